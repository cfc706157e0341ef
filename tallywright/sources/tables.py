"""Table readers and the mapping of an event table onto card transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.functions import cycle
from tallywright.schemas import CARD_FEED, CARD_TRANSACTIONS, GIVEN_TABLES, require_columns

# Fixed values of the card feed.
CARD_TYPES = ["Visa", "Mastercard", "Amex"]
COUNTRIES = ["US", "CA", "GB", "IN", "DE"]
INVALID_AMOUNT = -99.0
INVALID_EVERY = 97


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of ``folder``, either one file or a folder of part files.

    Columns of a known table are checked before anything runs on them.
    """
    table = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    require_columns(table.schema, GIVEN_TABLES.get(name, {}), name)
    return table


def read_card_transactions(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet feed of card transactions, whose time may still be text."""
    feed = spark.read.parquet(path)
    text = isinstance(feed.schema["timestamp"].dataType, T.StringType) if "timestamp" in feed.columns else False
    wanted = CARD_FEED if text else CARD_TRANSACTIONS
    require_columns(feed.schema, {f.name: f.dataType.simpleString() for f in wanted}, path)
    return feed


def read_catalog_table(spark: SparkSession, identifier: str) -> DataFrame:
    """A catalog table by its one-, two- or three-part name."""
    return spark.table(identifier)


def load_card_transactions(raw: DataFrame, tolerant: bool = False) -> DataFrame:
    """Give the feed a real timestamp column.

    Text is cast; under ANSI rules a malformed value stops the job. With
    ``tolerant`` it becomes NULL instead. Timestamp columns pass through.
    """
    if not isinstance(raw.schema["timestamp"].dataType, T.StringType):
        return raw
    text = F.col("timestamp")
    parsed = text.try_cast("timestamp") if tolerant else text.cast("timestamp")
    return raw.withColumn("timestamp", parsed)


def event_amount() -> Column:
    """The card amount of an event; invalid on about one row in a hundred."""
    invalid = F.col("event_id") % INVALID_EVERY == 0
    return F.when(invalid, F.lit(INVALID_AMOUNT)).otherwise(F.round(F.col("value") * 10, 2))


def card_transactions_from_events(events: DataFrame) -> DataFrame:
    """Card transactions read off an event table, bad amounts included.

    About one row in a hundred carries a negative amount so that the quality gate
    has something to reject; which rows do depends on their id alone.
    """
    return events.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("timestamp"),
        event_amount().alias("amount"),
        F.col("event_type").alias("merchant_category"),
        cycle(CARD_TYPES, F.col("event_id")).alias("card_type"),
        cycle(COUNTRIES, F.col("user_id")).alias("country"),
    )
