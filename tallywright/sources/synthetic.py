"""Deterministic synthetic transactions derived from a column of record ids."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.functions import cycle, hash_draw, padded_id
from tallywright.schemas import TRANSACTIONS_BRONZE

# Fixed values of the synthetic table.
MERCHANT_CATEGORIES = [
    "grocery",
    "fuel",
    "travel",
    "online_services",
    "electronics",
    "cash_withdrawal",
    "gaming",
    "utilities",
]
COUNTRIES = ["US", "IN", "GB", "DE", "SG"]
CHANNELS = ["pos", "mobile", "web", "atm"]
RISKY_CATEGORIES = ["gaming", "cash_withdrawal"]
FIRST_DATE = "2026-07-01"
DAYS = 31
ACCOUNTS = 25_000
CUSTOMERS = 15_000
AMOUNT_SEED = 42
RISK_SEED = 99
RANGE_PARTITIONS = 16


def id_range(
    spark: SparkSession, rows: int, partitions: int = RANGE_PARTITIONS
) -> DataFrame:
    """Record ids ``0 .. rows-1``; ``rand`` draws repeat only for equal ``partitions``."""
    return spark.range(0, rows, 1, partitions).withColumnRenamed("id", "record_id")


def default_batch_id() -> str:
    return datetime.now(timezone.utc).isoformat()


def _draws(mode: str, record_id: Column) -> tuple[Column, Column]:
    """Amount and the variable part of the risk score."""
    if mode == "rand":
        amount = F.round(F.rand(AMOUNT_SEED) * 9500.0 + 1.0, 2)
        return amount.cast("decimal(12,2)"), F.rand(RISK_SEED) * 0.35
    if mode == "hash":
        cents = hash_draw(record_id, 950_001) + 100
        amount = (cents / 100).cast("decimal(12,2)")
        risk = hash_draw(F.concat(F.lit("risk"), record_id.cast("string")), 3_501)
        return amount, risk / 10_000
    raise ValueError(f"unknown draw mode {mode!r}")


def make_transactions(
    ids: DataFrame,
    batch_id: str | None = None,
    created_at: Column | None = None,
    draws: str = "hash",
    customer: Column | None = None,
    amount: Column | None = None,
) -> DataFrame:
    """Sixteen transaction columns, each a function of ``record_id`` unless given.

    ``customer`` and ``amount`` take what the input rows hold in place of the
    formula and of the draw. ``draws='hash'`` depends on the id only.
    ``draws='rand'`` uses seeded generators and so also on the partition layout of
    ``ids``.
    """
    record_id = F.col("record_id")
    drawn, risk_part = _draws(draws, record_id)
    amount = drawn if amount is None else amount.cast("decimal(12,2)")
    customer = F.pmod(record_id, F.lit(CUSTOMERS)) if customer is None else customer
    event_date = F.date_add(
        F.to_date(F.lit(FIRST_DATE)), F.pmod(record_id, F.lit(DAYS)).cast("int")
    )
    base = ids.select(
        "record_id",
        padded_id("TX", 12, record_id).alias("transaction_id"),
        padded_id("ACCT", 8, F.pmod(record_id, F.lit(ACCOUNTS))).alias("account_id"),
        padded_id("CUST", 7, customer).alias("customer_id"),
        event_date.alias("event_date"),
        cycle(MERCHANT_CATEGORIES, record_id).alias("merchant_category"),
        amount.alias("amount"),
        risk_part.alias("risk_part"),
    )
    risk_floor = F.when(F.col("merchant_category").isin(RISKY_CATEGORIES), 0.42).otherwise(0.12)
    derived = base.select(
        "*",
        F.timestamp_add(
            "SECOND", (record_id % 86_400).cast("int"), F.col("event_date").cast("timestamp")
        ).alias("event_ts"),
        F.lit("USD").alias("currency"),
        cycle(COUNTRIES, record_id).alias("country"),
        cycle(CHANNELS, record_id).alias("channel"),
        (F.pmod(record_id, F.lit(3)) != 0).alias("is_card_present"),
        F.round(risk_floor + F.col("risk_part"), 4).alias("risk_score"),
        F.lit(batch_id if batch_id is not None else default_batch_id()).alias(
            "ingestion_batch_id"
        ),
        F.sha2(F.concat("transaction_id", "customer_id"), 256).alias("payload_hash"),
        (created_at if created_at is not None else F.current_timestamp()).alias("created_at"),
        F.col("event_date").alias("processing_date"),
    )
    return derived.select(*TRANSACTIONS_BRONZE.fieldNames())


def transactions_from_events(
    events: DataFrame, batch_id: str | None = None, created_at: Column | None = None
) -> DataFrame:
    """One transaction for each event: its id, its user as customer, its value as amount."""
    rows = events.select(F.col("event_id").alias("record_id"), "user_id", "value")
    return make_transactions(
        rows, batch_id, created_at, customer=F.col("user_id"), amount=F.col("value")
    )
