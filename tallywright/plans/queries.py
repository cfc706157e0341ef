"""Registered queries over the test tables, by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.operators import bronze, changes, digest, marts, quality, reconcile, reports
from tallywright.operators.asof import as_of_join
from tallywright.operators.bursts import burst_windows, bursts
from tallywright.operators.cube import IncrementalCube
from tallywright.operators.drift import against_exact, date_sketches
from tallywright.operators.profile import with_past_average, with_profile, with_zscore
from tallywright.operators.recurrence import weighted_volatility
from tallywright.operators.robust import with_robust_score
from tallywright.operators.rules import FraudRules
from tallywright.operators.velocity import (
    with_previous_amounts,
    with_rolling_totals,
    with_velocity_flag,
)
from tallywright.plans.fraud import flag_transactions, fraud_reports, score_transactions
from tallywright.plans.ingest import ingest_report, ingest_transactions
from tallywright.plans.marts import build_gold
from tallywright.session import fresh_folder, pin_time_zone, temporary_settings, written
from tallywright.sources import (
    card_transactions_from_events,
    event_amount,
    load_card_transactions,
    read_catalog_table,
    read_table,
    transactions_from_events,
)
from tallywright.schemas import TRANSACTIONS_BRONZE
from tallywright.streaming import event_stream, ingest, ingest_table, run_windows, window_counts
from tallywright.streaming.delivery import ingest_once, sweep_late
from tallywright.streaming.jobs import BY_DATE_AND_BATCH
from tallywright.streaming.velocity import run_velocity, trailing_counts

Query = Callable[[SparkSession, str], DataFrame]

# In the event table "purchase" stands for the high-risk category.
RULES = FraudRules(risky_category="purchase")
BATCH_ID = "batch-1"
CREATED_AT = "2026-08-01 00:00:00"
VELOCITY_WINDOW = "1 hour"
VELOCITY_LIMIT = 3
AS_OF = "2024-01-15 00:00:00"
WATERMARK = "1 day"
BURST_GAP = "2 hours"
REDELIVERY = "5 days"
SLOT_WIDTH = 64


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return card_transactions_from_events(read_table(spark, sf, "events"))


def _valid(spark: SparkSession, sf: str) -> DataFrame:
    return quality.accepted(load_card_transactions(_raw(spark, sf)))


def _flagged(spark: SparkSession, sf: str) -> DataFrame:
    return flag_transactions(_raw(spark, sf), RULES)


def _rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def _rounded_profile(df: DataFrame) -> DataFrame:
    """Means of amounts in tenths can tie at few decimals, where engines differ."""
    return _rounded(_rounded(df, 8, "cust_avg_amount"), 4, "cust_std_amount")


# --- load and gate ------------------------------------------------------------


def load_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return load_card_transactions(_raw(spark, sf))


def load_text_feed(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows from a feed whose timestamps are text."""
    feed = _raw(spark, sf).withColumn("timestamp", F.col("timestamp").cast("string"))
    return _plain_time(load_card_transactions(feed), "timestamp")


def dq_valid(spark: SparkSession, sf: str) -> DataFrame:
    return quality.accepted(_raw(spark, sf))


def dq_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return quality.rejected(_raw(spark, sf))


def dq_unclassified(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in neither branch. No amount is missing in these tables, so the query
    drops the amount of error events first."""
    amount = F.when(F.col("merchant_category") != "error", F.col("amount"))
    return quality.unclassified(_raw(spark, sf).withColumn("amount", amount))


def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.gate_counts(_raw(spark, sf))


def dq_balances(spark: SparkSession, sf: str) -> DataFrame:
    """The gate on account balances; the comparison reaches the scan."""
    return quality.rejected(read_table(spark, sf, "customer"), "c_acctbal").select(
        "c_custkey", "c_acctbal"
    )


# --- profile and flags --------------------------------------------------------


def customer_profile(spark: SparkSession, sf: str) -> DataFrame:
    out = with_profile(_valid(spark, sf)).select(
        "transaction_id", "customer_id", "amount", "cust_avg_amount", "cust_std_amount"
    )
    return _rounded_profile(out)


def customer_profile_past(spark: SparkSession, sf: str) -> DataFrame:
    out = with_past_average(_valid(spark, sf)).select(
        "transaction_id", "customer_id", "amount", "past_avg_amount"
    )
    return _rounded(out, 8, "past_avg_amount")


def customer_zscore(spark: SparkSession, sf: str) -> DataFrame:
    out = with_zscore(with_profile(_valid(spark, sf))).select(
        "transaction_id", "customer_id", "amount", "amount_zscore"
    )
    # Adding zero turns a rounded -0.0 into 0.0.
    return out.withColumn("amount_zscore", F.round("amount_zscore", 4) + F.lit(0.0))


def fraud_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _flagged(spark, sf).select(
        "transaction_id",
        "customer_id",
        "timestamp",
        "amount",
        "merchant_category",
        "is_fraudulent",
        "fraud_reason",
    )


def fraud_scored(spark: SparkSession, sf: str) -> DataFrame:
    """Every column of the flagged table: profile, previous amounts, flag."""
    out = score_transactions(_raw(spark, sf), RULES)
    return _rounded_profile(out)


def robust_outliers(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts measured against the customer's median and median deviation."""
    slim = _valid(spark, sf).select("transaction_id", "customer_id", "amount")
    return _rounded(with_robust_score(slim), 6, "median", "deviation", "robust_score")


# --- reports ------------------------------------------------------------------


def fraud_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reports.fraud_summary(_flagged(spark, sf))


def fraud_by_category(spark: SparkSession, sf: str) -> DataFrame:
    return reports.fraud_by_category(_flagged(spark, sf))


def fraud_by_card(spark: SparkSession, sf: str) -> DataFrame:
    return reports.fraud_by_card(_flagged(spark, sf))


def fraud_samples(spark: SparkSession, sf: str) -> DataFrame:
    return reports.fraud_samples(_flagged(spark, sf))


def fraud_job(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job as one table: gate counts seen by the profile pass, and the reports
    read from one cube, which is written and released."""
    out = fraud_reports(_raw(spark, sf), RULES)
    gate = spark.createDataFrame(
        [("gate", name, count, None) for name, count in out.gate.items()],
        "report string, item string, transactions long, measure double",
    )
    lines = [
        out.summary.select(
            F.lit("summary"), F.col("is_fraudulent").cast("string"), "tx_count", "total_volume"
        ),
        out.by_category.select(
            F.lit("category"), "merchant_category", "fraud_count", "fraud_volume"
        ),
        out.by_card.select(F.lit("card"), "card_type", "fraud_tx_count", "fraud_percentage"),
    ]
    kept = written(reduce(DataFrame.union, lines, gate), "fraud-job")
    out.close()
    return kept


def category_share(spark: SparkSession, sf: str) -> DataFrame:
    return reports.category_share(_valid(spark, sf))


# --- velocity -----------------------------------------------------------------


def velocity_lag(spark: SparkSession, sf: str) -> DataFrame:
    return with_previous_amounts(_valid(spark, sf)).select(
        "transaction_id", "customer_id", "amount", "prev_amount_1", "prev_amount_2"
    )


def velocity_rolling(spark: SparkSession, sf: str) -> DataFrame:
    slim = _valid(spark, sf).select("transaction_id", "customer_id", "timestamp", "amount")
    return with_rolling_totals(slim, VELOCITY_WINDOW).select(
        "transaction_id", "customer_id", "amount", "rolling_count", "rolling_amount"
    )


def velocity_flags(spark: SparkSession, sf: str) -> DataFrame:
    slim = _valid(spark, sf).select("transaction_id", "customer_id", "timestamp", "amount")
    return with_velocity_flag(slim, VELOCITY_WINDOW, VELOCITY_LIMIT).select(
        "transaction_id", "customer_id", "rolling_count", "is_high_velocity"
    )


def customer_bursts(spark: SparkSession, sf: str) -> DataFrame:
    """Events of a user that follow each other within the gap."""
    events = read_table(spark, sf, "events")
    return _plain_time(bursts(events, "user_id", "ts", "value", BURST_GAP, ["event_id"]), "start", "end")


# --- transaction table and ingest -----------------------------------------------


def _plain_time(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _transactions(spark: SparkSession, sf: str, batch_id: str = BATCH_ID) -> DataFrame:
    """One transaction for each event row."""
    created = F.lit(CREATED_AT).cast("timestamp")
    return transactions_from_events(read_table(spark, sf, "events"), batch_id, created)


def _comparable(table: DataFrame) -> DataFrame:
    out = _plain_time(table, "event_ts", "created_at")
    return out.withColumn("amount", F.col("amount").cast("double"))


def synth_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return _comparable(_transactions(spark, sf))


def synth_risk(spark: SparkSession, sf: str) -> DataFrame:
    """Risk by category and channel."""
    return (
        _transactions(spark, sf)
        .groupBy("merchant_category", "channel")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count_if("is_card_present").alias("card_present"),
            F.min("risk_score").alias("min_risk"),
            F.max("risk_score").alias("max_risk"),
            F.round(F.avg("risk_score"), 4).alias("avg_risk"),
        )
    )


def _new_table(spark: SparkSession) -> dict[str, str]:
    folder = fresh_folder(spark, "bronze")
    return {
        "identifier": f"bronze.transactions_{uuid.uuid4().hex}",
        "location": f"{folder}/table",
        "namespace_location": f"{folder}/namespace",
    }


def _ingested(spark: SparkSession, sf: str) -> str:
    target = _new_table(spark)
    ingest_transactions(_transactions(spark, sf), **target)
    return target["identifier"]


def bronze_write(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per partition after the write."""
    table = read_catalog_table(spark, _ingested(spark, sf))
    return table.groupBy("processing_date").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("amount").cast("double").alias("amount"),
        F.min("transaction_id").alias("first_id"),
        F.max("transaction_id").alias("last_id"),
    )


def bronze_readback(spark: SparkSession, sf: str) -> DataFrame:
    return _comparable(read_catalog_table(spark, _ingested(spark, sf)))


def bronze_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """A second batch replaces the dates it holds, a rerun of it changes nothing, and
    the dates it does not hold survive."""
    identifier = _ingested(spark, sf)
    second = _transactions(spark, sf, "batch-2")
    later = second.filter(F.col("processing_date") >= F.lit("2026-07-20").cast("date"))
    bronze.overwrite_partitions(later, identifier)
    bronze.overwrite_partitions(later, identifier)
    return (
        read_catalog_table(spark, identifier)
        .groupBy("processing_date", "ingestion_batch_id")
        .agg(F.count(F.lit(1)).alias("records"), F.sum("amount").cast("double").alias("amount"))
    )


def cube_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Records and volume by category and channel, kept up to date while a second batch
    replaces the later dates with doubled amounts; the totals are never computed anew."""
    first = _transactions(spark, sf)
    later = first.filter(F.col("processing_date") >= F.lit("2026-07-20").cast("date"))
    cube = IncrementalCube(fresh_folder(spark, "cube"), "processing_date", ("merchant_category", "channel"))
    cube.replace(0, first, "amount")
    cube.replace(1, later.withColumn("amount", F.col("amount") * 2), "amount")
    return cube.totals(spark, first.schema).withColumn("volume", F.col("volume").cast("double"))


def category_counts(spark: SparkSession, sf: str) -> DataFrame:
    return ingest_report(read_catalog_table(spark, _ingested(spark, sf)))


# --- marts --------------------------------------------------------------------


def silver_clean(spark: SparkSession, sf: str) -> DataFrame:
    return marts.silver_clean(
        read_table(spark, sf, "lineitem"),
        keys=["l_orderkey", "l_linenumber"],
        latest_by="l_shipdate",
        valid=F.col("l_quantity") > 0,
        codes=["l_returnflag", "l_linestatus"],
        types={"l_shipdate": "date"},
    )


def silver_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Line items in five batches, out of order, into a table that is kept up to date; returned
    lines remove their key. Every batch is applied twice."""
    lines = read_table(spark, sf, "lineitem").filter(F.col("l_quantity") > 0)
    cleaned = lines.withColumn("l_shipdate", F.to_date("l_shipdate"))
    path = fresh_folder(spark, "silver")
    batch_of = F.pmod(F.dayofyear("l_shipdate"), F.lit(5))
    others = [c for c in cleaned.columns if c not in ("l_orderkey", "l_linenumber", "l_shipdate")]
    for batch in (3, 0, 4, 1, 2):
        for _ in range(2):
            changes.apply_changes(
                path,
                cleaned.filter(batch_of == batch),
                ["l_orderkey", "l_linenumber"],
                ["l_shipdate", *others],
                deleted=F.col("l_returnflag") == "R",
                buckets=16,
            )
    return changes.read_current(spark, path, cleaned.schema)


def purchase_quotes(spark: SparkSession, sf: str) -> DataFrame:
    """Every purchase with the newest click of its user no later than it."""
    events = read_table(spark, sf, "events")
    bought = events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    clicks = events.filter(F.col("event_type") == "click").select(
        "user_id", F.col("ts").alias("click_ts"), F.col("event_id").alias("click_id"), F.col("value").alias("click_value")
    )
    return as_of_join(
        bought, clicks, "user_id", "ts", "click_ts", ["click_id", "click_ts", "click_value"], ["click_id"]
    )


def daily_ohlc(spark: SparkSession, sf: str) -> DataFrame:
    return marts.bars(read_table(spark, sf, "events"), "event_type", "value", "ts", "event_id")


def _monthly_prices(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders")
    return marts.sector_prices(orders, "o_orderpriority", "o_totalprice", "o_orderdate", "month")


def _daily_closes(spark: SparkSession, sf: str) -> DataFrame:
    return daily_ohlc(spark, sf).select("period", F.col("symbol").alias("sector"), "close")


def _by_symbol(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("sector", "symbol")


def daily_returns(spark: SparkSession, sf: str) -> DataFrame:
    """Change of each symbol's daily close."""
    out = marts.period_returns(_daily_closes(spark, sf))
    return _by_symbol(_rounded(out, 6, "period_return"))


def daily_volatility(spark: SparkSession, sf: str) -> DataFrame:
    out = marts.volatility(marts.period_returns(_daily_closes(spark, sf)))
    return _by_symbol(_rounded(out, 6, "period_return", "volatility"))


def ewma_volatility(spark: SparkSession, sf: str) -> DataFrame:
    """Exponentially weighted volatility of each symbol's daily close."""
    out = weighted_volatility(marts.period_returns(_daily_closes(spark, sf)))
    return _by_symbol(_rounded(out, 6, "period_return", "ewma_volatility"))


def walk_forward(spark: SparkSession, sf: str) -> DataFrame:
    """Each month's summed price forecast from the sector's earlier months, as parts of the price:
    forecasts of prices in cents often lie halfway between two cents, where engines differ."""
    out = marts.walk_forward(_monthly_prices(spark, sf))
    parts = {c: F.round(F.col(c) / F.nullif(F.col("close"), F.lit(0.0)), 6) for c in ("forecast", "error")}
    return out.withColumns(parts)


def forecast_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of forecasts by day, made from earlier days only."""
    out = marts.forecast_errors(marts.walk_forward(_daily_closes(spark, sf), "day"))
    return _by_symbol(_rounded(out, 4, "bias", "mean_absolute", "root_mean_square"))


def daily_trend(spark: SparkSession, sf: str) -> DataFrame:
    out = marts.trend_forecast(_daily_closes(spark, sf), "day")
    return _by_symbol(_rounded(out, 2, "slope", "intercept", "forecast"))


def monthly_returns(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(marts.period_returns(_monthly_prices(spark, sf)), 6, "period_return")


def volatility(spark: SparkSession, sf: str) -> DataFrame:
    out = marts.volatility(marts.period_returns(_monthly_prices(spark, sf)))
    return _rounded(out, 6, "period_return", "volatility")


def gold_volatility(spark: SparkSession, sf: str) -> DataFrame:
    """Through both gates, written by period and sector, read back."""
    gold = build_gold(read_table(spark, sf, "orders"), fresh_folder(spark, "gold"))
    return _rounded(gold, 6, "period_return", "volatility")


def asof_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events")
    return marts.as_of(events, "user_id", "ts", AS_OF, ["event_id"])


def silver_refused(spark: SparkSession, sf: str) -> DataFrame:
    """Events the cleaning refuses, with the reason; errors stand for a missing key."""
    events = read_table(spark, sf, "events").withColumn(
        "user_id", F.when(F.col("event_type") != "error", F.col("user_id"))
    )
    out = marts.silver_refused(events, ["event_id", "user_id"], F.col("value") > 10)
    return out.select("event_id", "value", "reason")


def dq_suite(spark: SparkSession, sf: str) -> DataFrame:
    customers = quality.check(
        read_table(spark, sf, "customer"),
        [
            quality.not_null("c_custkey"),
            quality.in_range("c_acctbal", 0.0, 10_000.0),
            quality.unique("c_custkey"),
        ],
    )
    orders = quality.check(
        read_table(spark, sf, "orders"),
        [
            quality.not_null("o_custkey"),
            quality.in_set("o_orderstatus", ["O", "F"]),
            quality.unique("o_orderkey"),
        ],
    )
    lines = quality.check(
        read_table(spark, sf, "lineitem"),
        [
            quality.in_range("l_discount", 0.0, 0.1),
            quality.unique("l_orderkey", "l_linenumber"),
        ],
    )
    return customers.unionByName(orders).unionByName(lines)


def drift_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Users and values of each day by stored sketches, held against exact counts."""
    events, day = read_table(spark, sf, "events"), F.to_date("ts")
    sketches = written(date_sketches(events, day, "user_id", "value"), "sketches")
    return against_exact(sketches, events, day, "user_id", "value")


def trend_forecast(spark: SparkSession, sf: str) -> DataFrame:
    out = marts.trend_forecast(_monthly_prices(spark, sf))
    return _rounded(out, 2, "slope", "intercept", "forecast")


# --- streaming ----------------------------------------------------------------

WINDOW_KEYS = ["window_start", "event_type"]


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = read_table(spark, sf, "events").schema
    return event_stream(spark, sf, "events", schema, "ts")


def _stream_windows(stream: DataFrame) -> DataFrame:
    counted = window_counts(stream, "ts", ["event_type"], "value", watermark=WATERMARK)
    return run_windows(counted, ["event_type"])


def _batch_windows(events: DataFrame) -> DataFrame:
    return window_counts(events, "ts", ["event_type"], "value")


def _accepted_events(events: DataFrame) -> DataFrame:
    """Events whose card transaction passes the gate."""
    return quality.accepted(events.withColumn("amount", event_amount())).drop("amount")


def stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    return _plain_time(_stream_windows(_event_stream(spark, sf)), "window_start")


def _ingested_stream(stream: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    spark = stream.sparkSession
    path = fresh_folder(spark, "stream")
    ingest(stream, path, fresh_folder(spark, "stream-progress"), partition_by)
    return spark.read.schema(stream.schema).parquet(path)


def _card_stream(spark: SparkSession, sf: str) -> DataFrame:
    cards = card_transactions_from_events(_event_stream(spark, sf))
    return cards.withColumn("processing_date", F.to_date("timestamp"))


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Accepted transactions streamed into date partitions, read back."""
    stream = quality.accepted(_card_stream(spark, sf))
    return _plain_time(_ingested_stream(stream, ["processing_date"]), "timestamp")


def _streamed_bronze(spark: SparkSession, sf: str) -> DataFrame:
    target = _new_table(spark)
    identifier = target["identifier"]
    bronze.create_namespace(spark, "bronze", target["namespace_location"])
    bronze.create_table(
        spark, identifier, TRANSACTIONS_BRONZE, BY_DATE_AND_BATCH, location=target["location"]
    )
    created = F.lit(CREATED_AT).cast("timestamp")
    stream = transactions_from_events(_event_stream(spark, sf), BATCH_ID, created)
    ingest_table(stream, identifier, fresh_folder(spark, "bronze-progress"))
    return read_catalog_table(spark, identifier).drop("ingestion_batch_id")


def stream_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Events streamed into the transaction table, read back."""
    return _comparable(_streamed_bronze(spark, sf))


def stream_once(spark: SparkSession, sf: str) -> DataFrame:
    """Three deliveries that repeat themselves, each followed by a restart, into the transaction
    table. Sign-ups of the first days come only with the last one, too late to be told from
    repeats; a sweep brings them in."""
    events = read_table(spark, sf, "events")
    folder = fresh_folder(spark, "deliveries")
    target = _new_table(spark)
    identifier = target["identifier"]
    bronze.create_namespace(spark, "bronze", target["namespace_location"])
    bronze.create_table(
        spark, identifier, TRANSACTIONS_BRONZE, BY_DATE_AND_BATCH, location=target["location"]
    )
    created = F.lit(CREATED_AT).cast("timestamp")
    to_rows = lambda rows: transactions_from_events(rows, BATCH_ID, created)
    third = F.least(F.lit(2), F.floor((F.dayofmonth("ts") - 1) / 10))
    kind = F.col("event_type")
    late = (third == 0) & (kind == "signup")
    progress = fresh_folder(spark, "once-progress")
    for delivery in range(3):
        own = events.filter((third == delivery) & ~late)
        # The same batch twice over for some, the batch before once more, and what was held back.
        again = events.filter((third == delivery) & (kind == "click"))
        before = events.filter((third == delivery - 1) & (kind != "signup"))
        parts = [own, again, before] + ([events.filter(late)] if delivery == 2 else [])
        reduce(DataFrame.unionByName, parts).coalesce(2).write.mode("append").parquet(f"{folder}/events.parquet")
        stream = event_stream(spark, folder, "events", events.schema, "ts", 1)
        ingest_once(stream, ["event_id"], "ts", REDELIVERY, to_rows, identifier, progress)
    delivered = spark.read.schema(events.schema).parquet(f"{folder}/events.parquet")
    sweep_late(to_rows(delivered), identifier, ["transaction_id"], "late")
    return _comparable(read_catalog_table(spark, identifier).drop("ingestion_batch_id"))


def stream_velocity(spark: SparkSession, sf: str) -> DataFrame:
    """Velocity flags of accepted transactions as they arrive; after the end, those of the batch."""
    stream = quality.accepted(_card_stream(spark, sf))
    counted = trailing_counts(
        stream, "customer_id", "timestamp", "transaction_id", VELOCITY_WINDOW, WATERMARK
    )
    return run_velocity(counted, "customer_id", "transaction_id", VELOCITY_LIMIT)


def stream_bursts(spark: SparkSession, sf: str) -> DataFrame:
    """Bursts that are over when the stream ends: those the watermark has passed."""
    found = burst_windows(_event_stream(spark, sf), "user_id", "ts", "value", BURST_GAP, WATERMARK)
    path = fresh_folder(spark, "bursts")
    stores = spark.sparkContext.defaultParallelism
    with temporary_settings(spark, {"spark.sql.shuffle.partitions": str(stores)}):
        ingest(found, path, fresh_folder(spark, "bursts-progress"), [])
    return _plain_time(spark.read.schema(found.schema).parquet(path), "start", "end")


def reconcile_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """The batch table against the streamed one: every transaction is equal."""
    batch = read_catalog_table(spark, _ingested(spark, sf)).drop("ingestion_batch_id")
    measures = [c for c in batch.columns if c != "transaction_id"]
    compared = reconcile.compare(batch, _streamed_bronze(spark, sf), ["transaction_id"], measures)
    return reconcile.status_counts(compared)


def reconcile_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Batch and stream over the same rows: every window is equal."""
    compared = reconcile.compare(
        _batch_windows(read_table(spark, sf, "events")),
        _stream_windows(_event_stream(spark, sf)),
        WINDOW_KEYS,
        ["events", "total"],
    )
    return reconcile.status_counts(compared)


def reconcile_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Ungated batch against gated stream: the windows that lost rows."""
    found = reconcile.differences(
        _batch_windows(read_table(spark, sf, "events")),
        _stream_windows(_accepted_events(_event_stream(spark, sf))),
        WINDOW_KEYS,
        ["events", "total"],
    )
    return _plain_time(found, "window_start")


def reconcile_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Gated batch rows against ungated streamed rows: the rejected ones."""
    streamed = _ingested_stream(_card_stream(spark, sf), ["processing_date"])
    batch = _valid(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return _plain_time(reconcile.row_differences(batch, streamed), "timestamp")


def reconcile_digest(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows by digests: only slots of ids whose sums differ are read again."""
    streamed = _ingested_stream(_card_stream(spark, sf), ["processing_date"])
    batch = _valid(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    batch = written(batch.select(*[c for c in streamed.columns if c in batch.columns]), "batch")
    streamed = streamed.select(*batch.columns)
    trees = [digest.digest_tree(side, "transaction_id", SLOT_WIDTH) for side in (batch, streamed)]
    return _plain_time(digest.digest_differences(batch, streamed, *trees), "timestamp")


REGISTERED: tuple[Query, ...] = (
    load_transactions,
    load_text_feed,
    dq_valid,
    dq_rejected,
    dq_unclassified,
    dq_summary,
    dq_balances,
    customer_profile,
    customer_profile_past,
    customer_zscore,
    robust_outliers,
    fraud_flags,
    fraud_scored,
    fraud_summary,
    fraud_by_category,
    fraud_by_card,
    fraud_samples,
    fraud_job,
    category_share,
    velocity_lag,
    velocity_rolling,
    velocity_flags,
    customer_bursts,
    synth_transactions,
    synth_risk,
    bronze_write,
    bronze_readback,
    bronze_overwrite,
    cube_incremental,
    category_counts,
    silver_clean,
    silver_incremental,
    purchase_quotes,
    daily_ohlc,
    daily_returns,
    daily_volatility,
    ewma_volatility,
    daily_trend,
    monthly_returns,
    silver_refused,
    volatility,
    gold_volatility,
    asof_snapshot,
    dq_suite,
    drift_sketches,
    trend_forecast,
    walk_forward,
    forecast_errors,
    stream_windows,
    stream_ingest,
    stream_bronze,
    stream_once,
    stream_velocity,
    stream_bursts,
    reconcile_bronze,
    reconcile_windows,
    reconcile_gate,
    reconcile_rows,
    reconcile_digest,
)


def registry() -> dict[str, Query]:
    """Queries by name, each pinned to UTC."""

    def pinned(query: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return query(pin_time_zone(spark), sf)

        return run

    return {query.__name__: pinned(query) for query in REGISTERED}
