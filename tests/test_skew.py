"""Hot keys: the split paths must equal Spark's own window functions."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import as_rows, assert_close
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.operators.profile import ORDER, with_past_average, with_profile
from tallywright.operators.skew import SkewPolicy, lay_out
from tallywright.operators.velocity import with_previous_amounts, with_rolling_totals
from tallywright.schemas import CARD_TRANSACTIONS

START = datetime(2026, 7, 17)
SPLIT = SkewPolicy(rows_per_task=20, broadcast_rows=0)
WHOLE = SkewPolicy()


def _rows(seed, spread_seconds, null_key=False, odd_amounts=False):
    """Half of all rows belong to one customer; the rest to forty others."""
    draw = random.Random(seed)
    rows = []
    for i in range(600):
        hot = draw.random() < 0.5
        customer = (None if null_key else "HOT") if hot else f"C{draw.randrange(40):02d}"
        at = START + timedelta(seconds=draw.randrange(spread_seconds))
        amount = round(draw.uniform(1, 500), 2)
        if odd_amounts and draw.random() < 0.02:
            amount = draw.choice([float("nan"), float("inf"), None])
        rows.append((f"T{i:05d}", customer, at, amount, "Retail", "Visa", "US"))
    return rows


CASES = {
    "many ties": dict(seed=2, spread_seconds=6),
    "null key, one instant": dict(seed=3, spread_seconds=1, null_key=True),
    "odd amounts": dict(seed=5, spread_seconds=20_000, odd_amounts=True),
}


@pytest.fixture(params=sorted(CASES))
def rows(spark, request):
    data = _rows(**CASES[request.param])
    return spark.createDataFrame(data, CARD_TRANSACTIONS).repartition(5)


def test_hot_key_is_cut_into_even_chunks(rows):
    laid = lay_out(rows, "customer_id", ORDER, SPLIT)
    assert laid.split
    sizes = laid.hot.groupBy("_chunk").count().collect()
    assert len(sizes) > 5
    assert max(r["count"] for r in sizes) < 100
    assert laid.rows.count() == 600


def test_without_hot_keys_nothing_is_written(rows):
    laid = lay_out(rows, "customer_id", ORDER, WHOLE)
    assert not laid.split and laid.hot is None


def test_previous_amounts(rows):
    w = W.partitionBy("customer_id").orderBy(*ORDER)
    expected = rows.withColumn("prev_amount_1", F.lag("amount", 1).over(w)).withColumn(
        "prev_amount_2", F.lag("amount", 2).over(w)
    )
    for policy in (SPLIT, WHOLE):
        assert as_rows(with_previous_amounts(rows, policy)) == as_rows(expected)


def test_rolling_totals(rows):
    seconds = 600
    w = (
        W.partitionBy("customer_id")
        .orderBy(F.col("timestamp").cast("long"))
        .rangeBetween(-seconds, 0)
    )
    expected = rows.withColumn("rolling_count", F.count(F.lit(1)).over(w)).withColumn(
        "rolling_amount", F.sum("amount").over(w)
    )
    for policy in (SPLIT, WHOLE):
        assert_close(with_rolling_totals(rows, f"{seconds} seconds", policy), expected)


def test_rolling_totals_of_decimals_stay_exact(spark):
    rows = spark.createDataFrame(_rows(seed=1, spread_seconds=4_000), CARD_TRANSACTIONS)
    exact = rows.withColumn("amount", F.col("amount").cast("decimal(12,2)"))
    w = W.partitionBy("customer_id").orderBy(F.col("timestamp").cast("long")).rangeBetween(-60, 0)
    expected = exact.withColumn("rolling_amount", F.sum("amount").over(w).cast("decimal(30,2)"))
    for policy in (SPLIT, WHOLE):
        got = with_rolling_totals(exact, "1 minute", policy).drop("rolling_count")
        got = got.withColumn("rolling_amount", F.col("rolling_amount").cast("decimal(30,2)"))
        assert as_rows(got) == as_rows(expected)


def test_past_average(rows):
    w = W.partitionBy("customer_id").orderBy(*ORDER).rowsBetween(W.unboundedPreceding, -1)
    expected = rows.withColumn("past_avg_amount", F.avg("amount").over(w))
    for policy in (SPLIT, WHOLE):
        assert_close(with_past_average(rows, policy), expected)


def test_profile_by_broadcast_and_by_salted_join(rows):
    w = W.partitionBy("customer_id")
    expected = rows.withColumn("cust_avg_amount", F.avg("amount").over(w)).withColumn(
        "cust_std_amount", F.stddev("amount").over(w)
    )
    for policy in (SPLIT, WHOLE):
        assert_close(with_profile(rows, policy), expected)


def test_copies_of_one_row_are_spread(spark):
    """All rows of the hot key are equal in every column."""
    copies = spark.range(0, 400, 1, 8).select(
        F.lit("T1").alias("transaction_id"),
        F.lit("HOT").alias("customer_id"),
        F.lit(START).alias("timestamp"),
        F.lit(2.5).alias("amount"),
    )
    laid = lay_out(copies, "customer_id", ORDER, SPLIT)
    assert max(r["count"] for r in laid.hot.groupBy("_chunk").count().collect()) <= 200
    out = with_rolling_totals(copies, "1 hour", SPLIT)
    assert out.select("rolling_count", "rolling_amount").distinct().collect() == [(400, 1000.0)]
    assert with_profile(copies, SPLIT).filter("cust_avg_amount = 2.5").count() == 400
    lags = with_previous_amounts(copies, SPLIT)
    assert lags.filter(F.col("prev_amount_1").isNull()).count() == 1
    assert lags.filter(F.col("prev_amount_2").isNull()).count() == 2


def test_null_timestamps_keep_their_own_frame(spark):
    data = [(f"T{i}", "HOT", None if i % 3 else START, 1.0, "Retail", "Visa", "US") for i in range(90)]
    rows = spark.createDataFrame(data, CARD_TRANSACTIONS).repartition(3)
    for policy in (SPLIT, WHOLE):
        out = with_rolling_totals(rows, "1 hour", policy)
        got = {(r["timestamp"], r["rolling_count"]) for r in out.collect()}
        assert got == {(None, 60), (START, 30)}


def test_every_key_above_the_limit_is_split(spark):
    """More hot keys than any list of fixed length would hold."""
    rows = spark.range(0, 12_000, 1, 6).select(
        F.format_string("T%05d", "id").alias("transaction_id"),
        (F.col("id") % 300).cast("string").alias("customer_id"),
        (F.lit(START).cast("timestamp") + F.make_dt_interval(secs=F.col("id").cast("double"))).alias("timestamp"),
        F.lit(1.0).alias("amount"),
    )
    policy = SkewPolicy(rows_per_task=10, broadcast_rows=50)
    laid = lay_out(rows, "customer_id", ORDER, policy)
    sizes = laid.rows.groupBy("customer_id", "_chunk").count()
    assert laid.rows.filter("_chunk = 0").count() == 0
    assert sizes.agg(F.max("count")).first()[0] < 40
    w = W.partitionBy("customer_id").orderBy(*ORDER)
    expected = rows.withColumn("prev_amount_1", F.lag("amount", 1).over(w)).withColumn(
        "prev_amount_2", F.lag("amount", 2).over(w)
    )
    assert as_rows(with_previous_amounts(rows, policy)) == as_rows(expected)


@pytest.mark.parametrize("amounts", [[4e-7, 4e-7, 1.5], [1e23, 3.25, 1e23], [1 / 3, 2 / 3, 7.0], [1e300, 1e-300, None]])
def test_odd_amounts_equal_the_range_frame(spark, amounts):
    data = [
        (f"T{i:03d}", f"C{i % 3}", START + timedelta(seconds=7 * i), amounts[i % 3] if i % 3 else 2.5, "Retail", "Visa", "US")
        for i in range(90)
    ] + [(f"U{i}", "ODD", START + timedelta(seconds=i), amounts[i % 3], "Retail", "Visa", "US") for i in range(40)]
    rows = spark.createDataFrame(data, CARD_TRANSACTIONS)
    w = W.partitionBy("customer_id").orderBy(F.col("timestamp").cast("long")).rangeBetween(-60, 0)
    expected = rows.withColumn("rolling_count", F.count(F.lit(1)).over(w)).withColumn("rolling_amount", F.sum("amount").over(w))
    for policy in (SPLIT, WHOLE):
        assert_close(with_rolling_totals(rows, "1 minute", policy), expected)


def test_wide_decimals_keep_their_scale(spark):
    rows = spark.createDataFrame(_rows(seed=4, spread_seconds=4_000), CARD_TRANSACTIONS)
    fine = rows.withColumn("amount", (F.col("amount") / 7).cast("decimal(38,10)"))
    w = W.partitionBy("customer_id").orderBy(F.col("timestamp").cast("long")).rangeBetween(-60, 0)
    expected = fine.withColumn("rolling_amount", F.sum("amount").over(w).cast("decimal(38,10)"))
    for policy in (SPLIT, WHOLE):
        got = with_rolling_totals(fine, "1 minute", policy).drop("rolling_count")
        got = got.withColumn("rolling_amount", F.col("rolling_amount").cast("decimal(38,10)"))
        assert as_rows(got) == as_rows(expected)
