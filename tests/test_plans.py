"""What the plans must look like for large inputs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallywright.functions.money import exact_sum
from tallywright.operators import marts, reports
from tallywright.operators.profile import attach_profile, profile_table
from tallywright.operators.quality import accepted, check, rejected, unique
from tallywright.operators.skew import SkewPolicy
from tallywright.plans import queries as q
from tallywright.schemas import SchemaError
from tallywright.session import written
from tallywright.sources import read_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df)


@pytest.fixture(scope="module")
def valid(spark, sf_small):
    return q._valid(spark, sf_small)


def test_gate_reaches_the_scan(spark, sf_small):
    text = plan(rejected(read_table(spark, sf_small, "customer"), "c_acctbal"))
    assert "LessThanOrEqual(c_acctbal,0.0)" in text


def test_as_of_reaches_the_scan_and_limits_before_the_shuffle(spark, sf_small):
    text = plan(q.asof_snapshot(spark, sf_small))
    assert "PushedFilters: [IsNotNull(ts), LessThanOrEqual(ts" in text
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[exchange:]


def test_keep_latest_limits_before_the_shuffle(spark, sf_small):
    text = plan(q.silver_clean(spark, sf_small))
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[exchange:]
    assert "IsNotNull(l_orderkey)" in text


def test_small_profile_leaves_the_facts_in_place(valid):
    text = plan(q.with_profile(valid))
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text and "Window" not in text


def test_large_profile_is_shuffled_with_a_salt(valid):
    profile = written(profile_table(valid), "profile")
    policy = SkewPolicy(rows_per_task=10, broadcast_rows=10)
    joined = attach_profile(valid, profile, policy)
    text = plan(joined)
    assert "_salt" in text
    # The list of hot keys is longer than the limit allows, so nothing is broadcast by hint.
    assert "TakeOrderedAndProject" not in text
    assert joined.count() == valid.count()


def test_report_reads_only_its_columns(spark, sf_small):
    text = plan(q.fraud_by_card(spark, sf_small))
    scan = text[text.index("event_id") :]
    assert "props" not in scan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint" in text


def test_samples_are_a_top_k(spark, sf_small):
    assert "TakeOrderedAndProject(limit=10" in plan(q.fraud_samples(spark, sf_small))


def test_shares_scan_once(valid):
    shares = reports.category_share(valid)
    text = final_plan(shares)
    assert "ReusedExchange" in text
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_previous_amounts_take_one_shuffle(spark, sf_small):
    text = plan(q.velocity_lag(spark, sf_small))
    assert text.count("Exchange") == 1
    assert text.count("+- Window") == 1


def test_rolling_totals_take_one_shuffle_and_a_growing_frame(spark, sf_small):
    text = plan(q.velocity_rolling(spark, sf_small))
    assert text.count("Exchange") == 1
    assert "unboundedpreceding$(), currentrow$()" in text


def test_bars_combine_before_the_shuffle(spark, sf_small):
    text = plan(q.daily_ohlc(spark, sf_small))
    assert "partial_min_by" in text and text.count("Exchange") == 1
    assert "SortAggregate" not in text and "Sort " not in text


def test_unique_counts_combine_before_the_shuffle(spark, sf_small):
    text = plan(check(read_table(spark, sf_small, "orders"), [unique("o_orderkey")]))
    assert "partial_count" in text and "IsNotNull(o_orderkey)" in text


def test_returns_and_volatility_share_a_shuffle(spark, sf_small):
    text = plan(q.volatility(spark, sf_small))
    assert text.count("Exchange") == 2  # one for the prices, one for both windows


def test_filter_stays_below_the_profile(valid):
    flagged = accepted(valid).groupBy("customer_id").agg(F.avg("amount"))
    assert "Filter" in plan(flagged)


def test_no_query_joins_without_keys(spark, sf_small):
    for name in ("fraud_scored", "category_share", "dq_suite", "trend_forecast", "daily_returns"):
        text = plan(q.registry()[name](spark, sf_small))
        assert "NestedLoop" not in text and "CartesianProduct" not in text, name


def test_period_is_taken_from_the_date(spark, sf_small):
    orders = read_table(spark, sf_small, "orders")
    text = plan(marts.sector_prices(orders, "o_orderpriority", "o_totalprice", "o_orderdate", "month"))
    assert "as timestamp" not in text


def test_money_sums_do_not_depend_on_the_layout(spark):
    rows = spark.range(0, 200_000).select(
        (F.col("id") % 3 == 0).alias("is_fraudulent"),
        F.lit("Retail").alias("merchant_category"),
        F.lit("Visa").alias("card_type"),
        F.col("id").alias("transaction_id"),
        F.round(F.rand(3) * 1e9, 2).alias("amount"),
    )
    rows = written(rows, "money")
    for report in (reports.fraud_summary, reports.fraud_by_category, reports.category_share):
        found = {frozenset(map(tuple, report(rows.repartition(n)).collect())) for n in (1, 3, 16)}
        assert len(found) == 1
    cube = {frozenset(map(tuple, reports.fraud_summary(reports.report_cube(rows.repartition(n))).collect())) for n in (1, 5)}
    assert cube == {frozenset(map(tuple, reports.fraud_summary(rows).collect()))}


def test_exact_sum_keeps_odd_values(spark):
    rows = spark.createDataFrame([(1, float("nan")), (2, 1e30), (2, 0.5), (3, None), (4, 0.1), (4, 0.2)], "k int, v double")
    found = {r["k"]: r["s"] for r in rows.groupBy("k").agg(exact_sum("v").alias("s")).collect()}
    assert found[1] != found[1] and found[2] == 1e30 + 0.5 and found[3] is None and found[4] == 0.3


def test_wrong_columns_stop_before_the_plan(spark, tmp_path):
    spark.range(3).selectExpr("id as event_id", "'x' as value").write.parquet(str(tmp_path / "events.parquet"))
    with pytest.raises(SchemaError, match="ts missing instead of timestamp_ntz.*value string instead of double"):
        read_table(spark, str(tmp_path), "events")


def test_job_leaves_no_cached_cube(spark, sf_small):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    assert q.fraud_job(spark, sf_small).where("report = 'gate'").count() == 5
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
