"""As-of joins, recurrences, bursts and medians: split keys equal plain loops over rows."""

from __future__ import annotations

import math
import random
import statistics
from datetime import datetime, timedelta

import pytest
from conftest import as_rows

from tallywright.functions.money import exact_sum
from tallywright.operators.asof import as_of_join
from tallywright.operators.bursts import burst_windows, bursts
from tallywright.operators.recurrence import recurrence
from tallywright.operators.robust import exact_median, with_robust_score
from tallywright.operators.skew import SkewPolicy
from pyspark.sql import functions as F

START = datetime(2026, 7, 17)
SPLIT = SkewPolicy(rows_per_task=25, broadcast_rows=0)
WHOLE = SkewPolicy()
POLICIES = pytest.mark.parametrize("policy", [SPLIT, WHOLE], ids=["split", "whole"])


def keyed(seed, rows, seconds):
    """A third of the rows belong to one key, some to none; instants repeat and are missing."""
    draw = random.Random(seed)
    out = []
    for i in range(rows):
        key = draw.choice(["HOT", f"K{draw.randrange(12)}", f"K{draw.randrange(12)}"]) if i % 40 else None
        at = None if i % 50 == 7 else START + timedelta(seconds=draw.randrange(seconds))
        out.append((i, key, at, round(draw.uniform(-50, 50), 2)))
    return out


# --- as-of ------------------------------------------------------------------------------


@POLICIES
@pytest.mark.parametrize("seconds", [8, 100_000])
def test_as_of_join_equals_a_loop(spark, policy, seconds):
    facts, versions = keyed(1, 400, seconds), keyed(2, 300, seconds)
    expected = []
    for i, key, at, value in facts:
        fits = [v for v in versions if key is not None and v[1] == key and at is not None and v[2] is not None and v[2] <= at]
        best = max(fits, key=lambda v: (v[2], v[0]), default=(None, None, None, None))
        expected.append((i, key, at, value, best[0], best[3]))
    left = spark.createDataFrame(facts, "id long, key string, at timestamp_ntz, value double").repartition(4)
    right = spark.createDataFrame(versions, "version long, key string, since timestamp_ntz, price double").repartition(3)
    found = as_of_join(left, right, "key", "at", "since", ["version", "price"], ["version"], policy)
    assert found.columns == ["id", "key", "at", "value", "version", "price"]
    assert as_rows(found) == as_rows(spark.createDataFrame(expected, found.schema))


def test_as_of_join_without_rows(spark):
    facts = spark.createDataFrame(keyed(1, 20, 50), "id long, key string, at timestamp_ntz, value double")
    versions = facts.selectExpr("key", "at AS since", "value AS price")
    assert as_of_join(facts, versions.limit(0), "key", "at", "since", ["price"]).filter("price IS NULL").count() == 20
    assert as_of_join(facts.limit(0), versions, "key", "at", "since", ["price"]).count() == 0


def test_versions_without_values_hide_older_ones(spark):
    """The newest version counts even where its values are missing."""
    facts = spark.createDataFrame([("a", 5)], "key string, at int")
    versions = spark.createDataFrame([("a", 1, 2.0), ("a", 3, None)], "key string, since int, price double")
    assert as_of_join(facts, versions, "key", "at", "since", ["price"]).first()["price"] is None


# --- recurrence -------------------------------------------------------------------------


@POLICIES
@pytest.mark.parametrize("block_bits", [1, 3, 8])
def test_recurrence_equals_a_loop(spark, policy, block_bits):
    draw = random.Random(3)
    rows = []
    for i in range(500):
        multiplier = draw.choice([0.0, 0.94, -0.5, None, 0.9, 0.9])
        rows.append((i, "HOT" if i % 3 else f"K{i % 5}", multiplier, draw.choice([None, 1.5, -2.25, 0.125])))
    state, expected = {}, {}
    for i, key, m, a in rows:
        if m is not None and a is not None:
            state[key] = m * state.get(key, 0.0) + a
        expected[i] = state.get(key, 0.0)
    frame = spark.createDataFrame(rows, "n long, key string, m double, a double").repartition(5)
    found = recurrence(frame, "key", ["n"], F.col("m"), F.col("a"), "y", policy, block_bits)
    got = {r["n"]: r["y"] for r in found.collect()}
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[n], y, rel_tol=1e-12, abs_tol=1e-12) for n, y in expected.items())


# --- bursts -----------------------------------------------------------------------------


@POLICIES
@pytest.mark.parametrize("seconds", [60, 40_000])
def test_bursts_equal_session_windows(spark, policy, seconds):
    rows = keyed(4, 500, seconds)
    frame = spark.createDataFrame(rows, "id long, key string, at timestamp_ntz, value double").repartition(4)
    found = bursts(frame, "key", "at", "value", "30 seconds", ["id"], policy)
    expected = burst_windows(frame, "key", "at", "value", "30 seconds")
    assert as_rows(found) == as_rows(expected)
    assert found.agg(F.sum("events")).first()[0] == sum(r[2] is not None for r in rows)


def test_an_event_at_the_end_of_a_burst_belongs_to_it(spark):
    rows = [("a", START), ("a", START + timedelta(seconds=30)), ("a", START + timedelta(seconds=61))]
    frame = spark.createDataFrame([(k, t, 1.0) for k, t in rows], "key string, at timestamp_ntz, value double")
    for found in (bursts(frame, "key", "at", "value", "30 seconds"), burst_windows(frame, "key", "at", "value", "30 seconds")):
        assert sorted(r["events"] for r in found.collect()) == [1, 2]


# --- medians ----------------------------------------------------------------------------

SHAPES = {
    "spread": lambda d, i: d.uniform(-1e3, 1e3),
    "few values": lambda d, i: float(d.randrange(3)),
    "one value": lambda d, i: 7.25,
    "one far off": lambda d, i: 1e300 if i == 5 else d.uniform(1.0, 1.001),
    "wide": lambda d, i: d.choice([-1, 1]) * 10 ** d.uniform(-200, 200),
    "odd": lambda d, i: d.choice([float("nan"), float("inf"), None, 1.0, -2.0, 3.5, 0.0, -0.0]),
}


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_medians_of_hot_and_cold_keys(spark, monkeypatch, shape):
    from tallywright.operators import robust

    monkeypatch.setattr(robust, "FEW", 8)
    draw = random.Random(6)
    rows = [(None if i % 7 == 0 else "HOT" if i % 3 else f"K{i % 5}", SHAPES[shape](draw, i)) for i in range(700)]
    groups = {}
    for key, value in rows:
        if value is not None and math.isfinite(value):
            groups.setdefault(key, []).append(value)
    frame = spark.createDataFrame(rows, "key string, value double").repartition(4)
    for policy in (SPLIT, WHOLE):
        found = {r["key"]: (r["_rows"], r["_median"]) for r in exact_median(frame, "key", "value", policy).collect()}
        assert found.keys() == groups.keys()
        for key, values in groups.items():
            assert found[key][0] == len(values)
            assert math.isclose(found[key][1], statistics.median(values), rel_tol=1e-12), (policy, key)


def test_robust_scores(spark):
    rows = [(f"T{i}", "a", float(v)) for i, v in enumerate([10, 11, 12, 13, 14, 1000])] + [("U", "b", 5.0), ("V", "b", 5.0), ("W", "b", 9.0)]
    frame = spark.createDataFrame(rows, "transaction_id string, customer_id string, amount double")
    found = {r["transaction_id"]: r for r in with_robust_score(frame).collect()}
    assert {k for k, r in found.items() if r["is_robust_outlier"]} == {"T5"}
    assert found["W"]["deviation"] == 0 and found["W"]["robust_score"] is None
    assert math.isclose(found["T0"]["robust_score"], -2.5 / (1.4826 * 1.5))


# --- exact sums -------------------------------------------------------------------------


@pytest.mark.parametrize("amount, expected", [(4e-7, 0.04), (1e-9, 1e-4), (0.1234567, 12345.67), (1e25, 1e30), (1 / 3, 33333.3333333333), (12345678901.5, 1234567890150000.0)])
def test_no_amount_is_rounded_before_it_is_added(spark, amount, expected):
    for tasks in (1, 3, 16):
        frame = spark.range(0, 100_000, 1, tasks).select(F.lit(amount).alias("v"))
        assert math.isclose(frame.agg(exact_sum("v").alias("s")).first()["s"], expected, rel_tol=1e-12)


def test_sums_do_not_depend_on_the_layout(spark):
    draw = random.Random(8)
    values = [(draw.choice([1e-9, 1e-7, 0.01, 1e5, 1e12]) * draw.random(),) for _ in range(4_000)] + [(None,)]
    frame = spark.createDataFrame(values, "v double")
    sums = {frame.repartition(n).agg(exact_sum("v").alias("s")).first()["s"] for n in (1, 3, 16)}
    assert len(sums) == 1 and math.isclose(sums.pop(), math.fsum(v for v, in values if v is not None), rel_tol=1e-12)
    odd = spark.createDataFrame([(float("nan"),), (1.0,)], "v double").agg(exact_sum("v").alias("s")).first()["s"]
    assert math.isnan(odd)
    assert spark.createDataFrame([(None,)], "v double").agg(exact_sum("v").alias("s")).first()["s"] is None
