"""Stored sketches: bounded errors, merging, and what counts as drift."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tallywright.operators.drift import against_exact, date_sketches, different_between, drift, estimates
from tallywright.session import written

SCHEMA = "day int, user string, value double"


def rows_of(draw, day, n, centre=0.0, users=500):
    return [(day, f"u{draw.randrange(users)}", draw.gauss(centre, 1.0)) for _ in range(n)]


def stored(spark, rows, tasks=4):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(tasks)
    return frame, written(date_sketches(frame, F.col("day"), "user", "value"), "sketches")


def test_estimates_stay_within_their_bounds(spark):
    draw = random.Random(1)
    rows = [r for day, n in enumerate([10, 500, 6_000, 20_000]) for r in rows_of(draw, day, n, users=4_000)]
    frame, sketches = stored(spark, rows)
    checked = against_exact(sketches, frame, F.col("day"), "user", "value").collect()
    assert len(checked) == 4
    for r in checked:
        assert r["rows"] == [10, 500, 6_000, 20_000][r["date"]]
        assert r["different"] == len({u for d, u, _ in rows if d == r["date"]})
        assert r["different_within"] and r["median_within"]


def test_ranges_merge_without_reading_rows(spark):
    draw = random.Random(2)
    rows = [r for day in range(5) for r in rows_of(draw, day, 800, users=900)]
    _, sketches = stored(spark, rows)
    for first, last in ((0, 4), (1, 2), (3, 3)):
        exact = len({u for d, u, _ in rows if first <= d <= last})
        assert abs(different_between(sketches, first, last).first()["different"] - exact) <= 0.05 * exact + 1


def test_a_moved_distribution_fails_and_sampling_noise_does_not(spark):
    draw = random.Random(3)
    rows = rows_of(draw, 0, 3_000) + rows_of(draw, 1, 3_000) + rows_of(draw, 2, 3_000, centre=1.5)
    rows += rows_of(draw, 3, 3_000, centre=1.5, users=40) + rows_of(draw, 4, 200, centre=1.5, users=40)
    found = {r["date"]: r for r in drift(stored(spark, rows)[1]).collect()}
    assert [found[d]["success"] for d in range(5)] == [True, True, False, False, False]
    assert found[0]["rank_shift"] is None and found[1]["rank_shift"] < 0.1 and found[2]["rank_shift"] > 0.3
    assert found[3]["different_ratio"] > 5 and found[3]["rank_shift"] < 0.1
    assert found[4]["rows_ratio"] == 15


def test_dates_without_values(spark):
    rows = [(0, "a", None), (0, None, float("nan")), (1, "b", 2.0), (None, "c", 3.0), (2, None, None)]
    frame, sketches = stored(spark, rows, 2)
    found = {r["date"]: r for r in estimates(sketches).collect()}
    assert (found[0]["missing"], found[0]["median"], found[0]["different"]) == (2, None, 1)
    assert (found[None]["median"], found[1]["median"], found[2]["different"]) == (3.0, 2.0, 0)
    assert all(r["success"] for r in drift(sketches).collect())
    assert date_sketches(frame.limit(0), F.col("day"), "user", "value").count() == 0
