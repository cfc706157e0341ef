"""Incremental tables, digests and forecasts."""

from __future__ import annotations

import random

import pytest
from conftest import as_rows
from pyspark.sql import functions as F

from tallywright.operators import marts
from tallywright.operators.changes import apply_changes, read_current
from tallywright.operators.cube import IncrementalCube
from tallywright.operators.digest import differing_slots, digest_differences, digest_tree, rows_in
from tallywright.operators.reconcile import row_differences
from tallywright.operators.skew import SkewPolicy

COLUMNS = "id long, part long, version long, value string, gone boolean"


def history(seed=1, rows=600):
    draw = random.Random(seed)
    return [
        (draw.randrange(60) if i % 90 else None, draw.randrange(3), i, f"v{i}", draw.random() < 0.2) for i in range(rows)
    ]


def full_build(frame):
    newest = marts.keep_latest(frame.filter("id IS NOT NULL AND part IS NOT NULL"), ["id", "part"], ["version", "gone", "value"])
    return newest.filter("NOT gone")


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(broadcast_rows=0)], ids=["broadcast", "joined"])
def test_batches_out_of_order_equal_a_full_build(spark, tmp_path, policy):
    rows = history()
    draw = random.Random(2)
    draw.shuffle(rows)
    path = str(tmp_path / "silver")
    for start in range(0, len(rows), 120):
        batch = spark.createDataFrame(rows[start : start + 120], COLUMNS)
        for _ in range(2):
            apply_changes(path, batch, ["id", "part"], ["version"], F.col("gone"), 8, policy)
    whole = spark.createDataFrame(rows, COLUMNS)
    assert as_rows(read_current(spark, path, whole.schema)) == as_rows(full_build(whole))


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    path = tmp_path / "silver"
    apply_changes(str(path), spark.createDataFrame(history(), COLUMNS), ["id", "part"], ["version"], F.col("gone"), 16)
    files = lambda: {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    before = files()
    one = spark.createDataFrame([(7, 1, 10_000, "new", False)], COLUMNS)
    touched = apply_changes(str(path), one, ["id", "part"], ["version"], F.col("gone"), 16)
    assert len(touched) == 1
    assert {file.parent.name for file, _ in before.items() ^ files().items()} == {f"_bucket={touched[0]}"}
    assert apply_changes(str(path), one.limit(0), ["id", "part"], ["version"]) == []


def test_a_late_version_does_not_bring_a_key_back(spark, tmp_path):
    path = str(tmp_path / "silver")
    steps = [(1, 0, 5, "a", False), (1, 0, 7, "b", True), (1, 0, 6, "c", False)]
    for step in steps:
        frame = spark.createDataFrame([step], COLUMNS)
        apply_changes(path, frame, ["id", "part"], ["version"], F.col("gone"), 4)
    assert read_current(spark, path, frame.schema).count() == 0


def test_batches_are_not_rewritten_until_buckets_are_crowded(spark, tmp_path):
    path = tmp_path / "silver"
    rows = history(4)
    files = lambda: {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    apply = lambda frame: apply_changes(str(path), frame, ["id", "part"], ["version"], F.col("gone"), 2, max_batches=3)
    batches = [spark.createDataFrame(rows[start::5], COLUMNS) for start in range(5)]
    for batch in batches[:3]:
        before = files()
        assert apply(batch) == [0, 1]
        after = files()
        assert before.items() < after.items()
        assert apply(batch) == [] and files() == after
    for batch in batches[3:]:
        apply(batch)
    assert len(list(path.glob("_batch=*/_bucket=0"))) == 2
    assert apply(batches[0]) == []
    whole = spark.createDataFrame(rows, COLUMNS)
    assert as_rows(read_current(spark, str(path), whole.schema)) == as_rows(full_build(whole))


def test_batches_that_differ_in_where_a_null_stands_are_both_applied(spark, tmp_path):
    path, columns = str(tmp_path / "silver"), "id long, version long, one string, two string"
    first = spark.createDataFrame([(1, 1, "x", None), (2, 1, "y", None)], columns)
    second = spark.createDataFrame([(1, 1, "x", None), (2, 1, None, "y")], columns)
    assert apply_changes(path, first, ["id"], ["version"], buckets=2)
    assert apply_changes(path, second, ["id"], ["version"], buckets=2)
    assert [tuple(r) for r in read_current(spark, path, first.schema).orderBy("id").collect()] == [(1, 1, "x", None), (2, 1, "y", None)]


def test_a_table_without_batches_is_empty(spark, tmp_path):
    frame = spark.createDataFrame([(None, 1)], "id long, version long")
    assert apply_changes(str(tmp_path / "silver"), frame, ["id"], ["version"]) == []
    assert read_current(spark, str(tmp_path / "silver"), frame.schema).count() == 0


# --- digests ----------------------------------------------------------------------------


def sides(spark, change):
    rows = [(i, f"t{i % 7}", None if i % 11 == 0 else i / 4) for i in [*range(-300, 2_000), *range(50_000, 50_040), *[5] * 30]]
    rows += [(None, "no key", 1.0)] * 3
    left = spark.createDataFrame(rows, "id long, name string, value double")
    right = spark.createDataFrame(change(list(rows)), left.schema).repartition(5)
    return left, right


CHANGES = {
    "nothing": lambda rows: rows,
    "one row": lambda rows: rows[:-5] + [(1_234, "x", None)] + rows[-5:],
    "null moved": lambda rows: [(i, None, v) if i == 77 else (i, n, v) for i, n, v in rows],
    "a copy less": lambda rows: rows[:-4] + rows[-3:],
    "no key": lambda rows: rows[:-1],
    "much": lambda rows: [(i, n, v if i is None or i % 64 else -1.0) for i, n, v in rows],
    "all": lambda rows: [],
    "far": lambda rows: rows + [(1 << 62, "far", 0.0), (-(1 << 62), "far", 0.0)],
}


@pytest.mark.parametrize("change", sorted(CHANGES))
def test_digests_find_what_the_rows_tell(spark, change):
    left, right = sides(spark, CHANGES[change])
    trees = [digest_tree(side, "id", 16) for side in (left, right)]
    found = digest_differences(left, right, *trees)
    assert as_rows(found) == as_rows(row_differences(left, right))


def test_equal_tables_read_no_rows_and_few_slots_reach_the_scan(spark, tmp_path):
    left, right = sides(spark, CHANGES["one row"])
    left.write.parquet(str(tmp_path / "left"))
    stored = spark.read.parquet(str(tmp_path / "left"))
    trees = [digest_tree(side, "id", 16) for side in (stored, right)]
    slots = differing_slots(*trees)
    assert {r["node"] for r in slots.collect()} == {1_234 // 16}
    picked = rows_in(stored, trees[0], slots)
    assert picked.count() == 16
    plan = picked._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(id,1232)" in plan and "LessThanOrEqual(id,1247)" in plan
    assert differing_slots(trees[0], trees[0]).count() == 0


def test_many_slots_are_joined(spark, monkeypatch):
    from tallywright.operators import digest

    monkeypatch.setattr(digest, "MAX_RANGES", 1)
    left, right = sides(spark, CHANGES["much"])
    trees = [digest_tree(side, "id", 16) for side in (left, right)]
    assert as_rows(digest_differences(left, right, *trees)) == as_rows(row_differences(left, right))


# --- forecasts --------------------------------------------------------------------------


def test_forecasts_look_at_earlier_periods_only(spark):
    rows = [(f"2024-{m:02d}-01", "a", 10.0 + 2 * m) for m in range(1, 7)] + [("2024-07-01", "a", 100.0), ("2024-01-01", "b", 5.0)]
    prices = spark.createDataFrame(rows, "period string, sector string, close double").withColumn("period", F.to_date("period"))
    walked = {(r["sector"], r["period"].month): r for r in marts.walk_forward(prices).collect()}
    assert walked["a", 1]["forecast"] is None and walked["a", 2]["forecast"] is None
    assert [round(walked["a", m]["error"], 9) for m in range(3, 7)] == [0.0] * 4
    assert round(walked["a", 7]["error"], 9) == 76.0
    errors = {r["sector"]: r for r in marts.forecast_errors(marts.walk_forward(prices)).collect()}
    assert errors.keys() == {"a"} and errors["a"]["forecasts"] == 5 and round(errors["a"]["mean_absolute"], 9) == 15.2


# --- increments -------------------------------------------------------------------------


def test_cube_follows_replaced_parts(spark, tmp_path):
    draw = random.Random(5)
    schema = "day string, kind string, channel string, amount double"
    make = lambda day: [(day, draw.choice("abc"), draw.choice(["x", None]), round(draw.uniform(-9, 9), 3)) for _ in range(40)]
    cube = IncrementalCube(str(tmp_path / "cube"), "day", ("kind", "channel"))
    held = {}

    def expected():
        rows = [r for part in held.values() for r in part]
        whole = spark.createDataFrame(rows, schema).groupBy("kind", "channel")
        return whole.agg(F.count(F.lit(1)).alias("records"), F.sum(F.col("amount").cast("decimal(38,6)")).cast("decimal(38,6)").alias("volume"))

    for batch, days in enumerate([["d1", "d2", "d3"], ["d2"], ["d3", "d4", None], ["d1"]]):
        changed = {day: make(day) for day in days}
        held |= changed
        frame = spark.createDataFrame([r for part in changed.values() for r in part], schema)
        for _ in range(2):  # the second run stands for one after a lost driver
            cube.replace(batch, frame, "amount")
        assert as_rows(cube.totals(spark, frame.schema)) == as_rows(expected())
    del held["d4"]
    gone = spark.createDataFrame([("d4",)], "day string")
    cube.replace(9, frame.limit(0), "amount", gone)
    assert as_rows(cube.totals(spark, frame.schema)) == as_rows(expected())
    held["d4"] = make("d4")
    change = cube.replace(10, spark.createDataFrame(held["d4"], schema), "amount")
    assert as_rows(cube.totals(spark, frame.schema)) == as_rows(expected())
    assert change.agg(F.sum("records")).first()[0] == 40
