from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallywright.operators import marts, reconcile
from tallywright.operators.quality import DataQualityError
from tallywright.plans.marts import build_gold


def test_bars_by_hand(spark):
    t = datetime
    ticks = spark.createDataFrame(
        [
            (2, "X", 5.0, t(2024, 1, 1, 9)),
            (1, "X", 7.0, t(2024, 1, 1, 9)),
            (3, "X", 1.0, t(2024, 1, 1, 12)),
            (4, "X", 3.0, t(2024, 1, 1, 16)),
            (5, "X", 9.0, t(2024, 1, 1, 16)),
            (6, "X", 4.0, t(2024, 1, 2, 0)),
        ],
        "id long, symbol string, price double, at timestamp",
    )
    got = {r["period"]: tuple(r)[2:] for r in marts.bars(ticks, "symbol", "price", "at", "id").collect()}
    assert got == {
        date(2024, 1, 1): (7.0, 9.0, 1.0, 9.0, 25.0, 5),
        date(2024, 1, 2): (4.0, 4.0, 4.0, 4.0, 4.0, 1),
    }
    monthly = marts.bars(ticks, "symbol", "price", "at", "id", grain="month").first()
    assert (monthly["period"], monthly["open"], monthly["close"]) == (date(2024, 1, 1), 7.0, 4.0)


@pytest.fixture(scope="module")
def prices(spark):
    rows = [("A", date(2024, m, 1), c) for m, c in enumerate((100.0, 110.0, 99.0, 0.0, 50.0), 1)]
    rows += [("B", date(2024, 1, 1), 10.0)]
    return spark.createDataFrame(rows, "sector string, period date, close double")


def test_returns_and_volatility(prices):
    out = marts.volatility(marts.period_returns(prices), periods=2).orderBy("sector", "period")
    rows = out.collect()
    returns = [None if r["period_return"] is None else round(r["period_return"], 6) for r in rows]
    assert returns == [None, 0.1, -0.1, -1.0, None, None]
    spread = [None if r["volatility"] is None else round(r["volatility"], 6) for r in rows]
    assert spread == [None, None, 0.141421, 0.636396, None, None]


def test_trend_of_a_straight_line(spark):
    rows = [("A", date(2023 + m // 12, m % 12 + 1, 1), 10.0 + 2.5 * m) for m in range(18)]
    line = spark.createDataFrame(rows, "sector string, period date, close double")
    fit = marts.trend_forecast(line).first()
    assert round(fit["slope"], 6) == 2.5 and fit["periods"] == 18
    assert fit["next_period"] == date(2024, 7, 1)
    assert round(fit["forecast"], 6) == 10.0 + 2.5 * 18


def test_trend_by_day(spark):
    rows = [("A", date(2024, 2, 20 + d), 3.0 + 0.5 * d) for d in range(10)]
    line = spark.createDataFrame(rows, "sector string, period date, close double")
    fit = marts.trend_forecast(line, "day").first()
    assert fit["next_period"] == date(2024, 3, 1)
    assert (round(fit["slope"], 9), round(fit["forecast"], 6)) == (0.5, 8.0)


def test_silver_tells_what_it_refused(spark):
    rows = spark.createDataFrame([(1, 5), (None, 5), (2, 0), (3, None)], "k int, n int")
    refused = marts.silver_refused(rows, ["k"], F.col("n") > 0)
    assert sorted(r["reason"] for r in refused.collect()) == ["invalid", "invalid", "key"]
    assert marts.silver_clean(rows, ["k"], "n", F.col("n") > 0).count() == 1


def test_silver_normalises_and_keeps_the_latest(spark):
    rows = spark.createDataFrame(
        [
            (1, " a ", "2024-01-01", 1.0),
            (1, "b", "2024-01-03", 2.0),
            (1, "c", None, 3.0),
            (2, "d", "2024-01-02", 1.0),
            (2, "d", "2024-01-02", 4.0),
            (3, "e", "2024-01-01", -1.0),
            (None, "f", "2024-01-01", 1.0),
        ],
        "id int, code string, day string, n double",
    )
    out = marts.silver_clean(
        rows, ["id"], "day", valid=rows["n"] > 0, codes=["code"], types={"day": "date"}
    )
    assert sorted(tuple(r) for r in out.collect()) == [
        (1, "B", date(2024, 1, 3), 2.0),
        (2, "D", date(2024, 1, 2), 4.0),
    ]
    assert out.columns == rows.columns


def test_as_of_includes_its_moment(spark):
    t = datetime
    versions = spark.createDataFrame(
        [(1, t(2024, 1, 1), "a"), (1, t(2024, 1, 5), "b"), (2, t(2024, 1, 6), "c")],
        "id int, at timestamp, v string",
    )

    def read(moment):
        return {r["id"]: r["v"] for r in marts.as_of(versions, "id", "at", moment).collect()}

    assert read("2024-01-04 00:00:00") == {1: "a"}
    assert read("2024-01-05 00:00:00") == {1: "b"}
    assert read("2024-02-01 00:00:00") == {1: "b", 2: "c"}


def orders(spark, *rows):
    schema = (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp, o_orderpriority string"
    )
    full = [(k, 1, "O", p, datetime(2024, m, 1), s) for k, p, m, s in rows]
    return spark.createDataFrame(full, schema)


def test_gold_is_written_by_year(spark, tmp_path):
    path = tmp_path / "gold"
    good = orders(spark, (1, 100.0, 1, "A"), (2, 150.0, 2, " a"), (2, 90.0, 1, "A"), (3, 0.0, 3, "A"))
    gold = build_gold(good, str(path))
    assert sorted((r["period"], r["sector"], r["close"], r["period_return"]) for r in gold.collect()) == [
        (date(2024, 1, 1), "A", 100.0, None),
        (date(2024, 2, 1), "A", 150.0, 0.5),
    ]
    assert len(list((path / "period_year=2024").glob("*.parquet"))) == 1


def test_failed_gate_halts_before_the_write(spark, tmp_path):
    path = tmp_path / "gold"
    build_gold(orders(spark, (1, 100.0, 1, "A")), str(path))
    kept = sorted(p.name for p in path.rglob("*.parquet"))
    with pytest.raises(DataQualityError, match=r"in_range\(o_totalprice\): 1 rows"):
        build_gold(orders(spark, (1, 100.0, 1, "A"), (2, -5.0, 2, "A")), str(path))
    with pytest.raises(DataQualityError, match=r"not_null\(o_orderpriority\)"):
        build_gold(orders(spark, (1, 100.0, 1, None)), str(path))
    assert sorted(p.name for p in path.rglob("*.parquet")) == kept


def test_reconcile_statuses(spark):
    schema = "k string, n int"
    batch = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("d", None), ("x", 1)], schema)
    stream = spark.createDataFrame([("a", 1), ("b", 9), (None, 3), ("d", None), ("y", 1)], schema)
    got = {r["k"]: r["status"] for r in reconcile.compare(batch, stream, ["k"], ["n"]).collect()}
    assert got == {
        "a": "equal",
        "b": "different",
        None: "equal",
        "d": "equal",
        "x": "only_batch",
        "y": "only_stream",
    }
    assert reconcile.differences(batch, stream, ["k"], ["n"]).count() == 3


def test_row_differences_count_copies(spark):
    schema = "k string, n int"
    batch = spark.createDataFrame([("a", 1)] * 5 + [("b", None)] + [("c", 1)], schema)
    stream = spark.createDataFrame([("a", 1)] * 2 + [("b", None)] + [("d", 1)] * 3, schema)
    got = {tuple(r) for r in reconcile.row_differences(batch, stream).collect()}
    assert got == {
        ("a", 1, "only_batch", 3),
        ("c", 1, "only_batch", 1),
        ("d", 1, "only_stream", 3),
    }
