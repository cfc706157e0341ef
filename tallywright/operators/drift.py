"""Expectations on change: sketches stored for each date and compared between dates.

A date's rows are read once; what is kept is a few kilobytes for each measured column, from
which counts of different values and quantiles of any range of dates follow by merging.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Sizes of the sketches, and what they promise: relative error of a count (three deviations), error of a rank.
HLL_BITS, KLL_SIZE = 12, 400
COUNT_ERROR, RANK_ERROR = 0.05, 0.02
PROBES = (0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95)
STEPS = 100


def date_sketches(rows: DataFrame, date: Column, different: str, value: str) -> DataFrame:
    """``(date, rows, missing, different, quantiles)``: one row a date, to be stored.

    Sketches combine where the rows are, so a date that holds a third of them is no bigger than
    others when it moves. Missing and NaN values are counted and are no part of the quantiles.
    """
    number = F.col(value).cast("double")
    held = F.when(~F.isnan(number), number)
    return rows.groupBy(date.alias("date")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(held.isNull()).alias("missing"),
        F.hll_sketch_agg(different, F.lit(HLL_BITS)).alias("different"),
        F.kll_sketch_agg_double(held, F.lit(KLL_SIZE)).alias("quantiles"),
    )


def estimates(sketches: DataFrame) -> DataFrame:
    """``(date, rows, missing, different, median)`` of stored sketches."""
    return sketches.select(
        "date",
        "rows",
        "missing",
        F.hll_sketch_estimate("different").alias("different"),
        F.when(F.col("rows") > F.col("missing"), F.kll_sketch_get_quantile_double("quantiles", F.lit(0.5))).alias("median"),
    )


def different_between(sketches: DataFrame, first, last) -> DataFrame:
    """About how many different values the dates of a range have together, from their sketches."""
    kept = sketches.filter(F.col("date").between(F.lit(first), F.lit(last)))
    return kept.agg(F.hll_sketch_estimate(F.hll_union_agg("different")).alias("different"))


def _grid(sketch: str) -> Column:
    """Quantiles in even steps: the ranks of any value to within a step."""
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)]))


def _shift(mine: str, other: str, probes: Sequence[float]) -> Column:
    """How far quantiles of one grid lie off in the ranks of another: 0 for equal distributions.

    A value that many rows share covers a range of ranks; what counts is the way to that range.
    """
    grid = F.col(other)

    def away(p: float) -> Column:
        value = F.get(mine, F.lit(round(p * STEPS)))
        below = F.size(F.filter(grid, lambda g: g < value)) / F.lit(STEPS + 1)
        upto = F.size(F.filter(grid, lambda g: g <= value)) / F.lit(STEPS + 1)
        return F.greatest(below - p, p - upto, F.lit(0.0))

    moved = [away(p) for p in probes]
    return F.greatest(*moved)


def drift(
    sketches: DataFrame,
    rank_limit: float = 0.2,
    count_ratio: float = 2.0,
    rows_ratio: float = 4.0,
    probes: Sequence[float] = PROBES,
) -> DataFrame:
    """Each date against the one before: how far its distribution, its different values and its rows moved.

    ``success`` fails where quantiles moved by more than ``rank_limit`` in rank, or counts by
    more than their ratio either way. The first date, and one next to a date without
    values, has nothing to be compared with and succeeds. One row a date meets in a window.
    """
    order = W.orderBy("date")
    filled = F.col("rows") > F.col("missing")
    beside = sketches.withColumns(
        {
            "_grid": F.when(filled, _grid("quantiles")),
            "_grid_before": F.lag(F.when(filled, _grid("quantiles"))).over(order),
            "_different": F.lag(F.hll_sketch_estimate("different")).over(order),
            "_rows": F.lag("rows").over(order),
        }
    )
    both = F.col("_grid").isNotNull() & F.col("_grid_before").isNotNull()
    shift = F.when(both, _shift("_grid", "_grid_before", probes))
    ratio = lambda a, b: F.greatest(a, b) / F.greatest(F.least(a, b), F.lit(1))
    rows = beside.select(
        "date",
        shift.alias("rank_shift"),
        ratio(F.hll_sketch_estimate("different"), F.col("_different")).alias("different_ratio"),
        ratio(F.col("rows"), F.col("_rows")).alias("rows_ratio"),
    )
    within = (
        (F.coalesce("rank_shift", F.lit(0.0)) <= rank_limit)
        & (F.coalesce("different_ratio", F.lit(1.0)) <= count_ratio)
        & (F.coalesce("rows_ratio", F.lit(1.0)) <= rows_ratio)
    )
    return rows.withColumn("success", within)


def against_exact(sketches: DataFrame, rows: DataFrame, date: Column, different: str, value: str) -> DataFrame:
    """``(date, rows, different, different_within, median_within)``: exact counts beside the estimates.

    ``median_within`` tells whether the estimated median has about half of the values on either side.
    """
    found = estimates(sketches).select(F.col("date").alias("_date"), F.col("different").alias("_different"), F.col("median").alias("_median"))
    timed = rows.withColumn("_on", date).join(F.broadcast(found), F.col("_on").eqNullSafe(F.col("_date")))
    number = F.col(value).cast("double")
    held = number.isNotNull() & ~F.isnan(number)
    exact = timed.groupBy(F.col("_on").alias("date")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(different).alias("different"),
        F.first("_different").alias("_estimate"),
        F.count_if(held & (number < F.col("_median"))).alias("_below"),
        F.count_if(held & (number <= F.col("_median"))).alias("_upto"),
        F.count_if(held).alias("_held"),
    )
    near = F.abs(F.col("_estimate") - F.col("different")) <= F.col("different") * COUNT_ERROR + 1
    slack = F.col("_held") * RANK_ERROR + 1
    middle = (F.col("_below") <= F.col("_held") / 2 + slack) & (F.col("_upto") >= F.col("_held") / 2 - slack)
    return exact.select("date", "rows", "different", near.alias("different_within"), middle.alias("median_within"))
