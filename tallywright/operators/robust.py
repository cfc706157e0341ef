"""Exact medians by key, and outliers measured against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.operators.skew import (
    DEFAULT_POLICY,
    SkewPolicy,
    hottest,
    join_per_key,
    measured,
    same_key,
)
from tallywright.session import written

#: Bins of a refinement round, and rows of a bin that are few enough to be looked at as they are.
BINS, FEW = 1024, 4096
#: Makes the median deviation of a normal sample its standard deviation.
NORMAL = 1.4826


def _finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def _cold(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.percentile("_value", F.lit(0.5)).alias("_median"))


def _hot(rows: DataFrame, key: str, counts: DataFrame, policy: SkewPolicy) -> DataFrame:
    """The median of each of the few keys in ``counts`` by narrowing the range that holds it.

    A round counts the rows of a key's range in bins, which combine where the rows are, and
    goes on with the bin that holds the middle, between the least and the greatest value
    in it. The first round is by magnitude, so that a single far value does not hold it up.
    It ends when the bin holds one value or few rows.
    """
    state = counts.select(
        F.col(key).alias("_s_key"),
        F.floor((F.col("_rows") - 1) / 2).alias("_rank"),
        F.col("_rows").alias("_all"),
        F.lit(None).cast("double").alias("_low"),
        F.lit(None).cast("double").alias("_high"),
        F.lit(0).cast("long").alias("_below"),
        F.col("_rows").alias("_held"),
    )
    state = written(state, "median-state")
    on = same_key(F.col(key), F.col("_s_key"))
    by_size = True
    while True:
        inside = rows.join(measured(state, "median-state", policy), on).filter(
            F.col("_low").isNull() | F.col("_value").between(F.col("_low"), F.col("_high"))
        )
        if by_size:
            # asinh grows with the value and like its logarithm far from zero.
            place = F.floor(F.asinh("_value") * 16)
        else:
            width = F.col("_high") / BINS - F.col("_low") / BINS
            place = F.least(F.lit(BINS - 1), F.floor((F.col("_value") - F.col("_low")) / width))
            place = F.when(width > 0, place).otherwise(F.lit(0))
        bins = inside.groupBy("_s_key", place.cast("long").alias("_bin")).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_value").alias("_least"), F.max("_value").alias("_most")
        )
        # A few thousand bins for each hot key.
        bins = bins.groupBy("_s_key").agg(F.array_sort(F.collect_list(F.struct("_bin", "_n", "_least", "_most"))).alias("_bins"))
        state = written(_narrowed(state, bins), "median-state")
        by_size = False
        if state.filter((F.col("_low") < F.col("_high")) & (F.col("_held") > FEW)).isEmpty():
            break
    lower = _picked(rows, key, state, policy)
    # With an even number of rows the other middle is the same value again or the next greater one.
    facts = rows.join(measured(lower, "median-lower", policy), on)
    beyond = facts.groupBy("_s_key").agg(
        F.count_if(F.col("_value") <= F.col("_lower")).alias("_upto"),
        F.min(F.when(F.col("_value") > F.col("_lower"), F.col("_value"))).alias("_next"),
        F.first("_lower").alias("_lower"),
        F.first("_all").alias("_all"),
    )
    upper = F.when((F.col("_all") % 2 == 1) | (F.col("_upto") > F.col("_all") / 2), F.col("_lower")).otherwise(F.col("_next"))
    return beyond.select(F.col("_s_key").alias(key), ((F.col("_lower") + upper) / 2).alias("_median"))


def _narrowed(state: DataFrame, bins: DataFrame) -> DataFrame:
    """Each key's bin that holds its rank, and how many rows lie below it."""
    start = F.struct(F.col("_below").alias("seen"), F.lit(None).cast("struct<_bin:bigint,_n:bigint,_least:double,_most:double>").alias("bin"))

    def step(found: Column, bin_: Column) -> Column:
        reached = found["bin"].isNotNull()
        passed = found["seen"] + bin_["_n"]
        return (
            F.when(reached, found)
            .when(passed > F.col("_rank"), F.struct(found["seen"].alias("seen"), bin_.alias("bin")))
            .otherwise(F.struct(passed.alias("seen"), found["bin"].alias("bin")))
        )

    joined = state.join(bins.withColumnRenamed("_s_key", "_b_key"), same_key(F.col("_s_key"), F.col("_b_key")))
    joined = joined.withColumn("_found", F.aggregate("_bins", start, step))
    return joined.select(
        "_s_key",
        "_rank",
        "_all",
        F.col("_found.bin._least").alias("_low"),
        F.col("_found.bin._most").alias("_high"),
        F.col("_found.seen").alias("_below"),
        F.col("_found.bin._n").alias("_held"),
    )


def _picked(rows: DataFrame, key: str, state: DataFrame, policy: SkewPolicy) -> DataFrame:
    """The value at each key's rank, from a bin of one value or of few rows."""
    inside = rows.join(measured(state, "median-state", policy), same_key(F.col(key), F.col("_s_key"))).filter(
        (F.col("_low") < F.col("_high")) & F.col("_value").between(F.col("_low"), F.col("_high"))
    )
    few = inside.groupBy("_s_key").agg(F.array_sort(F.collect_list("_value")).alias("_values"))
    joined = state.join(few.withColumnRenamed("_s_key", "_v_key"), same_key(F.col("_s_key"), F.col("_v_key")), "left")
    at = (F.col("_rank") - F.col("_below") + 1).cast("int")
    lower = F.when(F.col("_values").isNull(), F.col("_low")).otherwise(F.get("_values", at - 1))
    return joined.select("_s_key", "_all", lower.alias("_lower"))


def exact_median(rows: DataFrame, key: str, value: str | Column, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """``(key, _rows, _median)`` over the finite values of each key.

    Keys within the policy's limit are counted by value in one aggregate. The rows of a key
    above it are never sorted nor sent to one task. The mean of both middles counts where
    rows are even. NULL, NaN and infinities are left out; NULL keys are one key.
    """
    column = F.col(value) if isinstance(value, str) else value
    held = rows.select(key, column.cast("double").alias("_value")).filter(_finite(F.col("_value")))
    counts = written(held.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")), "median-rows")
    hot = hottest(counts, "_rows", policy)
    if hot.isEmpty():
        medians = _cold(held, key)
    else:
        names = measured(hot.select(F.col(key).alias("_hot_key")), "hot-keys", policy)
        is_hot = same_key(F.col(key), F.col("_hot_key"))
        cold = _cold(held.join(names, is_hot, "left_anti"), key)
        medians = cold.unionByName(_hot(held.join(names, is_hot, "left_semi"), key, hot, policy))
    medians = medians.withColumnRenamed(key, "_m_key")
    joined = counts.join(medians, same_key(F.col(key), F.col("_m_key"))).drop("_m_key")
    return written(joined, "medians")


def with_robust_score(
    df: DataFrame,
    key: str = "customer_id",
    value: str = "amount",
    spread_by: str = "transaction_id",
    limit: float = 3.5,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Median and median deviation of the key beside each row, and whether the row is far out.

    ``robust_score`` is the distance from the median in normal standard deviations, NULL where
    the deviation is 0; ``is_robust_outlier`` tells whether it is beyond ``limit`` either way.
    """
    medians = exact_median(df, key, value, policy).withColumnRenamed("_median", "median")
    centred = join_per_key(df, medians, key, "_rows", spread_by, ["median"], policy)
    distance = F.abs(F.col(value).cast("double") - F.col("median"))
    spreads = exact_median(centred, key, distance, policy).withColumnRenamed("_median", "deviation")
    out = join_per_key(centred, spreads, key, "_rows", spread_by, ["deviation"], policy)
    score = (F.col(value) - F.col("median")) / F.nullif(F.lit(NORMAL) * F.col("deviation"), F.lit(0.0))
    return out.withColumn("robust_score", score).withColumn(
        "is_robust_outlier", F.coalesce(F.abs("robust_score") > limit, F.lit(False))
    )
