"""First-order recurrences along a key's order, as a scan of pairs.

``y[t] = m[t] * y[t-1] + a[t]`` is a chain of maps ``y -> m * y + a``; two that follow each
other are one such map again. So prefixes are built by doubling: after ``k`` rounds a row
holds the map of the last ``2 ** k`` rows. Rounds are run in blocks, and the blocks' maps are
scanned in the same way, so nothing depends on a loop over rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.operators.skew import DEFAULT_POLICY, SkewPolicy, lay_out, same_key
from tallywright.session import written

#: Rows of a block, as a power of two.
BLOCK_BITS = 8


def _scanned(rows: DataFrame, key: str, order: Sequence[str], policy: SkewPolicy, block_bits: int) -> DataFrame:
    """``rows`` with ``_m`` and ``_a`` of each row's whole prefix in place of its own."""
    laid = lay_out(rows, key, order, policy)
    placed = laid.rows.withColumn("_nth", F.row_number().over(W.partitionBy(key, "_chunk").orderBy(*laid.order)) - 1)
    placed = placed.withColumn("_block", F.shiftright("_nth", block_bits))
    block = W.partitionBy(key, "_chunk", "_block").orderBy("_nth")
    for step in range(block_bits):
        before_m, before_a = (F.lag(c, 1 << step).over(block) for c in ("_m", "_a"))
        placed = placed.withColumns({"_before_m": before_m, "_before_a": before_a})
        placed = placed.withColumns(
            {
                "_a": F.when(F.col("_before_a").isNull(), F.col("_a")).otherwise(F.col("_m") * F.col("_before_a") + F.col("_a")),
                "_m": F.coalesce(F.col("_m") * F.col("_before_m"), F.col("_m")),
            }
        )
    placed = written(placed.drop("_before_m", "_before_a"), "scan")
    ends = placed.groupBy(key, "_chunk", "_block").agg(F.max_by("_m", "_nth").alias("_m"), F.max_by("_a", "_nth").alias("_a"))
    if ends.filter((F.col("_block") > 0) | (F.col("_chunk") > 1)).isEmpty():
        return placed.drop("_nth", "_block", "_chunk")
    # A 2 ** block_bits-th of the rows; where a key has many blocks, they are cut into chunks again.
    ends = ends.withColumnsRenamed({"_chunk": "_of_chunk", "_block": "_of_block"})
    whole = written(_scanned(ends, key, ("_of_chunk", "_of_block"), policy, block_bits), "scan-blocks")
    ahead = W.partitionBy(key).orderBy("_of_chunk", "_of_block")
    before = whole.select(
        F.col(key).alias("_b_key"),
        F.col("_of_chunk").alias("_b_chunk"),
        F.col("_of_block").alias("_b_block"),
        F.lag("_m").over(ahead).alias("_b_m"),
        F.lag("_a").over(ahead).alias("_b_a"),
    ).filter(F.col("_b_m").isNotNull())
    here = (
        same_key(F.col(key), F.col("_b_key"))
        & (F.col("_chunk") == F.col("_b_chunk"))
        & (F.col("_block") == F.col("_b_block"))
    )
    joined = placed.join(before, here, "left")
    return joined.withColumns(
        {
            "_a": F.when(F.col("_b_a").isNull(), F.col("_a")).otherwise(F.col("_m") * F.col("_b_a") + F.col("_a")),
            "_m": F.coalesce(F.col("_m") * F.col("_b_m"), F.col("_m")),
        }
    ).drop("_b_key", "_b_chunk", "_b_block", "_b_m", "_b_a", "_nth", "_block", "_chunk")


def recurrence(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    multiplier: Column,
    addend: Column,
    name: str,
    policy: SkewPolicy = DEFAULT_POLICY,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """``rows`` with ``name``: ``multiplier * previous + addend``, 0 before a key's first row.

    A row whose multiplier or addend is NULL passes the previous value on. ``order`` must tell
    a key's rows apart. Keys above the policy's limit are cut into chunks. Of a key's rows
    one in ``2 ** block_bits`` meets in an ordered window.
    """
    whole = multiplier.isNotNull() & addend.isNotNull()
    own = rows.withColumns(
        {
            "_m": F.when(whole, multiplier.cast("double")).otherwise(F.lit(1.0)),
            "_a": F.when(whole, addend.cast("double")).otherwise(F.lit(0.0)),
        }
    )
    return _scanned(own, key, order, policy, block_bits).withColumn(name, F.col("_a")).select(*rows.columns, name)


def weighted_volatility(returns: DataFrame, decay: float = 0.94, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Root of the exponentially weighted mean of squared returns, by ``sector``.

    A sector starts with its first return; until then the result is NULL, and a period
    without a return keeps what was before it.
    """
    squared = F.col("period_return") * F.col("period_return")
    first = returns.filter(F.col("period_return").isNotNull()).groupBy("sector").agg(F.min("period").alias("_start"))
    first = first.withColumnRenamed("sector", "_f_sector")
    timed = returns.join(first, same_key(F.col("sector"), F.col("_f_sector")), "left").drop("_f_sector")
    starts = F.col("period") == F.col("_start")
    out = recurrence(
        timed,
        "sector",
        ["period"],
        F.when(starts, F.lit(0.0)).when(squared.isNotNull(), F.lit(decay)),
        F.when(starts, squared).otherwise(F.lit(1 - decay) * squared),
        "_variance",
        policy,
    )
    known = F.col("period") >= F.col("_start")
    return out.withColumn("ewma_volatility", F.when(known, F.sqrt("_variance"))).drop("_variance", "_start")
