"""Facts joined with the version of their key that was the newest at their time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.operators.skew import DEFAULT_POLICY, SkewPolicy, add_carry, lay_out

#: In the merged stream versions come before the facts of their instant.
VERSION, FACT = 0, 1


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    version_at: str,
    values: Sequence[str],
    tie_break: Sequence[str] = (),
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Every fact with ``values`` of the newest version of its ``key`` no later than it.

    Both sides are merged into one stream by key and time, in which the last version is
    carried on: one shuffle and one sort, where a join on the inequality would pair every
    fact with all earlier versions. Keys above the policy's limit are cut into chunks along
    the order, and each chunk is given the last version of the chunks before it.

    Versions of one instant are ordered by ``tie_break``, the last one counts; those without
    a key or a time never apply. Facts without a version, a key or a time have NULL values.
    """
    ties = [f"_tie_{n}" for n in range(len(tie_break))]
    kinds = [versions.schema[c].dataType for c in tie_break]
    moment = versions.schema[version_at].dataType
    held = versions.filter(F.col(key).isNotNull() & F.col(version_at).isNotNull()).select(
        F.col(key).alias("_key"),
        F.col(version_at).alias("_at"),
        F.lit(VERSION).alias("_turn"),
        *[F.col(c).alias(t) for c, t in zip(tie_break, ties, strict=True)],
        F.struct(*[F.col(c) for c in values]).alias("_version"),
        F.lit(None).cast(facts.schema).alias("_fact"),
    )
    asked = facts.select(
        F.col(key).alias("_key"),
        F.col(at).cast(moment).alias("_at"),
        F.lit(FACT).alias("_turn"),
        *[F.lit(None).cast(k).alias(t) for k, t in zip(kinds, ties, strict=True)],
        F.lit(None).cast(held.schema["_version"].dataType).alias("_version"),
        F.struct(*[F.col(c) for c in facts.columns]).alias("_fact"),
    )
    order = ("_at", "_turn", *ties)
    laid = lay_out(held.unionByName(asked), "_key", order, policy)
    so_far = (
        W.partitionBy("_key", "_chunk").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    rows = laid.rows.withColumn("_newest", F.last("_version", ignorenulls=True).over(so_far))
    if laid.split:
        # One row for each hot key and chunk; the newest of a chunk goes by the same order.
        newest = laid.hot.filter(F.col("_turn") == VERSION).groupBy("_key", "_chunk").agg(
            F.max_by("_version", F.struct("_at", *ties)).alias("_version")
        )
        chunks = laid.hot.select("_key", "_chunk").distinct().join(
            newest.select(
                F.col("_key").alias("_n_key"), F.col("_chunk").alias("_n_chunk"), "_version"
            ),
            F.col("_key").eqNullSafe(F.col("_n_key")) & (F.col("_chunk") == F.col("_n_chunk")),
            "left",
        )
        before = W.partitionBy("_key").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
        carry = chunks.select(
            "_key", "_chunk", F.last("_version", ignorenulls=True).over(before).alias("_carried")
        ).filter(F.col("_carried").isNotNull())
        rows = add_carry(rows, carry, "_key", ["_carried"], policy)
        rows = rows.withColumn("_newest", F.coalesce("_newest", "_carried"))
    # A fact without a time sorts first, ahead of every version.
    return rows.filter(F.col("_turn") == FACT).select(
        "_fact.*", *[F.col("_newest").getField(c).alias(c) for c in values]
    )
