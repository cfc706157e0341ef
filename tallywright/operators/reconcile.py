"""Comparing a batch result with a streamed one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare(
    batch: DataFrame, stream: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Every key of either side with both sides' measures and a status.

    Each side has one row per key, so no key is heavy here.
    """
    b = batch.select(
        *[F.col(k).alias(f"b_{k}") for k in keys],
        *[F.col(m).alias(f"batch_{m}") for m in measures],
        F.lit(True).alias("_in_batch"),
    )
    s = stream.select(
        *[F.col(k).alias(f"s_{k}") for k in keys],
        *[F.col(m).alias(f"stream_{m}") for m in measures],
        F.lit(True).alias("_in_stream"),
    )
    on = reduce(and_, [F.col(f"b_{k}").eqNullSafe(F.col(f"s_{k}")) for k in keys])
    equal = reduce(
        and_, [F.col(f"batch_{m}").eqNullSafe(F.col(f"stream_{m}")) for m in measures]
    )
    status = (
        F.when(F.col("_in_stream").isNull(), "only_batch")
        .when(F.col("_in_batch").isNull(), "only_stream")
        .when(equal, "equal")
        .otherwise("different")
    )
    return b.join(s, on, "full").select(
        *[F.coalesce(f"b_{k}", f"s_{k}").alias(k) for k in keys],
        *[c for m in measures for c in (f"batch_{m}", f"stream_{m}")],
        status.alias("status"),
    )


def differences(
    batch: DataFrame, stream: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Only the keys on which the two sides disagree."""
    return compare(batch, stream, keys, measures).filter(F.col("status") != "equal")


def status_counts(compared: DataFrame) -> DataFrame:
    return compared.groupBy("status").agg(F.count(F.lit(1)).alias("keys"))


def row_differences(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other, and how many times more.

    Both directions of EXCEPT ALL in one aggregation: batch rows count up, stream
    rows down, and what does not cancel is left over. Copies combine before the
    shuffle and stay one row with a number.
    """
    both = batch.withColumn("_balance", F.lit(1)).unionByName(
        stream.select(*batch.columns).withColumn("_balance", F.lit(-1))
    )
    left_over = both.groupBy(*batch.columns).agg(F.sum("_balance").alias("_balance"))
    return left_over.filter(F.col("_balance") != 0).select(
        *batch.columns,
        F.when(F.col("_balance") > 0, "only_batch").otherwise("only_stream").alias("side"),
        F.abs("_balance").alias("copies"),
    )
