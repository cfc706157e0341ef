"""Spending profiles per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.operators.skew import (
    DEFAULT_POLICY,
    SkewPolicy,
    add_carry,
    join_per_key,
    lay_out,
)
from tallywright.session import written

ORDER = ("timestamp", "transaction_id")


def profile_table(valid: DataFrame) -> DataFrame:
    """One row per customer: rows, mean and sample deviation of the amount.

    The moments combine on the map side, so a customer with very many rows costs
    the shuffle one row per task.
    """
    return valid.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("cust_rows"),
        F.avg("amount").alias("cust_avg_amount"),
        F.stddev_samp("amount").alias("cust_std_amount"),
    )


def attach_profile(
    valid: DataFrame, profile: DataFrame, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Mean and deviation of a written profile table on every row."""
    return join_per_key(
        valid,
        profile,
        key="customer_id",
        rows="cust_rows",
        spread_by="transaction_id",
        values=["cust_avg_amount", "cust_std_amount"],
        policy=policy,
    )


def with_profile(valid: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Mean and deviation over all rows of the customer, on every row.

    Equal to ``avg(..) over (partition by customer_id)``, without gathering a
    customer's rows in one task.
    """
    return attach_profile(valid, written(profile_table(valid), "profile"), policy)


def with_zscore(profiled: DataFrame) -> DataFrame:
    """Distance from the customer's mean in deviations; NULL where there is no spread."""
    return profiled.withColumn(
        "amount_zscore",
        (F.col("amount") - F.col("cust_avg_amount"))
        / F.nullif(F.col("cust_std_amount"), F.lit(0.0)),
    )


def with_past_average(valid: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Mean of the customer's earlier rows only; NULL on the first one."""
    laid = lay_out(valid, "customer_id", ORDER, policy)
    before = (
        W.partitionBy("customer_id", "_chunk")
        .orderBy(*laid.order)
        .rowsBetween(W.unboundedPreceding, -1)
    )
    rows = laid.rows.withColumn("_sum", F.sum("amount").over(before)).withColumn(
        "_n", F.count("amount").over(before)
    )
    total, n = F.col("_sum"), F.col("_n")
    if laid.split:
        earlier = (
            W.partitionBy("customer_id")
            .orderBy("_chunk")
            .rowsBetween(W.unboundedPreceding, -1)
        )
        carry = (
            laid.hot.groupBy("customer_id", "_chunk")
            .agg(F.sum("amount").alias("_chunk_sum"), F.count("amount").alias("_chunk_n"))
            .withColumn("_sum_before", F.sum("_chunk_sum").over(earlier))
            .withColumn("_n_before", F.sum("_chunk_n").over(earlier))
            .filter(F.col("_n_before") > 0)
        )
        rows = add_carry(rows, carry, "customer_id", ["_sum_before", "_n_before"])
        zero = F.lit(0)
        total = F.when(
            total.isNotNull() | F.col("_sum_before").isNotNull(),
            F.coalesce(total, zero) + F.coalesce(F.col("_sum_before"), zero),
        )
        n = n + F.coalesce(F.col("_n_before"), zero)
    return rows.withColumn("past_avg_amount", total / F.nullif(n, F.lit(0))).select(
        *valid.columns, "past_avg_amount"
    )
