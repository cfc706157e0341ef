"""From raw orders to the Gold table, with a gate before each step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.operators import bronze, marts, quality
from tallywright.operators.quality import Expectation
from tallywright.session import written

# One row a period and sector: a folder for each would hold one row.
GOLD_PARTITION = "period_year"


def raw_order_checks() -> list[Expectation]:
    return [quality.not_null("o_orderkey"), quality.in_range("o_totalprice", 0.0, 1e12)]


def silver_order_checks() -> list[Expectation]:
    return [quality.not_null("o_orderpriority"), quality.unique("o_orderkey")]


def gated(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """``df`` itself, once every expectation holds on it; otherwise an error."""
    quality.halt_on_failure(quality.check(df, expectations))
    return df


def build_gold(
    orders: DataFrame,
    path: str,
    grain: str = "month",
    periods: int = 3,
) -> DataFrame:
    """Returns and volatility by period and sector, written by year and read back.

    A failed gate raises before anything after it runs, so the files of an
    earlier run stay as they were. Silver is written, because its gate and the
    prices both read it and the dedupe should run once.
    """
    spark = orders.sparkSession
    cleaned = marts.silver_clean(
        gated(orders, raw_order_checks()),
        keys=["o_orderkey"],
        latest_by="o_orderdate",
        valid=F.col("o_totalprice") > 0,
        codes=["o_orderstatus", "o_orderpriority"],
    )
    silver = written(cleaned, "silver")
    prices = marts.sector_prices(
        gated(silver, silver_order_checks()), "o_orderpriority", "o_totalprice", "o_orderdate", grain
    )
    gold = marts.volatility(marts.period_returns(prices), periods)
    by_year = gold.withColumn(GOLD_PARTITION, F.year("period"))
    bronze.overwrite_partition_files(by_year, path, [GOLD_PARTITION])
    return spark.read.schema(by_year.schema).parquet(path).drop(GOLD_PARTITION)
