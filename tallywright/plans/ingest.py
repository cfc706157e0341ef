"""The ingest pipeline: derive, create, overwrite partitions, check, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallywright.operators import bronze
from tallywright.operators.reports import category_counts
from tallywright.schemas import TRANSACTIONS_BRONZE


def ingest_transactions(
    transactions: DataFrame,
    identifier: str,
    minimum_rows: int | None = None,
    provider: str = "parquet",
    location: str | None = None,
    namespace_location: str | None = None,
) -> DataFrame:
    """Write the input's dates into the table and return the table, checked.

    A second run with the same input replaces the same dates. The table must show at
    least ``minimum_rows``; by default as many as the write was seen to hand over.
    """
    spark = transactions.sparkSession
    namespace = identifier.rpartition(".")[0]
    if namespace:
        bronze.create_namespace(spark, namespace, namespace_location)
    bronze.create_table(
        spark, identifier, TRANSACTIONS_BRONZE, provider=provider, location=location
    )
    seen = Observation("ingest")
    observed = transactions.observe(seen, F.count(F.lit(1)).alias("rows"))
    bronze.overwrite_partitions(observed, identifier)
    needed = seen.get["rows"] if minimum_rows is None else minimum_rows
    return bronze.read_back(spark, identifier, needed)


def ingest_report(table: DataFrame) -> DataFrame:
    return category_counts(table, rows=20)
