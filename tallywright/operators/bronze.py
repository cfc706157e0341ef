"""The partitioned ingest table: DDL, partition overwrite, read-back check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallywright.operators.quality import require_rows
from tallywright.schemas import TRANSACTIONS_BRONZE, column_ddl
from tallywright.session import temporary_settings

# Options of the table formats.
FORMAT_PROPERTIES = {
    "iceberg": {
        "format-version": "2",
        "write.parquet.compression-codec": "zstd",
        "write.distribution-mode": "hash",
    },
    "parquet": {},
}
COMPRESSION = "zstd"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def is_v2(spark: SparkSession, identifier: str) -> bool:
    """Whether the table belongs to a catalog other than the session's own.

    A name's first part is a catalog if one is configured by it; else the session's
    current catalog holds the table.
    """
    first, *rest = identifier.split(".")
    named = bool(rest) and spark.conf.get(f"spark.sql.catalog.{first}", None) is not None
    catalog = first if named or first == "spark_catalog" else spark.catalog.currentCatalog()
    return catalog != "spark_catalog"


def create_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{at}")


def create_table(
    spark: SparkSession,
    identifier: str,
    schema: T.StructType = TRANSACTIONS_BRONZE,
    partition_by: Sequence[str] = ("processing_date",),
    provider: str = "parquet",
    location: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Create the table unless it exists."""
    wanted = FORMAT_PROPERTIES.get(provider, {}) if properties is None else properties
    listed = ", ".join(f"'{k}'='{v}'" for k, v in wanted.items())
    clauses = [
        f"CREATE TABLE IF NOT EXISTS {identifier} ({column_ddl(schema)})",
        f"USING {provider}",
        f"OPTIONS ('compression'='{COMPRESSION}')" if provider == "parquet" else "",
        f"PARTITIONED BY ({', '.join(partition_by)})",
        f"LOCATION '{location}'" if location else "",
        f"TBLPROPERTIES ({listed})" if listed else "",
    ]
    spark.sql(" ".join(c for c in clauses if c))


def spread_for_write(
    df: DataFrame, partition_by: Sequence[str], tasks: int | None = None
) -> DataFrame:
    """Gather rows of one partition value, but not in one task.

    A plain ``repartition(column)`` sends all rows of a value to a single writer.
    Rebalancing hashes in the same way and lets adaptive execution cut large
    partitions and merge small ones, so a date that holds a third of the table is
    written by many tasks. Where many tiny partitions are written, the time goes
    into opening files and not into rows; ``tasks`` then fixes the writers.
    """
    if tasks:
        return df.repartition(tasks, *partition_by)
    return df.hint("rebalance", *partition_by)


def overwrite_partitions(
    df: DataFrame, identifier: str, partition_by: Sequence[str] = ("processing_date",)
) -> None:
    """Replace the partitions present in ``df``; others stay. Columns go by name."""
    spark = df.sparkSession
    if is_v2(spark, identifier):
        df.writeTo(identifier).option("check-ordering", "false").overwritePartitions()
        return
    by_name = df.select(*spark.table(identifier).columns)
    writer = spread_for_write(by_name, partition_by).write.mode("overwrite")
    # insertInto takes the mode from the session only, not from an option.
    with temporary_settings(spark, {OVERWRITE_MODE: "dynamic"}):
        writer.insertInto(identifier)


def overwrite_partition_files(
    df: DataFrame, path: str, partition_by: Sequence[str], tasks: int | None = None
) -> None:
    """The same on a folder of Parquet files without a catalog."""
    (
        spread_for_write(df, partition_by, tasks)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def read_back(spark: SparkSession, identifier: str, minimum_rows: int) -> DataFrame:
    """The table, after checking that at least ``minimum_rows`` are visible."""
    table = spark.table(identifier)
    require_rows(table, minimum_rows, identifier)
    return table
