"""Session settings: time zone, adaptive execution, catalog and object store."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from math import ceil

from pyspark.sql import DataFrame, SparkSession

TARGET_PARTITION_BYTES = 200 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, minimum: int = 200) -> int:
    """Shuffle partitions that keep each one near 200 MB before AQE coalesces them."""
    return max(minimum, ceil(input_bytes / TARGET_PARTITION_BYTES))


@dataclass(frozen=True)
class CatalogConfig:
    """A v2 table catalog with its object store.

    Credentials are deliberately absent: they come from the cluster's own
    provider chain.
    """

    name: str
    implementation: str = "org.apache.iceberg.spark.SparkCatalog"
    extensions: str = "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions"
    catalog_impl: str | None = None
    uri: str | None = None
    ref: str | None = None
    auth_type: str | None = None
    warehouse: str | None = None
    io_impl: str | None = None
    endpoint: str | None = None
    path_style: bool = True
    cache_enabled: bool = False

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> CatalogConfig | None:
        """Read ``LAKE_*`` variables; None where no catalog is named."""
        env = os.environ if env is None else env
        name = env.get("LAKE_CATALOG")
        if not name:
            return None
        return cls(
            name=name,
            catalog_impl=env.get("LAKE_CATALOG_IMPL"),
            uri=env.get("LAKE_CATALOG_URI"),
            ref=env.get("LAKE_CATALOG_REF"),
            auth_type=env.get("LAKE_CATALOG_AUTH"),
            warehouse=env.get("LAKE_WAREHOUSE"),
            io_impl=env.get("LAKE_IO_IMPL"),
            endpoint=env.get("LAKE_S3_ENDPOINT"),
            path_style=env.get("LAKE_S3_PATH_STYLE", "true").lower() == "true",
            cache_enabled=env.get("LAKE_CATALOG_CACHE", "false").lower() == "true",
        )

    def settings(self) -> dict[str, str]:
        prefix = f"spark.sql.catalog.{self.name}"
        optional = {
            "catalog-impl": self.catalog_impl,
            "uri": self.uri,
            "ref": self.ref,
            "authentication.type": self.auth_type,
            "warehouse": self.warehouse,
            "io-impl": self.io_impl,
            "s3.endpoint": self.endpoint,
        }
        out = {"spark.sql.extensions": self.extensions, prefix: self.implementation}
        out.update({f"{prefix}.{key}": value for key, value in optional.items() if value})
        out[f"{prefix}.s3.path-style-access"] = str(self.path_style).lower()
        out[f"{prefix}.cache-enabled"] = str(self.cache_enabled).lower()
        return out


@dataclass(frozen=True)
class SessionConfig:
    """Settings every job starts from; ``extra`` wins over the defaults."""

    app_name: str = "tallywright"
    master: str | None = None
    shuffle_partitions: int = 200
    catalog: CatalogConfig | None = None
    extra: Mapping[str, str] = field(default_factory=dict)

    def settings(self) -> dict[str, str]:
        out = {
            "spark.sql.session.timeZone": "UTC",
            "spark.sql.shuffle.partitions": str(self.shuffle_partitions),
            "spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.coalescePartitions.enabled": "true",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
            "spark.sql.files.maxPartitionBytes": "256m",
            "spark.sql.sources.partitionOverwriteMode": "dynamic",
        }
        if self.catalog is not None:
            out.update(self.catalog.settings())
        out.update(self.extra)
        return out

    def build(self) -> SparkSession:
        builder = SparkSession.builder.appName(self.app_name)
        if self.master:
            builder = builder.master(self.master)
        for key, value in self.settings().items():
            builder = builder.config(key, value)
        return builder.getOrCreate()


@contextmanager
def temporary_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Session settings for one block; what was set before comes back after it."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def pin_time_zone(spark: SparkSession) -> SparkSession:
    """Hour-of-day rules read the wall clock, so every job runs in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, as ``spark.checkpoint.dir`` names it.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would lose data with the machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallywright-"))
    return context.getCheckpointDir()


_scopes: list[list[str]] = []


def _path(spark: SparkSession, folder: str):
    """The Hadoop file system of a folder and its path there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete, on leaving, every folder that :func:`fresh_folder` handed out inside.

    Frames that were built inside read these folders, so they must be used up, or their
    results written elsewhere, before the block ends. Outside of any block folders stay.
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for folder in made:
            files, path = _path(spark, folder)
            files.delete(path, True)


def fit_shuffle_partitions(spark: SparkSession, *folders: str) -> int:
    """Set the shuffle width from the size of the input files; returns it.

    Adaptive execution merges partitions that turn out small but never widens a shuffle,
    so the width has to follow the input.
    """
    total = 0
    for folder in folders:
        files, path = _path(spark, folder)
        total += files.getContentSummary(path).getLength()
    wide = shuffle_partitions_for(total)
    spark.conf.set("spark.sql.shuffle.partitions", str(wide))
    return wide


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call uses."""
    folder = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(folder)
    return folder


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as a table in the shared folder, and read back.

    Later uses read the files: nothing is recomputed when an executor is lost,
    and columns that were drawn per partition keep their values.
    """
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
