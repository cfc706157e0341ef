"""A cleaned table kept up to date by batches of changes."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Sequence
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.operators.bronze import COMPRESSION, spread_for_write
from tallywright.operators.digest import row_hashes
from tallywright.operators.marts import keep_latest
from tallywright.operators.quality import has_key
from tallywright.operators.skew import DEFAULT_POLICY, SkewPolicy
from tallywright.session import written

BUCKET, DELETED, BATCH = "_bucket", "_deleted", "_batch"
BUCKETS = 1024
#: Batches that may lie beside each other in a bucket before they are merged.
MAX_BATCHES = 16
#: Names, in a column's metadata, of its place among the keys and in the order of versions.
KEY_PLACE, ORDER_PLACE = "key_place", "order_place"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _folder(spark: SparkSession, path: str):
    """The Hadoop file system of a folder and its path there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _bucket_folders(spark: SparkSession, path: str) -> list[tuple[int, object]]:
    """The bucket of every folder with rows, and the folder; at most batches times buckets."""
    files, _ = _folder(spark, path)
    found = files.globStatus(_folder(spark, f"{path}/{BATCH}=*/{BUCKET}=*")[1])
    folders = [status.getPath() for status in found or []]
    return [(int(folder.getName().partition("=")[2]), folder) for folder in folders]


def _noted(batch: DataFrame, names: Sequence[str], note: str) -> DataFrame:
    for place, name in enumerate(names):
        batch = batch.withMetadata(name, {**batch.schema[name].metadata, note: place})
    return batch


def _named(schema: T.StructType, note: str) -> list[str]:
    return [f.name for f in sorted((f for f in schema if note in f.metadata), key=lambda f: f.metadata[note])]


def _newest(stored: DataFrame) -> DataFrame:
    """One version of each key, by the keys and the order that are noted in the files."""
    return keep_latest(stored, _named(stored.schema, KEY_PLACE), _named(stored.schema, ORDER_PLACE))


def _write_batch(rows: DataFrame, folder: str) -> None:
    spread = spread_for_write(rows.drop(BATCH), [BUCKET])
    writer = spread.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.option("compression", COMPRESSION).partitionBy(BUCKET).parquet(folder)


def apply_changes(
    path: str,
    changes: DataFrame,
    keys: Sequence[str],
    latest_by: Sequence[str],
    deleted: Column | None = None,
    buckets: int = BUCKETS,
    policy: SkewPolicy = DEFAULT_POLICY,
    max_batches: int = MAX_BATCHES,
) -> list[int]:
    """Bring the table at ``path`` up to a batch of ``changes``; returns the buckets it wrote to.

    The table is partitioned by a hash of the key. A batch's rows are laid beside what its
    buckets hold, which is neither read nor written again; the versions of a key meet when the
    table is read. Only buckets that a batch touches and that hold more than ``max_batches``
    batches are merged into one. Of a key's versions the last by ``latest_by`` stays, in
    whatever order batches come, and a batch that is applied again, which two 64-bit sums over
    all its columns and its number of rows tell, writes nothing. ``deleted`` marks versions
    that remove their key; they are kept as markers, so that an older version that comes late
    does not bring the key back.

    Changes without a whole key are left out, as in the full build. Ties on ``latest_by`` are
    broken by all other columns. Nothing is joined, so ``policy`` has nothing to limit.
    """
    spark = changes.sparkSession
    marker = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    others = [c for c in changes.columns if c not in keys and c not in latest_by]
    batch = changes.filter(has_key(keys)).withColumns({DELETED: marker, BUCKET: _bucket(keys, buckets)})
    batch = _noted(_noted(batch, keys, KEY_PLACE), [*latest_by, DELETED, *others], ORDER_PLACE)
    batch = written(batch, "changes")
    a, b = row_hashes([c for c in batch.columns if c != BUCKET])
    facts = batch.agg(F.count("*").alias("rows"), F.sum(a).alias("a"), F.sum(b).alias("b"), F.collect_set(BUCKET).alias("touched"))
    # At most ``buckets`` numbers.
    found = facts.first()
    touched = sorted(found["touched"])
    if not touched:
        return []
    name = md5(f"{found['rows']} {found['a']} {found['b']}".encode()).hexdigest()
    folder = f"{path}/{BATCH}=b{name}"
    files, done = _folder(spark, f"{folder}/_SUCCESS")
    if files.exists(done):
        return []
    _write_batch(batch, folder)
    _merge_crowded(spark, path, touched, max_batches)
    return touched


def _merge_crowded(spark: SparkSession, path: str, touched: Sequence[int], max_batches: int) -> None:
    """Merge the touched buckets that hold more than ``max_batches`` batches.

    What was merged goes only when the merged rows are there; a reader between the two meets
    versions twice, which changes nothing. The emptied folders of batches stay as their record.
    """
    folders = [(bucket, folder) for bucket, folder in _bucket_folders(spark, path) if bucket in set(touched)]
    crowded = [bucket for bucket, n in Counter(bucket for bucket, _ in folders).items() if n > max_batches]
    if not crowded:
        return
    stored = spark.read.parquet(path).filter(F.col(BUCKET).isin(crowded))
    _write_batch(_newest(stored), f"{path}/{BATCH}=m{uuid.uuid4().hex}")
    for bucket, folder in folders:
        if bucket in crowded:
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def read_current(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest version of each key, unless it is deleted; without batches there are none."""
    if not _bucket_folders(spark, path):
        return spark.createDataFrame([], schema)
    current = _newest(spark.read.parquet(path)).filter(~F.col(DELETED)).select(*schema.names)
    for field in schema:
        current = current.withMetadata(field.name, field.metadata)
    return current
