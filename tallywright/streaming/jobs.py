"""Streaming ingest into files, and windowed counts kept as versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.functions import to_event_time
from tallywright.functions.money import exact_sum
from tallywright.operators.bronze import COMPRESSION, overwrite_partitions
from tallywright.session import _path, fresh_folder, temporary_settings

MAX_FILES_PER_BATCH = 1_000
#: Versions of windows that may lie beside each other, and the two places of what was merged.
MAX_VERSIONS, BASES = 64, (-1, -2)
BY_DATE_AND_BATCH = ("processing_date", "ingestion_batch_id")


def event_stream(
    spark: SparkSession,
    folder: str,
    name: str,
    schema: T.StructType,
    at: str,
    max_files_per_trigger: int = MAX_FILES_PER_BATCH,
) -> DataFrame:
    """A file stream over one table of ``folder``, with ``at`` ready for a watermark.

    The brace pattern matches the table whether it is one file or a folder. A
    micro-batch takes at most ``max_files_per_trigger`` files, so a large backlog
    is worked off in steps that each leave a point to go on from.
    """
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(f"{folder.rstrip('/')}/{{{name}.parquet}}")
    return stream.withColumn(at, to_event_time(F.col(at)))


def kafka_stream(spark: SparkSession, options: dict[str, str], schema: T.StructType) -> DataFrame:
    """The same events as JSON messages of a Kafka topic; needs the Kafka connector."""
    return parse_messages(spark.readStream.format("kafka").options(**options).load(), schema)


def parse_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Events from messages, with ``topic``, ``partition`` and ``offset`` beside them.

    ``malformed`` holds the text of a message that is no JSON of this schema, whose
    columns are NULL then; it is NULL for all others.
    """
    wanted = T.StructType([*schema, T.StructField("malformed", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"}
    parsed = F.from_json(F.col("value").cast("string"), wanted, options)
    return messages.select(parsed.alias("event"), "topic", "partition", "offset").select(
        "event.*", "topic", "partition", "offset"
    )


def window_counts(
    events: DataFrame,
    at: str,
    keys: Sequence[str],
    value: str,
    window: str = "1 hour",
    watermark: str | None = None,
) -> DataFrame:
    """Rows and rounded sum per tumbling window and key; same plan for batch and stream."""
    timed = events.withColumn(at, to_event_time(F.col(at)))
    if watermark:
        timed = timed.withWatermark(at, watermark)
    return (
        timed.groupBy(F.window(at, window), *keys)
        .agg(F.count(F.lit(1)).alias("events"), F.round(exact_sum(value), 2).alias("total"))
        .select(F.col("window.start").alias("window_start"), *keys, "events", "total")
    )


def ingest(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str]) -> None:
    """Append all that is available to partitioned files, each row exactly once.

    The file sink commits whole batches to its log, so a restart after a lost
    executor or driver neither drops nor repeats rows.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("compression", COMPRESSION)
        .partitionBy(*partition_by)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_table(
    stream: DataFrame, identifier: str, checkpoint: str, batch_prefix: str = "stream"
) -> None:
    """Write all that is available into a transaction table, each row exactly once.

    The table is partitioned by :data:`BY_DATE_AND_BATCH`. Every micro-batch replaces the
    partitions that carry its own number, so one that is run again after a lost driver
    has no further effect, and other batches of the same date stay. Writes are rebalanced
    by partition, as in the batch ingest.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        named = batch.withColumn("ingestion_batch_id", F.lit(f"{batch_prefix}-{batch_id}"))
        overwrite_partitions(named, identifier, BY_DATE_AND_BATCH)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # Batches are written in a session of their own; this one may have listed older files.
    stream.sparkSession.catalog.refreshTable(identifier)


def _latest(versions: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    newest = [F.max_by(F.struct(*measures), "batch_id").alias("_newest")]
    return versions.groupBy("window_start", *keys).agg(*newest).select("window_start", *keys, "_newest.*")


def compact_windows(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> None:
    """Merge all versions of windows below ``path`` into one folder.

    The merged table goes into whichever of two places is free. Only when it is whole does the
    older one go, and then the versions that it holds; until then these hide both, so a
    driver may be lost at any point.
    """
    files, folder = _path(spark, path)

    def place(batch_id: int):
        return _path(spark, f"{path}/batch_id={batch_id}")[1]

    def whole(batch_id: int) -> bool:
        return files.exists(_path(spark, f"{path}/batch_id={batch_id}/_SUCCESS")[1])

    names = (status.getPath().getName() for status in files.listStatus(folder))
    versions = sorted(int(n.partition("=")[2]) for n in names if n.startswith("batch_id=") and "=-" not in n)
    free = next((b for b in BASES if not whole(b)), BASES[1])
    merged = _latest(_versions(spark, path, schema), keys, [c for c in schema.names if c not in ("window_start", *keys)])
    aside = fresh_folder(spark, "merged-windows")
    merged.select(*schema.names).write.parquet(aside)
    spark.read.schema(schema).parquet(aside).write.mode("overwrite").parquet(f"{path}/batch_id={free}")
    for older in (*(b for b in BASES if b != free), *versions):
        files.delete(place(older), True)


def _versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema, T.StructField("batch_id", T.LongType())])).parquet(path)


def run_windows(
    counted: DataFrame,
    keys: Sequence[str],
    path: str | None = None,
    checkpoint: str | None = None,
    state_partitions: int | None = None,
    max_versions: int = MAX_VERSIONS,
) -> DataFrame:
    """Run a windowed count to the end of its input; the latest count per window.

    Update mode emits only the windows a batch changed, open ones included, and
    keeps state only behind the watermark. Each batch replaces its own folder, so
    a repeated batch has no further effect; beyond ``max_versions`` they are merged
    into one. State has one store per shuffle partition, which adaptive execution
    does not merge; by default there are as many as the cluster has cores.
    """
    spark = counted.sparkSession
    stores = state_partitions or spark.sparkContext.defaultParallelism
    path = path or fresh_folder(spark, "windows")
    checkpoint = checkpoint or fresh_folder(spark, "windows-progress")
    files, folder = _path(spark, path)
    if not files.exists(folder):
        spark.createDataFrame([], counted.schema).write.parquet(f"{path}/batch_id={BASES[0]}")

    def write_version(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = (
        counted.writeStream.foreachBatch(write_version)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
    )
    with temporary_settings(spark, {"spark.sql.shuffle.partitions": str(stores)}):
        query = writer.start()
    query.awaitTermination()
    if len(files.listStatus(folder)) > max_versions + 1:
        compact_windows(spark, path, counted.schema, keys)
    measures = [c for c in counted.columns if c not in ("window_start", *keys)]
    return _latest(_versions(spark, path, counted.schema), keys, measures)
