"""Streams whose sender repeats itself: each event once, late ones too."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.operators.bronze import overwrite_partitions
from tallywright.session import temporary_settings
from tallywright.streaming.jobs import BY_DATE_AND_BATCH, ingest_table


def once(stream: DataFrame, keys: Sequence[str], at: str, watermark: str) -> DataFrame:
    """``stream`` without events that were met before, by ``keys``.

    Keys are remembered until the watermark, ``watermark`` behind the newest ``at``, has
    passed them, so state is bounded by the events of that time. An event that comes later
    than that cannot be told from a repeated one and is refused; :func:`sweep_late` brings in
    those that are missing.
    """
    return stream.withWatermark(at, watermark).dropDuplicatesWithinWatermark(list(keys))


def ingest_once(
    stream: DataFrame,
    keys: Sequence[str],
    at: str,
    watermark: str,
    to_rows: Callable[[DataFrame], DataFrame],
    identifier: str,
    checkpoint: str,
    batch_prefix: str = "stream",
    state_partitions: int | None = None,
) -> None:
    """Write all that is available into a transaction table, each event once.

    Repeats within a batch, between batches and after a restart are all met by the state
    that the checkpoint holds; a batch that is run again replaces itself. ``to_rows`` makes
    table rows of events. State has one store per shuffle partition, by default as many as
    the cluster has cores.
    """
    spark = stream.sparkSession
    stores = state_partitions or spark.sparkContext.defaultParallelism
    with temporary_settings(spark, {"spark.sql.shuffle.partitions": str(stores)}):
        ingest_table(to_rows(once(stream, keys, at, watermark)), identifier, checkpoint, batch_prefix)


def sweep_late(rows: DataFrame, identifier: str, keys: Sequence[str], batch_id: str) -> None:
    """Add to a transaction table those of ``rows`` whose key it does not hold.

    ``rows`` is what has been delivered, or the part of it that may have come late. They go
    into partitions of a batch of their own; run again, the sweep replaces what it wrote.
    """
    spark = rows.sparkSession
    names = {k: f"_held_{n}" for n, k in enumerate(keys)}
    held = spark.table(identifier).filter(F.col("ingestion_batch_id") != batch_id)
    held = held.select(*[F.col(k).alias(n) for k, n in names.items()])
    missing = rows.join(held, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()], "left_anti")
    named = missing.dropDuplicates(list(keys)).withColumn("ingestion_batch_id", F.lit(batch_id))
    overwrite_partitions(named, identifier, BY_DATE_AND_BATCH)
    spark.catalog.refreshTable(identifier)
