"""Rows of a customer in the trailing window, counted as they arrive."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallywright.functions import to_event_time
from tallywright.session import fresh_folder, temporary_settings

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class TrailingCounts(StatefulProcessor):
    """Keeps the instants and ids of a customer's rows for as long as frames may reach them.

    A row's count takes in rows of ``window`` before it and of its own instant. A row that
    arrives out of order raises the counts of rows after it, which come out again.
    """

    def __init__(self, window_micros: int, id_kind: str):
        self.window = window_micros
        self.id_kind = id_kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", f"micros long, id {self.id_kind}")

    def _held(self) -> list[tuple]:
        return list(self.rows.get()) if self.rows.exists() else []

    def _keep(self, held: list[tuple], watermark_ms: int) -> None:
        """Rows that no frame of a row to come can reach go; a timer looks after the rest."""
        reach = watermark_ms * 1_000 - self.window
        kept = [r for r in held if r[0] >= reach]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
        if not kept:
            self.rows.clear()
            return
        self.rows.put(kept)
        self.handle.registerTimer((kept[-1][0] + self.window) // 1_000 + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        fresh = [pair for part in rows for pair in zip(part["micros"].tolist(), part["id"].tolist(), strict=True)]
        known = self._held()
        held = sorted(known + fresh)
        at = np.array([m for m, _ in held], dtype=np.int64)
        counts = np.searchsorted(at, at, "right") - np.searchsorted(at, at - self.window, "left")
        # New rows, and rows that a new one lies in the frame of.
        arrived = np.sort(np.array([m for m, _ in fresh], dtype=np.int64))
        moved = np.searchsorted(arrived, at, "right") > np.searchsorted(arrived, at - self.window, "left")
        self._keep(held, timerValues.getCurrentWatermarkInMs())
        out = [(held[i][1], int(counts[i])) for i in np.flatnonzero(moved)]
        yield pd.DataFrame({"key": [key[0]] * len(out), "id": [i for i, _ in out], "rolling_count": [n for _, n in out]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self._keep(self._held(), timerValues.getCurrentWatermarkInMs())
        return iter([])

    def close(self) -> None:
        pass


def trailing_counts(
    stream: DataFrame, key: str, at: str, row_id: str, window: str, watermark: str
) -> DataFrame:
    """``(key, row_id, rolling_count)``: a version of each row's count whenever it grows.

    Rows more than ``watermark`` behind the newest are refused, as are rows without a key or
    a time, which have no place in a stream's order. The last version of a row is its largest.
    """
    spark = stream.sparkSession
    micros = spark.range(1).select(F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {window}"))).first()[0]
    kinds = {c: stream.schema[c].dataType.simpleString() for c in (key, row_id)}
    timed = stream.withColumn(at, to_event_time(F.col(at))).withWatermark(at, watermark)
    timed = timed.filter(F.col(key).isNotNull() & F.col(at).isNotNull())
    # Workers rename columns that begin with an underscore.
    keyed = timed.select(F.col(key).alias("key"), F.col(row_id).alias("id"), F.unix_micros(at).alias("micros"), F.col(at).alias("at"))
    counted = keyed.groupBy("key").transformWithStateInPandas(
        TrailingCounts(micros, kinds[row_id]),
        f"key {kinds[key]}, id {kinds[row_id]}, rolling_count long",
        "Update",
        "EventTime",
    )
    return counted.withColumnsRenamed({"key": key, "id": row_id})


def run_velocity(
    counted: DataFrame,
    key: str,
    row_id: str,
    limit: int,
    path: str | None = None,
    checkpoint: str | None = None,
    state_partitions: int | None = None,
) -> DataFrame:
    """Run :func:`trailing_counts` to the end of its input; each row's count and flag.

    Every batch replaces its own folder, so a repeated one has no further effect.
    """
    spark = counted.sparkSession
    stores = state_partitions or spark.sparkContext.defaultParallelism
    path = path or fresh_folder(spark, "velocity")
    checkpoint = checkpoint or fresh_folder(spark, "velocity-progress")
    spark.createDataFrame([], counted.schema).write.mode("overwrite").parquet(f"{path}/batch_id=-1")

    def write_version(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = (
        counted.writeStream.foreachBatch(write_version)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
    )
    settings = {"spark.sql.shuffle.partitions": str(stores), "spark.sql.streaming.stateStore.providerClass": ROCKS}
    with temporary_settings(spark, settings):
        query = writer.start()
    query.awaitTermination()
    versions = spark.read.schema(counted.schema).parquet(path)
    newest = versions.groupBy(key, row_id).agg(F.max("rolling_count").alias("rolling_count"))
    return newest.withColumn("is_high_velocity", F.col("rolling_count") >= limit)
