"""Streams over several files: equal to batch, restartable, late rows visible."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.operators import bronze, reconcile
from tallywright.operators.bursts import burst_windows, bursts
from tallywright.schemas import TRANSACTIONS_BRONZE
from tallywright.sources import transactions_from_events
from tallywright.streaming import event_stream, ingest, ingest_table, run_windows, window_counts
from tallywright.streaming.delivery import ingest_once, once, sweep_late
from tallywright.streaming.jobs import BY_DATE_AND_BATCH, parse_messages

SCHEMA = "event_id long, ts timestamp_ntz, event_type string, value double"
START = datetime(2024, 1, 1)


def events(spark, first, last):
    rows = [
        (i, START + timedelta(minutes=7 * i), "click" if i % 3 else "view", float(i))
        for i in range(first, last)
    ]
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


@pytest.fixture
def folder(tmp_path):
    return tmp_path / "in"


def stream_of(spark, folder, files=1):
    schema = events(spark, 0, 0).schema
    return event_stream(spark, str(folder), "events", schema, "ts", max_files_per_trigger=files)


def windows(df, watermark=None):
    return window_counts(df, "ts", ["event_type"], "value", watermark=watermark)


def settled(spark, folder, state):
    counted = windows(stream_of(spark, folder), watermark="1 day")
    return run_windows(counted, ["event_type"], f"{state}/out", f"{state}/progress")


def test_windows_over_many_batches_equal_batch(spark, folder, tmp_path):
    path = str(folder / "events.parquet")
    for first in range(0, 120, 40):
        events(spark, first, first + 40).write.mode("append").parquet(path)
    streamed = settled(spark, folder, tmp_path)
    batch = windows(spark.read.parquet(path))
    assert reconcile.differences(batch, streamed, ["window_start", "event_type"], ["events", "total"]).count() == 0
    assert streamed.agg(F.sum("events")).first()[0] == 120
    assert len(list((tmp_path / "out").glob("batch_id=*"))) > 3

    # More rows arrive, some of them in a window that is already counted.
    events(spark, 120, 150).write.mode("append").parquet(path)
    streamed = settled(spark, folder, tmp_path)
    batch = windows(spark.read.parquet(path))
    assert reconcile.differences(batch, streamed, ["window_start", "event_type"], ["events", "total"]).count() == 0

    # Nothing new: the result stands.
    assert settled(spark, folder, tmp_path).agg(F.sum("events")).first()[0] == 150


def test_rows_behind_the_watermark_show_up_in_reconciliation(spark, folder, tmp_path):
    path = str(folder / "events.parquet")
    events(spark, 1_000, 1_020).write.mode("append").parquet(path)
    settled(spark, folder, tmp_path)
    events(spark, 0, 5).write.mode("append").parquet(path)
    streamed = settled(spark, folder, tmp_path)
    batch = windows(spark.read.parquet(path))
    found = reconcile.differences(batch, streamed, ["window_start", "event_type"], ["events", "total"])
    assert {r["status"] for r in found.collect()} == {"only_batch"}


def test_empty_input_gives_no_windows(spark, folder, tmp_path):
    events(spark, 0, 0).write.parquet(str(folder / "events.parquet"))
    assert settled(spark, folder, tmp_path).count() == 0


def test_ingest_is_exactly_once_across_restarts(spark, folder, tmp_path):
    path = str(folder / "events.parquet")
    out, progress = str(tmp_path / "bronze"), str(tmp_path / "bronze-progress")
    for first in (0, 50):
        events(spark, first, first + 50).write.mode("append").parquet(path)
        for _ in range(2):
            stream = stream_of(spark, folder).withColumn("day", F.to_date("ts"))
            ingest(stream, out, progress, ["day"])
        assert spark.read.parquet(out).count() == first + 50
    table = spark.read.parquet(out)
    assert table.select("event_id").distinct().count() == 100
    assert "day" in table.columns


def test_one_file_or_a_folder(spark, sf_small):
    schema = spark.read.parquet(f"{sf_small}/events.parquet").schema
    stream = event_stream(spark, sf_small, "events", schema, "ts")
    assert stream.isStreaming
    assert stream.schema["ts"].dataType.simpleString() == "timestamp"


def test_stream_into_a_table_is_idempotent(spark, folder, tmp_path):
    """Three batches, a restart, and all of it once more from the start."""
    path = str(folder / "events.parquet")
    for first in range(0, 90, 30):
        events(spark, first, first + 30).withColumn("user_id", F.col("event_id")).write.mode("append").parquet(path)
    name = f"bronze_stream.t_{uuid.uuid4().hex}"
    bronze.create_namespace(spark, "bronze_stream", str(tmp_path / "namespace"))
    bronze.create_table(spark, name, TRANSACTIONS_BRONZE, BY_DATE_AND_BATCH, location=str(tmp_path / "table"))
    schema = spark.read.parquet(path).schema

    def run(progress):
        stream = event_stream(spark, str(folder), "events", schema, "ts", 1)
        ingest_table(transactions_from_events(stream), name, str(tmp_path / progress))
        table = spark.table(name)
        return table.count(), table.select("ingestion_batch_id").distinct().count()

    assert run("one") == (90, 3)
    events(spark, 90, 100).withColumn("user_id", F.col("event_id")).write.mode("append").parquet(path)
    assert run("one") == (100, 4)
    assert run("two") == (100, 4)


def test_malformed_messages_keep_their_text(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("kind", T.StringType())])
    messages = spark.createDataFrame(
        [('{"id": 1, "kind": "a"}', "t", 0, 5), ("no json", "t", 1, 6)],
        "value string, topic string, partition int, offset long",
    )
    rows = [tuple(r) for r in parse_messages(messages, schema).collect()]
    assert rows == [(1, "a", None, "t", 0, 5), (None, None, "no json", "t", 1, 6)]


def delivered(spark, folder, first, last, again=()):
    rows = [events(spark, first, last), *[events(spark, a, b) for a, b in again]]
    frame = rows[0]
    for more in rows[1:]:
        frame = frame.unionByName(more)
    frame.withColumn("user_id", F.col("event_id")).coalesce(1).write.mode("append").parquet(str(folder / "events.parquet"))


def test_redelivered_events_are_written_once(spark, folder, tmp_path):
    """Repeats within a batch, of earlier batches, across restarts, and events behind the watermark."""
    name = f"bronze_once.t_{uuid.uuid4().hex}"
    bronze.create_namespace(spark, "bronze_once", str(tmp_path / "namespace"))
    bronze.create_table(spark, name, TRANSACTIONS_BRONZE, BY_DATE_AND_BATCH, location=str(tmp_path / "table"))
    schema = T.StructType([*events(spark, 0, 0).schema, T.StructField("user_id", T.LongType())])

    def run():
        stream = event_stream(spark, str(folder), "events", schema, "ts", 1)
        ingest_once(stream, ["event_id"], "ts", "10 hours", transactions_from_events, name, str(tmp_path / "progress"), state_partitions=2)
        table = spark.table(name)
        return table.count(), table.select("transaction_id").distinct().count()

    delivered(spark, folder, 50, 100, again=[(50, 70), (60, 65)])
    delivered(spark, folder, 100, 150, again=[(90, 110)])
    delivered(spark, folder, 150, 200, again=[(60, 150)])
    assert run() == (150, 150)
    # A restart; repeats from before it, and events so late that they cannot be told from repeats.
    delivered(spark, folder, 200, 210, again=[(180, 200), (0, 50)])
    assert run() == (160, 160)
    assert run() == (160, 160)
    source = spark.read.schema(schema).parquet(str(folder / "events.parquet")).withColumn("ts", F.col("ts").cast("timestamp"))
    for _ in range(2):
        sweep_late(transactions_from_events(source), name, ["transaction_id"], "late-1")
        table = spark.table(name)
        assert (table.count(), table.select("transaction_id").distinct().count()) == (210, 210)
    batch = transactions_from_events(source.dropDuplicates(["event_id"]))
    compared = ["transaction_id", "event_ts", "amount", "payload_hash"]
    assert table.select(*compared).exceptAll(batch.select(*compared)).count() == 0


def test_state_of_redelivery_expires(spark, folder, tmp_path):
    schema = events(spark, 0, 0).schema
    events(spark, 0, 50).write.mode("append").parquet(str(folder / "events.parquet"))
    events(spark, 5_000, 5_010).write.mode("append").parquet(str(folder / "events.parquet"))
    events(spark, 5_010, 5_011).write.mode("append").parquet(str(folder / "events.parquet"))
    stream = once(event_stream(spark, str(folder), "events", schema, "ts", 1), ["event_id"], "ts", "1 day")
    query = (
        stream.writeStream.format("noop")
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    held = [state["numRowsTotal"] for progress in query.recentProgress for state in progress["stateOperators"]]
    assert max(held) >= 50 and held[-1] <= 11


def test_bursts_of_a_stream_equal_the_batch_ones_that_are_over(spark, folder, tmp_path):
    rows = [(i, START + timedelta(minutes=m), f"u{i % 3}", 1.0) for i, m in enumerate([0, 1, 2, 40, 41, 300, 301, 302, 3_000, 3_001])]
    schema = "event_id long, ts timestamp_ntz, user_id string, value double"
    for start in range(0, len(rows), 4):
        spark.createDataFrame(rows[start : start + 4], schema).coalesce(1).write.mode("append").parquet(str(folder / "events.parquet"))
    whole = spark.read.parquet(str(folder / "events.parquet"))
    stream = event_stream(spark, str(folder), "events", whole.schema, "ts", 1)
    found = burst_windows(stream, "user_id", "ts", "value", "30 minutes", "1 hour")
    ingest(found, str(tmp_path / "out"), str(tmp_path / "progress"), [])
    streamed = spark.read.schema(found.schema).parquet(str(tmp_path / "out"))
    over = bursts(whole, "user_id", "ts", "value", "30 minutes").filter(
        F.col("end") <= F.lit(START + timedelta(minutes=3_001 - 60)).cast("timestamp")
    )
    assert sorted(map(tuple, streamed.collect()), key=str) == sorted(map(tuple, over.collect()), key=str)
    assert over.count() > 3


def test_versions_of_windows_are_merged(spark, folder, tmp_path):
    """After every run; a place that was left half written by a lost driver is used again."""
    path = str(folder / "events.parquet")
    out = tmp_path / "out"
    for run, first in enumerate(range(0, 160, 40)):
        for start in (first, first + 20):
            events(spark, start, start + 20).write.mode("append").parquet(path)
        if run == 2:  # a driver was lost after it had merged, before it removed the older table
            other = next(p for p in (out / "batch_id=-1", out / "batch_id=-2") if not p.exists())
            other.mkdir()
        counted = windows(stream_of(spark, folder), watermark="1 day")
        streamed = run_windows(counted, ["event_type"], str(out), f"{tmp_path}/progress", max_versions=1)
        batch = windows(spark.read.parquet(path))
        assert reconcile.differences(batch, streamed, ["window_start", "event_type"], ["events", "total"]).count() == 0
        assert len(list(out.glob("batch_id=*"))) == 1
