"""Velocity as events arrive: after the last batch as in the batch job."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tallywright.operators.velocity import with_velocity_flag
from tallywright.streaming import event_stream
from tallywright.streaming.velocity import run_velocity, trailing_counts

SCHEMA = "transaction_id long, customer_id string, timestamp timestamp_ntz, amount double"


def test_counts_out_of_order_and_across_a_restart_equal_the_batch(spark, tmp_path):
    draw = random.Random(1)
    folder = tmp_path / "in"
    rows = [
        (i, f"C{draw.randrange(4)}", datetime(2026, 7, 1) + timedelta(seconds=30 * (i + draw.randrange(-20, 20))), 1.0)
        for i in range(240)
    ]

    def deliver(part):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder / "events.parquet"))

    def run():
        schema = spark.createDataFrame([], SCHEMA).schema
        stream = event_stream(spark, str(folder), "events", schema, "timestamp", 1)
        counted = trailing_counts(stream, "customer_id", "timestamp", "transaction_id", "10 minutes", "1 hour")
        return run_velocity(counted, "customer_id", "transaction_id", 5, str(tmp_path / "out"), str(tmp_path / "progress"), 2)

    def batch(part):
        flagged = with_velocity_flag(spark.createDataFrame(part, SCHEMA), "10 minutes", 5)
        return {(r["transaction_id"], r["rolling_count"], r["is_high_velocity"]) for r in flagged.collect()}

    deliver(rows[:90])
    deliver(rows[90:150])
    found = {(r["transaction_id"], r["rolling_count"], r["is_high_velocity"]) for r in run().collect()}
    assert found == batch(rows[:150])
    deliver(rows[150:])
    found = {(r["transaction_id"], r["rolling_count"], r["is_high_velocity"]) for r in run().collect()}
    assert found == batch(rows)
    assert spark.read.parquet(str(tmp_path / "out")).filter(F.col("batch_id") >= 0).count() > 240
