"""Bursts: events of a key that follow each other within a gap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.functions import to_event_time
from tallywright.functions.money import exact_sum
from tallywright.operators.skew import DEFAULT_POLICY, SkewPolicy, add_carry, lay_out


def burst_windows(events: DataFrame, key: str, at: str, value: str, gap: str, watermark: str | None = None) -> DataFrame:
    """``(key, start, end, events, total)`` by merging session windows, for batch and stream.

    A burst ends ``gap`` after its last event; an event at that very instant still belongs to
    it. As a stream with a ``watermark``, bursts come out in append mode once it has passed
    their end.
    """
    timed = events.withColumn(at, to_event_time(F.col(at)))
    if watermark:
        timed = timed.withWatermark(at, watermark)
    grouped = timed.groupBy(F.session_window(at, gap), key)
    return grouped.agg(F.count(F.lit(1)).alias("events"), F.round(exact_sum(value), 2).alias("total")).select(
        key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "events", "total"
    )


def bursts(
    events: DataFrame,
    key: str,
    at: str,
    value: str,
    gap: str,
    order: Sequence[str] = (),
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """The same bursts over a whole table, with keys above the policy's limit cut into chunks.

    Session windows sort all rows of a key in one task. Here each row is compared with the one
    before, chunks of a hot key are given the last instant and the number of bursts ahead
    of them, and a burst's rows are added up where they are. Events without a time are left
    out; those without a key are one key.
    """
    kind = to_event_time(F.col(at))
    timed = events.select(key, kind.alias("_at"), F.col(value).alias("_value"), *[F.col(c).alias(f"_o_{n}") for n, c in enumerate(order)])
    timed = timed.filter(F.col("_at").isNotNull())
    laid = lay_out(timed, key, ("_at", *[f"_o_{n}" for n in range(len(order))]), policy)
    w = W.partitionBy(key, "_chunk").orderBy(*laid.order)
    length = F.expr(f"INTERVAL {gap}")
    rows = laid.rows.withColumn("_before", F.lag("_at").over(w))
    if laid.split:
        ends = laid.hot.groupBy(key, "_chunk").agg(F.max("_at").alias("_last"))
        ends = ends.withColumn("_ahead", F.lag("_last").over(W.partitionBy(key).orderBy("_chunk")))
        rows = add_carry(rows, ends.filter(F.col("_ahead").isNotNull()), key, ["_ahead"], policy)
        rows = rows.withColumn("_before", F.coalesce("_before", "_ahead")).drop("_ahead")
    opens = F.col("_before").isNull() | (F.col("_at") > F.col("_before") + length)
    rows = rows.withColumn("_opens", opens.cast("long"))
    # The first of an instant's rows may open a burst; the others lie at no distance from it.
    rows = rows.withColumn("_burst", F.sum("_opens").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    if laid.split:
        opened = rows.filter(F.col("_chunk") > 0).groupBy(key, "_chunk").agg(F.sum("_opens").alias("_opened"))
        ahead = W.partitionBy(key).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
        carry = opened.select(key, "_chunk", F.sum("_opened").over(ahead).alias("_bursts_ahead"))
        rows = add_carry(rows, carry.filter(F.col("_bursts_ahead").isNotNull()), key, ["_bursts_ahead"], policy)
        rows = rows.withColumn("_burst", F.col("_burst") + F.coalesce("_bursts_ahead", F.lit(0)))
    return rows.groupBy(key, "_burst").agg(
        F.min("_at").alias("start"),
        (F.max("_at") + length).alias("end"),
        F.count(F.lit(1)).alias("events"),
        F.round(exact_sum("_value"), 2).alias("total"),
    ).drop("_burst")
