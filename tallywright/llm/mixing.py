"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.llm.common import WORD, written

BUCKETS = 4096
SEED = "mix-1"


def word_count(text):
    """Number of runs without white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, max_epochs: int = 3) -> DataFrame:
    """``sources`` (``source``, ``source_size``, ``weight``) with ``target``.

    The budget is the sum of all sizes. Sources above ``max_epochs`` times their size
    are clamped there and their excess is shared by weight until none is above. Clamping
    always takes a prefix of the sources in the order of limit per weight, so running
    sums over that order give the end of the rounds without a loop. One row a source
    meets in one window, as weights depend on the rank among all sources.
    """
    limit = F.col("source_size") * max_epochs
    every = Window.partitionBy()
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    filled = sources.withColumn("limit", limit).withColumns(
        {
            "room": F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(ahead), F.lit(0)),
            "open": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(ahead), F.lit(0)),
        }
    )
    # limit <= weight * room / open, in whole numbers
    filled = filled.withColumn("clamped", F.col("limit") * F.col("open") <= F.col("weight") * F.col("room"))
    first_open = F.struct((F.col("limit") / F.col("weight")).alias("r"), F.col("source").isNull().alias("u"), F.col("source").alias("s"), F.col("room").alias("room"), F.col("open").alias("open"))
    filled = filled.withColumn("level", F.min(F.when(~F.col("clamped"), first_open)).over(every))
    shared = F.col("weight") * F.col("level.room") / F.col("level.open")
    return filled.select(
        "source",
        "source_size",
        "weight",
        F.when(F.col("clamped"), F.col("limit").cast("double")).otherwise(shared).alias("target"),
    )


def mix_plan(rows: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, buckets: int = BUCKETS) -> DataFrame:
    """One row a source: ``p_source, source_size, target, rate, whole, cut``.

    ``rows`` has ``source``, ``size`` and ``draw``. Rows of a source are taken ``whole``
    times and, if their draw lies below ``cut``, once more. The cut is where the words of
    the rows below it meet the fractional need: words are summed by bucket of the draw,
    and within the bucket that holds the cut it is interpolated.
    """
    cells = rows.groupBy("source", F.floor(F.col("draw") * buckets).cast("int").alias("cell")).agg(F.sum("size").alias("words"))
    cells = written(cells, "mix-cells")
    totals = cells.groupBy("source").agg(F.sum("words").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (number % len(weights) + 1).cast("int"))
    plan = water_fill(totals.withColumn("weight", weight.cast("long")), max_epochs)
    plan = plan.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    plan = plan.withColumn("whole", F.floor("rate").cast("long")).withColumn(
        "need", F.col("target") - F.col("whole") * F.col("source_size")
    )
    named = plan.select(F.col("source").alias("p_source"), "source_size", "target", "rate", "whole", "need")
    upto = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    below = cells.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    last = (
        below.join(named, F.col("source").eqNullSafe(F.col("p_source")))
        .where((F.col("words") > 0) & (F.col("before") < F.col("need")))
        .groupBy(F.col("p_source").alias("c_source"))
        .agg(F.max(F.struct("cell", "before", "words")).alias("last"))
    )
    plan = named.join(last, F.col("p_source").eqNullSafe(F.col("c_source")), "left")
    part = F.least(F.lit(1.0), (F.col("need") - F.col("last.before")) / F.col("last.words"))
    cut = F.coalesce((F.col("last.cell") + part) / buckets, F.lit(0.0))
    return plan.select("p_source", "source_size", "target", "rate", "whole", cut.alias("cut"))


def repetitions(draw_column) -> Column:
    """How often a row is taken, from its draw and its source's plan beside it."""
    return F.col("whole") + (draw_column < F.col("cut")).cast("long")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED, **options) -> DataFrame:
    """``(doc_id, source, size, source_size, target, rate, repetitions, taken)`` for every row.

    Sources in code point order, null last and a source of its own, weigh ``weights``,
    repeating; a source stops at ``max_epochs`` times its size. Each row is taken the
    whole part of ``target / source_size`` times, and once more if its seeded draw lies
    below the source's cut (:func:`mix_plan`). No list of rows is sorted or gathered. A
    draw depends on the seed and ``doc_id`` alone, so reruns agree and rows that repeat an
    id are taken alike; a null id draws as the empty text. Null and empty texts have size
    0. Sources without words have target 0 and nothing of them is taken. Other columns of
    ``docs`` are not read. The sizes are written once, the plan has a row for each source
    and is broadcast where its files are small enough for the session's threshold.
    """
    rows = written(_rows(docs, doc_id, text, source, seed), "mix-rows")
    plan = written(mix_plan(rows, **options), "mix-plan")
    out = rows.join(plan, F.col("source").eqNullSafe(F.col("p_source")))
    times = repetitions(F.col("draw"))
    return out.select(
        "doc_id", "source", "size", "source_size", "target", "rate", times.alias("repetitions"), (times * F.col("size")).alias("taken")
    )


def _rows(docs: DataFrame, doc_id: str, text: str, source: str, seed: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        draw(F.col(doc_id), seed).alias("draw"),
    )


def repeat_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED, **options) -> DataFrame:
    """``docs`` with every row as often as the mix takes it, columns unchanged.

    Only the plan, a row for each source, is joined to the rows; draws are made again.
    """
    plan = written(mix_plan(_rows(docs, doc_id, text, source, seed), **options), "mix-plan")
    own = docs.columns
    names = {c: f"__plan_{c}" for c in plan.columns}
    joined = docs.join(plan.withColumnsRenamed(names), F.col(source).eqNullSafe(F.col("__plan_p_source")))
    times = F.col("__plan_whole") + (draw(F.col(doc_id), seed) < F.col("__plan_cut")).cast("long")
    copies = F.explode(F.array_repeat(F.lit(True), times.cast("int")))
    return joined.select(*[F.col(f"`{c}`") for c in own], copies.alias("__copy")).drop("__copy")


def draw(key, seed: str = SEED):
    """A number in [0, 1) from 48 bits of MD5; a null key draws as the empty text."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))
