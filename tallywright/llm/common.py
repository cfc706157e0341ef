"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.session import written

WHITE = " \t\n\x0b\x0c\r"
WHITE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["WHITE", "WHITE_CLASS", "WORD", "components", "drawn", "held_out", "table", "tidy", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(run: Callable[[Iterator], Iterator], *forget: Callable[[], None]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow``, giving memory back to the system when a task is over.

    Workers serve one stage after the other; what the last one held would stay theirs.
    """

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            for drop in forget:
                drop()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return wrapped


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the key as text leaves ``fold``; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def drawn(rows: DataFrame, place: Column, n: int, *ties: Column) -> DataFrame:
    """At most ``n`` of ``rows``, those with the smallest ``place``, a 64-bit hash; ``ties`` order equal ones.

    Rows are counted first, and those whose hash lies beyond the share that is needed, with
    room for chance, go where they are: what meets in one task is little more than ``n``
    rows however many tasks there are.
    """
    total = rows.count()
    if total == 0:
        return rows
    share = min(1.0, (n + 6 * n**0.5 + 20) / total)
    spread = (place.cast("double") / F.lit(float(1 << 64))) + 0.5
    return rows.where(spread <= share).orderBy(place, *ties).limit(n)


def components(nodes: DataFrame, edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)``: the smallest node reachable over undirected edges.

    ``nodes`` has ``node``; ``edges`` has ``a`` and ``b``, both from ``nodes``; nulls
    are left out. Each round gives every root the smallest root next to it and then
    halves the paths, so chains of length n end in O(log n) rounds. Links shrink as
    they are rewritten to roots and those within one component go. Every round is
    written to the shared folder, which bounds lineage; only a row count reaches the
    driver. Skewed joins are on one row per node and left to adaptive execution.
    """
    parent = nodes.where("node IS NOT NULL").select("node").distinct().withColumn("root", F.col("node"))
    links = (
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    links = written(links, f"{label}-links")
    touched = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    roots = written(touched.withColumn("root", F.col("node")), f"{label}-roots")
    while not links.isEmpty():
        # Every root that has a smaller root beside it hooks to the smallest such root.
        hook = links.groupBy(F.col("b").alias("old")).agg(F.min("a").alias("new"))
        hook = written(hook, f"{label}-hooks")
        # Follow hooks to their end: targets are always smaller, so there are no cycles.
        while True:
            step = hook.alias("h").join(
                hook.select(F.col("old").alias("mid"), F.col("new").alias("far")).alias("n"),
                F.col("h.new") == F.col("n.mid"),
                "left",
            )
            step = written(
                step.select("old", F.coalesce("far", "new").alias("new"), F.col("far").isNotNull().alias("moved")),
                f"{label}-hooks",
            )
            hook = step.drop("moved")
            if step.where("moved").isEmpty():
                break
        to_root = hook.select(F.col("old").alias("key"), F.col("new").alias("up"))
        roots = written(
            roots.join(to_root, F.col("root") == F.col("key"), "left").select(
                "node", F.coalesce("up", "root").alias("root")
            ),
            f"{label}-roots",
        )
        left = to_root.select(F.col("key").alias("ka"), F.col("up").alias("ua"))
        right = to_root.select(F.col("key").alias("kb"), F.col("up").alias("ub"))
        moved = (
            links.join(left, F.col("a") == F.col("ka"), "left")
            .join(right, F.col("b") == F.col("kb"), "left")
            .select(F.coalesce("ua", "a").alias("x"), F.coalesce("ub", "b").alias("y"))
            .where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
        links = written(moved, f"{label}-links")
    known = roots.select(F.col("node").alias("key"), F.col("root").alias("up"))
    return parent.join(known, F.col("node") == F.col("key"), "left").select(
        "node", F.coalesce("up", "root").alias("component")
    )
