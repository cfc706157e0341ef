"""Exact dedup by progressive refinement: length, prefix hash, full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import WHITE, written

PREFIX_CHARS = 256


def normalised(text: Column) -> Column:
    """The text without any white space; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for char in WHITE:
        out = F.replace(out, F.lit(char), F.lit(""))
    return out


def exact_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_singles: bool = False,
    prefix_chars: int = PREFIX_CHARS,
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, full_hash)`` of documents that have equal others.

    Rows are grouped by length of the normalised text, those that share a length by a
    hash of its first characters as well, and only those that share both have their full
    text moved and hashed (SHA-256). ``keep_singles`` also returns, and hashes, the rows
    that dropped out on the way.

    Of equal texts the one with the most code points before normalisation stays, then
    the smallest ``doc_id`` (null last). Null and empty texts, and texts of white space,
    are equal. Rows that repeat a ``doc_id`` with an equal text count in ``group_size``
    and share its fate; rows with one ``doc_id`` and other texts are judged by their text.
    Other columns are not read. Groups are met by partial aggregates and by joins that
    adaptive execution may split, never gathered.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("body"), F.length(text).alias("chars"))
    rows = rows.select(
        "doc_id",
        "body",
        F.coalesce("chars", F.lit(0)).alias("chars"),
        F.length("body").alias("size"),
        F.xxhash64(F.substring("body", 1, prefix_chars)).alias("prefix"),
    )
    # A length met once stands alone whatever its prefix; the second count covers both.
    by_prefix = rows.groupBy("size", "prefix").agg(F.count("*").alias("n"))
    by_length = by_prefix.groupBy("size").agg(F.sum("n").alias("n_length"))
    crowded = by_length.where("n_length > 1").select(F.col("size").alias("crowded_size"))
    alive = (
        by_prefix.where("n > 1")
        .join(crowded, F.col("size") == F.col("crowded_size"), "left_semi")
        .select(F.col("size").alias("alive_size"), F.col("prefix").alias("alive_prefix"))
    )
    same = (F.col("size") == F.col("alive_size")) & (F.col("prefix") == F.col("alive_prefix"))
    if keep_singles:
        # Every row is asked for with its hash, so it is taken where the row is read: no text moves.
        hashed = rows.select("doc_id", "chars", "size", "prefix", F.sha2("body", 256).alias("full_hash"))
        hashed = hashed.join(alive, same, "left").withColumn("survives", F.col("alive_size").isNotNull())
    else:
        hashed = rows.join(alive, same, "left_semi").select(
            "doc_id", "chars", "size", "prefix", F.sha2("body", 256).alias("full_hash"), F.lit(True).alias("survives")
        )
    order = F.struct((-F.col("chars")).alias("c"), F.col("doc_id").isNull().alias("absent"), F.col("doc_id").alias("id"))
    groups = (
        hashed.where("survives")
        .groupBy(F.col("full_hash").alias("group_hash"))
        .agg(F.min(order).getField("id").alias("group_keep"), F.count("*").alias("group_n"))
    )
    out = hashed.join(groups, F.col("full_hash") == F.col("group_hash"), "left")
    keep = F.when(F.col("group_n").isNull(), F.col("doc_id")).otherwise(F.col("group_keep"))
    return out.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_n", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "full_hash",
    )


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with exactly one row of each group of equal texts; all columns stay as they are.

    The row that stays is chosen as in :func:`exact_groups`, and among rows that repeat its id
    (or have none) by a number drawn for each row, with which the rows are written first.
    """
    marked = written(docs.withColumn("__row", F.monotonically_increasing_id()), "exact-rows")
    named = F.struct(F.col(doc_id).isNull().alias("absent"), F.col(doc_id).alias("id"), F.col("__row").alias("row"))
    groups = exact_groups(marked.select(named.alias("__name"), F.col(text).alias("__text")), "__name", "__text")
    gone = groups.where("NOT kept").select(F.col("doc_id.row").alias("__gone"))
    return marked.join(gone, F.col("__row") == F.col("__gone"), "left_anti").drop("__row")
