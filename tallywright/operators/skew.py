"""Keeping hot keys off single tasks.

A key that holds a large share of all rows must not end in one task, neither in a
join nor in an ordered window. The helpers here find such keys with a partially
aggregated count, whose result is bounded, and spread only those.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.session import written


@dataclass(frozen=True)
class SkewPolicy:
    """Limits behind every broadcast and every per-key task.

    ``rows_per_task``: a key with more rows is split, however many such keys there
    are; their list has at most ``total / rows_per_task`` rows by itself.
    ``broadcast_rows`` and ``broadcast_bytes``: a table within both, once written and
    counted, is broadcast, a larger one goes through a shuffled join.
    """

    rows_per_task: int = 10_000_000
    broadcast_rows: int = 1_000_000
    broadcast_bytes: int = 256 * 1024 * 1024


DEFAULT_POLICY = SkewPolicy()


def same_key(left: Column, right: Column) -> Column:
    """Equality that lets NULL meet NULL, as grouping and window partitions do."""
    return left.eqNullSafe(right)


def hottest(counts: DataFrame, rows: str, policy: SkewPolicy) -> DataFrame:
    """The keys above ``rows_per_task``."""
    return counts.filter(F.col(rows) > policy.rows_per_task)


def measured(df: DataFrame, label: str, policy: SkewPolicy) -> DataFrame:
    """``df`` written and counted; marked for broadcast if it is within the limits."""
    table = written(df, label)
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    per_row = 16 * len(df.columns)
    letters = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0))
    size = table.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(letters), F.lit(0)).alias("bytes")
    ).first()
    fits = (
        size["rows"] <= policy.broadcast_rows
        and size["bytes"] + size["rows"] * per_row <= policy.broadcast_bytes
    )
    return F.broadcast(table) if fits else table


def join_per_key(
    facts: DataFrame,
    per_key: DataFrame,
    key: str,
    rows: str,
    spread_by: str,
    values: Sequence[str],
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add ``values`` of a one-row-per-key table to every fact row.

    ``per_key`` must be written already (its size is read first) and carry its
    row count in ``rows``. Small enough, it is broadcast and the facts do not
    move. Otherwise both sides are shuffled by key and salt: a hot key's facts
    are spread over several salts by the hash of ``spread_by`` and of the input
    split, which parts even copies of one row; its single per-key row is repeated
    once for each salt.
    """
    key_bytes = F.octet_length(F.col(key).cast("string"))
    size = per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col(key).isNull()).alias("nulls"),
        F.coalesce(F.sum(key_bytes), F.lit(0)).alias("key_bytes"),
    ).first()
    row_bytes = 16 * (len(values) + 2)
    fits = (
        size["keys"] <= policy.broadcast_rows
        and size["key_bytes"] + size["keys"] * row_bytes <= policy.broadcast_bytes
    )
    narrow = per_key.select(F.col(key).alias("_key"), F.col(rows).alias("_rows"), *values)
    equal = (
        same_key(F.col(key), F.col("_key")) if size["nulls"] else F.col(key) == F.col("_key")
    )
    if fits:
        return facts.join(F.broadcast(narrow), equal, "left").drop("_key", "_rows")

    hot = measured(
        hottest(narrow, "_rows", policy).select(
            F.col("_key").alias("_hot_key"),
            F.ceil(F.col("_rows") / policy.rows_per_task).cast("int").alias("_splits"),
        ),
        "hot-keys",
        policy,
    )
    splits = F.coalesce(F.col("_splits"), F.lit(1))

    def with_splits(df: DataFrame, column: str) -> DataFrame:
        return df.join(hot, same_key(F.col(column), F.col("_hot_key")), "left")

    salted_facts = with_splits(facts, key).withColumn(
        "_salt", F.pmod(F.xxhash64(spread_by, F.spark_partition_id()), splits).cast("int")
    )
    salted_values = with_splits(narrow, "_key").select(
        "_key", *values, F.explode(F.sequence(F.lit(0), splits - 1)).alias("_value_salt")
    )
    return salted_facts.drop("_hot_key", "_splits").join(
        salted_values, equal & (F.col("_salt") == F.col("_value_salt")), "left"
    ).drop("_key", "_salt", "_value_salt")


@dataclass(frozen=True)
class OrderedRows:
    """Rows laid out for per-key ordered windows.

    ``rows`` carries a ``_chunk`` number: windows partition by (key, ``_chunk``)
    and order by ``order``. A cold key has one chunk. A hot key has several, cut
    along the order, so chunk ``i`` precedes chunk ``i + 1``. ``split`` tells
    whether any key has more than one.
    """

    rows: DataFrame
    key: str
    order: tuple[str, ...]
    split: bool
    hot: DataFrame | None = None


def lay_out(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    policy: SkewPolicy = DEFAULT_POLICY,
    counts: DataFrame | None = None,
) -> OrderedRows:
    """Cut hot keys into chunks along ``order``; leave all others whole.

    ``counts`` may give the rows per key (column ``_rows``) where they are
    cheaper to take elsewhere.

    Range partitioning on (key, order) samples the data and places its borders
    inside a hot key where needed, so chunks stay even whatever the key or the
    timestamps look like; rows equal in all of these are told apart by the input
    split they came from. The chunk number is the range partition, drawn once and
    written, because everything later has to agree on it.
    """
    order = tuple(order)
    if counts is None:
        counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    hot_keys = measured(
        hottest(counts, "_rows", policy).select(F.col(key).alias("_hot_key"), "_rows"),
        "hot-keys",
        policy,
    )
    found = hot_keys.agg(F.count(F.lit(1)).alias("keys"), F.sum("_rows").alias("rows")).first()
    if not found["keys"]:
        return OrderedRows(df.withColumn("_chunk", F.lit(0)), key, order, split=False)

    is_hot = same_key(F.col(key), F.col("_hot_key"))
    names = hot_keys.drop("_rows")
    chunks = ceil(found["rows"] / policy.rows_per_task) + 1
    hot = written(
        df.join(names, is_hot, "left_semi")
        .withColumn("_input_split", F.spark_partition_id())
        .repartitionByRange(chunks, key, *order, "_input_split")
        .withColumn("_chunk", F.spark_partition_id() + 1)
        .drop("_input_split"),
        "chunks",
    )
    cold = df.join(names, is_hot, "left_anti").withColumn("_chunk", F.lit(0))
    return OrderedRows(cold.unionByName(hot), key, order, split=True, hot=hot)


def add_carry(
    rows: DataFrame,
    carry: DataFrame,
    key: str,
    values: Sequence[str],
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Join values carried into each chunk of a hot key.

    ``carry`` has a row for each hot key and chunk it reaches: hot keys plus chunks
    at most, both bounded by the rows over ``rows_per_task``. It is written and
    counted, and broadcast only within the policy's limits.
    """
    narrow = measured(
        carry.select(
            F.col(key).alias("_carry_key"), F.col("_chunk").alias("_carry_chunk"), *values
        ),
        "carry",
        policy,
    )
    on = same_key(F.col(key), F.col("_carry_key")) & (F.col("_chunk") == F.col("_carry_chunk"))
    return rows.join(narrow, on, "left").drop("_carry_key", "_carry_chunk")
