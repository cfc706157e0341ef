"""Comparing two tables by a tree of digests, and rows only where digests differ.

Rows are hashed and the hashes added up by slots of the key. Sums do not depend on order,
so both sides may lie as they like, and copies count. Slots are the leaves of a tree whose
nodes are sums again. The trees are small tables that can be kept with their table; two of
them are walked from the top, and rows are read only below nodes that differ.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.operators.reconcile import row_differences
from tallywright.session import written

#: Children of a node, as bits, and ranges that a filter may list before a join takes over.
FAN_BITS, MAX_RANGES = 4, 200
SUM = "decimal(38,0)"
NOWHERE = "decimal(20,0)"


@dataclass(frozen=True)
class DigestTree:
    """Digests of a table: ``levels`` from the slots up, ``(node, rows, sum_a, sum_b)`` each.

    Slot ``n`` holds keys from ``n * width`` up to the next; rows without a key have the NULL
    slot, which stands apart on every level.
    """

    key: str
    width: int
    columns: tuple[str, ...]
    levels: tuple[DataFrame, ...]


def slot_of(key: Column | str, width: int) -> Column:
    """The slot of a whole-number key."""
    value = F.col(key) if isinstance(key, str) else key
    return F.floor(value.cast(NOWHERE) / F.lit(width)).cast("long")


def row_hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two hashes of 64 bits over all columns; a NULL is told from a value and from its neighbours."""
    absent = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return tuple(F.xxhash64(F.lit(seed), absent, *columns).cast(SUM) for seed in ("a", "b"))


def _sums(grouped) -> DataFrame:
    return grouped.agg(F.sum("rows").alias("rows"), F.sum("sum_a").cast(SUM).alias("sum_a"), F.sum("sum_b").cast(SUM).alias("sum_b"))


def digest_tree(rows: DataFrame, key: str, width: int, label: str = "digests") -> DigestTree:
    """Read ``rows`` once and keep the digests of all slots and of the nodes above them.

    Sums are taken where the rows are; a slot's partial sums are all that moves, however
    many rows a key has. Maps are no part of the digest.
    """
    columns = tuple(f.name for f in rows.schema if not isinstance(f.dataType, T.MapType))
    a, b = row_hashes(columns)
    hashed = rows.select(slot_of(key, width).alias("node"), F.lit(1).cast("long").alias("rows"), a.alias("sum_a"), b.alias("sum_b"))
    levels = [written(_sums(hashed.groupBy("node")), label)]
    while True:
        ends = levels[-1].agg(F.min("node").alias("low"), F.max("node").alias("high")).first()
        # Shifting ends at 0, or at -1 for keys below zero.
        if ends["low"] == ends["high"] or (ends["low"], ends["high"]) == (-1, 0):
            return DigestTree(key, width, columns, tuple(levels))
        above = levels[-1].withColumn("node", F.shiftright("node", FAN_BITS))
        levels.append(written(_sums(above.groupBy("node")), label))


def _level(tree: DigestTree, level: int) -> DataFrame:
    """A level; above the top its one or two nodes, lifted."""
    if level < len(tree.levels):
        return tree.levels[level]
    top = tree.levels[-1]
    return top.withColumn("node", F.shiftright("node", FAN_BITS * (level - len(tree.levels) + 1)))


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Nodes whose digests are not the same on both sides, a missing node included."""
    measures = ("rows", "sum_a", "sum_b")
    other = right.select(F.col("node").alias("o_node"), *[F.col(m).alias(f"o_{m}") for m in measures])
    sides = left.withColumn("_left", F.lit(True)).join(
        other.withColumn("_right", F.lit(True)), F.col("node").eqNullSafe(F.col("o_node")), "full"
    )
    same = reduce(lambda x, y: x & y, [F.col(m).eqNullSafe(F.col(f"o_{m}")) for m in measures])
    return sides.filter(~same).select(F.when(F.col("_left"), F.col("node")).otherwise(F.col("o_node")).alias("node"))


def differing_slots(left: DigestTree, right: DigestTree) -> DataFrame:
    """Slots whose rows are not the same on both sides.

    From the top down, the children of differing nodes alone are compared.
    """
    if (left.key, left.width, left.columns) != (right.key, right.width, right.columns):
        raise ValueError("the trees are over other keys, widths or columns")
    top = max(len(left.levels), len(right.levels)) - 1
    open_: DataFrame | None = None
    for level in range(top, -1, -1):
        sides = [_level(left, level), _level(right, level)]
        if open_ is not None:
            parents = open_.select(F.col("node").alias("parent"))
            below = F.shiftright("node", FAN_BITS).eqNullSafe(F.col("parent"))
            sides = [side.join(parents, below, "left_semi") for side in sides]
        open_ = written(_differing(*sides), "digest-open")
    return open_


def _ranges(slots: DataFrame) -> tuple[list[tuple[int, int]] | None, bool]:
    """Runs of neighbouring slots, None if there are too many, and whether the NULL slot is among them."""
    absent = not slots.filter(F.col("node").isNull()).isEmpty()
    known = slots.filter(F.col("node").isNotNull())
    found = sorted(r["node"] for r in known.limit(64 * MAX_RANGES).collect())
    if len(found) == 64 * MAX_RANGES:
        return None, absent
    runs: list[tuple[int, int]] = []
    for slot in found:
        if runs and runs[-1][1] == slot - 1:
            runs[-1] = (runs[-1][0], slot)
        else:
            runs.append((slot, slot))
    return (runs if len(runs) <= MAX_RANGES else None), absent


def rows_in(rows: DataFrame, tree: DigestTree, slots: DataFrame) -> DataFrame:
    """The rows in ``slots``.

    A few runs of slots become comparisons on the key, which reach the scan and skip files
    and row groups; many slots are joined.
    """
    runs, absent = _ranges(slots)
    if runs is None:
        wanted = slots.select(F.col("node").alias("_slot"))
        return rows.join(wanted, slot_of(tree.key, tree.width).eqNullSafe(F.col("_slot")), "left_semi")
    kind = rows.schema[tree.key].dataType
    bound = lambda value: F.lit(value).cast(kind)
    largest = {T.LongType: 1 << 63, T.IntegerType: 1 << 31, T.ShortType: 1 << 15, T.ByteType: 1 << 7}.get(type(kind))
    parts = []
    for low, high in runs:
        first, last = low * tree.width, (high + 1) * tree.width - 1
        if largest:
            first, last = max(first, -largest), min(last, largest - 1)
        parts.append((F.col(tree.key) >= bound(first)) & (F.col(tree.key) <= bound(last)))
    if absent:
        parts.append(F.col(tree.key).isNull())
    return rows.filter(reduce(or_, parts)) if parts else rows.limit(0)


def digest_differences(
    batch: DataFrame, stream: DataFrame, batch_tree: DigestTree, stream_tree: DigestTree
) -> DataFrame:
    """Rows that one side has more often than the other, as :func:`row_differences` finds them.

    Only rows in slots that differ are read. Rows of equal slots are taken to be equal: two
    sums of 64-bit hashes and the count agree.
    """
    slots = differing_slots(batch_tree, stream_tree)
    return row_differences(rows_in(batch, batch_tree, slots), rows_in(stream, stream_tree, slots))
