"""Merkle manifest of a dataset, kept as a postorder append log.

Leaves of a tree are numbered without gathering them. Builders take aligned runs of leaves,
so each builds whole subtrees, and append every node when its last child is in: children
come before parents, and a subtree is one stretch of the log, its root last. Where a node
lies follows from the sizes of the subtrees before it, so a proof finds a leaf's siblings by
arithmetic and reads them from the log.

A builder's stretch is a page of :data:`PAGE` leaves. The roots of a tree's pages are the
leaves of the next tier, until one page holds the rest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.llm.common import written

FAN_BITS, PAGE_LEVELS = 4, 2
FAN, PAGE = 1 << FAN_BITS, 1 << (FAN_BITS * PAGE_LEVELS)
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGEST, HEX = 32, 64
TRAIL = "places array<int>, runs array<string>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- addresses ------------------------------------------------------------------------


def leaf_position(i: int) -> int:
    """Where leaf ``i`` lies: behind a whole subtree for each unit of each of its digits."""
    out, size = 0, 1
    while i:
        i, digit = divmod(i, FAN)
        out += digit * size
        size = size * FAN + 1
    return out


def count_at(level: int, n: int) -> int:
    """Nodes of a level of a tree with ``n`` leaves."""
    return -(-n >> (FAN_BITS * level))


def subtree_size(level: int, j: int, n: int) -> int:
    """Nodes below and with node ``j`` of a level; less than the whole only at the right edge."""
    out = 0
    for below in range(level + 1):
        width = FAN ** (level - below)
        out += min((j + 1) * width, count_at(below, n)) - j * width
    return out


def node_position(level: int, j: int, n: int) -> int:
    return leaf_position(j << (FAN_BITS * level)) + subtree_size(level, j, n) - 1


def height(n: int) -> int:
    """Levels above the leaves until one node is left."""
    level = 0
    while count_at(level, n) > 1:
        level += 1
    return level


# --- builders -------------------------------------------------------------------------


def append_nodes(leaves: Sequence[str], levels: int) -> list[str]:
    """All nodes of a subtree in the order in which they are complete."""
    log: list[str] = []
    runs: list[list[str]] = [[] for _ in range(levels + 1)]

    def append(node: str, level: int) -> None:
        log.append(node)
        runs[level].append(node)
        if level < levels and len(runs[level]) == FAN:
            close(level)

    def close(level: int) -> None:
        node = digest("".join(runs[level]))
        runs[level].clear()
        append(node, level + 1)

    for leaf in leaves:
        append(leaf, 0)
    for level in range(levels):
        if runs[level]:
            close(level)
    return log


def page_levels(n: int) -> int:
    """Levels that a page adds: all that are left if it is the tree's only one."""
    return PAGE_LEVELS if n > PAGE else height(n)


def _grow(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("i")
    n = rows["n"][0].as_py()
    log = append_nodes(rows["digest"].to_pylist(), page_levels(n))
    columns = {
        "tree": pa.array([rows["tree"][0].as_py()], pa.string()),
        "block": pa.array([rows["block"][0].as_py()], pa.int64()),
        "n": pa.array([n], pa.int64()),
        "held": pa.array([rows.num_rows], pa.int32()),
        "root": pa.array([log[-1]], pa.string()),
        "log": pa.array([bytes.fromhex("".join(log))], pa.binary()),
    }
    return pa.table(columns)


def _block() -> Column:
    return F.shiftright("i", FAN_BITS * PAGE_LEVELS)


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``i``, the place in its ``tree`` by ``order``, and ``n``, the tree's rows.

    Rows are partitioned by ranges, sorted there and written with a running number; a tree's
    counts of each partition, added up, give what lies ahead. ``order`` must part copies of
    a row, so that no range has to hold them all.
    """
    placed = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = written(placed.withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    placed = placed.withColumn("part", F.shiftright("at", 33))
    runs = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    ahead = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("tree").alias("r_tree"),
        F.col("part").alias("r_part"),
        (F.coalesce(F.sum("rows").over(ahead), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(Window.partitionBy("tree")).alias("n"),
    )
    joined = placed.join(runs, (F.col("tree") == F.col("r_tree")) & (F.col("part") == F.col("r_part")))
    return joined.withColumn("i", F.col("at") + F.col("shift")).drop("at", "part", "r_tree", "r_part", "shift")


@dataclass
class Log:
    """Pages of all trees, the leaves' tier first, and ``(tree, subroot)``."""

    tiers: list[DataFrame]
    roots: DataFrame


def build(leaves: DataFrame) -> Log:
    """The log over ``(tree, i, n, digest)``; no tree is gathered, whatever its size."""
    tiers: list[DataFrame] = []
    level = leaves.select("tree", "i", "n", "digest")
    while True:
        kind = "tree string, block long, n long, held int, root string, log binary"
        pages = level.withColumn("block", _block()).groupBy("tree", "block").applyInArrow(_grow, kind)
        pages = written(pages, "merkle-log")
        tiers.append(pages)
        rest = pages.where(F.col("n") > PAGE)
        if rest.isEmpty():
            break
        level = rest.select(
            "tree", F.col("block").alias("i"), F.ceil(F.col("n") / PAGE).cast("long").alias("n"), F.col("root").alias("digest")
        )
    roots = None
    for pages in tiers:
        some = pages.where(F.col("n") <= PAGE).select("tree", F.col("root").alias("subroot"))
        roots = some if roots is None else roots.unionByName(some)
    return Log(tiers, roots)


def append_log(log: Log) -> DataFrame:
    """``(tree, position, digest)``: every node at its place in its tree's postorder."""
    out = None
    sizes = log.tiers[0].groupBy(F.col("tree").alias("s_tree")).agg(F.max("n").alias("leaves"))
    for tier, pages in enumerate(log.tiers):

        def run(batches: Iterator[pa.RecordBatch], tier: int = tier) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for tree, block, n, held, nodes, leaves in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                    places, found = [], []
                    for level in range(min(1, tier), page_levels(n) + 1):
                        for j in range(count_at(level, held)):
                            own = DIGEST * node_position(level, j, held)
                            across = (block << (FAN_BITS * (PAGE_LEVELS - level))) + j
                            places.append(node_position(tier * PAGE_LEVELS + level, across, leaves))
                            found.append(nodes[own : own + DIGEST].hex())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tree] * len(places), pa.string()), pa.array(places, pa.int64()), pa.array(found, pa.string())],
                        ["tree", "position", "digest"],
                    )

        joined = pages.join(sizes, F.col("tree") == F.col("s_tree")).select("tree", "block", "n", "held", "log", "leaves")
        rows = joined.mapInArrow(run, "tree string, position long, digest string")
        out = rows if out is None else out.unionByName(rows)
    return out


# --- proofs ---------------------------------------------------------------------------


def page_runs(log: bytes, held: int, n: int) -> list[list[str]]:
    """For each level of a page below its root, the runs of siblings, read from the log by their positions."""
    out = []
    for level in range(page_levels(n)):
        places = (node_position(level, j, held) * DIGEST for j in range(count_at(level, held)))
        nodes = [log[p : p + DIGEST].hex() for p in places]
        out.append(["".join(nodes[a : a + FAN]) for a in range(0, len(nodes), FAN)])
    return out


def trail_of(x: int, runs: list[list[str]]) -> Iterator[tuple[int, str]]:
    """From leaf ``x`` of a page up: its place in its run and the run."""
    for level, row in enumerate(runs):
        j = x >> (FAN_BITS * level)
        yield j % FAN, row[j // FAN]


def others(place: int, run: str) -> tuple[str, str]:
    """The siblings before and after a place."""
    return run[: HEX * place], run[HEX * (place + 1) :]


def fold(leaf: str, trail: Sequence[tuple[int, str]]) -> str:
    """The root that ``leaf`` leads to among the siblings of a trail."""
    for place, run in trail:
        before, after = others(place, run)
        leaf = digest(before + leaf + after)
    return leaf


def _spread(pages: DataFrame) -> DataFrame:
    """``(tree, i, places, runs)`` for each leaf of the pages, whose own trail goes on behind it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, block, n, held, log, places, runs in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                own = page_runs(log, held, n)
                trails = [list(trail_of(x, own)) for x in range(held)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([tree] * held, pa.string()),
                        pa.array(range(block * PAGE, block * PAGE + held), pa.int64()),
                        pa.array([[p for p, _ in t] + places for t in trails], pa.list_(pa.int32())),
                        pa.array([[r for _, r in t] + runs for t in trails], pa.list_(pa.string())),
                    ],
                    ["tree", "i", "places", "runs"],
                )

    chosen = pages.select("tree", "block", "n", "held", "log", "places", "runs")
    return chosen.mapInArrow(run, f"tree string, i long, {TRAIL}")


def page_trails(log: Log, above: DataFrame) -> DataFrame:
    """Pages of the first tier, each with the trail of its root; ``above`` has the trees' (``tree``, ``places``, ``runs``)."""
    tops = above.select(F.col("tree").alias("a_tree"), "places", "runs")
    lower: DataFrame | None = None
    for pages in reversed(log.tiers):
        trailed = pages.where(F.col("n") <= PAGE).join(tops, F.col("tree") == F.col("a_tree")).drop("a_tree")
        if lower is not None:
            up = lower.select(F.col("tree").alias("u_tree"), F.col("i").alias("u_i"), "places", "runs")
            same = (F.col("tree") == F.col("u_tree")) & (F.col("block") == F.col("u_i"))
            trailed = trailed.unionByName(pages.where(F.col("n") > PAGE).join(up, same).drop("u_tree", "u_i"))
        if pages is log.tiers[0]:
            return trailed
        lower = written(_spread(trailed), "merkle-trails")
    raise ValueError("a log has at least one tier")


def _prover(depth: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Proofs of a page's leaves; the last ``depth`` steps of a trail lie above the trees' own roots."""
    names = ["key", "leaf", "subroot", "proof_sha256", "folded_root"]

    def run(leaves: pa.Table, page: pa.Table) -> pa.Table:
        if not leaves.num_rows or not page.num_rows:
            return pa.table([leaves["key"].slice(0, 0), *[pa.array([], pa.string())] * 4], names=names)
        leaves = leaves.sort_by("i")
        row = {name: page[name][0].as_py() for name in ("block", "n", "held", "root", "log", "places", "runs")}
        runs = page_runs(row["log"], row["held"], row["n"])
        above = list(zip(row["places"], row["runs"], strict=True))
        above_others = "".join("".join(others(*step)) for step in above)
        subroot = fold(row["root"], above[: len(above) - depth])
        proofs, folded = [], []
        for i, changed in zip(leaves["i"].to_pylist(), leaves["changed"].to_pylist(), strict=True):
            own = list(trail_of(i - row["block"] * PAGE, runs))
            proofs.append(digest("".join("".join(others(*step)) for step in own) + above_others))
            folded.append(fold(changed, own + above))
        columns = [[subroot] * len(proofs), proofs, folded]
        return pa.table([leaves["key"], leaves["digest"], *[pa.array(c, pa.string()) for c in columns]], names=names)

    return run


# --- the manifest of a table ----------------------------------------------------------


def field(value: Column) -> Column:
    """A value as its length in bytes, a colon and its text; ``-`` for null."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def prove(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    key: str = "doc_id",
    group: str = "source",
    altered: Mapping[str, Column] | None = None,
    where: Column | None = None,
    log_to: Callable[[Log], None] | None = None,
) -> DataFrame:
    """``(key, leaf, subroot, root, proof_sha256, folded_root, verified)`` for every row.

    A row's leaf hashes its ``fields``. The rows of a ``group`` in the order of ``key`` are the
    leaves of a tree; the groups in bytewise order, null first, are those of the tree above.
    ``folded_root`` is what a row leads to with its original siblings once the columns in
    ``altered`` are replaced (in rows that ``where`` holds for; all if None), and ``verified``
    whether that is the root. ``log_to`` is given the log of the groups' trees.

    A null key comes first and is never altered by a condition that is null for it. Rows that
    repeat a key are leaves of their own, by the order of their leaf. Null and empty texts
    have different leaves. Other columns are not read. An empty table has no root and gives
    no rows. A group is built and proven page by page; no task holds more.
    """
    changes = dict(altered or {})
    if where is not None:
        kept = F.coalesce(where, F.lit(False))
        changes = {name: F.when(kept, value).otherwise(F.col(name)) for name, value in changes.items()}
        touched = kept
    else:
        touched = F.lit(bool(changes))
    leaf = leaf_digest([F.col(f) for f in fields])
    other = leaf_digest([changes.get(f, F.col(f)) for f in fields])
    named = F.col(group).cast("string")
    rows = docs.select(
        F.col(key).alias("key"),
        # Bytewise before all others, as null is to be.
        F.when(named.isNull(), "").otherwise(F.concat(F.lit("+"), named)).alias("tree"),
        leaf.alias("digest"),
        F.when(touched, other).alias("other"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = written(rows.withColumn("changed", F.coalesce("other", "digest")).drop("other"), "merkle-leaves")
    leaves = written(numbered(rows, ["key", "digest", "row"]), "merkle-numbered")
    log = build(leaves)
    if log_to is not None:
        log_to(log)
    tops = log.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("digest"))
    tops = written(numbered(tops, ["name"]), "merkle-groups")
    crown = build(tops)
    first = tops.first()
    root = crown.roots.first()["subroot"] if first else None
    nothing = docs.sparkSession.createDataFrame([("", [], [])], f"tree string, {TRAIL}")
    trails = _spread(page_trails(crown, nothing)).select(F.col("i").alias("t_i"), "places", "runs")
    above = written(tops.join(trails, F.col("i") == F.col("t_i")).select(F.col("name").alias("tree"), "places", "runs"), "merkle-above")
    kind = docs.schema[key].dataType.simpleString()
    proven = (
        leaves.withColumn("block", _block())
        .groupBy("tree", "block")
        .cogroup(page_trails(log, above).groupBy("tree", "block"))
        .applyInArrow(
            _prover(height(first["n"]) if first else 0),
            f"key {kind}, leaf string, subroot string, proof_sha256 string, folded_root string",
        )
    )
    top = F.lit(root).cast("string")
    return proven.select(
        F.col("key").alias(key), "leaf", "subroot", top.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == top).alias("verified")
    )
