"""MinHash near-dedup with circulant signatures, banding and exact verification.

Two permutations make all coordinates of a signature: the first spreads shingles over a
universe of positions, the second gives each position its value, and coordinate ``k`` is
the least value of the positions shifted by ``k`` around the universe.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import components, tidy, written
from tallywright.llm.shingles import forget_words, shingle_set, similar

BANDS, ROWS, UNIVERSE_BITS, SEED = 32, 4, 20, 7
#: Coordinates, of which the first go into bands, and the part of them alike that a pair needs.
COORDINATES, ESTIMATE = 1024, 0.67
#: Members of a bucket that meet in one task are at most about twice as many.
BLOCK = 256
FIRST = np.uint64(0xA24BAED4963EE407)
BAND_BASE = np.uint64(0x9FB21C651E98DF25)
ROWS_A_BATCH = 1024
SHINGLES_AT_ONCE = 2_048


@lru_cache(maxsize=2)
def circulant(bits: int, size: int, seed: int) -> np.ndarray:
    """Row ``i`` holds the second permutation's values from position ``i`` on, ``size`` of them."""
    values = np.random.RandomState(seed).permutation(1 << bits).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([values, values[: size - 1]]), size)


def signature(shingles: np.ndarray, size: int, bits: int = UNIVERSE_BITS, seed: int = SEED) -> np.ndarray:
    """``size`` coordinates; equal ones between two sets tell their Jaccard similarity."""
    at = ((shingles * FIRST) >> np.uint64(64 - bits)).astype(np.int64)
    shifted = circulant(bits, size, seed)
    least = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(at), SHINGLES_AT_ONCE):
        np.minimum(least, shifted[at[start : start + SHINGLES_AT_ONCE]].min(axis=0), out=least)
    return least


def band_hashes(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash a band, its number mixed in."""
    out = np.arange(1, bands + 1, dtype=np.uint64) * FIRST
    for row in coordinates.reshape(bands, rows).T.astype(np.uint64):
        out = (out ^ row) * BAND_BASE
        out ^= out >> np.uint64(32)
    return out.view(np.int64)


def packed(coordinates: np.ndarray) -> bytes:
    """Four bits of each coordinate, two to a byte."""
    low = coordinates.astype(np.uint8) & 15
    return (low[::2] | low[1::2] << 4).tobytes()


def alike(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """The part of coordinates that each packed row shares with ``one``, less what four bits share by chance."""
    differ = rows ^ one
    same = ((differ & 15) == 0).mean(axis=1) / 2 + ((differ & 240) == 0).mean(axis=1) / 2
    return (same - 1 / 16) / (1 - 1 / 16)


def sketches(docs: DataFrame, width: int, bands: int, rows: int, coordinates: int, bits: int, seed: int) -> DataFrame:
    """``(doc_id, n_shingles, digest, bands, sketch, marks)``: set size, MD5 of the set,
    hashes of its bands, its coordinates :func:`packed`, half of each band's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_A_BATCH):
                part = batch.slice(start, ROWS_A_BATCH)
                sizes, digests, made, low, marks = [], [], [np.empty(0, np.int64)], [], []
                for text in part.column(1).to_pylist():
                    found = shingle_set(text, width)
                    sizes.append(len(found))
                    if not len(found):
                        digests.append(None)
                        low.append(None)
                        marks.append(None)
                        continue
                    digests.append(hashlib.md5(found.tobytes()).digest())
                    values = signature(found, coordinates, bits, seed)
                    made.append(band_hashes(values[: bands * rows], bands, rows))
                    low.append(packed(values))
                    marks.append(made[-1].astype(np.int32).tobytes())
                ends = np.concatenate([[0], np.cumsum([bands if n else 0 for n in sizes])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.ListArray.from_arrays(ends, np.concatenate(made)),
                        pa.array(low, pa.binary()),
                        pa.array(marks, pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "digest", "bands", "sketch", "marks"],
                )

    kind = "doc_id long, n_shingles long, digest binary, bands array<long>, sketch binary, marks binary"
    return docs.mapInArrow(tidy(run, forget_words, circulant.cache_clear), kind)


def across_parts(members: DataFrame, percent: int, estimate: float, block: int) -> DataFrame:
    """Pairs (``a``, ``b``) of one bucket and different parts that may be similar enough.

    ``members`` has ``band, rep, n, part, sketch, marks``. A bucket's members are dealt to blocks
    by a hash, and every two blocks meet in one task, so no task gets a whole bucket. A pair
    goes on if the set sizes allow it and ``estimate`` of the coordinates are alike, once
    only: from the first band that it shares.
    """
    sizes = members.groupBy("band").agg(F.count("*").alias("size"), F.min("part").alias("low"), F.max("part").alias("high"))
    sizes = sizes.where("low < high").select(F.col("band").alias("bucket"), F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    dealt = members.join(sizes, F.col("band") == F.col("bucket"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "n", "part", "sketch", "marks")
    dealt = dealt.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "rep")

    def compare(group: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        i, j = group[0][1], group[0][2]
        block_, rep, n, part = (np.array([row[k] for row in group], dtype=np.int64) for k in (3, 4, 5, 6))
        sketch = np.frombuffer(b"".join(row[7] for row in group), dtype=np.uint8).reshape(len(group), -1)
        marks = np.frombuffer(b"".join(row[8] for row in group), dtype=np.int32).reshape(len(group), -1)
        here = np.array(group[0][0], dtype=np.int64).astype(np.int32)
        left, right = np.flatnonzero(block_ == i), np.flatnonzero(block_ == j)
        out_a, out_b = [], []
        for at in left:
            them = right[(part[right] != part[at]) & (100 * np.minimum(n[right], n[at]) >= percent * np.maximum(n[right], n[at]))]
            if i == j:
                them = them[them > at]
            them = them[alike(sketch[them], sketch[at]) >= estimate]
            shared = marks[them] == marks[at]
            them = them[marks[at][shared.argmax(axis=1)] == here]
            out_a.append(np.full(len(them), rep[at]))
            out_b.append(rep[them])
        one, two = np.concatenate(out_a) if out_a else rep[:0], np.concatenate(out_b) if out_b else rep[:0]
        return np.minimum(one, two), np.maximum(one, two)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(group: list[tuple]) -> pa.RecordBatch:
            one, two = compare(group)
            return pa.RecordBatch.from_arrays([pa.array(one), pa.array(two)], ["a", "b"])

        group: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns)), strict=True):
                if group and row[:3] != group[-1][:3]:
                    yield flush(group)
                    group = []
                group.append(row)
        if group:
            yield flush(group)

    return dealt.mapInArrow(tidy(run), "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``) whose whole sets are similar enough."""
    first = texts.select(F.col("doc_id").alias("a_id"), F.col("text").alias("a_text"))
    second = texts.select(F.col("doc_id").alias("b_id"), F.col("text").alias("b_text"))
    joined = pairs.join(first, F.col("a") == F.col("a_id")).join(second, F.col("b") == F.col("b_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for batch in batches:
            a, b, left, right = (batch.column(i) for i in range(4))
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                text = left[i].as_py()
                if text != last:
                    last, last_set = text, shingle_set(text, width)
                keep[i] = similar(last_set, shingle_set(right[i].as_py(), width), percent)
            chosen = pa.array(keep)
            yield pa.RecordBatch.from_arrays([a.filter(chosen), b.filter(chosen)], ["a", "b"])

    return joined.select("a", "b", "a_text", "b_text").mapInArrow(tidy(run, forget_words), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 75,
    bands: int = BANDS,
    rows: int = ROWS,
    coordinates: int = COORDINATES,
    estimate: float = ESTIMATE,
    block: int = BLOCK,
    bits: int = UNIVERSE_BITS,
    seed: int = SEED,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row; the smallest id of a component stays.

    Documents are linked if their whole sets of ``width``-word shingles have a Jaccard
    similarity of ``percent`` hundredths or more. Two that reach it share no band with a
    probability of at most ``(1 - 0.75 ** rows) ** bands``, five in a million as set.

    Equal sets are one class, whose smallest id stands for it. In a band's bucket every
    member is first held against the bucket's smallest, which is linear in its size, and
    the links that hold are united. Then only members of different components are held
    against each other, by their sketches and in blocks, so a large group of near copies is
    never written out as pairs; at the threshold about one pair in twenty million falls below
    ``estimate`` by its 1,024 coordinates, far fewer than banding misses. No bucket is cut. Links are confirmed on the texts, which are taken once, and only of
    documents that share a bucket with others.

    Null and empty texts have no shingles and are linked with nothing. Rows that repeat an
    id are one document, linked by any of its texts. Rows without an id are linked with
    nothing, have no component and stay. Other columns are not read. The result of an
    empty table is empty.
    """
    rows_in = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    even = max(coordinates, bands * rows) + 1 & ~1
    sketched = written(sketches(rows_in, width, bands, rows, even, bits, seed), "near-sketches")
    usable = sketched.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = written(
        usable.groupBy("digest").agg(F.min("doc_id").alias("rep")).select(F.col("digest").alias("class_digest"), "rep"),
        "near-classes",
    )
    stands = usable.join(classes, (F.col("digest") == F.col("class_digest")) & (F.col("doc_id") == F.col("rep")))
    members = stands.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    crowded = members.groupBy("band").agg(F.min("rep").alias("leader"), F.max("rep").alias("other"))
    crowded = crowded.where("leader < other").select(F.col("band").alias("bucket"), "leader")
    members = written(members.join(crowded, F.col("band") == F.col("bucket")).select("band", "rep", "n", "leader"), "near-buckets")

    met = members.select(F.col("rep").alias("met_id")).distinct()
    texts = written(rows_in.join(met, F.col("doc_id") == F.col("met_id"), "left_semi"), "near-texts")
    stars = members.where("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    stars = written(stars, "near-stars")
    links = written(verified(stars, texts, width, percent), "near-links")

    found = components(met.select(F.col("met_id").alias("node")), links, "near")
    found = written(found.select(F.col("node").alias("m_node"), F.col("component").alias("part")), "near-parts")
    placed = members.join(found, F.col("rep") == F.col("m_node")).select("band", "rep", "n", "part")
    mixed = placed.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    mixed = mixed.where("low < high").select(F.col("band").alias("bucket"))
    rest = written(placed.join(mixed, F.col("band") == F.col("bucket"), "left_semi"), "near-mixed")
    sketch = stands.select(F.col("rep").alias("s_rep"), "sketch", "marks").dropDuplicates(["s_rep"])
    rest = rest.join(sketch, F.col("rep") == F.col("s_rep")).drop("s_rep")
    across = across_parts(rest, percent, estimate, block).join(stars, ["a", "b"], "left_anti")
    links = links.unionByName(verified(written(across, "near-across"), texts, width, percent))

    final = components(met.select(F.col("met_id").alias("node")), written(links, "near-links"), "near")
    final = written(final.select(F.col("node").alias("f_node"), "component"), "near-components")
    by_class = classes.join(final, F.col("rep") == F.col("f_node"), "left").select(
        "class_digest", F.coalesce("component", "rep").alias("component_id")
    )
    out = sketched.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
    out = out.join(by_class, F.col("digest") == F.col("class_digest"), "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with exactly one row of each component, columns unchanged.

    Rows are judged one by one, by a number drawn for each and written with it, so repeated
    and null ids are no exception. The row with the smallest id stays, then the smallest number.
    """
    marked = written(docs.withColumn("__row", F.monotonically_increasing_id()), "near-rows")
    rows = marked.select("__row", F.col(text).alias("__text"))
    found = near_duplicates(rows, "__row", "__text", **options).select(F.col("doc_id").alias("__found"), "component_id")
    # A row alone in its component stays whatever its id.
    shared = found.groupBy(F.col("component_id").alias("part")).agg(F.count("*").alias("n")).where("n > 1")
    found = written(found.join(shared, F.col("component_id") == F.col("part")).select("__found", "part"), "near-shared")
    named = marked.select("__row", F.col(doc_id).alias("__id")).join(found, F.col("__row") == F.col("__found"))
    order = F.struct(F.col("__id").isNull().alias("absent"), F.col("__id").alias("id"), F.col("__row").alias("row"))
    stays = named.groupBy(F.col("part").alias("whole")).agg(F.min(order)["row"].alias("stay"))
    gone = found.join(stays, F.col("part") == F.col("whole")).where("__found <> stay").select(F.col("__found").alias("__gone"))
    return marked.join(written(gone, "near-gone"), F.col("__row") == F.col("__gone"), "left_anti").drop("__row")
