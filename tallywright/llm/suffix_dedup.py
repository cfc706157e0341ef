"""Removal of repeated byte strings by sorting suffixes.

A string of ``length`` bytes that starts at two places of the corpus is repeated. Every
string has an anchor, the least hash among its ``k``-byte pieces, so equal strings have
equal anchors, and neighbouring starts mostly share one: they make an interval. Anchors
that occur once are done with. Of the intervals that share an anchor, those with the same
bytes are counted, and the different ones are sorted by their suffixes; a start is
repeated if its suffix and one beside it in the order begin with the same ``length`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import tidy, written
from tallywright.llm.suffix_sort import suffix_arrays

LENGTH, PIECE = 200, 51
#: Starts handled at once; with what a string reaches beyond, places fit in 16 bits.
CHUNK = 48_000
#: Different intervals of one anchor that are sorted together; beyond, strings are counted.
MAX_SORTED = 16
#: Symbols sorted in step.
BATCH_SYMBOLS = 1_500_000
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=4)
def _tables(size: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte, and the powers of a base modulo 2**64 with their inverses."""
    rng = np.random.RandomState(seed)
    numbers = rng.randint(0, 1 << 32, 256, dtype=np.uint64) << np.uint64(32) | rng.randint(0, 1 << 32, 256, dtype=np.uint64)
    base = BASE + np.uint64(2 * seed)
    powers = np.full(size, base)
    powers[0] = 1
    inverse = pow(int(base), -1, 1 << 64)
    back = np.full(size, np.uint64(inverse))
    back[0] = 1
    return numbers, np.cumprod(powers), np.cumprod(back)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * MIX
    return x ^ (x >> np.uint64(29))


class Hashes:
    """64-bit hashes of any part of one byte string."""

    def __init__(self, data: np.ndarray, seed: int = 1):
        size = 1 << max(12, int(len(data)).bit_length())
        numbers, powers, self.back = _tables(size, seed)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(numbers[data] * powers[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[ends] - self.sums[starts]) * self.back[starts])

    def rolling(self, width: int) -> np.ndarray:
        count = len(self.sums) - width
        return _mixed((self.sums[width:] - self.sums[:count]) * self.back[:count])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours: a running least to each side of block borders."""
    blocks = -(-len(values) // width) + 1
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def intervals(text: bytes, length: int = LENGTH, piece: int = PIECE) -> list[tuple[np.ndarray, ...]]:
    """Arrays ``(anchor, content, start, n)``: ``n`` starts from ``start`` on share an anchor.

    ``content`` hashes the bytes their strings cover. Long texts go in chunks, which may
    split an interval; nothing else depends on where they begin.
    """
    out = []
    whole = np.frombuffer(text, dtype=np.uint8)
    for begin in range(0, len(whole) - length + 1, CHUNK):
        data = whole[begin : begin + CHUNK + length - 1]
        hashes = Hashes(data)
        pieces = hashes.rolling(piece)
        ranked = (pieces & np.uint64(0xFFFFFFFFFFFF0000)) | np.arange(len(pieces), dtype=np.uint64)
        least = _sliding_least(ranked, length - piece + 1)
        place = (least & np.uint64(0xFFFF)).astype(np.int64)
        starts = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
        sizes = np.diff(np.append(starts, len(place)))
        content = hashes.of(starts, starts + sizes + (length - 1))
        out.append((pieces[place[starts]].view(np.int64), content.view(np.int64), starts + begin, sizes))
    return out


def repeated_starts(groups: list[list[bytes]], length: int = LENGTH) -> list[list[np.ndarray]]:
    """For each group of byte strings and each string: which starts of ``length`` bytes recur in the group."""
    symbols, lengths, opens, spans = [], [], [], []
    at = 0
    for group in groups:
        parts = []
        for data in group:
            opens.append(at + sum(map(len, parts)))
            spans.append(len(data) - length + 1)
            parts += [np.frombuffer(data, np.uint8).astype(np.int16) + 2, np.ones(1, np.int16)]
        parts[-1] = np.zeros(1, np.int16)
        symbols += parts
        lengths.append(sum(map(len, parts)))
        at += lengths[-1]
    flat = np.concatenate(symbols)
    order, _ = suffix_arrays(flat, np.array(lengths))
    whole = np.zeros(len(flat), dtype=bool)
    for start, span in zip(opens, spans, strict=True):
        whole[start : start + max(0, span)] = True
    # Suffixes of one string group stand together, so neighbours of two groups are never alike:
    # between them stands the suffix that is the 0 alone.
    one, two = order[:-1], order[1:]
    alike = np.flatnonzero(whole[one] & whole[two])
    for offset in range(length):
        alike = alike[flat[one[alike] + offset] == flat[two[alike] + offset]]
        if not len(alike):
            break
    found = np.zeros(len(flat), dtype=bool)
    found[one[alike]] = True
    found[two[alike]] = True
    marks = iter([found[start : start + max(0, span)] for start, span in zip(opens, spans, strict=True)])
    return [[next(marks) for _ in group] for group in groups]


def _runs(mask: np.ndarray) -> np.ndarray:
    """Flat ``start, end, start, end ...`` of the true stretches."""
    edges = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.column_stack([np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)]).ravel().astype(np.int32)


def _intervals_of(rows: DataFrame, length: int, piece: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                took, made = [], []
                for i, text in enumerate(part.column(2).to_pylist()):
                    for chunk in intervals(text, length, piece):
                        took.append(np.full(len(chunk[0]), i))
                        made.append(chunk)
                if not made:
                    continue
                rows_of = pa.array(np.concatenate(took))
                anchor, content, at, n = (np.concatenate(x) for x in zip(*made, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor),
                        pa.array(content),
                        part.column(0).take(rows_of),
                        part.column(1).take(rows_of),
                        pa.array(at.astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                    ],
                    ["anchor", "content", "doc_id", "row_key", "start", "n"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run, _tables.cache_clear), f"anchor long, content long, doc_id {kind}, row_key long, start int, n int")


def _with_bytes(wanted: DataFrame, rows: DataFrame, length: int) -> DataFrame:
    """``(anchor, content, hot, body)`` of the intervals in ``wanted``, whose texts are in ``rows``."""
    listed = wanted.groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("anchor", "content", "hot", "start", "n")).alias("parts"))
    listed = listed.select(F.col("doc_id").alias("w_id"), F.col("row_key").alias("w_key"), "parts")
    joined = rows.join(listed, (F.col("row_key") == F.col("w_key")) & F.col("doc_id").eqNullSafe(F.col("w_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                lists = part.column(1)
                fields = lists.flatten()
                owner = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                texts = part.column(0).to_pylist()
                at, n = fields.field("start").to_numpy(), fields.field("n").to_numpy()
                bodies = [texts[i][a : a + m + length - 1] for i, a, m in zip(owner, at, n, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [fields.field("anchor"), fields.field("content"), fields.field("hot"), pa.array(bodies, pa.binary())],
                    ["anchor", "content", "hot", "body"],
                )

    return joined.select("body", "parts").mapInArrow(tidy(run), "anchor long, content long, hot boolean, body binary")


def _sorted_marks(bodies: DataFrame, length: int) -> DataFrame:
    """``(anchor, content, runs)`` from groups of one anchor, which are small and come together."""
    dealt = bodies.repartition("anchor").sortWithinPartitions("anchor", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[list[tuple[int, int]]] = []
        groups: list[list[bytes]] = []
        held, last = 0, None

        def flush() -> pa.RecordBatch:
            # Strings of like length go in step.
            by = sorted(range(len(groups)), key=lambda i: sum(map(len, groups[i])))
            anchors, contents, runs = [], [], []
            marks = repeated_starts([groups[i] for i in by], length)
            for i, found in zip(by, marks, strict=True):
                for (anchor, content), mask in zip(keys[i], found, strict=True):
                    if mask.any():
                        anchors.append(anchor)
                        contents.append(content)
                        runs.append(_runs(mask))
            return pa.RecordBatch.from_arrays(
                [pa.array(anchors, pa.int64()), pa.array(contents, pa.int64()), pa.array(runs, pa.list_(pa.int32()))],
                ["anchor", "content", "runs"],
            )

        for batch in batches:
            for anchor, content, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if anchor != last:
                    if held >= BATCH_SYMBOLS:
                        yield flush()
                        keys, groups, held = [], [], 0
                    keys.append([])
                    groups.append([])
                    last = anchor
                if keys[-1] and keys[-1][-1] == (anchor, content):
                    continue  # a row that another repeats
                keys[-1].append((anchor, content))
                groups[-1].append(body)
                held += len(body)
        if groups:
            yield flush()

    return dealt.select("anchor", "content", "body").mapInArrow(tidy(run), "anchor long, content long, runs array<int>")


def _counted_marks(bodies: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many different intervals: every string for itself.

    Strings are counted by two 64-bit hashes in partial aggregates, so no group is gathered.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, content, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                data = np.frombuffer(body, np.uint8)
                one, two = Hashes(data, 1).rolling(length), Hashes(data, 2).rolling(length)
                count = len(one)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(count, anchor)),
                        pa.array(np.full(count, content)),
                        pa.array(np.arange(count, dtype=np.int32)),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                    ],
                    ["anchor", "content", "at", "one", "two"],
                )

    strings = bodies.select("anchor", "content", "body").distinct()
    strings = written(strings.mapInArrow(tidy(run, _tables.cache_clear), "anchor long, content long, at int, one long, two long"), "repeat-strings")
    again = strings.groupBy("one", "two").count().where("count > 1").select(F.col("one").alias("x"), F.col("two").alias("y"))
    hits = strings.join(again, (F.col("one") == F.col("x")) & (F.col("two") == F.col("y")), "left_semi")
    runs = F.flatten(F.collect_list(F.array("at", (F.col("at") + 1).cast("int"))))
    return hits.groupBy("anchor", "content").agg(runs.alias("runs"))


def repeated_spans(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    piece: int = PIECE,
    max_sorted: int = MAX_SORTED,
) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)`` for every row.

    ``spans`` are the maximal runs of bytes covered by strings of ``length`` bytes that
    start anywhere else as well, as structs ``begin, end`` in bytes; ``kept`` is the rest
    of the text, as bytes. Strings are judged on the input. Null counts as empty, and texts
    under ``length`` bytes lose nothing. Rows that repeat another, id included, are texts of
    their own: both lose what they share. Other columns are not read.

    Intervals are counted by anchor in partial aggregates, and those of anchors met once go
    before anything else is moved. Of equal intervals one stands for all, so groups of
    copies cost as much as their rows. Anchors with more than ``max_sorted`` different
    intervals are not cut but judged string by string. Texts are moved twice: those with
    intervals to be sorted, and all of them to their spans.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(doc_id), F.col(text)).alias("row_key"), body.alias("body"))
    long_rows = rows.where(F.octet_length("body") >= length)
    every = _intervals_of(long_rows, length, piece)
    again = every.groupBy("anchor").count().where("count > 1").select(F.col("anchor").alias("met"))
    found = written(every.join(again, F.col("anchor") == F.col("met"), "left_semi"), "repeat-intervals")

    kinds = found.groupBy("anchor", "content").agg(
        F.count("*").alias("copies"), F.min(F.struct("row_key", "start", "doc_id", "n")).alias("one")
    )
    kinds = written(kinds, "repeat-kinds")
    crowd = kinds.groupBy("anchor").agg(F.count("*").alias("different")).where("different > 1")
    crowd = crowd.select(F.col("anchor").alias("met"), (F.col("different") > max_sorted).alias("hot"))
    wanted = kinds.join(crowd, F.col("anchor") == F.col("met")).select("anchor", "content", "hot", "one.*")
    bodies = written(_with_bytes(wanted, long_rows, length), "repeat-bodies")
    marks = _sorted_marks(bodies.where("NOT hot"), length).unionByName(_counted_marks(bodies.where("hot"), length))
    whole = kinds.where("copies > 1").select("anchor", "content", F.lit(None).cast("array<int>").alias("runs"))
    single = kinds.where("copies = 1").select(F.col("anchor").alias("k_anchor"), F.col("content").alias("k_content"))
    marks = marks.join(single, (F.col("anchor") == F.col("k_anchor")) & (F.col("content") == F.col("k_content")), "left_semi")
    marks = written(marks.unionByName(whole), "repeat-marks").withColumnsRenamed({"anchor": "m_anchor", "content": "m_content"})
    hits = found.join(marks, (F.col("anchor") == F.col("m_anchor")) & (F.col("content") == F.col("m_content")))
    listed = hits.groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("start", "n", "runs")).alias("marks"))
    listed = listed.select(F.col("doc_id").alias("l_id"), F.col("row_key").alias("l_key"), "marks")
    joined = rows.join(listed, (F.col("row_key") == F.col("l_key")) & F.col("doc_id").eqNullSafe(F.col("l_id")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                sizes, spans, kept = [], [], []
                for data, marks in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    edges = cover(len(data), marks or [], length)
                    sizes.append(len(data))
                    spans.append([{"begin": a, "end": b} for a, b in edges])
                    kept.append(b"".join(data[a:b] for a, b in zip([0, *(e for _, e in edges)], [*(s for s, _ in edges), len(data)], strict=True)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "spans", "kept"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.select("doc_id", "body", "marks").mapInArrow(
        tidy(run), f"doc_id {kind}, n_bytes long, spans array<struct<begin: long, end: long>>, kept binary"
    )


def cover(size: int, marks: list[dict], length: int = LENGTH) -> list[tuple[int, int]]:
    """The stretches of a text of ``size`` bytes that the marked strings cover."""
    if not marks:
        return []
    change = np.zeros(size + 1, dtype=np.int32)
    for mark in marks:
        start, runs = mark["start"], mark["runs"]
        if runs is None:
            runs = (0, mark["n"])
        for a, b in zip(runs[::2], runs[1::2], strict=True):
            change[start + a] += 1
            change[start + b + length - 1] -= 1
    edges = _runs(np.cumsum(change[:-1]) > 0).tolist()
    return list(zip(edges[::2], edges[1::2], strict=True))
