"""Alignment of the tokens of two vocabularies over the same bytes.

Both tokenizers spell a text out in bytes; where tokens of both end at one offset a group
ends, and all tokens of a group are linked. Most links are a token and its equal: a group of
one token each holds the same bytes, so the pair follows from the first id by an array made
once (the identity map). Those are counted in vectors as long as the vocabulary. Only pairs
of groups that are not one to one are counted by a shuffle, after each task has united
what it met.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.bpe import PATTERN, byte_of_char
from tallywright.llm.common import tidy, written

#: Links worked on at once; pairs a task holds before it hands them on; pairs of one broadcast.
LINKS_AT_ONCE, PAIRS_HELD, PAIRS_A_PASS = 1_000_000, 2_000_000, 4_000_000
ROWS_A_BATCH = 256
CHARS_AT_ONCE, LONG_RUN = 2_000_000, 1_000
SPACE = "▁"


@dataclass
class Spec:
    """Two tokenizer files, as their contents, and what a process makes of them once."""

    byte_level: str
    pieces: bytes
    made: Pair | None = field(default=None, compare=False)

    @classmethod
    def read(cls, byte_level: str, pieces: str) -> Spec:
        return cls(Path(byte_level).read_text(encoding="utf-8"), Path(pieces).read_bytes())

    def pair(self) -> Pair:
        if self.made is None:
            self.made = Pair(self)
        return self.made

    def __getstate__(self) -> dict:
        return self.__dict__ | {"made": None}


def _quick_encoder(model: dict, spell, special: set[str]) -> tiktoken.Encoding | None:
    """The same merges in a faster library, if every merge makes the token that its rank tells."""
    spelled = {spell(t): i for t, i in model["vocab"].items() if t not in special}
    size = len(spelled) - len(model["merges"])
    for rank, pair in enumerate(model["merges"]):
        if spelled.get(spell("".join(pair.split(" ") if isinstance(pair, str) else pair))) != size + rank:
            return None
    return tiktoken.Encoding("byte-level", pat_str=PATTERN.pattern, mergeable_ranks=spelled, special_tokens={})


def _has_long_run(text: str) -> bool:
    """Whether a run without, or of, white space is so long that the faster library would be the slower."""
    if len(text) < LONG_RUN:
        return False
    words = list(map(len, text.split()))
    return max(words, default=0) >= LONG_RUN or len(text) - sum(words) - len(words) >= LONG_RUN


class Pair:
    """Both tokenizers, the bytes of their tokens, and the identity map."""

    def __init__(self, spec: Spec):
        # Set before the library starts threads of its own: Spark places the work.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.exact = tokenizers.Tokenizer.from_str(spec.byte_level)
        self.exact.encode_special_tokens = True
        self.exact.no_padding()
        self.exact.no_truncation()
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=spec.pieces)
        chars = byte_of_char()
        spell = lambda text: bytes(map(chars.__getitem__, text)) if all(c in chars for c in text) else text.encode()
        vocabulary = self.exact.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for text, number in vocabulary.items():
            self.a_bytes[number] = spell(text)
        self.b_bytes = [self._piece(i) for i in range(self.pieces.get_piece_size())]
        plain = [i for i in range(len(self.b_bytes)) if not self.pieces.is_control(i) and not self.pieces.is_unknown(i)]
        own: dict[bytes, int] = {}
        for number in sorted(plain, key=self.pieces.is_byte):  # a byte stands for itself only where no piece does
            own.setdefault(self.b_bytes[number], number)
        #: The id of the second vocabulary with the same bytes, -1 if there is none.
        self.same = np.array([own.get(t, -1) if t else -1 for t in self.a_bytes], dtype=np.int64)
        self.a_size = np.array(list(map(len, self.a_bytes)), dtype=np.int64)
        self.b_size = np.array(list(map(len, self.b_bytes)), dtype=np.int64)
        self.a_names = [np.array([f"{i}{mark}" for i in range(len(self.a_bytes))], dtype=object) for mark in ",|"]
        self.b_names = [np.array([f"{i}{mark}" for i in range(len(self.b_bytes))], dtype=object) for mark in ",;"]
        special = {x.content for x in self.exact.get_added_tokens_decoder().values()}
        self.quick = _quick_encoder(json.loads(spec.byte_level)["model"], spell, special)

    def _piece(self, number: int) -> bytes:
        if self.pieces.is_byte(number):
            return bytes([int(self.pieces.id_to_piece(number)[3:5], 16)])
        return self.pieces.id_to_piece(number).replace(SPACE, " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ids of each text in both vocabularies; empty ones unless both spell a blank and the text."""
        out = []
        slow = [i for i, t in enumerate(texts) if self.quick is None or _has_long_run(t)]
        exact = dict(zip(slow, self.exact.encode_batch_fast([" " + texts[i] for i in slow], add_special_tokens=False), strict=True))
        first = [exact[i].ids if i in exact else self.quick.encode_ordinary(" " + t) for i, t in enumerate(texts)]
        for text, a, b in zip(texts, first, self.pieces.encode(texts, num_threads=1), strict=True):
            wanted = b" " + text.encode()
            a_ids, b_ids = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
            # Byte-level tokens hold the bytes they were made from; their number is looked at all the same.
            same = bool(text) and self.a_size[a_ids].sum() == len(wanted) == self.b_size[b_ids].sum()
            if same and b"".join(map(self.b_bytes.__getitem__, b)) == wanted:
                out.append((a_ids, b_ids))
            else:
                out.append((a_ids[:0], b_ids[:0]))
        return out


@dataclass
class Groups:
    """Tokens of both kinds in each group: how many, and where the first lies."""

    a_count: np.ndarray
    b_count: np.ndarray
    a_first: np.ndarray
    b_first: np.ndarray

    @property
    def links(self) -> int:
        return int((self.a_count * self.b_count).sum())


def groups_of(pair: Pair, a: np.ndarray, b: np.ndarray) -> Groups:
    """Groups end where a token of either kind ends at the same byte."""
    if not len(a):
        none = np.zeros(0, np.int64)
        return Groups(none, none, none, none)
    a_ends, b_ends = np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b])
    # Both sides spell the same bytes, so one mark for each byte tells where the other side ends.
    ends_b = np.zeros(b_ends[-1] + 1, dtype=bool)
    ends_b[b_ends] = True
    a_last = np.flatnonzero(ends_b[a_ends]) + 1
    ends_b[:] = False
    ends_b[a_ends] = True
    b_last = np.flatnonzero(ends_b[b_ends]) + 1
    a_first, b_first = np.concatenate([[0], a_last[:-1]]), np.concatenate([[0], b_last[:-1]])
    return Groups(a_last - a_first, b_last - b_first, a_first, b_first)


def spelled(pair: Pair, a: np.ndarray, b: np.ndarray, groups: Groups) -> str:
    """``a1,a2|b1;a3|b2,b3``: the groups' ids in order."""
    if not len(a):
        return ""
    a_group, b_group = (np.repeat(np.arange(len(n)), n) for n in (groups.a_count, groups.b_count))
    out = np.empty(len(a) + len(b), dtype=object)
    a_place = np.arange(len(a)) + groups.b_first[a_group]
    b_place = np.arange(len(b)) + (groups.a_first + groups.a_count)[b_group]
    out[a_place], out[b_place] = pair.a_names[0][a], pair.b_names[0][b]
    a_last, b_last = groups.a_first + groups.a_count - 1, groups.b_first + groups.b_count - 1
    out[a_place[a_last]], out[b_place[b_last]] = pair.a_names[1][a[a_last]], pair.b_names[1][b[b_last]]
    return "".join(out.tolist())[:-1]


def identical(pair: Pair, a: np.ndarray, b: np.ndarray, groups: Groups) -> np.ndarray:
    """Which groups are one token of each kind that the identity map pairs."""
    single = np.flatnonzero((groups.a_count == 1) & (groups.b_count == 1))
    same = np.zeros(len(groups.a_count), dtype=bool)
    same[single] = pair.same[a[groups.a_first[single]]] == b[groups.b_first[single]]
    return same


def irregular(pair: Pair, a: np.ndarray, b: np.ndarray, groups: Groups, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs of the ``chosen`` groups, as ``a * vocabulary + b`` ascending, and their links.

    Links are laid out some at a time, so one long group takes no more room than many short.
    """
    wide = len(pair.b_bytes)
    members = np.flatnonzero(np.repeat(chosen, groups.a_count))
    group = np.repeat(np.arange(len(chosen)), groups.a_count)[members]
    times = groups.b_count[group]
    ends = np.cumsum(times)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    start = 0
    while start < len(members):
        taken = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, taken + LINKS_AT_ONCE, "right")))
        here = slice(start, stop)
        n = times[here]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        keys = np.repeat(a[members[here]], n) * wide + b[np.repeat(groups.b_first[group[here]], n) + within]
        found.append(np.unique(keys, return_counts=True))
        start = stop
    return united(found)


def united(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts by key, added up over parts."""
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(place, weights=np.concatenate([n for _, n in parts]), minlength=len(keys)).astype(np.int64)


class Met:
    """Pairs that a task has met and in how many rows, united now and then."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = self.last = 0

    def add(self, keys: np.ndarray) -> None:
        self.parts.append((keys, np.ones(len(keys), np.int64)))
        self.held += len(keys)

    def full(self) -> bool:
        """Whether too many pairs are held even once they are united."""
        if self.held > 2 * self.last + PAIRS_HELD // 2:
            self.parts = [united(self.parts)]
            self.held = self.last = len(self.parts[0][0])
        return self.held > PAIRS_HELD

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out = united(self.parts)
        self.__init__()
        return out


#: One table for what a pass over the texts finds: rows of documents, and counts, which have a key.
FIELDS = {"row": "long", "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups_sha256": "string", "a": "binary", "b": "binary", "key": "long", "n": "long"}
KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _table(columns: dict[str, pa.Array], id_kind: pa.DataType) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    kinds = {"doc_id": id_kind} | {name: KINDS[kind] for name, kind in FIELDS.items()}
    return pa.RecordBatch.from_arrays([columns[n] if n in columns else pa.nulls(size, k) for n, k in kinds.items()], list(kinds))


def _counted(keys: np.ndarray, n: np.ndarray, id_kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(keys), 65_536):
        part = slice(start, start + 65_536)
        yield _table({"key": pa.array(keys[part]), "n": pa.array(n[part])}, id_kind)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """A batch in parts of bounded rows and characters, and their texts."""
    start, texts, chars = 0, [], 0
    for text in batch.column(2):
        texts.append(text.as_py() or "")
        chars += len(texts[-1])
        if len(texts) >= ROWS_A_BATCH or chars >= CHARS_AT_ONCE:
            yield batch.slice(start, len(texts)), texts
            start, texts, chars = start + len(texts), [], 0
    if texts:
        yield batch.slice(start), texts


def _find(spec, kind: str):
    """Tokens and groups of each row, and the counts of a task's pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = spec.value.pair()
        wide = len(pair.b_bytes)
        vector = np.zeros(len(pair.a_bytes), dtype=np.int64)
        met, id_kind = Met(), None
        for batch in batches:
            id_kind = batch.schema.field(0).type
            for rows, texts in _slices(batch):
                n_a, n_b, n_groups, n_links, hashes, a_ids, b_ids = [], [], [], [], [], [], []
                for a, b in pair.encode(texts):
                    groups = groups_of(pair, a, b)
                    same = identical(pair, a, b, groups)
                    equal = np.zeros(len(vector), dtype=bool)
                    equal[a[groups.a_first[same]]] = True
                    keys, _ = irregular(pair, a, b, groups, ~same)
                    # A pair that the map knows is counted by its vector wherever it is linked.
                    known = pair.same[keys // wide] == keys % wide
                    equal[keys[known] // wide] = True
                    vector += equal
                    met.add(keys[~known])
                    if met.full():
                        yield from _counted(*met.take(), id_kind)
                    n_a.append(len(a))
                    n_b.append(len(b))
                    n_groups.append(len(same))
                    n_links.append(groups.links)
                    hashes.append(hashlib.sha256(spelled(pair, a, b, groups).encode()).hexdigest() if len(a) else "")
                    a_ids.append(a.astype(kind).tobytes())
                    b_ids.append(b.astype(kind).tobytes())
                columns = {"doc_id": rows.column(0), "row": rows.column(1), "n_groups": pa.array(n_groups, pa.int64())}
                columns |= {"n_a": pa.array(n_a, pa.int64()), "n_b": pa.array(n_b, pa.int64())}
                columns |= {"n_links": pa.array(n_links, pa.int64()), "groups_sha256": pa.array(hashes, pa.string())}
                yield _table(columns | {"a": pa.array(a_ids, pa.binary()), "b": pa.array(b_ids, pa.binary())}, id_kind)
        if id_kind is not None:
            counted = np.flatnonzero(vector)
            yield from _counted(*met.take(), id_kind)
            yield from _counted(counted * wide + pair.same[counted], vector[counted], id_kind)

    return run


@dataclass
class Counts:
    """Rows that hold a pair: by identity, the best of any pair by first id, and some other pairs by key.

    ``keys`` of this pass lie from ``low`` to below ``high``; those in between that are not
    listed were met once.
    """

    vector: np.ndarray
    best: np.ndarray
    low: int
    high: int
    keys: np.ndarray
    n: np.ndarray

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.ones(len(keys), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys.astype(self.keys.dtype)), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.n[at], 1).astype(np.int64)


def _judge(spec, counts, kind: str, first: bool):
    """``(row, n_best, count_sum)`` over the links of one pass; the first one has the identical groups too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, known = spec.value.pair(), counts.value
        wide = len(pair.b_bytes)
        for batch in batches:
            best, total = [], []
            for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                a, b = (np.frombuffer(x, dtype=kind).astype(np.int64) for x in (a, b))
                groups = groups_of(pair, a, b)
                same = identical(pair, a, b, groups)
                ids = a[groups.a_first[same]]
                n = known.vector[ids]
                count, top = (int(n.sum()), int((n == known.best[ids]).sum())) if first else (0, 0)
                keys, links = irregular(pair, a, b, groups, ~same)
                part = slice(*np.searchsorted(keys, [known.low, known.high]))
                keys, links = keys[part], links[part]
                equal = pair.same[keys // wide] == keys % wide
                n = np.where(equal, known.vector[keys // wide], known.of(keys))
                total.append(count + int((n * links).sum()))
                best.append(top + int(links[n == known.best[keys // wide]].sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.int64()), pa.array(total, pa.int64())], ["row", "n_best", "count_sum"])

    return run


def align(
    docs: DataFrame,
    byte_level: str,
    pieces: str,
    doc_id: str = "doc_id",
    text: str = "text",
    pairs_a_pass: int = PAIRS_A_PASS,
) -> tuple[DataFrame, DataFrame]:
    """A row for each document and a row for each linked pair of ids.

    The first frame has ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``
    and the ids in both vocabularies (``a``, ``b``: little-endian, two bytes each if that is
    enough, else four); the second has ``a, b, n``: in how many rows the pair is linked.

    ``byte_level`` and ``pieces`` are tokenizer files. A text is encoded behind a blank, without
    special tokens, whose spelling is plain text. Null and empty texts, and texts that one of
    the two does not give back byte by byte, have no tokens: zeros and an empty hash. Every row
    counts, repeated ones and those without an id too; other columns are not read. Texts are
    encoded once and kept as ids. The counts of pairs met more than once are broadcast, at most
    ``pairs_a_pass`` at a time; if there are more, the ids are gone through once for each part,
    so neither the driver nor a task holds more whatever the corpus.
    """
    spark = docs.sparkSession
    contents = Spec.read(byte_level, pieces)
    pair = contents.pair()
    wide, size = len(pair.b_bytes), len(pair.a_bytes)
    kind = "<u2" if max(wide, size) <= 1 << 16 else "<u4"
    spec = spark.sparkContext.broadcast(contents)
    # Rows are told apart by a number of their own, so ids may repeat or be missing.
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    rows = rows.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    fields = {"doc_id": rows.schema["doc_id"].dataType.simpleString()} | FIELDS
    found = written(rows.mapInArrow(tidy(_find(spec, kind)), ", ".join(f"{n} {k}" for n, k in fields.items())), "aligned")
    counted = found.where(F.col("key").isNotNull()).groupBy("key").agg(F.sum("n").alias("n"))
    counted = written(counted, "aligned-pairs")
    first_id = F.floor(F.col("key") / F.lit(wide)).cast("int")
    best_rows = counted.groupBy(first_id.alias("a")).agg(F.max("n").alias("n")).toArrow()
    best = np.zeros(size, dtype=np.int64)
    best[best_rows["a"].to_numpy()] = best_rows["n"].to_numpy()
    # No more rows than the first vocabulary has ids.
    known = spark.createDataFrame([(int(i * wide + b),) for i, b in enumerate(pair.same) if b >= 0], "same long")
    by_map = counted.join(F.broadcast(known), F.col("key") == F.col("same"), "left_semi").toArrow()
    vector = np.zeros(size, dtype=np.int64)
    vector[by_map["key"].to_numpy() // wide] = by_map["n"].to_numpy()
    often = counted.where(F.col("n") > 1).join(F.broadcast(known), F.col("key") == F.col("same"), "left_anti")
    ids = found.where(F.col("key").isNull()).select("row", "a", "b")
    judged = None
    for low, high in _passes(often, wide, size, pairs_a_pass):
        part = often.where((F.col("key") >= low) & (F.col("key") < high)).toArrow()
        keys, n = part["key"].to_numpy(), part["n"].to_numpy()
        order = np.argsort(keys)
        narrow = np.uint32 if wide * size < 1 << 32 else np.int64
        some = Counts(vector, best, low, high, keys[order].astype(narrow), n[order].astype(np.uint32 if n.max(initial=0) < 1 << 32 else np.int64))
        shared = spark.sparkContext.broadcast(some)
        one = ids.mapInArrow(tidy(_judge(spec, shared, kind, low == 0)), "row long, n_best long, count_sum long")
        judged = one if judged is None else judged.unionByName(one)
    judged = judged.groupBy(F.col("row").alias("j_row")).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = found.where(F.col("key").isNull()).drop("key", "n").join(judged, F.col("row") == F.col("j_row")).select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        "n_best",
        "count_sum",
        "groups_sha256",
        "a",
        "b",
    )
    return out, counted.select(first_id.alias("a"), (F.col("key") % wide).cast("int").alias("b"), "n")


def _passes(often: DataFrame, wide: int, size: int, pairs_a_pass: int) -> list[tuple[int, int]]:
    """Ranges of keys that hold about ``pairs_a_pass`` rows each, cut between first ids."""
    first_id = F.floor(F.col("key") / F.lit(wide)).cast("long")
    counts = often.groupBy(first_id.alias("a")).count().toArrow()
    rows = np.zeros(size, dtype=np.int64)
    rows[counts["a"].to_numpy()] = counts["count"].to_numpy()
    part = np.maximum(0, np.cumsum(rows) - 1) // max(1, pairs_a_pass)
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), size]
    return [(low * wide, high * wide) for low, high in zip(cuts[:-1], cuts[1:], strict=True)]
