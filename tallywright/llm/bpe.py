"""Byte-pair encoding by a tokenization automaton.

The automaton reads tokens. It starts with one state and an arc for each byte. The
merges, in their order, each put in a gadget: for a merge of ``u`` and ``v`` the state
that ``u`` leads to is replaced by a copy without its arc ``v``, and beside every arc
``u`` that is left an arc for the merged token leads where ``v`` led. What it accepts in
the end are exactly the sequences the merges produce, one for each text.

All arcs with one label lead to one state, so a state is named by the token read last,
and its history of cut arcs by that token and the right parts it was merged from.

The merges are compiled once, on the driver, into packed arrays: a byte trie of all tokens
that some text can have, and a table of arcs by state and token. Many words are encoded in
step: the trie finds every token in them, and the table tells which one leads on from each
state. Arcs are entered in the table as they are first met.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from tallywright.llm.common import tidy

PATTERN = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
#: Bounds of what a task remembers: words that long, so many of them, half of 2 to the power of arcs.
MAX_CACHED_BYTES, MAX_CACHED_WORDS, TABLE_BITS = 48, 150_000, 19
#: What is worked on at once: characters of texts, new words in step.
CHARS_AT_ONCE, WORDS_IN_STEP = 500_000, 8_192
SPREAD = np.uint64(0x9E3779B97F4A7C15)
ROWS_A_BATCH = 256


def byte_of_char() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary, inverted."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Packed:
    """A table of whole numbers from 0 up by whole numbers from 0 up, in two arrays; open addressing."""

    def __init__(self, bits: int):
        self.bits, self.size = bits, 0
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.zeros(1 << bits, dtype=np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 for those that are not in."""
        slots = self._slots(keys)
        held = self.keys[slots]
        out = np.where(held == keys, self.values[slots], -1)
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & (len(self.keys) - 1)
            held, wanted = self.keys[slots[open_]], keys[open_]
            out[open_] = np.where(held == wanted, self.values[slots[open_]], -1)
            open_ = open_[(held != wanted) & (held >= 0)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Enter different keys that are not in; beyond half of the room all others go first."""
        if self.size + len(keys) > len(self.keys) // 2:
            self.keys.fill(-1)
            self.size = 0
        self.size += len(keys)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] < 0
            self.keys[slots[free]] = keys[free]
            won = self.keys[slots] == keys
            self.values[slots[won]] = values[won]
            slots, keys, values = (slots[~won] + 1) & (len(self.keys) - 1), keys[~won], values[~won]


class Automaton:
    """Compiled merges: ``encode`` and ``encode_all`` split bytes into token ids, ``label`` spells an id."""

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        size = max(vocabulary.values(), default=-1) + 1
        self.left = [-1] * size
        self.right = [-1] * size
        self.birth = [-1] * size
        self.label: list[bytes] = [b""] * size
        self.cut: dict[tuple[int, int], int] = {}
        self.token: dict[bytes, int] = {}
        self.table = Packed(TABLE_BITS)
        for text, number in vocabulary.items():
            self.label[number] = text
            if len(text) == 1:
                self.token[text] = number
        for rank, (u, v) in enumerate(merges):
            self.add_gadget(vocabulary[u], vocabulary[v], vocabulary[u + v], rank)
        self.longest = max(map(len, self.token), default=0)
        self._pack_trie()

    def _pack_trie(self) -> None:
        nodes: dict[int, int] = {}
        tokens = [-1]
        for text, number in self.token.items():
            at = 0
            for byte in text:
                at = nodes.setdefault(at << 8 | byte, len(tokens))
                if at == len(tokens):
                    tokens.append(-1)
            tokens[at] = number
        self.trie = Packed(max(4, (4 * len(nodes)).bit_length()))
        self.trie.put(np.array(list(nodes), np.int64), np.array(list(nodes.values()), np.int32))
        self.token_at = np.array(tokens, dtype=np.int32)

    def add_gadget(self, u: int, v: int, merged: int, rank: int) -> None:
        if (u, v) in self.cut or self.birth[merged] >= 0:
            raise ValueError(f"merge {rank} makes a token or takes a pair that another merge has")
        reachable = self.label[u] in self.token and self.label[v] in self.token and self.arc(u, v, rank)
        self.cut[u, v] = rank
        self.left[merged], self.right[merged], self.birth[merged] = u, v, rank
        if reachable:
            self.token[self.label[merged]] = merged

    def arc(self, last: int, token: int, now: int) -> bool:
        """Whether the state behind ``last`` has an arc ``token`` once ``now`` merges are in.

        ``last`` ended with its right part until it was merged, and ``token`` began with
        its left part; a cut made while both stood apart removes the arc.
        """
        cut, left, right, birth = self.cut, self.left, self.right, self.birth
        a, until_a = last, now
        while a >= 0:
            b, until_b = token, now
            while b >= 0:
                rank = cut.get((a, b))
                # A token doubled is cut by its own merge: the pair is taken from the left.
                if rank is not None and rank < until_a and rank <= until_b:
                    return False
                b, until_b = left[b], birth[b]
            a, until_a = right[a], birth[a]
        return True

    def goes(self, lasts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """For each state, named by its last token, whether it has the arc."""
        keys = lasts.astype(np.int64) << 32 | tokens
        found = self.table.get(keys)
        new = np.unique(keys[found < 0])
        if len(new):
            now = len(self.cut)
            arcs = [self.arc(key >> 32, key & 0xFFFFFFFF, now) for key in new.tolist()]
            for start in range(0, len(new), 1 << (TABLE_BITS - 2)):
                part = slice(start, start + (1 << (TABLE_BITS - 2)))
                self.table.put(new[part], np.array(arcs[part], np.int32))
            missing = found < 0
            found[missing] = np.array(arcs, np.int32)[np.searchsorted(new, keys[missing])]
        return found > 0

    def encode(self, word: bytes) -> list[int]:
        """The one accepted path that spells ``word``: every prefix has one last token.

        Goes through one word, however long, in a time that grows with its length.
        """
        token, now = self.token, len(self.cut)
        whole = token.get(word)
        if whole is not None:
            return [whole]
        known: dict[tuple[int, int], bool] = {}
        lasts, starts = [-1], [0]
        for end in range(1, len(word) + 1):
            for start in range(max(0, end - self.longest), end):
                found = token.get(word[start:end])
                if found is None:
                    continue
                pair = lasts[start], found
                if start and pair not in known:
                    known[pair] = self.arc(*pair, now)
                if start == 0 or known[pair]:
                    lasts.append(found)
                    starts.append(start)
                    break
        out, end = [], len(word)
        while end:
            out.append(lasts[end])
            end = starts[end]
        return out[::-1]

    def encode_all(self, words: list[bytes]) -> list[bytes]:
        """The paths of all words, which are not empty, as little-endian unsigned 32-bit ids."""
        if not words:
            return []
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        first = np.cumsum(sizes) - sizes
        word = np.repeat(np.arange(len(words)), sizes)
        # Every token in every word, by walking the trie from all places at once.
        at = np.arange(len(flat))
        room, node, size = (first + sizes)[word] - at, np.zeros(len(flat), np.int64), 0
        begins, ends, tokens = [], [], []
        while len(at):
            node = self.trie.get(node << 8 | flat[at + size])
            size += 1
            on = node >= 0
            at, room, node = at[on], room[on], node[on]
            token = self.token_at[node]
            full = token >= 0
            begins.append(at[full])
            ends.append(at[full] + size)
            tokens.append(token[full])
            on = room > size
            at, room, node = at[on], room[on], node[on].astype(np.int64)
        begin, end, token = map(np.concatenate, (begins, ends, tokens))
        own = word[begin]
        reach = end - first[own]
        order = np.argsort(reach, kind="stable")
        # A word of n bytes has n + 1 places, so words lie one place further apart.
        begin, end, token, own = begin[order] + own[order], end[order] + own[order], token[order], own[order]
        steps = np.searchsorted(reach[order], np.arange(1, sizes.max(initial=0) + 2))
        last = np.full(len(flat) + len(words), -1, dtype=np.int64)
        came = np.zeros(len(flat) + len(words), dtype=np.int64)
        home = first + np.arange(len(words))
        for low, high in zip(steps[:-1], steps[1:], strict=True):
            here = slice(low, high)
            b, e, t = begin[here], end[here], token[here]
            start = b == home[own[here]]
            good = start.copy()
            inner = np.flatnonzero(~start)
            good[inner] = self.goes(last[b[inner]], t[inner])
            last[e[good]], came[e[good]] = t[good], b[good]
        # Back from the ends, all words at once.
        who, place = np.arange(len(words)), home + sizes
        path, owner = [], []
        while len(who):
            path.append(last[place])
            owner.append(who)
            place = came[place]
            on = place > home[who]
            who, place = who[on], place[on]
        owner_, path_ = np.concatenate(owner[::-1]), np.concatenate(path[::-1])
        ids = path_[np.argsort(owner_, kind="stable")].astype("<u4").tobytes()
        stops = np.cumsum(np.bincount(owner_, minlength=len(words))) * 4
        return [ids[a:b] for a, b in zip([0, *stops.tolist()[:-1]], stops.tolist(), strict=True)]


class Tokenizer(dict):
    """Texts to ids and back; as a dict it remembers words by their bytes."""

    def __init__(self, spec: str):
        super().__init__()
        model = json.loads(spec)
        chars = byte_of_char()
        spell = lambda text: bytes(map(chars.__getitem__, text))
        self.special = {x["content"]: x["id"] for x in model["added_tokens"]}
        vocabulary = {spell(t): i for t, i in model["model"]["vocab"].items() if t not in self.special}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
        self.automaton = Automaton(vocabulary, [(spell(u), spell(v)) for u, v in pairs])
        size = max([len(self.automaton.label), *(i + 1 for i in self.special.values())])
        self.labels = self.automaton.label + [b""] * (size - len(self.automaton.label))
        for text, number in self.special.items():
            self.labels[number] = text.encode()
        longest_first = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.cutter = re.compile(f"({'|'.join(longest_first)})") if longest_first else None

    def __missing__(self, word: bytes) -> bytes:
        """Long words are encoded each time they are met."""
        return np.array(self.automaton.encode(word), dtype="<u4").tobytes()

    def learn(self, pieces: list[list[bytes]]) -> None:
        """Encode all words of ``pieces`` that are short and new, in step, and remember them."""
        new = [w for w in set().union(*pieces).difference(self) if len(w) <= MAX_CACHED_BYTES]
        if len(self) + len(new) > MAX_CACHED_WORDS:
            self.clear()
            new = [w for w in set().union(*pieces) if len(w) <= MAX_CACHED_BYTES]
        for start in range(0, len(new), WORDS_IN_STEP):
            part = new[start : start + WORDS_IN_STEP]
            self.update(zip(part, self.automaton.encode_all(part), strict=True))

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; none for null and empty ones."""
        out: list[bytes] = []
        start = 0
        while start < len(texts):
            stop, chars = start, 0
            while stop < len(texts) and (stop == start or chars < CHARS_AT_ONCE):
                chars += len(texts[stop] or "")
                stop += 1
            split = [self.split(t) if t else [] for t in texts[start:stop]]
            self.learn([x for parts in split for x in parts if isinstance(x, list)])
            for parts in split:
                found = [b"".join(map(self.__getitem__, x)) if isinstance(x, list) else x for x in parts]
                out.append(b"".join(found))
            start = stop
        return out

    def split(self, text: str) -> list[list[bytes] | bytes]:
        """The words of a text, and between them the ids of special tokens spelled in it."""
        if self.cutter is None or not any(s in text for s in self.special):
            return [words(text)]
        return [
            np.array([self.special[part]], dtype="<u4").tobytes() if part in self.special else words(part)
            for part in self.cutter.split(text)
            if part
        ]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """The arcs' labels in sequence; bytes that are no UTF-8 are replaced."""
        spelled = map(self.labels.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())
        return b"".join(spelled).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """By code point: 1 letter, 2 number, 3 white space, 0 anything else."""
    out = np.zeros(0x110000, dtype=np.uint8)
    kind = {"L": 1, "N": 2}
    for code in range(0x110000):
        out[code] = kind.get(unicodedata.category(chr(code))[0], 0)
    out[list(WHITE_SPACE)] = 3
    return out


def words(text: str) -> list[bytes]:
    """The pieces of :data:`PATTERN`, as bytes.

    Without apostrophes a piece starts where the class of characters changes. The last
    character of a run of white space is apart, and joins what follows if it is a space.
    """
    if not text:
        return []
    if "'" in text or "\0" in text:
        return [w.encode() for w in PATTERN.findall(text)]
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    kind = char_classes()[codes]
    starts = np.empty(len(codes), dtype=bool)
    starts[0] = False
    np.not_equal(kind[1:], kind[:-1], out=starts[1:])
    white = kind == 3
    last = np.flatnonzero(white[:-1] & ~white[1:])
    starts[last] = True
    starts[last[codes[last] == 0x20] + 1] = False
    starts[0] = False
    place = np.arange(len(codes)) + np.cumsum(starts)
    spread = np.zeros(place[-1] + 1, dtype=np.uint32)
    spread[place] = codes
    return spread.tobytes().decode("utf-32-le").encode().split(b"\0")


def tokenizer(spec: str) -> Tokenizer:
    return Tokenizer(spec)


def read_spec(path: str) -> str:
    return Path(path).read_text(encoding="utf-8")


def compiled(path: str) -> Tokenizer:
    """The automaton of a tokenizer file, made on the driver; its size follows the file's."""
    return tokenizer(read_spec(path))


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids)``: every whole text as token ids.

    ``ids`` is binary: little-endian unsigned 32-bit integers. Special tokens spelled in a
    text are encoded as themselves. Null and empty texts have no ids. Every row gives a
    row, repeated ones too; other columns are not read. Nothing is shuffled, and an
    executor holds a batch of rows and a bounded table of words at a time.
    """
    return _coded(docs, path, doc_id, text, decode=False)


def encode_and_decode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)``: as :func:`encode_documents`, and the ids' text.

    Both are done while a row is held, in one pass; null and empty texts decode to the empty one.
    """
    return _coded(docs, path, doc_id, text, decode=True)


def _coded(docs: DataFrame, path: str, doc_id: str, text: str, decode: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(compiled(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_A_BATCH):
                part = batch.slice(at, ROWS_A_BATCH)
                ids = tool.encode_all(part.column(1).to_pylist())
                counts = pa.array([len(x) // 4 for x in ids], pa.int64())
                columns = [part.column(0), counts, pa.array(ids, pa.binary())]
                if decode:
                    columns.append(pa.array(map(tool.decode, ids), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "decoded"][: len(columns)])

    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"doc_id {kind}, n_tokens long, ids binary" + (", decoded string" if decode else ""))


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """``encoded`` with the decoded text as a last column ``into``; null ids give null.

    An id beyond the vocabulary fails the job, as it has no label.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(compiled(path))
    kept = encoded.drop(into)
    column = kept.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_A_BATCH):
                part = batch.slice(at, ROWS_A_BATCH)
                texts = [None if x is None else tool.decode(x) for x in part.column(column).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], [*part.schema.names, into]
                )

    schema = StructType([*kept.schema.fields, StructField(into, StringType())])
    return kept.mapInArrow(tidy(run), schema)
