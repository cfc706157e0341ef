"""Language identification by cross-parsing with suffix automata.

A text is parsed from left to right into the longest phrases that occur in a language's
labelled text. The language it reads like needs the fewest phrases for its length.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywright.llm.common import written

#: Bounds of what is learned from each language: characters (the last row is whole) and rows.
TRAIN_CHARS, TRAIN_ROWS = 40_000, 400
PIECE = 1024
PIECES_AT_ONCE = 4096
LETTER = regex.compile(r"\p{L}")


def suffix_automaton(codes: np.ndarray) -> list[dict[int, int]]:
    """The arcs of each state of the automaton of all substrings, by code."""
    size = 2 * len(codes) + 1
    moves: list[dict[int, int]] = [{}]
    link, length = [-1] * size, [0] * size
    last = 0
    for code in codes.tolist():
        new = len(moves)
        moves.append({})
        length[new] = length[last] + 1
        at = last
        while at >= 0 and code not in moves[at]:
            moves[at][code] = new
            at = link[at]
        if at < 0:
            link[new] = 0
        else:
            target = moves[at][code]
            if length[target] == length[at] + 1:
                link[new] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                length[copy], link[copy] = length[at] + 1, link[target]
                while at >= 0 and moves[at].get(code) == target:
                    moves[at][code] = copy
                    at = link[at]
                link[target] = link[new] = copy
        last = new
    return moves


def packed(moves: list[dict[int, int]], alphabet: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(base, owner, target)``: the arc of a state by a code is at ``base[state] + code``, if the state owns that place.

    Rows lie over one another where they have no arcs, so room grows with arcs and not with
    states times letters. Wide rows are placed first, single arcs fill the gaps.
    """
    base = np.zeros(len(moves), dtype=np.int64)
    owner = np.full(2 * sum(map(len, moves)) + 2 * alphabet + PIECE, -1, dtype=np.int32)
    target = np.zeros(len(owner), dtype=np.int32)
    cursor, tried = 0, np.arange(256)[:, None]
    for state in sorted((s for s, arcs in enumerate(moves) if len(arcs) > 1), key=lambda s: -len(moves[s])):
        codes = np.fromiter(moves[state], np.int64, len(moves[state]))
        while True:
            if cursor + 256 + alphabet > len(owner):
                owner = np.concatenate([owner, np.full(len(owner), -1, dtype=np.int32)])
                target = np.concatenate([target, np.zeros(len(target), dtype=np.int32)])
            fits = (owner[cursor + tried + codes] < 0).all(axis=1)
            if fits.any():
                break
            cursor += 256
        base[state] = cursor + fits.argmax()
        owner[base[state] + codes] = state
        target[base[state] + codes] = list(moves[state].values())
    single = [(s, *next(iter(arcs.items()))) for s, arcs in enumerate(moves) if len(arcs) == 1]
    if single:
        state, code, to = np.array(single, dtype=np.int64).T
        free = np.flatnonzero(owner < 0)[: len(state)]  # there are: room is twice the arcs at least
        base[state], owner[free], target[free] = free - code, state, to
    used = int(np.flatnonzero(owner >= 0).max(initial=0)) + 1
    gap = np.full(alphabet, -1, dtype=np.int32)
    return base, np.concatenate([owner[:used], gap]), np.concatenate([target[:used], gap])


@dataclass
class Model:
    """All languages' automata, :func:`packed`, one after the other.

    ``again`` has the state after the first code of a phrase for each language and code. Every
    letter of any language's learned text has a code; those in none share the last.
    """

    languages: list[str]
    code_of: np.ndarray
    base: np.ndarray
    owner: np.ndarray
    target: np.ndarray
    again: np.ndarray
    scale: np.ndarray

    def codes(self, text: str) -> np.ndarray:
        """Letters by their code, lower case; any run of other characters is one code 0."""
        points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
        codes = self.code_of[points]
        keep = codes != 0
        keep[1:] |= codes[:-1] != 0
        keep[:1] = True
        return codes[keep]

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases for each text and language, and each text's number of codes.

        Texts are cut into pieces of one length so that many are parsed in step; every
        piece starts a phrase. The whole text counts.
        """
        coded = [self.codes(t) for t in texts]
        sizes = np.array([len(c) for c in coded], dtype=np.int64)
        counts = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(texts)), counts)
        pieces = int(counts.sum())
        flat = np.zeros(pieces * PIECE, dtype=np.int32)
        base = np.concatenate([[0], np.cumsum(counts)[:-1]]) * PIECE if len(texts) else []
        for at, codes in zip(base, coded, strict=True):
            flat[at : at + len(codes)] = codes
        grid = flat.reshape(pieces, PIECE)
        first = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(texts) else np.zeros(0, np.int64)
        lengths = np.minimum(PIECE, np.repeat(sizes, counts) - (np.arange(pieces) - np.repeat(first, counts)) * PIECE)
        order = np.argsort(-lengths, kind="stable")
        ended = np.zeros((len(self.languages), pieces), dtype=np.int64)
        for start in range(0, pieces, PIECES_AT_ONCE):
            some = order[start : start + PIECES_AT_ONCE]
            ended[:, some] = self._parse(np.ascontiguousarray(grid[some].T), lengths[some])
        out = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        for language in range(len(self.languages)):
            out[:, language] = np.bincount(owner, weights=ended[language], minlength=len(texts))
        return out, sizes

    def _parse(self, columns: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of each piece; pieces come longest first, so those that end leave at the back."""
        if not len(lengths):
            return np.ones((len(self.languages), 0), dtype=np.int32)
        state = self.again[:, columns[0]]
        ended = np.ones(state.shape, dtype=np.int32)
        live = np.searchsorted(-lengths, -np.arange(PIECE), side="left")
        for step in range(1, int(lengths[0])):
            n = live[step]
            here, code = state[:, :n], columns[step, :n]
            place = self.base[here] + code
            goes = self.owner[place] == here
            ended[:, :n] += ~goes
            state[:, :n] = np.where(goes, self.target[place], self.again[:, code])
        return ended

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ``und`` and 0 for null or without a letter."""
        known = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if self.languages else []
        names, scores = ["und"] * len(texts), np.zeros(len(texts))
        if not known:
            return names, scores
        counts, sizes = self.phrases([texts[i] for i in known])
        rate = counts * self.scale / np.maximum(1, sizes)[:, None]
        best = rate.argmin(axis=1)
        # Shares that fall off fast with the number of phrases: 1 / n for texts alike in all.
        weight = (rate.min(axis=1, keepdims=True) / rate) ** 8
        share = weight.max(axis=1) / weight.sum(axis=1)
        for place, i in enumerate(known):
            names[i], scores[i] = self.languages[best[place]], share[place]
        return names, scores


def fit(samples: dict[str, list[str]], letters: int | None = None) -> Model:
    """A model from labelled texts; ties between languages go to the first in code point order.

    Texts are learned whole. Where a language has fewer, its phrases are shorter, so counts are
    scaled by the logarithm of what was learned from. Marks, such as vowel signs, count as
    letters. With ``letters``, only so many of the most frequent ones are told apart.
    """
    languages = sorted(samples)
    learned = {name: "\n".join(samples[name]) for name in languages}
    points = np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(t.lower().encode("utf-32-le", "replace"), np.uint32) for t in learned.values())])
    values, counts = np.unique(points, return_counts=True)
    common = [v for _, v in sorted(zip(-counts, values, strict=True)) if _is_letter(chr(v))][:letters]
    number = {chr(v): i + 1 for i, v in enumerate(common)}
    alphabet = len(number) + 2
    code_of = np.zeros(0x110000, dtype=np.int32)
    for point in range(len(code_of)):
        char = chr(point)
        if _is_letter(char):
            code_of[point] = number.get(char.lower()[0], alphabet - 1)
    none = np.zeros(0, np.int32)
    model = Model(languages, code_of, none, none, none, np.zeros((0, alphabet), np.int32), np.ones(len(languages)))
    parts, agains, sizes, states, places = [], [], [], 0, 0
    for name in languages:
        codes = model.codes(learned[name])
        moves = suffix_automaton(codes)
        # Where a phrase cannot go on, the next one starts with the same character. One that the
        # language never has is a phrase of its own: it leads to an extra state that ends it.
        again = np.full(alphabet, len(moves), dtype=np.int32)
        again[list(moves[0])] = list(moves[0].values())
        moves.append({})
        base, owner, target = packed(moves, alphabet)
        parts.append((base + places, np.where(owner >= 0, owner + states, -1), target + states))
        agains.append(again + states)
        sizes.append(len(codes))
        states, places = states + len(moves), places + len(owner)
    if languages:
        kinds = (np.int64 if places > 1 << 31 else np.int32, np.int32, np.int32)
        model.base, model.owner, model.target = (np.concatenate(x).astype(k) for x, k in zip(zip(*parts, strict=True), kinds, strict=True))
        model.again = np.stack(agains)
        model.scale = np.log(np.maximum(2, sizes)) / np.log(max(2, *sizes))
    return model


def _is_letter(char: str) -> bool:
    return char.isalpha() or unicodedata.category(char)[0] == "M"


def labelled_sample(docs: DataFrame, doc_id: str, text: str, lang: str, chars: int, rows: int) -> dict[str, list[str]]:
    """Whole texts by language, in the order of a hash of id and text, equal rows once: at most
    ``rows``, and none after those that have ``chars`` characters together. Every language is
    learned. Texts move only once chosen."""
    usable = docs.where(docs[lang].isNotNull() & (F.length(docs[text]) > 0)).select(
        docs[lang].alias("lang"), docs[text].alias("text"), F.xxhash64(docs[doc_id], docs[text]).alias("place")
    )
    sizes = written(usable.groupBy("lang", "place").agg(F.max(F.length("text")).alias("size")), "language-sizes")
    # Of a common language only the share of places that surely holds the first ``rows`` is ranked.
    share = sizes.groupBy(F.col("lang").alias("of")).agg(F.least(F.lit(1.0), F.lit(rows + 6 * rows**0.5 + 20) / F.count("*")).alias("share"))
    spread = F.col("place").cast("double") / F.lit(float(1 << 64)) + 0.5
    near = sizes.join(share, F.col("lang") == F.col("of")).where(spread <= F.col("share")).drop("of", "share")
    order = Window.partitionBy("lang").orderBy("place")
    first = near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= rows).drop("n")
    chosen, held = [], {}
    for row in first.orderBy("lang", "place").toLocalIterator():
        if held.get(row["lang"], 0) < chars:
            held[row["lang"]] = held.get(row["lang"], 0) + row["size"]
            chosen.append((row["lang"], row["place"]))
    picked = F.broadcast(docs.sparkSession.createDataFrame(chosen, "lang string, place long"))
    texts = usable.join(picked, ["lang", "place"]).groupBy("lang", "place").agg(F.max("text").alias("text"))
    out: dict[str, list[str]] = {}
    for row in texts.orderBy("lang", "place").toLocalIterator():
        out.setdefault(row["lang"], []).append(row["text"])
    return out


def identify(
    docs: DataFrame,
    training: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    chars: int = TRAIN_CHARS,
    rows: int = TRAIN_ROWS,
) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row of ``docs``, read as a whole.

    ``training`` has labelled rows; rows with a null text or language teach nothing. What is
    learned from is bounded by ``rows`` and by ``chars`` plus one row a language and so fits the
    driver, as the number of languages does; the automata go to the executors by broadcast. Null texts
    and texts without a letter are ``und`` with score 0, as all are without training rows.
    Other columns are not read; repeated rows give repeated results.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(labelled_sample(training, doc_id, text, lang, chars, rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = model.value
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                names, scores = tool.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

    chosen = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
