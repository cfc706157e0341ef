"""Toxicity by two Kneser-Ney models, of toxic and of ordinary text.

A class counts in how many different contexts, that is behind how many different words, it
has met an expression (the continuation count). A part of each count is held back, the
larger part the less often an expression was met, and what is held back goes to the shared
distribution, counted over both classes alike: with ``d = margin * sqrt(count)``,

    p(word | class) = max(count - d, 0) / total + held_back / total * p(word | both)

So expressions that are rare say the same in both classes, and what tells the classes apart
are words that one of them has in many contexts. Passages of several lengths, and the whole
text, are compared by their log-likelihoods a word; a logistic curve over the strongest
passage of each length, fitted on rows that the counts have not seen, gives the score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import tidy, written

#: Words whose counts the driver gets by one job, about; of each it keeps a hash and a ratio.
WORDS_A_JOB = 2_000_000
#: Of the rows learned from, one in so many fits the curve instead of being counted.
CURVE_FOLD = 4
PASSAGES = (1, 2, 4, 8)
MARGIN, SHARED_DISCOUNT = 1.5, 0.75
WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
START = 0
MAX_KNOWN, MAX_KNOWN_CHARS = 150_000, 48
WORDS_AT_ONCE = 400_000
ROWS_A_BATCH = 256
#: Pairs of words that a task holds before it hands them on.
PAIRS_AT_ONCE = 2_000_000
#: The most frequent words of a few rows: what stands before them is counted in so many places.
CROWD_ROWS, CROWDED, CROWD_PLACES = 400, 500, 64
#: Rows of the curve that are added up in one task.
CURVE_ROWS_A_TASK = 50_000


class Names(dict):
    """64-bit hashes of lower-case words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        found = xxhash.xxh64_intdigest(word.encode("utf-8", "replace")) or 1
        if len(word) <= MAX_KNOWN_CHARS:
            if len(self) >= MAX_KNOWN:
                self.clear()
            self[word] = found
        return found


def word_hashes(text: str | None, names: Names) -> np.ndarray:
    """The words of the whole text in order, as hashes; case is ignored."""
    words = WORD.findall(text.lower()) if text else []
    return np.fromiter(map(names.__getitem__, words), np.uint64, len(words))


@dataclass
class Model:
    """``ratios`` of log-likelihoods, toxic over ordinary, by hash; all other words share ``rest``.

    ``weights`` are the curve's, the last one its constant.
    """

    hashes: np.ndarray
    ratios: np.ndarray
    rest: float
    weights: np.ndarray

    def word_ratios(self, words: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(words), self.rest)
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        return np.where(self.hashes[at] == words, self.ratios[at], self.rest)

    def evidence(self, texts: list[np.ndarray]) -> np.ndarray:
        """For each text: the greatest log ratio a word of passages of each length, and the whole's.

        A text that is shorter than a passage is one passage. Without words all are 0.
        """
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        out = np.zeros((len(texts), len(PASSAGES) + 1))
        full = np.flatnonzero(sizes)
        if not len(full):
            return out
        sums = np.concatenate([[0.0], np.cumsum(self.word_ratios(np.concatenate([texts[i] for i in full])))])
        ends = np.cumsum(sizes[full])
        begins = ends - sizes[full]
        out[full, -1] = (sums[ends] - sums[begins]) / sizes[full]
        for place, length in enumerate(PASSAGES):
            # A passage from each word on; those that would reach over their text's end count from its end.
            start = np.arange(len(sums) - 1)
            last = np.repeat(ends, sizes[full])
            first = np.repeat(begins, sizes[full])
            stop = np.minimum(start + length, last)
            start = np.maximum(stop - length, first)
            means = (sums[stop] - sums[start]) / (stop - start)
            out[full, place] = np.maximum.reduceat(means, begins)
        return out

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        out, start = [np.zeros(0)], 0
        while start < len(texts):
            stop, held = start, 0
            while stop < len(texts) and (stop == start or held < WORDS_AT_ONCE):
                held += len(texts[stop])
                stop += 1
            rows = self.evidence(texts[start:stop])
            out.append(1 / (1 + np.exp(-np.clip(rows @ self.weights[:-1] + self.weights[-1], -500, 500))))
            start = stop
        return np.concatenate(out)


def held_back(counts: np.ndarray) -> np.ndarray:
    """What is taken off each count: all of one that is met once or twice, less than a seventh of a hundred."""
    return np.minimum(counts, MARGIN * np.sqrt(counts))


def class_totals(counts: np.ndarray, words: np.ndarray) -> tuple[float, float]:
    """The sum of a class's counts, and the share of it that is held back; ``words`` have each count."""
    order = np.argsort(counts)
    counts, words = counts[order].astype(np.float64), words[order]
    total = float((counts * words).sum())
    return total, float((held_back(counts) * words).sum()) / max(total, 1.0)


def word_table(
    hashes: np.ndarray,
    counts: tuple[np.ndarray, np.ndarray],
    both: np.ndarray,
    totals: list[tuple[float, float]],
    all_both: int,
    all_words: int,
    max_words: int | None = None,
) -> Model:
    """The classes' models in one table.

    ``counts`` has the contexts of each word in toxic and in ordinary text, ``both`` those in
    either, ``all_both`` their sum over ``all_words``. Words of which no class keeps a part
    may be left out: they say the same, ``rest``. All others keep a ratio of their own, unless
    a caller sets ``max_words``, which cuts those nearest to ``rest`` first.
    """
    order = np.argsort(hashes)
    hashes, both = hashes[order], both[order].astype(np.float64)
    if not all(total for total, _ in totals):
        return Model(np.zeros(0, np.uint64), np.zeros(0), 0.0, np.zeros(len(PASSAGES) + 2))
    # The shared distribution keeps a share for words that neither class has.
    shared = (both - SHARED_DISCOUNT + SHARED_DISCOUNT * all_words / (all_words + 1)) / all_both
    logs = []
    for found, (total, spare) in zip(counts, totals, strict=True):
        found = found[order].astype(np.float64)
        logs.append(np.log((found - held_back(found)) / total + spare * shared))
    ratios, rest = logs[0] - logs[1], float(np.log(totals[0][1] / totals[1][1]))
    return _furthest(Model(hashes, ratios, rest, np.zeros(len(PASSAGES) + 2)), max_words)


def _furthest(model: Model, max_words: int | None) -> Model:
    """``model``, or if it has more than ``max_words``, that many of its words, furthest from the rest."""
    if max_words is None or len(model.hashes) <= max_words:
        return model
    own = np.sort(np.argsort(-np.abs(model.ratios - model.rest), kind="stable")[:max_words])
    return Model(model.hashes[own], model.ratios[own], model.rest, model.weights)


def fit_curve(
    sums: Callable[[np.ndarray], tuple[float, np.ndarray, np.ndarray]], width: int, rounds: int = 60, pull: float = 0.02
) -> np.ndarray:
    """``width`` weights of a logistic curve by Newton steps; ``pull`` holds them back where rows are few.

    ``sums`` gives for weights the loss, its slope and its bend over all rows.
    """
    weights = np.zeros(width)
    hold = np.full(width, pull)
    hold[-1] = 1e-6
    plain, slope, bend = sums(weights)
    loss = plain
    for _ in range(rounds):
        step, scale = np.linalg.solve(bend + np.diag(hold), slope + hold * weights), 1.0
        while scale > 1e-6:
            tried = weights - scale * step
            plain, new_slope, new_bend = sums(tried)
            new = plain + 0.5 * (hold * tried * tried).sum()
            if new <= loss:
                break
            scale /= 2
        if scale <= 1e-6 or loss - new < 1e-9:
            break
        weights, loss, slope, bend = tried, new, new_slope, new_bend
    return weights


def curve_sums(evidence: np.ndarray, target: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, slope and bend of the curve over some rows."""
    x = np.column_stack([evidence, np.ones(len(evidence))])
    z = np.clip(x @ weights, -60, 60)
    p = 1 / (1 + np.exp(-z))
    return (np.logaddexp(0, z) - target * z).sum(), x.T @ (p - target), (x * (p * (1 - p))[:, None]).T @ x


def _fitted(held: DataFrame) -> np.ndarray | None:
    """The curve's weights over all of ``held`` (``toxic``, ``evidence``); none without both classes.

    Every step is a job that adds up in the tasks; the driver gets sums. Targets are moved off
    0 and 1 by what the number of rows of a class allows.
    """
    found = held.agg(F.count_if("toxic").alias("good"), F.count_if(~F.col("toxic")).alias("bad")).first()
    good, bad = found["good"], found["bad"]
    if not good or not bad:
        return None
    width = len(PASSAGES) + 2

    def sums(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                toxic = np.array(batch.column(0).to_pylist(), dtype=bool)
                evidence = batch.column(1).flatten().to_numpy().reshape(-1, width - 1)
                loss, slope, bend = curve_sums(evidence, np.where(toxic, (good + 1) / (good + 2), 1 / (bad + 2)), weights)
                yield pa.RecordBatch.from_arrays([pa.array([[loss, *slope, *bend.ravel()]], pa.list_(pa.float64()))], ["sums"])

        parts = held.select("toxic", "evidence").mapInArrow(run, "sums array<double>").toArrow()
        total = np.array(parts["sums"].to_pylist()).sum(axis=0)
        return total[0], total[1 : width + 1], total[width + 1 :].reshape(width, width)

    return fit_curve(sums, width)


def _crowded(rows: DataFrame) -> np.ndarray:
    """The most frequent words of a few rows. They only decide where pairs meet, not what is counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words, counts = np.unique(word_hashes(text, names), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "n"])

    found = rows.select("text").limit(CROWD_ROWS).mapInArrow(run, "word long, n long")
    most = found.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(CROWDED)
    return np.sort(most.toArrow()["word"].to_numpy().view(np.uint64))


def _contexts(rows: DataFrame, crowded: np.ndarray) -> DataFrame:
    """``(toxic, word, place, contexts)``: the words that each word stands behind; the first follows a start.

    A list has no word twice; a word has one for each class and place from all that a task
    holds at once. The contexts of ``crowded`` words are dealt over places by their hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names()
        held: dict[bool, list[tuple[np.ndarray, np.ndarray]]] = {True: [], False: []}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for label, chunks in held.items():
                if not chunks:
                    continue
                context, word = (np.concatenate(x) for x in zip(*chunks, strict=True))
                chunks.clear()
                many = np.isin(word, crowded)
                place = np.where(many, context % np.uint64(CROWD_PLACES), 0).astype(np.int32)
                order = np.lexsort((context, place, word))
                context, word, place = context[order], word[order], place[order]
                head = np.ones(len(word), dtype=bool)
                head[1:] = (word[1:] != word[:-1]) | (place[1:] != place[:-1])
                fresh = head.copy()
                fresh[1:] |= context[1:] != context[:-1]
                context, word, place, head = context[fresh], word[fresh], place[fresh], head[fresh]
                at = np.flatnonzero(head)
                lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(word)).astype(np.int32)), pa.array(context.view(np.int64)))
                whole = pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), label)), pa.array(word[at].view(np.int64)), pa.array(place[at]), lists],
                    ["toxic", "word", "place", "contexts"],
                )
                for start in range(0, len(at), 20_000):
                    yield whole.slice(start, 20_000)

        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_A_BATCH):
                part = batch.slice(start, ROWS_A_BATCH)
                for label, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    words = word_hashes(text, names)
                    if len(words):
                        held[label].append((np.concatenate([[np.uint64(START)], words[:-1]]).astype(np.uint64), words))
                        size += len(words)
                if size >= PAIRS_AT_ONCE:
                    yield from flush()
                    size = 0
        yield from flush()

    return rows.select("toxic", "text").mapInArrow(tidy(run), "toxic boolean, word long, place int, contexts array<long>")


def _word_counts(lists: DataFrame) -> DataFrame:
    """``(word, t, o, both)``: in how many contexts each word stands in toxic, ordinary and all text."""
    dealt = lists.repartition("word", "place").select("toxic", "word", "place", F.explode("contexts").alias("context"))
    pairs = dealt.groupBy("word", "place", "context").agg(F.max("toxic").alias("in_t"), F.max(~F.col("toxic")).alias("in_o"))
    placed = pairs.groupBy("word", "place").agg(F.count_if("in_t").alias("t"), F.count_if("in_o").alias("o"), F.count("*").alias("both"))
    return placed.groupBy("word").agg(F.sum("t").alias("t"), F.sum("o").alias("o"), F.sum("both").alias("both"))


def _telling(
    words: DataFrame, totals: list[tuple[float, float]], all_both: int, all_words: int, max_words: int | None = None
) -> DataFrame:
    """The words of which a class keeps a part; of more than ``max_words``, if set, little more than those furthest from the rest."""
    kept = words.where(F.greatest("t", "o") > MARGIN**2)
    if max_words is None:
        return kept
    count = kept.count()
    if count <= max_words or not all(total for total, _ in totals):
        return kept
    shared = (F.col("both") - SHARED_DISCOUNT + SHARED_DISCOUNT * all_words / (all_words + 1)) / all_both
    logs = [
        F.log((F.col(name) - F.least(F.col(name).cast("double"), MARGIN * F.sqrt(name))) / total + spare * shared)
        for name, (total, spare) in zip(("t", "o"), totals, strict=True)
    ]
    far = kept.withColumn("far", F.abs(logs[0] - logs[1] - float(np.log(totals[0][1] / totals[1][1]))))
    share = min(1.0, max_words / count + 0.01)
    least = far.agg(F.percentile_approx("far", 1 - share, 10_000).alias("least")).first()["least"]
    return far.where(F.col("far") >= least).drop("far")


def _collected(
    kept: DataFrame, totals: list[tuple[float, float]], all_both: int, all_words: int, max_words: int | None = None
) -> Model:
    """:func:`word_table` of all ``kept`` words, whose counts reach the driver in parts: those with the same first bits of the hash."""
    bits = (kept.count() // WORDS_A_JOB).bit_length()
    kept = written(kept, "toxic-telling") if bits else kept
    parts = []
    for part in range(1 << bits):
        found = (kept.where(F.shiftrightunsigned("word", 64 - bits) == part) if bits else kept).toArrow()
        word, t, o, both = (found[name].to_numpy() for name in ("word", "t", "o", "both"))
        parts.append(word_table(word.view(np.uint64), (t, o), both, totals, all_both, all_words))
    # Hashes are in order within a part, and parts are.
    hashes, ratios = (np.concatenate([getattr(p, name) for p in parts]) for name in ("hashes", "ratios"))
    return _furthest(Model(hashes, ratios, parts[0].rest, parts[0].weights), max_words)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_words: int | None = None,
) -> Model:
    """A model from all rows of ``docs`` (``doc_id``, ``text``) that ``labels`` (``doc_id``, ``label``) mark.

    One row in :data:`CURVE_FOLD`, by a hash of id and text, fits the curve, all others are
    counted. Rows that agree in id, text and label count once. Null ids, texts and labels
    teach nothing. Spark counts the contexts and adds up the curve's steps; the driver keeps
    a hash and a ratio, 16 bytes, of every word that a class has met often enough to keep a
    count, and gets them in parts. ``max_words`` bounds them for callers that want fewer.
    Without rows of both classes every text scores 0.5.
    """
    known = labels.where(labels[label].isNotNull()).select(labels[doc_id].alias("l_id"), (labels[label] == 1).alias("toxic")).distinct()
    rows = docs.select(docs[doc_id].alias("id"), docs[text].cast("string").alias("text")).where("text IS NOT NULL AND id IS NOT NULL")
    rows = rows.withColumn("row_key", F.xxhash64("id", "text"))
    for_curve = F.pmod(F.xxhash64("row_key", F.lit(1)), F.lit(CURVE_FOLD)) == 0

    # The labels' side is narrow: texts are dealt by id but not sorted.
    counted = rows.where(~for_curve).join(known.hint("shuffle_hash"), F.col("id") == F.col("l_id")).select("toxic", "text")
    words = written(_word_counts(_contexts(counted, _crowded(rows))), "toxic-words")
    sizes = words.agg(F.coalesce(F.sum("both"), F.lit(0)).alias("both"), F.count("*").alias("words")).first()
    totals = []
    for name in ("t", "o"):
        steps = words.groupBy(name).agg(F.count("*").alias("words")).toArrow()
        totals.append(class_totals(steps[name].to_numpy(), steps["words"].to_numpy()))
    known_by = totals, sizes["both"], sizes["words"], max_words
    model = _collected(_telling(words, *known_by), *known_by)

    # Only evidence meets the labels here. Rows lie in the same order in every run, so sums agree.
    judged = _evidence(rows.where(for_curve), model).join(known, F.col("id") == F.col("l_id"))
    held = written(judged.dropDuplicates(["toxic", "row_key"]).select("toxic", "row_key", "evidence"), "toxic-evidence")
    tasks = 1 + held.count() // CURVE_ROWS_A_TASK
    held = written(held.repartition(tasks, "row_key").sortWithinPartitions("row_key", "toxic").select("toxic", "evidence"), "toxic-curve")
    weights = _fitted(held)
    if weights is not None:
        model.weights = weights
    return model


def _evidence(rows: DataFrame, model: Model) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_A_BATCH):
                part = batch.slice(start, ROWS_A_BATCH)
                found = shared.value.evidence([word_hashes(t, names) for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(found.tolist(), pa.list_(pa.float64()))], ["id", "row_key", "evidence"]
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "text", "row_key").mapInArrow(tidy(run), f"id {kind}, row_key long, evidence array<double>")


def score_documents(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every row's whole text, 0 to 1, more for toxic.

    Null and empty texts, and those without a word, score as a text without evidence. Other
    columns are not read; repeated rows score alike. Every task holds the model, 16 bytes a word.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_A_BATCH):
                part = batch.slice(start, ROWS_A_BATCH)
                scores = shared.value.score([word_hashes(t, names) for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    chosen = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(tidy(run), f"doc_id {kind}, score double")
