"""Secret scan: candidates from the text, false positives removed by a random forest."""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallywright.llm.common import drawn, written
from tallywright.session import fresh_folder

MIN_RUN, MIN_ASSIGNED = 12, 8
#: Bounds of what is learned: words of the dictionary, labelled findings of each class.
DICTIONARY_WORDS, MAX_LABELLED = 20_000, 10_000
TREES, DEPTH, SEED = 30, 8, 11
BEFORE, AFTER, PATH = 16, 8, 8
NUMBERS = 14
FEATURES = NUMBERS + BEFORE + AFTER + PATH
NEAR = 80

DIGIT = re.compile(r"[0-9]")
RIGHT = re.compile(r"[A-Za-z0-9+/_\-]*={0,2}")
ASSIGNED = re.compile(r"[=:][ \t]?[\"']?([^\s\"'=:,;]{%d,})" % MIN_ASSIGNED)
LETTERS = re.compile(r"[^\W\d_]+")

#: Key formats that tell a secret by themselves or by the name it is assigned to.
KNOWN = re.compile(
    r"""(?P<cloud>(?<![A-Z0-9])AKIA[A-Z0-9]{16}(?![A-Z0-9]))"""
    r"""|(?:token|secret|api_key)\s?[=:]\s?["'](?P<token>[0-9A-Za-z+/_\-]{20,})["']"""
    r"""|(?:password|passwd)\s?[=:]\s?["']?(?P<password>[^\s"']{8,})"""
    r"""|--(?:password|passwd|token|secret)[ =](?P<option>[^\s"']{8,})"""
)
#: A value that only a blank parts from the word that names it; the forest decides.
NAMED = re.compile(r"""\b(?:password|passwd|secret|token|api[_-]?key)[ \t]+["']?([^\s"']{8,})""", re.IGNORECASE)


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans that may hold a secret, in order: what :data:`KNOWN` tells, runs of key characters
    with a digit, and values that are assigned or named by the word before.

    Runs have :data:`MIN_RUN` characters or more. A run is found by its first digit, so plain
    words cost a scan for digits only. Known formats win over other spans; of others that
    overlap the one that begins first stays.
    """
    found, at = set(), 0
    while digit := DIGIT.search(text, at):
        begin = digit.start()
        while begin > 0 and (text[begin - 1].isascii() and (text[begin - 1].isalnum() or text[begin - 1] in "+/_-")):
            begin -= 1
        at = RIGHT.match(text, digit.start()).end()
        if at - begin >= MIN_RUN:
            found.add((begin, at))
    for pattern in (ASSIGNED, NAMED):
        found.update(match.span(1) for match in pattern.finditer(text))
    known = [m.span(m.lastgroup) for m in KNOWN.finditer(text)]
    starts = [begin for begin, _ in known]
    out, last = list(known), 0
    for begin, end in sorted(found.difference(known)):
        place = bisect_right(starts, begin)
        if begin >= last and all(b <= begin or a >= end for a, b in known[max(0, place - 1) : place + 1]):
            out.append((begin, end))
            last = end
    return sorted(out)


def label_known(text: str, spans: list[tuple[int, int]]) -> list[bool]:
    """Whether each span holds a value that :data:`KNOWN` tells in its neighbourhood."""
    out = []
    for begin, end in spans:
        start = max(0, begin - 24)
        hits = (m.span(m.lastgroup) for m in KNOWN.finditer(text, start, min(len(text), end + 4)) if m.lastgroup)
        out.append(any(a < end and b > begin for a, b in hits))
    return out


class Transitions:
    """Log probabilities of a letter after another, from counted words."""

    def __init__(self, words: dict[str, int]):
        pairs, firsts = Counter(), Counter()
        for word, count in words.items():
            for a, b in zip(word, word[1:], strict=False):
                pairs[a, b] += count
                firsts[a] += count
        self.logs = {ab: math.log((n + 0.5) / (firsts[ab[0]] + 20)) for ab, n in pairs.items()}
        self.words = frozenset(words)
        self.longest = max(map(len, words), default=0)

    def mean(self, value: str) -> float:
        runs = [x for x in LETTERS.findall(value.lower()) if len(x) > 1]
        steps = [self.logs.get(ab, -8.0) for run in runs for ab in zip(run, run[1:], strict=False)]
        return sum(steps) / len(steps) if steps else -10.0

    def coverage(self, value: str) -> float:
        """The share of characters in dictionary words, taken longest first from the left."""
        low, at, covered = value.lower(), 0, 0
        while at < len(low):
            for end in range(min(len(low), at + self.longest), at + 2, -1):
                if low[at:end] in self.words:
                    covered += end - at
                    at = end
                    break
            else:
                at += 1
        return covered / max(1, len(low))


def features(text: str, span: tuple[int, int], path: str | None, known: Transitions) -> list[float]:
    begin, end = span
    value = text[begin:end]
    size = len(value)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s" for c in value]
    counts = Counter(value)
    out = [0.0] * FEATURES
    out[0] = math.log(size)
    for i, kind in enumerate("duls"):
        out[1 + i] = kinds.count(kind) / size
    out[5] = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / size
    out[6] = -sum(n / size * math.log2(n / size) for n in counts.values())
    out[7] = known.mean(value)
    out[8] = float(all(c in "0123456789abcdef" for c in value))
    out[9] = len(counts) / size
    out[10] = known.coverage(value)
    out[11] = sum(a == b for a, b in zip(value, value[1:], strict=False)) / size
    before, after = text[max(0, begin - NEAR) : begin], text[end : end + NEAR]
    out[12] = float(before[-1:] in ("=", ":") or before[-2:-1] in ("=", ":"))
    out[13] = float(before[-1:] in ('"', "'"))
    place = NUMBERS
    for words, width in ((LETTERS.findall(before)[-2:], BEFORE), (LETTERS.findall(after)[:1], AFTER), ([path] if path else [], PATH)):
        for word in words:
            out[place + zlib.crc32(word.lower().encode()) % width] = 1.0
        place += width
    return out


def count_words(docs: DataFrame, text: str = "text", size: int = DICTIONARY_WORDS) -> dict[str, int]:
    """The ``size`` most frequent words of letters over all whole texts, and their counts.

    Tasks count their own words, so what is moved are counts; only the dictionary, bounded
    by ``size``, reaches the driver. Ties are broken by code point.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(counts: Counter) -> pa.RecordBatch:
            words: Counter = Counter()
            for word, n in counts.items():
                word = word.strip(".,;:!?\"'()")
                if 3 <= len(word) <= 24 and word.isalpha():
                    words[word.lower()] += n
            return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"])

        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update((text.as_py() or "").split())
                if len(counts) > 200_000:
                    yield emit(counts)
                    counts.clear()
        yield emit(counts)

    counted = docs.select(docs[text].cast("string")).mapInArrow(run, "word string, n long")
    counted = written(counted.groupBy("word").agg(F.sum("n").alias("n")), "secret-words")
    return {r["word"]: r["n"] for r in _most(counted, size).collect()}


def _most(counted: DataFrame, size: int) -> DataFrame:
    """The ``size`` rows of ``(word, n)`` with the largest ``n``, then by code point.

    A histogram over counts, exact for small ones and in steps of a hundredth above, tells
    where the cut lies; words surely above it are taken without a sort. Those of the step that
    holds the cut are cut again by count, and equal counts by their first characters.
    """
    step = F.when(F.col("n") < 1024, F.col("n")).otherwise(1024 + F.floor(F.log(F.col("n") / 1024) * 100)).cast("long")
    taken, rest, wanted = None, counted, size
    for level in (step, F.col("n"), -F.coalesce(F.ascii("word"), F.lit(0)), -F.coalesce(F.ascii(F.substring("word", 2, 1)), F.lit(0))):
        placed = rest.withColumn("level", level)
        groups = placed.groupBy("level").count()
        upto = Window.orderBy(F.desc("level"))
        cut = groups.withColumn("upto", F.sum("count").over(upto)).where(F.col("upto") > wanted).orderBy(F.desc("level")).first()
        if cut is None:
            part, rest = placed, None
        else:
            part, rest = placed.where(F.col("level") > cut["level"]), placed.where(F.col("level") == cut["level"]).drop("level")
            wanted -= cut["upto"] - cut["count"]
        part = part.select("word", "n")
        taken = part if taken is None else taken.unionByName(part)
        if rest is None or wanted == 0:
            return taken
    return taken.unionByName(rest.orderBy("word").limit(wanted))


def find_candidates(docs: DataFrame, known: Transitions, doc_id: str = "doc_id", text: str = "text", path: str | None = "source") -> DataFrame:
    """``(doc_id, begin, end, value, looks_known, features)``, a row for each candidate."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for key, content, where in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                spans = candidates(content) if content else []
                for span, label in zip(spans, label_known(content, spans) if spans else [], strict=True):
                    found = (key, *span, content[span[0] : span[1]], label, features(content, span, where, words))
                    for column, value in zip(rows, found, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows[0], batch.schema.field(0).type),
                    pa.array(rows[1], pa.int64()),
                    pa.array(rows[2], pa.int64()),
                    pa.array(rows[3], pa.string()),
                    pa.array(rows[4], pa.bool_()),
                    pa.array(rows[5], pa.list_(pa.float64())),
                ],
                ["doc_id", "begin", "end", "value", "looks_known", "features"],
            )

    where = docs[path].cast("string") if path else F.lit(None).cast("string")
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"), where.alias("path"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, begin long, end long, value string, looks_known boolean, features array<double>")


@dataclass
class Forest:
    """Trees as arrays, a row for each tree: at node ``i`` go to ``left`` or ``right`` by whether
    ``feature`` is at most ``threshold``; a leaf has a negative feature and the ``share`` of secrets."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The mean over trees of the share in the leaf that a row ends in."""
        out = np.zeros(len(rows))
        for tree in range(len(self.feature)):
            at, moving = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
            while len(moving):
                feature = self.feature[tree, at[moving]]
                moving, feature = moving[feature >= 0], feature[feature >= 0]
                here = at[moving]
                below = rows[moving, feature] <= self.threshold[tree, here]
                at[moving] = np.where(below, self.left[tree, here], self.right[tree, here])
            out += self.share[tree, at]
        return out / len(self.feature)


def _forest(model, spark) -> Forest:
    """The trees of a fitted model, by way of its stored form; trees x nodes rows, bounded by both settings."""
    folder = fresh_folder(spark, "secret-forest")
    model.write().save(folder)
    data = spark.read.parquet(f"{folder}/data").select("treeID", "nodeData.*")
    nodes = data.select("treeID", "id", "impurityStats", "leftChild", "rightChild", "split.*").collect()
    trees, size = model.getNumTrees, 1 + max(r["id"] for r in nodes)
    out = Forest(np.full((trees, size), -1, np.int64), *(np.zeros((trees, size), k) for k in (np.float64, np.int64, np.int64, np.float64)))
    for r in nodes:
        place, stats = (r["treeID"], r["id"]), r["impurityStats"]
        out.share[place] = stats[1] / sum(stats) if sum(stats) else 0.5
        if r["leftChild"] >= 0:
            out.feature[place], out.threshold[place] = r["featureIndex"], r["leftCategoriesOrThreshold"][0]
            out.left[place], out.right[place] = r["leftChild"], r["rightChild"]
    return out


def train(labelled: DataFrame, max_labelled: int = MAX_LABELLED, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> Forest | None:
    """A forest from ``features`` and boolean ``label``; None unless both labels are there.

    At most ``max_labelled`` findings of each label are learned from, first in the order of
    a hash of their place, and in one order, so that reruns agree. Null labels are left out.
    """
    ranked = labelled.withColumn("place", F.xxhash64("doc_id", "begin", "end"))
    parts = [drawn(ranked.where(F.col("label") == kind), F.col("place"), max_labelled, F.col("value")) for kind in (True, False)]
    sample = written(reduce(DataFrame.unionByName, parts).select(F.col("label").cast("double").alias("label"), "place", "features"), "secret-sample")
    if sample.select("label").distinct().count() < 2:
        return None
    ordered = sample.coalesce(1).sortWithinPartitions("label", "place", "features")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, labelCol="label", featuresCol="vector")
    return _forest(forest.fit(ordered.select("label", array_to_vector("features").alias("vector"))), labelled.sparkSession)


def score(found: DataFrame, forest: Forest | None) -> DataFrame:
    """``found`` with ``score``, the forest's probability of a secret; 0.5 without a forest."""
    if forest is None:
        return found.withColumn("score", F.lit(0.5))
    shared = found.sparkSession.sparkContext.broadcast(forest)
    column = found.columns.index("features")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            scores = shared.value.score(rows) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, "score"])

    return found.mapInArrow(run, StructType([*found.schema.fields, StructField("score", DoubleType())]))


def scan(
    docs: DataFrame,
    teaching=None,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = "source",
    labels: DataFrame | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """``(doc_id, begin, end, value, score, secret)`` for every candidate of every whole text.

    ``begin`` and ``end`` count code points. The forest learns from labelled findings:
    ``labels`` (``doc_id``, ``begin``, ``end``, ``label``) where reviewers have left some, else
    findings whose format tells (:data:`KNOWN`). ``teaching`` is a condition on ``doc_id`` for
    the findings to learn from; all if None. Features are length, kinds of characters and their
    changes, letter transitions, dictionary coverage, path and neighbouring words; the known
    formats are not among them. Null and empty texts have no candidates, a null path no path
    feature. Rows that repeat a document repeat its findings. Other columns are not read.
    """
    known = Transitions(count_words(docs, text))
    found = written(find_candidates(docs, known, doc_id, text, path), "secret-candidates")
    taught = found if teaching is None else found.where(teaching)
    if labels is None:
        taught = taught.withColumn("label", F.col("looks_known"))
    else:
        given = labels.select(*(F.col(c).alias(f"l_{c}") for c in ("doc_id", "begin", "end")), "label").dropDuplicates(["l_doc_id", "l_begin", "l_end"])
        taught = taught.join(given, [F.col(c) == F.col(f"l_{c}") for c in ("doc_id", "begin", "end")])
    scored = score(found, train(taught))
    return scored.select("doc_id", "begin", "end", "value", "score", (F.col("score") >= threshold).alias("secret"))
