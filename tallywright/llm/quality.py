"""Quality classifier learned from positive and unlabelled documents.

Trusted documents are the positives, web text without a label is a mixture of both
classes. A small network over statistics of the whole text minimises the non-negative
unbiased risk: with the share ``prior`` of good documents in the mixture,

    prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)])

where the second part is climbed instead of descended while it is negative. The share is
estimated from the scores of networks trained on half of the samples (the lowest ratio of
the parts of both other halves that lie above a threshold).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import drawn, tidy, written

#: Bounds of the samples a model is fitted on.
POSITIVES, UNLABELLED = 6_000, 12_000
CLASSES = 9
STATISTICS = 16
FEATURES = CLASSES * CLASSES + STATISTICS
HIDDEN, EPOCHS, BATCH, SEED = 24, 40, 512, 5
ROWS_A_BATCH = 1024


@lru_cache(maxsize=1)
def char_kinds() -> np.ndarray:
    """By code point up to 0xFFFF: lower, upper, other letter, digit, space, line end, stop, mark, rest."""
    out = np.full(0x10001, 8, dtype=np.uint8)
    for point in range(0x10000):
        char, kind = chr(point), unicodedata.category(chr(point))
        if kind == "Ll":
            out[point] = 0
        elif kind == "Lu":
            out[point] = 1
        elif kind[0] == "L" or kind[0] == "M":
            out[point] = 2
        elif kind[0] == "N":
            out[point] = 3
        elif char in "\n\r":
            out[point] = 5
        elif char.isspace():
            out[point] = 4
        elif char in ".,;:?'\"-()":
            out[point] = 6
        elif kind[0] in "PS":
            out[point] = 7
    return out


def features(text: str | None) -> np.ndarray:
    """Shares of pairs of neighbouring character kinds, and statistics of words and lines."""
    out = np.zeros(FEATURES, dtype=np.float32)
    if not text:
        return out
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    kinds = char_kinds()[np.minimum(points, 0x10000)].astype(np.int64)
    pairs = np.bincount(kinds[:-1] * CLASSES + kinds[1:], minlength=CLASSES * CLASSES)
    out[: CLASSES * CLASSES] = np.sqrt(pairs / max(1, len(kinds) - 1))
    share = np.bincount(kinds, minlength=CLASSES) / len(kinds)
    words, lines = text.split(), [line for line in text.split("\n") if line.strip()]
    different = len(set(words))
    longest = max(map(len, words), default=0)
    stat = out[CLASSES * CLASSES :]
    stat[:CLASSES] = share
    stat[9] = np.log1p(len(words)) / 10
    stat[10] = different / max(1, len(words))
    # Vocabulary grows with the root of the length; this ratio hardly depends on it.
    stat[11] = different / max(1.0, len(words) ** 0.8)
    stat[12] = 1 - len(set(lines)) / max(1, len(lines))
    stat[13] = len(words) / len(kinds)
    stat[14] = min(1.0, longest / 100)
    stat[15] = sum(a == b for a, b in zip(words, words[1:], strict=False)) / max(1, len(words))
    return out


@dataclass
class Model:
    """Scores are the network's; ``prior`` is what everything gets where nothing was learned."""

    prior: float
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray] | None

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(rows), self.prior)
        return 1 / (1 + np.exp(-np.clip(self._raw(self._scaled(rows))[0], -30, 30)))

    def _scaled(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -6, 6)

    def _raw(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w, b, v, c = self.weights
        hidden = np.tanh(x @ w + b)
        return hidden @ v + c[0], hidden


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = SEED) -> Model:
    """Mini-batch Adam on the non-negative risk with the logistic loss."""
    both = np.concatenate([positive, unlabelled]).astype(np.float64)
    rng = np.random.RandomState(seed)
    model = Model(prior, both.mean(axis=0), both.std(axis=0) + 1e-3, None)
    p, u = model._scaled(positive), model._scaled(unlabelled)
    model.weights = [
        rng.randn(FEATURES, HIDDEN) / np.sqrt(FEATURES),
        np.zeros(HIDDEN),
        rng.randn(HIDDEN) / np.sqrt(HIDDEN),
        np.zeros(1),
    ]
    first, second = [np.zeros_like(w) for w in model.weights], [np.zeros_like(w) for w in model.weights]
    step = 0
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    loss_as_bad = lambda z: np.logaddexp(0, z)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(u))
        for start in range(0, len(u), BATCH):
            xu = u[order[start : start + BATCH]]
            xp = p[rng.randint(0, len(p), size=min(BATCH, len(p)))]
            zp, hp = model._raw(xp)
            zu, hu = model._raw(xu)
            bad = loss_as_bad(zu).mean() - prior * loss_as_bad(zp).mean()
            if bad >= 0:
                gp = (-prior * (1 - sigmoid(zp)) - prior * sigmoid(zp)) / len(zp)
                gu = sigmoid(zu) / len(zu)
            else:
                gp = prior * sigmoid(zp) / len(zp)
                gu = -sigmoid(zu) / len(zu)
            w, _, v, _ = model.weights
            grads = [0.0] * 4
            for x, h, g in ((xp, hp, gp), (xu, hu, gu)):
                back = g[:, None] * v * (1 - h * h)
                grads = [a + b for a, b in zip(grads, (x.T @ back, back.sum(axis=0), h.T @ g, np.array([g.sum()])), strict=True)]
            step += 1
            rate = 0.005 * (1 - epoch / EPOCHS) + 0.0005
            for i, grad in enumerate(grads):
                grad = grad + 1e-4 * model.weights[i]
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad * grad
                model.weights[i] -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return model


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, confidence: float = 0.1) -> float:
    """The share of positives in the mixture, from scores of both samples.

    Above a threshold that only positives pass, the mixture holds ``prior`` times the part
    of the positives that do. The threshold with the lowest upper bound is taken, with
    margins for the sizes of the samples.
    """
    p, u = np.sort(positive), np.sort(unlabelled)
    cuts = np.quantile(p, np.linspace(0.02, 0.9, 80))
    above_p = 1 - np.searchsorted(p, cuts, side="left") / len(p)
    above_u = 1 - np.searchsorted(u, cuts, side="left") / len(u)
    margin = np.sqrt(np.log(4 / confidence) / 2) * (1 / np.sqrt(len(p)) + 1 / np.sqrt(len(u)))
    best = np.argmin((above_u + margin) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, seed: int = SEED) -> Model:
    """Without a sample of either kind every text scores ``prior``, one half if unknown."""
    if not len(positive) or not len(unlabelled):
        return Model(0.5 if prior is None else prior, np.zeros(FEATURES), np.ones(FEATURES), None)
    if prior is None:
        prior = 0.5
        if min(len(positive), len(unlabelled)) > 1:
            # Half of each sample trains a network, the other half is measured by it; the
            # second one knows the share that the first one found, and tells it better.
            for _ in range(2):
                half = train(positive[::2], unlabelled[::2], prior, seed)
                prior = estimate_prior(half.score(positive[1::2]), half.score(unlabelled[1::2]))
    return train(positive, unlabelled, prior, seed)


def _featured(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(t).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(made, pa.binary())], ["trusted", "place", "features"]
            )

    return rows.mapInArrow(run, "trusted boolean, place long, features binary")


def learn(
    docs: DataFrame,
    trusted: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    prior: float | None = None,
    seed: int = SEED,
) -> Model:
    """A model from ``docs`` (``doc_id``, ``text``) and the ids in ``trusted`` (``doc_id``).

    At most ``positives`` trusted and ``unlabelled`` other ids are drawn, in the order of a
    hash of the id, and of each kind at most twice as many of their different texts, in the
    order of a hash of both; only their features reach the driver. The unlabelled sample is
    drawn from all of ``docs``, trusted ones included, as the mixture is. Null ids are not
    drawn, and an id that several rows have counts with each of its texts, up to the bounds.
    """
    ids = docs.select(docs[doc_id].alias("id")).where("id IS NOT NULL").distinct()
    good = trusted.select(trusted[doc_id].alias("id")).where("id IS NOT NULL").distinct()
    pick = lambda rows, n, salt: drawn(rows, F.xxhash64("id", F.lit(salt)), n, F.col("id"))
    good = pick(good.join(ids, "id", "left_semi"), positives, 1).withColumn("trusted", F.lit(True))
    sampled = written(good.unionByName(pick(ids, unlabelled, 2).withColumn("trusted", F.lit(False))), "quality-ids")
    rows = docs.select(docs[doc_id].alias("row_id"), docs[text].cast("string").alias("text"))
    # Bounded by the two sample sizes whatever the input.
    rows = rows.join(F.broadcast(sampled), F.col("row_id") == F.col("id"))
    rows = rows.withColumn("place", F.xxhash64("row_id", "text")).select("trusted", "place", "text")
    made = written(_featured(rows).dropDuplicates(["trusted", "place"]), "quality-sample")
    sample = {}
    for kind, n in ((True, positives), (False, unlabelled)):
        found = drawn(made.where(F.col("trusted") == kind), F.col("place"), 2 * n).collect()
        sample[kind] = sorted(r["features"] for r in found)
        sample[kind] = [np.frombuffer(x, np.float32) for x in sample[kind]]
    rng = np.random.RandomState(seed)
    parts = [np.array(sample[k], dtype=np.float64).reshape(-1, FEATURES) for k in (True, False)]
    return fit(*(part[rng.permutation(len(part))] for part in parts), prior=prior, seed=seed)


def score_documents(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every row's whole text; null and empty texts score 0.

    Other columns are not read and never enter a score; repeated rows score alike. The
    model's size does not depend on the data.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_A_BATCH):
                part = batch.slice(start, ROWS_A_BATCH)
                texts = part.column(1).to_pylist()
                scores = tool.score(np.array([features(t) for t in texts], dtype=np.float64).reshape(-1, FEATURES))
                scores = np.where([bool(t) for t in texts], scores, 0.0)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    chosen = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(tidy(run), f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, columns unchanged.

    Rows are judged where they are read; null and empty texts go.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_A_BATCH):
                part = batch.slice(start, ROWS_A_BATCH)
                texts = part.column(place).to_pylist()
                scores = tool.score(np.array([features(t) for t in texts], dtype=np.float64).reshape(-1, FEATURES))
                yield part.filter(pa.array((scores >= threshold) & np.array([bool(t) for t in texts])))

    return docs.mapInArrow(tidy(run), docs.schema)
