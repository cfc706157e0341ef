"""Learned operators by held-out accuracy; vector search against brute force; the pipeline."""

from __future__ import annotations

import glob
import importlib.util
import random

import numpy as np
import pytest
from llm_cases import Union, documents, sentence
from pyspark.sql import functions as F

import corpus_pipeline
from tallywright.llm import embedding_dedup, language_id, quality, queries, secrets
from tallywright.llm.common import components, table
from tallywright.llm.hnsw import Graph
from tallywright.session import shared_folder


@pytest.fixture(scope="module")
def nothing(spark):
    return documents(spark).where("false")


# --- components -----------------------------------------------------------------------


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 120)] + [(7, 7), (200, 150), (None, 3)]
    edges += [(rng.randrange(300, 500), rng.randrange(300, 500)) for _ in range(90)]
    union = Union()
    for a, b in edges:
        if a is not None:
            union.join(a, b)
    nodes = spark.range(0, 520).withColumnRenamed("id", "node")
    found = components(nodes, spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == {i: union.find(i) for i in range(520)}


# --- 7: vectors -----------------------------------------------------------------------


def clusters(seed: int = 1) -> np.ndarray:
    rng = np.random.RandomState(seed)
    centres = rng.randn(300, 24)
    groups = [centres + 0.02 * rng.randn(*centres.shape), centres[:40] + 0.02 * rng.randn(40, 24)]
    groups.append(centres[0] + 0.05 * rng.randn(120, 24))
    return np.concatenate(groups)


def brute(vectors: dict[int, np.ndarray], least: float = 0.95) -> dict[int, tuple[int, int]]:
    ids = sorted(vectors)
    rows = np.array([vectors[i] / np.linalg.norm(vectors[i]) for i in ids])
    near = rows @ rows.T >= least
    union = Union()
    for a, b in zip(*np.nonzero(near), strict=True):
        union.join(ids[a], ids[b])
    return {i: (int(near[k].sum()) - 1, union.find(i)) for k, i in enumerate(ids)}


def test_vectors_against_brute_force(spark):
    made = clusters()
    vectors = dict(enumerate(made))
    vectors |= {1000 + i: made[5] for i in range(30)}
    odd = [(5000, None), (5001, []), (5002, [0.0] * 24), (5003, [float("nan")] * 24), (5004, [None] * 24), (5005, [1.0] * 3)]
    rows = [(i, [float(x) for x in v], "junk") for i, v in vectors.items()] + [(i, v, "junk") for i, v in odd]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string")
    found = {r["vec_id"]: r for r in embedding_dedup.near_vectors(frame, min_shards=3, block_rows=200).collect()}
    expected = brute(vectors)
    assert {i: (r["n_links"], r["component_id"]) for i, r in found.items() if i < 5000} == expected
    for i, _ in odd:
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True)
    empty = embedding_dedup.near_vectors(frame.where("false"))
    assert empty.count() == 0


def test_graphs_are_written_once_in_small_parts(spark, monkeypatch):
    """What a JVM holds at once does not grow with a shard; several rounds of shards find what one would."""
    monkeypatch.setattr(embedding_dedup, "CHUNK_BYTES", 4_096, raising=False)
    vectors = dict(enumerate(clusters(5)))
    short = {1000 + i: v[:7] for i, v in vectors.items() if i < 90}
    rows = [(i, [float(x) for x in v]) for i, v in (vectors | short).items()]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    before = set(glob.glob(f"{shared_folder(spark)}/vector-graphs-*"))
    found = embedding_dedup.near_vectors(frame, min_shards=1, shard_rows=150, block_rows=64).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == brute(vectors) | brute(short)
    (folder,) = set(glob.glob(f"{shared_folder(spark)}/vector-graphs-*")) - before
    graphs = spark.read.parquet(folder)
    data = [name for name, kind in graphs.dtypes if kind == "binary"]
    sizes = graphs.select(*[F.max(F.length(name)).alias(name) for name in data]).first()
    assert data and max(sizes) <= 4_096
    # Whole graphs have more bytes than their vectors, and no part is there twice.
    assert graphs.agg(F.sum(F.length(data[0]))).first()[0] > 8 * sum(map(len, [*vectors.values(), *short.values()]))
    assert graphs.select("dims", "shard", "part").distinct().count() == graphs.count()


def test_pairs_of_a_dense_group_come_in_parts():
    rng = np.random.RandomState(6)
    rows = rng.randn(12) + 0.01 * rng.randn(9_000, 12)
    graph = Graph(rows / np.linalg.norm(rows, axis=1, keepdims=True))
    sizes = [len(q) for q, _ in graph.pairs(graph.vectors[:300], 0.95, 400)]
    assert sum(sizes) == 300 * 9_000 and max(sizes) <= 256 * 8_192


def test_trees_grow_edge_by_edge():
    rng = np.random.RandomState(8)
    root, union = np.arange(500), Union()
    for _ in range(12):
        one, two = rng.randint(0, 500, (2, 30))
        embedding_dedup._join(root, one, two)
        for a, b in zip(one.tolist(), two.tolist(), strict=True):
            union.join(a, b)
        assert root.tolist() == [union.find(i) for i in range(500)]


def test_graph_recall():
    rows = clusters(2)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    graph = Graph(rows)
    q, i = graph.search(graph.vectors, 16)
    assert (np.bincount(q[q == i], minlength=len(rows)) == 1).mean() > 0.98
    q, i = graph.within(rows, 0.95, 8, 100, 0.99)
    assert len(q) >= 0.99 * (rows @ rows.T >= 0.95).sum()


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def test_vectors_that_nothing_leads_to_are_attached():
    rng = np.random.RandomState(7)
    centre = rng.randn(24)
    core, shell = centre + 0.1 * rng.randn(3_000, 24), centre + 2.0 * rng.randn(60, 24)
    graph = Graph(unit(np.concatenate([shell, core])))
    for links in graph.layers:
        seen, fresh = {0}, [0]
        while fresh:
            fresh = list({int(n) for at in fresh for n in links[at] if n >= 0} - seen)
            seen.update(fresh)
        assert len(seen) == len(links)


def test_graph_whose_upper_layer_takes_several_batches():
    rng = np.random.RandomState(2)
    graph = Graph(unit(rng.randn(20_000, 8)))
    assert graph.sizes[-2] > 512
    q, i = graph.search(graph.vectors[::20], 16)
    assert (20 * q == i).sum() >= 0.98 * 1_000


def test_audit_is_not_empty_where_audited_queries_have_no_links():
    rng = np.random.RandomState(4)
    graph = Graph(unit(rng.randn(2_000, 32)))
    queries = unit(graph.vectors + 0.05 * rng.randn(2_000, 32))
    queries[::32] = unit(rng.randn(63, 32))
    truth = queries @ graph.vectors.T >= 0.95
    assert not truth[::32].any()
    q, i = graph.within(queries, 0.95, 1, 63, 0.99)
    assert len(q) >= 0.99 * truth.sum()


def test_audit_counts_each_query_once_over_all_shards(spark):
    # Query 1 has 99 links in one shard, all found; queries 2 and 3 have one each, in others, missed at first.
    rows = [(4, 1, 0, 99, 0), (4, 2, 0, 1, 0), (4, 2, 0, 0, 1), (4, 3, 0, 1, 0), (4, 3, 0, 0, 1), (4, 3, 1, 0, 1), (8, 1, 0, 5, 0)]
    audited = spark.createDataFrame(rows, "dims int, node long, step int, links long, missed long")
    steps = lambda recall: {r["dims"]: r["step"] for r in embedding_dedup._steps(audited, recall).collect()}
    assert (steps(0.99), steps(0.5), steps(0.3)) == ({4: 2}, {4: 1}, {})


# --- 1: quality -----------------------------------------------------------------------


def test_prior_and_scores_from_positives_and_a_mixture():
    rng = np.random.RandomState(0)
    good, bad = rng.randn(3_000, quality.FEATURES) * 0.3, rng.randn(800, quality.FEATURES) * 0.3
    bad[:, :6] += 1.0
    mixture = np.concatenate([good[2_000:], bad[:300]])
    model = quality.fit(good[:2_000], mixture)
    assert abs(model.prior - 1_000 / 1_300) < 0.06
    assert (model.score(good) >= 0.5).mean() > 0.95
    assert (model.score(bad[300:]) < 0.5).mean() > 0.95


def test_quality_on_held_out_rows(spark, sf_small):
    scored = queries.op1_quality(spark, sf_small).where("held_out")
    labels = table(spark, sf_small, "labels")
    rows = scored.join(labels, "doc_id").select("score", "quality").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_of_awkward_rows(spark, nothing):
    docs = documents(spark)
    model = quality.learn(docs, docs.where("doc_id > 3"))
    rows = quality.score_documents(docs, model).collect()
    assert len(rows) == docs.count()
    assert all(r["score"] == 0 for r in rows if r["doc_id"] in (0, 1))
    unknown = quality.learn(nothing, nothing)
    assert unknown.weights is None and quality.score_documents(docs, unknown).count() == docs.count()
    kept = quality.keep_good(docs, unknown)
    assert kept.columns == docs.columns
    assert kept.where("text is null or text = ''").count() == 0


# --- 8: language ----------------------------------------------------------------------


def test_longest_matches_of_one_language():
    model = language_id.fit({"x": ["abcabc"], "y": ["zzzyyy"]}, letters=10)
    phrases, sizes = model.phrases(["abcabcab", "zzyy"])
    assert sizes.tolist() == [8, 4]
    assert phrases[:, 0].tolist() == [2, 4]
    assert phrases[:, 1].tolist() == [8, 1]


def test_pieces_do_not_change_the_language():
    model = language_id.fit({"x": ["the thing is that"], "y": ["der ding ist das"]})
    names, scores = model.predict(["that is the thing " * 500, "das ist der ding", None, "", "123 !!", "ß"])
    assert names[:2] == ["x", "y"] and names[2:5] == ["und"] * 3 and names[5] in ("x", "y")
    assert scores[2:5].tolist() == [0, 0, 0] and ((0 <= scores) & (scores <= 1)).all()


def test_every_script_has_its_letters():
    texts = {
        "ar": "كل الناس يولدون أحرارا متساوين في الكرامة والحقوق",
        "el": "όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι",
        "hi": "सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता",
        "ja": "すべての人間は、生まれながらにして自由であり",
        "ko": "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에",
        "ne": "सबै व्यक्तिहरू जन्मजात स्वतन्त्र हुन् ती सबैको समान अधिकार",
        "ru": "все люди рождаются свободными и равными в своем достоинстве",
        "xx": "\U0001e900\U0001e901\U0001e902 \U0001e903\U0001e904\U0001e905",
        "zh": "人人生而自由在尊严和权利上一律平等他们赋有理性和良心",
    }
    latin = {"en": "the quick brown fox jumps over the lazy dog " * 40, "fr": "portez ce vieux whisky au juge blond qui fume " * 40}
    model = language_id.fit({k: [v] for k, v in (texts | latin).items()})
    names, _ = model.predict([v[len(v) // 3 :] for v in texts.values()])
    assert names == list(texts)


def test_scripts_without_blanks_are_told_apart_beside_common_alphabets():
    alphabets = {"el": "αβγδεζηθικλμνξοπρστυφχψω", "en": "abcdefghijklmnopqrstuvwxyz", "ru": "абвгдежзийклмнопрстуфхцчшщъыьэюя"}
    rare = {"ja": "すべての人間は生まれながらにして自由で", "ko": "모든인간은태어날때부터자유로우며그존엄", "zh": "人人生而自由在尊严和权利上一律平等他们"}
    model = language_id.fit({k: [v * 20] for k, v in alphabets.items()} | {k: [v] for k, v in rare.items()})
    names, _ = model.predict([v[5:15] for v in rare.values()])
    assert names == list(rare)


def test_language_learns_from_whole_rows(spark):
    rows = [(1, "a" * 5_000 + " end", "x"), (None, "b" * 50_000 + " end", "y"), (None, "b" * 50_000 + " end", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = language_id.labelled_sample(docs, "doc_id", "text", "lang", 40_000, 400)
    assert sample == {"x": [rows[0][1]], "y": [rows[1][1]]}


def test_language_on_held_out_rows(spark, sf_small):
    found = queries.op8_language_id(spark, sf_small).where("held_out").join(table(spark, sf_small, "documents"), "doc_id")
    assert found.where("lang = lang_pred").count() / found.count() > 0.95


def test_language_of_awkward_rows(spark, nothing):
    docs = documents(spark)
    assert language_id.identify(docs, docs).count() == docs.count()
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(nothing, docs).count() == 0


# --- 10: secrets ----------------------------------------------------------------------


def secret_documents(spark):
    rng = random.Random(6)
    hexes = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    texts = []
    for i in range(240):
        kinds = [f'token = "{hexes(40)}"', f"password={hexes(18)}", "AKIA" + "".join(rng.choices("ABCDEFGH234567", k=16)), str(rng.randrange(10**15, 10**16))]
        texts.append(f"{sentence(rng, 20)} {kinds[i % 4]} {sentence(rng, 10)}")
    return documents(spark, texts)


def test_secrets_on_held_out_findings(spark):
    docs = secret_documents(spark).where("doc_id is not null")
    found = secrets.scan(docs, teaching=F.col("doc_id") % 3 != 1).where("doc_id % 3 = 1").distinct().collect()
    texts = dict((r["doc_id"], r["text"]) for r in docs.collect())
    assert {r["doc_id"] for r in found} == {i for i in texts if i % 3 == 1}
    right = [r["secret"] == (r["doc_id"] % 4 != 3) for r in found]
    assert sum(right) / len(right) > 0.95
    assert all(texts[r["doc_id"]][r["begin"] : r["end"]] == r["value"] for r in found)


def test_given_labels_decide(spark):
    docs = secret_documents(spark).where("doc_id is not null")
    numbers = secrets.scan(docs).select("doc_id", "begin", "end", (F.col("doc_id") % 4 == 3).alias("label"))
    found = secrets.scan(docs, labels=numbers).collect()
    assert sum(r["secret"] == (r["doc_id"] % 4 == 3) for r in found) / len(found) > 0.95


def test_secrets_of_awkward_rows(spark, nothing):
    docs = documents(spark, [None, "", "password=", "x" * 50_000 + "1", "=" * 100, "token: 'abcd12345678'"])
    rows = secrets.scan(docs).collect()
    assert {r["doc_id"] for r in rows} == {3, 5}
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert secrets.scan(nothing).count() == 0


# --- pipeline -------------------------------------------------------------------------


def test_stages_chain_on_small_tables(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    columns, left = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, left = left, stage(spark, left, sf_small)
        assert left.columns == columns, name
        assert left.select("doc_id").subtract(before.select("doc_id")).count() == 0
    labels = table(spark, sf_small, "labels")
    first = corpus_pipeline.keep_quality(spark, docs, sf_small)
    good = labels.where("quality = 1").select("doc_id")
    assert good.join(first, "doc_id", "left_semi").count() > 0.9 * good.count()
    final = corpus_pipeline.run(spark, sf_small)
    assert set(final.columns) == {"doc_id", "n_tokens", "ids", "decoded"}
    assert final.count() == left.count()
    assert final.select("decoded").exceptAll(left.select("text")).count() == 0


def test_nothing_else_imports_the_subpackage():
    root = importlib.util.find_spec("tallywright").submodule_search_locations[0]
    from pathlib import Path

    for path in Path(root).rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path
