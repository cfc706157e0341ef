"""Operators with one right answer for each row, against brute force and the library."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from llm_cases import (
    awkward_texts,
    by_text,
    documents,
    exact_rows,
    near_components,
    pairs_of,
    repeated,
    sentence,
)
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallywright.llm import bpe, exact_dedup, minhash, mixing, queries, suffix_dedup, url_filter
from tallywright.llm.suffix_sort import suffix_arrays

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark)


@pytest.fixture(scope="module")
def nothing(spark, docs):
    return spark.createDataFrame([], docs.schema)


# --- 5: exact dedup -------------------------------------------------------------------


@pytest.mark.parametrize("singles", [True, False])
def test_exact_groups(docs, singles):
    found = exact_dedup.exact_groups(docs, keep_singles=singles)
    expected = exact_rows(pairs_of(docs))
    assert by_text(found.collect()) == by_text(r for r in expected if singles or r[2] > 1)


def test_short_prefix_leaves_the_full_hash_to_decide(docs):
    found = exact_dedup.exact_groups(docs, keep_singles=True, prefix_chars=1)
    assert by_text(found.collect()) == by_text(exact_rows(pairs_of(docs)))


def test_dropping_exact_copies_keeps_columns(docs):
    left = exact_dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns
    kept = {r[4] for r in exact_rows(pairs_of(docs))}
    assert {r[4] for r in exact_rows(pairs_of(left))} == kept


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    base = sentence(random.Random(3), 80)
    near = base.replace(base.split()[40], "changed", 1)
    rows = [(1, base), (1, base), (None, base), (None, "none here"), (None, "none here"), (2, "other words"), (1, near), (None, near)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    exact = exact_dedup.drop_exact_copies(docs)
    assert by_text(exact.collect()) == by_text([(1, base), (None, "none here"), (2, "other words"), (1, near)])
    left = minhash.drop_near_duplicates(docs).collect()
    assert len(left) == 3 and {r["text"] for r in left} - {base, near} == {"none here", "other words"}


# --- 2: repeated strings --------------------------------------------------------------


def test_suffix_arrays_of_many_strings():
    rng = np.random.RandomState(0)
    for kinds in (1, 2, 3, 200):
        parts = [np.append(rng.randint(1, kinds + 1, size=rng.randint(0, 50)), 0) for _ in range(40)]
        order, starts = suffix_arrays(np.concatenate(parts), np.array([len(p) for p in parts]))
        for part, start in zip(parts, starts, strict=True):
            expected = sorted(range(len(part)), key=lambda i: part[i:].tolist())
            assert (order[start : start + len(part)] - start).tolist() == expected


@pytest.mark.parametrize("length, piece, sorted_at_most", [(200, 51, 16), (30, 8, 16), (30, 8, 1), (12, 12, 3)])
def test_repeated_spans(docs, length, piece, sorted_at_most):
    texts = docs.where("length(text) < 20000 or text is null")
    found = suffix_dedup.repeated_spans(texts, length=length, piece=piece, max_sorted=sorted_at_most)
    got = [
        (r["doc_id"], r["n_bytes"], sum(s["end"] - s["begin"] for s in r["spans"]), len(r["spans"]), r["digest"])
        for r in found.withColumn("digest", F.sha2("kept", 256)).collect()
    ]
    assert by_text(got) == by_text(repeated(pairs_of(texts), length))


def test_long_text_repeats_itself_across_chunks(spark):
    text = sentence(random.Random(3), 9_000, 8_000)
    passage = text[1_000:1_400]
    docs = documents(spark, [text + "#" + passage, "tail-" + passage]).dropDuplicates(["doc_id"])
    found = [r for r in suffix_dedup.repeated_spans(docs).collect() if r["doc_id"] == 0]
    assert [(s["begin"], s["end"]) for s in found[0]["spans"]][0] == (1_000, 1_400)
    assert found[0]["spans"][-1]["end"] == len(text) + 401


# --- 3: BPE ---------------------------------------------------------------------------


def test_same_ids_as_the_library(docs):
    library = Tokenizer.from_file(VOCABULARY)
    for row in bpe.decode_documents(bpe.encode_documents(docs, VOCABULARY), VOCABULARY, into="decoded").collect():
        assert len(row["ids"]) == 4 * row["n_tokens"]
    texts = [t for t in awkward_texts() if t is not None]
    tool = bpe.tokenizer(bpe.read_spec(VOCABULARY))
    rng = random.Random(2)
    letters = ["ab", "a ", "aab \n", "0123 ab.!'", "éèçÀß ñó\t\n", "the and ing tion", "日本語 \u2003x"]
    texts += ["".join(rng.choice(rng.choice(letters)) for _ in range(rng.randrange(1, 50))) for _ in range(2_000)]
    for text in texts:
        ids = np.frombuffer(tool.encode(text), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text
        assert tool.decode(tool.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_decoding_gives_the_text_back(docs):
    encoded = bpe.encode_documents(docs, VOCABULARY)
    decoded = bpe.decode_documents(encoded, VOCABULARY)
    assert by_text(decoded.select("doc_id", "text").collect()) == by_text((i, t or "") for i, t in pairs_of(docs))


def test_automaton_follows_merge_order():
    vocabulary = {b"a": 0, b"b": 1, b"aa": 2, b"ab": 3, b"aab": 4}
    made = bpe.Automaton(vocabulary, [(b"a", b"a"), (b"a", b"b"), (b"aa", b"b")])
    assert made.encode(b"aaa") == [2, 0]
    assert made.encode(b"aab") == [4]
    assert made.encode(b"aaab") == [2, 3]


# --- 4: URL filter --------------------------------------------------------------------

URLS = [
    "http://a.net/", "http://net", "http://NET/x", "https://x.example.net/en/1", "https://example.net/en",
    "https://notexample.net/en/", "http://example.com/de/", "http://example.com/DE/", "http://fr.org/fr/x?y=/z#t",
    "http://q.com?u=http://a.net/", "no scheme", "", None, "://", "http://user@x.net:80/", "http://x.org#/fr/", "a://b://net/",
    "http://x..net/", "http://example.net/en/a b\nc",
]
#: host, path, rule and verdict by hand
JUDGED = {
    "http://a.net/": ("a.net", "/", "net/", "block"),
    "http://net": ("net", "", None, "allow"),
    "https://x.example.net/en/1": ("x.example.net", "/en/1", "example.net/en/", "allow"),
    "https://example.net/en": ("example.net", "/en", "net/", "block"),
    "https://notexample.net/en/": ("notexample.net", "/en/", "net/", "block"),
    "http://fr.org/fr/x?y=/z#t": ("fr.org", "/fr/x", "org/fr/", "allow"),
    "http://q.com?u=http://a.net/": ("q.com", "", None, "allow"),
    "a://b://net/": ("b:", "//net/", None, "allow"),
}


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_urls(spark, limit):
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS)] + [(0, URLS[0], "old")], "page_id long, url string, host string")
    found = url_filter.filter_urls(pages, queries.URL_RULES, max_broadcast_bytes=limit)
    rows = {r["page_id"]: tuple(r[c] for c in ("host", "path", "rule", "verdict")) for r in found.collect()}
    assert found.count() == len(URLS) + 1
    for url, expected in JUDGED.items():
        assert rows[URLS.index(url)] == expected
    for url in ("no scheme", "", None, "://"):
        assert rows[URLS.index(url)] == ("", "", None, "allow")


def test_both_ways_of_matching_agree(spark):
    rng = random.Random(1)
    rules = [
        url_filter.Rule.parse(rng.choice(["allow", "block"]), ".".join(rng.choices("abc", k=rng.randint(1, 3))) + rng.choice(["", "/", "/a", "/a/", "/a/b", "/ab"]))
        for _ in range(40)
    ]
    urls = ["http://" + ".".join(rng.choices("abcd", k=rng.randint(1, 4))) + rng.choice(["", "/", "/a", "/ab", "/a/b/c", "/abc/"]) for _ in range(300)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    one = url_filter.filter_urls(pages, rules)
    two = url_filter.filter_urls(pages, rules, max_broadcast_bytes=0)
    assert by_text(one.collect()) == by_text(two.select(one.columns).collect())


# --- 6: mixing ------------------------------------------------------------------------


def test_mix_meets_targets_and_limits(spark):
    rng = random.Random(4)
    texts = [sentence(rng, rng.randint(1, 80)) for _ in range(1_200)]
    docs = documents(spark, texts)
    rows = [r for r in mixing.mix(docs).collect() if r["doc_id"] is not None]
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    for source in {r["source"] for r in rows}:
        mine = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 160
        assert mine[0]["target"] <= 3 * mine[0]["source_size"]
    assert by_text(mixing.mix(docs.repartition(7)).collect()) == by_text(mixing.mix(docs).collect())


def test_excess_is_shared_by_weight(spark):
    sizes = spark.createDataFrame([("a", 10, 5), ("b", 100, 2), ("c", 100, 1), ("d", 0, 5)], "source string, source_size long, weight long")
    targets = {r["source"]: r["target"] for r in mixing.water_fill(sizes).collect()}
    assert targets == {"a": 30.0, "d": 0.0, "b": 120.0, "c": 60.0}


def test_repeated_rows_follow_the_mix(docs):
    out = mixing.repeat_documents(docs)
    assert out.columns == docs.columns
    wanted = {r["doc_id"]: r["repetitions"] for r in mixing.mix(docs).collect()}
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert all(counts.get(i, 0) == n * (2 if i == 4 else 1) for i, n in wanted.items() if i is not None)


# --- 9: near-dedup --------------------------------------------------------------------


def test_near_duplicates(docs):
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs).where("doc_id is not null").collect()}
    expected = near_components(pairs_of(docs))
    expected.pop(None)
    assert found == expected


def test_hot_bucket_of_near_copies(spark):
    rng = random.Random(8)
    base = sentence(rng, 90).split()
    texts = []
    for _ in range(150):
        words = base.copy()
        for _ in range(rng.randrange(0, 7)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    docs = documents(spark, texts).where("doc_id is not null")
    found = minhash.near_duplicates(docs, block=16)
    expected = near_components(pairs_of(docs))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()} == expected
    left = minhash.drop_near_duplicates(docs)
    assert {r["doc_id"] for r in left.collect()} == {c for _, c in expected.values()}


# --- all ------------------------------------------------------------------------------


def test_empty_tables_give_empty_results(spark, nothing):
    assert exact_dedup.exact_groups(nothing, keep_singles=True).count() == 0
    assert suffix_dedup.repeated_spans(nothing).count() == 0
    assert bpe.encode_documents(nothing, VOCABULARY).count() == 0
    assert mixing.mix(nothing).count() == 0
    assert mixing.repeat_documents(nothing).count() == 0
    assert minhash.near_duplicates(nothing).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.filter_urls(pages, queries.URL_RULES).count() == 0
