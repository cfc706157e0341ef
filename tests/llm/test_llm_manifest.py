"""Merkle manifest, token alignment and toxicity against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_cases import by_text, documents, sentence
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallywright.llm import alignment, merkle, queries, toxicity
from tallywright.llm.common import held_out, table

BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return documents(spark).where("false")


# --- 11: manifest ---------------------------------------------------------------------


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text) -> str:
    parts = []
    for value in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text):
        parts.append("-" if value is None else f"{len(str(value).encode())}:{value}")
    return sha("".join(parts))


def levels_of(leaves: list[str]) -> list[list[str]]:
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][a : a + 16])) for a in range(0, len(out[-1]), 16)])
    return out


def steps(levels: list[list[str]], i: int):
    for row in levels[:-1]:
        start = i // 16 * 16
        run = row[start : start + 16]
        yield run[: i - start], run[i - start + 1 :]
        i //= 16


def brute_manifest(rows) -> list[tuple]:
    """Each row's result by plain lists; rows that are equal in all are told apart by nothing."""
    trees = defaultdict(list)
    for row in rows:
        trees[row["source"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf_of(row, row["text"]), row))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for name in names:
        trees[name].sort(key=lambda x: x[:3])
        built[name] = levels_of([x[2] for x in trees[name]])
    top = levels_of([built[name][-1][0] for name in names])
    out = []
    for place, name in enumerate(names):
        for i, (_, _, leaf, row) in enumerate(trees[name]):
            altered = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 and row["text"] is not None
            lowered = row["text"].translate({c: c + 32 for c in range(65, 91)}) if altered else row["text"]
            folded, proof = leaf_of(row, lowered), ""
            for before, after in [*steps(built[name], i), *steps(top, place)]:
                proof += "".join(before + after)
                folded = sha("".join([*before, folded, *after]))
            root = top[-1][0]
            out.append((row["doc_id"], leaf, built[name][-1][0], root, sha(proof), folded, folded == root))
    return out


def manifest(frame, **options):
    lowered = F.translate("text", merkle.CAPITALS, merkle.CAPITALS.lower())
    return merkle.prove(frame, altered={"text": lowered}, where=held_out(F.col("doc_id"), 5, 0), **options)


def test_positions_of_postorder():
    for n in (1, 2, 15, 16, 17, 255, 256, 257, 700, 4096, 4097, 5000):
        order, levels = [], [-(-n // 16**k) for k in range(merkle.height(n) + 1)]

        def visit(level, j, order=order, levels=levels):
            if level:
                for child in range(16 * j, min(16 * j + 16, levels[level - 1])):
                    visit(level - 1, child)
            order.append((level, j))

        visit(len(levels) - 1, 0)
        assert [merkle.node_position(level, j, n) for level, j in order] == list(range(len(order))), n


@pytest.mark.parametrize("n", [1, 16, 17, 256, 300])
def test_builders_append_in_completion_order(n):
    leaves = [sha(str(i)) for i in range(n)]
    levels = levels_of(leaves)
    log = merkle.append_nodes(leaves, len(levels) - 1)
    for level, row in enumerate(levels):
        assert [log[merkle.node_position(level, j, n)] for j in range(len(row))] == row


def test_manifest_of_awkward_rows(spark, docs, nothing):
    assert by_text(manifest(docs).collect()) == by_text(brute_manifest(docs.collect()))
    empty = manifest(nothing)
    assert empty.count() == 0 and empty.columns == manifest(docs).columns
    lone = docs.where("doc_id = 4").limit(1)
    row = manifest(lone).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == sha("")


def test_manifest_of_many_rows_and_its_log(spark):
    """A source of more than a page of pages, copies of one row beyond a page, and many small sources."""
    rows = [(i, f"Text {i}", "en", "hot", 6) for i in range(5_000)]
    rows += [(7, "Same", None, "copies", 4)] * 400
    rows += [(10_000 + i, None if i % 7 == 0 else f"T{i}", "de", None if i % 50 == 0 else f"s{i % 300}", i) for i in range(900)]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    logs = []
    found = manifest(frame, log_to=logs.append)
    assert by_text(found.collect()) == by_text(brute_manifest(frame.collect()))
    written = {(r["tree"], r["position"]): r["digest"] for r in merkle.append_log(logs[0]).collect()}
    hot = levels_of([leaf_of(r, r["text"]) for r in frame.where("source = 'hot'").orderBy("doc_id").collect()])
    for level, row in enumerate(hot):
        for j, node in enumerate(row):
            assert written["+hot", merkle.node_position(level, j, 5_000)] == node
    assert sum(tree == "+hot" for tree, _ in written) == sum(map(len, hot))


# --- 12: alignment --------------------------------------------------------------------


def brute_alignment(texts: list[str | None]) -> list[tuple]:
    """``(n_a, n_b, n_groups, n_links, n_best, count_sum, spelling)`` of each text by loops over tokens."""
    first = Tokenizer.from_file(BYTE_LEVEL)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}

    def first_bytes(i):
        return bytes(chars[c] for c in first.id_to_token(i))

    def second_bytes(i):
        if second.is_byte(i):
            return bytes([int(second.id_to_piece(i)[3:5], 16)])
        return second.id_to_piece(i).replace("▁", " ").encode()

    found = []
    for text in texts:
        wanted = b" " + (text or "").encode()
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        a_bytes, b_bytes = list(map(first_bytes, a)), list(map(second_bytes, b))
        if not text or b"".join(a_bytes) != wanted or b"".join(b_bytes) != wanted:
            found.append([])
            continue
        a_ends, b_ends = list(np.cumsum(list(map(len, a_bytes)))), list(np.cumsum(list(map(len, b_bytes))))
        groups, i, j = [], 0, 0
        for end in sorted(set(a_ends) & set(b_ends)):
            k, m = a_ends.index(end) + 1, b_ends.index(end) + 1
            groups.append((a[i:k], b[j:m]))
            i, j = k, m
        found.append(groups)
    holds = Counter(pair for groups in found for pair in {(x, y) for a, b in groups for x in a for y in b})
    best = defaultdict(int)
    for (x, _), n in holds.items():
        best[x] = max(best[x], n)
    out = []
    for groups in found:
        links = [(x, y) for a, b in groups for x in a for y in b]
        spelling = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        counts = (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links))
        sums = (sum(holds[p] == best[p[0]] for p in links), sum(holds[p] for p in links))
        out.append((*counts, *sums, sha(spelling) if groups else ""))
    return out


def aligned_rows(frame, **options):
    rows, _ = alignment.align(frame, BYTE_LEVEL, PIECES, **options)
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()


ODD = [
    "▁ is not a blank",
    "a <unk> b </s> <s> <|endoftext|>",
    "<0x41> A",
    "   many   blanks  \n\n\n and lines\t\t",
    "日本語のテキスト と \U0001f600\U0001f601 x",
    "á ffi ﬁ ½   　",
    "\x00 nul \x1f",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "ab" * 3_000,
    " " * 2_500 + "x",
]


@pytest.mark.parametrize("pairs_a_pass", [alignment.PAIRS_A_PASS, 50])
def test_alignment_against_loops(spark, docs, pairs_a_pass):
    texts = [(r["doc_id"], r["text"]) for r in docs.where("text is null or length(text) < 20000").collect()] + list(enumerate(ODD, 100))
    frame = spark.createDataFrame([(*row, "junk", "junk", 1) for row in texts], "doc_id long, text string, `key` string, `row` string, n long")
    expected = [(row[0], *found) for row, found in zip(texts, brute_alignment([t for _, t in texts]), strict=True)]
    assert by_text(aligned_rows(frame.repartition(3), pairs_a_pass=pairs_a_pass)) == by_text(expected)


def test_pairs_of_the_whole_corpus(spark):
    texts = ["the cat", "the cat", "the dog sat on", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, pairs = alignment.align(frame, BYTE_LEVEL, PIECES)
    first, second = Tokenizer.from_file(BYTE_LEVEL), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counts = {(r["a"], r["b"]): r["n"] for r in pairs.collect()}
    assert counts[first.encode(" the").ids[0], second.encode("the")[0]] == 3
    assert counts[first.encode(" cat").ids[0], second.encode("cat")[0]] == 2


def test_alignment_of_nothing(spark, nothing):
    assert aligned_rows(nothing) == []
    empty = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    assert {tuple(r)[1:] for r in aligned_rows(empty)} == {(0, 0, 0, 0, 0, 0, "")}


def test_both_byte_level_libraries_split_alike():
    """Every code point between letters, digits, marks and blanks."""
    pair = alignment.Spec.read(BYTE_LEVEL, PIECES).pair()
    points = [p for p in range(1, 0x110000) if not 0xD800 <= p < 0xE000]
    texts = ["".join(f"a{chr(p)}b {chr(p)}1{chr(p)}!{chr(p)} " for p in points[k : k + 64]) for k in range(0, len(points), 64)]
    odd = [k for k, t in enumerate(texts) if pair.quick.encode_ordinary(t) != pair.exact.encode(t, add_special_tokens=False).ids]
    assert not odd, [hex(points[64 * k]) for k in odd]


def test_long_groups_are_laid_out_in_parts(monkeypatch):
    pair = alignment.Spec.read(BYTE_LEVEL, PIECES).pair()
    (a, b), = pair.encode(["the quick brown fox thonnener ndreea " * 20])
    groups = alignment.groups_of(pair, a, b)
    every = np.ones(len(groups.a_count), dtype=bool)
    whole = alignment.irregular(pair, a, b, groups, every)
    monkeypatch.setattr(alignment, "LINKS_AT_ONCE", 7)
    parts = alignment.irregular(pair, a, b, groups, every)
    assert whole[0].tolist() == parts[0].tolist() and whole[1].tolist() == parts[1].tolist()
    assert whole[1].sum() == groups.links


# --- 13: toxicity ---------------------------------------------------------------------


def brute_ratio(word, rows: list[tuple[bool, list[str]]]) -> float:
    """The log ratio of a word by the formula, from lists of words."""
    met = {True: set(), False: set()}
    for label, words in rows:
        met[label].update(zip(["^", *words[:-1]], words, strict=True))
    both = met[True] | met[False]
    types = {w for _, w in both}
    count = lambda pairs, w: sum(v == w for _, v in pairs)
    shared = (max(count(both, word) - 0.75, 0.0) + 0.75 * len(types) / (len(types) + 1)) / len(both)
    logs = []
    for label in (True, False):
        held = lambda c: min(c, 1.5 * math.sqrt(c))
        spare = sum(held(count(met[label], w)) for w in types) / len(met[label])
        own = count(met[label], word)
        logs.append(math.log((own - held(own)) / len(met[label]) + spare * shared))
    return logs[0] - logs[1]


def toxic_rows(rows: int = 240, seed: int = 3):
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        words = sentence(rng, rng.randrange(20, 200)).split()
        if i % 4 == 0:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(["vilething", "Badword"]))
        out.append((i, " ".join(words), i % 4 == 0))
    return out


def test_ratios_by_the_formula(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "CURVE_FOLD", 1 << 40)
    rows = toxic_rows(60)
    frame = spark.createDataFrame(rows, "doc_id long, text string, bad boolean")
    model = toxicity.learn(frame, frame.select("doc_id", F.col("bad").cast("int").alias("toxic")))
    split = [(bad, text.lower().split()) for _, text, bad in rows]
    names = toxicity.Names()
    for word in ("vilething", "badword", "w3x", "w77x"):
        found = model.word_ratios(np.array([names[word]], np.uint64))[0]
        expected = brute_ratio(word, split)
        counts = Counter(bad for bad, words in split for w in words if w == word)
        if max(counts.values()) >= 3:
            assert math.isclose(found, expected, rel_tol=1e-9), word


def test_passages_are_compared_by_length():
    model = toxicity.Model(np.array([5], np.uint64), np.array([4.0]), -1.0, np.zeros(len(toxicity.PASSAGES) + 2))
    text = np.array([9, 9, 5, 5, 9], np.uint64)
    found = model.evidence([text, np.zeros(0, np.uint64), text[:1]])
    assert found[0].tolist() == [4.0, 4.0, 1.5, 1.0, 1.0]
    assert found[1].tolist() == [0.0] * 5 and found[2].tolist() == [-1.0] * 5


def test_toxic_rows_are_found(spark):
    rows = toxic_rows(800)
    frame = spark.createDataFrame(rows, "doc_id long, text string, bad boolean")
    labels = frame.where("doc_id % 5 <> 0").select("doc_id", F.col("bad").cast("int").alias("toxic"))
    scored = toxicity.score_documents(frame, toxicity.learn(frame, labels)).join(frame, "doc_id").where("doc_id % 5 = 0").collect()
    assert np.mean([(r["score"] >= 0.5) == r["bad"] for r in scored]) > 0.97


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    scored = queries.op13_toxicity(spark, sf).where("held_out")
    rows = scored.join(table(spark, sf, "labels"), "doc_id").select("score", "predicted", "toxic").collect()
    bad, good = ([r["predicted"] for r in rows if r["toxic"] == kind] for kind in (1, 0))
    assert np.mean(bad) > 0.85 and np.mean(good) < 0.02
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_toxicity_of_awkward_rows(spark, docs, nothing):
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    scored = toxicity.score_documents(docs, toxicity.learn(docs, labels)).collect()
    assert len(scored) == docs.count() and all(0 <= r["score"] <= 1 for r in scored)
    silent = {r["score"] for r in scored if r["doc_id"] in (0, 1, 2)}
    assert len(silent) == 1
    unknown = toxicity.learn(nothing, labels)
    assert {r["score"] for r in toxicity.score_documents(docs, unknown).collect()} == {0.5}
    assert toxicity.score_documents(nothing, unknown).count() == 0


def test_all_labelled_rows_teach(spark, monkeypatch):
    """A word that only the last of very many ordinary rows have, each behind another word, is counted."""
    monkeypatch.setattr(toxicity, "CURVE_FOLD", 1 << 40)
    monkeypatch.setattr(toxicity, "PAIRS_AT_ONCE", 5_000)
    rows = [(i, f"c{i} lateword plain", i < 6_000) for i in range(24_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, bad boolean")
    model = toxicity.learn(frame, frame.select("doc_id", F.col("bad").cast("int").alias("toxic")))
    names = toxicity.Names()
    found = model.word_ratios(np.array([names[w] for w in ("lateword", "plain")], np.uint64))
    # Every row has a word of its own behind the start, then "lateword"; "plain" has one context.
    shared = (24_000 - 0.75 + 0.75 * 24_002 / 24_003) / 48_001
    logs = []
    for n in (6_000, 18_000):
        held, total = 1.5 * math.sqrt(n), 2 * n + 1
        logs.append(math.log((n - held) / total + (n + held + 1) / total * shared))
    assert math.isclose(found[0], logs[0] - logs[1], rel_tol=1e-9)
    # Met behind one word only, so no class keeps a part of it.
    assert found[1] == model.rest


def test_the_curve_is_fitted_over_all_rows_in_parts(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "CURVE_ROWS_A_TASK", 100)
    rng = np.random.RandomState(2)
    toxic = rng.rand(700) < 0.3
    evidence = rng.randn(700, len(toxicity.PASSAGES) + 1) + toxic[:, None]
    target = np.where(toxic, (toxic.sum() + 1) / (toxic.sum() + 2), 1 / ((~toxic).sum() + 2))
    alone = toxicity.fit_curve(lambda w: toxicity.curve_sums(evidence, target, w), evidence.shape[1] + 1)
    held = spark.createDataFrame(list(zip(toxic.tolist(), evidence.tolist(), strict=True)), "toxic boolean, evidence array<double>")
    assert np.allclose(toxicity._fitted(held.repartition(7)), alone, atol=1e-6)


def test_more_telling_words_than_the_bound(spark):
    frame = spark.createDataFrame([(w, 3 + w % 40, 3 + w % 7, 6 + w % 47) for w in range(5_000)], "word long, t long, o long, both long")
    totals = [(90_000.0, 0.3), (60_000.0, 0.4)]
    whole, some = (toxicity._telling(frame, totals, 200_000, 9_000, n).toArrow() for n in (5_000, 1_000))
    made = []
    for kept in (whole, some):
        word, t, o, both = (kept[c].to_numpy() for c in ("word", "t", "o", "both"))
        made.append(toxicity.word_table(word.view(np.uint64), (t, o), both, totals, 200_000, 9_000, 1_000))
    assert whole.num_rows == 5_000 and some.num_rows < 5_000 and len(made[1].hashes) == 1_000
    far = [np.sort(np.abs(m.ratios - m.rest)) for m in made]
    assert np.allclose(far[0], far[1], rtol=1e-12)


def test_words_beyond_two_million_keep_their_ratios():
    n = 2_100_000
    hashes = np.arange(1, n + 1, dtype=np.uint64)
    t, o = np.full(n, 9), np.full(n, 4)
    t[-3:], both = 5, np.full(n, 13)
    model = toxicity.word_table(hashes, (t, o), both, [(9.0 * n, 0.3), (4.0 * n, 0.4)], 13 * n, n)
    assert len(model.hashes) == n
    own = model.word_ratios(hashes[[0, -1]])
    shared = (13 - 0.75 + 0.75 * n / (n + 1)) / (13 * n)
    ordinary = math.log((4 - 1.5 * 2) / (4 * n) + 0.4 * shared)
    for ratio, met in zip(own, (9, 5), strict=True):
        toxic = math.log((met - 1.5 * math.sqrt(met)) / (9 * n) + 0.3 * shared)
        assert math.isclose(ratio, toxic - ordinary, rel_tol=1e-9)


def test_telling_words_reach_the_driver_in_parts(spark, monkeypatch):
    rng = np.random.RandomState(4)
    words = np.unique(rng.randint(-(1 << 63), (1 << 63) - 1, 3_000, dtype=np.int64)).tolist()
    frame = spark.createDataFrame([(w, i % 40, i % 7, i % 40 + i % 7) for i, w in enumerate(words)], "word long, t long, o long, both long")
    terms = [(90_000.0, 0.3), (60_000.0, 0.4)], 200_000, 9_000
    kept = toxicity._telling(frame, *terms)
    assert kept.count() == sum(max(i % 40, i % 7) >= 3 for i in range(len(words)))
    whole = toxicity._collected(kept, *terms)
    monkeypatch.setattr(toxicity, "WORDS_A_JOB", 200)
    parts, some = toxicity._collected(kept, *terms), toxicity._collected(kept, *terms, 1_000)
    assert len(whole.hashes) == kept.count() and (np.diff(parts.hashes) > 0).all()
    assert (parts.hashes == whole.hashes).all() and (parts.ratios == whole.ratios).all() and parts.rest == whole.rest
    assert len(some.hashes) == 1_000 and np.isin(some.hashes, whole.hashes).all()
