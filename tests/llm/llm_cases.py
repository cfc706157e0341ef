"""Small documents with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

#: Names that operators use inside; as extra columns they must do no harm.
CLASHING = ["body", "chars", "size", "prefix", "draw", "anchor", "band", "rep", "part", "node", "score", "features", "ids", "key"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def sentence(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(words))


def awkward_texts() -> list[str | None]:
    rng = random.Random(5)
    base = sentence(rng, 120)
    near = base.split()
    near[60] = "changed"
    far = base.split()
    far[::9] = ["other"] * len(far[::9])
    passage = sentence(rng, 60)
    return [
        None,
        "",
        " \t\n",
        "a",
        base,
        base,
        base.replace(" ", "  "),
        " ".join(near),
        " ".join(far),
        passage + " " + sentence(rng, 40),
        sentence(rng, 40) + " " + passage,
        "one two three four",
        "ONE two three four",
        "x" * 900,
        "héllo wörld " * 40,
        sentence(rng, 12_000, 9_000),
        "it's <|endoftext|> 'quoted' text\u3000with\u00a0spaces 12½",
        "short",
        "\U0001f600 " * 70,
    ]


def documents(spark, texts=None, start: int = 0):
    texts = awkward_texts() if texts is None else texts
    langs, sources = ["en", "de", None], ["b", "a", None, "c"]
    rows = [
        (start + i, t, langs[i % 3], sources[i % 4], None if t is None else len(t), *["junk"] * len(CLASHING))
        for i, t in enumerate(texts)
    ]
    # A row that repeats another, one without an id, and one with nothing at all.
    rows += [rows[4 % len(rows)], (None, "no id here", None, None, None, *[None] * len(CLASHING))] if rows else []
    rows += [(None,) * len(rows[0])] if rows else []
    return spark.createDataFrame(rows, SCHEMA)


def pairs_of(df) -> list[tuple]:
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


class Union(dict):
    def __missing__(self, key):
        return key

    def find(self, x):
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self[b] = a


def shingles(text: str | None, width: int = 5) -> set:
    low = {c: c + 32 for c in range(65, 91)}
    words = [w.translate(low) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*[words[k:] for k in range(width)], strict=False))


def near_components(rows: list[tuple]) -> dict:
    """``doc_id -> (n_shingles, component_id)`` by counting common shingles of all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    union = Union()
    for (a, s), (b, t) in itertools.combinations([x for x in sets if x[0] is not None and x[1]], 2):
        if a != b and 100 * len(s & t) >= 75 * len(s | t):
            union.join(a, b)
    return {i: (len(s), None if i is None else union.find(i)) for i, s in sets}


def repeated(rows: list[tuple], length: int) -> list[tuple]:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of each row."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(b[s : s + length] for _, b in texts for s in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        spans: list[list[int]] = []
        for s in range(len(b) - length + 1):
            if counts[b[s : s + length]] > 1:
                if spans and spans[-1][1] >= s:
                    spans[-1][1] = s + length
                else:
                    spans.append([s, s + length])
        kept, at = b"", 0
        for s, e in spans:
            kept += b[at:s]
            at = e
        kept += b[at:]
        out.append((i, len(b), sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest()))
    return out


def exact_rows(rows: list[tuple]) -> list[tuple]:
    """``(doc_id, keep_id, group_size, kept, hash)`` of each row."""
    groups = defaultdict(list)
    for i, t in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        groups[hashlib.sha256(body.encode()).hexdigest()].append((-len(t or ""), i is None, i))
    out = []
    for digest, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        out += [(i, keep, len(members), i == keep, digest) for _, _, i in members]
    return out


def by_text(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=str)
