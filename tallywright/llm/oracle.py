"""The same results in DuckDB SQL, for the operators that SQL can express."""

URL_FILTER = r"""
WITH rules(host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
rests AS (
  SELECT page_id,
         CASE WHEN position('://' IN url) > 0
              THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages
),
parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*', 0),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
),
hits AS (
  SELECT p.host, p.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.host, p.path
                            ORDER BY length(r.host) DESC, length(r.path) DESC) AS n
  FROM (SELECT DISTINCT host, path FROM parts) p
  JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host))
              AND starts_with(p.path, r.path)
)
SELECT p.page_id, p.host, p.path, h.rule, coalesce(h.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN hits h ON p.host = h.host AND p.path = h.path AND h.n = 1
"""

EXACT_DEDUP = r"""
WITH bodies AS (
  SELECT doc_id, coalesce(length(text), 0) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256
                                 ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id IS NOT DISTINCT FROM
         first_value(doc_id) OVER (PARTITION BY text_sha256
                                   ORDER BY chars DESC, doc_id NULLS LAST) AS kept,
       text_sha256
FROM bodies
"""

MIXING = r"""
WITH rows AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT)
           / 281474976710656.0::DOUBLE AS draw
  FROM documents
),
cells AS (
  SELECT source, CAST(floor(draw * 4096) AS INTEGER) AS cell, CAST(sum(size) AS BIGINT) AS words
  FROM rows GROUP BY ALL
),
totals AS (SELECT source, CAST(sum(words) AS BIGINT) AS source_size FROM cells GROUP BY source),
weighed AS (
  SELECT source, source_size, source_size * 3 AS cap,
         CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM totals
),
filled AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER ahead, 0) AS BIGINT) AS room,
         CAST(sum(weight) OVER () - coalesce(sum(weight) OVER ahead, 0) AS BIGINT) AS open,
         row_number() OVER (ORDER BY cap::DOUBLE / weight, source IS NULL, source) AS place
  FROM weighed
  WINDOW ahead AS (ORDER BY cap::DOUBLE / weight, source IS NULL, source
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
level AS (
  SELECT room, open FROM filled WHERE cap * open > weight * room ORDER BY place LIMIT 1
),
plan AS (
  SELECT source, source_size,
         CASE WHEN cap * open <= weight * room THEN cap::DOUBLE
              ELSE (weight * (SELECT room FROM level))::DOUBLE / (SELECT open FROM level) END AS target
  FROM filled
),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole,
         target - (CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END)
                  * source_size AS need
  FROM plan
),
below AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY cell
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM cells
),
cuts AS (
  SELECT b.source, b.cell, b.before, b.words, r.need,
         row_number() OVER (PARTITION BY b.source ORDER BY b.cell DESC) AS n
  FROM below b JOIN rates r ON b.source IS NOT DISTINCT FROM r.source
  WHERE b.words > 0 AND b.before < r.need
)
SELECT d.doc_id, d.size, r.source_size, r.target,
       CAST(d.size * (r.whole + CASE WHEN d.draw < coalesce(
         (c.cell + least(1.0::DOUBLE, (c.need - c.before::DOUBLE) / c.words)) / 4096, 0)
         THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rows d
JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
LEFT JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source AND c.n = 1
"""



def _merkle_field(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _merkle_leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_merkle_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _merkle_levels(name: str, first: str, levels: int) -> str:
    """Runs and nodes of each level; trees with one node left stay as they are."""
    out = [f"{name}_n0 AS ({first})"]
    for k in range(levels):
        out.append(
            f"{name}_r{k} AS (SELECT tree, i // 16 AS r, any_value(n) AS n, string_agg(digest, '' ORDER BY i) AS run "
            f"FROM {name}_n{k} GROUP BY tree, i // 16)"
        )
        out.append(
            f"{name}_n{k + 1} AS (SELECT tree, r AS i, (n + 15) // 16 AS n, "
            f"CASE WHEN n = 1 THEN run ELSE sha256(run) END AS digest FROM {name}_r{k})"
        )
    return ",\n".join(out)


def _merkle_steps(name: str, row: str, levels: int) -> str:
    """Add each level's siblings to ``proof`` and fold ``folded`` with them; ``i`` counts up the levels."""
    out, before = [], row
    for k in range(levels):
        place = "64 * (d.i % 16)"
        ahead, behind = f"substr(r.run, 1, {place})", f"substr(r.run, {place} + 65)"
        out.append(
            f"{name}_s{k} AS (SELECT d.* REPLACE (d.i // 16 AS i, "
            f"d.proof || CASE WHEN r.n = 1 THEN '' ELSE {ahead} || {behind} END AS proof, "
            f"CASE WHEN r.n = 1 THEN d.folded ELSE sha256({ahead} || d.folded || {behind}) END AS folded) "
            f"FROM {before} d JOIN {name}_r{k} r ON d.tree = r.tree AND d.i // 16 = r.r)"
        )
        before = f"{name}_s{k}"
    return ",\n".join(out)


def merkle(levels: int = 5) -> str:
    """Trees of up to 16 to the power of ``levels`` leaves; a tree's name puts the null source first."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = f"translate(text, '{capitals}', '{capitals.lower()}')"
    digits = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    bits = "list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = f"xor(list_reduce(list_prepend(4294967295, {digits}), lambda crc, byte: {bits}), 4294967295)"
    return f"""
WITH hashed AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '+' || source END AS tree,
         {_merkle_leaf('text')} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {_merkle_leaf(lowered)} END AS altered
  FROM documents),
leaves AS (
  SELECT doc_id, tree, leaf, coalesce(altered, leaf) AS folded, '' AS proof,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY tree) AS n
  FROM hashed),
{_merkle_levels('low', 'SELECT tree, i, n, leaf AS digest FROM leaves', levels)},
groups AS (
  SELECT '' AS tree, tree AS name, digest, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n
  FROM low_n{levels}),
{_merkle_levels('top', 'SELECT tree, i, n, digest FROM groups', levels)},
{_merkle_steps('low', 'leaves', levels)},
lifted AS (
  SELECT l.doc_id, l.leaf, l.folded, l.proof, g.digest AS subroot, '' AS tree, g.i
  FROM low_s{levels - 1} l JOIN groups g ON l.tree = g.name),
{_merkle_steps('top', 'lifted', levels)}
SELECT s.doc_id, s.leaf, s.subroot, t.digest AS root, sha256(s.proof) AS proof_sha256,
       s.folded AS folded_root, s.folded = t.digest AS verified
FROM top_s{levels - 1} s, top_n{levels} t
"""


ORACLE = {
    "op4_url_filter": URL_FILTER,
    "op5_exact_dedup": EXACT_DEDUP,
    "op6_mixing": MIXING,
    "op11_merkle": merkle(),
}
