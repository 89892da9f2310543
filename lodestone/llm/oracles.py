"""SQL of the same results, where SQL can express a query."""

from __future__ import annotations

from . import mixing, sharding

_WORD = r"[^\x20\x09-\x0D]+"

_ASCII_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '{_WORD}') AS words FROM documents),
s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(words) = 0 OR words IS NULL THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
  ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS sh FROM w),
e AS MATERIALIZED (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
links AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT a AS doc_id, a AS r FROM links UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a),
least AS (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, coalesce(least.r, s.doc_id) AS component_id FROM s LEFT JOIN least USING (doc_id)
"""


def _uniform(key: str) -> str:
    return f"((CAST('0x' || substr(md5({key}), 1, {sharding.DRAW_BITS // 4}) AS BIGINT) + 0.5) / {float(1 << sharding.DRAW_BITS)!r})"


def _placed(tree: list[sharding.Shard], key: str, seed: str = "tree") -> str:
    """Nested CASE over the levels; the least draw of a node's children is found by comparing them all."""

    def choose(below: list[sharding.Shard], path: str, levels: list[str]) -> str:
        groups: dict[str, list[sharding.Shard]] = {}
        for s in below:
            groups.setdefault(str(getattr(s, levels[0])), []).append(s)
        inner = {name: (choose(g, f"{path}/{name}", levels[1:]) if len(levels) > 1 else name) for name, g in groups.items()}
        if len(groups) == 1:
            return next(iter(inner.values()))
        draws = {name: f"(-ln({_uniform(f"'{seed}/{path}/{name}/' || {key}")}) / {sum(s.weight for s in g)!r})" for name, g in groups.items()}
        least = f"least({', '.join(draws.values())})"
        return "CASE " + " ".join(f"WHEN {draws[n]} = {least} THEN {inner[n]}" for n in groups) + " END"

    return choose(tree, "", ["region", "rack", "shard"])


_TREE = sharding.tree_of(16)
# The checksum's table of 256 entries comes from its rule, and a text's bytes from its hexadecimal form.
OP4 = f"""
WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, CAST(i AS BIGINT))) AS tab),
d AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h, coalesce(CAST(doc_id AS VARCHAR), 'null') AS k FROM documents),
c AS (SELECT doc_id, k, CAST(strlen(text) + 1 AS BIGINT) AS size,
  xor(list_reduce(list_transform(range(0, length(h), 2), lambda i: CAST('0x' || substr(h, i + 1, 2) AS BIGINT)), lambda crc, b: xor(crc // 256, tab[(xor(crc, b) % 256) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS text_crc32 FROM d, t),
p AS (SELECT doc_id, size, text_crc32, 'key' AS law, CAST({_placed(_TREE, 'k')} AS INTEGER) AS shard, CAST({_placed(sharding.grown(_TREE), 'k')} AS INTEGER) AS grown_shard FROM c)
SELECT *, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot FROM p
"""


def _hashed(seed: str, *keys: str) -> str:
    text = " || '/' || ".join([f"'{seed}'", *(f"coalesce(CAST({k} AS VARCHAR), 'null')" for k in keys)])
    return f"CAST('0x' || substr(md5({text}), 1, {mixing.DRAW_BITS // 4}) AS BIGINT)"


# Square-root weights and as many rows as there are; rates here stay below the step that is inverted at once.
OP5 = f"""
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT source, sum(n) OVER () * sqrt(n) / sum(sqrt(n)) OVER () / n AS rate FROM n),
law AS (SELECT source, k, sum(exp(-rate + CASE WHEN k = 0 THEN 0 ELSE k * ln(rate) - lgamma(k + 1) END)) OVER (PARTITION BY source ORDER BY k) AS c FROM r, range(64) g(k)),
u AS (SELECT *, ({_hashed('mix', 'doc_id', '1')} + 0.5) / {float(1 << mixing.DRAW_BITS)!r} AS u FROM documents),
counted AS (SELECT u.* EXCLUDE (u), (SELECT count(*) FROM law WHERE law.source IS NOT DISTINCT FROM u.source AND c <= u) AS n_copies FROM u),
copies AS (SELECT *, unnest(range(n_copies)) AS copy FROM counted)
SELECT *, {_hashed('mix/order', 'doc_id', 'copy')} AS shuffle_key FROM copies
"""

OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
k AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest, max(page_id) OVER (PARTITION BY body) AS keeper FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to FROM k
"""
