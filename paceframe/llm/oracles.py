"""SQL of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from .lines import MIN_CHARS, MIN_SITES
from .text import LOWER, UPPER

_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = rf"regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+')"

JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPACED} AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * o >= 90 * (p.n + q.n - o)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.a = d.doc_id GROUP BY 1, 2"""

SUFFIX = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, p, substr(x, 2 * p + 1, 100) AS s FROM (SELECT doc_id, x, unnest(range(0, n - 49)) AS p FROM h)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
r AS (SELECT doc_id, p FROM w JOIN f USING (s) WHERE first < doc_id),
g AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 0 ELSE 1 END AS fresh FROM r),
s AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM g),
t AS (SELECT doc_id, k, min(p) AS a, max(p) + 50 AS b FROM s GROUP BY 1, 2),
u AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS prev FROM t),
v AS (SELECT doc_id, count(*) AS spans, sum(b - a) AS removed, max(b) AS last,
  string_agg(substr(x, 2 * prev + 1, 2 * (a - prev)), '' ORDER BY a) AS head FROM u JOIN h USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM h LEFT JOIN v USING (doc_id)"""

VECTORS = """
WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM e x JOIN e y ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.v, y.v) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, component_id = vec_id AS kept
FROM e JOIN c ON c.a = vec_id LEFT JOIN k ON k.a = vec_id"""

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, w, least(10, len(w)) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM b)),
ks AS (SELECT DISTINCT k FROM b),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d JOIN ks ON len(w) >= k)),
hit AS (SELECT doc_id, item, i, k FROM dw JOIN bw USING (k, s)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY 1),
own AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(pos.n, 0) AS n_hit, coalesce(own.n, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN own USING (doc_id)"""

LINES = f"""
WITH d AS (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
k AS (SELECT doc_id, source, unnest(x) AS line, generate_subscripts(x, 1) AS i FROM d),
b AS (SELECT trim(line, ' ') AS t, min(doc_id) AS first FROM k
  WHERE source IS NOT NULL AND length(trim(line, ' ')) >= {MIN_CHARS} GROUP BY 1 HAVING count(DISTINCT source) >= {MIN_SITES}),
m AS (SELECT doc_id, line, i, first IS NOT NULL AS gone FROM k LEFT JOIN b ON trim(line, ' ') = t AND first <> doc_id)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id"""

def _hashed_field(name: str) -> str:
    return f"coalesce(octet_length(encode({name}::VARCHAR))::VARCHAR || ':' || {name}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_hashed_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII characters, bit by bit: a character enters at every eighth step."""
    bits = f"list_transform(range(0, 8 * length({text})), lambda i: CASE WHEN i % 8 = 0 THEN ascii(substr({text}, (i // 8 + 1)::INT, 1)) ELSE 0 END::BIGINT)"
    step = "xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), lambda c, b: {step}), 4294967295)"


def _merkle(heights: int = 6, top_heights: int = 2) -> str:
    """Trees of up to 8 ** heights leaves and 8 ** top_heights trees, level by level."""
    steps = [f"""
WITH d AS (SELECT doc_id, {_leaf('text')} AS leaf, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS p,
  CASE WHEN {_crc32('doc_id::VARCHAR')} % 3 = 0 THEN {_leaf('low')} ELSE {_leaf('text')} END AS f
  FROM (SELECT *, translate(text, '{UPPER}', '{LOWER}') AS low FROM documents)),
n0 AS (SELECT t, p, leaf AS h FROM d), r0 AS (SELECT doc_id, leaf, t, p, f, '' AS proof FROM d)"""]
    for k in range(heights + top_heights):
        if k == heights:  # the subroots become the leaves of one tree
            steps.append(f"n{k}t AS (SELECT 0 AS t, t AS p, h FROM n{k}), r{k}t AS (SELECT doc_id, leaf, 0 AS t, t AS p, f, proof FROM r{k})")
        nodes, rows = (f"n{k}t", f"r{k}t") if k == heights else (f"n{k}", f"r{k}")
        run = "PARTITION BY t, p // 8 ORDER BY p ROWS BETWEEN"
        steps.append(f"""s{k} AS (SELECT t, p, h, count(*) OVER (PARTITION BY t) AS c,
  coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
  coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM {nodes})""")
        steps.append(f"""n{k + 1} AS (SELECT t, p // 8 AS p, CASE WHEN max(c) > 1 THEN sha256(string_agg(h, '' ORDER BY p)) ELSE max(h) END AS h
  FROM s{k} GROUP BY t, p // 8)""")
        steps.append(f"""r{k + 1} AS (SELECT r.doc_id, r.leaf, r.t, r.p // 8 AS p, CASE WHEN c > 1 THEN sha256(a || f || b) ELSE f END AS f,
  CASE WHEN c > 1 THEN proof || a || b ELSE proof END AS proof FROM {rows} r JOIN s{k} s ON s.t = r.t AND s.p = r.p)""")
    last = heights + top_heights
    return ",\n".join(steps) + f"""
SELECT r.doc_id, r.leaf, n{heights}.h AS subroot, n{last}.h AS root, sha256(r.proof) AS proof_sha256, r.f AS folded_root, r.f = n{last}.h AS verified
FROM r{last} r JOIN d USING (doc_id) JOIN n{heights} ON n{heights}.t = d.t JOIN n{last} ON true"""


NEGATIVES = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS s
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b)::INTEGER AS rank,
  n.b AS negative_id, p.s AS positive_score, n.s AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 80 * p.s <= 100 * n.s AND 100 * n.s <= 100 * p.s
QUALIFY rank <= 5"""


ORACLES = {
    "op13_hard_negatives": NEGATIVES,
    "op12_merkle_manifest": _merkle(),
    "op3_ngram_jaccard_join": JACCARD, "op5_suffix_dedup": SUFFIX, "op7_embedding_near_dedup": VECTORS,
    "op9_decontamination": DECONTAMINATE, "op10_line_dedup": LINES,
}
