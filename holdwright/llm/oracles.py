"""DuckDB SQL for the queries that SQL can express: the same rows by plain joins and windows."""

from __future__ import annotations

from . import mixing, sharding

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWER = f"translate(coalesce(text, ''), '{_UP}', '{_LOW}')"
_HASH = "CAST('0x' || substr(md5({0}), 1, 15) AS BIGINT)"

# Each shard in turn takes the first free slot of its own order, until no slot is free.
_n = len(sharding.SHARDS)
_m = sharding.SLOTS
OP1 = f"""
WITH RECURSIVE s AS (SELECT k, 'shard-' || lpad(CAST(k AS VARCHAR), 2, '0') AS shard FROM range({_n}) t(k)),
  o AS MATERIALIZED (SELECT list({_HASH.format("'offset:' || shard")} % {_m} ORDER BY k) AS f, list({_HASH.format("'skip:' || shard")} % {_m - 1} + 1 ORDER BY k) AS p FROM s),
  fill AS (
    SELECT 0 AS step, CAST(NULL AS BIGINT) AS slot, CAST(NULL AS BIGINT) AS k, list_transform(range({_m}), lambda x: 0) AS used, list_transform(range({_n}), lambda x: 0) AS turn
    UNION ALL
    SELECT step + 1, here, who, list_concat(used[:here], [1], used[here + 2:]), list_concat(turn[:who], [j + 1], turn[who + 2:])
    FROM (SELECT step, used, turn, who, j, (f[who + 1] + j * p[who + 1]) % {_m} AS here FROM (
      SELECT step, used, turn, step % {_n} AS who, f, p, list_filter(range(turn[step % {_n} + 1], {_m}), lambda j: used[(f[step % {_n} + 1] + j * p[step % {_n} + 1]) % {_m} + 1] = 0)[1] AS j FROM fill, o WHERE step < {_m})))
SELECT doc_id, CAST(d.slot AS INTEGER) AS slot, 'shard-' || lpad(CAST(k AS VARCHAR), 2, '0') AS shard
FROM (SELECT doc_id, {_HASH.format("coalesce(CAST(doc_id AS VARCHAR), '')")} % {_m} AS slot FROM documents) d JOIN (SELECT slot, k FROM fill WHERE slot IS NOT NULL) t ON d.slot = t.slot
"""

OP3 = """
WITH d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS n, sha1(h) AS s FROM (SELECT page_id, coalesce(html, '') AS h FROM pages)),
  m AS (SELECT s, n, max(page_id) AS newest FROM d WHERE n >= 1000 GROUP BY 1, 2)
SELECT page_id, d.n AS payload_bytes, d.s AS payload_digest, CASE WHEN newest IS NULL OR page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> newest THEN newest END AS refers_to FROM d LEFT JOIN m ON d.s = m.s AND d.n = m.n
"""

OP5 = """
WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
  g AS (SELECT * FROM e WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
  l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
    WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.98),
  r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
  c AS (SELECT a, least(a, min(b)) AS root FROM r GROUP BY 1), n AS (SELECT a, count(*) AS n FROM l GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, vec_id = coalesce(root, vec_id) AS kept FROM e LEFT JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a
"""


def _weights(column: str, weights: dict[str, float]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {w}" for k, w in weights.items()) + f" ELSE {mixing.OTHER} END"


def _fill(name: str, source: str, parent: str, weight: str) -> str:
    """Shares of the parent's budget by weight, none above cap: a child is full if its ratio of cap to weight is below the level at which the budget runs out."""
    part = f"PARTITION BY {parent}" if parent else ""
    return f"""{name}_w AS (SELECT *, CAST({weight} AS DOUBLE) AS wt FROM {source}),
  {name}_o AS (SELECT *, sum(cap) OVER (p ORDER BY cap / wt RANGE UNBOUNDED PRECEDING) AS caps, sum(wt) OVER (p ORDER BY cap / wt RANGE UNBOUNDED PRECEDING) AS wts, sum(wt) OVER p AS every FROM {name}_w WINDOW p AS ({part})),
  {name}_f AS (SELECT *, cap / wt * (every - wts) + caps <= budget AS full_ FROM {name}_o),
  {name} AS (SELECT *, CASE WHEN full_ THEN cap ELSE least(cap, (budget - coalesce(sum(CASE WHEN full_ THEN cap END) OVER q, 0)) * wt / sum(CASE WHEN NOT full_ THEN wt END) OVER q) END AS alloc FROM {name}_f WINDOW q AS ({part}))"""


_E = mixing.MAX_EPOCHS
_DOMAIN = "'domain-' || (CASE WHEN regexp_extract(source, '([0-9]{1,9})$', 1) <> '' THEN CAST(regexp_extract(source, '([0-9]{1,9})$', 1) AS INTEGER) ELSE 0 END % 4)"
OP6 = f"""
WITH d AS (SELECT doc_id, CASE WHEN source IS NULL THEN 'unknown' ELSE {_DOMAIN} END AS domain, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
    CAST(coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r]+')), 0) AS BIGINT) AS tokens FROM documents),
  leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS DOUBLE) AS total, CAST(sum(tokens) AS DOUBLE) * {_E} AS cap FROM d GROUP BY 1, 2, 3),
  top_s AS (SELECT domain, sum(cap) AS cap, (SELECT sum(total) FROM leaf) * {mixing.SHARE} AS budget FROM leaf GROUP BY 1),
  {_fill("top", "top_s", "", _weights("domain", mixing.DOMAIN_WEIGHTS))},
  mid_s AS (SELECT l.domain, lang, sum(l.cap) AS cap, max(t.alloc) AS budget FROM leaf l JOIN top t ON l.domain = t.domain GROUP BY 1, 2),
  {_fill("mid", "mid_s", "domain", _weights("lang", mixing.LANG_WEIGHTS))},
  low_s AS (SELECT l.*, m.alloc AS budget FROM leaf l JOIN mid m ON l.domain = m.domain AND l.lang = m.lang),
  {_fill("low", "low_s", "domain, lang", "1.0")},
  b AS (SELECT domain, lang, source, total, floor(round(alloc, 6)) AS tokens, CASE WHEN total > 0 THEN CAST(least(floor(floor(round(alloc, 6)) / total), {_E}) AS INTEGER) ELSE 0 END AS whole FROM low),
  x AS (SELECT d.*, b.whole, b.tokens - b.whole * b.total AS rest, md5('{mixing.SEED}:' || b.whole || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM d JOIN b USING (domain, lang, source)),
  y AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place RANGE UNBOUNDED PRECEDING) AS upto FROM x)
SELECT doc_id, CAST(epoch AS INTEGER) AS epoch, tokens, domain, lang, source FROM (SELECT *, unnest(range(whole)) AS epoch FROM x)
UNION ALL SELECT doc_id, whole, tokens, domain, lang, source FROM y WHERE upto <= rest AND whole < {_E}
"""

OP8 = """
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
  s AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
  r AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1) // 256 AS part FROM t),
  p AS (SELECT t.conv_id, perspective, turn, role, text, part, CASE WHEN role = perspective THEN '<|assistant|>' || chr(10) WHEN role = 'system' THEN '<|system|>' || chr(10) ELSE '<|user ' || role || '|>' || chr(10) END AS head,
    text || '<|end|>' || chr(10) AS body FROM r t JOIN s ON t.conv_id = s.conv_id),
  o AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS stop FROM p)
SELECT conv_id, perspective, CAST(part AS BIGINT) AS part, count(*) AS n_turns, CAST(min(stop - length(head) - length(body)) AS BIGINT) AS start, string_agg(head || body, '' ORDER BY turn NULLS FIRST, role, text) AS text,
  coalesce(string_agg(CASE WHEN role = perspective THEN (stop - length(body)) || '-' || stop END, ',' ORDER BY turn NULLS FIRST, role, text), '') AS mask FROM o GROUP BY 1, 2, 3
"""

_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP9 = f"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark), d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
  g AS (SELECT DISTINCT array_to_string(w[i:i + n - 1], ' ') AS gram, n, item_id FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
  o AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)),
  h AS (SELECT doc_id, i, o.n, item_id FROM o JOIN g ON o.gram = g.gram AND o.n = g.n),
  k AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY 1),
  s AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM h GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN s USING (doc_id)
"""

OP10 = f"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x09-\\x0D ]+'), lambda x: x <> '') AS w FROM documents),
  p AS (SELECT doc_id, w[i] AS w, CASE WHEN i > 1 THEN w[i - 1] END AS v, CASE WHEN i > 2 THEN w[i - 2] END AS u FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
  c1 AS (SELECT w, count(*) AS n FROM p GROUP BY 1), c2 AS (SELECT v, w, count(*) AS n FROM p WHERE v IS NOT NULL GROUP BY 1, 2), c3 AS (SELECT u, v, w, count(*) AS n FROM p WHERE u IS NOT NULL GROUP BY 1, 2, 3),
  t AS (SELECT count(*) AS n FROM p),
  k AS (SELECT doc_id, p.u, p.v, t.n AS total, w1.n AS n_w, v1.n AS n_v, vw.n AS n_vw, uv.n AS n_uv, uvw.n AS n_uvw FROM p CROSS JOIN t JOIN c1 w1 ON p.w = w1.w LEFT JOIN c1 v1 ON p.v = v1.w
    LEFT JOIN c2 vw ON p.v = vw.v AND p.w = vw.w LEFT JOIN c2 uv ON p.u = uv.v AND p.v = uv.w LEFT JOIN c3 uvw ON p.u = uvw.u AND p.v = uvw.v AND p.w = uvw.w),
  s AS (SELECT doc_id, CASE WHEN u IS NOT NULL THEN ln(n_uvw / n_uv) WHEN v IS NOT NULL THEN ln(n_vw / n_v) ELSE ln(n_w / total) END AS s,
    coalesce(CASE WHEN u IS NOT NULL THEN n_uvw < 1 WHEN v IS NOT NULL THEN n_vw < 1 END, false) AS backed, coalesce(n_uvw, n_vw, n_w) = 1 AS single FROM k)
SELECT d.doc_id, CAST(count(s) AS BIGINT) AS n_words, CAST(coalesce(sum(CAST(backed AS BIGINT)), 0) AS BIGINT) AS n_backoff, CAST(coalesce(sum(CAST(single AS BIGINT)), 0) AS BIGINT) AS n_single,
  round(coalesce(sum(s), 0), 3) AS score FROM d LEFT JOIN s ON d.doc_id = s.doc_id GROUP BY 1
"""

_TERMS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP13 = f"""
WITH t AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
  d AS (SELECT r, doc_id, len(w) AS n FROM t WHERE len(w) > 0), s AS (SELECT count(*) AS n_docs, sum(n) AS n_terms FROM d),
  i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
  f AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM t) WHERE term IN (SELECT term FROM i) GROUP BY 1, 2),
  k AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term, n_docs),
  v AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS v FROM f JOIN k USING (term) JOIN d USING (r) CROSS JOIN s),
  c AS (SELECT item_id, r, doc_id, CAST(sum(v) AS BIGINT) AS score FROM v JOIN i USING (term) GROUP BY 1, 2, 3 HAVING sum(v) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM c
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""

SQL = {"op1_sharding": OP1, "op3_warc": OP3, "op5_embedding_dedup": OP5, "op6_mixing": OP6, "op8_chat": OP8, "op9_decontamination": OP9, "op10_lm_score": OP10, "op13_search": OP13}
