"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations


def _fill(nodes: str, parent: str, budget: str) -> str:
    """Water-filling of ``nodes`` (weight, cap) under ``parent``."""
    return f"""
    SELECT *, least(cap::DOUBLE, greatest(max(lvl) OVER (PARTITION BY {parent}) * weight, 0.0)) AS share FROM (
      SELECT *, ({budget} - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER (PARTITION BY {parent}) - coalesce(sum(weight) OVER before, 0.0)) AS lvl
      FROM {nodes} WINDOW before AS (PARTITION BY {parent} ORDER BY cap / weight, cap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


MIXING = f"""
WITH docs AS (
  SELECT doc_id, 'd' || (regexp_extract(source, '(\\d+)$', 1)::INT % 4) AS domain, lang, source,
         len(regexp_extract_all(text, '\\S+'))::BIGINT AS n_tokens FROM documents),
leaves AS (
  SELECT domain, lang, source, sum(n_tokens) AS tokens, sum(n_tokens) * 2 AS cap, 1.0::DOUBLE AS weight FROM docs GROUP BY ALL),
n1 AS (
  SELECT domain, sum(cap) AS cap, CASE domain WHEN 'd1' THEN 2.0 ELSE 1.0 END::DOUBLE AS weight,
         (SELECT sum(tokens) FROM leaves)::DOUBLE AS above, 0 AS root FROM leaves GROUP BY domain),
g1 AS ({_fill('n1', 'root', 'above')}),
n2 AS (
  SELECT domain, lang, sum(l.cap) AS cap, CASE lang WHEN 'en' THEN 4.0 ELSE 1.0 END::DOUBLE AS weight, any_value(g1.share) AS above
  FROM leaves l JOIN g1 USING (domain) GROUP BY domain, lang),
g2 AS ({_fill('n2', 'domain', 'above')}),
n3 AS (SELECT l.*, g2.share AS above FROM leaves l JOIN g2 USING (domain, lang)),
g3 AS ({_fill('n3', 'domain, lang', 'above')}),
plan AS (SELECT domain, lang, source, floor(share)::BIGINT // tokens::BIGINT AS full_epochs, floor(share)::BIGINT % tokens::BIGINT AS rest FROM g3),
ordered AS (
  SELECT doc_id, domain, lang, source, n_tokens, full_epochs, rest,
         sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('42:' || full_epochs || ':' || doc_id), n_tokens
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM docs JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, (full_epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM ordered
"""

CHAT = """
WITH t AS (
  SELECT conv_id, lone, role, text, row_number() OVER (PARTITION BY conv_id, lone ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS p
  FROM (SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS lone FROM conversations)),
c AS (SELECT conv_id, count(*) AS n, list({'r': role, 't': text} ORDER BY p) AS l FROM t GROUP BY conv_id, lone),
w AS (SELECT min(conv_id) AS conv_id, n, l, count(*) AS logged FROM c GROUP BY n, l)
SELECT conv_id, n::BIGINT AS n_turns, logged AS n_logged,
       array_to_string(list_transform(l, lambda x: '<|im_start|>' || coalesce(x.r, '') || chr(10) || coalesce(x.t, '') || '<|im_end|>' || chr(10)), '') AS text
FROM w WHERE NOT EXISTS (SELECT 1 FROM c d WHERE d.n > w.n AND d.l[1:w.n] = w.l)
"""

NEAR_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_max(list_transform(embedding, lambda x: abs(x))) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT vec_id AS id, vec_id AS other FROM embeddings
  UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.other = links.a),
least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE links.a = least.id) AS n_links, component_id, component_id = id AS kept FROM least
"""

SUFFIXES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
block AS (SELECT doc_id, 500 * k AS base, substr(h, 1000 * k + 1, 1198) AS s FROM (SELECT *, unnest(range(0, length(h) // 1000 + 1)) AS k FROM d)),
w AS (SELECT doc_id, base + i AS start, substr(s, 2 * i + 1, 200) AS s FROM (SELECT *, unnest(range(0, least(500, length(s) // 2 - 99))) AS i FROM block)),
again AS (
  SELECT doc_id, start FROM (SELECT doc_id, start, row_number() OVER (PARTITION BY md5(s) ORDER BY doc_id, start) AS nth FROM w)
  WHERE nth > 1),
edge AS (SELECT doc_id, start, coalesce(start > lag(start) OVER (PARTITION BY doc_id ORDER BY start) + 100, true)::INT AS opens FROM again),
run AS (
  SELECT doc_id, min(start) AS a, max(start) + 100 AS b
  FROM (SELECT doc_id, start, sum(opens) OVER (PARTITION BY doc_id ORDER BY start) AS nth FROM edge) GROUP BY doc_id, nth),
piece AS (
  SELECT doc_id, a, b - a AS gone, substr(h, 2 * coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1,
         2 * (a - coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0))) AS before FROM run JOIN d USING (doc_id)),
kept AS (SELECT doc_id, sum(gone) AS n_removed, count(*) AS n_spans, string_agg(before, '' ORDER BY a) AS head, max(a + gone) AS last FROM piece GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

JACCARD = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\\s+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 9 * c >= 4 * (x.n + y.n)),
reach AS (
  SELECT doc_id AS id, doc_id AS other FROM documents
  UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.other = links.a),
least AS (SELECT id, min(other) AS class_id FROM reach GROUP BY id)
SELECT id AS doc_id, class_id, (SELECT count(*) FROM links WHERE links.a = least.id) AS n_links, class_id = id AS kept FROM least
"""

DIVERGENCE = """
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT doc, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL),
n AS (SELECT g.lang, g.source, v, coalesce(sum(c), 0) AS n FROM grp g JOIN size USING (lang) LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT n.lang, n.source, kept.term, coalesce(c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c, 0) + 1)) // (n + v)::HUGEINT AS p
  FROM n JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(c) + 1)) // (sum(sum(c)) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang))::HUGEINT AS q
  FROM p GROUP BY lang, term),
listed AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // y.p) FROM p x JOIN p y USING (lang, term) WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM listed)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

RANKED = f"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
tf AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(w) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
i AS (SELECT row_number() OVER () AS item, item_id, {_WORDS} AS w FROM benchmark),
q AS (SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(w) AS term FROM i) GROUP BY ALL),
wq AS (SELECT item, item_id, term, times, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight FROM q JOIN df USING (term), s),
scored AS (
  SELECT item, item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(w) * n) // l))))::BIGINT AS score
  FROM wq JOIN tf USING (term) JOIN d USING (doc), s GROUP BY item, item_id, doc, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE: dict[str, str] = {"op1_embedding_neardup": NEAR_VECTORS, "op4_ngram_jaccard": JACCARD, "op5_suffix_dedup": SUFFIXES, "op7_mixing": MIXING, "op8_chat": CHAT, "op11_source_divergence": DIVERGENCE, "op12_ranked_search": RANKED}
