"""Queries of the training-data operators and their SQL, where SQL can express them."""

from __future__ import annotations

from . import quality_rules as rules
from .divergence import op13_divergence
from .mixing import op9_mixing
from .neardup_vectors import op5_near_vectors
from .packing import op10_packing
from .quality_cnn import op6_quality_cnn
from .quality_rules import op7_quality_rules
from .repair import op12_repair
from .sharding import op8_sharding
from .simhash import op2_simhash
from .substrings import op4_substrings
from .suffixes import op11_suffixes
from .toxicity import op1_toxicity
from .warc import op3_warc

QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_simhash,
        op3_warc,
        op4_substrings,
        op5_near_vectors,
        op6_quality_cnn,
        op7_quality_rules,
        op8_sharding,
        op9_mixing,
        op10_packing,
        op11_suffixes,
        op12_repair,
        op13_divergence,
    )
}

OP3_SQL = """
WITH p AS (SELECT page_id, COALESCE(html, '') AS h, strlen(COALESCE(html, '')) AS n FROM pages),
f AS (SELECT page_id, h, n, CASE WHEN n >= 100 THEN MIN(page_id) OVER (PARTITION BY h) END AS first_id FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
  CASE WHEN first_id IS NOT NULL AND (page_id IS NULL OR page_id <> first_id) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id IS NOT NULL AND (page_id IS NULL OR page_id <> first_id) THEN first_id END AS refers_to
FROM f
"""

OP5_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT e.vec_id, COALESCE(n.n, 0) AS n_links, LEAST(e.vec_id, COALESCE(m.m, e.vec_id)) AS component_id,
  e.vec_id = LEAST(e.vec_id, COALESCE(m.m, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN (SELECT a, COUNT(*) AS n FROM l GROUP BY a) n ON e.vec_id = n.a LEFT JOIN (SELECT a, MIN(b) AS m FROM r GROUP BY a) m ON e.vec_id = m.a
"""


def op7_sql() -> str:
    """The same measures by rows of words, and the same exact bounds by sums of binomial terms."""
    rates = {"symbol_rate": "n_symbols / w", "repeat_rate": "n_repeat_words / w", "dup_line_rate": "n_dup_lines / n_lines", "bang_rate": "n_bangs / w", "upper_rate": "n_upper / c"}
    level = rules.DELTA / (len(rules.STRATA) + 1)
    grid = ", ".join(f"('{r}', {i}, {c!r}::DOUBLE)" for i, (r, c) in enumerate(rules.cutoffs(), 1))
    stratum = " + ".join(f"CAST(n_words > {x} AS INT)" for x in rules.STRATA)
    return f"""
WITH d AS (SELECT ROW_NUMBER() OVER () AS k, doc_id, COALESCE(text, '') AS t FROM documents),
x AS (SELECT k, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda z: z <> '') AS ws, list_filter(string_split(t, chr(10)), lambda z: regexp_matches(z, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
s AS (SELECT k, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS g FROM (SELECT k, ws, UNNEST(range(1, len(ws) - 1)) AS i FROM x) y),
u AS (SELECT k, i FROM (SELECT k, i, COUNT(*) OVER (PARTITION BY k, g) AS c FROM s) y WHERE c > 1),
r AS (SELECT k, COUNT(DISTINCT i + o) AS n FROM u, (VALUES (0), (1), (2)) v(o) GROUP BY k),
m AS (SELECT d.k, d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(COALESCE(r.n, 0) AS BIGINT) AS n_repeat_words, len(string_split(t, chr(10))) AS n_lines,
  len(regexp_extract_all(t, '!')) AS n_bangs, len(regexp_extract_all(t, '\\p{{Lu}}')) AS n_upper FROM d JOIN x ON d.k = x.k LEFT JOIN r ON d.k = r.k),
q AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {stratum} AS stratum, GREATEST(n_words, 1)::DOUBLE AS w, GREATEST(word_chars, 1)::DOUBLE AS c FROM m),
a AS (SELECT *, {", ".join(f"({e})::DOUBLE AS {r}" for r, e in rates.items())} FROM q),
g(rule, i, cut) AS (VALUES {grid}),
b AS (SELECT a.k, MIN(g.i) AS step FROM a JOIN g ON CASE g.rule {" ".join(f"WHEN '{r}' THEN a.{r}" for r in rates)} END >= g.cut GROUP BY a.k),
e AS (SELECT a.*, b.step FROM a LEFT JOIN b ON a.k = b.k),
h AS (SELECT stratum, step FROM e JOIN (SELECT doc_id, MAX(quality) AS y FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) l ON e.doc_id = l.doc_id WHERE y = 1 AND NOT base_failed),
z AS (SELECT stratum, CAST(COUNT(*) AS INT) AS n FROM h GROUP BY stratum),
p AS (SELECT stratum, n, UNNEST(range(0, n + 1)) AS k FROM z),
f AS (SELECT stratum, k, SUM(exp(lgamma(n + 1.0) - lgamma(k + 1.0) - lgamma(n - k + 1.0) + k * ln({rules.ALPHA}) + (n - k) * ln(1 - {rules.ALPHA}))) OVER (PARTITION BY stratum ORDER BY k) AS cdf FROM p),
bound AS (SELECT z.stratum, COALESCE(MAX(k) FILTER (WHERE cdf <= {level}), -1) AS most FROM z LEFT JOIN f ON z.stratum = f.stratum GROUP BY z.stratum),
steps AS (SELECT bound.stratum, g.i FROM bound, g WHERE (SELECT COUNT(*) FROM h WHERE h.stratum = bound.stratum AND h.step <= g.i) <= bound.most),
chosen AS (SELECT stratum, MAX(i) AS last FROM steps GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT COALESCE(step <= last, FALSE) AS kept
FROM e LEFT JOIN chosen ON e.stratum = chosen.stratum
"""


OP11_SQL = """
WITH d AS (SELECT ROW_NUMBER() OVER (ORDER BY doc_id NULLS LAST) AS k, doc_id, hex(encode(COALESCE(text, ''))) AS h FROM documents),
s AS (SELECT k, i, md5(substr(h, 2 * i + 1, 200)) AS g FROM (SELECT k, h, UNNEST(range(0, len(h) // 2 - 99)) AS i FROM d) y),
r AS (SELECT k, i FROM (SELECT k, i, ROW_NUMBER() OVER (PARTITION BY g ORDER BY k, i) AS nth FROM s) y WHERE nth > 1),
m AS (SELECT k, i, SUM(jump) OVER (PARTITION BY k ORDER BY i) AS run FROM (SELECT k, i, CASE WHEN i - LAG(i) OVER (PARTITION BY k ORDER BY i) <= 100 THEN 0 ELSE 1 END AS jump FROM r) y),
c AS (SELECT k, MIN(i) AS b, MAX(i) + 100 AS e FROM m GROUP BY k, run),
p AS (SELECT c.k, b, e, substr(h, 2 * COALESCE(LAG(e) OVER (PARTITION BY c.k ORDER BY b), 0) + 1, 2 * (b - COALESCE(LAG(e) OVER (PARTITION BY c.k ORDER BY b), 0))) AS before FROM c JOIN d ON c.k = d.k),
q AS (SELECT k, SUM(e - b) AS n_removed, COUNT(*) AS n_spans, MAX(e) AS e, string_agg(before, '' ORDER BY b) AS before FROM p GROUP BY k)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed, CAST(COALESCE(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(COALESCE(before, '') || substr(h, 2 * COALESCE(e, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN q ON d.k = q.k
"""

OP13_SQL = r"""
WITH d AS (SELECT ROW_NUMBER() OVER () AS k, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source, COALESCE(text, '') AS t FROM documents),
w AS (SELECT k, lang, source, translate(UNNEST(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term, COUNT(*) AS lang_n FROM w GROUP BY lang, term HAVING COUNT(DISTINCT k) >= 10),
n AS (SELECT w.lang, w.source, w.term, COUNT(*) AS n FROM w JOIN kept ON w.lang = kept.lang AND w.term = kept.term GROUP BY w.lang, w.source, w.term),
g AS (SELECT DISTINCT lang, source FROM d),
dense AS (SELECT g.lang, g.source, kept.term, COALESCE(n.n, 0) AS n FROM g JOIN kept ON g.lang = kept.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = kept.term),
gp AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 2)) // (SUM(n) OVER (PARTITION BY lang, source) + 2 * COUNT(*) OVER (PARTITION BY lang, source)) AS p FROM dense),
lp AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (lang_n + 2)) // (SUM(lang_n) OVER (PARTITION BY lang) + 2 * COUNT(*) OVER (PARTITION BY lang)) AS q FROM kept),
s AS (SELECT a.lang, a.source, b.source AS item, SUM(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, COALESCE(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT gp.lang, gp.source, 'term', gp.term, ((p - q) * (p - q)) // (p + q) FROM gp JOIN lp ON gp.lang = lp.lang AND gp.term = lp.term WHERE n > 0 AND p > q),
z AS (SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(ROW_NUMBER() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM r)
SELECT * FROM z WHERE part = 'pair' OR rank <= 10
"""

ORACLE_SQL = {"op11_suffixes": OP11_SQL, "op3_warc": OP3_SQL, "op5_near_vectors": OP5_SQL, "op7_quality_rules": op7_sql(), "op13_divergence": OP13_SQL}
