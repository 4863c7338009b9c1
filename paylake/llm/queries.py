"""Registered queries of this subpackage, and SQL where SQL can say the same.

Each query applies one operator with its production parameters to its whole
table and derives the digest columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylake.llm import (
    decontaminate,
    language_id,
    line_dedup,
    merkle,
    mixing,
    ngram_join,
    quality,
    secret_scan,
    simhash,
    suffix_dedup,
    token_align,
    token_counts,
    token_files,
)
from paylake.llm.common import read_table
from paylake.llm.merkle_sql import OP13_SQL


def _over(fn, *tables: str):
    """A query that hands the named tables to ``fn``."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(*(read_table(spark, sf_dir, t) for t in tables))
    run.__doc__ = fn.__doc__
    return run


QUERIES = {
    "op1_suffix_dedup": _over(suffix_dedup.op1_suffix_dedup, "documents"),
    "op2_secret_scan": _over(secret_scan.op2_secret_scan, "documents"),
    "op3_simhash": _over(simhash.op3_simhash, "documents"),
    "op4_quality_rules": _over(quality.op4_quality_rules, "documents"),
    "op5_token_output": _over(token_files.op5_token_output, "documents"),
    "op6_mix_sources": _over(mixing.op6_mix_sources, "documents"),
    "op7_language_id": _over(language_id.op7_language_id, "pages", "documents"),
    "op8_decontaminate": _over(decontaminate.op8_decontaminate, "documents", "benchmark"),
    "op9_line_dedup": _over(line_dedup.op9_line_dedup, "documents"),
    "op10_token_counts": _over(token_counts.op10_token_counts, "documents"),
    "op11_ngram_join": _over(ngram_join.op11_ngram_join, "documents"),
    "op12_token_align": _over(token_align.op12_token_align, "documents"),
    "op13_merkle_manifest": _over(merkle.op13_merkle_manifest, "documents"),
}

_SPACES = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"

OP4_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS t, lang, source,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         string_split(coalesce(text, ''), chr(10)) AS l
  FROM documents),
pos AS (
  SELECT doc_id, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS tri
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)),
twice AS (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, tri) AS n FROM pos) WHERE n > 1),
reps AS (SELECT doc_id, count(DISTINCT p) AS n FROM twice GROUP BY doc_id),
m AS (
  SELECT words.doc_id, lang, source, len(w) AS n_words,
         list_aggregate(list_transform(w, lambda x: length(x)), 'sum')::BIGINT AS wc,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         list_filter(l, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS held, len(l) AS n_lines,
         coalesce(reps.n, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN reps USING (doc_id)),
metrics AS (
  SELECT doc_id, lang, source, n_words, coalesce(wc, 0) AS word_chars, n_symbols,
         (len(held) - len(list_distinct(held)))::BIGINT AS n_dup_lines, n_repeat_words, n_lines FROM m),
ratio AS (
  SELECT doc_id, lang, source, unnest(['symbols', 'repeats', 'dup_lines', 'word_length']) AS metric,
         unnest([1000 * n_symbols // n_words, 1000 * n_repeat_words // n_words,
                 1000 * n_dup_lines // n_lines, 100 * word_chars // n_words]) AS v,
         unnest([n_symbols >= 10, n_repeat_words >= 60, n_dup_lines >= 4, true]) AS enough
  FROM metrics WHERE n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words),
b AS (SELECT *, greatest(length(bin(v)) - 6, 0) AS e FROM ratio),
low AS (SELECT *, ((v >> e) << e) AS low FROM b),
levels AS (
  SELECT lang, source, metric, 1 AS lvl, low FROM low
  UNION ALL SELECT lang, NULL, metric, 2, low FROM low
  UNION ALL SELECT NULL, NULL, metric, 3, low FROM low),
fence AS (
  SELECT lang, source, metric, lvl, count(*) AS n, quantile_disc(low, 0.1) AS q10, quantile_disc(low, 0.5) AS q50,
         quantile_disc(low, 0.9) AS q90
  FROM levels GROUP BY ALL),
bounds AS (
  SELECT *, q90 + 5 * greatest(q90 - q50, q50 // 32) AS hi, q10 - 5 * greatest(q50 - q10, q50 // 32) AS lo FROM fence),
used AS (
  SELECT r.doc_id, r.metric, r.low AS v, r.enough,
         CASE WHEN a.n >= 200 THEN a.hi WHEN g.n >= 200 THEN g.hi ELSE h.hi END AS hi,
         CASE WHEN a.n >= 200 THEN a.lo WHEN g.n >= 200 THEN g.lo ELSE h.lo END AS lo
  FROM low r
  JOIN bounds a ON a.lvl = 1 AND a.metric = r.metric AND a.lang IS NOT DISTINCT FROM r.lang
                AND a.source IS NOT DISTINCT FROM r.source
  JOIN bounds g ON g.lvl = 2 AND g.metric = r.metric AND g.lang IS NOT DISTINCT FROM r.lang
  JOIN bounds h ON h.lvl = 3 AND h.metric = r.metric),
failed AS (
  SELECT DISTINCT doc_id FROM used WHERE enough AND (v > hi OR (metric = 'word_length' AND v < lo)))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND doc_id NOT IN (SELECT doc_id FROM failed) AS kept
FROM metrics
"""

OP9_SQL = f"""
WITH lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
pos AS (
  SELECT doc_id, i, l[i] AS line,
         translate(trim(l[i], {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM lines)),
shared AS (
  SELECT k, max(doc_id) AS last FROM pos WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT pos.*, (shared.k IS NOT NULL AND doc_id <> last) AS gone FROM pos LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP8_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iwin AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM iw WHERE len(w) > 0)),
dwin AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM dw JOIN (SELECT DISTINCT n FROM iwin) ON len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM dwin JOIN iwin USING (k, n)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN names USING (doc_id)
"""

OP1_SQL = r"""
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)),
ids AS (
  SELECT h, doc_id, lag(doc_id) OVER o AS prev, lead(doc_id) OVER o AS next
  FROM (SELECT DISTINCT h, doc_id FROM win) WINDOW o AS (PARTITION BY h ORDER BY doc_id)),
hit AS (
  SELECT win.doc_id, i, coalesce(prev, next) AS other FROM win JOIN ids USING (h, doc_id)
  WHERE prev IS NOT NULL OR next IS NOT NULL),
gap AS (
  SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS fresh FROM hit),
grp AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM gap)
SELECT doc_id, min(i) - 1 AS start, max(i) + 49 AS "end", max(i) + 50 - min(i) AS n_words, min(other) AS other_doc_id
FROM grp GROUP BY doc_id, g
"""

OP11_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
grams AS (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1),
                             lambda i: md5(w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))
                        WHEN len(w) > 0 THEN [md5(array_to_string(w, ' '))] ELSE [] END) AS g
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 90 * (x.n + y.n - c)),
reached AS (
  SELECT a AS doc_id, b AS other FROM links
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
FROM words LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT doc_id, min(other) AS low FROM reached GROUP BY doc_id) USING (doc_id)
"""

ORACLE_SQL = {"op1_suffix_dedup": OP1_SQL, "op8_decontaminate": OP8_SQL, "op4_quality_rules": OP4_SQL, "op9_line_dedup": OP9_SQL, "op11_ngram_join": OP11_SQL,
              "op13_merkle_manifest": OP13_SQL}
