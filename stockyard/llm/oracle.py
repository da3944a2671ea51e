"""DuckDB SQL of the registered operators that SQL can express.

The others (fingerprints, MinHash components, nearest neighbours, pseudonyms, BPE merges,
language machines, the quantised n-gram model, the pipeline) are tested against brute
force, round trips or held-out accuracy in tests/llm.
"""

from __future__ import annotations

import string

from . import licenses, line_dedup, mixing

_LOWERED = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

EXACT_DEDUP = f"""
WITH n AS (SELECT doc_id, sha256({_LOWERED}) AS sha FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY sha) AS keep_id, count(*) OVER (PARTITION BY sha) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY sha) AS kept, sha AS text_sha256
FROM n"""

# The level in closed form: sources by cap / weight; the first whose level leaves it under its cap sets it.
MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '{mixing.WORD}')) AS size FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1 AS BIGINT) AS weight,
         {mixing.MAX_RATE} * source_size AS cap
  FROM totals
), levels AS (
  SELECT weight, cap, row_number() OVER by_cap AS place,
         CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (by_cap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
         / CAST(sum(weight) OVER (by_cap ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM ranked WINDOW by_cap AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST)
), chosen AS (
  SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= cap
), targets AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), weight * coalesce((SELECT level FROM chosen), 0.0::DOUBLE)) AS target FROM ranked
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / CAST(source_size AS DOUBLE) ELSE 1.0::DOUBLE END AS rate FROM targets
)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, r.source_size, r.target,
       CAST(s.size * (floor(r.rate) + CASE WHEN
         CAST('0x' || substr(md5('0:' || coalesce(CAST(s.doc_id AS VARCHAR), 'text:' || md5(coalesce(s.text, '')))), 1, 13) AS BIGINT)
         / {float(1 << 52)!r}::DOUBLE < r.rate - floor(r.rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source"""

_LINES = line_dedup.Params()
LINE_DEDUP = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), lines AS (
  SELECT r, doc_id, unnest(generate_series(1, len(l))) AS p, unnest(l) AS line FROM d
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM lines
), frequent AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= {_LINES.min_chars}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {_LINES.min_docs}
), marked AS (
  SELECT k.r, k.doc_id, k.p, k.line, f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.last AS gone
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r"""


def _license_scan() -> str:
    quoted = ", ".join(f"({k}, '{name}', '" + text.replace("'", "''") + "')" for k, (name, text) in enumerate(licenses.TEMPLATES))
    t = f"{licenses.THRESHOLD}::DOUBLE"
    words = "string_split(trim(lower(regexp_replace({}, '[^A-Za-z0-9]+', ' ', 'g'))), ' ')"
    grams = "list_distinct(list_transform(generate_series(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1]))"
    return f"""
WITH templates AS (
  SELECT k, license, {grams} AS g FROM (SELECT k, license, {words.format("t")} AS w FROM (VALUES {quoted}) v(k, license, t))
), lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS l, row_number() OVER () AS row FROM documents WHERE text IS NOT NULL
), passages AS (
  SELECT row, doc_id, CAST(unnest(generate_series(1, len(l))) AS INTEGER) AS line, unnest(l) AS passage FROM lines
  UNION ALL SELECT row, doc_id, 0, text FROM lines WHERE len(l) > 1
), split AS (
  SELECT row, doc_id, line, {words.format("passage")} AS w FROM passages
), sets AS (
  SELECT row, doc_id, line, {grams} AS g FROM split WHERE len(w) >= 2
), scored AS (
  SELECT s.row, s.doc_id, s.line, t.k, t.license, 2.0::DOUBLE * len(list_intersect(s.g, t.g)) / CAST(len(s.g) + len(t.g) AS DOUBLE) AS dice
  FROM sets s JOIN templates t
    ON len(s.g) >= len(t.g) * {t} / (2 - {t}) AND len(s.g) <= len(t.g) * (2 - {t}) / {t} AND list_has_any(s.g, t.g)
), named AS (
  SELECT row, doc_id, line, unnest(generate_series(1, len(w))) AS i, unnest(w) AS word FROM split WHERE line > 0
), numbered AS (
  SELECT row, doc_id, line, row_number() OVER text AS p, word || ' ' || lead(word) OVER text AS gram
  FROM named WHERE word <> '' WINDOW text AS (PARTITION BY row ORDER BY line, i)
), forms AS (
  SELECT k, license, g, len(g) AS size, len(w) - 1 AS n FROM (SELECT t.*, {words.format("v.t")} AS w FROM templates t JOIN (VALUES {quoted}) v(k, license, t) USING (k))
  WHERE len(w) >= {licenses.WINDOW_WORDS}
), starts AS (
  SELECT d.row, d.doc_id, d.line, d.p, f.k, f.license, f.g, f.size, f.n
  FROM numbered d JOIN (SELECT k, unnest(g) AS gram FROM forms) u ON d.gram = u.gram JOIN forms f ON f.k = u.k
  QUALIFY len(list(DISTINCT d.gram) OVER (PARTITION BY d.row, f.k)) >= f.size * {t} / (2 - {t}) - 1e-9
), windows AS (
  SELECT s.row, s.doc_id, s.line, s.k, s.license, s.p,
         2.0::DOUBLE * count(DISTINCT d.gram) FILTER (list_contains(s.g, d.gram)) / CAST(count(DISTINCT d.gram) + any_value(s.size) AS DOUBLE) AS dice
  FROM starts s JOIN numbered d ON d.row = s.row AND d.p BETWEEN s.p AND s.p + s.n - 1 AND d.gram IS NOT NULL
  GROUP BY s.row, s.doc_id, s.line, s.k, s.license, s.p
), peaks AS (
  SELECT * FROM (
    SELECT *, lag(dice) OVER text AS before, lead(dice) OVER text AS after FROM (
      SELECT row, doc_id, line, k, license, p, max(dice) AS dice FROM windows GROUP BY ALL)
    WINDOW text AS (PARTITION BY row, k ORDER BY p))
  WHERE dice >= {t} AND dice >= coalesce(before, 0) AND dice > coalesce(after, 0)
)
SELECT doc_id, line, license, dice FROM (
  SELECT *, row_number() OVER (PARTITION BY row, line ORDER BY dice DESC, k) AS turn FROM (
    SELECT row, doc_id, line, k, license, dice FROM scored UNION ALL SELECT row, doc_id, line, k, license, dice FROM peaks))
WHERE turn = 1 AND dice >= {t}"""


def oracle_sql() -> dict[str, str]:
    return {"op4_license_scan": _license_scan(), "op5_mixing": MIXING, "op9_exact_dedup": EXACT_DEDUP, "op12_line_dedup": LINE_DEDUP}
