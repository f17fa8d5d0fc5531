"""DuckDB SQL for the operators that SQL can express, written from their definitions."""

from __future__ import annotations

# Lines: a blank line belongs to the line before it. A pair of lines goes when the same
# pair occurs earlier; all lines it covers go. A line of 50 words or more goes when the same
# line occurs earlier, whatever stands beside it.
OP2 = r"""
WITH raw AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL
), marked AS (
  SELECT *, CASE WHEN i = 1 OR regexp_matches(line, '[^\x20\x09-\x0D]') THEN 1 ELSE 0 END AS opens FROM raw
), numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS unit FROM marked
), units AS (
  SELECT doc_id, unit, string_agg(line, chr(10) ORDER BY i) AS body FROM numbered GROUP BY doc_id, unit
), trimmed AS (
  SELECT doc_id, unit, body, regexp_replace(body, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line FROM units
), pairs AS (
  SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY unit) AS nxt,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 50 AND row_number() OVER (PARTITION BY line ORDER BY doc_id, unit) > 1 AS lone
  FROM trimmed
), ranked AS (
  SELECT *, CASE WHEN nxt IS NULL THEN 0 WHEN row_number() OVER (PARTITION BY line, nxt ORDER BY doc_id, unit) > 1 THEN 1 ELSE 0 END AS rep FROM pairs
), covered AS (
  SELECT *, greatest(rep, coalesce(lag(rep) OVER (PARTITION BY doc_id ORDER BY unit), 0), CASE WHEN lone THEN 1 ELSE 0 END) AS gone FROM ranked
), result AS (
  SELECT doc_id, count(*) AS n_lines, sum(gone) AS n_removed, string_agg(body, chr(10) ORDER BY unit) FILTER (WHERE gone = 0) AS kept
  FROM covered GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text
FROM documents d LEFT JOIN result r ON d.doc_id = r.doc_id
"""

OP9 = r"""
WITH base AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), word AS (
  SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM base
), win AS (
  SELECT doc_id, x, i, lead(x, 1) OVER d AS y, lead(x, 2) OVER d AS z FROM word WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), counted AS (
  SELECT doc_id, i, CASE WHEN z IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, x, y, z) > 1 THEN 1 ELSE 0 END AS rep FROM win
), cover AS (
  SELECT doc_id, max(rep) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c FROM counted
), rep AS (
  SELECT doc_id, sum(c) AS n FROM cover GROUP BY doc_id
), line AS (
  SELECT doc_id, l, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM base)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
  GROUP BY doc_id, l
), dup AS (
  SELECT doc_id, sum(n - 1) AS n FROM (SELECT doc_id, trim_l, sum(n) AS n FROM (SELECT doc_id, l AS trim_l, n FROM line) GROUP BY doc_id, trim_l) GROUP BY doc_id
), m AS (
  SELECT b.doc_id, b.source, CAST(len(b.w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(b.text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(b.text) - length(regexp_replace(b.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM base b LEFT JOIN rep ON b.doc_id = rep.doc_id LEFT JOIN dup ON b.doc_id = dup.doc_id
), f AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m
), host AS (
  SELECT source, count(*) AS n, sum(CASE WHEN base_failed THEN 1 ELSE 0 END) AS failed FROM f WHERE source IS NOT NULL GROUP BY source
), total AS (
  SELECT CAST(sum(n) AS DOUBLE) AS n, CAST(sum(failed) AS DOUBLE) AS failed, count(*) AS h, sum(CAST(failed AS DOUBLE) * failed / n) AS q FROM host
), prior AS (
  SELECT failed / n AS mean, greatest(q / n - (failed / n) * (failed / n) - (failed / n) * (1 - failed / n) * h / n, 1e-6) AS var FROM total
), weight AS (
  SELECT mean, greatest(mean * (1 - mean) / var - 1, 1e-6) AS s FROM prior
), verdict AS (
  SELECT source, (failed + mean * s) / (n + s) > 0.6 AS rejected FROM host, weight
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND NOT coalesce(rejected, false)) AS kept
FROM f LEFT JOIN verdict v ON f.source = v.source
"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 3 AS cap FROM src
), levels AS (
  SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps_before,
         sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights_left
  FROM weighed
), capped AS (
  SELECT *, CAST(total - caps_before AS DOUBLE) / weights_left > CAST(cap AS DOUBLE) / weight AS is_capped FROM levels
), target AS (
  SELECT source, source_size,
         CASE WHEN is_capped THEN CAST(cap AS DOUBLE)
              ELSE CAST(total - sum(CASE WHEN is_capped THEN cap ELSE 0 END) OVER () AS DOUBLE) / sum(CASE WHEN is_capped THEN 0 ELSE weight END) OVER () * weight END AS target,
         CAST(CAST('0x' || substr(md5('42|' || coalesce('s' || source, 'n')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
  FROM capped
), ranked AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.u, row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS k,
         CASE WHEN t.source_size > 0 THEN least(3.0, t.target / t.source_size) ELSE 0.0 END AS step
  FROM d JOIN target t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CAST(size * (floor(k * step + u) - floor((k - 1) * step + u)) AS BIGINT) AS taken
FROM ranked
"""



def _op11(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Codebooks over all entries and no search: every part is compared to each."""

    def nearest(k: int) -> str:
        return f"""d{k} AS (
  SELECT c.r, c.part, b.entry, sum((c.x - b.x) * (c.x - b.x)) AS d FROM comp c JOIN book{k} b ON c.part = b.part AND c.pos = b.pos GROUP BY c.r, c.part, b.entry
), a{k} AS (
  SELECT r, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM d{k} GROUP BY r, part
)"""

    def moved(k: int) -> str:
        return f"""s{k} AS (
  SELECT a.part, a.entry, c.pos, CAST(sum(c.x) AS BIGINT) AS s, count(*) AS n FROM a{k} a JOIN comp c ON a.r = c.r AND a.part = c.part GROUP BY a.part, a.entry, c.pos
), book{k + 1} AS (
  SELECT b.part, b.entry, b.pos, CASE WHEN s.n IS NULL THEN b.x ELSE (s.s - ((s.s % s.n) + s.n) % s.n) // s.n END AS x
  FROM book{k} b LEFT JOIN s{k} s ON b.part = s.part AND b.entry = s.entry AND b.pos = s.pos
)"""

    steps = [x for k in range(rounds) for x in (nearest(k), moved(k))] + [nearest(rounds)]
    return f"""
WITH kept AS (
  SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), flat AS (
  SELECT r, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i, len(embedding) // {parts} AS width FROM kept
), comp AS (
  SELECT r, i // width AS part, i % width AS pos, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM flat
), book0 AS (
  SELECT part, r AS entry, pos, x FROM comp WHERE r < {entries}
), {", ".join(steps)}, coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r
)
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book{rounds}) AS codebooks_sha256
FROM kept k JOIN coded c ON k.r = c.r
"""


OP11 = _op11()

ORACLE_SQL: dict[str, str] = {"op2_line_dedup": OP2, "op9_quality_rules": OP9, "op10_mixing": OP10, "op11_vector_codes": OP11}
