"""The quality rules as DuckDB SQL, from the same expressions of features and distances."""

from __future__ import annotations

from cadenza.llm.quality import BASE_FAILED, CUTOFF, DIMS, DISTANCE, ESTIMATE, FEATURES, FLOORS, HALF, LEAST_ROWS, MEDIAN, MOMENTS, PAIRS, PARAMETERS, STEPS, X

_WORD = r"[^\x20\x09-\x0D]+"


def _cut_at(name: str, rows: str, value: str, by: str, share: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT {by}, min({value}) AS at_value, max(n) AS n FROM (
    SELECT {by}, {value}, sum(c) OVER (PARTITION BY {by} ORDER BY {value}) AS upto, sum(c) OVER (PARTITION BY {by}) AS n
    FROM (SELECT {by}, {value}, count(*) AS c FROM {rows} GROUP BY ALL)
  ) WHERE upto >= {share} GROUP BY {by}
)"""


def quality_ctes(documents: str = "documents") -> str:
    """CTEs that end in ``verdict``: doc_id, the measures, base_failed and kept."""
    steps = []
    for step in range(STEPS + 1):
        steps.append(f"""seen{step} AS MATERIALIZED (SELECT k1, k2, {', '.join(X)}, {', '.join(DISTANCE)} FROM rows_ JOIN found{step} USING (k1, k2))""")
        steps.append(_cut_at(f"limit{step}", f"seen{step}", "bin", "k1, k2", HALF))
        if step < STEPS:
            steps.append(f"""sums{step} AS (SELECT k1, k2, {', '.join(f'{m.split(" AS ")[0]} AS {m.split(" AS ")[1]}' for m in MOMENTS)}
  FROM (SELECT s.* FROM seen{step} s JOIN limit{step} USING (k1, k2) WHERE s.bin <= at_value) GROUP BY k1, k2
), found{step + 1} AS MATERIALIZED (SELECT k1, k2, {', '.join(PARAMETERS)} FROM (SELECT k1, k2, {', '.join(ESTIMATE)} FROM sums{step}))""")
    start = [f"CAST(centre{j} AS DOUBLE) AS m{j}" for j in range(1, DIMS + 1)]
    start += [f"greatest(CAST(1.4826 AS DOUBLE) * at{j}, CAST({FLOORS[j - 1]} AS DOUBLE)) AS l{j}{k}" if j == k else f"CAST(0 AS DOUBLE) AS l{j}{k}" for j, k in PAIRS]
    sides = ", ".join(f"max(centre) FILTER (f = {j}) AS centre{j}, max(away) FILTER (f = {j}) AS at{j}" for j in range(1, DIMS + 1))
    long = " UNION ALL ".join(f"SELECT k1, k2, {j} AS f, x{j} AS x FROM rows_" for j in range(1, DIMS + 1))
    return rf"""
texts_ AS MATERIALIZED (
  SELECT row_number() OVER () AS row_, *, coalesce(regexp_extract_all(text, '{_WORD}'), []) AS w FROM {documents}
), gram_ AS (
  SELECT row_, i, count(*) OVER (PARTITION BY row_, g) AS times
  FROM (SELECT row_, i, array_to_string(w[i : i + 2], ' ') AS g FROM (SELECT row_, w, unnest(range(1, len(w) - 1)) AS i FROM texts_))
), repeated_ AS (
  SELECT row_, count(DISTINCT spot) AS n_repeat FROM (SELECT row_, unnest(range(i, i + 3)) AS spot FROM gram_ WHERE times > 1) GROUP BY row_
), lines_ AS (
  SELECT row_, count(*) - count(DISTINCT line) AS n_dup FROM (SELECT row_, unnest(string_split(text, chr(10))) AS line FROM texts_)
  WHERE regexp_matches(line, '{_WORD}') GROUP BY row_
), measured_ AS MATERIALIZED (
  SELECT *, {BASE_FAILED} AS base_failed FROM (
    SELECT row_, doc_id, coalesce(lang, '') AS k1, coalesce(source, '') AS k2, CAST(len(w) AS BIGINT) AS n_words,
      CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
      CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
      coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words
    FROM texts_ LEFT JOIN lines_ USING (row_) LEFT JOIN repeated_ USING (row_)
  )
), grouped_ AS MATERIALIZED (
  SELECT * REPLACE (CASE WHEN count(*) FILTER (NOT base_failed) OVER (PARTITION BY k1, k2) >= {LEAST_ROWS} THEN 's' || k2 ELSE '' END AS k2) FROM measured_
), rows_ AS MATERIALIZED (
  SELECT * FROM (SELECT k1, k2, {', '.join(FEATURES)}, count(*) OVER (PARTITION BY k1, k2) AS members FROM grouped_ WHERE NOT base_failed)
  WHERE members >= {LEAST_ROWS}
), long_ AS ({long}), {_cut_at('centre_', 'long_', 'x', 'k1, k2, f', 'n / 2')},
away_ AS (SELECT k1, k2, f, abs(x - at_value) AS away FROM long_ JOIN centre_ USING (k1, k2, f)),
{_cut_at('spread_', 'away_', 'away', 'k1, k2, f', 'n / 2')},
found0 AS MATERIALIZED (
  SELECT k1, k2, {', '.join(start)} FROM (
    SELECT k1, k2, {sides} FROM (
      SELECT c.k1, c.k2, c.f, c.at_value AS centre, s.at_value AS away FROM centre_ c JOIN spread_ s ON c.k1 = s.k1 AND c.k2 = s.k2 AND c.f = s.f
    ) GROUP BY k1, k2
  )
), {', '.join(steps)},
final_ AS (
  SELECT f.*, greatest(CAST(1 AS DOUBLE), ((at_value + 1) / CAST(16 AS DOUBLE)) * ((at_value + 1) / CAST(16 AS DOUBLE)) / CAST({MEDIAN} AS DOUBLE)) AS scale
  FROM found{STEPS} f JOIN limit{STEPS} USING (k1, k2)
), far_ AS (
  SELECT row_, d2, scale FROM (
    SELECT row_, scale, {', '.join(X)}, {', '.join(DISTANCE)} FROM (
      SELECT row_, k1, k2, {', '.join(FEATURES)} FROM grouped_ WHERE NOT base_failed
    ) JOIN final_ USING (k1, k2)
  )
), verdict AS (
  SELECT row_, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND coalesce(d2 <= CAST({CUTOFF} AS DOUBLE) * scale, true) AS kept
  FROM grouped_ LEFT JOIN far_ USING (row_)
)"""


QUALITY_SQL = f"WITH {quality_ctes()} SELECT * EXCLUDE (row_) FROM verdict"
