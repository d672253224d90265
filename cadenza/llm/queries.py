"""The operators applied to their whole tables, each with its DuckDB SQL where one exists."""

from __future__ import annotations

from cadenza.llm import content_sort, periodic_runs, phrase_dedup, suffix_dedup, warc
from cadenza.llm.bpe import round_trip
from cadenza.llm.decontaminate import hit_counts
from cadenza.llm.html_text import extract
from cadenza.llm.jaccard_groups import linked
from cadenza.llm.lexical_search import search
from cadenza.llm.pii import find_spans
from cadenza.llm.quality import judged
from cadenza.llm.quality_sql import QUALITY_SQL
from cadenza.llm.url_filters import Rule, filter_urls
from cadenza.session import small_batches

QUERIES = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = (function, sql)
        return function

    return register


def table(spark, sf_dir: str, name: str):
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


def _url_sql() -> str:
    fits = " ".join(
        f"WHEN ('.' || host) LIKE '%.{r.host}' AND starts_with(path, '{r.path}') THEN {{}}"
        for r in sorted(URL_RULES, key=lambda r: -len(r.text))
    )
    ordered = sorted(URL_RULES, key=lambda r: -len(r.text))
    rule = "CASE " + fits.format(*(f"'{r.text}'" for r in ordered)) + " END"
    verdict = "CASE " + fits.format(*(f"'{r.verdict}'" for r in ordered)) + " ELSE 'allow' END"
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
)
SELECT page_id, host, path, {rule} AS rule, {verdict} AS verdict FROM parts"""


@query("op1_url_filters", _url_sql())
def op1(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES, id_column="page_id")


_WORD4 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_DECONTAMINATION_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD4}'), []) AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD4}') AS w
  FROM benchmark
), item_window AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM item_window), places AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d
), doc_window AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS phrase FROM places, sizes WHERE i + n - 1 <= len(w)
), hit AS (
  SELECT doc_id, i, n, item FROM doc_window JOIN item_window USING (n, phrase)
), hit_words AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS listed FROM hit GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query("op4_decontamination", _DECONTAMINATION_SQL)
def op4(spark, sf_dir):
    return hit_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_bpe")
def op8(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "documents"))


_JACCARD_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), shingle AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM d WHERE len(w) > 0)
), sized AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS MATERIALIZED (
  SELECT x, y FROM common JOIN sized p ON p.doc_id = x JOIN sized q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least AS component_id
FROM d LEFT JOIN sized USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS least FROM reach GROUP BY x) USING (doc_id)"""


@query("op5_jaccard_join", _JACCARD_SQL)
def op5(spark, sf_dir):
    return linked(table(spark, sf_dir, "documents"))


@query("op2_quality_rules", QUALITY_SQL)
def op2(spark, sf_dir):
    return judged(table(spark, sf_dir, "documents"), carry=["doc_id"])


@query("op10_pii")
def op10(spark, sf_dir):
    return find_spans(table(spark, sf_dir, "documents"))


@query("op7_html_extraction")
def op7(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))


@query("op3_suffix_dedup")
def op3(spark, sf_dir):
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query("op9_phrase_dedup")
def op9(spark, sf_dir):
    return phrase_dedup.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


_WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
first AS (SELECT digest, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY digest)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN first USING (digest)"""


@query("op6_warc", _WARC_SQL)
def op6(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


_SEARCH_SQL = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), lengths AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), whole),
parts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))) AS part
  FROM tf JOIN weights USING (term) JOIN lengths USING (doc_id), whole
), scores AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM q JOIN parts USING (term) GROUP BY ALL),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10"""


@query("op11_lexical_search", _SEARCH_SQL)
def op11(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_periodic_runs")
def op12(spark, sf_dir):
    return periodic_runs.run_report(periodic_runs.with_planted_period(table(spark, sf_dir, "documents")))


_EXACT_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM t JOIN g USING (body)"""


@query("op13_exact_dedup", _EXACT_SQL)
def op13(spark, sf_dir):
    return content_sort.groups(table(spark, sf_dir, "documents"), keep="largest")
