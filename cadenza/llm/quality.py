"""Quality rules: robust multivariate outliers, in DataFrame and SQL functions only.

Each text is measured (words, word characters, symbols, repeated lines, words in
repeated three-word windows).  The measures become five log-scaled integers, and per
language and source the minimum covariance determinant is sought: from a start by
medians and median deviations, concentration steps keep the half of the documents
nearest by Mahalanobis distance and take mean and covariance anew from it.  A document
whose final distance lies beyond ``CUTOFF`` is rejected, as is one that fails the base
rules (fewer than 50 words; more than half of its words in repeated windows).

Every step is two aggregations with map-side sums: exact integer moments per group, and
counts per group and distance bin, from which the half is cut.  A hot source so costs
one row per task and bin, and results do not depend on the order of rows.  Per group at
most `BINS` rows are windowed.  Groups under ``LEAST_ROWS`` are pooled by language;
a pool still smaller is judged by the base rules alone.  ``FLOORS`` are least standard
deviations, so that a group of copies does not make its neighbours outliers.

Null texts have no words and fail; null languages and sources count as empty strings.
Repeated rows are measured and counted each.  An empty table gives an empty result.
Three-word windows are compared by 64-bit hashes within a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.session import cut

WHITE = " \t\n\u000b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
#: Steps of a feature per unit of its logarithm.
SCALE = 200
#: Least standard deviation of each feature, in steps: words, mean word length,
#: symbols, repeated lines, words in repeated windows.
FLOORS = (200, 14, 100, 100, 200)
DIMS = len(FLOORS)
LEAST_ROWS = 50
STEPS = 3
#: Distances are counted in sixteenths, up to 256.
BINS = 4096
#: Of chi-squared with five degrees of freedom: the median, and what one in 100,000 exceeds.
MEDIAN, CUTOFF = 4.351, 30.856

X = [f"x{j}" for j in range(1, DIMS + 1)]
PAIRS = [(j, k) for j in range(1, DIMS + 1) for k in range(1, j + 1)]


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column) -> Column:
    """Words covered by three-word windows that occur twice or more."""
    n = F.size(words)

    def covered(hashes: Column) -> Column:
        places = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(sorted_: Column) -> Column:
            last = F.size(sorted_) - 1
            same = F.transform(
                sorted_,
                lambda e, i: F.when(
                    ((i > 0) & (F.get(sorted_, i - 1)["h"] == e["h"])) | ((i < last) & (F.get(sorted_, i + 1)["h"] == e["h"])), e["i"]
                ),
            )
            return F.aggregate(
                F.sort_array(F.filter(same, lambda i: i.isNotNull())),
                F.struct(F.lit(0).alias("total"), F.lit(-3).alias("before")),
                lambda acc, i: F.struct((acc["total"] + F.least(F.lit(3), i - acc["before"])).alias("total"), i.alias("before")),
                lambda acc: acc["total"],
            )

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(places, repeated))

    def windows(hashed: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(hashed, i), F.get(hashed, i + 1), F.get(hashed, i + 2)))

    whole = let(let(F.transform(words, lambda w: F.xxhash64(w)), windows), covered)
    return F.when(n < 3, 0).otherwise(whole).cast("long")


def measures(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    def measured(whole: Column, trimmed: Column, words: Column) -> Column:
        lines = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "")
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.regexp_replace(trimmed, SPACES, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(trimmed, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            let(lines, lambda v: (F.size(v) - F.size(F.array_distinct(v))).cast("long")).alias("n_dup_lines"),
            _repeated(words).alias("n_repeat_words"),
        )

    def split(whole: Column, trimmed: Column) -> Column:
        words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))
        return let(words, lambda w: measured(whole, trimmed, w))

    return let(F.coalesce(text, F.lit("")), lambda whole: let(F.btrim(whole, F.lit(WHITE)), lambda trimmed: split(whole, trimmed)))


#: The features, in terms of the measures; texts without words never get here.
FEATURES = [
    f"CAST(round({SCALE} * ln(1 + n_words)) AS BIGINT) AS x1",
    f"CAST(round({SCALE} * ln(CAST(word_chars AS DOUBLE) / n_words)) AS BIGINT) AS x2",
    f"CAST(round({SCALE} * ln(1 + 100 * CAST(n_symbols AS DOUBLE) / n_words)) AS BIGINT) AS x3",
    f"CAST(round({SCALE} * ln(1 + n_dup_lines)) AS BIGINT) AS x4",
    f"CAST(round({SCALE} * ln(1 + 100 * CAST(n_repeat_words AS DOUBLE) / n_words)) AS BIGINT) AS x5",
]
BASE_FAILED = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words)"

#: Sums of a group from its rows.
MOMENTS = ["count(*) AS n"] + [f"sum({x}) AS s{j}" for j, x in enumerate(X, 1)] + [f"sum(x{j} * x{k}) AS q{j}{k}" for j, k in PAIRS]


def _estimate() -> list[str]:
    """Means and the Cholesky factor of the covariance, from a group's sums."""
    out = [f"CAST(s{j} AS DOUBLE) / n AS m{j}" for j in range(1, DIMS + 1)]
    for j, k in PAIRS:
        floor = f" + {FLOORS[j - 1] ** 2}" if j == k else ""
        out.append(f"CAST(q{j}{k} AS DOUBLE) / n - m{j} * m{k}{floor} AS c{j}{k}")
    for j in range(1, DIMS + 1):
        for k in range(1, j + 1):
            rest = "".join(f" - l{j}{i} * l{k}{i}" for i in range(1, k))
            out.append(f"sqrt(c{j}{j}{rest}) AS l{j}{j}" if j == k else f"(c{j}{k}{rest}) / l{k}{k} AS l{j}{k}")
    return out


ESTIMATE = _estimate()
PARAMETERS = [f"m{j}" for j in range(1, DIMS + 1)] + [f"l{j}{k}" for j, k in PAIRS]


def _distance() -> list[str]:
    out = []
    for j in range(1, DIMS + 1):
        rest = "".join(f" - l{j}{k} * z{k}" for k in range(1, j))
        out.append(f"(x{j} - m{j}{rest}) / l{j}{j} AS z{j}")
    return [*out, " + ".join(f"z{j} * z{j}" for j in range(1, DIMS + 1)) + " AS d2", f"CAST(floor(16 * sqrt(least(d2, CAST({(BINS // 16) ** 2} AS DOUBLE)))) AS BIGINT) AS bin"]


DISTANCE = _distance()


def _cut_at(rows: DataFrame, value: str, by: list[str], share: str) -> DataFrame:
    """Per group, the least value that reaches a share of the group's rows, and their number."""
    counts = rows.groupBy(*by, value).agg(F.count("*").alias("c"))
    keys = ", ".join(by)
    running = counts.selectExpr(*by, value, f"sum(c) OVER (PARTITION BY {keys} ORDER BY {value}) AS upto", f"sum(c) OVER (PARTITION BY {keys}) AS n")
    return running.where(f"upto >= {share}").groupBy(*by).agg(F.min(value).alias("at"), F.max("n").alias("n"))


HALF = f"floor((n + {DIMS + 1}) / 2)"
KEY = ["k1", "k2"]


def _start(rows: DataFrame) -> DataFrame:
    """Medians and median deviations as parameters of a diagonal estimate."""
    long = rows.selectExpr(*KEY, f"stack({DIMS}, " + ", ".join(f"{j}, x{j}" for j in range(1, DIMS + 1)) + ") AS (f, x)")
    centre = cut(_cut_at(long, "x", [*KEY, "f"], "n / 2").select(*KEY, "f", F.col("at").alias("centre")))
    spread = _cut_at(long.join(centre, [*KEY, "f"]).selectExpr(*KEY, "f", "abs(x - centre) AS away"), "away", [*KEY, "f"], "n / 2")
    both = spread.join(centre, [*KEY, "f"])
    sides = [F.max(F.when(F.col("f") == j, F.col(c))).alias(f"{c}{j}") for j in range(1, DIMS + 1) for c in ("centre", "at")]
    made = [f"CAST(centre{j} AS DOUBLE) AS m{j}" for j in range(1, DIMS + 1)]
    for j, k in PAIRS:
        made.append(f"greatest(CAST(1.4826 AS DOUBLE) * at{j}, CAST({FLOORS[j - 1]} AS DOUBLE)) AS l{j}{k}" if j == k else f"CAST(0 AS DOUBLE) AS l{j}{k}")
    return both.groupBy(*KEY).agg(*sides).selectExpr(*KEY, *made)


def estimates(rows: DataFrame) -> DataFrame:
    """Parameters of every group of ``rows`` (k1, k2, x1 ...), with ``scale`` for its distances."""
    found = cut(_start(rows))
    for step in range(STEPS + 1):
        seen = rows.join(found, KEY).selectExpr(*KEY, *X, *DISTANCE)
        limit = cut(_cut_at(seen, "bin", KEY, HALF))
        if step == STEPS:
            scale = f"greatest(CAST(1 AS DOUBLE), ((at + 1) / CAST(16 AS DOUBLE)) * ((at + 1) / CAST(16 AS DOUBLE)) / CAST({MEDIAN} AS DOUBLE)) AS scale"
            return found.join(limit.selectExpr(*KEY, scale), KEY)
        near = seen.join(limit.select(*KEY, "at"), KEY).where("bin <= at")
        sums = near.groupBy(*KEY).agg(*(F.expr(m) for m in MOMENTS))
        found = cut(sums.selectExpr(*KEY, *ESTIMATE).select(*KEY, *PARAMETERS))


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def judged(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", carry: list[str]) -> DataFrame:
    """The columns ``carry`` of every row, its measures, ``base_failed`` and ``kept``."""
    far, names = _distances(docs, text, lang, source, carry)
    return far.select(*(F.col(n).alias(c) for c, n in zip(carry, names, strict=True)), *MEASURES, "kept")


def kept_documents(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns, whatever their names."""
    far, names = _distances(docs, text, lang, source, docs.columns)
    return far.where("kept").select(*(F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)))


def _distances(docs: DataFrame, text: str, lang: str, source: str, carry: list[str]) -> tuple[DataFrame, list[str]]:
    """Measures and verdict of every row, and ``carry`` under the names that are returned."""
    names = [f"_c{i}" for i in range(len(carry))]
    measured = docs.select(
        *(F.col(c).alias(n) for c, n in zip(carry, names, strict=True)),
        F.coalesce(lang, F.lit("")).alias("k1"),
        F.coalesce(source, F.lit("")).alias("k2"),
        measures(F.col(text)).alias("m"),
    ).select(*names, "k1", "k2", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words")
    stats = cut(measured.withColumn("base_failed", F.expr(BASE_FAILED)))
    passed = stats.where("NOT base_failed")
    small = passed.groupBy("k1", "k2").count().where(F.col("count") < LEAST_ROWS).select("k1", "k2", F.lit(True).alias("small"))
    grouped = stats.join(cut(small), KEY, "left").withColumn("k2", F.when(F.col("small"), F.lit(None)).otherwise(F.concat(F.lit("s"), "k2"))).drop("small")
    grouped = grouped.withColumn("k2", F.coalesce("k2", F.lit("")))
    rows = cut(grouped.where("NOT base_failed").selectExpr(*KEY, *FEATURES))
    enough = rows.groupBy(*KEY).count().where(F.col("count") >= LEAST_ROWS).select(*KEY)
    found = cut(estimates(rows.join(cut(enough), KEY, "left_semi")))
    features = [f"CASE WHEN NOT base_failed THEN {value} END AS {name}" for value, name in (f.rsplit(" AS ", 1) for f in FEATURES)]
    far = grouped.join(found, KEY, "left").selectExpr(*names, *MEASURES, *PARAMETERS, "scale", *features, *DISTANCE)
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= CUTOFF * F.col("scale"), F.lit(True))
    return far.select(*names, *MEASURES, kept.alias("kept")), names
