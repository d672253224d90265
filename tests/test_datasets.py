import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from cadenza.functions.amounts import amount_difference
from cadenza.functions.dates import date_difference, date_part
from cadenza.functions.text import char_grams, gram_distance
from cadenza.operators import datasets, metrics, sampling

TX = "date date, user_id string, account_id string, transaction_id string, signed_amount double, description string, cycle_id string"


def monthly(user, months, first_id):
    """A monthly series with another transaction on each of its days."""
    other = [("corner shop", -5.0), ("bus fare", -6.0), ("books", -7.0)]
    rows = []
    for i in range(months):
        day = date(2018 + (11 + i) // 12, (11 + i) % 12 + 1, 1)
        rows.append((day, user, "acc", str((first_id + i) * 11111), -12.5, "CINEMA CLUB", "yyy"))
        text, amount = other[i % 3]
        rows.append((day, user, "acc", str(first_id + i), amount, text, None))
    return rows


def month_ahead(cycles):
    return cycles.withColumn("predicted_days", F.lit(31.0))


def test_next_date(spark):
    df = spark.createDataFrame(monthly("1", 4, 3), TX)
    rows = datasets.next_date_dataset(df).orderBy("date").collect()
    assert [r.next_date_target for r in rows] == [31, 31, 28]
    assert [r.previous_date for r in rows] == [None, date(2018, 12, 1), date(2019, 1, 1)]
    assert {r.number_of_unique_cycles for r in rows} == {1}


def test_next_date_limits(spark):
    rows = monthly("1", 4, 3) + [
        (date(2019, 1, 1), "2", "a", "q1", -2000.0, "x", "z"),
        (date(2019, 2, 1), "2", "a", "q2", -5.0, "x", "z"),
        (date(2019, 8, 1), "2", "a", "q3", -5.0, "x", "z"),
    ]
    many = [
        (date(2019, 1, d), "3", "a", f"m{c}{d}", -5.0, "x", f"c{c}") for c in range(30) for d in (1, 8)
    ]
    users = {r.user_id for r in datasets.next_date_dataset(spark.createDataFrame(rows + many, TX)).collect()}
    assert users == {"1"}
    users = {r.user_id for r in datasets.next_date_dataset(spark.createDataFrame(rows + many[2:], TX)).collect()}
    assert users == {"1", "3"}


def test_is_next_golden(spark):
    df = spark.createDataFrame(monthly("11111", 6, 3), TX)
    got = sorted(
        (r.has_cycle, r.date.isoformat(), r.transaction_id, r.signed_amount, r.description, r.predicted_date.isoformat(), r.predicted_signed_amount, r.predicted_description)
        for r in datasets.is_next_dataset(df, month_ahead).collect()
    )
    dates = ["2019-01-01", "2019-02-01", "2019-03-01", "2019-04-01"]
    ahead = ["2019-01-01", "2019-02-01", "2019-03-04", "2019-04-01"]
    positive = [(1, d, str((4 + i) * 11111), -12.5, "CINEMA CLUB", p, -12.5, "CINEMA CLUB") for i, (d, p) in enumerate(zip(dates, ahead))]
    texts = [("bus fare", -6.0), ("books", -7.0), ("corner shop", -5.0), ("bus fare", -6.0)]
    negative = [(0, d, str(4 + i), a, t, p, -12.5, "CINEMA CLUB") for i, (d, p, (t, a)) in enumerate(zip(dates, ahead, texts))]
    assert got == sorted(positive + negative)


def test_negatives_are_all_matches_or_a_share(spark):
    import random

    rng = random.Random(1)
    rows = []
    for i in range(150):
        cycle = rng.choice(["p", "q", None, None])
        rows.append((date(2019, 1, 1 + rng.randrange(28)), rng.choice("uuuv"), "a", f"t{i}", float(i), f"d{i}", cycle))
    df = spark.createDataFrame(rows, TX)
    positives = df.where("cycle_id is not null").select(
        "*", F.col("date").alias("predicted_date"), F.col("signed_amount").alias("predicted_signed_amount"),
        F.col("description").alias("predicted_description"), F.lit(1).alias("has_cycle"),
    )
    wanted = sorted(
        (p[1], p[4], r[3])
        for p in rows if p[6]
        for r in rows
        if r[1] == p[1] and r[6] != p[6] and abs((r[0] - p[0]).days) <= 4
    )
    none = df.where("cycle_id is null")
    every = [(r.user_id, r.predicted_signed_amount, r.transaction_id) for r in datasets.negative_examples(positives, none, every=True).collect()]
    assert sorted(every) == wanted
    drawn = [(r.user_id, r.predicted_signed_amount, r.transaction_id) for r in datasets.negative_examples(positives, none).collect()]
    count = positives.count()
    assert len(drawn) == len(set(drawn)) and set(drawn) <= set(wanted)
    assert abs(len(drawn) - count) <= 0.2 * count


def test_match_counts_without_matches_being_built(spark):
    rng = random.Random(2)
    rows = []
    for i in range(200):
        cycle = rng.choice(["p", "q", None, None])
        day = None if rng.random() < 0.05 else date(2019, 1, 1 + rng.randrange(28))
        amount = None if rng.random() < 0.1 else float(i)
        rows += [(day, rng.choice(["u", "u", "v", None]), "a", f"t{i % 150}", amount, f"d{i}", cycle)] * rng.choice([1, 1, 2])
    df = spark.createDataFrame(rows, TX)
    positives = df.where("cycle_id is not null")
    pairs = [
        (p[1], r[3], r[4])
        for p in rows if p[6] and p[0]
        for r in rows
        if r[0] and r[1] and r[1] == p[1] and r[6] != p[6] and abs((r[0] - p[0]).days) <= 4
    ]
    wanted = {
        u: (sum(p[0] == u for p in pairs), len({p[1] for p in pairs if p[0] == u}), sum(p[2] or 0 for p in pairs if p[0] == u))
        for u in {p[0] for p in pairs}
    }
    counts = datasets.match_counts(positives, df.where("cycle_id is null"))
    assert {r.user_id: (r.n_matches, r.n_transactions, r.amount) for r in counts.collect()} == wanted
    assert datasets.match_counts(positives.where("user_id = 'u' and cycle_id = 'p'"), df.limit(0)).isEmpty()
    # A million positives near each other and a million other rows: 10^12 matches.
    many = spark.range(1_000_000).selectExpr("'u' as user_id", "'a' as account_id", "date'2019-01-01' as date",
        "cast(id as string) as transaction_id", "1.0D as signed_amount", "'d' as description")
    hot = datasets.match_counts(many.withColumn("cycle_id", F.lit("p")), many)
    assert hot.collect() == [("u", "a", 10**12, 1_000_000, 1e12)]


def test_split_is_disjoint_and_exact(spark):
    df = spark.range(1000).select(F.expr("cast(id % 200 as string) as user_id"), "id")
    parts = sampling.split_by_user(df)
    users = parts.select("user_id", "part").distinct().groupBy("part").count().collect()
    assert {r.part: r["count"] for r in users} == {"test": 20, "validation": 20, "train": 160}
    assert parts.groupBy("user_id").agg(F.countDistinct("part").alias("n")).where("n > 1").isEmpty()
    assert parts.count() == 1000
    assert sampling.sample_of_users(df).select("user_id").distinct().count() == 4


def test_class_balance(spark):
    df = spark.createDataFrame(monthly("1", 4, 3) + [(date(2020, 1, 1), "9", "a", f"z{i}", 1.0, "x", None) for i in range(200)], TX)
    exact = datasets.has_cycle_dataset(df, rows=6).groupBy("has_cycle").count().collect()
    assert {r.has_cycle: r["count"] for r in exact} == {0: 3, 1: 3}
    assert datasets.has_cycle_dataset(df.where("cycle_id is not null")).count() == 4


def test_features(spark):
    days = ["2018-12-01", "2018-12-10", "2019-01-01", "2019-01-10", "2019-02-01", "2019-02-10", "no date", None]
    df = spark.createDataFrame([(d,) for d in days], "date string").select(
        "date", *[date_part("date", p).alias(p) for p in ("month", "day_of_month", "day_of_week")]
    )
    got = [tuple(r)[1:] for r in df.collect()]
    assert got == [(12, 1, 5), (12, 10, 0), (1, 1, 1), (1, 10, 3), (2, 1, 4), (2, 10, 6), (None,) * 3, (None,) * 3]
    with pytest.raises(ValueError):
        date_part("date", "century")

    pairs = [(2, 2), (3, 2), (4, 6), (5, 10), (-6, -6), (-7, -14), (-5, -15), (-6, -3), (0, 5), (0, 0), (1, 100)]
    df = spark.createDataFrame([(float(a), float(p)) for a, p in pairs], "a double, p double")
    got = [r.x and round(r.x, 4) for r in df.select(amount_difference("a", "p").alias("x")).collect()]
    assert got == [0, 0.3333, 0.5, 1, 0, 1, 2, 0.5, 10, None, 10]

    df = spark.createDataFrame([("2019-01-01", "2019-01-04"), ("2019-01-04", "2019-01-01"), ("2019-01-01", None)], "d string, p string")
    assert [r.x for r in df.select(date_difference("d", "p").alias("x")).collect()] == [3, 3, 0]

    df = spark.createDataFrame([("CINEMA CLUB", "cinema club"), ("CINEMA CLUB", "bla"), ("x", "")], "a string, b string")
    df = df.select(char_grams("a").alias("a"), char_grams("b").alias("b")).select(gram_distance("a", "b").alias("x"))
    assert [r.x for r in df.collect()] == [0.0, 1.0, None]


def test_metrics_on_nothing(spark):
    df = spark.createDataFrame([], "y int, p int")
    assert tuple(metrics.precision_recall(df, "y", "p", "x").first()) == (None, None)
    none_found = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    assert tuple(metrics.precision_recall(none_found, "y", "p", "x").first()) == (0.0, 0.0)
