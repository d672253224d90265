"""Branch and bound over score limits against the product of whole accounts."""

import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from cadenza.functions.amounts import amount_difference_sql
from cadenza.functions.dates import date_difference_sql
from cadenza.functions.text import char_grams_sql, gram_distance_sql
from cadenza.models.pipelines import Settings, fit_is_next, score_line, scored
from cadenza.operators.positions import best_match
from cadenza.plans import detection
from cadenza.plans.matching import ScoreLimits

START = date(2024, 1, 1)
TX = "user_id string, account_id string, transaction_id string, date date, signed_amount double, description string"
MEANS = (1.5, 0.4)


def fixture(spark, n=260):
    rng = random.Random(2)
    amount = lambda: rng.choice([None, 0.0, *(rng.uniform(-80, 80) for _ in range(15)), float(rng.randint(1, 9)), 10 ** rng.uniform(-2, 4)])
    day = lambda: START + timedelta(days=rng.randrange(90))
    text = lambda: rng.choice(["rent flat", "rent", "gym club", "", None])
    account = lambda: ("u", rng.choice("aaab"))
    rows = [(*account(), str(i), day() if i % 40 else None, amount(), text()) for i in range(n)]
    open_ = [(f"p{i}", *account(), f"c{i}", day(), text(), day(), amount(), [], []) for i in range(n)]
    return spark.createDataFrame(rows, TX), spark.createDataFrame(open_, detection.UPCOMING)


def score(limits):
    grams = [char_grams_sql(f"coalesce({c}, '')") for c in ("description", "predicted_description")]
    amount = amount_difference_sql("signed_amount", "predicted_signed_amount")
    days = date_difference_sql("date", "predicted_date")
    return F.expr(
        f"{limits.origin}D + {limits.amount}D * coalesce({amount}, {MEANS[0]}D) + {limits.date}D * {days}"
        f" + {limits.text}D * coalesce({gram_distance_sql(*grams)}, {MEANS[1]}D)"
    )


@pytest.mark.parametrize(
    "limits",
    [
        ScoreLimits(-2.0, -0.8, 0.08, -1.0, 1.0),  # far dates score high
        ScoreLimits(-1.0, 0.4, -0.05, 1.0, 1.0),  # unlike amounts and texts do
        ScoreLimits(0.0, -0.5, -0.2, -0.5, -9.0),  # all as usual, and nearly all pass
        ScoreLimits(0.0, 0.3, 0.01, 0.5, 3.0),
    ],
)
def test_best_matches_are_those_of_the_whole_account(spark, limits):
    rows, latest = fixture(spark)

    def best(candidates):
        pairs = candidates.withColumn("p", score(limits))
        found = best_match(pairs, "p", limits.least, detection.TRANSACTION, ["previous_date", "p"])
        return sorted(map(str, found.collect())), pairs.count()

    wanted, product = best(detection.candidates(rows, latest, None))
    found, built = best(detection.candidates(rows, latest, None, None, limits))
    assert wanted and found == wanted
    assert built < product / 2


def test_limits_of_a_fitted_model(spark):
    """Trained on pairs whose true ones lie far apart, so that the date has the other sign."""
    rng = random.Random(3)
    pairs = []
    for i in range(300):
        hit = i % 2
        gap = rng.randrange(20, 40) if hit else rng.randrange(25)
        pairs.append((f"{i}", START, START + timedelta(days=gap), 10.0, 10.0 + (0 if hit else rng.random() * 9), "gym", "gym" if rng.random() < 0.6 else "shop", hit))
    schema = "transaction_id string, date date, predicted_date date, signed_amount double, predicted_signed_amount double, description string, predicted_description string, has_cycle int"
    data = spark.createDataFrame(pairs, schema)
    model = fit_is_next(data, Settings())
    limits = ScoreLimits.passing(*score_line(model), 0.9)
    assert limits.date > 0 and limits.least == pytest.approx(math.log(9))
    both = scored(model, data.withColumn("line", score(limits)), "p").select("p", "line").collect()
    assert all(r.p == pytest.approx(1 / (1 + math.exp(-r.line)), abs=1e-9) for r in both)
