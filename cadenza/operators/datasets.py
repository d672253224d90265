"""Training sets of the three models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza import fixed
from cadenza.functions.dates import rounded_next_date
from cadenza.functions.keys import spread
from cadenza.operators.positions import in_cycle, unit, with_neighbour_dates
from cadenza.operators.sampling import ROW_KEY, keep_exactly, keep_fraction
from cadenza.session import cut

ACCOUNT = ["user_id", "account_id"]
IS_NEXT_COLUMNS = [
    "user_id",
    "account_id",
    "date",
    "transaction_id",
    "signed_amount",
    "description",
    "cycle_id",
    "predicted_date",
    "predicted_signed_amount",
    "predicted_description",
    "has_cycle",
]
_NUMBERING = 64


def has_cycle_dataset(df: DataFrame, rows: int | None = None, seed: int = fixed.SAMPLE_SEED) -> DataFrame:
    """Cycle rows and as many other rows.

    With ``rows`` exactly half of it from each class, else all cycle rows and a
    fraction of the others.
    """
    marked = df.withColumn("has_cycle", F.col("cycle_id").isNotNull().cast("int"))
    positive, negative = marked.where("has_cycle = 1"), marked.where("has_cycle = 0")
    if rows is not None:
        half = rows // 2
        return keep_exactly(positive, half, seed=seed).unionByName(keep_exactly(negative, half, seed=seed))
    counted = marked.agg(F.count_if(F.col("has_cycle") == 1), F.count_if(F.col("has_cycle") == 0)).first()
    fraction = min(1.0, counted[0] / counted[1]) if counted[1] else 1.0
    return positive.unionByName(keep_fraction(negative, fraction, ROW_KEY, seed))


def next_date_dataset(df: DataFrame) -> DataFrame:
    """Cycle rows with a next row, the days until it, and the usual limits."""
    rows = (
        with_neighbour_dates(df.where(F.col("cycle_id").isNotNull()))
        .where(F.col("next_date").isNotNull() & F.col("date").isNotNull())
        .withColumn("next_date_target", F.date_diff("next_date", "date"))
        .where(
            (F.col("next_date_target") > fixed.NEXT_DATE_MIN)
            & (F.col("next_date_target") < fixed.NEXT_DATE_MAX)
            & (F.col("signed_amount") > fixed.SIGNED_AMOUNT_MIN)
        )
    )
    # Two partial aggregations instead of a window over the account.
    cycles = (
        rows.groupBy(*ACCOUNT, "cycle_id")
        .agg(F.count("*"))
        .groupBy(*ACCOUNT)
        .agg(F.count("*").alias("number_of_unique_cycles"))
        .where(F.col("number_of_unique_cycles") < fixed.CYCLES_PER_ACCOUNT_MAX)
    )
    return rows.join(cycles, ACCOUNT)


def cycle_predictions(cycles: DataFrame, predict_days: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What each cycle row predicts: date, amount and description.

    ``predict_days`` adds a column ``predicted_days``.
    """
    return (
        predict_days(cycles)
        .withColumn("predicted_date", rounded_next_date("date", "predicted_days"))
        .withColumn("predicted_signed_amount", F.col("signed_amount"))
        .withColumn("predicted_description", F.col("description"))
    )


def positive_examples(predictions: DataFrame) -> DataFrame:
    """Each cycle row beside the prediction made by the row before it."""
    before = F.lag(F.struct("predicted_date", "predicted_signed_amount", "predicted_description")).over(in_cycle())
    return (
        predictions.withColumn("before", before)
        .where(F.col("before.predicted_date").isNotNull())
        .select(
            "user_id",
            "account_id",
            "date",
            "transaction_id",
            "signed_amount",
            "description",
            "cycle_id",
            F.col("before.predicted_date").alias("predicted_date"),
            F.col("before.predicted_signed_amount").alias("predicted_signed_amount"),
            F.col("before.predicted_description").alias("predicted_description"),
            F.lit(1).alias("has_cycle"),
        )
    )


def _numbered(pool: DataFrame) -> DataFrame:
    """Number the rows of an account's day 1.. by (hash slice, transaction).

    The slices keep a hot day from being numbered by one task.
    """
    day = [*ACCOUNT, "date"]
    sliced = pool.withColumn("slice", F.pmod(spread("transaction_id"), F.lit(_NUMBERING)))
    sizes = sliced.groupBy(*day, "slice").count()
    before = Window.partitionBy(*day).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*day, "slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(*day, "slice").orderBy("transaction_id", F.col("cycle_id").asc_nulls_first())
    return (
        sliced.withColumn("inside", F.row_number().over(inside))
        .join(offsets, [*day, "slice"])
        .withColumn("number", F.col("offset") + F.col("inside"))
        .drop("slice", "offset", "inside")
    )


def negative_examples(
    positives: DataFrame, non_cycles: DataFrame, *, seed: int = fixed.SAMPLE_SEED, every: bool = False
) -> DataFrame:
    """Rows dated near a cycle row but not of its cycle, beside its prediction.

    A match is a row of the same account within four days that is in no cycle,
    or a positive example of another cycle.  About as many matches as positives
    are drawn evenly; all where there are fewer (or with ``every``).

    Matches are counted from day totals and drawn by number, so that only drawn
    ones are ever built: an account with n rows in reach of m cycle rows costs
    n + m, not n * m.
    """
    day = [*ACCOUNT, "date"]
    columns = [*day, "transaction_id", "signed_amount", "description", "cycle_id"]
    pool = cut(
        _numbered(
            non_cycles.withColumn("cycle_id", F.lit(None).cast("string"))
            .select(*columns)
            .unionByName(positives.select(*columns))
        )
    )
    totals = pool.groupBy(*day).agg(F.count("*").alias("rows"))
    own = (
        pool.where(F.col("cycle_id").isNotNull())
        .groupBy(*day, "cycle_id")
        .agg(F.array_sort(F.collect_list("number")).alias("own"))
    )
    reach = fixed.MATCH_OFFSET_DAYS
    left = positives.select(
        *ACCOUNT,
        F.col("date").alias("positive_date"),
        F.col("transaction_id").alias("positive_id"),
        "cycle_id",
        "predicted_date",
        "predicted_signed_amount",
        "predicted_description",
    )
    near = (
        left.withColumn("offset", F.explode(F.sequence(F.lit(-reach), F.lit(reach))))
        .withColumn("date", F.date_add("positive_date", F.col("offset")))
        .join(totals, day)
        .join(own, [*day, "cycle_id"], "left")
        .withColumn("own", F.coalesce("own", F.array().cast("array<bigint>")))
        .withColumn("free", F.col("rows") - F.size("own"))
        .where(F.col("free") > 0)
    )
    key = [*ACCOUNT, "cycle_id", "positive_id", "positive_date"]
    per_positive = cut(
        near.groupBy(*key, "predicted_date", "predicted_signed_amount", "predicted_description").agg(
            F.array_sort(F.collect_list(F.struct("date", "free", "own"))).alias("days"),
            F.sum("free").alias("matches"),
        )
    )
    fraction = 1.0
    if not every:
        wanted = positives.count()
        available = per_positive.agg(F.sum("matches")).first()[0] or 0
        fraction = min(1.0, wanted / available) if available else 1.0

    lucky = unit(spread(*key, seed=seed))
    drawn = (
        per_positive.withColumn("draws", F.floor(F.col("matches") * F.lit(fraction) + lucky))
        .withColumn("draws", F.least("draws", "matches"))
        .where(F.col("draws") > 0)
        .withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("draws") - 1)))
        .withColumn(
            "rank",
            F.floor((F.col("k") + unit(spread(*key, "k", seed=seed))) * F.col("matches") / F.col("draws")),
        )
    )
    # The day that holds the rank, and the place inside it.
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("date").alias("date"),
                     F.lit(0).cast("bigint").alias("place"), F.array().cast("array<bigint>").alias("own"))
    found = F.aggregate(
        "days",
        start,
        lambda acc, d: F.struct(
            (acc["seen"] + d["free"]).alias("seen"),
            F.when((F.col("rank") >= acc["seen"]) & (F.col("rank") < acc["seen"] + d["free"]), d["date"])
            .otherwise(acc["date"]).alias("date"),
            F.when((F.col("rank") >= acc["seen"]) & (F.col("rank") < acc["seen"] + d["free"]), F.col("rank") - acc["seen"] + 1)
            .otherwise(acc["place"]).alias("place"),
            F.when((F.col("rank") >= acc["seen"]) & (F.col("rank") < acc["seen"] + d["free"]), d["own"])
            .otherwise(acc["own"]).alias("own"),
        ),
    )
    # Rows of the own cycle do not count, so the number skips them.
    number = F.aggregate(
        F.col("found.own"), F.col("found.place"), lambda acc, o: F.when(o <= acc, acc + 1).otherwise(acc)
    )
    picked = (
        drawn.withColumn("found", found)
        .withColumn("date", F.col("found.date"))
        .withColumn("number", number)
        .select(*day, "number", "cycle_id", "predicted_date", "predicted_signed_amount", "predicted_description")
    )
    return (
        picked.join(pool.drop("cycle_id"), [*day, "number"])
        .withColumn("has_cycle", F.lit(0))
        .select(*IS_NEXT_COLUMNS)
    )


def match_counts(positives: DataFrame, non_cycles: DataFrame) -> DataFrame:
    """Per account, what :func:`negative_examples` with ``every`` would give: the number of its
    rows, of their transactions, and the sum of their amounts.

    No match is built.  How many positives a row is matched with depends on its day and
    cycle only, so totals of days and cycles are joined to the rows once.
    """
    day = [*ACCOUNT, "date"]
    columns = [*day, "transaction_id", "signed_amount", "cycle_id"]
    pool = non_cycles.withColumn("cycle_id", F.lit(None).cast("string")).select(*columns)
    pool = pool.unionByName(positives.select(*columns))
    reach = fixed.MATCH_OFFSET_DAYS
    by_cycle = cut(
        positives.groupBy(*day, "cycle_id")
        .agg(F.count("*").alias("n"))
        .withColumn("offset", F.explode(F.sequence(F.lit(-reach), F.lit(reach))))
        .withColumn("date", F.date_add("date", F.col("offset")))
        .groupBy(*day, "cycle_id")
        .agg(F.sum("n").alias("own"))
    )
    near = by_cycle.groupBy(*day).agg(F.sum("own").alias("near"))
    times = F.col("near") - F.coalesce("own", F.lit(0))
    return (
        pool.join(near, day)
        .join(by_cycle, [*day, "cycle_id"], "left")
        .withColumn("times", times)
        .where("times > 0")
        .groupBy(*ACCOUNT)
        .agg(
            F.sum("times").alias("n_matches"),
            F.countDistinct("transaction_id").alias("n_transactions"),
            F.sum(F.col("times") * F.col("signed_amount")).alias("amount"),
        )
    )


def is_next_dataset(
    df: DataFrame, predict_days: Callable[[DataFrame], DataFrame], *, seed: int = fixed.SAMPLE_SEED
) -> DataFrame:
    """Positive and negative examples for "is this the next of that cycle"."""
    positives = cut(positive_examples(cycle_predictions(next_date_dataset(df), predict_days)))
    negatives = negative_examples(positives, df.where(F.col("cycle_id").isNull()), seed=seed)
    return positives.unionByName(negatives)


def dataset_sizes(df: DataFrame) -> DataFrame:
    """Rows per part and class, in one grouped count."""
    return df.groupBy("part", F.col("cycle_id").isNotNull().cast("int").alias("has_cycle")).agg(
        F.count("*").alias("n_rows")
    )
