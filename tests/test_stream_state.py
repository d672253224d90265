"""Keyed streams hold as many values as dates and hash slices ask for, not one per cycle or account."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from cadenza.session import work_path
from cadenza.streaming import expiry, feedback, order
from cadenza.streaming.keyed import run

ROWS = 4_000


def upcoming(spark, path):
    rows = spark.range(ROWS).select(
        F.lit("u").alias("user_id"),
        F.lit("a").alias("account_id"),
        F.concat(F.lit("c"), "id").alias("cycle_id"),
        F.col("id").cast("string").alias("transaction_id"),
        F.lit(date(2024, 3, 1)).alias("date"),
        F.lit(date(2024, 3, 8)).alias("predicted_date"),
        F.col("id").cast("double").alias("predicted_signed_amount"),
        F.lit("text").alias("predicted_description"),
    )
    rows.coalesce(1).write.parquet(f"{path}/upcoming")
    return spark.readStream.schema(rows.schema).parquet(f"{path}/upcoming")


def held(query):
    query.awaitTermination()
    return max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress)


def test_rows_of_many_accounts_wait_in_few_values(spark, tmp_path):
    rows = order.in_order(upcoming(spark, tmp_path), ["transaction_id"], 2)
    assert 0 < held(run(rows, work_path(spark, "state"), "rows", {})) < ROWS


def test_late_payments_of_many_cycles_in_few_values(spark, tmp_path):
    base = work_path(spark, "state")
    assert 0 < held(expiry.start(upcoming(spark, tmp_path), base, 2)) < ROWS


def test_feedback_of_many_cycles_in_few_values(spark, tmp_path):
    base, left = work_path(spark, "state"), upcoming(spark, tmp_path)
    events = spark.range(3).select(
        F.lit("u").alias("user_id"), F.lit("a").alias("account_id"), F.concat(F.lit("c"), "id").alias("cycle_id"),
        F.lit("2024-03-02").cast("timestamp").alias("at"), F.col("id").alias("event_id"), F.lit("confirm").alias("kind"),
        F.lit(date(2024, 3, 2)).alias("date"), F.lit(1.0).alias("signed_amount"), F.lit("f").alias("description"), F.lit(30).alias("period_days"),
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events")
    right = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/events")
    assert 0 < held(feedback.start(left, right, base)) < ROWS
    found = feedback.state(spark, base)
    assert found.count() == ROWS and found.where("status = 'manual'").count() == 3
    assert found.where("status = 'manual'").first().predicted_date == date(2024, 3, 2) + timedelta(days=30)
