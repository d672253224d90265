"""Registered queries: streams of several micro-batches with late and shuffled rows.

The events arrive in waves.  A row comes up to ``DELAY`` days after its date, one in 37
twelve days after; a wave is a slice of arrival days.  Each wave is written to the source
folder, and the stream is started again to take it in, so every query also goes through
a restart for each wave.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.queries import modelling as M
from cadenza.session import cut, work_path
from cadenza.sources import adapters as A
from cadenza.streaming import expiry, feedback, order
from cadenza.streaming.keyed import run, written
from cadenza.streaming.live import LiveDetection

WAVES, DELAY, TOO_LATE = 3, 2, 12


def _waves(spark, sf_dir):
    """The events with the number of the wave they come in."""
    events = A.table(spark, sf_dir, "events")
    after = F.when(F.col("event_id") % 37 == 0, TOO_LATE).otherwise(F.col("event_id") % (DELAY + 1)).cast("int")
    rows = events.withColumn("arrival", F.date_add(F.col("ts").cast("date"), after))
    first, last = rows.agg(F.min("arrival"), F.max("arrival")).first()
    span = 1 if first is None else (last - first).days + 1
    return rows.withColumn("wave", F.floor(F.date_diff("arrival", F.lit(first)) * WAVES / span).cast("int")).drop("arrival")


def _arriving(spark, sf_dir, start):
    """Writes wave after wave and lets ``start`` (a function of the stream) take each in."""
    rows, source = cut(_waves(spark, sf_dir)), work_path(spark, "arrivals")
    for wave in range(WAVES):
        rows.where(F.col("wave") == wave).drop("wave").write.parquet(f"{source}/wave={wave}")
        start(spark.readStream.schema(rows.drop("wave").schema).parquet(source)).awaitTermination()


WAVES_SQL = f"""
  arrivals as (
    select *, cast(ts as date) as date,
           cast(ts as date) + cast(case when event_id % 37 = 0 then {TOO_LATE} else event_id % {DELAY + 1} end as integer) as arrival
    from events),
  waves as (
    select *, cast(floor(date_diff('day', min(arrival) over (), arrival) * {WAVES}
             / (date_diff('day', min(arrival) over (), max(arrival) over ()) + 1)) as integer) as wave from arrivals),
  reached as (
    select w.wave, (select max(date) from waves e where e.wave < w.wave) - {DELAY} as reached
    from (select unnest(range(0, {WAVES + 1})) as wave) w),
  timed as (select w.*, coalesce(date <= reached, false) as late from waves w join reached using (wave)),
  at_end as (select reached as last_reached from reached where wave = {WAVES})"""


def late_payments_stream(spark, sf_dir):
    """What is sent about predictions that no event of their cycle follows in time."""
    base = work_path(spark, "expiry")
    _arriving(spark, sf_dir, lambda stream: expiry.start(M.upcoming_of(stream), base, DELAY))
    return expiry.emitted(spark, base)


LATE_PAYMENTS_SQL = f"""
with {WAVES_SQL},
  predictions as (
    select cast(user_id as varchar) as user_id, cast(user_id as varchar) as account_id, user_id || '/' || event_type as cycle_id,
           cast(event_id as varchar) as transaction_id, date, date + 7 as predicted_date, value as predicted_signed_amount, late
    from timed),
  followed as (
    select *, lead(date) over (partition by user_id, account_id, cycle_id order by date) as next_date
    from (select * from predictions where not late
          qualify row_number() over (partition by user_id, account_id, cycle_id, date order by transaction_id desc) = 1))
select user_id, account_id, cycle_id, transaction_id, date, predicted_date,
       case when k <= 3 then predicted_date + cast(k as integer) end as sent_date, predicted_signed_amount, cast(k as integer) as days_late,
       case when k <= 3 then 'active' else 'model_deleted' end as status
from followed, at_end, unnest(range(1, 5)) as u(k)
where predicted_date + cast(k as integer) <= last_reached and (next_date is null or next_date > predicted_date + cast(k as integer))
union all
select user_id, account_id, cycle_id, transaction_id, date, predicted_date, null, predicted_signed_amount, null, 'late'
from predictions where late"""


def ordered_stream(spark, sf_dir):
    """The events in order of date, as far as the watermark came, and those too late."""
    base = work_path(spark, "ordered")

    def start(stream):
        rows = stream.select(F.col("event_id").cast("string").alias("transaction_id"), "user_id", F.col("ts").cast("date").alias("date"), "value")
        return run(order.in_order(rows, ["user_id"], DELAY), base, "rows", {})

    _arriving(spark, sf_dir, start)
    rows = cut(written(spark, base, "rows", "transaction_id string, user_id long, date date, value double, late boolean"))
    # No batch hands on a date that an earlier one has already passed.
    steps = rows.where("NOT late").groupBy("batch").agg(F.min("date").alias("low"), F.max("date").alias("high"))
    broken = steps.alias("a").join(steps.alias("b"), F.expr("a.batch < b.batch AND a.high >= b.low")).limit(1).count()
    return rows.drop("batch").withColumn("in_order", F.lit(broken == 0))


ORDERED_SQL = f"""
with {WAVES_SQL}
select cast(event_id as varchar) as transaction_id, user_id, date, value, late, true as in_order
from timed, at_end where late or date <= last_reached"""


def stream_with_late_rows(spark, sf_dir):
    """A detection over all waves, then finished: what it predicts, and the rows that came too late."""
    live = LiveDetection(M.rule_models(), work_path(spark, "live"), lateness_days=DELAY - 1)
    _arriving(spark, sf_dir, lambda stream: live.start(M.event_transactions(stream)))
    live.finish(spark)
    found = M.flat(live.upcoming(spark)).withColumn("late", F.lit(False))
    late = live.late(spark).select("transaction_id", "user_id", "account_id", F.date_format("date", "yyyy-MM-dd").alias("date"), F.lit(True).alias("late"))
    return found.unionByName(late, allowMissingColumns=True)


IN_TIME_SQL = M.RULES_SQL.replace("with recursive tx as (", f"with recursive {WAVES_SQL}, tx as (", 1).replace(
    "as words from events)", "as words from timed where not late)", 1
).replace("as predicted_next_amounts\nfrom folds", "as predicted_next_amounts, false as late\nfrom folds") + """
union all
select cast(event_id as varchar), cast(user_id as varchar), cast(user_id as varchar), null, strftime(date, '%Y-%m-%d'),
       null, null, null, null, null, true
from timed where late"""


def feedback_stream(spark, sf_dir):
    """Predictions and feedback as two streams that arrive in opposite order of their waves."""
    base, source = work_path(spark, "feedback"), work_path(spark, "arrivals")
    upcoming, events = (cut(df.withColumn("_wave", F.pmod(F.xxhash64(c), F.lit(3)))) for df, c in
                        ((M.upcoming_of(A.table(spark, sf_dir, "events")), "transaction_id"), (M.feedback_of(A.table(spark, sf_dir, "events")), "event_id")))
    for wave in range(3):
        upcoming.where(F.col("_wave") == wave).drop("_wave").write.parquet(f"{source}/upcoming/wave={wave}")
        events.where(F.col("_wave") == 2 - wave).drop("_wave").write.parquet(f"{source}/feedback/wave={wave}")
        streams = (spark.readStream.schema(df.drop("_wave").schema).parquet(f"{source}/{name}") for df, name in ((upcoming, "upcoming"), (events, "feedback")))
        feedback.start(*streams, base).awaitTermination()
    return feedback.state(spark, base)


QUERIES = {
    "late_payments_stream": (late_payments_stream, LATE_PAYMENTS_SQL),
    "ordered_stream": (ordered_stream, ORDERED_SQL),
    "stream_with_late_rows": (stream_with_late_rows, IN_TIME_SQL),
    "feedback_stream": (feedback_stream, M.FEEDBACK_SQL),
}
