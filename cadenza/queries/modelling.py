"""Registered queries: windows, state, life cycle, models, replay, stream."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cadenza.fixed import EARLY_STOPPING_ROUNDS, METRIC_FLOORS
from cadenza.models import boosting, pipelines
from cadenza.models.pipelines import CycleModels, Settings
from cadenza.operators import positions, sampling
from cadenza.plans import detection, lifecycle, replay
from cadenza.plans.windows import window_map
from cadenza.queries.training import TX_SQL
from cadenza.session import at_once, cut, work_path
from cadenza.sources import adapters as A
from cadenza.streaming.live import LiveDetection

# --- windows --------------------------------------------------------------------


def window_assignment(spark, sf_dir):
    orders = A.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    return window_map(orders)


WINDOW_SQL = """
with recursive d as (select distinct cast(o_orderdate as date) as date from orders),
w as (
  select min(date) as window_start from d
  union all
  select (select min(d.date) from d where d.date > w.window_start + interval 4 day) from w
  where w.window_start is not null)
select date, (select max(window_start) from w where window_start <= date) as window_start from d"""


def window_assignment_account(spark, sf_dir):
    orders = A.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("account"), F.col("o_orderdate").cast("date").alias("date")
    )
    return window_map(orders, by=["account"])


WINDOW_ACCOUNT_SQL = """
with recursive d as (select distinct o_custkey as account, cast(o_orderdate as date) as date from orders),
w as (
  select account, min(date) as window_start from d group by account
  union all
  select w.account, min(d.date) from w join d on w.account = d.account and d.date > w.window_start + interval 4 day
  group by w.account, w.window_start)
select d.account, d.date, max(w.window_start) as window_start
from d join w on d.account = w.account and w.window_start <= d.date group by 1, 2"""


# --- state ------------------------------------------------------------------------


def _event_upcoming(spark, sf_dir):
    return upcoming_of(A.table(spark, sf_dir, "events"))


def upcoming_of(events):
    """Every event as a prediction of its user's event type, a week ahead."""
    return events.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("user_id").cast("string").alias("account_id"),
        F.concat_ws("/", F.col("user_id"), F.col("event_type")).alias("cycle_id"),
        F.col("ts").cast("date").alias("date"),
        F.col("event_type").alias("predicted_description"),
        F.date_add(F.col("ts").cast("date"), 7).alias("predicted_date"),
        F.col("value").alias("predicted_signed_amount"),
        F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.date_add(F.col("ts").cast("date"), i * 7)).alias(
            "predicted_next_dates"
        ),
        F.array_repeat("value", 4).alias("predicted_next_amounts"),
    )


_UPCOMING_SQL = """
  upcoming as (
    select cast(event_id as varchar) as transaction_id, cast(user_id as varchar) as user_id,
           cast(user_id as varchar) as account_id, user_id || '/' || event_type as cycle_id, cast(ts as date) as date,
           event_type as predicted_description, cast(cast(ts as date) + interval 7 day as date) as predicted_date,
           value as predicted_signed_amount
    from events),
  latest as (
    select * from upcoming
    qualify row_number() over (partition by user_id, account_id, cycle_id
                               order by predicted_date desc, date desc, transaction_id desc) = 1)"""


def latest_upcoming(spark, sf_dir):
    """Orders of a customer beside the latest prediction of each open cycle."""
    latest = positions.latest_per_cycle(_event_upcoming(spark, sf_dir))
    orders = A.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_custkey").cast("string").alias("account_id"),
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("signed_amount"),
        F.col("o_orderpriority").alias("description"),
    )
    return detection.candidates(orders, latest, None).select(
        "user_id", "account_id", "transaction_id", "cycle_id", "predicted_date", "previous_date", "predicted_signed_amount"
    )


LATEST_SQL = f"""
with {_UPCOMING_SQL}
select user_id, account_id, cast(o_orderkey as varchar) as transaction_id, cycle_id, predicted_date,
       date as previous_date, predicted_signed_amount
from latest join orders on cast(o_custkey as varchar) = user_id"""


def near_upcoming(spark, sf_dir):
    """Events beside predictions at most three days away."""
    latest = positions.latest_per_cycle(_event_upcoming(spark, sf_dir))
    rows = A.labelled_events(spark, sf_dir)
    return detection.candidates(rows, latest, 3).select("user_id", "transaction_id", "date", "cycle_id", "predicted_date")


NEAR_SQL = f"""
with {_UPCOMING_SQL}
select l.user_id, cast(event_id as varchar) as transaction_id, cast(ts as date) as date, cycle_id, predicted_date
from latest l join events e on cast(e.user_id as varchar) = l.user_id
where abs(date_diff('day', cast(ts as date), predicted_date)) <= 3"""


def resolution(spark, sf_dir):
    """A given match and a given score: the match decides."""
    lines = A.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("account_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        (F.col("l_discount") * 10).alias("has_cycle_probability"),
        F.col("l_tax").alias("tax"),
        F.col("l_shipdate").cast("date").alias("day"),
    )
    matches = (
        lines.where("tax > 0.06")
        .groupBy("user_id", "account_id", "transaction_id")
        .agg(F.max("day").alias("previous_date"))
        .withColumn("cycle_id", F.concat(F.lit("known-"), "user_id"))
    )
    return detection.resolve(lines.select("user_id", "account_id", "transaction_id", "has_cycle_probability"), matches).select(
        "user_id", "account_id", "transaction_id", "previous_date", "cycle_id"
    )


RESOLUTION_SQL = """
with lines as (
  select cast(l_suppkey as varchar) as user_id, cast(l_partkey as varchar) as account_id,
         l_orderkey || '-' || l_linenumber as transaction_id, l_discount * 10 as score, l_tax, cast(l_shipdate as date) as day
  from lineitem),
matches as (
  select user_id, account_id, transaction_id, max(day) as previous_date from lines where l_tax > 0.06 group by 1, 2, 3)
select user_id, account_id, transaction_id, previous_date,
       case when previous_date is not null then 'known-' || user_id
            else sha256(user_id || '|' || account_id || '|' || transaction_id || '|new') end as cycle_id
from lines left join matches using (user_id, account_id, transaction_id)
where previous_date is not null or score > 0.85"""


# --- life cycle -------------------------------------------------------------------


def within_28_days(spark, sf_dir):
    steps = lifecycle.within_horizon(_event_upcoming(spark, sf_dir), "2024-01-10")
    return steps.select("transaction_id", "cycle_id", "upcoming_date", "upcoming_amount")


WITHIN_SQL = f"""
with {_UPCOMING_SQL}
select transaction_id, cycle_id, cast(date + to_days(cast(7 * i as integer)) as date) as upcoming_date,
       predicted_signed_amount as upcoming_amount
from upcoming, unnest(range(1, 5)) as u(i)
where date_diff('day', date '2024-01-10', cast(date + to_days(cast(7 * i as integer)) as date)) <= 28"""


def shifted_upcoming(spark, sf_dir):
    latest = positions.latest_per_cycle(_event_upcoming(spark, sf_dir))
    return lifecycle.shifted(latest, "2024-02-03").select(
        "user_id", "account_id", "cycle_id", "predicted_date", "days_late", "sent_date", "status"
    )


SHIFTED_SQL = f"""
with {_UPCOMING_SQL},
late as (select *, date_diff('day', predicted_date, date '2024-02-03') as late from latest)
select user_id, account_id, cycle_id, predicted_date, cast(greatest(late, 0) as integer) as days_late,
       case when late <= 0 then predicted_date when late <= 3 then date '2024-02-03' end as sent_date,
       case when late > 3 then 'model_deleted' else 'active' end as status
from late"""


def feedback_of(events):
    """Every event as feedback: small values delete the cycle, large ones confirm it, others only
    say that it was seen.  Feedback of signups is about a cycle that nothing predicts."""
    cycle = F.when(F.col("event_type") == "signup", "manual").otherwise(F.col("event_type"))
    return events.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("user_id").cast("string").alias("account_id"),
        F.concat_ws("/", F.col("user_id"), cycle).alias("cycle_id"),
        F.col("ts").alias("at"),
        "event_id",
        F.when(F.col("value") > 20, "confirm").when(F.col("value") < 5, "delete").otherwise("seen").alias("kind"),
        F.col("ts").cast("date").alias("date"),
        F.col("value").alias("signed_amount"),
        F.col("event_type").alias("description"),
        F.lit(30).alias("period_days"),
    )


def feedback_state(spark, sf_dir):
    """Predictions beside the feedback that came about them."""
    feedback = feedback_of(A.table(spark, sf_dir, "events"))
    feedback = feedback.withColumn("at", F.struct("at", "event_id"))
    return lifecycle.with_feedback(positions.latest_per_cycle(_event_upcoming(spark, sf_dir)), feedback)


FEEDBACK_SQL = f"""
with {_UPCOMING_SQL},
feedback as (
  select cast(user_id as varchar) as user_id, cast(user_id as varchar) as account_id,
         user_id || '/' || case when event_type = 'signup' then 'manual' else event_type end as cycle_id,
         case when value > 20 then 'confirm' when value < 5 then 'delete' else 'seen' end as kind,
         cast(ts as date) as f_date, value as f_amount, event_type as f_description
  from events
  qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1)
select user_id, account_id, cycle_id,
       case when kind = 'confirm' then f_date else date end as date,
       case when kind = 'confirm' then cast(f_date + interval 30 day as date) else predicted_date end as predicted_date,
       case when kind = 'confirm' then f_amount else predicted_signed_amount end as predicted_signed_amount,
       case when kind = 'confirm' then f_description else predicted_description end as predicted_description,
       case when kind = 'delete' then 'user_deleted' when kind = 'confirm' then 'manual' else 'active' end as status
from latest full outer join feedback using (user_id, account_id, cycle_id)
where kind = 'confirm' or predicted_date is not null"""


def retroactive_repair(spark, sf_dir):
    """The model's output is played by the events of value above 10."""
    tx = cut(A.labelled_events(spark, sf_dir))
    known = tx.where(F.col("signed_amount") > 10)
    return lifecycle.retroactive_repair(tx, known)


REPAIR_SQL = f"""
with recursive {TX_SQL},
g as (
  select user_id, account_id, cycle_id, count(*) as n_transactions, min(date) as first_date, max(date) as last_date,
         bool_or(signed_amount > 10) as known
  from tx where cycle_id is not null group by 1, 2, 3)
select user_id, account_id, cycle_id, n_transactions, first_date, last_date, true as has_cycle,
       round(date_diff('day', first_date, last_date) / (n_transactions - 1), 6) as average_days_between_transactions
from g where not known"""

# --- evaluation of given results ----------------------------------------------------


def _given_replay(spark, sf_dir):
    """Labelled events with a made-up detector: weekly anchored per event type, with a cycle for
    all but small amounts."""
    tx = cut(A.labelled_events(spark, sf_dir))
    cycle = F.when(F.col("predicted_signed_amount") > 5, F.col("cycle_id"))
    return replay.enrich(tx, _event_upcoming(spark, sf_dir).withColumn("cycle_id", cycle))


def replay_enriched(spark, sf_dir):
    return _given_replay(spark, sf_dir).select(
        "user_id", "transaction_id", "true_cycle_id", "cycle_id", "predicted_date", "predicted_signed_amount",
        "nth_in_cycle", "new_cycle", "next_in_cycle", "predicted_nth_in_cycle", "predicted_new_cycle",
        "predicted_next_in_cycle",
    )


_GIVEN_SQL = f"""{TX_SQL},
{_UPCOMING_SQL},
  joined as (
    select t.user_id, t.account_id, t.transaction_id, t.date, t.cycle_id as true_cycle_id,
           case when u.predicted_signed_amount > 5 then u.cycle_id end as cycle_id, u.predicted_date, u.predicted_signed_amount
    from tx t left join upcoming u using (user_id, account_id, transaction_id)),
  enriched as (
    select *, cast(case when true_cycle_id is not null then row_number() over a end as integer) as nth_in_cycle,
           coalesce(true_cycle_id is not null and row_number() over a = 1, false) as new_cycle,
           coalesce(true_cycle_id is not null and row_number() over a > 1, false) as next_in_cycle,
           cast(case when cycle_id is not null then row_number() over b end as integer) as predicted_nth_in_cycle,
           coalesce(cycle_id is not null and row_number() over b = 1, false) as predicted_new_cycle,
           coalesce(cycle_id is not null and row_number() over b > 1, false) as predicted_next_in_cycle
    from joined
    window a as (partition by user_id, account_id, true_cycle_id order by date, transaction_id),
           b as (partition by user_id, account_id, cycle_id order by date, transaction_id))"""
ENRICHED_SQL = f"""
with recursive {_GIVEN_SQL}
select user_id, transaction_id, true_cycle_id, cycle_id, predicted_date, predicted_signed_amount, nth_in_cycle,
       new_cycle, next_in_cycle, predicted_nth_in_cycle, predicted_new_cycle, predicted_next_in_cycle
from enriched"""


def given_replay_metrics(spark, sf_dir):
    row = replay.replay_metrics(cut(_given_replay(spark, sf_dir)))
    return row.select(*[F.round(c, 9).alias(c) for c in row.columns])


def _pr_sql(name, y, p, source):
    return (
        f"(select round(count(*) filter ({y} and {p}) / count(*) filter ({p}), 9) as precision_{name},"
        f" round(count(*) filter ({y} and {p}) / count(*) filter ({y}), 9) as recall_{name} from {source})"
    )


_METRICS_CTE = f"""{_GIVEN_SQL},
opened as (
  select * from enriched where true_cycle_id in (
    select true_cycle_id from enriched where new_cycle and predicted_new_cycle)),
metrics as (
  select * from {_pr_sql('overall', 'true_cycle_id is not null', 'cycle_id is not null', 'enriched')},
  {_pr_sql('first', 'new_cycle', 'predicted_new_cycle', 'enriched')},
  {_pr_sql('subsequent', 'next_in_cycle', 'predicted_next_in_cycle', 'opened')})"""
GIVEN_METRICS_SQL = f"with recursive {_METRICS_CTE} select * from metrics"


def release_gate(spark, sf_dir):
    return replay.gate(given_replay_metrics(spark, sf_dir))


GATE_SQL = f"""
with recursive {_METRICS_CTE},
lines as (
  {' union all '.join(f"select '{n}' as metric, {n} as value, cast({f} as double) as floor from metrics" for n, f in METRIC_FLOORS.items())})
select metric, value, floor, coalesce(value > floor, false) as passed from lines"""

# --- prediction with given rules in the models' place ---------------------------------


def rule_models() -> CycleModels:
    """Plain rules as the three models, so that SQL can follow every step: a match is at most
    two days off, and the more words of both descriptions are common, the better."""

    def is_next(df):
        gap = F.abs(F.date_diff("date", "predicted_date"))
        money = F.least(F.abs(F.col("signed_amount") - F.col("predicted_signed_amount")), F.lit(10.0))
        one, other = F.split("description", " "), F.split("predicted_description", " ")
        alike = F.size(F.array_intersect(one, other)) / F.size(F.array_union(one, other))
        score = F.lit(0.95) + F.lit(0.04) * alike - F.lit(0.004) * gap - F.lit(0.0004) * money
        return df.withColumn("is_next_probability", F.when((alike >= 0.3) & (gap <= 2), score).otherwise(F.lit(0.0)))

    return CycleModels(
        has_cycle=lambda df: df.withColumn(
            "has_cycle_probability", F.when(F.col("signed_amount") > 10, F.lit(0.9)).otherwise(F.lit(0.1))
        ),
        is_next=is_next,
        next_days=lambda df: df.withColumn(
            "predicted_days", F.when(F.col("previous_date").isNull(), F.lit(7.6)).otherwise(F.lit(6.9))
        ),
        widest_gap=2,
    )


def event_transactions(events):
    return events.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("user_id").cast("string").alias("account_id"),
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("ts").cast("date").alias("date"),
        F.col("value").alias("signed_amount"),
        F.concat_ws(" ", "event_type", "props").alias("description"),
    )


def flat(upcoming):
    """Dates as one text, and amounts as one of whole cents."""
    cents = F.transform("predicted_next_amounts", lambda a: F.round(a * 100).cast("long").cast("string"))
    return detection.formatted(upcoming).withColumns(
        {
            "predicted_next_dates": F.array_join("predicted_next_dates", ","),
            "predicted_next_amounts": F.array_join(cents, ","),
        }
    )


def predict_by_rules(spark, sf_dir):
    return flat(detection.predict(event_transactions(A.table(spark, sf_dir, "events")), rule_models()))


def _stream_of_events(spark, sf_dir):
    source = spark.readStream.schema(A.table(spark, sf_dir, "events").schema)
    return event_transactions(source.option("pathGlobFilter", "events.parquet").parquet(sf_dir))


def stream_by_rules(spark, sf_dir):
    live = LiveDetection(rule_models(), work_path(spark, "live"))
    live.start(_stream_of_events(spark, sf_dir)).awaitTermination()
    live.finish(spark)
    return flat(live.upcoming(spark))


RULES_SQL = """
with recursive tx as (
  select cast(user_id as varchar) as user_id, cast(event_id as varchar) as transaction_id, cast(ts as date) as date,
         value as signed_amount, event_type || ' ' || props as description,
         list_distinct(string_split(event_type || ' ' || props, ' ')) as words from events),
w as (
  select 1 as n, min(date) as opens from tx
  union all
  select n + 1, (select min(date) from tx where date > w.opens + interval 4 day) from w where w.opens is not null),
folds as (
  select 0 as n, '' as user_id, '' as transaction_id, '' as cycle_id, cast(null as date) as date, cast([] as varchar[]) as words,
         '' as description, cast(null as date) as predicted_date, cast(null as double) as amount, cast(null as date) as d2
  union all
  (with known as (select * from folds),
   latest as (
     select * from known where transaction_id <> ''
     qualify row_number() over (partition by user_id, cycle_id order by predicted_date desc, date desc, transaction_id desc) = 1),
   today as (
     select tx.*, k.n from (select max(n) + 1 as n from known) k join w on w.n = k.n
     join tx on tx.date between w.opens and w.opens + interval 4 day),
   scored as (
     select t.user_id, t.transaction_id, l.cycle_id, l.date as previous, abs(date_diff('day', t.date, l.predicted_date)) as gap,
            len(list_intersect(t.words, l.words)) / (len(t.words) + len(l.words) - len(list_intersect(t.words, l.words))) as alike,
            least(abs(t.signed_amount - l.amount), 10.0::double) as money
     from today t join latest l on t.user_id = l.user_id and abs(date_diff('day', t.date, l.predicted_date)) <= 2),
   matched as (
     select *, 0.95::double + 0.04::double * alike - 0.004::double * gap - 0.0004::double * money as p from scored
     where alike >= 0.3 and p > 0.95::double
     qualify row_number() over (partition by user_id, transaction_id order by p desc, cycle_id) = 1),
   found as (
     select t.*, coalesce(m.cycle_id, case when t.signed_amount > 10
              then sha256(t.user_id || '|' || t.user_id || '|' || t.transaction_id || '|new') end) as cycle_id,
            case when m.previous is null then 7 else 6 end as step
     from today t left join matched m using (user_id, transaction_id))
   select (select max(n) + 1 from known) as n, user_id, transaction_id, cycle_id, date, words, description,
          predicted_date, amount, d2 from known
   where (select max(n) from known) < (select max(n) from w where opens is not null)
   union all
   select n, user_id, transaction_id, cycle_id, date, words, description,
          cast(date + to_days(step) as date), signed_amount, cast(date + to_days(step) as date)
   from found where cycle_id is not null))
select transaction_id, user_id, user_id as account_id, cycle_id, strftime(date, '%Y-%m-%d') as date,
       description as predicted_description, strftime(predicted_date, '%Y-%m-%d') as predicted_date,
       amount as predicted_signed_amount,
       concat_ws(',', strftime(predicted_date, '%Y-%m-%d'), strftime(predicted_date + interval 6 day, '%Y-%m-%d'),
         strftime(predicted_date + interval 12 day, '%Y-%m-%d'), strftime(predicted_date + interval 18 day, '%Y-%m-%d'))
         as predicted_next_dates,
       rtrim(repeat(cast(cast(round(amount * 100) as bigint) as varchar) || ',', 4), ',') as predicted_next_amounts
from folds where n = (select max(n) from w where opens is not null) and transaction_id <> ''"""

# --- parts of the boosted models ----------------------------------------------------


def median_leaves(spark, sf_dir):
    """Each event's distance from 10 as a residual, its type and hour as a leaf."""
    events = A.table(spark, sf_dir, "events").select(
        "event_type", F.hour("ts").alias("hour"), (F.col("value") - 10).alias("residual")
    )
    return boosting.median_leaves(events, ["event_type", "hour"], "residual")


MEDIAN_LEAVES_SQL = f"""
select event_type, cast(hour(ts) as integer) as hour,
       quantile_cont(round((value - 10) * {boosting.GRID}), 0.5) / {boosting.GRID} as value
from events where value is not null group by all"""


def newton_leaves(spark, sf_dir):
    """Purchases against even odds: gradient and curvature per user and hour, in whole numbers."""
    events = A.table(spark, sf_dir, "events").select(
        "user_id",
        F.hour("ts").alias("hour"),
        F.when(F.col("event_type") == "purchase", F.lit(1.0)).otherwise(F.lit(-1.0)).alias("g"),
        F.lit(1.0).alias("h"),
    )
    found = boosting.newton_leaves(events, ["user_id", "hour"], "g", "h", 0.5, 0.25)
    return found.withColumn("value", F.round("value", 9))


NEWTON_LEAVES_SQL = """
select user_id, cast(hour(ts) as integer) as hour,
       round(case when sum(s) > 0.5 then sum(s) - 0.5 when sum(s) < -0.5 then sum(s) + 0.5 else 0.0 end::double
         / (count(*) + 0.25), 9) as value
from (select *, case when event_type = 'purchase' then 1 else -1 end as s from events) group by all"""


def early_stopping(spark, sf_dir):
    """Hourly mean values of each user's events as the losses of rounds."""
    hours = A.table(spark, sf_dir, "events").groupBy("user_id", F.unix_timestamp(F.date_trunc("hour", "ts")).alias("at")).agg(
        F.round(F.avg("value"), 6).alias("loss")
    )
    order = Window.partitionBy("user_id").orderBy("at")
    losses = hours.select("user_id", "loss", (F.row_number().over(order) - 1).alias("round"))
    return boosting.kept_rounds(losses, ["user_id"])


EARLY_STOPPING_SQL = f"""
with hours as (select user_id, date_trunc('hour', ts) as hour_start, round(avg(value), 6) as loss from events group by all),
  losses as (select user_id, loss, cast(row_number() over (partition by user_id order by hour_start) - 1 as integer) as round from hours),
  bests as (
    select a.user_id, a.round, min(b.loss) as least, arg_min(b.round, (b.loss, b.round)) filter (b.loss is not null) as best
    from losses a join losses b on a.user_id = b.user_id and b.round <= a.round group by all),
  ends as (
    select user_id, coalesce(min(round) filter (round - best >= {EARLY_STOPPING_ROUNDS}), max(round)) as round
    from bests group by user_id)
select user_id, best as kept, least as loss from bests join ends using (user_id, round)"""

# --- fitted models ------------------------------------------------------------------

_FITTED: dict = {}


def _once(spark, sf_dir, name, make):
    """What ``make`` gives, once per session, input and name."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _FITTED:
        _FITTED[key] = make()
    return _FITTED[key]


def _parts(spark, sf_dir):
    """The events with given cycles, and the parts of their users."""

    def make():
        tx = cut(sampling.split_by_user(A.events_with_given_cycles(spark, sf_dir)))
        parts = {p: tx.where(F.col("part") == p).drop("part") for p in ("train", "validation", "test")}
        return tx.drop("part"), parts

    return _once(spark, sf_dir, "parts", make)


def _model(spark, sf_dir, name):
    """One model fitted on the train users; with another one only where it needs that."""
    _, parts = _parts(spark, sf_dir)
    train, validation, settings = parts["train"], parts["validation"], Settings()
    fits = {
        "has_cycle": lambda: pipelines.has_cycle_of(train, validation, settings)[0],
        "next_date": lambda: pipelines.next_date_of(train, validation, settings)[0],
        "is_next": lambda: pipelines.is_next_of(train, _model(spark, sf_dir, "next_date"), settings),
    }
    return _once(spark, sf_dir, name, fits[name])


def _fitted(spark, sf_dir):
    """The rows, their parts and all three models, of which two have nothing to do with has-cycle."""
    rows = _parts(spark, sf_dir)
    at_once(spark, lambda: _model(spark, sf_dir, "has_cycle"), lambda: _model(spark, sf_dir, "is_next"))
    names = ("has_cycle", "next_date", "is_next")
    return *rows, CycleModels.of({name: _model(spark, sf_dir, name) for name in names})


def has_cycle_model(spark, sf_dir):
    model = _model(spark, sf_dir, "has_cycle")
    test = _parts(spark, sf_dir)[1]["test"]
    return pipelines.has_cycle_report(test, lambda df: pipelines.scored(model, df, "has_cycle_probability"))


def next_date_model(spark, sf_dir):
    model = _model(spark, sf_dir, "next_date")
    return pipelines.next_date_error(_parts(spark, sf_dir)[1]["test"], lambda df: pipelines.regressed(model, df))


def is_next_model(spark, sf_dir):
    days, model = _model(spark, sf_dir, "next_date"), _model(spark, sf_dir, "is_next")
    return pipelines.is_next_report(
        _parts(spark, sf_dir)[1]["test"],
        lambda df: pipelines.scored(model, df, "is_next_probability"),
        lambda df: pipelines.regressed(days, df),
    )


def predict_upcoming(spark, sf_dir):
    tx, _, models = _fitted(spark, sf_dir)
    return detection.formatted(detection.predict(tx, models))


def replay_metrics(spark, sf_dir):
    _, parts, models = _fitted(spark, sf_dir)
    return replay.replay_metrics(replay.replay(parts["test"], models))


def replay_reports(spark, sf_dir):
    _, parts, models = _fitted(spark, sf_dir)
    return replay.replay_reports(replay.replay(parts["test"], models))


def predict_stream(spark, sf_dir):
    """The events as a stream, with the same result as the batch run."""
    _, _, models = _fitted(spark, sf_dir)
    live = LiveDetection(models, work_path(spark, "live"))
    live.start(_stream_of_events(spark, sf_dir)).awaitTermination()
    live.finish(spark)
    return detection.formatted(live.upcoming(spark))


QUERIES = {
    "window_assignment": (window_assignment, WINDOW_SQL),
    "window_assignment_account": (window_assignment_account, WINDOW_ACCOUNT_SQL),
    "latest_upcoming": (latest_upcoming, LATEST_SQL),
    "near_upcoming": (near_upcoming, NEAR_SQL),
    "resolution": (resolution, RESOLUTION_SQL),
    "within_28_days": (within_28_days, WITHIN_SQL),
    "shifted_upcoming": (shifted_upcoming, SHIFTED_SQL),
    "feedback_state": (feedback_state, FEEDBACK_SQL),
    "retroactive_repair": (retroactive_repair, REPAIR_SQL),
    "replay_enriched": (replay_enriched, ENRICHED_SQL),
    "given_replay_metrics": (given_replay_metrics, GIVEN_METRICS_SQL),
    "release_gate": (release_gate, GATE_SQL),
    "predict_by_rules": (predict_by_rules, RULES_SQL),
    "stream_by_rules": (stream_by_rules, RULES_SQL),
    "median_leaves": (median_leaves, MEDIAN_LEAVES_SQL),
    "newton_leaves": (newton_leaves, NEWTON_LEAVES_SQL),
    "early_stopping": (early_stopping, EARLY_STOPPING_SQL),
    "has_cycle_model": (has_cycle_model, None),
    "next_date_model": (next_date_model, None),
    "is_next_model": (is_next_model, None),
    "predict_upcoming": (predict_upcoming, None),
    "replay_metrics": (replay_metrics, None),
    "replay_reports": (replay_reports, None),
    "predict_stream": (predict_stream, None),
}
