"""Registered queries: splits, training sets, features and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.fixed import SAMPLE_SEED
from cadenza.functions.amounts import amount_difference
from cadenza.functions.dates import date_difference, date_part, rounded_next_date, truncated_next_date
from cadenza.operators import datasets, metrics, positions, sampling
from cadenza.queries.labelling import labels_sql
from cadenza.session import cut
from cadenza.sources import adapters as A

_EVENT_ROWS = """
  select cast(user_id as varchar) || '|' || cast(user_id as varchar) as user_account_id,
         event_type as counterparty_cluster, cast(event_id as varchar) || '|false' as transaction_pending_id,
         cast(ts as date) as date, value as signed_amount, cast(user_id as varchar) as user_id,
         cast(user_id as varchar) as account_id, cast(event_id as varchar) as transaction_id,
         event_type || ' ' || props as description
  from events"""
TX_SQL = labels_sql(_EVENT_ROWS) + ",\n  tx as (select * from with_labels)"


def hash_sql(*parts: str, seed: int | None = None) -> str:
    text = ", ".join(parts) + (f", '{seed}'" if seed is not None else "")
    return f"cast('0x' || substr(md5(concat_ws('|', {text})), 1, 15) as bigint)"


def _unit_sql(*parts: str, seed: int | None = None) -> str:
    return f"(cast({hash_sql(*parts, seed=seed)} as double) / 1152921504606846976.0::double)"


# --- splits and samples -------------------------------------------------------


def user_split(spark, sf_dir):
    orders = A.table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("user_id"))
    return (
        sampling.split_by_user(orders)
        .groupBy("part")
        .agg(F.count("*").alias("n_rows"), F.countDistinct("user_id").alias("n_users"))
    )


USER_SPLIT_SQL = f"""
with users as (select distinct cast(o_custkey as varchar) as user_id from orders),
hashed as (select user_id, {hash_sql('user_id', seed=SAMPLE_SEED)} as t, {hash_sql('user_id', seed=SAMPLE_SEED + 1)} as v from users),
tested as (
  select *, row_number() over (order by t) <= ceil(round(0.1::double * count(*) over (), 9)) as is_test from hashed),
validated as (
  select user_id, row_number() over (order by v) <= ceil(round(0.1::double / 0.9::double * count(*) over (), 9)) as is_val
  from tested where not is_test),
parts as (
  select t.user_id, case when is_test then 'test' when is_val then 'validation' else 'train' end as part
  from tested t left join validated v on t.user_id = v.user_id)
select part, count(*) as n_rows, count(distinct p.user_id) as n_users
from orders join parts p on cast(o_custkey as varchar) = p.user_id group by part"""


def split_overlap(spark, sf_dir):
    """Users found in more than one part: none."""
    orders = A.table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("user_id"))
    parts = sampling.split_by_user(orders).groupBy("user_id").agg(F.countDistinct("part").alias("parts"))
    return parts.agg(F.count("*").alias("n_users"), F.count_if(F.col("parts") > 1).alias("n_shared"))


SPLIT_OVERLAP_SQL = """
select count(distinct o_custkey) as n_users, cast(0 as bigint) as n_shared from orders"""


def _customer_sample(spark, sf_dir):
    customers = A.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("user_id"), "c_mktsegment"
    )
    return customers


def user_sample(spark, sf_dir):
    from cadenza.operators.base import sample_users

    return sample_users(_customer_sample(spark, sf_dir), 75)


USER_SAMPLE_SQL = f"""
with users as (select cast(c_custkey as varchar) as user_id, c_mktsegment from customer)
select * from users
where {hash_sql('user_id', seed=SAMPLE_SEED)} <
      (select case when count(*) <= 75 then 1152921504606846977
              else cast(floor(round(75.0::double / count(*), 4) * 1152921504606846976.0::double) as bigint) end from users)"""


def evaluation_sample(spark, sf_dir):
    """All orders of two in a hundred customers."""
    orders = A.table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("user_id"), "o_orderkey")
    return sampling.sample_of_users(orders)


EVALUATION_SAMPLE_SQL = f"""
with users as (select distinct cast(o_custkey as varchar) as user_id from orders),
chosen as (
  select user_id from users
  qualify row_number() over (order by {hash_sql('user_id', seed=SAMPLE_SEED + 2)})
          <= ceil(round(0.02::double * count(*) over (), 9)))
select cast(o_custkey as varchar) as user_id, o_orderkey
from orders where cast(o_custkey as varchar) in (select user_id from chosen)"""


def has_cycle_dataset(spark, sf_dir):
    tx = cut(A.labelled_events(spark, sf_dir))
    return datasets.has_cycle_dataset(tx).select("user_id", "account_id", "transaction_id", "date", "has_cycle")


HAS_CYCLE_SQL = f"""
with recursive {TX_SQL},
c as (select count(*) filter (cycle_id is not null) as pos, count(*) filter (cycle_id is null) as neg from tx)
select user_id, account_id, transaction_id, date, cast(cycle_id is not null as integer) as has_cycle
from tx, c
where cycle_id is not null or pos >= neg
   or {hash_sql('user_id', 'account_id', 'transaction_id', seed=SAMPLE_SEED)}
      < cast(floor(cast(pos as double) / neg * 1152921504606846976.0::double) as bigint)"""


def class_sample(spark, sf_dir):
    """The same number of rows of each class, exactly."""
    tx = cut(A.labelled_events(spark, sf_dir))
    return datasets.has_cycle_dataset(tx, rows=400).select("user_id", "account_id", "transaction_id", "has_cycle")


CLASS_SAMPLE_SQL = f"""
with recursive {TX_SQL}
select user_id, account_id, transaction_id, cast(cycle_id is not null as integer) as has_cycle
from tx
qualify row_number() over (partition by cycle_id is not null
  order by {hash_sql('user_id', 'account_id', 'transaction_id', seed=SAMPLE_SEED)}) <= 200"""


def dataset_sizes(spark, sf_dir):
    return datasets.dataset_sizes(sampling.split_by_user(cut(A.labelled_events(spark, sf_dir))))


DATASET_SIZES_SQL = f"""
with recursive {TX_SQL},
{USER_SPLIT_SQL.split('with ', 1)[1].split('select part')[0].replace('cast(o_custkey as varchar)', 'user_id').replace('from orders', 'from tx')}
select part, cast(cycle_id is not null as integer) as has_cycle, count(*) as n_rows
from tx join parts using (user_id) group by 1, 2"""


# --- data sets ------------------------------------------------------------------

_NEXT_COLUMNS = [
    "user_id",
    "account_id",
    "cycle_id",
    "transaction_id",
    "date",
    "previous_date",
    "next_date",
    "next_date_target",
    "number_of_unique_cycles",
]


def next_date_dataset(spark, sf_dir):
    return datasets.next_date_dataset(A.labelled_events(spark, sf_dir)).select(*_NEXT_COLUMNS)


_NEXT_SQL = f"""{TX_SQL},
  ordered as (
    select *, lag(date) over w as previous_date, lead(date) over w as next_date from tx where cycle_id is not null
    window w as (partition by user_id, account_id, cycle_id order by date, transaction_id)),
  targeted as (
    select *, cast(date_diff('day', date, next_date) as integer) as next_date_target from ordered
    where next_date is not null and date_diff('day', date, next_date) > 0
      and date_diff('day', date, next_date) < 100 and signed_amount > -1000),
  next_rows as (
    select t.*, n.number_of_unique_cycles from targeted t
    join (select user_id, account_id, count(distinct cycle_id) as number_of_unique_cycles
          from targeted group by 1, 2) n using (user_id, account_id)
    where number_of_unique_cycles < 30)"""
NEXT_SQL = f"with recursive {_NEXT_SQL} select {', '.join(_NEXT_COLUMNS)} from next_rows"


def _standin(cycles):
    """A fixed number of days in place of a fitted model."""
    return cycles.withColumn("predicted_days", F.lit(7.0))


def is_next_positives(spark, sf_dir):
    cycles = datasets.next_date_dataset(A.labelled_events(spark, sf_dir))
    return datasets.positive_examples(datasets.cycle_predictions(cycles, _standin))


_POSITIVES_SQL = f"""{_NEXT_SQL},
  positives as (
    select * from (
      select user_id, account_id, date, transaction_id, signed_amount, description, cycle_id,
             cast(lag(date) over w + interval 7 day as date) as predicted_date,
             lag(signed_amount) over w as predicted_signed_amount,
             lag(description) over w as predicted_description, 1 as has_cycle
      from next_rows
      window w as (partition by user_id, account_id, cycle_id order by date, transaction_id))
    where predicted_date is not null)"""
POSITIVES_SQL = f"with recursive {_POSITIVES_SQL} select * from positives"


def is_next_negatives(spark, sf_dir):
    tx = cut(A.labelled_events(spark, sf_dir))
    positives = cut(datasets.positive_examples(datasets.cycle_predictions(datasets.next_date_dataset(tx), _standin)))
    return datasets.negative_examples(positives, tx.where(F.col("cycle_id").isNull()))


_KEY = ("p.user_id", "p.account_id", "p.cycle_id", "p.transaction_id", "p.date")
_DRAW_KEY = ("user_id", "account_id", "cycle_id", "positive_id", "positive_date")
NEGATIVES_SQL = f"""
with recursive {_POSITIVES_SQL},
pool as (
  select *, row_number() over (partition by user_id, account_id, date
      order by {hash_sql('transaction_id')} % 64, transaction_id, cycle_id nulls first) as number
  from (select user_id, account_id, date, transaction_id, signed_amount, description, cast(null as varchar) as cycle_id
        from tx where cycle_id is null
        union all select user_id, account_id, date, transaction_id, signed_amount, description, cycle_id from positives)),
pairs as (
  select p.user_id, p.account_id, p.cycle_id, p.transaction_id as positive_id, p.date as positive_date,
         p.predicted_date, p.predicted_signed_amount, p.predicted_description,
         r.date, r.transaction_id, r.signed_amount, r.description,
         row_number() over (partition by {', '.join(_KEY)} order by r.date, r.number) - 1 as rank,
         count(*) over (partition by {', '.join(_KEY)}) as matches
  from positives p join pool r
    on p.user_id = r.user_id and p.account_id = r.account_id
   and r.date between p.date - interval 4 day and p.date + interval 4 day
   and r.cycle_id is distinct from p.cycle_id),
f as (select least(1.0::double, cast((select count(*) from positives) as double) / (select count(*) from pairs)) as f),
drawn as (
  select user_id, account_id, cycle_id, positive_id, positive_date, matches, draws,
         unnest(range(0, draws)) as k
  from (select distinct user_id, account_id, cycle_id, positive_id, positive_date, matches,
               least(cast(floor(matches * f + {_unit_sql(*_DRAW_KEY, seed=SAMPLE_SEED)}) as bigint), matches) as draws
        from pairs, f)
  where draws > 0),
ranks as (
  select *, cast(floor((k + {_unit_sql(*_DRAW_KEY, 'k', seed=SAMPLE_SEED)}) * matches / draws) as bigint) as rank from drawn)
select q.user_id, q.account_id, q.date, q.transaction_id, q.signed_amount, q.description, q.cycle_id,
       q.predicted_date, q.predicted_signed_amount, q.predicted_description, 0 as has_cycle
from pairs q join ranks using (user_id, account_id, cycle_id, positive_id, positive_date, rank)"""


def negative_match_counts(spark, sf_dir):
    """All matches (no draw): how many rows there are in reach, per account."""
    tx = cut(A.labelled_events(spark, sf_dir))
    positives = cut(datasets.positive_examples(datasets.cycle_predictions(datasets.next_date_dataset(tx), _standin)))
    counts = datasets.match_counts(positives, tx.where(F.col("cycle_id").isNull()))
    return counts.withColumn("amount", F.col("amount").cast("decimal(20,2)").cast("double"))


MATCH_COUNTS_SQL = f"""
{NEGATIVES_SQL.split('f as (select least')[0].rstrip().rstrip(',')}
select user_id, account_id, count(*) as n_matches, count(distinct transaction_id) as n_transactions,
       cast(cast(sum(signed_amount) as decimal(20,2)) as double) as amount
from pairs group by 1, 2"""


# --- features -------------------------------------------------------------------


def date_parts(spark, sf_dir):
    orders = A.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("date")
    )
    return orders.select(
        "o_orderkey", *[date_part("date", p).alias(p) for p in ("month", "day_of_month", "day_of_week", "day_of_year")]
    )


DATE_PARTS_SQL = """
select o_orderkey, cast(month(o_orderdate) as integer) as month, cast(day(o_orderdate) as integer) as day_of_month,
       cast(isodow(o_orderdate) - 1 as integer) as day_of_week, cast(dayofyear(o_orderdate) as integer) as day_of_year
from orders"""


def _ordered_lines(spark, sf_dir):
    lines, orders = A.table(spark, sf_dir, "lineitem"), A.table(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def date_difference_query(spark, sf_dir):
    rows = _ordered_lines(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").cast("date").alias("shipped"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date")).alias("ordered"),
    )
    return rows.withColumn("difference", date_difference("shipped", "ordered"))


DATE_DIFFERENCE_SQL = """
select l_orderkey, l_linenumber, cast(l_shipdate as date) as shipped,
       case when o_orderstatus <> 'P' then cast(o_orderdate as date) end as ordered,
       cast(case when o_orderstatus <> 'P' then abs(date_diff('day', l_shipdate, o_orderdate)) else 0 end as integer) as difference
from lineitem join orders on l_orderkey = o_orderkey"""


def amount_difference_query(spark, sf_dir):
    rows = A.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return rows.withColumn("difference", F.round(amount_difference("l_discount", "l_tax"), 9))


AMOUNT_DIFFERENCE_SQL = """
select l_orderkey, l_linenumber, l_discount, l_tax,
       round(case when l_discount = 0 and l_tax = 0 then null when l_discount = 0 then 10.0
            else least(abs((l_tax - l_discount) / l_discount), 10.0) end, 9) as difference
from lineitem"""


def predicted_dates(spark, sf_dir):
    """Rounding for training, cutting off for serving."""
    rows = A.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").cast("date").alias("date"),
        (F.col("l_quantity") / 2).alias("days"),
    )
    return rows.withColumn("rounded", rounded_next_date("date", "days")).withColumn(
        "truncated", truncated_next_date("date", "days")
    )


PREDICTED_DATES_SQL = """
select l_orderkey, l_linenumber, cast(l_shipdate as date) as date, l_quantity / 2 as days,
       cast(l_shipdate + to_days(cast(round_even(l_quantity / 2, 0) as integer)) as date) as rounded,
       cast(l_shipdate + to_days(cast(trunc(l_quantity / 2) as integer)) as date) as truncated
from lineitem"""


def impute_scale_stats(spark, sf_dir):
    rows = A.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).alias("quantity"), F.col("l_discount").alias("discount")
    )
    stats = metrics.impute_scale_statistics(rows, ["quantity", "discount"])
    return stats.select(*[F.round(c, 9).alias(c) for c in stats.columns])


IMPUTE_SQL = """
with given as (
  select case when l_returnflag <> 'N' then l_quantity end as quantity, l_discount as discount from lineitem),
m as (select avg(quantity) as q, avg(discount) as d from given),
filled as (select coalesce(quantity, q) as quantity, coalesce(discount, d) as discount from given, m)
select round(avg(quantity), 9) as mean_quantity, round(avg(discount), 9) as mean_discount,
       round(stddev_pop(quantity), 9) as std_quantity, round(stddev_pop(discount), 9) as std_discount
from filled"""


# --- positions and matches --------------------------------------------------------


def cycle_position(spark, sf_dir):
    tx = A.labelled_events(spark, sf_dir)
    return positions.cycle_position(tx, "cycle_id").select(
        "user_id", "account_id", "transaction_id", "cycle_id", "nth_in_cycle", "new_cycle", "next_in_cycle"
    )


CYCLE_POSITION_SQL = f"""
with recursive {TX_SQL}
select user_id, account_id, transaction_id, cycle_id,
       cast(case when cycle_id is not null then row_number() over w end as integer) as nth_in_cycle,
       cycle_id is not null and row_number() over w = 1 as new_cycle,
       cycle_id is not null and row_number() over w > 1 as next_in_cycle
from tx window w as (partition by user_id, account_id, cycle_id order by date, transaction_id)"""


def best_match(spark, sf_dir):
    """Discount plays the score of a line against its order."""
    lines = A.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.concat_ws("/", F.col("l_suppkey"), F.col("l_linenumber")).alias("cycle_id"),
        F.col("l_discount").alias("score"),
        F.col("l_shipdate").cast("date").alias("previous_date"),
    )
    return positions.best_match(lines, "score", 0.05, ["transaction_id"], ["previous_date"])


BEST_MATCH_SQL = """
select l_orderkey as transaction_id, l_suppkey || '/' || l_linenumber as cycle_id, cast(l_shipdate as date) as previous_date
from lineitem where l_discount > 0.05
qualify row_number() over (partition by l_orderkey order by l_discount desc, l_suppkey || '/' || l_linenumber, l_shipdate) = 1"""


# --- metrics ------------------------------------------------------------------------


def classification_report(spark, sf_dir):
    rows = A.table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").alias("label"), (F.col("l_discount") > 0.05).alias("prediction")
    )
    return metrics.classification_report(rows, "label", "prediction")


CLASSIFICATION_SQL = """
with c as (
  select count(*) filter (y and p) as tp, count(*) filter (not y and p) as fp,
         count(*) filter (y and not p) as fn, count(*) filter (not y and not p) as tn
  from (select l_returnflag = 'R' as y, l_discount > 0.05 as p from lineitem)),
k as (
  select '0' as name, tn / (tn + fn) as pr, tn / (tn + fp) as re, tn + fp as support from c
  union all select '1', tp / (tp + fp), tp / (tp + fn), tp + fn from c),
s as (select *, 2 * pr * re / (pr + re) as f from k)
select name, round(pr, 9) as precision, round(re, 9) as recall, round(f, 9) as f1_score, support from s
union all
select 'accuracy', round((tp + tn) / (tp + tn + fp + fn), 9), round((tp + tn) / (tp + tn + fp + fn), 9),
       round((tp + tn) / (tp + tn + fp + fn), 9), tp + tn + fp + fn from c
union all select 'macro avg', round(avg(pr), 9), round(avg(re), 9), round(avg(f), 9), cast(sum(support) as bigint) from s
union all select 'weighted avg', round(sum(pr * support) / sum(support), 9), round(sum(re * support) / sum(support), 9),
       round(sum(f * support) / sum(support), 9), cast(sum(support) as bigint) from s"""


def mae(spark, sf_dir):
    rows = _ordered_lines(spark, sf_dir).select(
        F.col("l_quantity").alias("y"), F.date_diff("l_shipdate", "o_orderdate").alias("p")
    )
    return metrics.mean_absolute_error(rows, "y", "p")


MAE_SQL = """
select round(avg(abs(l_quantity - date_diff('day', o_orderdate, l_shipdate))), 6) as mae
from lineitem join orders on l_orderkey = o_orderkey"""


QUERIES = {
    "user_split": (user_split, USER_SPLIT_SQL),
    "split_overlap": (split_overlap, SPLIT_OVERLAP_SQL),
    "user_sample": (user_sample, USER_SAMPLE_SQL),
    "evaluation_sample": (evaluation_sample, EVALUATION_SAMPLE_SQL),
    "has_cycle_dataset": (has_cycle_dataset, HAS_CYCLE_SQL),
    "class_sample": (class_sample, CLASS_SAMPLE_SQL),
    "dataset_sizes": (dataset_sizes, DATASET_SIZES_SQL),
    "next_date_dataset": (next_date_dataset, NEXT_SQL),
    "is_next_positives": (is_next_positives, POSITIVES_SQL),
    "is_next_negatives": (is_next_negatives, NEGATIVES_SQL),
    "negative_match_counts": (negative_match_counts, MATCH_COUNTS_SQL),
    "date_parts": (date_parts, DATE_PARTS_SQL),
    "date_difference": (date_difference_query, DATE_DIFFERENCE_SQL),
    "amount_difference": (amount_difference_query, AMOUNT_DIFFERENCE_SQL),
    "predicted_dates": (predicted_dates, PREDICTED_DATES_SQL),
    "impute_scale_stats": (impute_scale_stats, IMPUTE_SQL),
    "cycle_position": (cycle_position, CYCLE_POSITION_SQL),
    "best_match": (best_match, BEST_MATCH_SQL),
    "classification_report": (classification_report, CLASSIFICATION_SQL),
    "mae": (mae, MAE_SQL),
}
