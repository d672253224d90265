"""Registered queries: periodic series and their summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.fixed import MAX_CYCLES_PER_GROUP, PERIODS
from cadenza.operators.series import cap_cycles, label_cycles, summarise_cycles
from cadenza.plans.repair import LabelStore
from cadenza.session import cut, work_path
from cadenza.sources import adapters as A


def labels_sql(rows_sql: str, key: str = "user_account_id || 'x' || counterparty_cluster") -> str:
    """CTEs up to ``labelled``: the greedy search restated as recursive SQL.

    One recursion step moves every group by one: it grows the open series,
    closes it, or opens one at the next free row.
    """
    gaps = ", ".join(str(round(2 * p)) for p, _, _ in PERIODS)
    errors = ", ".join(str(2 * e) for _, e, _ in PERIODS)
    names = ", ".join(f"{float(p)}" for p, _, _ in PERIODS)
    return f"""
  given as materialized (
    select *, row_number() over (partition by user_account_id, counterparty_cluster
                                 order by date, transaction_pending_id, signed_amount) as place
    from ({rows_sql})),
  grouped as (
    select user_account_id, counterparty_cluster, list(place order by place) as ids,
           list(2 * date_diff('day', date '1970-01-01', date) order by place) as days,
           list(signed_amount order by place) as amounts
    from given group by 1, 2),
  search as (
    select user_account_id, counterparty_cluster, ids, days, amounts, 1 as p, 0 as s,
           cast([] as integer[]) as series, cast(0 as double) as total,
           list_transform(days, lambda d: -1) as codes, 0 as found
    from grouped where len(days) >= 3
    union all
    select user_account_id, counterparty_cluster, ids, days, amounts,
           case when len(series) = 0 and pick is null then p + 1 else p end,
           case when len(series) = 0 then coalesce(pick.j, 0) else s end,
           case when pick is not null then list_append(series, pick.j) else cast([] as integer[]) end,
           case when pick is null then 0 when len(series) = 0 then amounts[pick.j] else total + amounts[pick.j] end,
           case when pick is null and len(series) >= 3
                then list_transform(codes, lambda c, i: case when list_contains(series, i) then found * 5 + p - 1 else c end)
                else codes end,
           case when pick is null and len(series) >= 3 then found + 1 else found end
    from (
      select *, case when len(series) = 0
          then (select min({{'d': cast(0 as double), 'j': cast(j as integer)}}) from unnest(range(s + 1, len(days) + 1)) as u(j)
                where codes[j] < 0)
          else (select min({{'d': abs(amounts[j] - total / len(series)), 'j': cast(j as integer)}})
                from unnest(range(series[-1] + 1, len(days) + 1)) as u(j)
                where codes[j] < 0
                  and abs(days[series[-1]] + [{gaps}][p] - days[j]) <= [{errors}][p]) end as pick
      from search where p <= 5)
  ),
  finished as (
    select * from search where p = 6),
  labelled as (
    select user_account_id, counterparty_cluster, ids[i] as place,
           case when codes[i] >= 0 and found <= {MAX_CYCLES_PER_GROUP}
                then {key} || '_' || (codes[i] // 5) end as cycle_id,
           case when codes[i] >= 0 and found <= {MAX_CYCLES_PER_GROUP}
                then ([{names}])[1 + codes[i] % 5] end as cycle_period
    from (select *, unnest(range(1, len(ids) + 1)) as i from finished)),
  with_labels as (
    select g.*, l.cycle_id, cast(l.cycle_period as double) as cycle_period
    from given g left join labelled l using (user_account_id, counterparty_cluster, place))"""


_LABEL_COLUMNS = (
    "user_account_id, counterparty_cluster, transaction_pending_id, date, signed_amount, cycle_id, cycle_period"
)


def _labels(adapter, rows_sql):
    sql = f"with recursive {labels_sql(rows_sql)} select {_LABEL_COLUMNS} from with_labels"
    return (lambda spark, d: label_cycles(adapter(spark, d))), sql


def labels_of_repeated_keys(spark, sf_dir):
    """Many rows of a group and day share one transaction key here, and big groups
    are those of more than five rows, so every way of the search is taken."""
    rows = A.event_groups(spark, sf_dir)
    same = rows.withColumn("transaction_pending_id", F.concat(F.lit("k"), F.right("transaction_pending_id", F.lit(1))))
    return label_cycles(same, group_limit=5)


REPEATED_KEYS_SQL = f"""
  select user_account_id, counterparty_cluster, 'k' || right(transaction_pending_id, 1) as transaction_pending_id,
         date, signed_amount
  from ({A.EVENT_GROUPS_SQL})"""


def labels_of_big_groups(spark, sf_dir):
    """All customers with more than three lines are big groups."""
    return label_cycles(A.customer_groups(spark, sf_dir), group_limit=3)


def repaired_labels(spark, sf_dir):
    """Labels of the lines up to a date, then of all: customers without a later line are not
    searched again."""
    store = LabelStore(work_path(spark, "labels"))
    rows = cut(A.customer_groups(spark, sf_dir))
    last = rows.agg(F.max("date")).first()[0]
    store.update(rows.where(F.col("date") <= F.date_sub(F.lit(last), 365)))
    return store.labelled(spark, store.update(rows))


def _summary(adapter, rows_sql):
    sql = f"""with recursive {labels_sql(rows_sql)}
select user_account_id, counterparty_cluster, cycle_id, cycle_period, count(*) as n_transactions,
       min(date) as first_date, max(date) as last_date, round(avg(signed_amount), 9) as mean_amount
from with_labels where cycle_id is not null group by all"""
    return (lambda spark, d: summarise_cycles(label_cycles(adapter(spark, d)))), sql


def cycle_cap(spark, sf_dir):
    """A3 on given labels: a customer's ship modes stand for cycles."""
    lines, orders = A.table(spark, sf_dir, "lineitem"), A.table(spark, sf_dir, "orders")
    given = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("user_account_id"),
        F.col("o_orderpriority").alias("counterparty_cluster"),
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_quantity") < 25, F.concat_ws("/", "l_returnflag", "l_linestatus")).alias("cycle_id"),
    )
    return cap_cycles(given, ["user_account_id", "counterparty_cluster"])


CYCLE_CAP_SQL = """
with given as (
  select cast(o_custkey as varchar) as user_account_id, o_orderpriority as counterparty_cluster,
         l_orderkey, l_linenumber,
         case when l_quantity < 25 then l_returnflag || '/' || l_linestatus end as cycle_id
  from lineitem join orders on l_orderkey = o_orderkey),
n as (
  select user_account_id, counterparty_cluster, count(distinct cycle_id) as c from given group by 1, 2)
select g.user_account_id, g.counterparty_cluster, l_orderkey, l_linenumber,
       case when c <= 2 then cycle_id end as cycle_id
from given g join n using (user_account_id, counterparty_cluster)"""


def cycle_violations(spark, sf_dir):
    """How often a labelled row breaks a rule; every count has to be 0."""
    from pyspark.sql import Window

    labelled = label_cycles(A.customer_groups(spark, sf_dir))
    inside = labelled.where(F.col("cycle_id").isNotNull())
    in_order = Window.partitionBy("cycle_id").orderBy("date", "transaction_pending_id")
    gap = F.date_diff("date", F.lag("date").over(in_order))
    allowed = F.array(*[F.lit(float(e)) for _, e, _ in PERIODS])
    names = F.array(*[F.lit(float(p)) for p, _, _ in PERIODS])
    error = F.element_at(allowed, F.array_position(names, F.col("cycle_period")).cast("int"))
    gaps = inside.withColumn("gap", gap).select(
        F.count_if(F.abs(F.col("gap") - F.col("cycle_period")) > error).alias("irregular_gaps")
    )
    lengths = inside.groupBy("cycle_id").count().select(F.count_if(F.col("count") < 3).alias("short_cycles"))
    over = (
        inside.select("user_account_id", "counterparty_cluster", "cycle_id")
        .distinct()
        .groupBy("user_account_id", "counterparty_cluster")
        .count()
        .select(F.count_if(F.col("count") > MAX_CYCLES_PER_GROUP).alias("groups_over_cap"))
    )
    rows = labelled.select(F.count("*").alias("n_rows"))
    # Four one-row tables side by side.
    one = [t.withColumn("_k", F.lit(1)) for t in (gaps, lengths, over, rows)]
    return one[0].join(one[1], "_k").join(one[2], "_k").join(one[3], "_k").drop("_k")


CYCLE_VIOLATIONS_SQL = """
select cast(0 as bigint) as irregular_gaps, cast(0 as bigint) as short_cycles,
       cast(0 as bigint) as groups_over_cap, count(*) as n_rows
from lineitem join orders on l_orderkey = o_orderkey"""


QUERIES = {
    "cycle_labels": _labels(A.event_groups, A.EVENT_GROUPS_SQL),
    "cycle_labels_customer": _labels(A.customer_groups, A.CUSTOMER_GROUPS_SQL),
    "cycle_labels_supplier": _labels(A.supplier_groups, A.SUPPLIER_GROUPS_SQL),
    "cycle_labels_repeated_keys": (labels_of_repeated_keys, _labels(None, REPEATED_KEYS_SQL)[1]),
    "cycle_labels_big_groups": (labels_of_big_groups, _labels(None, A.CUSTOMER_GROUPS_SQL)[1]),
    "repaired_labels": (repaired_labels, _labels(None, A.CUSTOMER_GROUPS_SQL)[1]),
    "cycle_summary": _summary(A.event_groups, A.EVENT_GROUPS_SQL),
    "cycle_summary_customer": _summary(A.customer_groups, A.CUSTOMER_GROUPS_SQL),
    "cycle_cap": (cycle_cap, CYCLE_CAP_SQL),
    "cycle_violations": (cycle_violations, CYCLE_VIOLATIONS_SQL),
}
