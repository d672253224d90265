"""The given test tables seen as the inputs of this library.

Each adapter is a plain projection or join over whole tables.  ``*_SQL`` states
the same for DuckDB, as the common start of the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.keys import account_key, transaction_key


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(column: str):
    return F.round(F.col(column) * 100).cast("bigint")


def _line_id():
    """Line items have no unique number pair, so the id covers every column."""
    return F.md5(
        F.concat_ws(
            "-",
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            F.col("l_quantity").cast("bigint"),
            _cents("l_extendedprice"),
            _cents("l_discount"),
            _cents("l_tax"),
            "l_returnflag",
            "l_linestatus",
            F.col("l_shipdate").cast("date"),
        )
    )


_LINE_ID_SQL = (
    "md5(concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, cast(l_quantity as bigint),"
    " cast(round(l_extendedprice * 100) as bigint), cast(round(l_discount * 100) as bigint),"
    " cast(round(l_tax * 100) as bigint), l_returnflag, l_linestatus, cast(l_shipdate as date)))"
)


# --- labelled groups: one row per transaction, group columns ready -----------


def event_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as transactions; a user's event type is the counterparty group."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("user_account_id"),
        F.col("event_type").alias("counterparty_cluster"),
        F.col("event_id").cast("string").alias("transaction_pending_id"),
        F.col("ts").cast("date").alias("date"),
        F.col("value").alias("signed_amount"),
    )


EVENT_GROUPS_SQL = """
  select cast(user_id as varchar) as user_account_id, event_type as counterparty_cluster,
         cast(event_id as varchar) as transaction_pending_id, cast(ts as date) as date,
         value as signed_amount
  from events"""


def customer_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as transactions; everything of a customer is one group."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("user_account_id"),
        F.lit("all").alias("counterparty_cluster"),
        _line_id().alias("transaction_pending_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("signed_amount"),
    )


CUSTOMER_GROUPS_SQL = f"""
  select cast(o_custkey as varchar) as user_account_id, 'all' as counterparty_cluster,
         {_LINE_ID_SQL} as transaction_pending_id, cast(l_shipdate as date) as date,
         l_extendedprice as signed_amount
  from lineitem join orders on l_orderkey = o_orderkey"""


def supplier_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as transactions; a supplier's part name is the group."""
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_suppkey").cast("string").alias("user_account_id"),
        F.col("p_name").alias("counterparty_cluster"),
        _line_id().alias("transaction_pending_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("signed_amount"),
    )


SUPPLIER_GROUPS_SQL = f"""
  select cast(l_suppkey as varchar) as user_account_id, p_name as counterparty_cluster,
         {_LINE_ID_SQL} as transaction_pending_id, cast(l_shipdate as date) as date,
         l_extendedprice as signed_amount
  from lineitem join part on l_partkey = p_partkey"""


# --- the seven input tables --------------------------------------------------


def input_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Customers as users with one account each; line items are the app's
    transactions, events those of the second tenant.  Tenants are told apart by
    region, customers of NATION_7 are the test users, and an account is deleted
    where the balance is negative."""
    homes = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("user_id", F.col("c_custkey").cast("string"))
    )

    def users(region):
        return homes.where(region).select(
            "user_id", F.col("n_name").alias("country_code"), F.col("c_mktsegment").alias("client_id")
        )

    accounts = homes.select(
        F.concat(F.lit("A"), "user_id").alias("account_id"),
        "user_id",
        F.when(F.col("c_acctbal") < 0, "closed").alias("deleted"),
        F.col("c_mktsegment").alias("type"),
    )
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    app = lines.select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.concat(F.lit("A"), F.col("o_custkey").cast("string")).alias("account_id"),
        _line_id().alias("transaction_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        (F.col("l_linestatus") == "O").alias("pending"),
        F.col("p_name").alias("counterparty"),
        (F.col("l_tax") > 0).alias("is_merchant"),
        F.lit(None).cast("string").alias("cycle_id"),
        F.concat_ws(" ", "p_type", "p_brand", "p_name").alias("description"),
        F.col("l_extendedprice").alias("amount"),
        F.when(F.col("l_returnflag") == "R", "credit").otherwise("debit").alias("transaction_type"),
        F.lit(False).alias("internal_transaction"),
    )
    partner = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("A"), F.col("user_id").cast("string")).alias("account_id"),
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("ts").cast("date").alias("date"),
        (F.col("value") > 100).alias("pending"),
        F.col("event_type").alias("counterparty"),
        F.lit(True).alias("is_merchant"),
        F.lit(None).cast("string").alias("cycle_id"),
        F.concat_ws(" ", "event_type", "props").alias("description"),
        F.col("value").alias("amount"),
        F.when(F.col("event_id") % 2 == 0, "debit").otherwise("credit").alias("transaction_type"),
        F.lit(False).alias("internal_transaction"),
    )
    return {
        "users_app": users(F.col("n_regionkey") <= 2),
        "test_users_app": homes.where(F.col("n_name") == "NATION_7").select("user_id"),
        "accounts_app": accounts,
        "transactions_app": app,
        "users_partner": users(F.col("n_regionkey") > 2),
        "accounts_partner": accounts,
        "transactions_partner": partner,
    }


INPUT_TABLES_SQL = f"""
  homes as (
    select *, cast(c_custkey as varchar) as user_id from customer join nation on c_nationkey = n_nationkey),
  users_app as (
    select user_id, n_name as country_code, c_mktsegment as client_id from homes where n_regionkey <= 2),
  users_partner as (
    select user_id, n_name as country_code, c_mktsegment as client_id from homes where n_regionkey > 2),
  test_users_app as (select user_id from homes where n_name = 'NATION_7'),
  accounts as (
    select 'A' || user_id as account_id, user_id,
           case when c_acctbal < 0 then 'closed' end as deleted, c_mktsegment as type from homes),
  transactions_app as (
    select cast(o_custkey as varchar) as user_id, 'A' || cast(o_custkey as varchar) as account_id,
           {_LINE_ID_SQL} as transaction_id, cast(l_shipdate as date) as date,
           l_linestatus = 'O' as pending, p_name as counterparty, l_tax > 0 as is_merchant,
           cast(null as varchar) as cycle_id, p_type || ' ' || p_brand || ' ' || p_name as description,
           l_extendedprice as amount,
           case when l_returnflag = 'R' then 'credit' else 'debit' end as transaction_type,
           false as internal_transaction
    from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey),
  transactions_partner as (
    select cast(user_id as varchar) as user_id, 'A' || cast(user_id as varchar) as account_id,
           cast(event_id as varchar) as transaction_id, cast(ts as date) as date,
           value > 100 as pending, event_type as counterparty, true as is_merchant,
           cast(null as varchar) as cycle_id, event_type || ' ' || props as description, value as amount,
           case when event_id % 2 = 0 then 'debit' else 'credit' end as transaction_type,
           false as internal_transaction
    from events)"""


# --- text clustering ---------------------------------------------------------


def documents_as_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as counterparties; a language is one (hot) account."""
    return table(spark, sf_dir, "documents").select(
        F.col("lang").alias("user_account_id"),
        F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("transaction_pending_id"),
        F.lit("2024-01-01").cast("date").alias("date"),
        F.col("text").alias("counterparty"),
    )


DOCUMENT_ROWS_SQL = """
  select lang as user_account_id, lpad(cast(doc_id as varchar), 12, '0') as transaction_pending_id,
         date '2024-01-01' as date, text as counterparty
  from documents"""


# --- labelled transactions of users, for data sets and prediction ------------


def labelled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the cycles found in them, as a training table."""
    from cadenza.operators.series import label_cycles

    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("user_id").cast("string").alias("account_id"),
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("ts").cast("date").alias("date"),
        F.lit(False).alias("pending"),
        F.col("value").alias("signed_amount"),
        F.concat_ws(" ", "event_type", "props").alias("description"),
        F.col("event_type").alias("counterparty_cluster"),
    )
    keyed = rows.withColumn("user_account_id", account_key()).withColumn(
        "transaction_pending_id", transaction_key()
    )
    return label_cycles(keyed).drop("user_account_id", "transaction_pending_id")


#: Event types that stand for recurring payments where labels are given.
RECURRING_TYPES = ("purchase", "signup")


def events_with_given_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a training table whose cycles are given: those of a user and a
    recurring type.  The description names the type, so there is something to learn."""
    key = F.concat_ws("|", "user_id", "event_type")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("user_id").cast("string").alias("account_id"),
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("ts").cast("date").alias("date"),
        F.lit(False).alias("pending"),
        F.col("value").alias("signed_amount"),
        F.concat_ws(" ", "event_type", "props").alias("description"),
        F.col("event_type").alias("counterparty_cluster"),
        F.when(F.col("event_type").isin(*RECURRING_TYPES), key).alias("cycle_id"),
        F.lit(None).cast("double").alias("cycle_period"),
    )
