from datetime import date

from cadenza.operators import base
from cadenza.sources.schemas import SCHEMAS, column_names
from cadenza.sources.tables import read_all, read_table, read_training_table, write_training_table

ROW = ("1", "a", "t", date(2018, 9, 2), False, "Landlord", True, None, "rent", 10.0, "debit", False)


def test_partition_folders_are_pruned(spark, tmp_path):
    path = str(tmp_path / "tx")
    rows = [(*ROW[:2], f"t{y}{m}", date(y, m, 3), *ROW[4:], y, m) for y, m in ((2018, 8), (2018, 9), (2019, 1), (2017, 12))]
    schema = SCHEMAS["transactions_app"] + ", year int, month int"
    spark.createDataFrame(rows, schema).write.partitionBy("year", "month").parquet(path)
    df = read_table(spark, "transactions_app", path, start="2018-09-01")
    assert df.columns == column_names("transactions_app")
    assert {r.transaction_id for r in df.collect()} == {"t20189", "t20191"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_csv_tables_with_types_and_renames(spark, tmp_path):
    for table in SCHEMAS:
        spark.createDataFrame([], SCHEMAS[table]).write.option("header", True).csv(str(tmp_path / table))
    (tmp_path / "users_app" / "part.csv").write_text("id,country_code,client_id\n7,FR,x\n")
    (tmp_path / "transactions_partner" / "part.csv").write_text(
        ",".join(column_names("transactions_partner")) + "\n7,a,t,2019-01-02,true,Shop,false,,text,5.5,debit,false\n"
    )
    tables = read_all(spark, {t: str(tmp_path / t) for t in SCHEMAS}, fmt="csv")
    assert tables["users_app"].first().user_id == "7"
    row = tables["transactions_partner"].first()
    assert (row.date, row.pending, row.amount, row.cycle_id) == (date(2019, 1, 2), True, 5.5, None)


def test_base_table_rules(spark):
    def users(*rows):
        return spark.createDataFrame(rows, "user_id string, country_code string, client_id string")

    def accounts(*rows):
        return spark.createDataFrame(rows, "account_id string, user_id string, deleted string, type string")

    good = ROW
    app = [
        good,
        good,  # an exact copy
        (*good[:3], date(2018, 8, 31), *good[4:]),
        (*good[:3], date(2020, 9, 1), *good[4:]),
        (*good[:5], "  ", *good[6:]),
        (*good[:10], None, good[11]),
        ("2", *good[1:]),  # a test user
        ("3", *good[1:]),  # elsewhere
        ("1", "closed", *good[2:]),
        (*good[:4], None, *good[5:10], "credit", False),
    ]
    tables = {
        "users_app": users(("1", "GB", "z"), ("2", "GB", "z"), ("3", "NL", "z")),
        "test_users_app": spark.createDataFrame([("2",)], "user_id string"),
        "accounts_app": accounts(("a", "1", None, "x"), ("a", "2", None, "x"), ("a", "3", None, "x"), ("closed", "1", "2019-01-01", "x")),
        "transactions_app": spark.createDataFrame(app, SCHEMAS["transactions_app"]),
        "users_partner": users(("1", "NL", "client"), ("9", "NL", "other")),
        "accounts_partner": accounts(("a", "1", None, "x"), ("a", "9", None, "x")),
        "transactions_partner": spark.createDataFrame([(*good[:3], date(2015, 1, 1), *good[4:]), ("9", *good[1:])], SCHEMAS["transactions_partner"]),
    }
    rows = sorted(
        (r.origin, r.date.isoformat(), r.signed_amount, r.user_account_id, r.transaction_pending_id)
        for r in base.base_transactions(tables, partner_client_ids=["client"]).collect()
    )
    assert rows == [
        ("app", "2018-09-02", -10.0, "1|a", "t|false"),
        ("app", "2018-09-02", 10.0, "1|a", "t|"),
        ("app", "2020-09-01", -10.0, "1|a", "t|false"),
        ("partner", "2015-01-01", -10.0, "1|a", "t|false"),
    ]
    assert base.sample_users(tables["users_app"], 2).count() <= 3


def test_training_table_round_trip(spark, tmp_path):
    df = spark.range(100)
    write_training_table(df, str(tmp_path / "t"), files=4)
    assert read_training_table(spark, str(tmp_path / "t")).count() == 100
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 4
