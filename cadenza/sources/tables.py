"""Reading the input tables and writing the training table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.sources.schemas import PARTITIONS, RENAMED, SCHEMAS, column_names


def since(first: str | date) -> Column:
    """Rows of the month of ``first`` or later, on the partition columns alone,
    so that earlier folders are never listed."""
    first = date.fromisoformat(str(first))
    return (F.col("year") > first.year) | ((F.col("year") == first.year) & (F.col("month") >= first.month))


def read_table(
    spark: SparkSession, table: str, path: str, *, fmt: str = "parquet", start: str | None = None
) -> DataFrame:
    """One catalogued table with its declared types, pruned and renamed.

    ``start`` prunes the partition folders of a table that has them.
    """
    partitioned = start and table in PARTITIONS
    schema = f"{SCHEMAS[table]}, {PARTITIONS[table]}" if partitioned else SCHEMAS[table]
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    df = reader.load(path)
    if partitioned:
        df = df.where(since(start))
    return project(df, table)


def project(df: DataFrame, table: str) -> DataFrame:
    renamed = RENAMED.get(table, {})
    return df.select(*[F.col(n).alias(renamed.get(n, n)) for n in column_names(table)])


def read_all(spark: SparkSession, paths: dict[str, str], *, fmt: str = "parquet", start: str | None = None) -> dict[str, DataFrame]:
    """All seven tables, lazily."""
    return {table: read_table(spark, table, paths[table], fmt=fmt, start=start) for table in SCHEMAS}


def write_training_table(df: DataFrame, path: str, files: int | None = None) -> None:
    """Write the training table.

    ``files`` spreads the finished rows over that many files with a shuffle of
    their own, which leaves the work before it at full width; without it the
    file layout follows the shuffle that produced the rows.
    """
    (df.repartition(files) if files else df).write.mode("overwrite").parquet(path)


def read_training_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
