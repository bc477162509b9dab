"""Raw CSV files and their dated landing snapshots."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmeter.tables import TableSpec

SNAPSHOT = "snapshot_date"
FAULTY = "faulty_line"


def read_raw(spark: SparkSession, table: TableSpec, path: str, keep_faulty: bool = False) -> DataFrame:
    """Read a CSV file or folder with a header line.

    The schema is declared, so no pass over the data is spent on inference. Columns bind by
    position. A field that does not fit its type is NULL and its row stays. With ``keep_faulty`` the column
    ``faulty_line`` holds the line as it was read wherever something did not fit, and NULL elsewhere.
    """
    reader = spark.read.option("header", True)
    if keep_faulty:
        reader = reader.option("columnNameOfCorruptRecord", FAULTY)
        return reader.schema(f"{table.raw_schema}, {FAULTY} string").csv(path)
    return reader.schema(table.raw_schema).csv(path)


def land_snapshot(df: DataFrame, path: str, day: date | str) -> None:
    """Keep a raw table as it was on one day. Landing a day again replaces that day only."""
    (
        df.withColumn(SNAPSHOT, F.lit(str(day)).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(SNAPSHOT)
        .parquet(path)
    )


def read_snapshot(spark: SparkSession, table: TableSpec, path: str, day: date | str) -> DataFrame:
    """Read one landed day; the other days' folders are pruned."""
    return _day(spark, table, path, day).drop(FAULTY)


def reparse_snapshot(
    spark: SparkSession,
    table: TableSpec,
    path: str,
    day: date | str,
    fix: Callable[[DataFrame], DataFrame] | None = None,
    **options: str,
) -> DataFrame:
    """Read one landed day and parse its faulty lines anew.

    ``fix`` gets the faulty lines with all fields as text, parsed with the given options of Spark's CSV reader, and
    returns them with values that fit; they are cast to the types of the table. Lines that were read without a fault
    are taken as they were landed. One narrow pass: nothing is shuffled.
    """
    rows = _day(spark, table, path, day)
    as_text = ", ".join(f"{c.raw} string" for c in table.columns)
    faulty = rows.where(F.col(FAULTY).isNotNull()).select(F.from_csv(FAULTY, as_text, options).alias("fields"))
    texts = faulty.select("fields.*")
    fixed = fix(texts) if fix else texts
    again = fixed.select(*(F.col(c.raw).try_cast(c.type).alias(c.raw) for c in table.columns))
    return rows.where(F.col(FAULTY).isNull()).drop(FAULTY).unionByName(again)


def _day(spark: SparkSession, table: TableSpec, path: str, day: date | str) -> DataFrame:
    return (
        spark.read.schema(f"{table.raw_schema}, {FAULTY} string, {SNAPSHOT} date")
        .parquet(path)
        .where(F.col(SNAPSHOT) == F.lit(str(day)).cast("date"))
        .drop(SNAPSHOT)
    )
