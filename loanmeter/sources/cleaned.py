"""Cleaned Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanmeter.operators.hot_members import KEY
from loanmeter.plans.score import ScoreTables
from loanmeter.sources.member_counts import MemberCounts, append_member_rows, table_files
from loanmeter.tables import SCORE_TABLES, TABLES, TableSpec


def table_path(root: str, table: TableSpec) -> str:
    """Where a table lies below the folder of all cleaned tables; writer and readers share it."""
    return f"{root.rstrip('/')}/{table.folder}"


def append_clean(df: DataFrame, path: str, rebalance: bool = False) -> None:
    """Append to a cleaned table. Appending the same rows again stores them again.

    ``rebalance`` evens out file sizes at the cost of a shuffle, for runs that would leave many
    small files. Rows of a table of members are counted by member, for the plans of scores; that reads one column of
    what was written.
    """
    out = df.hint("rebalance") if rebalance else df
    if KEY not in df.columns:
        out.write.mode("append").option("compression", "zstd").parquet(path)
        return
    before = table_files(df.sparkSession, path)
    out.write.mode("append").option("compression", "zstd").parquet(path)
    append_member_rows(df.sparkSession, path, table_files(df.sparkSession, path) - before)


def read_clean(spark: SparkSession, table: TableSpec, path: str) -> DataFrame:
    """Read a cleaned table with its declared schema, so no file footer is read up front."""
    return spark.read.schema(table.clean_schema).parquet(path)


def read_score_tables(spark: SparkSession, root: str) -> ScoreTables:
    """The cleaned tables the score needs, with what was counted when they were appended to."""
    paths = {n: table_path(root, TABLES[n]) for n in SCORE_TABLES}
    return ScoreTables(
        **{n: read_clean(spark, TABLES[n], path) for n, path in paths.items()},
        counts=MemberCounts(spark, root, paths),
    )


def register_views(spark: SparkSession, root: str) -> None:
    """Offer every cleaned table to SQL users, as a view named like its folder."""
    for table in TABLES.values():
        read_clean(spark, table, table_path(root, table)).createOrReplaceTempView(table.folder)
