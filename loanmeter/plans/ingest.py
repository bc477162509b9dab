"""Batch ingest: raw CSV to landing snapshot to cleaned Parquet, for all six tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loanmeter.plans.clean import clean
from loanmeter.sources.cleaned import append_clean, table_path
from loanmeter.sources.raw import land_snapshot, read_raw, read_snapshot
from loanmeter.tables import TABLES, TableSpec

SUCCESS = "Success"
STATUS_SCHEMA = "table string, rows_written bigint, status string"


class IngestError(RuntimeError):
    """Some tables failed. ``status`` has a row for each table, as in the result of a whole batch."""

    def __init__(self, status: list[tuple[str, int | None, str]]):
        self.status = status
        super().__init__("; ".join(f"{name}: {said}" for name, _, said in status if said != SUCCESS))


@dataclass(frozen=True)
class IngestConfig:
    raw: str
    """Folder of the raw CSV files."""
    landing: str
    """Folder of the dated snapshots."""
    cleaned: str
    """Folder of the cleaned tables."""
    snapshot_date: date | str


def ingest_table(spark: SparkSession, table: TableSpec, cfg: IngestConfig) -> int:
    """Land one table, clean the landed day and append it. Returns the number of rows appended.

    Lines that did not fit the schema are landed as they were, so that the day can be parsed anew. The rows are counted
    while they are written.
    """
    landing = table_path(cfg.landing, table)
    raw = read_raw(spark, table, f"{cfg.raw}/{table.raw_file}", keep_faulty=True)
    land_snapshot(raw, landing, cfg.snapshot_date)
    written = Observation()
    cleaned = clean(read_snapshot(spark, table, landing, cfg.snapshot_date), table)
    append_clean(
        cleaned.observe(written, F.count(F.lit(1)).alias("rows")),
        table_path(cfg.cleaned, table),
    )
    return written.get["rows"]


def ingest_all(spark: SparkSession, cfg: IngestConfig) -> DataFrame:
    """Ingest the six tables side by side, so that a small one does not hold up a cluster.

    Returns one row per table: ``table, rows_written, status``. If a table fails, the others are finished
    and an ``IngestError`` tells what was written; its cause is the first failure.
    """
    with ThreadPoolExecutor(len(TABLES)) as pool:
        runs = {name: pool.submit(ingest_table, spark, table, cfg) for name, table in TABLES.items()}
    failures = {name: run.exception() for name, run in runs.items() if run.exception()}
    status = [
        (name, None, type(failures[name]).__name__) if name in failures else (name, run.result(), SUCCESS)
        for name, run in runs.items()
    ]
    if failures:
        raise IngestError(status) from next(iter(failures.values()))
    return spark.createDataFrame(status, STATUS_SCHEMA)
