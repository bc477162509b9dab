"""Rows per member of the cleaned tables, kept beside them, and the hot members found from these.

Every append to a cleaned table leaves a *run* beside it: how many of the new rows each member has, counted from the
files just written, one column of them. Planning a score then sums up runs instead of scanning the keys of five tables.
What it finds is stored under a name made of the runs and the policy: as long as nothing was appended, further plans
read it and start no job.

The numbers steer parallelism only. A table that was written in another way has no runs, and its keys are
scanned; a run too many or too few changes no result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmeter.operators.hot_members import KEY, HotMembers, HotPolicy, hot_table

RUNS = "_member_rows"
"""In the folder of the table; readers of the table pass over names that start like this."""
FOUND = "_hot_members"


def _files(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    return sorted(x.getPath().getName() for x in system.listStatus(folder))


def table_files(spark: SparkSession, path: str) -> set[str]:
    """Paths of the data files of a table."""
    return {f"{path}/{name}" for name in _files(spark, path) if not name.startswith(("_", "."))}


def append_member_rows(spark: SparkSession, path: str, new_files: set[str]) -> None:
    """Count the members of files that were appended to the table in ``path``."""
    if not new_files:
        return
    keys = spark.read.schema(f"{KEY} string").parquet(*sorted(new_files)).where(F.col(KEY).isNotNull())
    counts = keys.groupBy(KEY).agg(F.count("*").alias("rows"))
    counts.write.parquet(f"{path}/{RUNS}/run-{uuid.uuid4().hex}")


@dataclass(frozen=True)
class MemberCounts:
    """The runs of the tables of a score. ``paths`` are the tables' folders by side."""

    spark: SparkSession
    root: str
    paths: Mapping[str, str]

    def runs(self, sides: tuple[str, ...]) -> dict[str, list[str]] | None:
        """Folders of the runs by side; None if a table has none."""
        found = {side: [f"{self.paths[side]}/{RUNS}/{x}" for x in _files(self.spark, f"{self.paths[side]}/{RUNS}")] for side in sides}
        return found if all(found.values()) else None

    def hot_members(self, sides: tuple[str, ...], policy: HotPolicy | None = None) -> tuple[bool, HotMembers | None]:
        """Whether there are runs to tell, and the hot members. Starts jobs only if the runs or the policy are new."""
        policy = policy or HotPolicy()
        runs = self.runs(sides)
        if runs is None:
            return False, None
        name = hashlib.sha256(repr((runs, policy)).encode()).hexdigest()
        folder = f"{self.root.rstrip('/')}/{FOUND}/{name}"
        rows = self._stored_rows(folder)
        if rows is None:
            own = folder + "-" + uuid.uuid4().hex
            hot_table(self.member_rows(runs), sides, policy).write.parquet(own)
            self._publish(own, folder, self.spark.read.schema(_schema(sides)).parquet(own).count())
            rows = self._stored_rows(folder)
        if not rows:
            return True, None
        table = self.spark.read.schema(_schema(sides)).parquet(folder)
        return True, HotMembers(table, sides, rows <= policy.most_broadcast)

    def member_rows(self, runs: Mapping[str, list[str]]) -> DataFrame:
        """One row per member: its number of rows on each side, as ``<side>_rows``, summed over the runs."""
        read = self.spark.read.schema(f"{KEY} string, rows bigint")
        parts = [read.parquet(*paths).select(KEY, "rows", F.lit(side).alias("side")) for side, paths in runs.items()]
        sums = [F.sum(F.when(F.col("side") == side, F.col("rows")).otherwise(0)).alias(f"{side}_rows") for side in runs]
        return reduce(DataFrame.unionAll, parts).groupBy(KEY).agg(*sums)

    def _stored_rows(self, folder: str) -> int | None:
        """The number of hot members stored in a folder; None if it is not there or not complete."""
        marks = [x for x in _files(self.spark, folder) if x.startswith("_rows-")]
        return int(marks[0].removeprefix("_rows-")) if marks else None

    def _publish(self, own: str, folder: str, rows: int) -> None:
        """Give a complete result its final name. If another session was faster, its result stays: both are equal."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        system = path(own).getFileSystem(self.spark._jsc.hadoopConfiguration())
        system.createNewFile(path(f"{own}/_rows-{rows}"))
        if not system.exists(path(folder)):
            system.rename(path(own), path(folder))


def _schema(sides: tuple[str, ...]) -> str:
    numbers = (f"{side}_cuts bigint, {side}_stride bigint" for side in sides)
    return f"{KEY} string, cells bigint, {', '.join(numbers)}"
