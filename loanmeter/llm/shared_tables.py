"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; the warehouse folder only where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/llm"


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, lean: bool = False) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    It is computed once however often it is used, and lost executors cost no recomputation. A ``lean`` table is compressed
    better, and Spark deletes the shuffle files of its making once it is written, not when the driver collects its garbage.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    if lean:
        conf = df.sparkSession.conf
        before = conf.get(_CLEAN, None)
        conf.set(_CLEAN, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            conf.unset(_CLEAN) if before is None else conf.set(_CLEAN, before)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_written: list[str] = []
"""Folders of the tables that ``stored`` has written in this process, in order."""


def stored_alone(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """The stored result of ``build``. The tables that were stored on the way are deleted once it is written."""
    before = len(_written)
    result = stored(build(), name)
    for path in _written[before:-1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    _written[before:] = _written[-1:]
    return result


def broadcast_if_small(df: DataFrame, most_rows: int) -> DataFrame:
    """Mark a table for broadcasting if a count finds it small enough.

    Rows of one key, however many, then meet their row of ``df`` without a shuffle. Beyond the bound the join is
    shuffled, and adaptive execution splits what is skewed. ``df`` should be stored: it is read twice.
    """
    return F.broadcast(df) if df.count() <= most_rows else df


def looked_up(rows: DataFrame, table: DataFrame, key: str, times: str, most: int = 20_000) -> DataFrame:
    """Inner join of ``rows`` with a stored ``table`` that has one row per ``key`` and in ``times`` how often it occurs.

    At most ``most`` keys can have a ``most``-th of all occurrences each: they are broadcast, so that no hot key is
    shuffled. Every other key is rare, and a shuffled join has no large group. ``rows`` is read twice.
    """
    c = F.col
    everything = table.agg(F.coalesce(F.sum(times), F.lit(0))).first()[0]
    hot = c(times).cast("decimal(38,0)") * most >= F.lit(everything)
    often = F.broadcast(table.where(hot))
    direct = rows.join(often, key)
    rest = rows.join(often.select(key), key, "left_anti").join(table.where(~hot), key)
    return direct.unionByName(rest.select(direct.columns))
