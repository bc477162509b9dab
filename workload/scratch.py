"""Folders for queries that write and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's warehouse folder, which all executors share."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"
