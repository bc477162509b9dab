"""The published score table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def publish_scores(scores: DataFrame, table: str, path: str, mode: str = "error") -> None:
    """Write the scores as an external Parquet table: dropping the table keeps the files.

    The default refuses to touch an existing table; a repeated run asks for ``overwrite``.
    """
    scores.write.format("parquet").mode(mode).option("path", path).saveAsTable(table)
