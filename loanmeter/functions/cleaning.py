"""Column builders for cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_TEXT = "null"


def with_ingest_date(df: DataFrame) -> DataFrame:
    """Add ``ingest_date``: the start of the query, the same for all rows."""
    return df.withColumn("ingest_date", F.current_timestamp())


def surrogate_key(*parts: Column) -> Column:
    """SHA-256 of the parts joined without a separator; NULL when any part is NULL.

    Without a separator ("1", "23") and ("12", "3") share a key. Stored keys depend on it.
    """
    return F.sha2(F.concat(*parts), 256)


def null_text_to_null(text: Column) -> Column:
    """The exact text ``null`` becomes NULL; ``NULL`` or ``Null`` stay."""
    return F.nullif(text, F.lit(NULL_TEXT))


def experience(length: Column) -> Column:
    """Employment length as a number in text form; ``n/a`` becomes the text ``null``."""
    whole = (
        F.when(length == "n/a", NULL_TEXT)
        .when(length == "10+ years", "10")
        .when(length.isin("1 year", "< 1 year"), "1")
    )
    return F.coalesce(whole, without(length, " years"))


def without(text: Column, part: str) -> Column:
    """Remove every occurrence of a literal part."""
    return F.replace(text, F.lit(part), F.lit(""))
