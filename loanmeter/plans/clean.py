"""Cleaning jobs: raw table in, cleaned table out.

A cleaning job is a single projection, so it runs in one stage without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmeter import tables
from loanmeter.functions.cleaning import (
    experience,
    null_text_to_null,
    surrogate_key,
    with_ingest_date,
    without,
)
from loanmeter.tables import TableSpec

TEXT_FIXES = {
    ("accounts", "emp_length"): experience,
    ("loans", "term"): lambda term: without(term, " months"),
    ("loans", "interest"): lambda interest: without(interest, "%"),
}


def clean(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Normalise texts, resolve the text ``null``, add key and ingest date, rename, order."""
    fixed, resolved = {}, {}
    for column in spec.columns:
        value = F.col(column.raw)
        fix = TEXT_FIXES.get((spec.name, column.raw))
        fixed[column.raw] = fix(value) if fix else value
        is_text = column.type == "string" and spec.null_text != tables.NEVER
        resolved[column.raw] = null_text_to_null(fixed[column.raw]) if is_text else fixed[column.raw]

    key_source = resolved if spec.null_text == tables.BEFORE_KEY else fixed
    cleaned = df.select(
        surrogate_key(*(key_source[part] for part in spec.key_parts)).alias(spec.key),
        *(resolved[c.raw].alias(c.clean) for c in spec.columns),
    )
    return cleaned.transform(with_ingest_date).select(*spec.clean_columns)


def clean_accounts(df: DataFrame) -> DataFrame:
    return clean(df, tables.ACCOUNTS)


def clean_customers(df: DataFrame) -> DataFrame:
    return clean(df, tables.CUSTOMERS)


def clean_defaulters(df: DataFrame) -> DataFrame:
    return clean(df, tables.DEFAULTERS)


def clean_investors(df: DataFrame) -> DataFrame:
    return clean(df, tables.INVESTORS)


def clean_loans(df: DataFrame) -> DataFrame:
    return clean(df, tables.LOANS)


def clean_payments(df: DataFrame) -> DataFrame:
    return clean(df, tables.PAYMENTS)
