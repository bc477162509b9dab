"""Cleaning: texts, keys, names and order."""

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loanmeter import TABLES, clean
from loanmeter.functions.cleaning import experience, null_text_to_null
from loanmeter.operators import filters

# Positions of string columns to fill per test; the rest stays NULL.


def rows(spark, table, *values):
    spec = TABLES[table]
    data = [tuple(v.get(c.raw) for c in spec.columns) for v in values]
    return spark.createDataFrame(data, spec.raw_schema)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


KEYS = {
    "accounts": ("acc_id", "mem_id", "loan_id"),
    "customers": ("mem_id", "age", "state"),
    "defaulters": ("loan_id", "mem_id", "def_id"),
    "investors": ("investor_loan_id", "loan_id", "investor_id"),
    "loans": ("loan_id", "mem_id", "acc_id"),
    "payments": ("loan_id", "mem_id", "latest_transaction_id"),
}


@pytest.mark.parametrize("table", TABLES)
def test_key(spark, table):
    def parts(*values):
        return {p: int(v) if p == "age" else v for p, v in zip(KEYS[table], values)}

    last = parts("1", "2", "null")
    missing = parts("1", "2", "3") | {KEYS[table][2]: None}
    whole = clean(rows(spark, table, parts("1", "23", "4"), parts("12", "3", "4"), last, missing), TABLES[table])
    keys = [r[0] for r in whole.collect()]
    null_text_key = None if table == "accounts" else sha("12null")
    assert keys == [sha("1234"), sha("1234"), null_text_key, None]


@pytest.mark.parametrize("table", TABLES)
def test_names_and_types(spark, table):
    spec = TABLES[table]
    df = clean(rows(spark, table, {}), spec)
    assert df.columns == spec.clean_columns
    assert df.columns[:2] == [spec.key, "ingest_date"]
    expected = spark.createDataFrame([], spec.clean_schema)
    assert dict(df.dtypes) == dict(expected.dtypes)
    assert isinstance(df.first()["ingest_date"], datetime)


def test_experience(spark):
    cases = {
        "n/a": None, "10+ years": "10", "1 year": "1", "< 1 year": "1", "3 years": "3", "null": None,
        "NULL": "NULL", "": "", "null years": None, "many": "many", "2 years years": "2",
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "t string")
    out = df.select("t", null_text_to_null(experience(F.col("t"))).alias("v"))
    assert {r.t: r.v for r in out.collect()} == {**cases, None: None}


def test_loan_texts(spark):
    loans = rows(
        spark,
        "loans",
        {"loan_id": "1", "term": " 36 months", "interest": "12.5%", "title": "null", "purpose": "Null"},
        {"loan_id": "2", "term": "null", "interest": "null%", "title": None},
    )
    first, second = clean(loans, TABLES["loans"]).orderBy("loan_id").collect()
    assert (first.term, first.interest, first.title, first.purpose) == (" 36", "12.5", None, "Null")
    assert (second.term, second.interest, second.title) == (None, None, None)


def test_investors_keep_null_text(spark):
    row = clean(rows(spark, "investors", {"investor_type": "null"}), TABLES["investors"]).first()
    assert row.investor_type == "null"


def test_one_narrow_stage(spark):
    """No cleaning job moves rows between tasks."""
    for name, spec in TABLES.items():
        plan = clean(rows(spark, name, {}), spec)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan


def test_loans_by_term_and_interest(spark):
    loans = rows(
        spark,
        "loans",
        *(
            {"loan_id": str(i), "term": term, "interest": rate}
            for i, (term, rate) in enumerate(
                [(" 36 months", "5.5%"), ("36 months", "5.0%"), ("60 months", "9%"), ("x", "9%"), ("36 months", "n/a"),
                 (None, "9%"), ("36 months", None), ("36 months", "6")]
            )
        ),
    )
    found = filters.loans_by_term_and_interest(clean(loans, TABLES["loans"]), 36, 5.0)
    assert sorted(r.loan_id for r in found.collect()) == ["0", "7"]


def test_payment_exceptions(spark):
    df = spark.createDataFrame(
        [(500, 500), (500, 650), (650, 500), (500, None), (None, 500), (650, None), (None, 0), (None, None)],
        "last_payment_pts int, total_payment_pts int",
    )
    found = [tuple(r) for r in filters.payment_exceptions(df).collect()]
    assert found == [(500, 650), (650, 500), (650, None), (None, 0)]


def test_inspection(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "v string")
    assert {r.v for r in filters.distinct_values(df, "v").collect()} == {"a", "b", None}
    assert filters.missing_values(df, "v").count() == 1
