"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as contract
import workload.oracle
import workload.queries
from tests.compare import differences, oracle
from workload import fixtures

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    return oracle(SF)


LOAN_QUERIES = tuple(workload.queries.QUERIES)


def test_every_query_has_sql():
    assert workload.queries.QUERIES.keys() == workload.oracle.ORACLE_SQL.keys()
    assert contract.queries().keys() >= workload.queries.QUERIES.keys()


@pytest.mark.parametrize(
    ("table", "source"),
    [("payments", "lineitem"), ("loans", "orders"), *((t, "customer") for t in ("customers", "defaulters", "accounts"))],
)
def test_derived_tables_are_whole(spark, table, source):
    """One row per row of the source, for every set of derived tables."""
    for sf in ("/root/testdata/sf0.001", SF):
        rows = spark.read.parquet(f"{sf}/{source}.parquet").count()
        for tables in (fixtures.RAW, fixtures.CLEANED, fixtures.HOT):
            assert fixtures.derive(spark, sf, tables[table]).count() == rows


@pytest.mark.parametrize("name", LOAN_QUERIES)
def test_query(spark, db, name):
    df = contract.queries()[name](spark, SF)
    found, expected, surplus, missing, rows = differences(df, db, contract.oracle_sql()[name])
    assert found == expected
    assert not surplus and not missing, (
        f"{sum(surplus.values())} surplus, {sum(missing.values())} missing, "
        f"e.g. {list(surplus)[:2]} and {list(missing)[:2]}"
    )
    assert rows > 0


def test_entry(spark):
    assert contract.entry(spark).columns[-2:] == ["loan_score", "loan_final_grade"]


SQL_TYPES = {"varchar": "string", "integer": "int", "float": "float", "double": "double", "bigint": "bigint", "date": "date"}


@pytest.mark.parametrize("name", [n for n in LOAN_QUERIES if n.startswith(("clean_", "loan_", "pts_", "csv_"))])
def test_types(spark, db, name):
    """Both sides agree on types, not only on values."""
    df = contract.queries()[name](spark, "/root/testdata/sf0.001")
    sql = db.execute("describe " + contract.oracle_sql()[name]).fetchall()
    types = {row[0]: SQL_TYPES.get(row[1].lower(), row[1].lower()) for row in sql}
    assert dict(df.dtypes) == types


def test_score_types(spark):
    """The score keeps its decimal type through all stages."""
    df = contract.queries()["loan_grade"](spark, SF)
    assert dict(df.dtypes)["loan_score"] == "decimal(17,4)"
    types = dict(contract.queries()["score_components"](spark, SF).dtypes)
    assert types["payment_history_pts"] == "decimal(13,2)"
    assert types["defaulters_history_pts"] == "decimal(13,2)"
    assert types["financial_health_pts"] == "decimal(16,4)"


def test_grades_of_the_fixture(spark):
    """Every grade occurs, as often as noted in FIXTURES.md."""
    graded = contract.queries()["loan_grade"](spark, SF).groupBy("loan_final_grade").count()
    assert {r[0]: r[1] for r in graded.collect()} == {
        "A": 645, "B": 8716, "C": 18019, "D": 11156, "E": 1060, "F": 34, None: 91846,
    }
