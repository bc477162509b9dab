"""Counts kept beside the cleaned tables: a second plan on unchanged tables starts no job."""

import uuid

import pytest

from loanmeter import ScoreTables, append_clean, read_score_tables, score_members
from loanmeter.operators.hot_members import HotPolicy, member_rows
from loanmeter.plans.score import ALL_SIDES
from loanmeter.sources.cleaned import table_path
from loanmeter.tables import SCORE_TABLES, TABLES
from workload import fixtures

SF = "/root/testdata/sf0.001"
POLICY = HotPolicy(most_rows=60, most_output=200)


def jobs(spark, run):
    """The result of ``run`` and how many jobs it started."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup("none", "")


@pytest.fixture
def root(spark, tmp_path):
    root = str(tmp_path / "cleaned")
    for name in SCORE_TABLES:
        append_clean(fixtures.derive(spark, SF, fixtures.HOT[name]), table_path(root, TABLES[name]))
    return root


def test_counts_are_those_of_the_keys(spark, root):
    tables = read_score_tables(spark, root)
    kept = tables.counts.member_rows(tables.counts.runs(ALL_SIDES))
    scanned = member_rows({name: getattr(tables, name) for name in ALL_SIDES})
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, scanned.select(kept.columns).collect()))


def test_second_plan_starts_no_job(spark, root):
    tables = read_score_tables(spark, root)
    first, some = jobs(spark, lambda: score_members(tables, policy=POLICY))
    again, none = jobs(spark, lambda: score_members(read_score_tables(spark, root), policy=POLICY))
    assert some > 0 and none == 0
    scanned = ScoreTables(**{name: getattr(tables, name) for name in SCORE_TABLES})
    expected = sorted(map(str, score_members(scanned, policy=POLICY).collect()))
    assert sorted(map(str, first.collect())) == sorted(map(str, again.collect())) == expected
    assert tables.hot_members(*ALL_SIDES, policy=POLICY).table.count() > 1
    # Another policy is another question.
    _, some = jobs(spark, lambda: score_members(tables))
    assert some > 0 and tables.hot_members(*ALL_SIDES) is None


def test_an_append_is_noticed(spark, root):
    tables = read_score_tables(spark, root)
    before = tables.hot_members(*ALL_SIDES, policy=POLICY).table.count()
    payments = table_path(root, TABLES["payments"])
    for _ in range(2):
        append_clean(fixtures.derive(spark, SF, fixtures.HOT["payments"]), payments)
    tables = read_score_tables(spark, root)
    _, some = jobs(spark, lambda: tables.hot_members(*ALL_SIDES, policy=POLICY))
    assert some > 0 and tables.hot_members(*ALL_SIDES, policy=POLICY).table.count() > before
    assert tables.payments.count() == 3 * 6000


def test_tables_without_counts_are_scanned(spark, root, tmp_path):
    tables = read_score_tables(spark, root)
    other = str(tmp_path / "other")
    for name in SCORE_TABLES:
        getattr(tables, name).write.parquet(table_path(other, TABLES[name]))
    plain = read_score_tables(spark, other)
    assert plain.counts.hot_members(ALL_SIDES) == (False, None)
    found = {r.member_id for r in plain.hot_members(*ALL_SIDES, policy=POLICY).table.collect()}
    assert found == {r.member_id for r in tables.hot_members(*ALL_SIDES, policy=POLICY).table.collect()}


def test_empty_appends(spark, tmp_path):
    path = str(tmp_path / "t")
    none = spark.createDataFrame([], "member_id string, x int")
    append_clean(none, path)
    append_clean(none, path)
    assert spark.read.schema("member_id string, x int").parquet(path).count() == 0
