"""CSV edges, snapshots, appends, publishing and the batch."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from loanmeter import (
    TABLES,
    IngestConfig,
    IngestError,
    append_clean,
    clean,
    ingest_all,
    land_snapshot,
    publish_scores,
    read_clean,
    read_raw,
    read_score_tables,
    read_snapshot,
    register_views,
    reparse_snapshot,
    score_members,
)

HEADERS = {n: ",".join(c.raw for c in s.columns) for n, s in TABLES.items()}


def write(path, table, *lines):
    path.write_text("\n".join([HEADERS[table], *lines]) + "\n")
    return str(path)


def test_csv_edges(spark, tmp_path):
    path = write(
        tmp_path / "d.csv",
        "defaulters",
        "L1,M1,D1,2,1.5,0,0,1,0.0,N,,,",  # blanks are NULL
        "L2, M2,D2,two,1.5,9999999999,3.0,1,x,Y,null,3,250",  # does not fit
        'L3,"",D3',  # short
        "L4,M4,D4,1,1,1,1,1,1,N,T,1,1,surplus,more",  # long
        '"L5, or 6",M5,D5,1,1,1,1,1,1,N,T,1,1',
    )
    rows = read_raw(spark, TABLES["defaulters"], path).orderBy("loan_id").collect()
    assert [r.loan_id for r in rows] == ["L1", "L2", "L3", "L4", "L5, or 6"]
    first, second, third, fourth, _ = rows
    assert (first.delinq_2yrs, first.hardship_type, first.hardship_length, first.hardship_amount) == (2, None, None, None)
    assert (second.mem_id, second.delinq_2yrs, second.pub_rec, second.pub_rec_bankruptcies) == (" M2", None, None, None)
    assert (second.total_rec_late_fee, second.hardship_type, second.hardship_length) == (None, "null", 3)
    assert tuple(third) == ("L3", None, "D3") + (None,) * 10
    assert fourth.hardship_amount == 1.0


def test_csv_dates_and_names(spark, tmp_path):
    """Dates are ISO or NULL; columns bind by position, not by header name."""
    path = tmp_path / "p.csv"
    names = HEADERS["payments"].replace("loan_id", "other_name")
    path.write_text(f"{names}\nL,M,T,1,1,1,1,2024-02-29,Feb-2024,ACH\nL,M,T,1,1,1,1,31/12/2024,2024-02-30,ACH\n")
    dates = read_raw(spark, TABLES["payments"], str(path)).select("loan_id", "last_pymnt_d", "next_pymnt_d").collect()
    assert [tuple(r) for r in dates] == [("L", date(2024, 2, 29), None), ("L", None, None)]


def test_csv_is_read_with_the_needed_columns_only(spark, tmp_path):
    path = write(tmp_path / "c.csv", "customers", "1,M,a,b,TRUE,30,NY,US")
    plan = read_raw(spark, TABLES["customers"], path).select("mem_id")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<mem_id:string>" in plan


def investors(spark, *ids):
    return spark.createDataFrame(
        [(i, "L", "I", 1.0, "T", 1, "s", "c") for i in ids], TABLES["investors"].raw_schema
    )


def test_snapshot_replaces_its_day_only(spark, tmp_path):
    spec, path = TABLES["investors"], str(tmp_path / "landing")
    land_snapshot(investors(spark, "a", "b"), path, "2024-01-01")
    land_snapshot(investors(spark, "c"), path, date(2024, 1, 2))
    land_snapshot(investors(spark, "d"), path, "2024-01-01")
    first = read_snapshot(spark, spec, path, "2024-01-01")
    second = read_snapshot(spark, spec, path, date(2024, 1, 2))
    assert first.columns == [c.raw for c in spec.columns]
    assert [r[0] for r in first.collect()] == ["d"]
    assert [r[0] for r in second.collect()] == ["c"]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_append_twice_doubles(spark, tmp_path):
    spec, path = TABLES["investors"], str(tmp_path / "clean")
    cleaned = clean(investors(spark, "a", "b"), spec)
    append_clean(cleaned, path)
    append_clean(cleaned, path, rebalance=True)
    back = read_clean(spark, spec, path)
    assert back.columns == spec.clean_columns
    assert back.count() == 4 and back.select("investor_key").distinct().count() == 2


def test_publish(spark, tmp_path):
    scores = spark.createDataFrame([("1", "A")], "member_id string, loan_final_grade string")
    path = str(tmp_path / "scores")
    spark.sql("create database if not exists scoring")
    publish_scores(scores, "scoring.member_scores", path)
    with pytest.raises(AnalysisException):
        publish_scores(scores, "scoring.member_scores", path)
    publish_scores(scores.withColumn("loan_final_grade", F.lit("B")), "scoring.member_scores", path, mode="overwrite")
    assert spark.table("scoring.member_scores").first().loan_final_grade == "B"
    kind = spark.sql("describe extended scoring.member_scores").where("col_name = 'Type'").first()
    assert kind.data_type == "EXTERNAL"
    spark.sql("drop table scoring.member_scores")
    assert spark.read.parquet(path).count() == 1


@pytest.fixture
def cfg(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    lines = {
        "accounts": ["A1,M1,L1,A,A1,Clerk,10+ years,OWN,50000,Verified,100000,Individual,,null"],
        "customers": ["C1,M1,Ann,Lee,TRUE,40,NY,US", "C2,M2,Bob,Roe,null,41,NY,US"],
        "defaulters": ["L1,M1,D1,0,0,0,0,0,0,N,null,,", "L2,M2,D2,0,0,0,0,0,0,N,null,,"],
        "investors": ["I1,L1,V1,1000,Bank,50,NY,US"],
        "loans": ["L1,M1,A1,10000,10000, 36 months,5.5%,300,2024-01-01,Fully Paid,car,Car,Cash"],
        "payments": ["L1,M1,T1,10000,9000,300,600,2024-02-01,2024-03-01,ACH"],
    }
    for name, rows in lines.items():
        write(raw / TABLES[name].raw_file, name, *rows)
    return IngestConfig(str(raw), str(tmp_path / "landing"), str(tmp_path / "cleaned"), "2024-05-01")


def test_batch_and_score(spark, cfg):
    status = [tuple(r) for r in ingest_all(spark, cfg).collect()]
    assert status == [
        ("customers", 2, "Success"),
        ("loans", 1, "Success"),
        ("accounts", 1, "Success"),
        ("defaulters", 2, "Success"),
        ("payments", 1, "Success"),
        ("investors", 1, "Success"),
    ]
    rows = score_members(read_score_tables(spark, cfg.cleaned)).collect()
    found = {r.member_id: (r.first_name, r.loan_score, r.loan_final_grade) for r in rows}
    assert found.keys() == {"M1", None}
    assert found["M1"][0] == "Ann" and float(found["M1"][1]) == 3142.5 and found["M1"][2] == "A"
    assert found[None] == (None, None, None)

    register_views(spark, cfg.cleaned)
    assert spark.sql("select count(*) from loan_defaulters where hardship_type is null").first()[0] == 2

    # The same day again: the snapshot is replaced, the cleaned rows are appended.
    ingest_all(spark, cfg)
    assert spark.read.parquet(f"{cfg.landing}/loan_details").count() == 1
    assert spark.read.parquet(f"{cfg.cleaned}/loan_details").count() == 2
    again = score_members(read_score_tables(spark, cfg.cleaned))
    # Two rows of each of five tables make 2^5 combinations; the unmatched row is there twice.
    assert again.where("member_id = 'M1'").count() == 32
    assert again.where("member_id is null").count() == 2


def test_failing_table_leaves_the_others_done(spark, cfg, tmp_path):
    (tmp_path / "raw" / TABLES["accounts"].raw_file).unlink()
    with pytest.raises(IngestError) as failed:
        ingest_all(spark, cfg)
    assert isinstance(failed.value.__cause__, AnalysisException)
    assert {name: (rows, said) for name, rows, said in failed.value.status} == {
        "customers": (2, "Success"), "loans": (1, "Success"), "accounts": (None, "AnalysisException"),
        "defaulters": (2, "Success"), "payments": (1, "Success"), "investors": (1, "Success"),
    }


def test_a_bad_date_is_parsed_anew_from_the_landing(spark, tmp_path):
    """The reader and the snapshot lose nothing: a line that did not fit comes back, whole lines are left as they were."""
    spec = TABLES["loans"]
    names = [c.raw for c in spec.columns]
    good = '1,m,a,5.5,5,36,1%,7,2018-01-31,Current,p,"t, u",Cash'
    lines = [",".join(names), good, good.replace("2018-01-31", "31.1.2018"), good.replace("5.5", "5;5"), "2,m", good + ",more"]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    landed = str(tmp_path / "landed")
    land_snapshot(read_raw(spark, spec, str(tmp_path / "in.csv"), keep_faulty=True), landed, "2024-01-01")
    plain = read_snapshot(spark, spec, landed, "2024-01-01")
    assert plain.columns == names and plain.where("issue_date is null").count() == 2
    unchanged = reparse_snapshot(spark, spec, landed, "2024-01-01")
    assert sorted(map(str, unchanged.collect())) == sorted(map(str, plain.collect()))

    def fix(rows):
        day = F.coalesce(F.try_to_date("issue_date", "d.M.yyyy"), F.try_to_date("issue_date", "yyyy-MM-dd"))
        return rows.withColumns({"issue_date": day, "loan_amt": F.replace("loan_amt", F.lit(";"), F.lit("."))})

    fixed = reparse_snapshot(spark, spec, landed, "2024-01-01", fix)
    assert fixed.columns == names and dict(fixed.dtypes) == dict(plain.dtypes)
    assert fixed.where("issue_date = date'2018-01-31' and loan_amt = 5.5 and title = 't, u'").count() == 4
    assert fixed.where("loan_id = '2' and issue_date is null").count() == 1
    # Days landed before the column existed are read as well.
    land_snapshot(read_raw(spark, spec, str(tmp_path / "in.csv")), landed, "2024-01-02")
    assert reparse_snapshot(spark, spec, landed, "2024-01-02").count() == read_snapshot(spark, spec, landed, "2024-01-02").count() == 5


def test_snapshots_and_cleaned_files_are_zstd(spark, tmp_path):
    loans = spark.createDataFrame([("1", "2", "3")], "loan_id string, mem_id string, acc_id string")
    land_snapshot(loans, str(tmp_path / "landing"), "2024-05-01")
    append_clean(loans, str(tmp_path / "plain"))
    append_clean(loans.withColumnRenamed("mem_id", "member_id"), str(tmp_path / "members"))
    for pattern in ("landing/*/*.parquet", "plain/*.parquet", "members/*.parquet"):
        assert {x.name.endswith(".zstd.parquet") for x in tmp_path.glob(pattern)} == {True}
