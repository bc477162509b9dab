"""Registered queries: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmeter import (
    TABLES,
    IngestConfig,
    ScoreParams,
    ScoreTables,
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
)
from loanmeter.functions.cleaning import surrogate_key
from loanmeter.operators import filters
from loanmeter.operators.hot_members import HotPolicy
from loanmeter.plans import score
from loanmeter.tables import SCORE_TABLES
from workload import fixtures, oracle
from workload.scratch import scratch_folder


def raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return fixtures.derive(spark, sf_dir, fixtures.RAW[table])


def cleaned(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return clean(raw(spark, sf_dir, table), TABLES[table])


def score_tables(spark: SparkSession, sf_dir: str, source=fixtures.CLEANED) -> ScoreTables:
    return ScoreTables(**{t: fixtures.derive(spark, sf_dir, source[t]) for t in SCORE_TABLES})


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, as gzip files; blanks at the ends of a text are part of it."""
    (
        df.write.option("header", True)
        .option("compression", "gzip")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_lines(lines: DataFrame, header: str, path: str) -> None:
    """Lines as they are, below a header line, so that a row can be too short or too long."""
    (
        lines.toDF(header)
        .write.option("header", True)
        .option("sep", "\u0001")
        .option("quote", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def _scan(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TABLES[table]
    path = scratch_folder(spark, f"scan-{table}")
    lines = fixtures.derive(spark, sf_dir, oracle.FAULTY_LINES[table])
    write_lines(lines, ",".join(c.raw for c in spec.columns), path)
    return read_raw(spark, spec, path)


def landing_reparsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faulty lines are landed with the day; later their dates of two other forms are read as well."""
    spec = TABLES["loans"]
    lines, path = scratch_folder(spark, "reparsed-lines"), scratch_folder(spark, "reparsed-landing")
    write_lines(fixtures.derive(spark, sf_dir, oracle.FAULTY_LINES["loans"]), ",".join(c.raw for c in spec.columns), lines)
    land_snapshot(read_raw(spark, spec, lines, keep_faulty=True), path, "2024-05-01")

    def dates(rows: DataFrame) -> DataFrame:
        forms = [F.try_to_date("issue_date", form) for form in ("yyyy-MM-dd", "dd/MM/yyyy", "MMM-yyyy")]
        return rows.withColumn("issue_date", F.coalesce(*forms))

    return reparse_snapshot(spark, spec, path, "2024-05-01", dates)


def _clean(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir, table).drop("ingest_date")


def ingest_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of a run carry the same time."""
    return cleaned(spark, sf_dir, "accounts").agg(
        F.count("ingest_date").alias("dated_rows"),
        F.count_distinct("ingest_date").alias("dates"),
    )


def surrogate_key_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of rows with missing or "null" parts, per table, next to the raw parts."""
    parts = []
    for name in TABLES:
        spec = TABLES[name]
        rows = raw(spark, sf_dir, name)
        for part in spec.key_parts:
            rows = rows.withColumn(f"part_{part}", F.col(part).cast("string"))
        shown = [F.col(f"part_{p}").alias(f"part_{i}") for i, p in enumerate(spec.key_parts, 1)]
        missing = F.lit(False)
        for p in spec.key_parts:
            missing = missing | F.col(f"part_{p}").isNull() | (F.col(f"part_{p}") == "null")
        whole = surrogate_key(*(F.col(p) for p in spec.key_parts))
        stored = F.col(spec.key)
        kept = rows.where(missing).withColumn("raw_key", whole)
        both = clean(kept, spec).select(stored.alias("stored_key"))
        parts.append(both.groupBy(F.lit(name).alias("source"), "stored_key").count())
        parts.append(
            kept.select("raw_key", *shown)
            .where(F.col("raw_key").isNotNull())
            .groupBy(F.lit(f"{name} raw").alias("source"), F.col("raw_key").alias("stored_key"))
            .count()
        )
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.withColumnRenamed("count", "key_rows")


def landing_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days are landed, then the first again with other rows: both days are read back."""
    spec = TABLES["loans"]
    path = scratch_folder(spark, "landing")
    loans = raw(spark, sf_dir, "loans")
    is_even = F.col("loan_id").cast("bigint") % 2 == 0
    land_snapshot(loans.where(is_even), path, "2024-05-01")
    land_snapshot(loans, path, "2024-05-02")
    land_snapshot(loans.where(~is_even), path, "2024-05-01")
    first, second = (
        read_snapshot(spark, spec, path, day).withColumn("landed_on", F.lit(day))
        for day in ("2024-05-01", "2024-05-02")
    )
    return first.unionByName(second)


def parquet_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TABLES["defaulters"]
    path = scratch_folder(spark, "append")
    rows = cleaned(spark, sf_dir, "defaulters")
    append_clean(rows, path)
    append_clean(rows, path, rebalance=True)
    return read_clean(spark, spec, path).drop("ingest_date")


def _landed_csv(spark: SparkSession, sf_dir: str, name: str) -> IngestConfig:
    root = scratch_folder(spark, name)
    cfg = IngestConfig(f"{root}/raw", f"{root}/landing", f"{root}/cleaned", "2024-05-01")
    for table, spec in TABLES.items():
        write_csv(raw(spark, sf_dir, table), f"{cfg.raw}/{spec.raw_file}")
    return cfg


def ingest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_all(spark, _landed_csv(spark, sf_dir, "ingest"))


def score_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From six CSV files to graded members."""
    cfg = _landed_csv(spark, sf_dir, "score")
    ingest_all(spark, cfg)
    return score.score_members(read_score_tables(spark, cfg.cleaned))


def registered_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the cleaned tables."""
    cfg = _landed_csv(spark, sf_dir, "views")
    ingest_all(spark, cfg)
    register_views(spark, cfg.cleaned)
    return spark.sql("""
        select l.loan_id, l.member_id, l.funded_amount, i.investor_type, i.loan_funded_amount
        from loan_details l join investor_details i on i.loan_id = l.loan_id
    """)


def pts_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.payment_points(score_tables(spark, sf_dir))


def pts_defaulters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.default_points(score_tables(spark, sf_dir))


def pts_financial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.financial_points(score_tables(spark, sf_dir))


def score_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.score_components(score_tables(spark, sf_dir))


def loan_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.loan_scores(score_tables(spark, sf_dir))


def loan_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.score_members(score_tables(spark, sf_dir))


def loan_grade_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores with other points, cuts and letters, set in the session."""
    settings = {f"spark.loanmeter.{name}": str(value) for name, value in oracle.OTHER_PARAMS.items()}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        params = ScoreParams.from_conf(spark)
    finally:
        for name in settings:
            spark.conf.unset(name)
    return score.score_members(score_tables(spark, sf_dir), params)


def _hot(policy: HotPolicy, spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.score_members(score_tables(spark, sf_dir, fixtures.HOT), policy=policy)


# The given tables are small, so the bounds are set low enough to notice.
HOT_BY_ROWS = HotPolicy(most_rows=500, most_output=5_000, max_cells=64)
HOT_BY_PRODUCT = HotPolicy(most_rows=10_000_000, most_output=20_000, max_cells=64)


def payment_exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.payment_exceptions(pts_payment(spark, sf_dir))


def grade_b_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.with_grade(loan_grade(spark, sf_dir), "B")


def published_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Under one name; a repeated run overwrites the table."""
    path = scratch_folder(spark, "published").rpartition("-")[0]
    publish_scores(loan_grade(spark, sf_dir), "member_scores_check", path, mode="overwrite")
    return spark.table("member_scores_check")


def distinct_experience(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employment lengths before and after cleaning."""
    before = filters.distinct_values(raw(spark, sf_dir, "accounts"), "emp_length")
    after = filters.distinct_values(cleaned(spark, sf_dir, "accounts"), "employee_experience")
    return (
        before.toDF("experience").withColumn("stage", F.lit("raw"))
        .unionByName(after.toDF("experience").withColumn("stage", F.lit("cleaned")))
    )


def null_experience(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filters.missing_values(cleaned(spark, sf_dir, "accounts"), "employee_experience")
    return rows.drop("ingest_date")


def loans_36m_over_5pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = cleaned(spark, sf_dir, "loans").drop("ingest_date")
    return filters.loans_by_term_and_interest(loans, 36, 5.0)


QUERIES = {
    "csv_scan_typed": partial(_scan, "payments"),
    **{f"csv_scan_{name}": partial(_scan, name) for name in TABLES if name != "payments"},
    "landing_snapshot": landing_snapshot,
    "landing_reparsed": landing_reparsed,
    "parquet_append_twice": parquet_append_twice,
    **{f"clean_{name}": partial(_clean, name) for name in TABLES},
    "ingest_dates": ingest_dates,
    "surrogate_key_nulls": surrogate_key_nulls,
    "pts_payment": pts_payment,
    "pts_defaulters": pts_defaulters,
    "pts_financial": pts_financial,
    "score_components": score_components,
    "loan_score": loan_score,
    "loan_grade": loan_grade,
    "loan_grade_params": loan_grade_params,
    "loan_grade_hot_member": partial(_hot, HOT_BY_ROWS),
    "loan_grade_hot_product": partial(_hot, HOT_BY_PRODUCT),
    "payment_exceptions": payment_exceptions,
    "grade_b_members": grade_b_members,
    "publish_scores": published_scores,
    "distinct_experience": distinct_experience,
    "null_experience": null_experience,
    "loans_36m_over_5pct": loans_36m_over_5pct,
    "ingest_all": ingest_batch,
    "score_from_csv": score_from_csv,
    "register_views": registered_views,
}
