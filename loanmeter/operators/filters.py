"""Filters and inspection queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmeter.params import ScoreParams


def payment_exceptions(pts: DataFrame, params: ScoreParams = ScoreParams()) -> DataFrame:
    """Payments with a point other than "good". An unknown point passes only with the other."""
    last, total = F.col("last_payment_pts"), F.col("total_payment_pts")
    return pts.where((last != params.good) | (total != params.good))


def with_grade(scores: DataFrame, *grades: str) -> DataFrame:
    return scores.where(F.col("loan_final_grade").isin(*grades))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def missing_values(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def loans_by_term_and_interest(loans: DataFrame, term: int, above: float) -> DataFrame:
    """Cleaned loans of one term above an interest rate.

    Both columns are text; what is not a number matches nothing.
    """
    months = F.col("term").try_cast("bigint")
    rate = F.col("interest").try_cast("double")
    return loans.where((months == term) & (rate > above))
