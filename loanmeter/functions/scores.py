"""Weighted components, score and final grade.

All arithmetic is decimal: a score of exactly 2500 must not move across the bound.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanmeter.params import ScoreParams

# Weights of the three components.
PAYMENT_WEIGHT = Decimal("0.20")
DEFAULT_WEIGHT = Decimal("0.45")
FINANCIAL_WEIGHT = Decimal("0.35")

PAYMENT_POINTS = ("last_payment_pts", "total_payment_pts")
DEFAULT_POINTS = (
    "delinq_pts",
    "public_records_pts",
    "public_bankruptcies_pts",
    "enq_pts",
    "hardship_pts",
)
FINANCIAL_POINTS = ("loan_status_pts", "home_pts", "credit_limit_pts", "grade_pts")
COMPONENTS = ("payment_history_pts", "defaulters_history_pts", "financial_health_pts")


def _weighted(points: list[Column], weight: Decimal) -> Column:
    return reduce(add, points) * F.lit(weight)


def payment_history(*points: Column) -> Column:
    return _weighted(list(points), PAYMENT_WEIGHT)


def defaulters_history(*points: Column) -> Column:
    return _weighted(list(points), DEFAULT_WEIGHT)


def financial_health(*points: Column) -> Column:
    return _weighted(list(points), FINANCIAL_WEIGHT)


def loan_score(*components: Column) -> Column:
    return reduce(add, components)


def final_grade(score: Column, params: ScoreParams) -> Column:
    """Bounds belong to the lower grade; no score, no grade."""
    return (
        F.when(score > params.cut_b, params.grade_a)
        .when(score > params.cut_c, params.grade_b)
        .when(score > params.cut_d, params.grade_c)
        .when(score > params.cut_e, params.grade_d)
        .when(score > params.cut_f, params.grade_e)
        .when(score.isNotNull(), params.grade_f)
    )
