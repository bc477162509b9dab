"""The eleven point rules.

Every rule is a chain of built-in expressions, so it runs inside whole-stage codegen. A rule
gives NULL for any value it does not name, and one NULL voids the member's score: do not add
defaults.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanmeter.params import ScoreParams

# Shares of the installment, of the funded amount and of the credit limit.
HALF = 0.5
ONE_AND_A_HALF = 1.5
LIMIT_SHARES = (
    (0.10, "excellent"),
    (0.20, "very_good"),
    (0.30, "good"),
    (0.50, "bad"),
    (0.70, "very_bad"),
)

# Phrases looked for in the lower-cased loan status, first match wins.
STATUS_PHRASES = (
    ("fully paid", "excellent"),
    ("current", "good"),
    ("in grace period", "bad"),
    ("late (16-30 days)", "very_bad"),
    ("late (31-120 days)", "very_bad"),
    ("charged off", "unacceptable"),
)

# Phrases looked for in the lower-cased home ownership, first match wins.
HOME_PHRASES = (
    ("own", "excellent"),
    ("rent", "good"),
    ("mortgage", "bad"),
    ("any", "very_bad"),
)

# Rating per loan grade, and the share of it kept by each sub-grade digit.
GRADE_RATINGS = {
    "A": "excellent",
    "B": "very_good",
    "C": "good",
    "D": "bad",
    "E": "very_bad",
    "F": "unacceptable",
    "G": "unacceptable",
}
SUB_GRADE_SHARES = {"1": "1.00", "2": "0.80", "3": "0.60", "4": "0.40", "5": "0.20"}
GRADE_POINTS_TYPE = "decimal(12,2)"


def _chain(*branches: tuple[Column, object]) -> Column:
    """CASE without ELSE."""
    condition, value = branches[0]
    out = F.when(condition, value)
    for condition, value in branches[1:]:
        out = out.when(condition, value)
    return out


def _phrases(text: Column, phrases, params: ScoreParams) -> list[tuple[Column, int]]:
    low = F.lower(text)
    return [(low.contains(phrase), getattr(params, rating)) for phrase, rating in phrases]


def last_payment_points(paid: Column, installment: Column, params: ScoreParams) -> Column:
    """Last payment against the installment; the only rule with a catch-all, which takes NULLs."""
    return _chain(
        (paid < installment * HALF, params.very_bad),
        (paid < installment, params.bad),
        (paid == installment, params.good),
        (paid <= installment * ONE_AND_A_HALF, params.very_good),
        (paid > installment * ONE_AND_A_HALF, params.excellent),
    ).otherwise(params.unacceptable)


def total_payment_points(total: Column, funded: Column, params: ScoreParams) -> Column:
    """All payments against the funded amount.

    NULL when a negative total stays below the half, or nothing is known about the funding.
    """
    half = funded * HALF
    return _chain(
        (total.isNull(), params.unacceptable),
        (total >= half, params.very_good),
        (total == 0, params.unacceptable),
        ((total > 0) & half.isNotNull(), params.good),
    )


def incident_points(count: Column, params: ScoreParams, many: int | None = None) -> Column:
    """Number of incidents; ``many`` is given for more than five and for an unknown number."""
    many = params.unacceptable if many is None else many
    return _chain(
        (count.isNull() | (count > 5), many),
        (count >= 3, params.very_bad),
        (count >= 1, params.bad),
        (count == 0, params.excellent),
    )


def delinquency_points(count: Column, params: ScoreParams) -> Column:
    return incident_points(count, params)


def public_records_points(count: Column, params: ScoreParams) -> Column:
    """Unlike its siblings this rule is mild on many or unknown records."""
    return incident_points(count, params, many=params.very_bad)


def bankruptcy_points(count: Column, params: ScoreParams) -> Column:
    return incident_points(count, params)


def enquiry_points(count: Column, params: ScoreParams) -> Column:
    return incident_points(count, params)


def hardship_points(flag: Column, params: ScoreParams) -> Column:
    return _chain(
        (flag == "N", params.very_good),
        (flag.isNull() | (flag == "Y"), params.bad),
    )


def loan_status_points(status: Column, params: ScoreParams) -> Column:
    return _chain(*_phrases(status, STATUS_PHRASES, params))


def home_points(ownership: Column, params: ScoreParams) -> Column:
    return _chain(
        (ownership.isNull(), params.very_bad),
        *_phrases(ownership, HOME_PHRASES, params),
    )


def credit_limit_points(funded: Column, limit: Column, params: ScoreParams) -> Column:
    """Funded amount as a share of the credit limit."""
    top_share = LIMIT_SHARES[-1][0]
    return _chain(
        *((funded <= limit * share, getattr(params, rating)) for share, rating in LIMIT_SHARES),
        (funded > limit * top_share, params.unacceptable),
    )


def grade_points(grade: Column, sub_grade: Column, params: ScoreParams) -> Column:
    """Points of the loan grade, cut down by the digit of the sub-grade.

    The sub-grade must carry the letter of its grade; F and G count as one letter.
    """
    letter = F.substring(sub_grade, 1, 1)
    digit = F.substr(sub_grade, F.lit(2))
    rating = _chain(*((grade == g, getattr(params, r)) for g, r in GRADE_RATINGS.items()))
    share = _chain(*((digit == d, Decimal(s)) for d, s in SUB_GRADE_SHARES.items()))
    same = F.translate(letter, "G", "F") == F.translate(grade, "G", "F")
    return F.when(same, (rating * share).cast(GRADE_POINTS_TYPE))
