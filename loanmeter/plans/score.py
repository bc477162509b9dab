"""Member scoring: points, components, score and grade.

Point rules that need one table only are computed before the join, so the shuffle carries a few
numbers per row instead of amounts and texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmeter.functions import points, scores
from loanmeter.operators.hot_members import HotMembers, HotPolicy, find_hot_members
from loanmeter.operators.member_join import join_members
from loanmeter.params import ScoreParams

PERSON = ("first_name", "last_name", "state", "country")
PAYMENT_COLUMNS = (
    "member_id", "state", "country", "first_name", "last_name", *scores.PAYMENT_POINTS,
)


class CountedMembers(Protocol):
    def hot_members(self, sides: tuple[str, ...], policy: HotPolicy | None = None) -> tuple[bool, HotMembers | None]:
        """Whether the members were counted, and the hot ones."""


@dataclass(frozen=True)
class ScoreTables:
    """The five cleaned tables the score reads."""

    payments: DataFrame
    customers: DataFrame
    defaulters: DataFrame
    loans: DataFrame
    accounts: DataFrame
    counts: CountedMembers | None = None
    """Hot members by counts that are kept with the tables."""

    def hot_members(self, *names: str, policy: HotPolicy | None = None) -> HotMembers | None:
        """Find the hot members of the named tables: by kept counts, or else by a Spark job over all keys."""
        if self.counts:
            counted, found = self.counts.hot_members(names, policy)
            if counted:
                return found
        return find_hot_members({name: getattr(self, name) for name in names}, policy)


PAYMENT_SIDES = ("payments", "customers")
DEFAULT_SIDES = ("defaulters", *PAYMENT_SIDES)
ALL_SIDES = (*DEFAULT_SIDES, "loans", "accounts")


def payment_points(
    tables: ScoreTables,
    params: ScoreParams = ScoreParams(),
    policy: HotPolicy | None = None,
) -> DataFrame:
    """Payments of known customers with the two payment points."""
    sides = _sides(tables, PAYMENT_SIDES, params)
    hot = tables.hot_members(*PAYMENT_SIDES, policy=policy)
    return join_members(sides, hot, columns=PAYMENT_COLUMNS)


def default_points(
    tables: ScoreTables,
    params: ScoreParams = ScoreParams(),
    policy: HotPolicy | None = None,
) -> DataFrame:
    """Every defaulter row with the payment points of its member and five default points."""
    sides = _sides(tables, DEFAULT_SIDES, params)
    hot = tables.hot_members(*DEFAULT_SIDES, policy=policy)
    return join_members(sides, hot, columns=(*PAYMENT_COLUMNS, *scores.DEFAULT_POINTS))


def financial_points(
    tables: ScoreTables,
    params: ScoreParams = ScoreParams(),
    policy: HotPolicy | None = None,
) -> DataFrame:
    """All eleven points, one row per combination of the member's rows."""
    sides = _sides(tables, ALL_SIDES, params)
    return join_members(
        sides,
        tables.hot_members(*ALL_SIDES, policy=policy),
        finish=lambda joined: joined.withColumns(_financial_points(params)),
        columns=(*PAYMENT_COLUMNS, *scores.DEFAULT_POINTS, *scores.FINANCIAL_POINTS),
    )


def score_components(
    tables: ScoreTables,
    params: ScoreParams = ScoreParams(),
    policy: HotPolicy | None = None,
) -> DataFrame:
    """The three weighted components."""
    return _scored(tables, params, policy, ("member_id", *PERSON, *scores.COMPONENTS))


def loan_scores(
    tables: ScoreTables,
    params: ScoreParams = ScoreParams(),
    policy: HotPolicy | None = None,
) -> DataFrame:
    """The loan score; NULL when any point is NULL."""
    return _scored(tables, params, policy, ("member_id", *PERSON, "loan_score"))


def score_members(
    tables: ScoreTables,
    params: ScoreParams = ScoreParams(),
    policy: HotPolicy | None = None,
) -> DataFrame:
    """The loan score with its letter grade: the table to publish."""
    columns = ("member_id", *PERSON, "loan_score", "loan_final_grade")
    return _scored(tables, params, policy, columns)


def _scored(
    tables: ScoreTables, params: ScoreParams, policy: HotPolicy | None, columns: tuple[str, ...]
) -> DataFrame:
    """Join and score; columns nobody asked for are pruned.

    Payment and default points are summed up before the join: one number per row is shuffled.
    """
    sides = _sides(tables, ALL_SIDES, params)
    payment = scores.payment_history(*map(F.col, scores.PAYMENT_POINTS))
    default = scores.defaulters_history(*map(F.col, scores.DEFAULT_POINTS))
    sides["payments"] = sides["payments"].select("member_id", payment.alias("payment_history_pts"))
    sides["defaulters"] = sides["defaulters"].select("member_id", default.alias("defaulters_history_pts"))

    def finish(joined: DataFrame) -> DataFrame:
        health = scores.financial_health(*_financial_points(params).values())
        score = scores.loan_score(*map(F.col, scores.COMPONENTS))
        grade = scores.final_grade(F.col("loan_score"), params)
        return (
            joined.withColumn("financial_health_pts", health)
            .withColumn("loan_score", score)
            .withColumn("loan_final_grade", grade)
        )

    return join_members(sides, tables.hot_members(*ALL_SIDES, policy=policy), finish, columns)


def _sides(tables: ScoreTables, names: tuple[str, ...], params: ScoreParams) -> dict[str, DataFrame]:
    return {n: getattr(tables, n).select("member_id", *SIDE_COLUMNS[n](params)) for n in names}


def _payment_side(params: ScoreParams) -> list[Column]:
    c = F.col
    last = points.last_payment_points(c("last_payment_amount"), c("installment"), params)
    total = points.total_payment_points(
        c("total_payment_recorded"), c("funded_amount_investor"), params
    )
    return [last.alias("last_payment_pts"), total.alias("total_payment_pts")]


def _customer_side(params: ScoreParams) -> list[Column]:
    return [F.col(name) for name in PERSON]


def _defaulter_side(params: ScoreParams) -> list[Column]:
    c = F.col
    return [
        points.delinquency_points(c("defaulters_2yrs"), params).alias("delinq_pts"),
        points.public_records_points(c("public_records"), params).alias("public_records_pts"),
        points.bankruptcy_points(c("public_records_bankruptcies"), params).alias(
            "public_bankruptcies_pts"
        ),
        points.enquiry_points(c("enquiries_6mnths"), params).alias("enq_pts"),
        points.hardship_points(c("hardship_flag"), params).alias("hardship_pts"),
    ]


def _loan_side(params: ScoreParams) -> list[Column]:
    status = points.loan_status_points(F.col("loan_status"), params)
    return [F.col("funded_amount"), status.alias("loan_status_pts")]


def _account_side(params: ScoreParams) -> list[Column]:
    c = F.col
    return [
        c("total_high_credit_limit"),
        points.home_points(c("home_ownership"), params).alias("owned_home_pts"),
        points.grade_points(c("grade"), c("sub_grade"), params).alias("grade_pts"),
    ]


SIDE_COLUMNS = {
    "payments": _payment_side,
    "customers": _customer_side,
    "defaulters": _defaulter_side,
    "loans": _loan_side,
    "accounts": _account_side,
}


def _financial_points(params: ScoreParams) -> dict[str, Column]:
    """The financial points after the join, in order.

    A member without an account counts like an account with unknown home ownership.
    """
    c = F.col
    no_home = points.home_points(F.lit(None).cast("string"), params)
    return {
        "loan_status_pts": c("loan_status_pts"),
        "home_pts": F.when(c("has_accounts"), c("owned_home_pts")).otherwise(no_home),
        "credit_limit_pts": points.credit_limit_points(
            c("funded_amount"), c("total_high_credit_limit"), params
        ),
        "grade_pts": c("grade_pts"),
    }
