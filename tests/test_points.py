"""Each point rule on literal rows: every branch, every bound, every NULL."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loanmeter.functions import points, scores
from loanmeter.params import ScoreParams

P = ScoreParams()
U, VB, B, G, VG, X = 0, 100, 250, 500, 650, 800
NAN = float("nan")


def evaluate(spark, types, rows, build):
    """The rule's value for each literal row, in order."""
    names = [f"c{i}" for i in range(len(types))]
    schema = "n int, " + ", ".join(f"{n} {t}" for n, t in zip(names, types))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
    out = df.select("n", build(*map(F.col, names)).alias("v")).collect()
    return [r.v for r in sorted(out, key=lambda r: r.n)]


def check(spark, types, cases, build):
    rows = [c[0] if isinstance(c[0], tuple) else (c[0],) for c in cases]
    found = evaluate(spark, types, rows, build)
    wrong = [(row, v, e) for row, v, (_, e) in zip(rows, found, cases) if v != e]
    assert not wrong


def test_last_payment(spark):
    cases = [
        ((49.0, 100.0), VB), ((50.0, 100.0), B), ((99.0, 100.0), B), ((100.0, 100.0), G),
        ((101.0, 100.0), VG), ((150.0, 100.0), VG), ((151.0, 100.0), X),
        ((None, 100.0), U), ((50.0, None), U), ((None, None), U), ((0.0, 0.0), G),
        ((-1.0, 0.0), VB), ((1.0, 0.0), X), ((0.0, -10.0), X), ((-7.0, -10.0), VB),
        ((NAN, 100.0), X), ((100.0, NAN), VB),
    ]
    check(spark, ["float", "float"], cases, lambda a, b: points.last_payment_points(a, b, P))


def test_total_payment(spark):
    cases = [
        ((0.0, 100.0), U), ((None, 100.0), U), ((None, None), U), ((0.0, None), U),
        ((50.0, 100.0), VG), ((49.5, 100.0), G), ((0.5, 100.0), G), ((-1.0, 100.0), None),
        ((5.0, None), None), ((-5.0, None), None), ((0.0, 0.0), VG), ((0.0, -2.0), VG), ((-1.0, -2.0), VG),
        ((-3.0, -2.0), None),
    ]
    check(spark, ["float", "double"], cases, lambda a, b: points.total_payment_points(a, b, P))


@pytest.mark.parametrize(
    "rule, many",
    [
        (points.delinquency_points, U),
        (points.public_records_points, VB),
        (points.bankruptcy_points, U),
        (points.enquiry_points, U),
    ],
)
def test_incidents(spark, rule, many):
    cases = [(-1, None), (0, X), (1, B), (2, B), (3, VB), (4, VB), (5, VB), (6, many), (99, many), (None, many)]
    check(spark, ["int"], cases, lambda n: rule(n, P))


def test_hardship_is_case_sensitive(spark):
    cases = [("N", VG), ("Y", B), (None, B), ("n", None), ("y", None), ("U", None), ("", None)]
    check(spark, ["string"], cases, lambda c: points.hardship_points(c, P))


def test_loan_status(spark):
    cases = [
        ("Fully Paid", X), ("CURRENT", G), ("In Grace Period", B), ("Late (16-30 days)", VB),
        ("LATE (31-120 DAYS)", VB), ("Charged Off", U), ("Default", None), (None, None), ("", None),
        ("Does not meet the credit policy. Status:Fully Paid", X), ("current, once charged off", G),
        ("Late 16-30 days", None),
    ]
    check(spark, ["string"], cases, lambda c: points.loan_status_points(c, P))


def test_home(spark):
    cases = [
        ("OWN", X), ("Own", X), ("Rent", G), ("mortgage", B), ("ANY", VB), (None, VB), ("NONE", None),
        ("OTHER", None), ("", None), ("own or rent", X),
    ]
    check(spark, ["string"], cases, lambda c: points.home_points(c, P))


def test_credit_limit(spark):
    cases = [
        ((100.0, 1000.0), X), ((100.01, 1000.0), VG), ((200.0, 1000.0), VG), ((200.01, 1000.0), G),
        ((300.0, 1000.0), G), ((300.01, 1000.0), B), ((500.0, 1000.0), B), ((500.01, 1000.0), VB),
        ((700.0, 1000.0), VB), ((700.01, 1000.0), U), ((1.0, None), None), ((None, 1000.0), None),
        ((0.0, 0.0), X), ((1.0, 0.0), U), ((-1.0, 0.0), X),
    ]
    check(spark, ["double", "float"], cases, lambda a, b: points.credit_limit_points(a, b, P))


def test_grades(spark):
    base = {"A": 800, "B": 650, "C": 500, "D": 250, "E": 100, "F": 0, "G": 0}
    cases = []
    for grade in base:
        for letter in base:
            for digit in range(0, 7):
                fits = grade == letter or {grade, letter} <= {"F", "G"}
                value = Decimal(base[grade]) * (6 - digit) / 5 if fits and 1 <= digit <= 5 else None
                cases.append(((grade, f"{letter}{digit}"), value))
    cases += [
        (("a", "a1"), None), (("A", "a1"), None), ((None, "A1"), None), (("A", None), None), (("A", "A"), None),
        (("A", "A11"), None), (("A", "A1 "), None), (("A", " A1"), None), (("", ""), None), (("H", "H1"), None),
    ]
    assert sum(value is not None for _, value in cases) == 45
    check(spark, ["string", "string"], cases, lambda a, b: points.grade_points(a, b, P))


def test_final_grade_bounds(spark):
    cases = [
        ("750", "F"), ("750.0001", "E"), ("1000", "E"), ("1000.0001", "D"), ("1500", "D"), ("1500.0001", "C"),
        ("2000", "C"), ("2000.0001", "B"), ("2500", "B"), ("2500.0001", "A"), ("-1", "F"), (None, None),
    ]
    cases = [(Decimal(v) if v else None, g) for v, g in cases]
    check(spark, ["decimal(17,4)"], cases, lambda c: scores.final_grade(c, P))


def test_weights_and_null(spark):
    def total(*c):
        return scores.loan_score(
            scores.payment_history(*c[:2]),
            scores.defaulters_history(*c[2:7]),
            scores.financial_health(*c[7:]),
        )

    types = ["int"] * 10 + ["decimal(12,2)"]
    best = (800, 650, 800, 800, 800, 800, 650, 800, 800, 800, Decimal("800.00"))
    cases = [(best, Decimal("3142.5000"))]
    cases += [(best[:i] + (None,) + best[i + 1 :], None) for i in range(11)]
    check(spark, types, cases, total)


def test_other_parameters(spark):
    params = ScoreParams(good=510, grade_a="AA", cut_b=2400)
    check(spark, ["float", "float"], [((1.0, 1.0), 510)], lambda a, b: points.last_payment_points(a, b, params))
    cases = [(Decimal("2450"), "AA"), (Decimal("2400"), "B")]
    check(spark, ["decimal(17,4)"], cases, lambda c: scores.final_grade(c, params))


def test_parameters_from_session(spark):
    spark.conf.set("spark.loanmeter.good", "510")
    spark.conf.set("spark.loanmeter.grade_f", "Z")
    try:
        assert ScoreParams.from_conf(spark) == ScoreParams(good=510, grade_f="Z")
    finally:
        spark.conf.unset("spark.loanmeter.good")
        spark.conf.unset("spark.loanmeter.grade_f")
    assert ScoreParams.from_conf(spark) == ScoreParams()


def test_unknown_parameter_is_an_error(spark):
    spark.conf.set("spark.loanmeter.goood", "520")
    try:
        with pytest.raises(ValueError, match="goood"):
            ScoreParams.from_conf(spark)
    finally:
        spark.conf.unset("spark.loanmeter.goood")
