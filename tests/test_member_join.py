"""The member join: specified multiplicities, hot members, and the shape of its plan."""

import re
from collections import Counter
from itertools import product

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loanmeter import ScoreTables, score_members
from loanmeter.operators.hot_members import HotPolicy, cut_side, find_hot_members, fold, hot_table, member_rows, unfold
from loanmeter.operators.member_join import join_members

SIDES = ("defaulters", "payments", "customers", "loans", "accounts")
EAGER = HotPolicy(most_rows=3, most_output=4, max_cells=16)
MEMBERS = ("a", "b", "c", None)


def frames(spark, data, sides=SIDES):
    return {
        s: spark.createDataFrame([(m, v) for m, v in data[s]], f"member_id string, {s}_value int") for s in sides
    }


def expected(data, sides=SIDES):
    """Nested loops over Python lists."""
    paid = [
        (m, p, c)
        for (m, p), (n, c) in product(data["payments"], data["customers"])
        if m is not None and m == n
    ]
    if "defaulters" not in sides:
        return Counter(paid)
    out = []
    for member, d in data["defaulters"]:
        for row in [r for r in paid if r[0] == member] or [(None, None, None)]:
            parts = []
            for name in ("loans", "accounts"):
                if name in sides:
                    own = [v for m, v in data[name] if m is not None and m == row[0]]
                    parts.append([(v, True) for v in own] or [(None, False)])
            for rest in product(*parts):
                out.append((*row, d, *(x for part in rest for x in part)))
    return Counter(out)


def found(df, sides=SIDES):
    names = ["member_id", "payments_value", "customers_value"]
    if "defaulters" in sides:
        names.append("defaulters_value")
    for name in ("loans", "accounts"):
        if name in sides:
            names += [f"{name}_value", f"has_{name}"]
    return Counter(tuple(r) for r in df.select(*names).collect())


EXAMPLE = {
    "defaulters": [("a", 1), ("a", 1), ("b", 2), ("x", 3), (None, 4), (None, 4), ("d", 5)],
    "payments": [("a", 1), ("a", 1), ("a", 2), ("b", 3), (None, 4), ("e", 5), ("d", 6)],
    "customers": [("a", 1), ("b", 2), ("b", 2), (None, 3), ("e", 4)],
    "loans": [("a", 1), ("a", 2), ("x", 3), (None, 4)],
    "accounts": [("b", 1), ("b", None), ("x", 3), (None, 4)],
}


@pytest.mark.parametrize("count", [2, 3, 4, 5])
def test_join_without_hot_members(spark, count):
    sides = ("payments", "customers") if count == 2 else SIDES[:count]
    assert found(join_members(frames(spark, EXAMPLE, sides)), sides) == expected(EXAMPLE, sides)


def test_two_of_everything(spark):
    data = {s: [("m", 1), ("m", 2)] for s in SIDES}
    assert join_members(frames(spark, data)).count() == 2**5


def many(spark, hot_side, sides=SIDES):
    """One member with a third of all rows of one side: some equal, some not."""
    data = {s: [(str(i), i) for i in range(40)] for s in SIDES}
    data[hot_side] = data[hot_side] + [("7", i % 9) for i in range(20)]
    data["defaulters"] = data["defaulters"] + [("nobody", 1)] * 6
    data["payments"] = data["payments"] + [("unknown", 1)] * 6
    return data


@pytest.mark.parametrize("hot_side", SIDES)
def test_one_hot_side(spark, hot_side):
    data = many(spark, hot_side)
    sides = frames(spark, data)
    hot = find_hot_members(sides, EAGER)
    assert {r.member_id: r[f"{hot_side}_cuts"] > 1 for r in hot.table.collect()}["7"]
    assert found(join_members(sides, hot)) == expected(data)


def test_hot_member_of_two_sides_only(spark):
    data = many(spark, "payments")
    sides = frames(spark, data, ("payments", "customers"))
    hot = find_hot_members(sides, EAGER)
    assert hot
    assert found(join_members(sides, hot), hot.sides) == expected(data, hot.sides)


def test_hot_members_with_missing_sides(spark):
    """Hot, but unknown to some side: unmatched rows appear once, not once per cell."""
    hot = [(m, v % 4) for m in "pqrs" for v in range(12)]
    data = {s: list(hot) for s in SIDES}
    data["defaulters"] = [(m, v) for m in "pqrst" for v in range(4)] + [("t", 9)] * 8
    data["customers"] = [(m, 1) for m in "qrs"]
    data["payments"] = [(m, v) for m, v in hot if m != "q"]
    data["loans"] = [(m, v) for m, v in hot if m != "r"]
    data["accounts"] = [(m, v) for m, v in hot if m == "p"] + [("s", 1)] * 4
    sides = frames(spark, data)
    members = find_hot_members(sides, EAGER)
    assert {r.member_id for r in members.table.collect()} == set("pqrst")
    assert found(join_members(sides, members)) == expected(data)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.data())
def test_any_data_any_cells(spark, data):
    rows = st.lists(st.tuples(st.sampled_from(MEMBERS), st.integers(0, 2)), max_size=9)
    tables = {s: data.draw(rows, label=s) for s in SIDES}
    policy = HotPolicy(
        most_rows=data.draw(st.integers(1, 4)),
        most_output=data.draw(st.integers(1, 10)),
        max_cells=data.draw(st.integers(1, 20)),
        most_broadcast=data.draw(st.integers(0, 1)),
    )
    sides = frames(spark, tables)
    assert found(join_members(sides, find_hot_members(sides, policy))) == expected(tables)


def cuts(spark, counts, policy):
    """The row of one hot member with the given numbers of rows, or None."""
    sides = tuple(counts)
    rows = spark.createDataFrame([("m", *counts.values())], "member_id string, " + ", ".join(f"{s}_rows long" for s in sides))
    found = hot_table(rows, sides, policy).collect()
    return found[0].asDict() if found else None


def test_rows_are_counted_exactly(spark):
    sides = frames(spark, {"payments": [("a", 1)] * 5 + [("b", 1)] * 2 + [(None, 1)] * 9, "customers": [("a", 1)]},
                   ("payments", "customers"))
    assert {tuple(r) for r in member_rows(sides).collect()} == {("a", 5, 1), ("b", 2, 0)}
    assert find_hot_members(sides) is None


def test_hot_by_product(spark):
    """Two sides below the bound on rows, their product above the bound on output; tables may be of any size."""
    policy = HotPolicy(most_rows=1_000, most_output=100_000)
    counts = {"defaulters": 1, "payments": 900, "customers": 1, "loans": 900, "accounts": 2}
    row = cuts(spark, counts, policy)
    assert row["cells"] >= 900 * 900 * 2 / policy.most_output
    assert cuts(spark, counts | {"loans": 10}, policy) is None
    data = {s: [(str(i), i) for i in range(30)] for s in SIDES}
    data["payments"] = data["payments"] + [("7", i) for i in range(11)]
    data["loans"] = data["loans"] + [("7", i) for i in range(11)]
    sides = frames(spark, data)
    hot = find_hot_members(sides, HotPolicy(most_rows=50, most_output=40))
    assert [r.member_id for r in hot.table.collect()] == ["7"]
    assert found(join_members(sides, hot)) == expected(data)


def test_cells_cover_all_combinations(spark):
    row = cuts(spark, {"defaulters": 3, "payments": 9, "customers": 1, "loans": 5, "accounts": 0}, EAGER)
    strides = [(row[f"{s}_stride"], row[f"{s}_cuts"]) for s in SIDES]
    cells = {sum(i * stride for i, (stride, _) in zip(at, strides)) for at in product(*(range(c) for _, c in strides))}
    assert cells == set(range(row["cells"]))


def test_unfold(spark):
    times = {"a": 1, "b": 25_003, "c": 10_000}
    df = spark.createDataFrame([(v,) for v, n in times.items() for _ in range(n)], "v string")
    folded = fold(df, "n")
    assert sorted(r.n for r in folded.collect()) == [1, 5_003, 10_000, 10_000, 10_000]
    assert {r.v: r["count"] for r in unfold(folded, "n").groupBy("v").count().collect()} == times


@pytest.fixture
def plain_plans(spark):
    """Plans as for tables too large to broadcast."""
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def test_each_table_is_shuffled_once(spark, tmp_path, plain_plans):
    columns = {
        "payments": "member_id string, funded_amount_investor double, total_payment_recorded float, "
        "installment float, last_payment_amount float, other string",
        "customers": "member_id string, first_name string, last_name string, state string, country string, age int",
        "defaulters": "member_id string, defaulters_2yrs int, public_records int, "
        "public_records_bankruptcies int, enquiries_6mnths int, hardship_flag string, other string",
        "loans": "member_id string, funded_amount double, loan_status string, other string",
        "accounts": "member_id string, grade string, sub_grade string, home_ownership string, "
        "total_high_credit_limit float, other string",
    }
    tables = {}
    for name, schema in columns.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
        tables[name] = spark.read.schema(schema).parquet(str(tmp_path / name))
    plan = score_members(ScoreTables(**tables))._jdf.queryExecution().executedPlan().toString()
    # Payments twice: folded by member and points, then joined; what is shuffled the second time is small.
    assert plan.count("Exchange hashpartitioning") == 6
    assert plan.count("Sort [") == 5
    assert plan.count("SortMergeJoin") == 4
    assert "other" not in plan and "age#" not in plan
    assert "PushedFilters: [IsNull(member_id)], ReadSchema: struct<member_id:string>" in plan


def test_cuts_are_balanced(spark):
    """Copies stay few: two equally large sides are cut alike, a small one not at all."""
    counts = {"payments": 1_000_000, "customers": 1, "defaulters": 1, "loans": 1_000_000, "accounts": 40}
    row = cuts(spark, counts, HotPolicy())
    assert row["payments_cuts"] / row["loans_cuts"] in (0.5, 1, 2)
    assert row["payments_cuts"] * row["loans_cuts"] >= 10_000
    assert (row["customers_cuts"], row["defaulters_cuts"], row["accounts_cuts"]) == (1, 1, 1)


def test_cells_do_not_depend_on_row_order(spark):
    """A task that runs again on rows in another order sends them to the same cells."""
    rows = [("a", v % 7) for v in range(60)] + [("b", v) for v in range(30)] + [("c", 1)]
    seen = []
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "member_id string, loans_value int").repartition(3)
        sides = frames(spark, {s: [(m, 1) for m in "ab"] for s in SIDES}) | {"loans": df}
        hot = find_hot_members(sides, EAGER)
        seen.append(Counter(tuple(r) for r in cut_side(df, "loans", hot).collect()))
    assert seen[0] == seen[1]


def test_payments_are_folded_before_they_are_shuffled(spark, plain_plans):
    plan = join_members(frames(spark, EXAMPLE))._jdf.queryExecution().executedPlan().toString()
    partial = [line for line in plan.splitlines() if "HashAggregate" in line and "partial_count" in line]
    assert len(partial) == 1 and "payments_value" in partial[0]
    # One generator over joined rows, one over the folded payments.
    assert plan.count("Generate ") == 2


def test_hot_members_take_the_same_plan(spark, tmp_path, plain_plans):
    """One scan of each table, and of defaulters one more for rows without a member."""
    data = many(spark, "payments")
    for name, df in frames(spark, data).items():
        df.write.parquet(str(tmp_path / name))
    sides = {s: spark.read.parquet(str(tmp_path / s)) for s in SIDES}
    hot = find_hot_members(sides, EAGER)
    joined = join_members(sides, hot)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"(?<!InMemory)Relation \[", plan)) == len(SIDES) + 1
    assert found(joined) == expected(data)


def test_output_of_a_hot_member_is_dealt_to_all_tasks(spark, tmp_path):
    """Few rows are joined, many come out: no task makes most of them."""
    n = {"payments": 2000, "customers": 1, "defaulters": 1, "loans": 1000, "accounts": 1}
    extra = {
        "payments": "100.0D funded_amount_investor, float(100) total_payment_recorded, float(10) installment, float(10) last_payment_amount",
        "customers": "'a' first_name, 'b' last_name, 'c' state, 'd' country",
        "defaulters": "0 defaulters_2yrs, 0 public_records, 0 public_records_bankruptcies, 0 enquiries_6mnths, 'N' hardship_flag",
        "loans": "id * 1.0D funded_amount, 'Current' loan_status",
        "accounts": "'A' grade, 'A1' sub_grade, 'OWN' home_ownership, float(1e6) total_high_credit_limit",
    }
    tables = {name: spark.sql(f"select 'h' member_id, {extra[name]} from range({n[name]})") for name in n}
    scores = score_members(ScoreTables(**tables), policy=HotPolicy(most_rows=500, most_output=5_000, max_cells=64))
    made = [r["count"] for r in scores.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(made) == 2_000_000 and max(made) < 1_000_000
