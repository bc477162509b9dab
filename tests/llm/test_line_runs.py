"""Shared lines against counting, in any number of batches, and the levels of runs."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loanmeter.llm.line_runs import LineRules, LineRuns, batch_lines, without_lines
from loanmeter.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import differences, oracle
from tests.llm import plain

SF = "/root/testdata/sf0.01"
LONG = "This line is long enough to be a key of its own, %s."


def key(line):
    return plain.lower_ascii(line.strip(" \t\n\x0b\x0c\r"))


def plain_lines(rows, least=5, chars=40):
    holders = defaultdict(list)
    for i, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= chars:
                holders[k].append(float("-inf") if i is None else i)
    tops = {k: max(own) for k, own in holders.items() if len(own) >= least}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if tops.get(key(x), i) == i or i is None and tops[key(x)] == float("-inf")]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return out


def found(docs, rules=LineRules()):
    return [tuple(r) for r in without_lines(docs, rules).select("doc.doc_id", "kept", "n_lines", "n_dropped").collect()]


def test_query_against_sql(spark):
    df = QUERIES["op11_line_dedup"](spark, SF)
    a, b, surplus, missing, rows = differences(df, oracle(SF), ORACLE_SQL["op11_line_dedup"])
    assert a == b and not surplus and not missing and rows == 1000
    assert df.where("n_dropped > 0").count() > 50


@pytest.mark.parametrize("rules", [LineRules(), LineRules(batches=1), LineRules(batches=9, fan_in=2), LineRules(most_broadcast=0, salts=3)])
def test_odd_rows(spark, rules):
    """Nulls, equal ids and rows, a line that a third has, white space and case, a long text."""
    a, b, c = (LONG % x for x in "abc")
    rows = [(i, f"own {i}\n {a.upper()}\t\n{b if i % 4 else ''}\nshort") for i in range(30)]
    rows += [(5, c), (5, c), (5, c), (5, c), (6, c + "\n" + c), (6, c), (None, c), (None, a), (7, None), (8, ""), (9, "\n\n")]
    rows += [(10, "\n".join(LONG % i for i in range(5000)) + "\n" + a), (11, "é" * 39), (12, "é" * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    docs = docs.withColumn("line", F.lit("x")).withColumn("kept", F.lit(1)).withColumn("row_hash", F.lit("y"))
    assert sorted(found(docs, rules), key=str) == sorted(plain_lines(rows), key=str)
    kept = without_lines(docs, rules)
    assert kept.select("doc.kept").distinct().count() == 1
    assert found(docs.limit(0), rules) == []


def test_runs_are_compacted(spark):
    docs = spark.createDataFrame([(i, LONG % (i % 7)) for i in range(70)], "doc_id long, text string")
    runs = LineRuns(spark, LineRules(least_docs=4, fan_in=2))
    sizes = []
    for low in range(60, -1, -10):
        batch = batch_lines(docs.where(F.col("doc_id").between(low, low + 9)))
        fresh = runs.unsettled(batch)
        sizes.append(fresh.count())
        runs.add(fresh)
    assert [len(level) for level in runs.levels] == [1, 1, 1]
    # Each line is in 10 documents; after three to five batches it has its four.
    assert sizes[0] == 7 and sizes[-1] == 0
    merged = {bytes(r.line): (r.n, r.top) for r in runs.merged().collect()}
    assert len(merged) == 7 and all(n >= 4 for n, _ in merged.values()) and {top for _, top in merged.values()} == set(range(63, 70))
    assert runs.unsettled(batch_lines(docs)).isEmpty()
    runs.close()


def test_only_lines_never_seen_before(spark):
    runs = LineRuns(spark, LineRules(least_docs=1))
    first = spark.createDataFrame([(1, LONG % "a"), (2, LONG % "b")], "doc_id long, text string")
    second = spark.createDataFrame([(3, f"{LONG % 'a'}\n{LONG % 'c'}")], "doc_id long, text string")
    runs.add(runs.unsettled(batch_lines(first)))
    assert runs.unsettled(batch_lines(second)).count() == 1
    runs.close()
