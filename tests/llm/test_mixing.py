from collections import defaultdict

import pytest

import loanmeter.llm.source_mixing as mixing
from loanmeter.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import differences, oracle
from tests.llm import plain


def targets(sizes, weights=(1, 2, 3), most=3):
    """Share by weight again and again until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: most * sizes[s] for s in over})


def documents():
    rows = [(i, t, "edge") for i, t in enumerate(plain.EDGE_TEXTS)]
    for i in range(300):
        source = ["big", "big", "small", None, "é", "Zoo"][i % 6] if i % 50 else "tiny"
        rows.append((1000 + i, "w " * (i % 17 + 1), source))
    return rows


@pytest.mark.parametrize("range_rows", [50_000, 7])
def test_sources_come_near_their_targets(spark, monkeypatch, range_rows):
    monkeypatch.setattr(mixing, "RANGE_ROWS", range_rows)
    rows = documents()
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, source string, epochs int")
    found = mixing.mix_sizes(docs).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(plain.words(text))
    expected, taken = targets(sizes), defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - expected[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert len(found) == len(rows)
    assert all(abs(taken[s] - expected[s]) <= 0.5 for s in sizes)
    again = mixing.mix_sizes(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in found)
    # The mixed documents hold just those words.
    words = defaultdict(int)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        words[r.doc_id] += len(plain.words(r.text))
    assert dict(words) == {r.doc_id: r.taken for r in found if r.taken}


def test_nothing_to_mix(spark):
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.mix_sizes(empty).collect()] == [0, 0]
    assert mixing.mixed(empty).count() == 0 and mixing.mix_sizes(empty.limit(0)).count() == 0


@pytest.mark.parametrize(
    "rows",
    [
        [(1, "w " * n, "s") for n in (5, 200, 300)] + [(2, "w", "t")],
        [(1, "a b c d e f g " * 5, "s")] * 20 + [(2, "x " * 900, "t")],
        [(None, "w " * n, "s") for n in (5, 200, 300, 5, 5)] + [(None, None, "s"), (2, "w " * 40, "t"), (2, "w " * 40, "t")],
        [(7, "w " * (n % 4), "s") for n in range(300)] + [(8, "v " * 9, None)] * 50,
    ],
)
def test_repeated_ids_and_rows(spark, rows):
    """The words taken add up to the target within one word, and no row gives more than three times its size."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(plain.words(text))
    expected, taken = targets(sizes), defaultdict(int)
    found = mixing.mix_sizes(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - expected[s]) <= 0.5 for s in sizes)
    again = mixing.mix_sizes(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    words = defaultdict(int)
    for r in mixing.mixed(docs).collect():
        words[r.source] += len(plain.words(r.text))
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in taken.items() if n}


def test_against_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    found, expected, surplus, missing, rows = differences(
        QUERIES["op4_source_mixing"](spark, sf_dir), oracle(sf_dir), ORACLE_SQL["op4_source_mixing"]
    )
    assert found == expected and not surplus and not missing and rows == 1000
