import random

import numpy as np
import pytest

from loanmeter.llm.components import components
from loanmeter.llm.hyper_minhash import NearRules, estimate, keep_one, near_components, sketches
from tests.llm import plain


def documents():
    random.seed(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = list(enumerate(plain.EDGE_TEXTS))
    for group in range(8):
        base = [random.choice(vocabulary) for _ in range(random.choice([12, 60, 200]))]
        for _ in range(12):
            own = list(base)
            for _ in range(random.randint(0, 5)):
                own[random.randrange(len(own))] = random.choice(vocabulary)
            rows.append((len(rows), " ".join(own).upper() if random.random() < 0.2 else "  ".join(own)))
    return [*rows, (len(rows), rows[-1][1]), (len(rows) + 1, rows[-1][1])]


@pytest.mark.parametrize("sizes", [{}, {"block": 3}, {"block_shingles": 100}])
def test_against_all_pairs(spark, sizes):
    """Also with blocks so small that buckets are compared block by block."""
    rows = documents()
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component int").repartition(3)
    expected = plain.near_components(rows)
    found = {r.doc_id: r for r in near_components(docs, NearRules(**sizes)).collect()}
    assert {i: r.component_id for i, r in found.items()} == expected
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(plain.shingles(t)) for i, t in rows}
    assert all(r.kept == (i == expected[i]) for i, r in found.items())


def test_long_texts_of_one_bucket_are_compared_in_small_blocks(spark):
    """Six texts of a MB each, in two components that a bucket holds together."""
    base = [f"word{i:05d}" for i in range(100_000)]
    rows = [(i, " ".join(base[: 100_000 - i * 2000] + [f"own{i}"] * (i * 15_000 if i > 2 else 0))) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = plain.near_components(rows)
    found = near_components(docs, NearRules(block_shingles=150_000)).collect()
    assert {r.doc_id: r.component_id for r in found} == expected


def test_rows_without_id_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (1, "a b c d"), (2, "a b c d"), (2, "a b c d")], "doc_id long, text string")
    found = near_components(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in found) == [
        (0, 0, True), (0, 0, True), (1, 1, True), (2, 1, False), (2, 1, False),
    ]
    assert near_components(docs.limit(0)).count() == 0
    assert sorted(r.doc_id or 0 for r in keep_one(docs).collect()) == [0, 0, 1]


def test_estimate_is_near_the_truth(spark):
    random.seed(4)
    a = [f"a{i}" for i in range(3000)]
    b = a[:2700] + [f"b{i}" for i in range(300)]
    rows = [(1, " ".join(a)), (2, " ".join(b))]
    one, two = sketches(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    registers = [np.frombuffer(r.registers, np.uint16) for r in (one, two)]
    x, y = plain.shingles(rows[0][1]), plain.shingles(rows[1][1])
    assert abs(estimate(*registers, one.n_shingles, two.n_shingles) - len(x & y) / len(x | y)) < 0.15


def test_components(spark):
    path = [(i, i + 1) for i in range(30)] + [(100, 101), (103, 102), (101, 102), (7, 7), (200, 100)]
    found = {r.node: r.component for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(1, 31), 0), **dict.fromkeys((101, 102, 103, 200), 100)}
