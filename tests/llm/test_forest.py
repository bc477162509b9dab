import math
import random

from pyspark.sql import functions as F

from loanmeter.llm.prefix_forest import ForestRules, nearest


def brute(rows, k=5):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, a in good:
        if q % 50 == 0:
            near = {
                (-sum(x * y for x, y in zip(a, b)) / math.hypot(*a) / math.hypot(*b), i) for i, b in good if i != q and len(b) == len(a)
            }
            out[q] = [(i, -s) for s, i in sorted(near, key=lambda x: (round(x[0], 12), x[1]))[:k]]
    return out


def test_exact_where_all_are_candidates(spark):
    random.seed(6)
    rows = [(i, [random.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 340)] + [(50 * 8, [1.0] * 6), (401, [1.0] * 6), (402, [2.0] * 6)]
    rows += [(500, None), (501, []), (502, [0.0] * 6), (503, [1.0, None] * 3), (504, [float("nan")] * 6), (505, [float("inf")] * 6)]
    rows += [(None, [1.0] * 6), (550, [1.0, 2.0]), (551, [2.0, 1.0]), (600, [1.0, 2.0, 3.0]), rows[0], rows[7]]
    vectors = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, block string")
    plain = [(r.vec_id, r.embedding) for r in vectors.collect()]
    found = {}
    for r in nearest(vectors, F.col("vec_id") % 50 == 0, ForestRules(trees=16, block=60)).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    expected = {q: near for q, near in brute(plain).items() if near}
    assert {q: [i for i, _ in near] for q, near in found.items()} == {q: [i for i, _ in near] for q, near in expected.items()}
    assert all(abs(a[1] - b[1]) < 1e-12 for q in found for a, b in zip(found[q], expected[q]))
    assert nearest(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_very_large_and_small_components(spark):
    rows = [(0, [1e200, 1e200]), (1, [3e180, 4e180]), (2, [1.0, 0.0]), (3, [-1e-200, 1e-200]), (4, [2e-310, 2e-310])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [(r.vec_id, round(r.score, 12)) for r in nearest(vectors, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert found == [(4, 1.0), (1, round(7 / 5 / math.sqrt(2), 12)), (2, round(math.sqrt(0.5), 12)), (3, 0.0)]


def test_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.select("vec_id", "embedding").collect()]
    found = nearest(vectors, F.col("vec_id") % 50 == 0, ForestRules(block=1_024, candidates=2_000)).collect()
    import numpy as np

    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in {r.query_id for r in found}:
        at = np.flatnonzero(ids == q)[0]
        score = x @ x[at]
        score[at] = -2
        best = set(ids[np.argsort(-score, kind="stable")[:5]].tolist())
        hits += len(best & {r.vec_id for r in found if r.query_id == q})
    assert hits >= 0.9 * len(found)
