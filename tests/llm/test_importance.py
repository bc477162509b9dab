"""Importance resampling against counting all features of all texts."""

import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from loanmeter.llm import importance as op
from loanmeter.llm.queries import QUERIES
from tests.llm import plain

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    words = WORD.findall(plain.lower_ascii(text))
    return len(words), [crc32(x.encode()) % 10_000 for x in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def plain_importance(rows, target):
    """``(doc_id, n_features, weight, score, rank)`` of ``(doc_id, text)`` rows."""
    own = [(i, *features(t)) for i, t in rows]
    s, t = (Counter(b for x in lists for b in x) for lists in ([x[2] for x in own], [features(x)[1] for x in target]))
    upper, lower = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = [math.floor(1000 * math.log((t[b] + 1) * upper / ((s[b] + 1) * lower))) for b in range(10_000)]
    scored = []
    for i, n_words, found in own:
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append([i, len(found), weight, weight + noise, n_words, None])
    able = sorted((x for x in scored if x[4] >= 20), key=lambda x: (-x[3], -math.inf if x[0] is None else x[0]))
    for k, x in enumerate(able[: 25 * len(able) // 100]):
        x[5] = k + 1
    return [(*x[:4], x[5]) for x in scored]


def test_query_against_plain_version(spark):
    rows, target = ([tuple(r) for r in spark.read.parquet(f"{SF}/{x}.parquet").select(i, "text").collect()]
                    for x, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    found = [tuple(r) for r in QUERIES["op13_importance"](spark, SF).collect()]
    assert sorted(found, key=str) == sorted(plain_importance(rows, [t for _, t in target]), key=str)
    assert sum(r[4] is not None for r in found) > 200


@pytest.fixture
def odd(spark):
    """Nulls, hot lines, equal rows and ids, words across lines and over ASCII, a long line and a long word."""
    hot = "A hot line, which so many documents share\n"
    rows = [(i, hot * (i % 3) + f"and {i} more words of its own, über 語 {i * i}\n\n-- \nend") for i in range(60)]
    rows += [(None, "x y " * 30), (None, "x z " * 30), (7, "same " * 25), (7, "same " * 25), (8, None), (9, ""), (10, " -\n")]
    rows += [(11, "long " * 50_000), (12, "w" * 200_000), (13, "\n".join(f"l{i}" for i in range(3000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return rows, docs.withColumn("line", F.lit(1)).withColumn("gain", F.lit(2)).withColumn("row_hash", F.lit("z"))


def test_odd_rows(spark, odd):
    rows, docs = odd
    target = ["end x y and more words", None, "A hot\nline"]
    wanted = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    found = op.importance(docs, wanted).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(plain_importance(rows, target), key=str)
    drawn = op.drawn(docs, wanted)
    assert drawn.columns == docs.columns and drawn.count() == found.where("rank is not null").count() > 4


def test_empty_tables(spark, odd):
    rows, docs = odd
    none = docs.limit(0)
    assert op.importance(none, docs).count() == 0
    found = op.importance(docs, none.select("text")).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(plain_importance(rows, []), key=str)


def test_equal_rows_are_drawn_apart(spark):
    docs = spark.createDataFrame([(1, "a b " * 12)] * 8, "doc_id long, text string")
    found = op.importance(docs, docs)
    assert sorted(r["rank"] for r in found.where("rank is not null").collect()) == [1, 2]
    assert op.drawn(docs, docs).count() == 2


def test_distinct_lines_are_counted_once(spark):
    docs = spark.createDataFrame([(i, "one line\nand another\none line") for i in range(50)], "doc_id long, text string")
    lines = {r.times: len(r.features) for r in op.segments(docs).collect()}
    assert lines == {100: 3, 50: 3}
    crossing = {len(r.crossing) for r in op.text_rows(docs).collect()}
    assert crossing == {2}
