"""Lyndon arrays and runs against trying all periods; the query against the contract's rules."""

import random
from hashlib import sha256
from zlib import crc32

import numpy as np

from loanmeter.llm.arrow_text import mix
from loanmeter.llm.periodic_runs import RunRules, find_runs, lyndon_lengths, word_runs
from loanmeter.llm.queries import QUERIES
from tests.llm import plain

SF = "/root/testdata/sf0.01"


def plain_lyndon(s):
    out = []
    for i in range(len(s)):
        j = i + 1
        while j < len(s) and s[j:] > s[i:]:
            j += 1
        out.append(j - i)
    return out


def plain_runs(s, least=12):
    """All maximal stretches with a smallest period, by period."""
    found, n = [], len(s)
    code = np.unique(np.array([str(x) for x in s]), return_inverse=True)[1] if n else np.zeros(0, int)
    for p in range(1, n // 2 + 1):
        same = np.r_[False, code[:-p] == code[p:], False].astype(np.int8)
        begins, ends = (np.flatnonzero(np.diff(same) == x) for x in (1, -1))
        for begin, length in zip(begins.tolist(), (ends - begins + p).tolist(), strict=True):
            own = code[begin : begin + length]
            if length >= max(least, 2 * p) and all((own[q:] != own[:-q]).any() for q in range(1, p)):
                found.append((begin, length, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def made_periodic(words, doc_id):
    h = crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_lyndon_lengths():
    draw = random.Random(1)
    for _ in range(500):
        s = [draw.randrange(draw.choice([1, 2, 3, 6])) for _ in range(draw.randrange(40))]
        assert lyndon_lengths(s) == plain_lyndon(s)


def test_runs_of_several_texts_at_once():
    draw = random.Random(2)
    for _ in range(500):
        texts = []
        for _ in range(draw.randint(1, 4)):
            own = []
            while draw.random() < 0.8:
                unit = [draw.randrange(draw.choice([1, 2, 4, 20])) for _ in range(draw.randint(1, 9))]
                own += (unit * 5)[: int(len(unit) * draw.choice([1, 1, 2, 3, 2.5, 4.4]))]
            texts.append(own)
        least = draw.choice([12, 12, 2, 3, 6])
        words = mix(np.array([x + 9 for s in texts for x in s], np.uint64))
        of = np.array([i for i, s in enumerate(texts) for _ in s], np.int64)
        found = [tuple(map(int, r)) for r in zip(*find_runs(words, of, RunRules(least)), strict=True)]
        base, expected = 0, []
        for s in texts:
            expected += [(b + base, n, p) for b, n, p in plain_runs(s, least)]
            base += len(s)
        assert found == expected


def test_query_against_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = QUERIES["op12_periodic_runs"](spark, SF).collect()
    assert len(rows) == len(texts) and sum(r.n_runs > 0 for r in rows) > 50
    for r in rows:
        words = made_periodic(plain.words(texts[r.doc_id]), r.doc_id)
        if len(words) > 1500:
            continue  # trying all periods takes the square of the length
        runs = plain_runs(words)
        gone = {i for b, n, p in runs for i in range(b + p, b + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        listed = "".join(f"{b},{n},{p}\n" for b, n, p in runs)
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert r.n_runs == len(runs)
        assert (r.runs_sha256, r.collapsed_sha256) == tuple(sha256(x.encode()).hexdigest() for x in (listed, kept))
        assert (r.start, r.length, r.period) == (top or (None,) * 3)
        assert r.exponent_milli == (top and 1000 * top[1] // top[2])


def test_odd_rows(spark):
    texts = [*plain.EDGE_TEXTS, "a b " * 40_000, "w" * 100_000, " ".join(map(str, range(20_000))) * 2]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "p q r " * 9, None, None), (3, "a", "x", "y"), (3, "a", "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed string")
    found = word_runs(docs).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    assert [tuple(x) for x in by_id[len(plain.EDGE_TEXTS)].runs] == [(0, 80_000, 2)]
    assert by_id[len(plain.EDGE_TEXTS)].collapsed == "a b" and by_id[None].collapsed == "p q r"
    assert by_id[0].n_words == 0 and by_id[0].runs == [] and by_id[0].collapsed == ""
    assert [tuple(x) for x in by_id[len(texts) - 1].runs] == []
    assert word_runs(docs.limit(0)).count() == 0
