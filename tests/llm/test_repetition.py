import random

from loanmeter.llm.repetition import RepetitionRules, keep_documents, repetition_rules
from loanmeter.llm.suffix_order import SuffixOrder
from tests.llm import plain

import numpy as np


def texts():
    random.seed(2)
    out = list(plain.EDGE_TEXTS)
    for _ in range(60):
        out.append(" ".join(random.choice("abcdefgh") * random.randint(1, 2) for _ in range(random.randint(0, 80))))
    good = " ".join(f"w{i}" for i in range(40))
    return [*out, good, good, " ".join(f"v{i % 90}" for i in range(200))]


def test_suffix_order_against_sorting():
    random.seed(1)
    for case in range(150):
        tokens = [random.randint(0, case % 3 + 1) for _ in range(random.randint(1, 40))] + [99]
        found = SuffixOrder(np.array(tokens), 3)
        suffixes = sorted(range(len(tokens)), key=lambda i: tokens[i:])

        def common(i, j):
            n = 0
            while tokens[i + n : i + n + 1] == tokens[j + n : j + n + 1] != []:
                n += 1
            return n

        near = [0, *(common(a, b) for a, b in zip(suffixes, suffixes[1:])), 0]
        expected = [(s, max(a, b)) for s, a, b in zip(suffixes, near, near[1:]) if max(a, b) >= 3]
        assert list(zip(found.order.tolist(), found.deepest().tolist())) == expected


def test_counts_against_plain_loops(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string")
    rules = RepetitionRules()
    for found in repetition_rules(docs, rules).collect():
        text = dict(rows)[found.doc_id]
        own = plain.words(text)
        eight, four = plain.repeated_words(own, 8), plain.repeated_words(own, rules.min_words)
        assert found.n_words == len(own) and found.word_chars == sum(map(len, own))
        assert found.n_symbols == sum((text or "").count(c) for c in "#*$%&|<>")
        assert found.n_dup_lines == plain.repeated_lines(text)
        assert (found.n_repeat_words, found.n_covered_words) == (len(eight), len(four))
        assert found.n_covered_chars == sum(len(own[i]) for i in four)
        assert found.base_failed == (len(own) < 20 or 100 * len(eight) > 30 * len(own))
        longest = max((n for n in range(4, len(own)) if plain.repeated_words(own, n)), default=0)
        assert found.longest_repeat == longest
        limits = found.n_covered_chars > 0.4 * found.word_chars or longest > 60 and longest > 0.2 * len(own)
        assert found.kept == (not found.base_failed and not limits)


def test_kept_documents_keep_their_columns(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts())], "doc_id long, text string, n_words string")
    kept = {r.doc_id for r in repetition_rules(docs).where("kept").collect()}
    rows = keep_documents(docs).collect()
    assert {r.doc_id for r in rows} == kept and len(kept) > 2 and rows[0].n_words == "x"
    assert keep_documents(docs.limit(0)).count() == 0


def test_quality_labels(spark):
    """Repetitive documents go, documents labelled as good stay."""
    base = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{base}/labels.parquet")
    found = repetition_rules(spark.read.parquet(f"{base}/documents.parquet")).join(labels, "doc_id")
    good = found.where("quality = 1 and not base_failed")
    assert good.where("kept").count() >= 0.99 * good.count()
