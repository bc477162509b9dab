"""The pipeline's own rules, which differ from those of the single queries."""

import random

import corpus_pipeline
from loanmeter.llm.span_dedup import with_row_hash
from tests.llm import plain

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def invented(seed, n, letters="abcdefghijklmnopqrstuvwxyz"):
    own = random.Random(seed)
    return ["".join(own.choice(letters) for _ in range(own.randint(4, 5))) for _ in range(n)]


def test_short_passages_of_many_words_go(spark):
    passage = invented(1, 51)
    assert 260 < len(" ".join(passage)) < 300
    around = [" ".join(invented(10 + i, 60)) for i in range(8)]
    unbroken = "".join(chr(0x4E00 + i) for i in range(150))
    texts = [
        f"{around[0]}\n\n{' '.join(passage)}\n\n{around[1]}",
        f"{around[2]} {'  '.join(passage)}\n{around[3]}",  # other white space
        " ".join(passage),
        f"{around[4]} {' '.join(passage[:49])} {around[5]}",  # a word too short
        f"{around[6]} {unbroken}",
        f"{unbroken} {around[7]}",
        None, "", "   ",
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], COLUMNS).repartition(3)
    found = {r.doc_id: r.text for r in corpus_pipeline.suffix_dedup(spark, docs, "").collect()}
    assert found == dict(enumerate(texts)) | {1: f"{around[2]} {around[3]}", 2: "", 5: f" {around[7]}"}


def test_passages_against_all_strings(spark):
    own = random.Random(7)
    base = [invented(20 + i, 90, "abé") for i in range(4)]
    texts = []
    for i in range(40):
        parts = []
        for _ in range(3):
            start = own.randint(0, 30)
            parts += own.choice(base)[start : start + own.randint(20, 60)] + invented(100 + own.randint(0, 30), own.randint(0, 3))
        texts.append(own.choice([" ", "\n", "  "]).join(parts) + own.choice(["", "\n"]))
    texts += [" ".join(base[0]) + " " + " ".join(base[0]), "ab " * 200, "é" * 900]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], COLUMNS).repartition(3)
    rows = [((r.doc_id, r.row_hash), r.text) for r in with_row_hash(docs).collect()]
    found = {r.doc_id: r.text for r in corpus_pipeline.suffix_dedup(spark, docs, "").collect()}
    expected = {place[0]: text for place, text in plain.without_passages(rows).items()}
    assert found == expected and sum(found[i] != t for i, t in enumerate(texts)) > 20


def linked_at_five_words(rows):
    """Ids that stay if texts are linked at four fifths of their five-word shingles, by comparing all pairs."""
    return {i for i, top in plain.near_components(rows, 80, 5).items() if i == top}


def test_near_copies_at_five_words(spark):
    base, other = invented(200, 200), invented(201, 200)
    changed = [w if i not in (20, 60, 100, 140, 180) else "changed" for i, w in enumerate(other)]
    rows = [
        (0, " ".join(base)), (1, " ".join(base + invented(202, 42))),  # 0.82 at both sizes: a near copy
        (2, " ".join(other)), (3, " ".join(changed)),  # 0.86 at three words, 0.77 at five: not one
    ]
    own = random.Random(9)
    for group in range(6):
        words = invented(210 + group, 150)
        for _ in range(12):
            places = own.sample(range(150), own.randint(0, 4))
            rows.append((len(rows), " ".join("x" + w if i in places else w for i, w in enumerate(words)) + " end" * own.randint(0, 1)))
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], COLUMNS).repartition(3)
    found = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert found == linked_at_five_words(rows) and 1 not in found and {0, 2, 3} <= found


def test_near_copies_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert not found & {255, 875} and {372, 452, 571, 952} <= found
