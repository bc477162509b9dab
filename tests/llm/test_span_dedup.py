import random

import pytest

from loanmeter.llm.span_dedup import SpanRules, remaining_bytes, with_row_hash, without_repeats
from tests.llm import plain


def documents():
    random.seed(5)
    base = ["".join(random.choice("abé") for _ in range(50)) for _ in range(4)]
    rows = [(i, t) for i, t in enumerate(plain.EDGE_TEXTS)]
    for i in range(40):
        parts = (random.choice(base)[random.randint(0, 5) : random.randint(25, 50)] + random.choice(["", "x", "yz"]) for _ in range(4))
        rows.append((random.choice([100 + i, 100 + i, None]), "".join(parts)))
    return [*rows, (500, "z" * 70), (503, "one line 123\n" * 30), (504, "q" + "one line 123\n" * 9), (501, base[0]), (502, base[0])]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("most_blocks", [10_000, 2])
def test_against_all_strings(spark, keep, most_blocks):
    """Also with keys so frequent, by the bound given, that strings are counted one by one."""
    rules = SpanRules(length=20, reach=8, most_blocks=most_blocks, keep=keep)
    docs = spark.createDataFrame(documents(), "doc_id long, text string")
    rows = with_row_hash(docs).collect()
    null = -1 << 63
    data = [((null if r.doc_id is None else r.doc_id, r.row_hash), (r.text or "").encode()) for r in rows]
    gone = plain.without_repeats(data, 20, keep)
    expected = []
    for r, (_, bytes_), flags in zip(rows, data, gone):
        kept = bytes(b for b, x in zip(bytes_, flags) if not x)
        runs = sum(1 for j, x in enumerate(flags) if x and not (j and flags[j - 1]))
        expected.append((r.doc_id or 0, len(bytes_), sum(flags), runs, kept))
    found = [(r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remaining_bytes(docs, rules).collect()]
    assert sorted(found) == sorted(expected) and sum(e[2] for e in expected) > 500


def test_text_stays_text_and_columns_stay(spark):
    rules = SpanRules(length=20, reach=8, keep="first")
    rows = [(i, t, "x", 1) for i, t in documents()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, of_doc int")
    found = without_repeats(docs, rules)
    assert found.columns == docs.columns and found.count() == len(rows)
    texts = {r.doc_id: r.text for r in found.where("doc_id in (0, 501, 502)").collect()}
    assert texts[0] is None and texts[502] == ""
    assert without_repeats(docs.limit(0), rules).count() == 0


@pytest.mark.parametrize("most_blocks", [10_000, 2])
def test_texts_are_shuffled_once(spark, most_blocks):
    """They are read for the anchors and for one shuffle, also with keys whose strings are counted one by one."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = documents()
    schema = "doc_id long, text string"
    docs = spark.createDataFrame(rows, schema).mapInArrow(counted, schema)
    remaining_bytes(docs, SpanRules(length=20, reach=8, most_blocks=most_blocks)).collect()
    assert read.value == 2 * len(rows)
