import random

import public_tokenizers
import pytest
import tiktoken

from loanmeter.llm.byte_bpe import decode, encode, read_ranks, round_trip
from loanmeter.llm.queries import RANKS
from tests.llm import plain


@pytest.fixture(scope="module")
def tokens():
    return read_ranks(RANKS)


def texts():
    random.seed(9)
    alphabet = " '  \n\t\x85\x1cabsterlvmd'sSé12½!,.　語\U0001f44d́"
    made = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 40))) for _ in range(1500)]
    return [*plain.EDGE_TEXTS, *made, "a" * 3000, "'s'll've x's", "<|endoftext|>", " " * 300, "é" * 999]


def test_ids_are_those_of_the_library(spark, tokens):
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={}
    )
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, ids int")
    for found in round_trip(docs, tokens).collect():
        text = dict(rows)[found.doc_id] or ""
        assert found.ids == library.encode_ordinary(text), repr(text)
        assert bytes(found.decoded) == text.encode()


def test_encode_then_decode(spark, tokens):
    docs = spark.createDataFrame(list(enumerate(texts()[:40])), "doc_id long, text string")
    encoded = encode(docs, tokens)
    decoded = {r.doc_id: bytes(r.decoded) for r in decode(encoded, tokens).collect()}
    assert decoded == {i: (t or "").encode() for i, t in enumerate(texts()[:40])}
    assert encode(docs.limit(0), tokens).count() == 0
