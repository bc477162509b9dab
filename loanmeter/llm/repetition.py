"""Quality rules on repetition inside a document, from a suffix array over its words.

Neighbours in suffix order with a longest common prefix of ``min_words`` or more belong to an LCP
interval, which is a repeated substring; the deepest interval a suffix belongs to is the longest
repeat that starts there. The spans of all repeats are united. A document is rejected when the
repeats cover too large a share of its characters or when one repeat is too long.

Many documents share one suffix sort: words are told apart by document, so no repeat crosses two.

Edge cases: a null or empty text has no words, no repeats, and fails the base rule; the text may be
of any length (a document longer than a slice is sorted alone); equal rows give equal results, one
each; other columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loanmeter.llm.arrow_text import (
    WHITE, flat, mapped, mix, per_text, prefix_hash, span_hash, word_spans,
)
from loanmeter.llm.suffix_order import SuffixOrder


@dataclass(frozen=True)
class RepetitionRules:
    window: int = 8
    """Words in the windows of the base rule."""
    min_words: int = 4
    """A repeat counts for the method's rules from this length."""
    max_covered: float = 0.40
    """Largest share of word characters inside repeats."""
    max_longest: float = 0.20
    """Largest share of the words that the longest single repeat may have ..."""
    longest_floor: int = 60
    """... where it has more words than this."""


SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_covered_words bigint, n_covered_chars bigint, longest_repeat bigint, "
    "base_failed boolean, kept boolean"
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def repetition_rules(docs: DataFrame, rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """Counts of words, characters, symbols, repeated lines and repeated words of each document,
    whether the base rule failed, and whether the document is kept."""
    return docs.select("doc_id", "text").mapInArrow(mapped(lambda part: _stats(part, rules)), SCHEMA)


def keep_documents(docs: DataFrame, rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """The documents that the rules keep, with all their columns; texts are not shuffled."""

    def kernel(part: pa.RecordBatch) -> pa.RecordBatch:
        return part.filter(_stats(part, rules).column("kept"))

    return docs.mapInArrow(mapped(kernel), docs.schema)


def _stats(part: pa.RecordBatch, rules: RepetitionRules) -> pa.RecordBatch:
    text = part.column("text")
    data, offsets = flat(text, b"\n")
    n_texts = part.num_rows
    starts, ends, of = word_spans(data, offsets)
    n_words = np.bincount(of, minlength=n_texts)
    letter = (data & 0xC0) != 0x80
    letter &= ~WHITE[data]
    chars_before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(letter, out=chars_before[1:])
    word_chars = chars_before[ends] - chars_before[starts]

    prefixes = prefix_hash(data)
    tokens = span_hash(prefixes, starts, ends) ^ mix(of.astype(np.uint64) + np.uint64(1))
    covered, covered_chars, repeated, longest = (np.zeros(n_texts, np.int64) for _ in range(4))
    if len(tokens):
        # A token behind each text ends all its suffixes.
        place = np.arange(len(tokens)) + of
        with_ends = np.empty(len(tokens) + n_texts, np.uint64)
        is_end = np.ones(len(with_ends), bool)
        is_end[place] = False
        with_ends[place] = tokens
        with_ends[is_end] = mix(np.arange(n_texts, dtype=np.uint64) + np.uint64(1 << 40))
        suffixes = SuffixOrder(with_ends, min(rules.min_words, rules.window))
        depth = suffixes.deepest()
        text_ends = np.cumsum(n_words + 1)
        word_of = np.cumsum(~is_end) - 1

        def united(least: int) -> np.ndarray:
            """Numbers of all words inside a repeat of ``least`` words or more."""
            deep = depth >= least
            at, length = suffixes.order[deep], depth[deep]
            step = np.zeros(len(with_ends) + 1, np.int64)
            np.add.at(step, at, 1)
            np.add.at(step, at + length, -1)
            return word_of[np.flatnonzero(np.cumsum(step) > 0)]

        inside = united(rules.min_words)
        covered = np.bincount(of[inside], minlength=n_texts)
        covered_chars = np.bincount(of[inside], weights=word_chars[inside], minlength=n_texts).astype(np.int64)
        repeated = np.bincount(of[united(rules.window)], minlength=n_texts)
        deep = depth >= rules.min_words
        np.maximum.at(longest, np.searchsorted(text_ends, suffixes.order[deep], "right"), depth[deep])

    base_failed = (n_words < 20) | (100 * repeated > 30 * n_words)
    all_chars = np.bincount(of, weights=word_chars, minlength=n_texts)
    too_covered = covered_chars > rules.max_covered * all_chars
    too_long = (longest > rules.longest_floor) & (longest > rules.max_longest * n_words)
    counts = (
        n_words, all_chars, per_text(_SYMBOL[data], offsets),
        _repeated_lines(data, offsets, prefixes, starts), repeated, covered, covered_chars, longest,
    )
    return pa.record_batch(
        [
            part.column("doc_id"),
            *(pa.array(np.asarray(x, np.int64)) for x in counts),
            pa.array(base_failed),
            pa.array(~(base_failed | too_covered | too_long)),
        ],
        names=[x.split()[0] for x in SCHEMA.split(", ")],
    )


def _repeated_lines(data, offsets, prefixes, word_starts) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text. Each text ends in a line feed."""
    line_ends = np.flatnonzero(data == 10)
    line_starts = np.r_[0, line_ends[:-1] + 1]
    words_before = np.searchsorted(word_starts, line_starts)
    with_word = np.searchsorted(word_starts, line_ends) > words_before
    line_starts, line_ends = line_starts[with_word], line_ends[with_word]
    of = np.searchsorted(offsets, line_starts, "right") - 1
    key = span_hash(prefixes, line_starts, line_ends) ^ mix(of.astype(np.uint64) + np.uint64(1))
    _, first = np.unique(key, return_index=True)
    n = len(offsets) - 1
    return np.bincount(of, minlength=n) - np.bincount(of[first], minlength=n)
