"""Runs of words: stretches that repeat with a period, by Lyndon arrays from suffix grouping.

Every run has a Lyndon root: under the given order of words or under its reverse, the longest Lyndon word that
starts at some place of the run is one period long. Both Lyndon arrays come straight from the first phase of
grouping suffix sorting (Baier): suffixes stand in groups by a common prefix, groups are taken from the greatest
down, and each suffix of a group lengthens the prefix of the nearest suffix to its left that is in a lower group.
When all groups were taken, a suffix's prefix is the longest Lyndon word that starts there; the suffixes need not be
sorted any further. Each candidate root is then extended to both sides as far as words one period apart agree, by
longest common extensions from hashes.

Only stretches that can hold a run are grouped. In a run of ``L >= least`` words with a period of at most ``L / 2``,
every word lies in a string of ``gram`` words that the text has twice (``gram`` as computed from ``least``): it is one
period further or nearer inside the run. So words outside of all such strings are ruled out, exactly. Stretches of
many texts are grouped together, apart by a separator that is smaller than every word in both orders.

Time grows with the words, and memory with the longest text. There is no shuffle.

Edge cases: null, empty and blank texts have no words and no runs, their collapsed text is empty; texts of any length are
read whole; equal rows give equal results, one each; other columns are ignored, whatever their names; an empty table
gives an empty result. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loanmeter.llm.arrow_text import flat, gather_spans, mapped, mix, prefix_hash, span_hash, word_spans


@dataclass(frozen=True)
class RunRules:
    least: int = 12
    """Words of the shortest run that counts; it has two periods or more as well."""

    @property
    def gram(self) -> int:
        return max(1, (self.least + 3) // 3)


SCHEMA = (
    "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
)


def word_runs(docs: DataFrame, rules: RunRules = RunRules()) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row.

    ``runs`` is sorted by start, then period; places are word numbers from 0. ``collapsed`` has, joined by one space, the
    words that no run contains behind its first period.
    """
    return docs.select("doc_id", "text").mapInArrow(mapped(lambda part: _text_runs(part, rules)), SCHEMA)


def _text_runs(part: pa.RecordBatch, rules: RunRules) -> pa.RecordBatch:
    data, offsets = flat(part.column("text"), b"\n")
    starts, ends, of = word_spans(data, offsets)
    n_words = np.bincount(of, minlength=part.num_rows)
    start, length, period = find_runs(span_hash(prefix_hash(data), starts, ends), of, rules)

    step = np.zeros(len(starts) + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, start + length, -1)
    kept = np.flatnonzero(np.cumsum(step[:-1]) == 0)

    first_word = np.cumsum(n_words) - n_words
    run_of = of[start]
    fields = [pa.array(start - first_word[run_of]), pa.array(length), pa.array(period)]
    bounds = np.searchsorted(run_of, np.arange(part.num_rows + 1)).astype(np.int32)
    runs = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
    collapsed = joined_words(data, starts, ends, of, kept, part.num_rows)
    return pa.record_batch(
        [part.column("doc_id"), pa.array(n_words.astype(np.int64)), runs, collapsed],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def joined_words(data, starts, ends, of, words: np.ndarray, n_texts: int) -> pa.Array:
    """The words of the given numbers, in the given order, as one text for each of ``of``, joined by one space."""
    size = ends[words] - starts[words] + 1
    blob = data[gather_spans(starts[words], size)]
    behind = np.cumsum(size)
    blob[behind - 1] = 0x20
    last = np.r_[of[words][1:] != of[words][:-1], True] if len(words) else np.zeros(0, bool)
    # No space behind the last word of a text.
    blob = np.delete(blob, behind[last] - 1)
    length = np.bincount(of[words], weights=size, minlength=n_texts).astype(np.int64)
    length -= length > 0
    bounds = np.r_[0, np.cumsum(length)].astype(np.int32)
    buffers = [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(blob.tobytes())]
    return pa.Array.from_buffers(pa.string(), n_texts, buffers)


def find_runs(words: np.ndarray, of: np.ndarray, rules: RunRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs; ``words`` are hashes, ``of`` the number of each word's text."""
    none = np.zeros(0, np.int64)
    low, high = _stretches(words, of, rules)
    if not len(low):
        return none, none, none
    # Stretches side by side, a separator before each and behind the last.
    size = high - low
    own = gather_spans(low, size)
    place = np.arange(len(own)) + np.repeat(np.arange(len(low)) + 1, size)
    n = len(own) + len(low) + 1
    origin = np.full(n, -1, np.int64)
    origin[place] = own
    apart = np.flatnonzero(origin < 0)
    tokens = mix(np.arange(n, dtype=np.uint64) + np.uint64(1 << 50))
    tokens[place] = words[own]
    rank = np.zeros(n, np.int64)
    rank[place] = np.unique(words[own], return_inverse=True)[1] + 1
    reverse = np.where(rank > 0, rank.max() + 1 - rank, 0)
    first = np.repeat(apart[:-1] + 1, size)
    behind = np.repeat(apart[1:], size)

    prefixes = prefix_hash(tokens)
    found = []
    for order in (rank, reverse):
        root = np.array(lyndon_lengths(order.tolist()), np.int64)[place]
        can = np.flatnonzero(2 * root <= behind - first)
        at, period = place[can], root[can]
        # A run needs a period of agreeing words on both sides together; most places agree on neither.
        can = can[(tokens[at] == tokens[at + period]) | (tokens[at - 1] == tokens[at + period - 1])]
        at, period = place[can], root[can]
        ahead = _common(prefixes, at, at + period, behind[can] - at - period, 1)
        back = _common(prefixes, at, at + period, at - first[can], -1)
        length = back + period + ahead
        good = length >= np.maximum(2 * period, rules.least)
        found.append(np.stack([origin[(at - back)[good]], length[good], period[good]]))
    runs = np.concatenate(found, axis=1)
    runs = runs[:, np.lexsort((runs[2], runs[0]))]
    if runs.shape[1]:
        runs = runs[:, np.r_[True, (runs[:, 1:] != runs[:, :-1]).any(axis=0)]]
    return runs[0], runs[1], runs[2]


def _stretches(words: np.ndarray, of: np.ndarray, rules: RunRules) -> tuple[np.ndarray, np.ndarray]:
    """Where the stretches begin and end that can hold a run."""
    n, k = len(words), rules.gram
    at = np.arange(max(0, n - k + 1))
    at = at[of[at] == of[at + k - 1]]
    if not len(at):
        return at, at
    grams = span_hash(prefix_hash(words), at, at + k) ^ mix(of[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(grams)
    same = grams[order][1:] == grams[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    step = np.zeros(n + 1, np.int64)
    step[at[twice]] += 1
    step[at[twice] + k] -= 1
    inside = np.cumsum(step[:-1]) > 0
    new_text = np.r_[True, of[1:] != of[:-1]]
    low = np.flatnonzero(inside & (new_text | np.r_[True, ~inside[:-1]]))
    high = np.flatnonzero(inside & np.r_[new_text[1:] | ~inside[1:], True]) + 1
    long_enough = high - low >= rules.least
    return low[long_enough], high[long_enough]


def _common(prefixes, left, right, most, direction: int) -> np.ndarray:
    """How many tokens agree from ``left`` and ``right`` on (or before them), ``most`` at most; by halving steps."""
    length = np.zeros(len(left), np.int64)
    for bit in range(int(most.max(initial=0)).bit_length() - 1, -1, -1):
        tried = length + (1 << bit)
        can = np.flatnonzero(tried <= most)
        if direction > 0:
            spans = ((x[can] + length[can], x[can] + tried[can]) for x in (left, right))
        else:
            spans = ((x[can] - tried[can], x[can] - length[can]) for x in (left, right))
        one, other = (span_hash(prefixes, a, b) for a, b in spans)
        can = can[one == other]
        length[can] = tried[can]
    return length


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """For each place, the length of the longest Lyndon word that starts there, by grouping from the greatest group down.

    A group is a span of places in suffix order, named by its start. Splitting it leaves the lower part its name.
    """
    n = len(symbols)
    by_symbol: dict[int, list[int]] = {}
    for i, x in enumerate(symbols):
        by_symbol.setdefault(x, []).append(i)
    group_of = [0] * n
    members: dict[int, set[int]] = {}
    prefix: dict[int, int] = {}
    end_of: dict[int, int] = {}
    ending = [0] * (n + 1)
    start = 0
    for x in sorted(by_symbol):
        own = by_symbol[x]
        for i in own:
            group_of[i] = start
        end = start + len(own)
        members[start], prefix[start], end_of[start], ending[end] = set(own), 1, end, start
        start = end

    # The places that were not taken yet, linked in text order.
    left, right = list(range(-1, n)), list(range(1, n + 2))
    out = [0] * n
    end = n
    while end:
        group = ending[end]
        taken, size = members.pop(group), prefix[group]
        end = group
        followed: dict[int, int] = {}
        for i in sorted(taken) if len(taken) > 1 else taken:
            out[i] = size
            before, behind = left[i], right[i]
            left[behind] = before
            if before >= 0:
                right[before] = behind
                followed[before] = followed.get(before, 0) + 1
        if len(followed) == 1:
            moves = [(group_of[i], times, [i]) for i, times in followed.items()]
        else:
            by_move: dict[tuple[int, int], list[int]] = {}
            for i, times in followed.items():
                by_move.setdefault((group_of[i], times), []).append(i)
            # Of one group, those followed by the most copies become the highest.
            moves = [(*move, by_move[move]) for move in sorted(by_move, reverse=True)]
        for lower, times, moved in moves:
            rest = members[lower]
            if len(rest) == len(moved):
                prefix[lower] += times * size
                continue
            rest.difference_update(moved)
            top = end_of[lower]
            new = top - len(moved)
            end_of[lower], ending[new] = new, lower
            members[new], prefix[new], end_of[new], ending[top] = set(moved), prefix[lower] + times * size, top, new
            for i in moved:
                group_of[i] = new
    return out


def with_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, where texts of some ids are made periodic from some word on, to have runs of all kinds.

    With ``h`` the crc32 of the id as text (null: empty), ``g = h // 10`` and ``n`` words: if ``h % 10`` is 0, each word
    ``i >= a`` becomes the word ``a + (i - a) % p``, where ``a = g % n`` and ``p = 1 + (n - a) // (3 + g % 8)``.
    """

    def kernel(part: pa.RecordBatch) -> pa.RecordBatch:
        hashed = [crc32(b"" if i is None else str(i).encode()) for i in part.column("doc_id").to_pylist()]
        chosen = np.array([h % 10 == 0 for h in hashed], bool)
        data, offsets = flat(part.column("text").filter(pa.array(chosen)), b"\n")
        starts, ends, of = word_spans(data, offsets)
        n_words = np.bincount(of, minlength=int(chosen.sum()))
        g = np.array(hashed, np.int64)[chosen] // 10
        from_word = g % np.maximum(n_words, 1)
        period = 1 + (n_words - from_word) // (3 + g % 8)
        base = np.cumsum(n_words) - n_words
        i = np.arange(len(starts)) - base[of]
        beyond = i - from_word[of]
        source = base[of] + np.where(beyond >= 0, from_word[of] + beyond % period[of], i)
        made = iter(joined_words(data, starts, ends, of, source, len(n_words)).to_pylist())
        texts = [next(made) if x else y for x, y in zip(chosen, part.column("text").to_pylist(), strict=True)]
        return pa.record_batch([part.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(mapped(kernel), "doc_id bigint, text string")
