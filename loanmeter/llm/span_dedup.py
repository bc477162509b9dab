"""Remove long byte strings that occur elsewhere in the corpus, by a sparse distributed suffix order.

A byte goes if it lies in a string of ``length`` bytes that also starts elsewhere. Sorting the suffixes of a
whole corpus is out of reach, but nearly all suffixes can be ruled out first:

1. Every start position has an *anchor*: the smallest eight-byte hash among the next ``reach`` positions.
   Equal strings have equal anchors at equal distances, so starts are grouped by anchor, about
   ``reach / 2`` of them to one. The bytes behind the anchor that all its strings contain are its *key*.
2. Anchors whose key occurs once are dropped. Counting is combined before the shuffle.
3. The *block* of an anchor is everything its strings cover. Anchors with equal blocks match at all their
   starts; one of them, the first, stands for all. Repeats inside one text are united before any shuffle.
4. Different blocks under one key meet in one task. There the start positions are put into suffix
   order by prefix doubling, with the LCP of neighbours. The nearest start before and the nearest behind in suffix
   order that come earlier in the corpus give each start's longest previous factor, and in the mirror its longest factor
   that comes again. One of ``length`` bytes or more tells that the string has an earlier, or a later copy.

With ``keep="first"`` only strings with an earlier copy go; with ``keep="none"`` all copies go. Earlier means
smaller ``(doc_id, row hash, position)``.

Keys with more than ``most_blocks`` different blocks are not gathered in a task: their strings are counted one by
one by a shuffled aggregation instead.

With ``words`` the same is done over the words of a text, each one symbol, the hash of its bytes; ``length`` and
``reach`` then count words, and white space may differ. A span of words goes up to the start of the next word.

Edge cases: null and empty texts lose nothing (null counts as empty); texts shorter than ``length`` likewise; rows
with the same id and text are copies of each other, rows with the same id and other text are told apart
by a hash of the text; a null id is an id of its own; extra columns are kept by ``without_repeats`` and
otherwise ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmeter.llm.arrow_text import flat, gather_spans, mapped, mix, prefix_hash, slices, span_hash, word_spans
from loanmeter.llm.shared_tables import stored
from loanmeter.llm.suffix_order import previous_factors, sparse_suffix_array

GRAM = 8
ROW = "row_hash"


@dataclass(frozen=True)
class SpanRules:
    length: int = 400
    reach: int = 320
    """Positions from the start of a string among which its anchor is sought; below ``length - 7``."""
    most_blocks: int = 10_000
    """Different blocks of one key that a task takes at most."""
    keep: str = "none"
    words: bool = False
    """Whether ``length`` and ``reach``, which is then below ``length``, count words instead of bytes."""

    @property
    def key_length(self) -> int:
        return self.length - self.reach + 1


def with_row_hash(docs: DataFrame) -> DataFrame:
    return docs.withColumn(ROW, F.xxhash64("doc_id", "text"))


def _same_row(left: DataFrame, right: DataFrame) -> Column:
    return (left[ROW] == right["of_row"]) & left["doc_id"].eqNullSafe(right["of_doc"])


def _symbols(texts: pa.Array, rules: SpanRules) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of bytes or word hashes, and where each one starts and ends."""
    if not rules.words:
        return flat(texts)
    data, offsets = flat(texts, b"\n")
    starts, ends, _ = word_spans(data, offsets)
    return span_hash(prefix_hash(data), starts, ends), np.searchsorted(starts, offsets)


def _block_symbols(blocks: pa.Array, rules: SpanRules) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(blocks)
    return (data.view(np.uint64), offsets // 8) if rules.words else (data, offsets)


ANCHORS = "doc_id bigint, row_hash bigint, key bigint, block bigint, times bigint, first bigint, last bigint"


def _anchors(part: pa.RecordBatch, rules: SpanRules) -> pa.RecordBatch:
    """One row per different block of a text: its key, how often the text has it, and the first and last
    start of its strings, where it comes first.

    What repeats inside the text, all but the first time, is known to go: the spans of it, united, are rows
    without a key. So a line that fills a text gives a few rows.
    """
    data, offsets = _symbols(part.column("text"), rules)
    n, length, reach = len(data), rules.length, rules.reach
    starts = np.zeros(0, np.int64)
    if n >= length:
        long_enough = np.maximum(np.diff(offsets) - length + 1, 0)
        starts = gather_spans(offsets[:-1], long_enough)
    if not len(starts):
        return pa.RecordBatch.from_pylist([], schema=pa.schema([(c.split()[0], pa.int64()) for c in ANCHORS.split(", ")]))
    anchor = _smallest(data, reach)[starts]
    of = np.repeat(np.arange(len(offsets) - 1), long_enough)
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])])
    first, last = starts[new], starts[np.r_[new[1:], len(starts)] - 1]
    at, text = anchor[new], of[new]
    prefixes = prefix_hash(data)
    key = span_hash(prefixes, at, at + rules.key_length)
    block = span_hash(prefixes, first, last + length)
    scoped = mix(block) ^ mix(text.astype(np.uint64) + np.uint64(1))
    _, once, times = np.unique(scoped, return_index=True, return_counts=True)
    again = np.ones(len(at), bool)
    again[once] = False
    again = np.flatnonzero(again)
    # Spans of a text come in order; those that touch are one.
    begin, end = first[again], last[again] + length
    apart = np.flatnonzero(np.r_[True, (begin[1:] > np.maximum.accumulate(end)[:-1])]) if len(again) else again
    last_of = np.r_[apart[1:], len(again)].astype(np.int64)[: len(apart)] - 1
    union_text, union_first = text[again][apart], begin[apart]
    union_last = np.maximum.accumulate(end)[last_of] - length if len(again) else union_first
    n_once, n_union = len(once), len(apart)
    own_text = np.r_[text[once], union_text]
    base = offsets[own_text]
    own = pa.array(own_text)
    no_key = np.r_[np.zeros(n_once, bool), np.ones(n_union, bool)]
    pad = np.zeros(n_union, np.int64)
    return pa.record_batch(
        [
            part.column("doc_id").take(own),
            part.column(ROW).take(own),
            *(pa.array(np.r_[x[once].view(np.int64), pad], mask=no_key) for x in (key, block)),
            pa.array(np.r_[times, pad]),
            pa.array(np.r_[first[once], union_first] - base),
            pa.array(np.r_[last[once], union_last] - base),
        ],
        names=[c.split()[0] for c in ANCHORS.split(", ")],
    )


def _smallest(data: np.ndarray, reach: int) -> np.ndarray:
    """For each position, that of the smallest gram hash among the next ``reach`` ones, leftmost if tied."""
    n = len(data)
    if data.dtype == np.uint8:
        padded = np.r_[data, np.zeros(GRAM, np.uint8)]
        grams = np.ndarray((n,), "<u8", padded, strides=(1,))
    else:
        grams = data
    place_bits = np.uint64(max(1, int(n).bit_length()))
    width = -(-n // reach) * reach
    value = np.full(width + reach, np.iinfo(np.uint64).max, np.uint64)
    value[:n] = mix(grams) >> place_bits << place_bits | np.arange(n, dtype=np.uint64)
    rows = value.reshape(-1, reach)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(behind[:n], ahead[reach - 1 : reach - 1 + n])
    return (least & ((np.uint64(1) << place_bits) - np.uint64(1))).astype(np.int64)


def repeated_spans(docs: DataFrame, rules: SpanRules = SpanRules()) -> DataFrame:
    """``of_doc, of_row, spans``: for each row of ``docs`` with repeats, the byte spans to remove.

    ``docs`` has ``doc_id``, ``text`` and the column of ``with_row_hash``. Spans may overlap. With ``words`` they
    are spans of words.
    """
    c = F.col
    texts = docs.select("doc_id", "text", ROW)  # as in ``remaining_bytes``: one shuffle of texts serves both
    anchors = stored(texts.mapInArrow(mapped(lambda part: _anchors(part, rules)), ANCHORS), "anchors")
    keyed = anchors.where(c("key").isNotNull())
    repeated = keyed.groupBy("key").agg(F.sum("times").alias("n")).where("n > 1").select("key")
    dup = stored(keyed.join(repeated, "key"), "repeated_anchors")

    place = F.struct("doc_id", ROW, "first", "last")
    blocks = stored(dup.groupBy("key", "block").agg(F.sum("times").alias("copies"), F.min(place).alias("top")), "blocks")
    various = blocks.groupBy("key").agg(F.count("*").alias("variety")).where("variety > 1")

    shared = dup.join(blocks.where("copies > 1"), ["key", "block"])
    if rules.keep == "first":
        shared = shared.where(place != c("top"))
    sure = shared.select("doc_id", ROW, "first", "last").unionByName(
        anchors.where(c("key").isNull()).select("doc_id", ROW, "first", "last")
    )
    sure = sure.select(
        c("doc_id").alias("of_doc"), c(ROW).alias("of_row"), c("first").alias("start"), (c("last") + rules.length).alias("end")
    )

    # The first of equal blocks is compared with the other blocks of its key.
    tops = blocks.join(various, "key").select("key", "variety", "copies", "top.*")

    def cut(some: Column) -> DataFrame:
        asked = (
            tops.where(some)
            .groupBy(c("doc_id").alias("of_doc"), c(ROW).alias("of_row"))
            .agg(F.collect_set(F.struct("key", "variety", "copies", "first", "last")).alias("asked"))
        )
        # Texts are shuffled whatever the other side's size: the plan is the same at every size, and all joins of the texts share
        # one shuffle.
        own = texts.join(asked.hint("merge"), _same_row(texts, asked)).select("doc_id", ROW, "text", "asked")
        return own.mapInArrow(mapped(lambda part: _cut_blocks(part, rules)), BLOCKS)

    few = cut(c("variety") <= rules.most_blocks).repartition("key").sortWithinPartitions("key")
    found = few.mapInArrow(lambda batches: _compare(batches, rules), SPANS)
    spans = sure.unionByName(found)
    if not various.where(c("variety") > rules.most_blocks).isEmpty():
        spans = spans.unionByName(_counted(cut(c("variety") > rules.most_blocks), rules))
    return spans.groupBy("of_doc", "of_row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


BLOCKS = "doc_id bigint, row_hash bigint, key bigint, variety bigint, copies bigint, first bigint, last bigint, block binary"
SPANS = 'of_doc bigint, of_row bigint, start bigint, end bigint'


def _cut_blocks(part: pa.RecordBatch, rules: SpanRules) -> pa.RecordBatch:
    """The bytes of the asked blocks."""
    data, offsets = _symbols(part.column("text"), rules)
    asked = part.column("asked")
    counts = asked.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    items = asked.flatten()
    text = np.repeat(np.arange(part.num_rows), counts)
    field = {name: items.field(name).to_numpy() for name in ("key", "variety", "copies", "first", "last")}
    size = field["last"] + rules.length - field["first"]
    blob = data[gather_spans(offsets[text] + field["first"], size)]
    ends = (np.r_[0, np.cumsum(size)] * data.itemsize).astype(np.int32)
    block = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(blob.tobytes())])
    own = pa.array(text)
    return pa.record_batch(
        [part.column("doc_id").take(own), part.column(ROW).take(own), *(pa.array(v) for v in field.values()), block],
        names=[c.split()[0] for c in BLOCKS.split(", ")],
    )


def _compare(batches, rules: SpanRules, most: int = 1 << 20):
    """Spans of blocks that come sorted by key. Keys stay whole; many are compared at once."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, "block", most):
            if size >= most:
                # The last key may go on in what follows.
                rows = _joined(held)
                key = rows.column("key").to_numpy()
                cut = int(np.searchsorted(key, key[-1]))
                if cut:
                    yield _removed(rows.slice(0, cut), rules)
                    held = [rows.slice(cut)]
                size = held[0].nbytes if cut else size
            held.append(part)
            size += part.nbytes
    if held and sum(x.num_rows for x in held):
        yield _removed(_joined(held), rules)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _removed(rows: pa.RecordBatch, rules: SpanRules) -> pa.RecordBatch:
    """One span per block that has repeats: all its strings contain the anchor, so their union is one span."""
    data, offsets = _block_symbols(rows.column("block"), rules)
    first, last, copies = (rows.column(x).to_numpy() for x in ("first", "last", "copies"))
    count = last - first + 1
    starts = gather_spans(offsets[:-1], count)
    block = np.repeat(np.arange(rows.num_rows), count)
    suffixes, lcp = sparse_suffix_array(data, starts, rules.length)
    # Text order of the starts: by row, then by position.
    order = np.lexsort((first, rows.column(ROW).to_numpy(), np.asarray(rows.column("doc_id").fill_null(-(1 << 63)))))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    position = (rank[block] * (int(count.max()) + 1) + starts - offsets[block])[suffixes]
    gone = np.zeros(len(starts), bool)
    gone[suffixes] = previous_factors(position, lcp) >= rules.length
    if rules.keep == "none":
        # The mirror: longest factors that come again later.
        gone[suffixes] |= previous_factors(-position, lcp) >= rules.length
        gone |= copies[block] > 1
    return _hull(rows, block[gone], (starts - offsets[block])[gone], first, rules)


def _hull(rows, block, start, first, rules: SpanRules) -> pa.RecordBatch:
    """From the first to the last start of each block, as spans of its row."""
    new = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else np.zeros(0, np.int64)
    own = block[new]
    ends = np.r_[new[1:], len(block)].astype(np.int64)[: len(new)] - 1
    take = pa.array(own)
    return pa.record_batch(
        [
            rows.column("doc_id").take(take),
            rows.column(ROW).take(take),
            pa.array(first[own] + start[new]),
            pa.array(first[own] + start[ends] + rules.length),
        ],
        names=[c.split()[0] for c in SPANS.split(", ")],
    )


STRINGS = "string bigint, doc_id bigint, row_hash bigint, copies bigint, start bigint, first bigint, last bigint"


def _counted(blocks: DataFrame, rules: SpanRules) -> DataFrame:
    """Spans of blocks of very frequent keys: strings are counted over the cluster, by their hash."""

    def kernel(part: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = _block_symbols(part.column("block"), rules)
        first, last = (part.column(x).to_numpy() for x in ("first", "last"))
        count = last - first + 1
        starts = gather_spans(offsets[:-1], count)
        block = np.repeat(np.arange(part.num_rows), count)
        string = span_hash(prefix_hash(data), starts, starts + rules.length)
        own = pa.array(block)
        return pa.record_batch(
            [
                pa.array(string.view(np.int64)),
                *(part.column(x).take(own) for x in ("doc_id", ROW, "copies")),
                pa.array(first[block] + starts - offsets[block]),
                *(part.column(x).take(own) for x in ("first", "last")),
            ],
            names=[c.split()[0] for c in STRINGS.split(", ")],
        )

    c = F.col
    # Not stored: a job of its own would shuffle all texts again. The blocks are cut twice instead, from the same shuffle.
    strings = blocks.mapInArrow(mapped(kernel, "block"), STRINGS)
    place = F.struct("doc_id", ROW, "start")
    counted = strings.groupBy("string").agg(F.sum("copies").alias("n"), F.min(place).alias("top"))
    if rules.keep == "first":
        counted = counted.where("n > 1").select("string", "top")
        gone = strings.join(counted, "string").where(place != c("top"))
    else:
        gone = strings.join(counted.where("n > 1").select("string"), "string")
    return (
        gone.groupBy(c("doc_id").alias("of_doc"), c(ROW).alias("of_row"), "first", "last")
        .agg(F.min("start").alias("start"), (F.max("start") + rules.length).alias("end"))
        .select("of_doc", "of_row", "start", "end")
    )


def remaining_bytes(docs: DataFrame, rules: SpanRules = SpanRules()) -> DataFrame:
    """``doc_id, kept, n_bytes, n_removed, n_spans`` per row: what is left, and how much went in how many runs."""
    names = ["kept", "n_bytes", "n_removed", "n_spans"]

    def kernel(part: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([part.column("doc_id"), *_without(part)], names=["doc_id", *names])

    texts = with_row_hash(docs.select("doc_id", "text"))
    schema = "doc_id bigint, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint"
    return _with_spans(texts, rules).mapInArrow(mapped(kernel), schema)


def without_repeats(docs: DataFrame, *rules: SpanRules) -> DataFrame:
    """The documents with the text that no rule removes. Bytes that no longer make a character go too."""
    names = docs.columns

    def kernel(part: pa.RecordBatch) -> pa.RecordBatch:
        kept = _without(part)[0].to_pylist()
        null = part.column("text").is_null().to_pylist()
        text = pa.array([None if gone else b.decode(errors="ignore") for b, gone in zip(kept, null, strict=True)], pa.string())
        columns = dict(zip(others, part.column("doc").flatten(), strict=True)) | {"text": text}
        return pa.record_batch([columns[name] for name in names], names=names)

    # Packed, so that no column of theirs clashes with the operator's.
    others = [name for name in names if name != "text"]
    packed = with_row_hash(docs.select("doc_id", "text", F.struct(*others).alias("doc")))
    return _with_spans(packed, *rules or [SpanRules()]).mapInArrow(mapped(kernel), docs.schema)


def _with_spans(docs: DataFrame, *rules: SpanRules) -> DataFrame:
    """The rows with a column of spans for each rule, ``spans0`` and so on, or ``words0`` if they are of words."""
    out = docs
    for i, some in enumerate(rules):
        spans = repeated_spans(docs, some).withColumnRenamed("spans", f"{'words' if some.words else 'spans'}{i}")
        out = out.join(spans.hint("merge"), _same_row(out, spans), "left").drop("of_doc", "of_row")
    return out


def _without(part: pa.RecordBatch) -> list[pa.Array]:
    data, offsets = flat(part.column("text"))
    step = np.zeros(len(data) + 1, np.int64)
    for name in part.schema.names:
        if not re.fullmatch(r"(spans|words)\d+", name):
            continue
        spans = part.column(name)
        counts = np.nan_to_num(spans.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        text = np.repeat(np.arange(part.num_rows), counts)
        items = spans.flatten()
        start, end = (items.field(x).to_numpy() for x in ("start", "end"))
        if name.startswith("words"):
            # Where each word starts, and behind the last one the end of its text.
            white, ends = flat(part.column("text"), b"\n")
            starts = word_spans(white, ends)[0]
            first = np.searchsorted(starts, ends)
            place = np.insert(starts, first[1:], ends[1:] - 1)
            first += np.arange(len(first))
            start, end = (place[first[text] + x] - ends[text] for x in (start, end))
        np.add.at(step, offsets[text] + start, 1)
        np.add.at(step, offsets[text] + end, -1)
    gone = np.cumsum(step)[:-1] > 0
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    inside = offsets[:-1][offsets[:-1] < len(data)]
    begins[inside] = gone[inside]
    before = lambda flags: np.r_[0, np.cumsum(flags)][offsets]
    left = before(~gone).astype(np.int32)
    kept = pa.Array.from_buffers(
        pa.binary(), part.num_rows, [None, pa.py_buffer(left.tobytes()), pa.py_buffer(data[~gone].tobytes())]
    )
    return [kept, *(pa.array(np.diff(x)) for x in (offsets, before(gone), before(begins)))]
