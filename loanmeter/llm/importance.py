"""Draw documents that look like a target, by the importance of hashed n-grams (Gumbel top-k resampling).

Features of a text are its words and pairs of neighbouring words; a feature's bucket is a hash of it. A bucket's *gain* is the
logarithm of its share in the target over its share in the documents, and a document's weight the mean gain of its
features. Adding Gumbel noise that depends on the id alone and taking the highest sums draws documents without
replacement, each with a chance in proportion to the exponential of its weight.

Segment deduplication makes the counting cheap where texts share lines. A line feed is never part of a word, so it cuts
texts into lines, the segments. Equal lines are brought together with how often they occur; the features of each distinct
line are hashed once and counted that often. The pairs that reach from the last word of a line to the first of the next
one are added separately, per document. The hashed features of the distinct lines are stored, so that the gains, once
known, are summed for each of them once as well; documents then add up their lines and their crossing pairs.

Documents refer to lines by a 128-bit hash. Lines so frequent that few can be are broadcast, by pigeonhole; others are looked
up by a shuffled join. Ranks come from counts per score, of which there are some 100,000 at most, and an order inside
each score.

Edge cases: null texts and texts without words have no features and weight 0; texts and lines of any length are taken
whole; a null id hashes as empty text and comes first among equal scores; equal rows have equal scores and follow each other;
extra columns, whatever their names, pass through ``drawn`` and are ignored otherwise; an empty target or table of
documents gives gains from the smoothing alone, no error.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import md5
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanmeter.llm.arrow_text import flat, lower_ascii, mapped
from loanmeter.llm.shared_tables import broadcast_if_small, looked_up, stored

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x41:0x5B] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
ROW = "row_hash"


@dataclass(frozen=True)
class ImportanceRules:
    buckets: int = 10_000
    """Up to 32,767."""
    least_words: int = 20
    percent: int = 25
    seed: int = 7
    most_scores: int = 1_000_000
    """Different scores up to which their counts are broadcast; they are counted before."""


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts, lower-cased and with a line feed behind each, where they and their words start and end."""
    data, offsets = flat(texts, b"\n")
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _WORD[data]
    step = np.diff(inside)
    return lower_ascii(data), offsets, np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[int]:
    text = data.tobytes()
    return [crc32(text[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _pair_buckets(data, first_hashes, starts, ends, rules: ImportanceRules) -> np.ndarray:
    """Buckets of pairs of words: the hash of the first word goes on over a space and the second."""
    text = data.tobytes()
    spans = zip(first_hashes, starts.tolist(), ends.tolist(), strict=True)
    return np.array([crc32(b" " + text[a:b], h) for h, a, b in spans], np.int64) % rules.buckets


def _listed(buckets: np.ndarray, of: np.ndarray, n: int) -> pa.Array:
    """Buckets as a list for each of ``n`` owners; ``of`` is sorted."""
    bounds = np.searchsorted(of, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(buckets.astype(np.int16)))


def segments(docs: DataFrame, rules: ImportanceRules = ImportanceRules()) -> DataFrame:
    """``line, times, features``: the distinct lines, how often they occur, and the buckets of their features."""

    def kernel(part: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets, starts, ends = _words(part.column("text"))
        of = np.searchsorted(offsets, starts, "right") - 1
        hashes = _hashes(data, starts, ends)
        second = np.flatnonzero(of[1:] == of[:-1]) + 1
        pairs = _pair_buckets(data, [hashes[i] for i in (second - 1).tolist()], starts[second], ends[second], rules)
        # Words, then pairs, line by line.
        owner = np.r_[of, of[second]]
        order = np.argsort(owner, kind="stable")
        features = np.r_[np.array(hashes, np.int64) % rules.buckets, pairs][order]
        return pa.record_batch(
            [part.column("line"), part.column("times"), _listed(features, owner[order], part.num_rows)],
            names=["line", "times", "features"],
        )

    lines = docs.select(F.explode(F.split("text", "\n")).alias("text")).where("text <> ''")
    distinct = lines.groupBy("text").agg(F.count("*").alias("times"))
    keyed = distinct.select(F.unhex(F.md5("text")).alias("line"), "times", "text")
    return keyed.mapInArrow(mapped(kernel), "line binary, times bigint, features array<smallint>")


ROWS = "row_id bigint, doc_id bigint, row_hash bigint, n_words bigint, lines array<binary>, crossing array<smallint>"


def text_rows(docs: DataFrame, rules: ImportanceRules = ImportanceRules()) -> DataFrame:
    """Each row of ``docs`` without its text: the number of words, the hashes of the lines that have words, and the buckets
    of pairs across lines. ``row_id`` is fixed once this is stored."""

    def kernel(part: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets, starts, ends = _words(part.column("text"))
        of = np.searchsorted(offsets, starts, "right") - 1
        raw = flat(part.column("text"), b"\n")[0]
        line_ends = np.flatnonzero(raw == 10)
        line = np.searchsorted(line_ends, starts)
        new_line = np.flatnonzero(np.r_[True, line[1:] != line[:-1]]) if len(line) else line
        low = np.r_[0, line_ends[:-1] + 1][line[new_line]].tolist()
        text = raw.tobytes()
        keys = [md5(text[a:b]).digest() for a, b in zip(low, line_ends[line[new_line]].tolist(), strict=True)]
        # The first word of a line, if its text has a line with words before.
        crossing = new_line[1:][of[new_line[1:]] == of[new_line[:-1]]] if len(line) else line
        before = _hashes(data, starts[crossing - 1], ends[crossing - 1])
        buckets = _pair_buckets(data, before, starts[crossing], ends[crossing], rules)
        n = part.num_rows
        bounds = np.searchsorted(of[new_line], np.arange(n + 1)).astype(np.int32)
        return pa.record_batch(
            [
                *(part.column(x) for x in ("row_id", "doc_id", ROW)),
                pa.array(np.bincount(of, minlength=n).astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys, pa.binary())),
                _listed(buckets, of[crossing], n),
            ],
            names=[x.split()[0] for x in ROWS.split(", ")],
        )

    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", F.xxhash64("doc_id", "text").alias(ROW), "text")
    return rows.mapInArrow(mapped(kernel), ROWS)


def bucket_counts(distinct: DataFrame, rows: DataFrame, rules: ImportanceRules) -> DataFrame:
    """``bucket, n``: how many features of the texts fall into each bucket."""

    def kernel(batches):
        total = np.zeros(rules.buckets, np.int64)
        for batch in batches:
            lists = batch.column("features")
            size = np.diff(lists.offsets.to_numpy())
            buckets = lists.flatten().to_numpy()
            times = np.repeat(batch.column("times").to_numpy(), size)
            total += np.bincount(buckets, weights=times, minlength=rules.buckets).astype(np.int64)
        filled = np.flatnonzero(total)
        yield pa.record_batch([pa.array(filled), pa.array(total[filled])], names=["bucket", "n"])

    features = distinct.select("times", "features").unionByName(
        rows.select(F.lit(1).cast("bigint").alias("times"), F.col("crossing").alias("features"))
    )
    return features.mapInArrow(kernel, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(own: DataFrame, target: DataFrame, rules: ImportanceRules) -> np.ndarray:
    """The gain of each bucket, from the counts of the documents and of the target; one number per bucket."""
    c = F.col
    spark = own.sparkSession
    buckets = spark.range(rules.buckets).select(c("id").alias("bucket"))
    counts = buckets.join(own.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
    counts = counts.select("bucket", *(F.coalesce(x, F.lit(0)).alias(x) for x in ("s", "t"))).toArrow().sort_by("bucket")
    s, t = (counts.column(x).to_numpy() for x in ("s", "t"))
    upper = (t + 1.0) * float(s.sum() + rules.buckets)
    lower = (s + 1.0) * float(t.sum() + rules.buckets)
    return np.floor(1000 * np.log(upper / lower)).astype(np.int64)


def _summed(rows: DataFrame, features: str, keys: str, gain: np.ndarray) -> DataFrame:
    """The columns ``keys`` and the sum of the gains of a list of buckets."""
    names = [x.split()[0] for x in keys.split(", ")]

    def kernel(batches):
        for batch in batches:
            lists = batch.column(features)
            before = np.r_[0, np.cumsum(gain[lists.flatten().to_numpy()])]
            bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            sums = pa.array(before[bounds[1:]] - before[bounds[:-1]])
            yield pa.record_batch([*(batch.column(x) for x in names), sums], names=[*names, "gain"])

    return rows.select(*names, features).mapInArrow(kernel, f"{keys}, gain bigint")


def importance(docs: DataFrame, target: DataFrame, rules: ImportanceRules = ImportanceRules()) -> DataFrame:
    """``doc_id, row_hash, n_words, n_features, weight, score, rank`` for every row of ``docs``.

    ``target`` has a column ``text``. ``rank`` counts from the highest score; it is null for rows that are not drawn.
    """
    c = F.col
    distinct = stored(segments(docs, rules), "segments")
    rows = stored(text_rows(docs, rules), "text_rows")
    wanted = target.select(F.lit(0).cast("bigint").alias("doc_id"), "text")
    of_target = bucket_counts(segments(wanted, rules), text_rows(wanted, rules), rules)
    gain = gains(bucket_counts(distinct, rows, rules), of_target, rules)

    of_lines = stored(_summed(distinct, "features", "line binary, times bigint", gain), "line_gains")
    places = rows.select("row_id", F.explode("lines").alias("line"))
    line_gains = looked_up(places, of_lines, "line", "times").select("row_id", "gain")
    crossing = _summed(rows, "crossing", "row_id bigint", gain)
    of_rows = line_gains.unionByName(crossing).groupBy("row_id").agg(F.sum("gain").alias("gain"))

    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{rules.seed}:"), F.coalesce(c("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    uniform = (noise.cast("bigint") + F.lit(0.5)) / F.lit(4294967296.0)
    features = F.greatest(c("n_words") * 2 - 1, F.lit(0))
    weight = F.when(c("n_features") == 0, F.lit(0)).otherwise(F.expr("(gain - pmod(gain, n_features)) div n_features"))
    scored = (
        rows.select("row_id", "doc_id", ROW, "n_words", features.cast("bigint").alias("n_features"))
        .join(of_rows, "row_id")
        .withColumn("weight", weight.cast("bigint"))
        .withColumn("score", c("weight") + F.floor(-1000 * F.log(-F.log(uniform))).cast("bigint"))
        .drop("gain")
    )
    return ranked(stored(scored, "scored"), rules)


def ranked(scored: DataFrame, rules: ImportanceRules) -> DataFrame:
    """Ranks by score and id over the whole table, without sorting it in one task."""
    c = F.col
    able = c("n_words") >= rules.least_words
    levels = scored.where(able).groupBy("score").agg(F.count("*").alias("n"))
    higher = Window.orderBy(c("score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    levels = stored(
        levels.select(
            c("score").alias("level"),
            F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("before"),
            F.sum("n").over(Window.partitionBy()).alias("all_able"),
        ),
        "levels",
    )
    limit = F.expr(f"{rules.percent} * all_able div 100")
    # Levels that begin beyond the limit need no order.
    levels = broadcast_if_small(levels.where(c("before") < limit).withColumn("limit", limit), rules.most_scores)
    inside = Window.partitionBy("score").orderBy("doc_id", ROW)
    of_able = scored.where(able).join(levels, c("score") == c("level"))
    drawn = of_able.withColumn("rank", c("before") + F.row_number().over(inside)).where(c("rank") <= c("limit"))
    ranks = drawn.select(c("row_id").alias("of_row"), c("rank").cast("bigint").alias("rank"))
    return scored.join(ranks, c("row_id") == c("of_row"), "left").select(
        "doc_id", ROW, "n_words", "n_features", "weight", "score", "rank"
    )


def drawn(docs: DataFrame, target: DataFrame, rules: ImportanceRules = ImportanceRules()) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns."""
    c = F.col
    taken = importance(docs, target, rules).where("rank is not null")
    counts = taken.groupBy(c("doc_id").alias("of_doc"), c(ROW).alias("of_row")).agg(F.count("*").alias("copies"))
    packed = docs.select(F.struct("*").alias("doc"), "doc_id", F.xxhash64("doc_id", "text").alias(ROW))
    same = c("doc_id").eqNullSafe(c("of_doc")) & (c(ROW) == c("of_row"))
    copy = F.row_number().over(Window.partitionBy("doc_id", ROW).orderBy(F.xxhash64("doc")))
    found = packed.join(counts, same).withColumn("copy", copy).where(c("copy") <= c("copies"))
    return found.select("doc.*")

