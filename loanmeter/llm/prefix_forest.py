"""Approximate nearest neighbours by a hash-prefix forest.

Vectors are dealt into blocks. In a block every tree has a random rotation; the signs of the rotated
components are a hash string of 64 bits, and the tree is the sorted array of these strings. A query descends
all trees to its longest matching prefixes and then ascends in all of them at once, bit by bit, until the
prefix ranges hold ``candidates`` entries. Those vectors are scored exactly, by cosine in double precision.

Every block answers every query, so a vector's chance to be found depends on the block's size, not on the
table's. The best of all blocks are merged. Equal vectors are one entry with their smallest ids,
so a vector with any number of copies takes one place and its copies compete by id.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components take no part; vectors of
different length are never compared; rows that share an id are no candidates of each other, and equal
rows count once; ties go to the smaller id; null ids take no part; fewer than ``k`` candidates give
fewer rows; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanmeter.llm.arrow_text import gather_spans
from loanmeter.llm.shared_tables import stored

BITS = 64
_PAIRS_AT_ONCE = 1 << 17


@dataclass(frozen=True)
class ForestRules:
    k: int = 5
    trees: int = 128
    block: int = 8_192
    """Vectors in a block, about."""
    candidates: int = 2_400
    """Entries that the prefix ranges of all trees of a block hold before scoring starts; one vector may be several."""


def usable(embedding: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def scaled(embedding: Column) -> Column:
    """Vectors whose squares would leave the range of doubles, divided by a power of two; the cosine stays the same."""
    most = F.array_max(F.transform(embedding, F.abs))
    scale = F.pow(F.lit(2.0), F.floor(F.log2(most)))
    extreme = (most > 1e100) | (most < 1e-100)
    return F.when(extreme, F.transform(embedding, lambda x: x / scale)).otherwise(embedding)


def nearest(vectors: DataFrame, is_query: Column, rules: ForestRules = ForestRules()) -> DataFrame:
    """``query_id, rank, vec_id, score`` over ``vec_id, embedding``: the ``k`` nearest found of each query."""
    c = F.col
    good = vectors.where(c("vec_id").isNotNull() & usable(c("embedding")))
    good = good.select("vec_id", scaled(c("embedding").cast("array<double>")).alias("embedding")).dropDuplicates()
    good = stored(good.withColumn("size", F.size("embedding")), "vectors")
    # One more than k: a query does not count itself.
    first_ids = Window.partitionBy("embedding").orderBy("vec_id")
    entries = (
        good.withColumn("nth", F.row_number().over(first_ids))
        .where(c("nth") <= rules.k + 1)
        .groupBy("embedding", "size")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )
    blocks = max(1, -(-good.count() // rules.block))
    block = F.pmod(F.xxhash64("embedding"), F.lit(blocks))
    rows = entries.select(block.alias("block"), "size", F.lit(False).alias("asks"), "ids", "embedding")
    asking = good.where(is_query).select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"),
        "size", F.lit(True).alias("asks"), F.array("vec_id").alias("ids"), "embedding",
    )
    group = ["block", "size"]
    dealt = rows.unionByName(asking).repartition(*group).sortWithinPartitions(*group, "asks")
    found = dealt.mapInArrow(lambda batches: _answers(batches, rules), "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(c("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(c("rank") <= rules.k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _answers(batches, rules: ForestRules):
    """Rows come block by block, a block's entries before its queries."""
    key, entries, forest = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("block", "size", "asks")])
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for start, stop in zip(np.r_[0, cuts], np.r_[cuts, len(keys)], strict=True):
            part, (block, size, asks) = batch.slice(start, stop - start), keys[start]
            if key != (block, size):
                key, entries, forest = (block, size), [], None
            if not asks:
                entries.append(part)
            elif entries:
                forest = forest or Forest(pa.Table.from_batches(entries), int(size), rules)
                yield forest.answer(part)


class Forest:
    """The trees of one block."""

    def __init__(self, entries: pa.Table, size: int, rules: ForestRules):
        self.rules, self.size = rules, size
        entries = entries.combine_chunks()
        self.vectors = entries.column("embedding").combine_chunks().flatten().to_numpy().reshape(-1, size)
        self.norms = np.sqrt(np.einsum("ij,ij->i", self.vectors, self.vectors))
        ids = entries.column("ids").combine_chunks()
        self.ids, self.id_ends = ids.flatten().to_numpy(), np.cumsum(ids.value_lengths().to_numpy())
        random = np.random.default_rng(6)
        self.turns = []
        for _ in range(rules.trees):
            # Orthogonal directions, as many as there are components; more bits need another set.
            sets = -(-BITS // size)
            turn = np.hstack([np.linalg.qr(random.standard_normal((size, size)))[0] for _ in range(sets)])
            self.turns.append(turn[:, :BITS])
        strings = [self._strings(self.vectors, t) for t in range(rules.trees)]
        self.order = [np.argsort(s, kind="stable") for s in strings]
        self.sorted = [s[o] for s, o in zip(strings, self.order, strict=True)]

    def _strings(self, vectors: np.ndarray, tree: int) -> np.ndarray:
        signs = np.packbits(vectors @ self.turns[tree] > 0, axis=1)
        return signs.view(">u8").reshape(-1).astype(np.uint64)

    def _ranges(self, asked: list[np.ndarray], bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each tree and query, the sorted entries that share its first ``bits`` bits."""
        free = (BITS - bits).astype(np.uint64)
        below = np.where(bits > 0, (np.uint64(1) << np.minimum(free, np.uint64(63))) - np.uint64(1), ~np.uint64(0))
        low, high = (np.empty((len(asked), len(bits)), np.int64) for _ in range(2))
        for t, strings in enumerate(asked):
            low[t] = np.searchsorted(self.sorted[t], strings & ~below, "left")
            high[t] = np.searchsorted(self.sorted[t], strings | below, "right")
        return low, high

    def answer(self, queries: pa.RecordBatch) -> pa.RecordBatch:
        asked_ids = queries.column("ids").flatten().to_numpy()
        vectors = queries.column("embedding").flatten().to_numpy().reshape(-1, self.size)
        out = []
        step = max(1, _PAIRS_AT_ONCE // max(1, min(len(self.vectors), self.rules.candidates)))
        for i in range(0, len(vectors), step):
            out.append(self._some(asked_ids[i : i + step], vectors[i : i + step]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)]
        return pa.record_batch([pa.array(x) for x in columns], names=["query_id", "vec_id", "score"])

    def _some(self, asked_ids: np.ndarray, vectors: np.ndarray):
        rules, n = self.rules, len(asked_ids)
        asked = [self._strings(vectors, t) for t in range(rules.trees)]
        # Descend by halving to the longest prefix whose ranges hold enough, over all trees together.
        least, most = np.zeros(n, np.int64), np.full(n, BITS)
        while (least < most).any():
            bits = (least + most + 1) // 2
            low, high = self._ranges(asked, bits)
            enough = (high - low).sum(axis=0) >= rules.candidates
            least, most = np.where(enough, bits, least), np.where(enough, most, bits - 1)
        low, high = self._ranges(asked, least)
        pairs = []
        for t in range(rules.trees):
            entry = self.order[t][gather_spans(low[t], high[t] - low[t])]
            pairs.append(np.repeat(np.arange(n), high[t] - low[t]) * len(self.vectors) + entry)
        query, entry = np.divmod(np.unique(np.concatenate(pairs)), len(self.vectors))
        norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        score = np.empty(len(query))
        for i in range(0, len(query), _PAIRS_AT_ONCE):
            some = slice(i, i + _PAIRS_AT_ONCE)
            dot = np.einsum("ij,ij->i", vectors[query[some]], self.vectors[entry[some]])
            score[some] = dot / (norms[query[some]] * self.norms[entry[some]])
        counts = np.diff(np.r_[0, self.id_ends])[entry]
        ids = self.ids[gather_spans((self.id_ends - np.diff(np.r_[0, self.id_ends]))[entry], counts)]
        query, score = np.repeat(query, counts), np.repeat(score, counts)
        other = ids != asked_ids[query]
        query, ids, score = query[other], ids[other], score[other]
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        begin = np.searchsorted(query, np.arange(n))
        best = np.arange(len(query)) - begin[query] < rules.k
        return asked_ids[query[best]], ids[best], score[best]
