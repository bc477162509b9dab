"""Near-duplicate components by HyperMinHash.

Of each shingle set 64 registers are kept. A register is the minimum of one hash function over the set,
compressed to 16 bits: the number of leading zeros and ten bits behind the leading one. Four registers
make a band of 64 bits. Sets that share a band are candidates; their Jaccard similarity is estimated from
equal registers, corrected for registers that agree by chance, and what may reach the threshold is
verified on the full sets.

At the threshold of 0.85 a pair shares none of the 16 bands with a chance of 7e-6, and falls below the
margin of the estimate, five standard deviations, with less than 1e-6.

Large groups are never expanded into pairs. Equal sets are one node. In the first round every node is compared with
one node per band bucket, the one whose bands lie in the largest buckets, and linked with the best of them.
Links make components. In the second round nodes of different components in one bucket are
compared, block against block where a bucket is large: first by registers, to see who may have a partner
at all, then on full sets, inside the task. Only links leave the task, one for each node and component, never
candidate pairs. All candidate pairs are thus either verified or already connected.

Edge cases: a null or empty text, or one without words, has an empty set and stays alone; fewer words than
a shingle make one shingle; rows without an id are kept and belong to no component (null); rows that
share an id are one node with several sets; texts are taken whole, whatever their length; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmeter.llm.arrow_text import flat, gather_spans, lower_ascii, mapped, mix, prefix_hash, span_hash, word_spans
from loanmeter.llm.components import components
from loanmeter.llm.shared_tables import stored

MANTISSA = 10
_CHANCE = 0.7213 / (1 << MANTISSA)
"""1 / (2 ln 2) over the mantissa values: how wide a register's cell is, on average, relative to its place."""


@dataclass(frozen=True)
class NearRules:
    shingle: int = 3
    percent: int = 85
    """Linked at 100 * intersection >= percent * union."""
    bands: int = 16
    rows: int = 4
    least_estimate: float = 0.62
    block: int = 1_000
    """A larger bucket is compared block by block, each pair of blocks in a task of its own."""
    block_shingles: int = 500_000
    """Shingles of a block, about: a block of long texts has fewer of them, one at least."""

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.Generator(np.random.PCG64(8))
    odd = random.integers(0, 1 << 64, n, dtype=np.uint64) | np.uint64(1)
    return odd, random.integers(0, 1 << 64, n, dtype=np.uint64)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit values of each text's distinct shingles, and the number of the text of each, ascending."""
    data, offsets = flat(texts, b" ")
    data = lower_ascii(data)
    starts, ends, of = word_spans(data, offsets)
    word = span_hash(prefix_hash(data), starts, ends)
    n = len(offsets) - 1
    n_words = np.bincount(of, minlength=n)
    first_word = np.cumsum(n_words) - n_words
    value, value_of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(word) >= size:
        rolled = np.zeros(len(word) - size + 1, np.uint64)
        for i in range(size):
            rolled = mix(rolled + word[i : len(word) - size + 1 + i])
        inside = of[: len(rolled)] == of[size - 1 :]
        value, value_of = rolled[inside], of[: len(rolled)][inside]
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for i in range(size - 1):
            more = n_words[short] > i
            whole[more] = mix(whole[more] + word[first_word[short[more]] + i])
        value = np.r_[value, mix(whole + n_words[short].astype(np.uint64))]
        value_of = np.r_[value_of, short]
    _, first = np.unique(value ^ mix(value_of.astype(np.uint64)), return_index=True)
    first = first[np.argsort(value_of[first], kind="stable")]
    return value[first], value_of[first]


def _sketch(part: pa.RecordBatch, rules: NearRules) -> pa.RecordBatch:
    value, of = shingle_sets(part.column("text"), rules.shingle)
    n = part.num_rows
    size = np.bincount(of, minlength=n)
    full = np.flatnonzero(size)
    registers = np.zeros((n, rules.registers), np.uint16)
    one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    if len(full):
        begin = (np.cumsum(size) - size)[full]
        for k, (odd, add) in enumerate(zip(*_functions(rules.registers), strict=True)):
            low = np.minimum.reduceat((value ^ add) * odd, begin)
            fraction, exponent = np.frexp((low >> np.uint64(11)).astype(np.float64))
            zeros = np.clip(53 - exponent, 0, 62)
            bits = np.where(fraction > 0, (fraction * 2 - 1) * (1 << MANTISSA), 0)
            registers[full, k] = (zeros << MANTISSA) + bits.astype(np.int64) + 1
        one[full] = np.add.reduceat(mix(value), begin)
        two[full] = np.add.reduceat(mix(value + np.uint64(0x5BD1E995)), begin)
    return pa.record_batch(
        [
            part.column("doc_id"),
            pa.array(size.astype(np.int64)),
            pa.array(one.view(np.int64)),
            pa.array(two.view(np.int64)),
            pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(2 * rules.registers), n, [None, pa.py_buffer(registers.tobytes())]
            ).cast(pa.binary()),
        ],
        names=["doc_id", "n_shingles", "set_one", "set_two", "registers"],
    )


def sketches(docs: DataFrame, rules: NearRules = NearRules()) -> DataFrame:
    """``doc_id, n_shingles, set_one, set_two, registers``; equal sets have equal ``set_one, set_two``."""
    schema = "doc_id bigint, n_shingles bigint, set_one bigint, set_two bigint, registers binary"
    return docs.select("doc_id", "text").mapInArrow(mapped(lambda part: _sketch(part, rules)), schema)


def estimate(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from registers (last axis) and set sizes, without chance agreements."""
    agree = (left == right).mean(axis=-1)
    chance = _CHANCE * (n / (n + m)) * (m / (n + m))
    return (agree - chance) / (1 - chance)


def near_components(docs: DataFrame, rules: NearRules = NearRules()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: the smallest id reachable over links, itself included."""
    c = F.col
    docs = docs.select("doc_id", "text")
    rows = stored(sketches(docs, rules), "sketches")
    full = rows.where(c("doc_id").isNotNull() & (c("n_shingles") > 0))
    of_set = ["n_shingles", "set_one", "set_two"]
    sets = stored(full.groupBy(*of_set).agg(F.min("doc_id").alias("node")), "sets")
    nodes = full.join(sets.withColumnRenamed("node", "doc_id"), ["doc_id", *of_set], "left_semi")
    nodes = nodes.dropDuplicates(["doc_id", *of_set])
    nodes = stored(nodes.select(c("doc_id").alias("node"), "n_shingles", "registers"), "nodes")

    members = stored(_bucket_members(nodes, rules), "members")
    texts = docs.join(members.select(c("node").alias("doc_id")).distinct(), "doc_id", "left_semi").distinct()
    texts = stored(texts, "texts")

    links = stored(verified(_first_pairs(members, nodes, rules), texts, rules), "links")
    known = components(links)
    open_ = stored(_open_members(members, nodes, known, rules), "open")
    if not open_.isEmpty():
        # The components so far are stars: with the new links they take few rounds more.
        known = components(known.toDF("a", "b").unionByName(_cross_links(open_, texts, rules)))

    placed = sets.join(known, "node", "left").select(*of_set, F.coalesce("component", "node").alias("component_id"))
    linked = c("doc_id").isNotNull() & (c("n_shingles") > 0)
    return (
        rows.drop("registers")
        .join(placed, of_set, "left")
        .withColumn("component_id", F.when(linked, c("component_id")).otherwise(c("doc_id")))
        .withColumn("kept", F.coalesce(c("doc_id") == c("component_id"), F.lit(True)))
        .select("doc_id", "n_shingles", "component_id", "kept")
    )


def _bucket_members(nodes: DataFrame, rules: NearRules) -> DataFrame:
    """``bucket, bucket_size, node`` for buckets of two nodes or more. Counted before they are joined."""
    width = 2 * rules.rows
    keys = [F.xxhash64(F.lit(b), F.expr(f"substring(registers, {b * width + 1}, {width})")) for b in range(rules.bands)]
    dealt = nodes.select("node", F.explode(F.array(*keys)).alias("bucket")).distinct()
    sizes = dealt.groupBy("bucket").agg(F.count("*").alias("bucket_size")).where("bucket_size > 1")
    return dealt.join(sizes, "bucket").select("bucket", "bucket_size", "node")


def _first_pairs(members: DataFrame, nodes: DataFrame, rules: NearRules) -> DataFrame:
    """Each node with the most similar of the central nodes of its buckets, if it may be linked."""
    c = F.col
    central = members.groupBy("node").agg(F.sum("bucket_size").alias("weight"))
    ranked = members.join(central, "node")
    centres = ranked.groupBy("bucket").agg(F.max(F.struct("weight", (-c("node")).alias("minus"))).alias("top"))
    pairs = (
        members.join(centres.select("bucket", (-c("top.minus")).alias("b")), "bucket")
        .select(c("node").alias("a"), "b")
        .where("a <> b")
        .distinct()
    )
    scored = _estimated(pairs, nodes, rules)
    best = scored.groupBy("a").agg(F.max(F.struct("similarity", (-c("b")).alias("minus"))).alias("top"))
    return best.select("a", (-c("top.minus")).alias("b"))


def _estimated(pairs: DataFrame, nodes: DataFrame, rules: NearRules) -> DataFrame:
    """Pairs that may be linked, with the estimate."""
    left = nodes.toDF("a", "n", "left")
    right = nodes.toDF("b", "m", "right")

    def run(batches):
        for batch in batches:
            n, m = (batch.column(x).to_numpy().astype(float) for x in ("n", "m"))
            similar = estimate(_registers(batch.column("left")), _registers(batch.column("right")), n, m)
            near = (similar >= rules.least_estimate) & (100 * np.minimum(n, m) >= rules.percent * np.maximum(n, m))
            out = pa.record_batch([batch.column("a"), batch.column("b"), pa.array(similar)], names=["a", "b", "similarity"])
            yield out.filter(pa.array(near))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "n", "m", "left", "right")
    return joined.mapInArrow(run, "a bigint, b bigint, similarity double")


def _registers(column: pa.Array) -> np.ndarray:
    data, offsets = flat(column)
    return data.view(np.uint16).reshape(len(offsets) - 1, -1) if len(data) else np.zeros((0, 1), np.uint16)


GROUP = ("bucket", "low", "high")
"""A bucket, or a pair of its blocks: what one task compares."""
OPEN = "bucket bigint, low bigint, high bigint, is_low boolean, node bigint, component bigint"


def _open_members(members: DataFrame, nodes: DataFrame, known: DataFrame, rules: NearRules) -> DataFrame:
    """Nodes that may be linked with a node of another component in their group."""
    c = F.col
    labelled = members.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("first"), F.max("component").alias("last"))
    several = labelled.join(mixed.where("first <> last").select("bucket"), "bucket").join(nodes, "node")
    # Rows and bytes of a block are bounded: texts of one bucket may be long.
    shingles = several.groupBy("bucket").agg(F.sum("n_shingles").alias("bucket_shingles"))
    several = several.join(shingles, "bucket")
    blocks = F.ceil(F.greatest(c("bucket_size") / rules.block, c("bucket_shingles") / rules.block_shingles))
    dealt = (
        several.withColumn("mine", F.pmod(F.xxhash64("node"), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
        .withColumn("low", F.least("mine", "other"))
        .withColumn("high", F.greatest("mine", "other"))
        .select(*GROUP, (c("mine") == c("low")).alias("is_low"), "node", "component", "n_shingles", "registers")
    )
    return _by_group(dealt).mapInArrow(lambda batches: _groups(batches, lambda g: _may_link(g, rules)), OPEN)


def _cross_links(open_: DataFrame, texts: DataFrame, rules: NearRules) -> DataFrame:
    """Links between components, verified on full sets."""
    with_text = open_.join(texts.withColumnRenamed("doc_id", "node"), "node").select(*open_.columns, "text")
    links = _by_group(with_text).mapInArrow(
        lambda batches: _groups(batches, lambda g: _linked(g, rules)), "a bigint, b bigint"
    )
    return links.distinct()


def _by_group(rows: DataFrame) -> DataFrame:
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP)


def _groups(batches, compare):
    """Apply ``compare`` to the rows of each group; a group has two blocks of rows at most."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(x).to_numpy() for x in GROUP])
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for start, stop in zip(np.r_[0, cuts], np.r_[cuts, len(keys)], strict=True):
            piece = batch.slice(start, stop - start)
            if held and any(held[-1].column(x)[0] != piece.column(x)[0] for x in GROUP):
                yield from compare(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held = []
            held.append(piece)
    if held:
        yield from compare(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def _partners(rows: pa.RecordBatch):
    """Each row outside of the most frequent component, with the rows it is to be compared with.

    A pair of two components has such a row, so no pair is missed.
    """
    label = rows.column("component").to_numpy()
    is_low = rows.column("is_low").to_numpy(zero_copy_only=False)
    one_block = rows.column("low")[0] == rows.column("high")[0]
    labels, which = np.unique(label, return_inverse=True)
    if len(labels) < 2:
        return
    for i in np.flatnonzero(which != np.bincount(which).argmax()):
        other = label != label[i]
        yield i, other if one_block else other & (is_low != is_low[i])


def _may_link(rows: pa.RecordBatch, rules: NearRules):
    size = rows.column("n_shingles").to_numpy()
    registers = _registers(rows.column("registers"))
    near = np.zeros(len(size), bool)
    for i, other in _partners(rows):
        at = np.flatnonzero(other & (100 * np.minimum(size, size[i]) >= rules.percent * np.maximum(size, size[i])))
        similar = estimate(registers[at], registers[i], size[at].astype(float), float(size[i]))
        at = at[similar >= rules.least_estimate]
        near[at] = True
        near[i] |= len(at) > 0
    yield rows.select([x.split()[0] for x in OPEN.split(", ")]).filter(pa.array(near))


def _linked(rows: pa.RecordBatch, rules: NearRules):
    """Exact intersections of a row's set with all sets of the group, by an index from shingles to rows."""
    value, of = shingle_sets(rows.column("text"), rules.shingle)
    n = rows.num_rows
    size = np.bincount(of, minlength=n)
    first = np.cumsum(size) - size
    _, shingle = np.unique(value, return_inverse=True)
    holders = of[np.argsort(shingle, kind="stable")]
    count = np.bincount(shingle)
    begin = np.cumsum(count) - count
    node, label = rows.column("node").to_numpy(), rows.column("component").to_numpy()
    found = []
    for i, other in _partners(rows):
        own = shingle[first[i] : first[i] + size[i]]
        both = np.bincount(holders[gather_spans(begin[own], count[own])], minlength=n)
        at = np.flatnonzero(other & (100 * both >= rules.percent * (size + size[i] - both)) & (both > 0))
        at = at[np.unique(label[at], return_index=True)[1]]
        found.append(np.column_stack([np.full(len(at), node[i]), node[at]]))
    links = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    yield pa.record_batch([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])


def verified(pairs: DataFrame, texts: DataFrame, rules: NearRules) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""

    def kernel(part: pa.RecordBatch) -> pa.RecordBatch:
        value, of = shingle_sets(part.column("text_a"), rules.shingle)
        other, other_of = shingle_sets(part.column("text_b"), rules.shingle)
        n = part.num_rows
        left = value ^ mix(of.astype(np.uint64))
        right = other ^ mix(other_of.astype(np.uint64))
        both = np.bincount(of[np.isin(left, right, assume_unique=True)], minlength=n)
        union = np.bincount(of, minlength=n) + np.bincount(other_of, minlength=n) - both
        linked = (100 * both >= rules.percent * union) & (both > 0)
        return part.select(["a", "b"]).filter(pa.array(linked))

    joined = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(mapped(kernel, "text_a"), "a bigint, b bigint")


def keep_one(docs: DataFrame, rules: NearRules = NearRules()) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns."""
    kept = near_components(docs, rules).where("kept").select("doc_id").distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")
