"""Mix sources to target weights, on native DataFrame operations only.

Documents of a source stand in the order of a hash-random key. The key is uniform, so its high part
deals a source into ranges of about ``RANGE_ROWS`` documents: word counts are summed by range, prefix
sums run over ranges, and only the range in which a source's budget ends is sorted by document. What
remains is one row per source: full epochs, the key at which the last epoch is cut, and the words that
the document at the cut still gives. Applying it to the documents needs no shuffle of texts.

Targets share the words of all sources by weight. A source is never repeated more than ``max_repeats``
times: what exceeds that is shared by the others by weight, until nobody is above.

Rows with the same doc_id have the same key and are ordered by a hash of their text. Equal rows stand at one place, as a
group with a number of copies: if the cut falls there, they are numbered, the first ones are taken whole, one is cut, and
the others give nothing. The group is counted before it is ordered, so a row that fills a third of the table is one row of
a sort; it is numbered within the parts it is stored in.

Edge cases: a null or empty text has size 0 and gives nothing; a null source is a source, last in order; a null id is an
id like others; for repeated ids and rows the words taken still add up to the target of the source, rounded, and no row gives more
than ``max_repeats`` times its size; texts of any length are counted whole; extra columns of the input pass through
``mixed`` and are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanmeter.llm.shared_tables import broadcast_if_small, stored

RANGE_ROWS = 50_000
MOST_BROADCAST = 50_000
"""Sources up to which the table with one row per source is broadcast; it is counted before."""
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
WORD = "[^\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def random_key(doc_id: Column) -> Column:
    """A whole number below 2**52 that looks random and depends on the id alone."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("bigint")


def text_key(text: Column) -> Column:
    """Tells apart rows with the same id: a whole number below 2**52 that depends on the text alone."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 13), 16, 10).cast("bigint")


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """One row per source: ``source, n_rows, source_size, target``."""
    c = F.col
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    by_name = Window.orderBy(c("source").asc_nulls_last())
    nth = (F.row_number().over(by_name) - 1) % len(weights)
    ranked = (
        totals.withColumn("nth", nth)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), c("nth") + 1).cast("bigint"))
        .withColumn("most", c("source_size") * max_repeats)
    )
    everything = Window.partitionBy()
    # Sources reach their limit in this order as the common level rises.
    rising = Window.orderBy(c("most") / c("weight"), c("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    left_words = c("all_words") - F.coalesce(F.sum("most").over(before), F.lit(0))
    left_weight = c("all_weights") - F.coalesce(F.sum("weight").over(before), F.lit(0))
    return (
        ranked.withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("all_weights", F.sum("weight").over(everything))
        .withColumn("full", c("most") * left_weight <= c("weight") * left_words)
        .withColumn("level_words", c("all_words") - F.sum(F.when(c("full"), c("most")).otherwise(0)).over(everything))
        .withColumn("level_weight", c("all_weights") - F.sum(F.when(c("full"), c("weight")).otherwise(0)).over(everything))
        .withColumn(
            "target",
            F.when(c("full"), c("most").cast("double")).otherwise(c("weight") * c("level_words") / c("level_weight")),
        )
        .select("source", "n_rows", "source_size", "target")
    )


def source_cuts(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """One row per source: its target, full epochs, and where the last epoch ends.

    ``sized`` has ``doc_id, source, size, key, content``. Documents that come before ``(cut_key, cut_doc, cut_content)`` are
    taken once more; the equal rows there give ``cut_words`` together.
    """
    c = F.col
    budget = F.floor(c("target") + 0.5).cast("bigint")
    plans = stored(
        source_targets(sized, weights, max_repeats)
        .withColumn("budget", budget)
        .withColumn("epochs", F.when(c("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0)))
        .withColumn("rest", c("budget") - c("epochs") * c("source_size"))
        .withColumn("ranges", F.ceil(c("n_rows") / RANGE_ROWS).cast("bigint"))
        .withColumnRenamed("source", "plan_source"),
        "source_plans",
    )
    plans = broadcast_if_small(plans, MOST_BROADCAST)
    of_source = c("source").eqNullSafe(c("plan_source"))
    in_range = F.floor(c("key") / F.lit(float(1 << 52)) * c("ranges")).cast("bigint")
    dealt = (
        sized.join(plans.select("plan_source", "ranges"), of_source)
        .withColumn("range", in_range)
        .select("doc_id", "source", "size", "key", "content", "range")
    )
    before_range = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ending = (
        dealt.groupBy("source", "range")
        .agg(F.sum("size").alias("range_size"))
        .withColumn("before", F.coalesce(F.sum("range_size").over(before_range), F.lit(0)))
        .join(plans.select("plan_source", "rest"), of_source)
        .where((c("before") <= c("rest")) & (c("rest") < c("before") + c("range_size")))
        .select(c("source").alias("cut_source"), c("range").alias("cut_range"), "before", "rest")
    )
    before_row = Window.partitionBy("source").orderBy("key", "doc_id", "content").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        dealt.join(ending, c("source").eqNullSafe(c("cut_source")) & (c("range") == c("cut_range")))
        .groupBy("source", "cut_source", "before", "rest", "key", "doc_id", "content")
        .agg(F.sum("size").alias("size"))
        .withColumn("start", c("before") + F.coalesce(F.sum("size").over(before_row), F.lit(0)))
        .where((c("start") <= c("rest")) & (c("rest") < c("start") + c("size")))
        .select(
            "cut_source", c("key").alias("cut_key"), c("doc_id").alias("cut_doc"), c("content").alias("cut_content"),
            (c("rest") - c("start")).alias("cut_words"),
        )
    )
    return (
        plans.join(cut, c("plan_source").eqNullSafe(c("cut_source")), "left")
        .select("plan_source", "source_size", "target", "epochs", "cut_key", "cut_doc", "cut_content", "cut_words")
    )


def _place() -> tuple[Column, Column]:
    """Whether a document comes before the cut, and whether it is one of those at the cut."""
    c = F.col
    same_key = c("key") == c("cut_key")
    same_doc = c("doc_id").eqNullSafe(c("cut_doc"))
    # Nulls sort first in a window.
    smaller = (c("doc_id") < c("cut_doc")) | (c("doc_id").isNull() & c("cut_doc").isNotNull())
    smaller = F.coalesce(smaller, F.lit(False)) | (same_doc & (c("content") < c("cut_content")))
    before = (c("key") < c("cut_key")) | (same_key & smaller)
    at = same_key & same_doc & (c("content") == c("cut_content"))
    return F.coalesce(before, F.lit(False)), F.coalesce(at, F.lit(False))


def _last_epoch(placed: DataFrame) -> DataFrame:
    """Adds ``last``, the words that the last epoch takes of each row, to rows joined with their source's cut."""
    c = F.col
    before, at = _place()
    whole = placed.where(~at).withColumn("last", F.when(before, c("size")).otherwise(F.lit(0)).cast("bigint"))
    # The rows at the cut are numbered: within the part of the table they stand in, and on from the parts before.
    rows = placed.where(at).withColumn("cut_row", F.monotonically_increasing_id())
    rows = stored(rows.withColumn("cut_part", F.shiftright("cut_row", 33)), "rows_at_cut")
    earlier = Window.partitionBy("of_source").orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        rows.groupBy(c("plan_source").alias("of_source"), c("cut_part").alias("of_part"))
        .agg(F.count("*").alias("part_rows"))
        .withColumn("earlier", F.coalesce(F.sum("part_rows").over(earlier), F.lit(0)))
    )
    inside = Window.partitionBy("plan_source", "cut_part").orderBy("cut_row")
    nth = c("earlier") + F.row_number().over(inside) - 1
    left = c("cut_words") - nth * c("size")
    cut = rows.join(parts, c("plan_source").eqNullSafe(c("of_source")) & (c("cut_part") == c("of_part"))).withColumn(
        "last", F.greatest(F.lit(0), F.least(c("size"), left)).cast("bigint")
    )
    return whole.unionByName(cut.select(whole.columns))


def _cuts(sized: DataFrame, weights: tuple[int, ...], max_repeats: int) -> DataFrame:
    return broadcast_if_small(stored(source_cuts(sized, weights, max_repeats), "cuts"), MOST_BROADCAST)


def _sized(docs: DataFrame) -> DataFrame:
    sized = docs.select("doc_id", "source", words(F.col("text")).alias("size"), text_key(F.col("text")).alias("content"))
    return sized.withColumn("key", random_key(F.col("doc_id")))


def mix_sizes(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``: the words the mix takes of each document."""
    c = F.col
    sized = stored(_sized(docs), "sized")
    placed = sized.join(_cuts(sized, weights, max_repeats), c("source").eqNullSafe(c("plan_source")))
    taken = (c("epochs") * c("size") + c("last")).cast("bigint")
    return _last_epoch(placed).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def mixed(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """The documents of the mix, with all their columns: one row per epoch that takes them.

    The document at the cut is cut behind its last taken word.
    """
    c = F.col
    cuts = _cuts(stored(_sized(docs), "sized"), weights, max_repeats)
    # Packed, so that no column of theirs clashes with the plan's.
    others = [name for name in docs.columns if name != "text"]
    packed = docs.select(
        F.struct(*others).alias("doc"), "doc_id", "source", "text", words(c("text")).alias("size"),
        random_key(c("doc_id")).alias("key"), text_key(c("text")).alias("content"),
    )
    placed = _last_epoch(packed.join(cuts, c("source").eqNullSafe(c("plan_source"))))
    copies = F.when(c("size") > 0, c("epochs") + (c("last") > 0).cast("bigint")).otherwise(0)
    each = (
        placed.withColumn("copies", copies)
        .where(c("copies") > 0)
        .withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("bigint"), c("copies"))))
    )
    cut = (c("epoch") > c("epochs")) & (c("last") < c("size"))
    text = F.when(cut, first_words(c("text"), c("last"))).otherwise(c("text"))
    return each.select(*(text.alias("text") if name == "text" else c("doc")[name].alias(name) for name in docs.columns))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word."""
    white, word = "[\\x20\\x09-\\x0D]", "[^\\x20\\x09-\\x0D]"
    # Pieces are a word and the white space behind it; white space at the start is one piece more.
    pieces = F.split(text, f"(?<={white})(?={word})")
    lead = F.when(text.rlike(f"^{white}"), 1).otherwise(0)
    taken = F.array_join(F.slice(pieces, F.lit(1), (n + lead).cast("int")), "")
    return F.regexp_replace(taken, f"{white}+$", "")
