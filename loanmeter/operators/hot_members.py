"""Members whose join is too much for one task, and how to split them over tasks.

A join on ``member_id`` sends all rows of a member to one task. For a member with a third of
all payments that task never ends, and neither does it for a member with middling numbers of payments and of
loans, whose product is large. Adaptive execution cannot help: it does not split the
right side of an outer join, nor a stage that chains several joins. So all members are joined
on ``(member_id, cell)``. Every side of a hot member is cut into pieces, a cell is one combination of
pieces, and a row goes to all cells its piece takes part in (the *shares* scheme for multiway
joins, Afrati and Ullman 2010). Each combination of rows meets in exactly one cell. A member that is not hot
has one cell.

Hot is who exceeds an absolute number of rows on one side or of output rows. The numbers come from one
aggregation over the keys of all sides, combined before it is shuffled; they stay in a table.

Nothing here depends on random numbers or row order: a recomputed task yields the same cells.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "member_id"
CELL = "cell"
UNFOLD_STEP = 10_000
UNFOLD_SHARE = 10 * UNFOLD_STEP
"""Output rows that are dealt to a task at once where there are hot members."""


@dataclass(frozen=True)
class HotPolicy:
    """When a member counts as hot, and how finely it is cut.

    The values steer parallelism only; the result is the same for any of them. They are numbers of rows, so they
    do not move with the size of a table.
    """

    most_rows: int = 100_000
    """Rows of a member on one side that a task takes at most."""
    most_output: int = 5_000_000
    """Output rows of a member that a task makes at most."""
    max_cells: int = 20_000
    """Cells wanted for one member at most."""
    most_broadcast: int = 100_000
    """Hot members up to which their table is broadcast; it is counted before."""


@dataclass(frozen=True)
class HotMembers:
    """``table`` has one row per hot member: ``cells``, and per side its cuts and the stride of a cut."""

    table: DataFrame
    sides: tuple[str, ...]
    is_small: bool

    def of(self, columns: Sequence[str]) -> DataFrame:
        wanted = self.table.select(KEY, *columns)
        return F.broadcast(wanted) if self.is_small else wanted


def find_hot_members(sides: Mapping[str, DataFrame], policy: HotPolicy | None = None) -> HotMembers | None:
    """Look for hot members; None if there are none. Reads only the key columns.

    Runs one Spark job, which counts the hot members. Their table is cached and recomputed where it is lost.
    """
    policy = policy or HotPolicy()
    table = hot_table(member_rows(sides), tuple(sides), policy).persist()
    found = table.count()
    if not found:
        table.unpersist()
        return None
    return HotMembers(table, tuple(sides), found <= policy.most_broadcast)


def member_rows(sides: Mapping[str, DataFrame]) -> DataFrame:
    """One row per member: its number of rows on each side, as ``<side>_rows``."""
    keys = [df.where(F.col(KEY).isNotNull()).select(KEY, F.lit(name).alias("side")) for name, df in sides.items()]
    counts = [F.count_if(F.col("side") == name).alias(f"{name}_rows") for name in sides]
    return reduce(DataFrame.unionAll, keys).groupBy(KEY).agg(*counts)


def hot_table(rows: DataFrame, sides: tuple[str, ...], policy: HotPolicy) -> DataFrame:
    """The hot members among the rows of ``member_rows``, with their cuts."""
    own = {side: F.col(f"{side}_rows") for side in sides}
    # A side that has no row of the member is never cut, and neither are the sides joined behind it: a
    # left row that finds no partner must appear once, not once per cell.
    is_paid = (own["payments"] > 0) & (own["customers"] > 0)
    used = {side: n if side == "defaulters" else F.when(is_paid, n).otherwise(0) for side, n in own.items()}
    if "defaulters" in own:
        used = {side: F.when(own["defaulters"] > 0, n).otherwise(0) for side, n in used.items()}
    counted = rows.select(KEY, F.array(*(n.cast("double") for n in used.values())).alias("rows"))
    output = reduce(mul, (F.greatest(F.col("rows")[i], F.lit(1.0)) for i in range(len(sides))))
    wanted = F.greatest(
        F.ceil(output / policy.most_output), F.ceil(F.array_max("rows") / policy.most_rows), F.lit(1)
    )
    wanted = F.least(wanted, F.lit(policy.max_cells)).cast("double")
    cut = (
        counted.withColumn("wanted", wanted)
        .where("wanted > 1")
        .withColumn("cuts", _cuts(F.col("rows"), F.col("wanted"), len(sides), policy.max_cells))
    )
    columns, stride = [], F.lit(1).cast("bigint")
    for i, side in enumerate(sides):
        cuts = F.col("cuts")[i].cast("bigint")
        columns += [cuts.alias(f"{side}_cuts"), stride.alias(f"{side}_stride")]
        stride = stride * cuts
    return cut.select(KEY, stride.alias("cells"), *columns).where("cells > 1")


def _cuts(rows: Column, wanted: Column, n: int, max_cells: int) -> Column:
    """Pieces per side. Halving the largest piece first keeps the copies sent to other cells near their least."""

    def halve(cuts: Column, _: Column) -> Column:
        pieces = F.zip_with(rows, cuts, lambda r, c: r / c)
        largest = F.array_position(pieces, F.array_max(pieces)) - 1
        more = F.transform(cuts, lambda c, i: F.when(i == largest, F.least(2 * c, F.get(rows, i))).otherwise(c))
        product = F.aggregate(cuts, F.lit(1.0), lambda a, c: a * c)
        return F.when((product < wanted) & (F.array_max(pieces) > 1), more).otherwise(cuts)

    steps = F.sequence(F.lit(1), F.lit(max(1, max_cells - 1).bit_length() + n))
    return F.aggregate(steps, F.array_repeat(F.lit(1.0), n), halve)


def cut_side(df: DataFrame, side: str, hot: HotMembers) -> DataFrame:
    """All rows of a side, sent to their cells; adds ``cell``, which is 0 for members that are not hot.

    A row's piece follows from its content. Rows folded into one with a count are spread evenly over the
    pieces, starting from the piece that the content decides.
    """
    placed = df.join(hot.of(["cells", f"{side}_cuts", f"{side}_stride"]), KEY, "left")
    numbers = {name: F.coalesce(F.col(name), F.lit(1).cast("bigint")) for name in ("cells", f"{side}_cuts", f"{side}_stride")}
    placed = placed.withColumns(numbers)
    cuts, stride = F.col(f"{side}_cuts"), F.col(f"{side}_stride")
    rows, content = f"{side}_rows", [c for c in df.columns if c != f"{side}_rows"]
    payload, start = content, F.pmod(F.xxhash64(*content), cuts)
    if rows in df.columns:
        nth = F.explode(F.sequence(F.lit(0).cast("bigint"), F.least(F.col(rows), cuts) - 1))
        share = F.floor(F.col(rows) / cuts) + (F.col("nth") < F.col(rows) % cuts).cast("bigint")
        placed = placed.withColumn("nth", nth).withColumn(rows, share).withColumn("piece", F.pmod(start + F.col("nth"), cuts))
        payload = [*content, rows]
    else:
        placed = placed.withColumn("piece", start)
    # All cells of that piece: the other sides' pieces above and below this side's stride.
    block = F.expr(f"other div {side}_stride")
    return placed.withColumn("other", F.explode(F.expr(f"sequence(0L, cells div {side}_cuts - 1)"))).select(
        *payload, (block * stride * cuts + F.col("piece") * stride + F.col("other") % stride).alias(CELL)
    )


def fold(df: DataFrame, rows: str) -> DataFrame:
    """Equal rows become one with a count ``rows``, or several where the count exceeds ``UNFOLD_STEP``.

    They are counted before they are shuffled.
    """
    left = F.col("all_rows") - F.col("step") * UNFOLD_STEP
    return (
        df.groupBy(*df.columns)
        .agg(F.count("*").alias("all_rows"))
        .withColumn("step", F.explode(F.expr(f"sequence(0L, (all_rows - 1) div {UNFOLD_STEP})")))
        .select(*df.columns, F.least(left, F.lit(UNFOLD_STEP).cast("bigint")).alias(rows))
    )


def unfold(df: DataFrame, rows: str) -> DataFrame:
    """Repeat each row as often as the column ``rows`` says, at most ``UNFOLD_STEP`` times, and drop that column."""
    kept = [c for c in df.columns if c != rows]
    return df.withColumn("copy", F.explode(F.array_repeat(F.lit(True), F.col(rows).cast("int")))).select(*kept)


def unfold_evenly(df: DataFrame, rows: str) -> DataFrame:
    """Like ``unfold``, for any counts: equal rows are folded, cut into shares, and the shares dealt to all tasks.

    How many rows a task makes then follows from their number alone, neither from members nor from the size of what was
    joined, by which adaptive execution would put many cells into one task.
    """
    kept = [c for c in df.columns if c != rows]
    left = F.col("all_rows") - F.col("share") * UNFOLD_SHARE
    shares = (
        df.groupBy(*kept)
        .agg(F.sum(rows).alias("all_rows"))
        .withColumn("share", F.explode(F.expr(f"sequence(0L, (all_rows - 1) div {UNFOLD_SHARE})")))
        .select(*kept, F.least(left, F.lit(UNFOLD_SHARE).cast("bigint")).alias("all_rows"))
        .repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    )
    step = F.explode(F.expr(f"sequence(0L, (all_rows - 1) div {UNFOLD_STEP})"))
    own = F.least(F.col("all_rows") - F.col("step") * UNFOLD_STEP, F.lit(UNFOLD_STEP).cast("bigint"))
    return unfold(shares.withColumn("step", step).select(*kept, own.alias(rows)), rows)
