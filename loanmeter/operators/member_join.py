"""The join of the score: all sides meet on ``member_id``.

    defaulters LEFT (payments INNER customers) LEFT loans LEFT accounts

Loans and accounts belong to the member id found on the *payments* side, which is NULL for a
defaulter without payments. Joining on that column would shuffle the widest intermediate
again, with every unmatched row in one partition. Where that id is not NULL it equals the
defaulter's own id, so all joins use the defaulter's id plus the condition "has payments". Each
table is then shuffled once, and the row multiplication happens inside one stage.

Rows multiply when a member has several rows on several sides. That is the specified result.
Payments, the side with most rows per member, have few distinct points: equal ones are folded into one row with a
count before they are shuffled, and unfolded after the last join. So the shuffle, the sort and
the row groups a join keeps in memory stay small, even for members with millions of payments.

Hot members are cut into cells (``hot_members``). The same joins serve them and all others. Where there are hot
members, what was joined is folded once more and dealt evenly to all tasks before it is unfolded: the output of one member
may be the product of its payments and loans.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmeter.operators.hot_members import CELL, KEY, HotMembers, cut_side, fold, unfold, unfold_evenly

PAID = "paid_member"
ROWS = "rows"
OPTIONAL = ("loans", "accounts")


Finish = Callable[[DataFrame], DataFrame]


def join_members(
    sides: Mapping[str, DataFrame],
    hot: HotMembers | None = None,
    finish: Finish = lambda joined: joined,
    columns: Sequence[str] = (),
) -> DataFrame:
    """Join the given sides; each has ``member_id`` and columns of its own.

    ``payments`` and ``customers`` are required. With ``defaulters`` the result has one or more
    rows per defaulter row and ``member_id`` is NULL where payments or customers lack the member.
    A joined optional side adds ``has_<side>``.

    ``finish`` adds columns to a joined row, and ``columns`` names those to keep. Both are applied
    before folded rows are unfolded, so the work is done once per distinct row.
    """

    def finished(joined: DataFrame) -> DataFrame:
        done = finish(joined)
        return done.select(*columns, *({ROWS} & set(done.columns))) if columns else done

    whole = "defaulters" in sides
    cut = {name: df.where(F.col(KEY).isNotNull()) for name, df in sides.items()}
    cut["payments"] = fold(cut["payments"], ROWS)
    on = [KEY]
    if hot:
        cut["payments"] = cut["payments"].withColumnRenamed(ROWS, "payments_rows")
        cut = {name: cut_side(df, name, hot) for name, df in cut.items()}
        cut["payments"] = cut["payments"].withColumnRenamed("payments_rows", ROWS)
        on = [KEY, CELL]
        if whole:
            cut["defaulters"] = _with_flags(cut["defaulters"], sides, hot)
    joined = _join(cut, on, bool(hot))
    if whole:
        joined = joined.withColumn(ROWS, F.coalesce(ROWS, F.lit(1)))
    result = (unfold_evenly if hot else unfold)(finished(joined), ROWS)
    if whole:
        nobody = _null_members(sides["defaulters"], joined.drop(ROWS))
        result = result.unionByName(finished(nobody))
    return result


def _join(sides: Mapping[str, DataFrame], on: list[str], cut: bool = False) -> DataFrame:
    paid = sides["payments"].join(sides["customers"], on)
    if "defaulters" not in sides:
        return paid.drop(CELL)

    out = sides["defaulters"].join(paid.withColumn(PAID, F.col(KEY)), on, "left")
    if cut:
        # Pieces may be empty. A member known to have partners has one in some other cell.
        out = out.where(F.col(PAID).isNotNull() | ~F.col("paid_is_cut"))
    for name in OPTIONAL:
        if name not in sides:
            continue
        side = sides[name].withColumnsRenamed({k: f"{name}_{k}" for k in on})
        same = reduce(and_, (F.col(k) == F.col(f"{name}_{k}") for k in on))
        out = out.join(side, same & F.col(PAID).isNotNull(), "left")
        has = F.col(f"{name}_{KEY}").isNotNull()
        if cut:
            out = out.where(has | ~F.col(f"{name}_is_cut"))
        out = out.withColumn(f"has_{name}", has).drop(*(f"{name}_{k}" for k in on), f"{name}_is_cut")
    return out.drop(KEY, CELL, "paid_is_cut").withColumnRenamed(PAID, KEY)


def _null_members(defaulters: DataFrame, joined: DataFrame) -> DataFrame:
    """Defaulter rows without a member id: they match nothing, so they skip the joins."""
    nobody = defaulters.where(F.col(KEY).isNull()).drop(KEY)
    flags = {f"has_{name}" for name in OPTIONAL}
    missing = {
        f.name: F.lit(False if f.name in flags else None).cast(f.dataType)
        for f in joined.schema
        if f.name not in nobody.columns
    }
    return nobody.withColumns(missing)


def _with_flags(defaulters: DataFrame, sides: Mapping[str, DataFrame], hot: HotMembers) -> DataFrame:
    """Which other sides of the member are cut, so that a missing partner may be in another cell."""
    cut = {"paid_is_cut": (F.col("payments_cuts") > 1) | (F.col("customers_cuts") > 1)}
    cut |= {f"{n}_is_cut": F.col(f"{n}_cuts") > 1 for n in OPTIONAL if n in sides}
    flags = hot.of([c.alias(name) for name, c in cut.items()])
    return defaulters.join(flags, KEY, "left").withColumns({n: F.coalesce(n, F.lit(False)) for n in cut})
