"""Drop lines that many documents share, by levelled sorted runs of line hashes.

Documents come in batches, those with the largest ids first. A batch is reduced to one row per line: its hash, how many
documents have it, and the largest id among them. It is merge-anti-joined with the *runs* kept so far, sorted tables of
such rows: lines that a run shows to be in ``least_docs`` documents are settled, since all later ids are smaller, and
need no more counting. What is left becomes a run of level 0. When a level holds ``fan_in`` runs, they are compacted into
one run of the next level, so a line is rewritten once per level only.

All runs are dealt by line into the same number of buckets, which is the number of shuffle partitions: joining a
batch with a run moves the batch only. Hot lines are combined before the shuffle, and once settled they leave it.

When the last batch is in, the runs are merged, and every line in ``least_docs`` documents goes from all but the
largest id. Each document's lines are looked up in these shared lines, which are broadcast if a count finds them few. Beyond
that the lookup is a shuffled join, salted: a line that a third of all documents have is dealt to ``salts`` tasks.

``LineRuns`` can be used on its own for batches that arrive over time: ``unsettled`` tells the new lines of a batch, ``add``
keeps them. With ``least_docs=1`` these are the lines never seen before.

Lines are compared by the 128-bit hash of their key: the line without white space at both ends, A-Z lower-cased. Keys
shorter than ``least_chars`` always stay.

Edge cases: a null or empty text is one empty line; texts of any length are taken whole; each row counts as a document, also
rows with equal ids, and if they have the largest id of a line, all of them keep it; a null id is smaller than all others;
extra columns, whatever their names, pass through ``without_lines``; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmeter.llm.arrow_text import flat, mapped
from loanmeter.llm.shared_tables import shared_folder, stored

ROW = "row_hash"
_WHITE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class LineRules:
    least_chars: int = 40
    least_docs: int = 5
    batches: int = 4
    """Into how many ranges of ids ``without_lines`` deals the documents."""
    fan_in: int = 3
    """Runs of a level that are compacted into one of the next."""
    most_broadcast: int = 300_000
    """Shared lines, of some 80 bytes each, up to which they are broadcast."""
    salts: int = 16


def line_keys(text: Column) -> Column:
    """The keys of all lines of a text, in order."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.transform(lines, lambda x: F.translate(F.btrim(x, F.lit(_WHITE)), _UPPER, _UPPER.lower()))


def _hashed(key: Column, rules: LineRules) -> Column:
    return F.when(F.length(key) >= rules.least_chars, F.unhex(F.md5(key)))


def batch_lines(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """``line, n, top``: each line of a batch, in how many documents it is, and the largest id of these."""
    hashes = F.array_distinct(F.transform(line_keys(F.col("text")), lambda x: _hashed(x, rules)))
    top = F.coalesce("doc_id", F.lit(NO_ID)).alias("top")
    each = docs.select(top, F.explode(hashes).alias("line")).where("line is not null")
    return each.groupBy("line").agg(F.count("*").alias("n"), F.max("top").alias("top"))


class LineRuns:
    """Sorted runs of ``line, n, top`` on levels, as bucketed tables in the shared folder."""

    def __init__(self, spark: SparkSession, rules: LineRules = LineRules()):
        self.spark, self.rules = spark, rules
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]

    def _runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def unsettled(self, lines: DataFrame) -> DataFrame:
        """The lines of a batch that no run shows to be in ``least_docs`` documents."""
        for name in self._runs():
            settled = self.spark.table(name).where(F.col("n") >= self.rules.least_docs).select("line")
            lines = lines.join(settled, "line", "left_anti")
        return lines

    def add(self, lines: DataFrame) -> None:
        """Keep the lines as a run, and compact every level that is full."""
        self.levels[0].append(self._write(lines))
        level = 0
        while len(self.levels[level]) >= self.rules.fan_in:
            if level + 1 == len(self.levels):
                self.levels.append([])
            full, self.levels[level] = self.levels[level], []
            self.levels[level + 1].append(self._write(self._merged(full)))
            for name in full:
                self.spark.sql(f"drop table {name}")
            level += 1

    def merged(self) -> DataFrame:
        """All lines of all runs."""
        return self._merged(self._runs())

    def close(self) -> None:
        for name in self._runs():
            self.spark.sql(f"drop table {name}")
        self.levels = [[]]

    def _merged(self, names: list[str]) -> DataFrame:
        # Read as plain files: in a union, Spark 4.1 takes bucketed scans to be dealt alike even where it reads them otherwise.
        rows = self.spark.read.schema("line binary, n bigint, top bigint").parquet(*map(self._path, names))
        return rows.groupBy("line").agg(F.sum("n").alias("n"), F.max("top").alias("top"))

    def _write(self, lines: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        # The rows come from an aggregation by line, dealt as the buckets are: a bucket is in one task.
        writer = lines.write.bucketBy(self.buckets, "line").sortBy("line")
        writer.option("path", self._path(name)).saveAsTable(name)
        return name

    def _path(self, name: str) -> str:
        return f"{shared_folder(self.spark)}/{name}"


def shared_lines(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """``line, n, top`` for the lines that ``least_docs`` documents share; a stored table."""
    c = F.col
    levels = [i / rules.batches for i in range(1, rules.batches)]
    bounds = docs.agg(F.percentile_approx("doc_id", levels)).first()[0] if levels else []
    bounds = sorted(set(bounds or []), reverse=True)
    runs = LineRuns(docs.sparkSession, rules)
    above: int | None = None
    for low in [*bounds, None]:
        batch = docs.select("doc_id", "text")
        if low is not None:
            batch = batch.where(c("doc_id") >= low)
        if above is not None:
            batch = batch.where((c("doc_id") < above) | c("doc_id").isNull() if low is None else c("doc_id") < above)
        runs.add(runs.unsettled(batch_lines(batch, rules)))
        above = low
    shared = stored(runs.merged().where(c("n") >= rules.least_docs), "shared_lines")
    runs.close()
    return shared


def _gone(docs: DataFrame, rules: LineRules) -> DataFrame:
    """``of_doc, of_row, gone``: the numbers of the lines that a document loses, where it loses any."""
    c = F.col
    keys = F.transform(line_keys(c("text")), lambda x, i: F.struct(_hashed(x, rules).alias("line"), i.alias("place")))
    places = docs.select("doc_id", ROW, F.explode(F.filter(keys, lambda x: x["line"].isNotNull())).alias("x"))
    places, shared = places.select("doc_id", ROW, "x.*"), shared_lines(docs, rules)
    if shared.count() <= rules.most_broadcast:
        found = places.join(F.broadcast(shared), "line")
    else:
        salts = F.explode(F.array(*map(F.lit, range(rules.salts)))).alias("salt")
        salted = places.withColumn("salt", F.pmod(F.xxhash64(ROW, "place"), F.lit(rules.salts)).cast("int"))
        found = salted.join(shared.select("line", "top", salts), ["line", "salt"])
    lost = found.where(F.coalesce("doc_id", F.lit(NO_ID)) != c("top"))
    return lost.groupBy(c("doc_id").alias("of_doc"), c(ROW).alias("of_row")).agg(F.collect_set("place").alias("gone"))


KEPT = "kept string, n_lines bigint, n_dropped bigint"


def without_lines(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """``doc, text, kept, n_lines, n_dropped`` for every row: ``doc`` holds all columns of the input but the text,
    ``kept`` the lines that stay, joined by line feeds, and the counts are of lines."""
    others = [name for name in docs.columns if name != "text"]
    packed = docs.select(F.struct(*others).alias("doc"), "doc_id", F.xxhash64("doc_id", "text").alias(ROW), "text")
    gone = _gone(packed.select("doc_id", ROW, "text"), rules)
    same = (packed[ROW] == gone["of_row"]) & packed["doc_id"].eqNullSafe(gone["of_doc"])
    rows = packed.join(gone, same, "left").select("doc", "text", "gone")
    out = rows.select("doc", "text").schema.simpleString()
    schema = f"{out.removeprefix('struct<').removesuffix('>')}, {KEPT.replace(' bigint', ':bigint').replace(' string', ':string')}"
    return rows.mapInArrow(mapped(_without), schema)


def _without(part: pa.RecordBatch) -> pa.RecordBatch:
    data, offsets = flat(part.column("text"), b"\n")
    ends = np.flatnonzero(data == 10) + 1
    first_line = np.searchsorted(ends, offsets, "right")
    first_line[0] = 0
    n_lines = np.diff(first_line)
    gone = part.column("gone")
    counts = np.nan_to_num(gone.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    of = np.repeat(np.arange(part.num_rows), counts)
    drop = np.zeros(len(ends), bool)
    drop[first_line[of] + gone.flatten().to_numpy()] = True
    size = np.diff(np.r_[0, ends])
    left = np.repeat(~drop, size)
    # The line feed behind the last line that stays goes.
    before = np.r_[0, np.cumsum(~drop)][first_line]
    staying = np.flatnonzero(~drop)
    has_any = np.diff(before) > 0
    left[ends[staying[before[1:][has_any] - 1]] - 1] = False
    length = np.r_[0, np.cumsum(left)][offsets].astype(np.int32)
    kept = pa.Array.from_buffers(
        pa.string(), part.num_rows, [None, pa.py_buffer(length.tobytes()), pa.py_buffer(data[left].tobytes())]
    )
    return pa.record_batch(
        [part.column("doc"), part.column("text"), kept, pa.array(n_lines), pa.array(counts)],
        names=["doc", "text", "kept", "n_lines", "n_dropped"],
    )
