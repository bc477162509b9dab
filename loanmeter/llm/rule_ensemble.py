"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted shallow trees are grown on a bounded labelled sample; every path from a root to a node becomes
a rule, a conjunction of bounds on statistics. A lasso logistic regression gives the rules weights, most
of them zero. What is left is compiled into one Spark column expression that scores every document.

Edge cases: a null or empty text has all statistics 0 and is scored like any other; texts of any length
are read whole; labels that are null are not learned from; without any labelled row, or with one class
only, the score is the share of label 1 (0.5 without labels); equal rows give equal scores, one each;
other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmeter.llm.arrow_text import WHITE, flat, lower_ascii, mapped, mix, per_text, prefix_hash, span_hash, word_spans

STATISTICS = (
    "log_words", "mean_word", "upper_share", "digit_share", "symbol_share", "bang_share", "bar_share",
    "stop_share", "non_ascii_share", "distinct_words", "same_as_previous", "repeated_pairs", "repeated_lines",
    "line_words", "longest_word",
)
SCHEMA = "doc_id bigint, " + ", ".join(f"{s} double" for s in STATISTICS)


def _bytes(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_UPPER, _DIGIT = _bytes(bytes(range(65, 91))), _bytes(bytes(range(48, 58)))
_SIGNS = {"symbol_share": _bytes(b"#*$%&<>"), "bang_share": _bytes(b"!?"), "bar_share": _bytes(b"|"), "stop_share": _bytes(b".,;:")}


def text_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every whole text."""
    return docs.select("doc_id", "text").mapInArrow(mapped(_statistics), SCHEMA)


def _statistics(part: pa.RecordBatch) -> pa.RecordBatch:
    data, offsets = flat(part.column("text"), b"\n")
    n = part.num_rows
    starts, ends, of = word_spans(data, offsets)
    n_words = np.bincount(of, minlength=n)
    solid = np.maximum(per_text(~WHITE[data], offsets), 1)
    words = np.maximum(n_words, 1)

    scope = mix(of.astype(np.uint64) + np.uint64(1))
    word = span_hash(prefix_hash(lower_ascii(data)), starts, ends) ^ scope
    same = np.zeros(n, np.int64)
    pairs_seen = pairs = np.zeros(n, np.int64)
    if len(word):
        same = np.bincount(of[1:][word[1:] == word[:-1]], minlength=n)
        inside = of[1:] == of[:-1]
        pair = mix(word[:-1] + mix(word[1:]))[inside]
        pair_of = of[1:][inside]
        pairs = np.bincount(pair_of, minlength=n)
        pairs_seen = np.bincount(pair_of[np.unique(pair, return_index=True)[1]], minlength=n)
    distinct = np.bincount(of[np.unique(word, return_index=True)[1]], minlength=n)

    line_ends = np.flatnonzero(data == 10)
    line_starts = np.r_[0, line_ends[:-1] + 1][: len(line_ends)]
    full = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[full], line_ends[full]
    line_of = np.searchsorted(offsets, line_starts, "right") - 1
    line = span_hash(prefix_hash(data), line_starts, line_ends) ^ mix(line_of.astype(np.uint64) + np.uint64(1))
    lines = np.bincount(line_of, minlength=n)
    lines_seen = np.bincount(line_of[np.unique(line, return_index=True)[1]], minlength=n)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, of, ends - starts)

    values = {
        "log_words": np.log1p(n_words),
        "mean_word": np.bincount(of, weights=ends - starts, minlength=n) / words,
        "upper_share": per_text(_UPPER[data], offsets) / solid,
        "digit_share": per_text(_DIGIT[data], offsets) / solid,
        **{name: per_text(table[data], offsets) / solid for name, table in _SIGNS.items()},
        "non_ascii_share": per_text(data >= 0x80, offsets) / solid,
        "distinct_words": distinct / words,
        "same_as_previous": same / words,
        "repeated_pairs": (pairs - pairs_seen) / np.maximum(pairs, 1),
        "repeated_lines": (lines - lines_seen) / np.maximum(lines, 1),
        "line_words": n_words / np.maximum(lines, 1),
        "longest_word": np.log1p(longest),
    }
    arrays = [pa.array(np.asarray(values[s], np.float64)) for s in STATISTICS]
    return pa.record_batch([part.column("doc_id"), *arrays], names=["doc_id", *STATISTICS])


@dataclass(frozen=True)
class EnsembleRules:
    sample_rows: int = 20_000
    """Labelled documents the trees and weights are fitted on, at most."""
    trees: int = 40
    depth: int = 3
    shrinkage: float = 0.3
    least_rows: int = 10
    """Rows a leaf has at least."""
    penalty: float = 0.002
    rounds: int = 400


@dataclass(frozen=True)
class Rule:
    """All bounds hold: ``(statistic, is_above, bound)``; above is strict."""

    bounds: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def column(self) -> Column:
        held = F.lit(True)
        for name, above, bound in self.bounds:
            held = held & ((F.col(name) > bound) if above else (F.col(name) <= bound))
        return F.when(held, self.weight).otherwise(0.0)

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, above, bound in self.bounds:
            value = x[:, STATISTICS.index(name)]
            out &= value > bound if above else value <= bound
        return out


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[Rule, ...]

    def score(self) -> Column:
        """The probability of label 1 as an expression over the statistics."""
        margin = F.lit(float(self.intercept))
        for rule in self.rules:
            margin = margin + rule.column()
        return 1.0 / (1.0 + F.exp(-margin))


def labelled_sample(statistics: DataFrame, labels: DataFrame, label: str, rules: EnsembleRules) -> DataFrame:
    """One row for each labelled id, and of these the ``sample_rows`` that a hash of the id draws first, exactly.

    An id with several labels counts with the highest; of several documents with one id, the one with the smallest statistics
    counts. So repeated ids, however many rows they have, do not enlarge the sample.
    """
    c = F.col
    known = labels.where(c(label).isNotNull() & c("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y"))
    known = known.join(statistics.select("doc_id"), "doc_id", "left_semi")
    drawn = known.orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(rules.sample_rows)
    own = statistics.join(drawn, "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct(*STATISTICS)).alias("own"))
    return own.select("doc_id", "own.*", "y")


def fit(sample: DataFrame, rules: EnsembleRules = EnsembleRules()) -> RuleModel:
    """Trees, rules and weights. ``sample`` is bounded by ``labelled_sample``."""
    table = sample.orderBy("doc_id", *STATISTICS, "y").toPandas()
    x, y = table[list(STATISTICS)].to_numpy(float), (table["y"].to_numpy() > 0).astype(float)
    if not len(y) or y.min() == y.max():
        share = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
        return RuleModel(float(np.log(share / (1 - share))), ())
    found = list(dict.fromkeys(_grow(x, y, rules)))
    return _lasso(x, y, found, rules)


def _grow(x: np.ndarray, y: np.ndarray, rules: EnsembleRules):
    """Paths of boosted trees; each tree sees half of the rows."""
    random = np.random.default_rng(5)
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(rules.trees):
        p = 1 / (1 + np.exp(-margin))
        rows = np.flatnonzero(random.random(len(y)) < 0.5)
        todo = [((), rows, np.arange(len(y)))]
        for _ in range(rules.depth):
            after = []
            for path, own, everyone in todo:
                best = _split(x[own], (y - p)[own], rules.least_rows)
                if best is None:
                    continue
                feature, bound = best
                for above in (False, True):
                    step = (STATISTICS[feature], above, bound)
                    inside = own[(x[own, feature] > bound) == above]
                    all_inside = everyone[(x[everyone, feature] > bound) == above]
                    yield Rule((*path, step))
                    after.append(((*path, step), inside, all_inside))
            todo = after or todo
        for _, own, everyone in todo:
            hessian = (p * (1 - p))[own].sum() + 1e-3
            margin[everyone] += rules.shrinkage * np.clip((y - p)[own].sum() / hessian, -4, 4)


def _split(x: np.ndarray, residual: np.ndarray, least: int) -> tuple[int, float] | None:
    """Feature and bound with the largest gain in squared error."""
    n, best = len(residual), None
    if n < 2 * least:
        return None
    total, top = residual.sum(), 1e-6
    for feature in range(x.shape[1]):
        order = np.argsort(x[:, feature], kind="stable")
        value, left = x[order, feature], np.cumsum(residual[order])[:-1]
        count = np.arange(1, n)
        gain = left**2 / count + (total - left) ** 2 / (n - count) - total**2 / n
        gain[(value[1:] == value[:-1]) | (count < least) | (n - count < least)] = 0
        at = int(gain.argmax())
        if gain[at] > top:
            top, best = gain[at], (feature, float((value[at] + value[at + 1]) / 2))
    return best


def _lasso(x: np.ndarray, y: np.ndarray, found: list[Rule], rules: EnsembleRules) -> RuleModel:
    """Accelerated proximal gradient on the logistic loss with an L1 penalty."""
    z = np.column_stack([r.holds(x) for r in found]).astype(float)
    weight = np.zeros(z.shape[1])
    intercept = float(np.log(y.mean() / (1 - y.mean())))
    ahead, ahead_intercept, pace = weight, intercept, 1.0
    step = 4.0 / (np.linalg.norm(z, 2) ** 2 / len(y) + 1)
    for _ in range(rules.rounds):
        error = 1 / (1 + np.exp(-(z @ ahead + ahead_intercept))) - y
        moved = ahead - step * (z.T @ error) / len(y)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * rules.penalty, 0)
        new_intercept = ahead_intercept - step * error.mean()
        new_pace = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead = new + (pace - 1) / new_pace * (new - weight)
        ahead_intercept = new_intercept + (pace - 1) / new_pace * (new_intercept - intercept)
        weight, intercept, pace = new, new_intercept, new_pace
    kept = (Rule(r.bounds, float(w)) for r, w in zip(found, weight, strict=True) if abs(w) > 1e-4)
    return RuleModel(float(intercept), tuple(kept))
