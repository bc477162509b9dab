"""Scoring parameters.

The values live in one frozen object that the plans turn into literals, so Catalyst folds
them and two runs with different parameters never share session state.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import SparkSession

CONF_PREFIX = "spark.loanmeter."


@dataclass(frozen=True)
class ScoreParams:
    # Points per rating.
    unacceptable: int = 0
    very_bad: int = 100
    bad: int = 250
    good: int = 500
    very_good: int = 650
    excellent: int = 800

    # Highest score that still gets the grade F, E, D, C, B. Above the last: A.
    cut_f: int = 750
    cut_e: int = 1000
    cut_d: int = 1500
    cut_c: int = 2000
    cut_b: int = 2500

    # Grade letters, best to worst.
    grade_a: str = "A"
    grade_b: str = "B"
    grade_c: str = "C"
    grade_d: str = "D"
    grade_e: str = "E"
    grade_f: str = "F"

    @classmethod
    def from_conf(cls, spark: SparkSession, prefix: str = CONF_PREFIX) -> ScoreParams:
        """Read overrides from the session, e.g. ``spark.loanmeter.good = 520``.

        Points and cuts are whole numbers. A name that is no parameter is an error.
        """
        kinds = {field.name: type(field.default) for field in fields(cls)}
        given = {k.removeprefix(prefix): v for k, v in spark.conf.getAll.items() if k.startswith(prefix)}
        unknown = sorted(given.keys() - kinds.keys())
        if unknown:
            raise ValueError(f"no such scoring parameters: {', '.join(prefix + name for name in unknown)}")
        return cls(**{name: kinds[name](value) for name, value in given.items()})
