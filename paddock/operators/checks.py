"""Rules on a table, measured while it is written.

A rule is one aggregate and the range it must lie in. All rules of a table are observed on the rows that pass into the
write, so that they cost no job and no further scan; rules that only look at column names cost nothing at all. The row
counts on both sides of a join are measured in the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from paddock.operators.joins import JoinAddsRows

SCHEMA = "table_name string, rule string, found double, low double, high double, broken boolean"


@dataclass(frozen=True)
class Rule:
    """`measure` is an aggregate; with `share` it is divided by the number of rows. `low` and `high` are allowed.

    A rule with `columns` is skipped for a table without them.
    """

    name: str
    measure: Column
    low: float = 0.0
    high: float = 0.0
    share: bool = False
    columns: tuple[str, ...] = ()


def at_most(name: str, breaks: Column, count: int = 0, columns: Sequence[str] = ()) -> Rule:
    """No more than `count` rows for which `breaks` is true."""
    return Rule(name, F.count_if(breaks), 0, count, columns=tuple(columns))


def expected_nulls(column: str, count: int) -> Rule:
    """Exactly so many nulls in a column."""
    return Rule(f"{column}_nulls", F.count_if(F.col(f"`{column}`").isNull()), count, count, columns=(column,))


def null_shares(columns: Sequence[str], limit: float = 0.3) -> list[Rule]:
    """No column may be null in more than this share of the rows."""
    return [Rule(f"{c}_mostly_null", F.count_if(F.col(f"`{c}`").isNull()), 0, limit, share=True, columns=(c,)) for c in columns]


@dataclass(frozen=True)
class Finding:
    table_name: str
    rule: str
    found: float
    low: float
    high: float

    @property
    def broken(self) -> bool:
        return not self.low <= self.found <= self.high

    def row(self) -> tuple:
        return self.table_name, self.rule, float(self.found), float(self.low), float(self.high), self.broken


@dataclass
class Watch:
    """A table whose rules are measured by the next action on `df`; read `findings` after it."""

    name: str
    df: DataFrame
    rules: list[Rule]
    required: Sequence[str] = ()
    _seen: Observation | None = field(default=None, repr=False)

    def __post_init__(self) -> None:
        self.rules = [r for r in self.rules if all(c in self.df.columns for c in r.columns)]
        self.missing = [c for c in self.required if c not in self.df.columns]
        self._seen = Observation()
        measures = [r.measure.alias(f"m{i}") for i, r in enumerate(self.rules)]
        self.df = self.df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *measures)

    @property
    def rows(self) -> int:
        return int(self._seen.get.get("rows", 0))

    def findings(self) -> list[Finding]:
        """What was measured, broken rules or not, and each required column that is not there."""
        found = self._seen.get
        rows = max(1, int(found.get("rows", 0)))
        values = [float(found.get(f"m{i}") or 0) / (rows if r.share else 1) for i, r in enumerate(self.rules)]
        return [Finding(self.name, f"{c}_missing", 1, 0, 0) for c in self.missing] + [
            Finding(self.name, r.name, v, r.low, r.high) for r, v in zip(self.rules, values)]


def as_table(spark: SparkSession, findings: Sequence[Finding]) -> DataFrame:
    return spark.createDataFrame([f.row() for f in findings], SCHEMA)


class RowsKept:
    """Whether a chain of left joins keeps the rows of its left side, measured by the action that writes the result."""

    def __init__(self, name: str, left: DataFrame, joins: Callable[[DataFrame], DataFrame]):
        self.name, self._before, self._after = name, Observation(), Observation()
        one = F.count(F.lit(1)).alias("rows")
        self.df = joins(left.observe(self._before, one)).observe(self._after, one)

    def require(self) -> int:
        """The number of rows; fails if the joins have added or lost some."""
        before, after = (int(o.get.get("rows", 0)) for o in (self._before, self._after))
        if before != after:
            raise JoinAddsRows(f"{self.name}: {before} rows before its joins, {after} behind them")
        return after
