"""Left joins of facts to dimensions, membership flags and join gates.

No broadcast hints: dimensions can be large, so the choice is left to Spark, which broadcasts only what it
has measured to be small and splits skewed sides otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Dimension:
    """A table to attach: its key (fact column name -> own column name), wanted columns, suffix for clashes."""

    table: DataFrame
    key: dict[str, str]
    columns: Sequence[str]
    suffix: str = ""
    rename: dict[str, str] = field(default_factory=dict)


def star_join(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Left join each dimension in turn. A column name wanted from several tables gets each table's suffix."""
    names = [c for d in dimensions for c in d.columns if c not in d.rename]
    clashes = {c for c in names if names.count(c) > 1}
    out = fact
    for d in dimensions:
        final = {c: d.rename.get(c, c + d.suffix if c in clashes else c) for c in d.columns}
        key = {own: f"__key_{own}" for own in d.key.values()}
        right = d.table.select(
            *[F.col(own).alias(k) for own, k in key.items()], *[F.col(c).alias(n) for c, n in final.items()]
        )
        on = [out[f] == right[key[own]] for f, own in d.key.items()]
        out = out.join(right, on, "left").drop(*key.values())
    return out


def attach_distinct(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Left join to the distinct rows of the wanted right columns."""
    return left.join(right.select(*keys, *columns).distinct(), keys, "left")


def with_membership(left: DataFrame, right: DataFrame, key: str, right_key: str, out: str) -> DataFrame:
    """Add whether the key occurs on the right. Distinct keys are taken first, so copies cost nothing."""
    keys = right.select(F.col(right_key).alias("__member")).where("__member is not null").distinct()
    return (
        left.join(keys, left[key] == keys["__member"], "left")
        .withColumn(out, F.col("__member").isNotNull())
        .drop("__member")
    )


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count: joining to such a table would add rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_per_key")).where("rows_per_key > 1")


class JoinAddsRows(ValueError):
    """The right side of a join that must keep the row count has repeated keys."""


def require_unique(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Fail if a key repeats. Cheaper than comparing row counts before and after the join."""
    worst = repeated_keys(df, keys).limit(3).collect()
    if worst:
        raise JoinAddsRows(f"{name}: repeated keys {[tuple(r) for r in worst]}")
    return df
