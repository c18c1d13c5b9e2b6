"""Lookups whose key is a range: a value lies between two bounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F


class OverlappingRanges(ValueError):
    """Two ranges of one key share a value, so that a lookup would add rows."""


def require_disjoint(table: DataFrame, keys: Sequence[str], low: str, high: str) -> DataFrame:
    """Fail if a range is empty, or if two ranges (bounds inclusive) of one key overlap. For lookup tables.

    A range is compared with the greatest bound of all that begin before it, not only with its neighbour's.
    """
    begun = W.partitionBy(*keys).orderBy(low, high).rowsBetween(W.unboundedPreceding, -1)
    wrong = table.withColumn("__before", F.max(high).over(begun)).where(
        F.col(low).isNull() | F.col(high).isNull() | (F.col(low) > F.col(high)) | (F.col(low) <= F.col("__before")))
    worst = wrong.drop("__before").limit(3).collect()
    if worst:
        raise OverlappingRanges(f"ranges overlap or are empty: {[tuple(r) for r in worst]}")
    return table


def attach_by_range(
    df: DataFrame, table: DataFrame, value: str, low: str, high: str, columns: Sequence[str], on: dict[str, str] | None = None,
) -> DataFrame:
    """Left join to the row of `table` whose bounds hold `value`, and whose other keys are equal (`on`: own to table's name).

    The bounds must not overlap within a key, see `require_disjoint`. With equal keys Spark hashes on those and tests the bounds on
    the few rows that share them; the table's size decides whether it is broadcast.
    """
    names = {c: f"__r_{c}" for c in dict.fromkeys([low, high, *columns, *(on or {}).values()])}
    right = table.select(*[F.col(c).alias(n) for c, n in names.items()])
    match = F.col(value).between(F.col(names[low]), F.col(names[high]))
    for own, other in (on or {}).items():
        match = match & (F.col(own) == F.col(names[other]))
    return df.join(right, match, "left").select(*df.columns, *[F.col(names[c]).alias(c) for c in columns])
