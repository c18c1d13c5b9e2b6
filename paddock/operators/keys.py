"""Rows with and without keys, and order-preserving cells and buckets for numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

ALL = "__all"
STEPS = 1024  # buckets per doubling of a number
COARSE, FINE = 1 << 12, 1 << 20  # cells per doubling, and cells within one of those
LEAST, GREATEST = 5e-324, 1.7976931348623157e308


def with_keys_only(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows with a null key: such rows belong to no group."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def null_spread(df: DataFrame, keys: list[str], parts: int = 1024) -> Column:
    """A further key that spreads the rows with a null key over tasks, and is the same for all other rows."""
    return F.when(any_null(keys), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(parts)))


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], prefix: str) -> Column:
    """Equality of keys, nulls being equal, with the right side's columns under a prefix."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"{prefix}{k}"]) for k in keys])


def value_bucket(value: Column) -> Column:
    """A bucket that never falls as the number grows: STEPS for each doubling, a few for all numbers below one.

    Their number is bounded by the range of the type, whatever the number of rows.
    """
    v = value.cast("double")
    steps = F.floor(F.log2(F.abs(v) + 1) * STEPS)
    return F.when(v < 0, -steps).otherwise(steps)


def present(value: Column) -> Column:
    """The value as a double, null for NaN: NaN means that there is no value."""
    v = value.cast("double")
    return F.when(~F.isnan(v), v)


def without_nan(df: DataFrame, column: str) -> Column:
    """The column, null for NaN; columns that cannot hold NaN are left as they are."""
    c = F.col(column)
    return F.when(~F.isnan(c), c) if dict(df.select(column).dtypes)[column] in ("double", "float") else c


def _place(value: Column) -> Column:
    """Place of a number's size on a logarithmic scale with COARSE * FINE steps for each doubling: one logarithm, which never
    falls as the size grows. About 2^20 doubles share a step."""
    size = F.least(F.greatest(F.abs(value), F.lit(LEAST)), F.lit(GREATEST))
    return F.floor((F.log2(size) + 1100) * (COARSE * FINE))


def coarse_cell(value: Column) -> Column:
    """Cell of a double, COARSE for each doubling, that never falls as the number grows; zero has cell zero."""
    return (F.signum(value) * F.floor(_place(value) / FINE)).cast("long")


def fine_cell(value: Column) -> Column:
    """Cell of a double within its coarse cell, FINE of them."""
    return (F.signum(value) * F.pmod(_place(value), F.lit(FINE))).cast("long")


def balanced_bucket(counted: DataFrame, value: str, parts: int | None = None) -> Column:
    """A bucket that never falls as `value` grows and holds about 1/parts of the rows of `counted` at most.

    Rows are first counted by coarse cell. A cell with more than its share is cut evenly between its least and greatest value;
    at most `parts` cells are, so what a row looks up is bounded. Counts, least and greatest values are exact, so
    the buckets are the same however often the counting is run. Infinite values have buckets of their own.
    """
    return _cut_bucket(F.col(value).cast("double"), _cuts(counted, value, parts).scalar())


def with_balanced_bucket(counted: DataFrame, value: str, out: str, parts: int | None = None) -> DataFrame:
    """`counted` with its balanced bucket. The cuts are one joined row, so that a costly `counted` is made once for both; as
    subquery they would make it again."""
    cut = counted.join(F.broadcast(_cuts(counted, value, parts).withColumnRenamed("cuts", "__cuts")))
    return cut.withColumn(out, _cut_bucket(F.col(value).cast("double"), F.col("__cuts"))).drop("__cuts")


def _cuts(counted: DataFrame, value: str, parts: int | None) -> DataFrame:
    """One row: a map from the coarse cells that are cut to where and into how many."""
    session = counted.sparkSession
    parts = parts or 4 * int(session.conf.get("spark.sql.shuffle.partitions"))
    v = F.col(value).cast("double")
    finite = F.when(F.abs(v) <= GREATEST, v)
    # Other values go after the count: a filter before it would make `counted` another plan, which shares nothing.
    cells = counted.groupBy(F.when(finite.isNotNull(), coarse_cell(v)).alias("cell")).agg(
        F.count(finite).alias("n"), F.min(finite).alias("lo"), F.max(finite).alias("hi")).where("n > 0")
    # One row with all cells, whose number the type bounds: one subquery.
    listed = cells.agg(F.sum("n").alias("total"), F.collect_list(F.struct("cell", "n", "lo", "hi")).alias("cells"))
    share = F.greatest(F.ceil(F.col("total") / parts), F.lit(1))
    cuts = F.transform(F.filter("cells", lambda c: (c["n"] > share) & (c["lo"] < c["hi"])), lambda c: F.struct(c["cell"], F.struct(
        c["lo"].alias("lo"), c["hi"].alias("hi"), F.least(F.ceil(c["n"] / share), F.lit(FINE - 1)).cast("double").alias("cuts"))))
    return listed.select(F.map_from_entries(cuts).alias("cuts"))


def _cut_bucket(v: Column, table: Column) -> Column:
    cell = coarse_cell(v)
    cut = F.try_element_at(table, cell)
    inside = F.least(F.floor((v - cut["lo"]) / (cut["hi"] - cut["lo"]) * cut["cuts"]), F.lit(FINE - 1))
    edge = 1 << 60
    return (F.when(v > GREATEST, F.lit(edge)).when(v < -GREATEST, F.lit(-edge))
            .otherwise(cell * FINE + F.when(cut.isNotNull(), F.greatest(inside, F.lit(0))).otherwise(0)).cast("long"))
