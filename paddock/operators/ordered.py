"""Ordered operators within groups: running totals, row numbers, ranks, previous values.

`order` lists column names, ascending; a leading "-" means descending (numeric columns). It must be a
total order within each group, so that results do not depend on row placement.

`bucket` cuts each group into consecutive ranges: an expression that never falls along `order`, such as the day of a
time. The window then runs per (group, bucket), and what earlier buckets contribute is added from a table of one row
per (group, bucket), joined by equality. So a group of any size is spread over tasks, and groups of all sizes are
treated alike. Without `bucket` a group is the work of one task: for groups that their grain bounds, such as the
seasons of a driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from paddock.operators.keys import ALL, any_null, balanced_bucket, null_spread, same_keys, value_bucket, without_nan

BUCKET = "__bucket"
RIGHT = "__right_"


def order_columns(order: list[str]) -> list[Column]:
    return [-F.col(c[1:]) if c.startswith("-") else F.col(c) for c in order]


def _with_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    return (df, keys) if keys else (df.withColumn(ALL, F.lit(0)), [ALL])


def _join_carry(local: DataFrame, carry: DataFrame, by: list[str]) -> DataFrame:
    keys = [*by, BUCKET]
    right = carry.withColumnsRenamed({k: f"{RIGHT}{k}" for k in keys})
    return local.join(right, same_keys(local, right, keys, RIGHT), "left")


def running_totals(
    df: DataFrame, keys: list[str], order: list[str], sums: dict[str, str], *, bucket: Column | None = None
) -> DataFrame:
    """Running sum up to and including the current row; `sums` maps output name to input column.

    Nulls are skipped: the total is null until the first value of the group.
    """
    data, by = _with_keys(df, keys)
    upto = W.unboundedPreceding, W.currentRow
    if bucket is None:
        w = W.partitionBy(*by).orderBy(*order_columns(order)).rowsBetween(*upto)
        return data.withColumns({name: F.sum(c).over(w) for name, c in sums.items()}).select(*df.columns, *sums)

    cut = data.withColumn(BUCKET, bucket)
    w = W.partitionBy(*by, BUCKET).orderBy(*order_columns(order)).rowsBetween(*upto)
    local = cut.withColumns({name: F.sum(c).over(w) for name, c in sums.items()})
    before = W.partitionBy(*by).orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
    carry = (
        cut.groupBy(*by, BUCKET).agg(*[F.sum(c).alias(f"__total_{n}") for n, c in sums.items()])
        .select(*by, BUCKET, *[F.sum(f"__total_{n}").over(before).alias(f"__carry_{n}") for n in sums])
    )
    joined = _join_carry(local, carry, by)
    return joined.select(*df.columns, *[
        F.coalesce(F.col(n) + F.col(f"__carry_{n}"), F.col(n), F.col(f"__carry_{n}")).alias(n) for n in sums])


def row_numbers(df: DataFrame, keys: list[str], order: list[str], out: str, *, bucket: Column | None = None) -> DataFrame:
    """Position of each row in its group, from 1."""
    one = df.withColumn("__one", F.lit(1).cast("long"))
    return running_totals(one, keys, order, {out: "__one"}, bucket=bucket).drop("__one")


def previous_values(
    df: DataFrame, keys: list[str], order: list[str], previous: dict[str, str], *, bucket: Column | None = None
) -> DataFrame:
    """Value of the preceding row of the group; null on the first row. Maps output name to column."""
    if bucket is None:
        w = W.partitionBy(*keys).orderBy(*order_columns(order))
        return df.withColumns({name: F.lag(c).over(w) for name, c in previous.items()})

    cut = df.withColumn(BUCKET, bucket)
    w = W.partitionBy(*keys, BUCKET).orderBy(*order_columns(order))
    local = cut.withColumns({name: F.lag(c).over(w) for name, c in previous.items()}).withColumn(
        "__first", F.row_number().over(w) == 1
    )
    point = F.struct(*order_columns(order))
    last = cut.groupBy(*keys, BUCKET).agg(
        F.max_by(F.struct(*[F.col(c).alias(n) for n, c in previous.items()]), point).alias("__last")
    )
    carry = last.select(
        *keys, BUCKET, F.lag("__last").over(W.partitionBy(*keys).orderBy(BUCKET)).alias("__carry")
    )
    joined = _join_carry(local, carry, keys)
    return joined.select(
        *df.columns,
        *[F.when(F.col("__first"), F.col(f"__carry.{n}")).otherwise(F.col(n)).alias(n) for n in previous],
    )


def min_rank(
    df: DataFrame, keys: list[str], value: str, out: str, *, descending: bool = True, best: str | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Competition rank (1, 2, 2, 4) of a numeric `value` in its group; `best` names the value of rank 1.

    A null or NaN value has no rank and moves no other; rows with a null key have none. With `bounded` the caller states that
    the grain bounds every group (the drivers of a race), and one window ranks it. Otherwise equal values are counted
    together; the rank of a value is one plus the number of rows before it, a running total over the counted values.
    """
    known = without_nan(df, value)
    if bounded:
        w = W.partitionBy(*keys, null_spread(df, keys)) if keys else W.partitionBy()
        last = known.desc_nulls_last() if descending else known.asc_nulls_last()
        has = known.isNotNull() & ~any_null(keys) if keys else known.isNotNull()
        ranked = df.withColumn(out, F.when(has, F.rank().over(w.orderBy(last))).cast(T.IntegerType()))
        if best:
            top = (F.max(known) if descending else F.min(known)).over(w)
            ranked = ranked.withColumn(best, F.when(~any_null(keys), top) if keys else top)
        return ranked.select(*df.columns, out, *([best] if best else []))
    counted = df.where(known.isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    sign = -1 if descending else 1
    order = [f"-{value}" if descending else value]
    bucket = value_bucket(F.col(value)) if keys else balanced_bucket(counted, value)
    ranks = running_totals(counted, keys, order, {"__upto": "__n"}, bucket=sign * bucket).select(
        *keys, value, (F.col("__upto") - F.col("__n") + 1).cast(T.IntegerType()).alias(out)
    )
    ranked = df.join(ranks, [*keys, value], "left") if keys else df.join(ranks, value, "left")
    if best:
        tops = counted.groupBy(*keys).agg((F.max(value) if descending else F.min(value)).alias(best))
        ranked = ranked.join(tops, keys, "left") if keys else ranked.join(F.broadcast(tops))  # one row
    return ranked.select(*df.columns, out, *([best] if best else []))


def _with_halo(df: DataFrame, number: str, size: int, reach: int) -> DataFrame:
    """Rows in ranges of `size` numbers, and copies of those within `reach` of a border in the range behind it."""
    cell = lambda by: F.floor((F.col(number) - 1 + by) / size)
    spread = F.explode(F.sequence(cell(-reach), cell(reach)))
    return df.select("*", cell(0).alias("__home"), spread.alias(BUCKET))


def neighbours(
    df: DataFrame, keys: list[str], number: str, wanted: dict[str, tuple[str, int]], *, size: int = 100_000
) -> DataFrame:
    """Values of rows at fixed distances: `wanted` maps output name to (column, distance), 1 being the preceding row.

    `number` is the row number in the group, without gaps. A group is cut into ranges of numbers, each with copies of the few
    rows beyond its borders, and one window per range sees all it needs: the rows are shuffled once, and no group
    gathers in a task. Where no such row exists the value is null.
    """
    reach = max(abs(d) for _, d in wanted.values())
    if reach >= size:
        raise ValueError("a range must be longer than the reach")
    w = W.partitionBy(*keys, BUCKET).orderBy(number)
    cut = _with_halo(df, number, size, reach)
    found = cut.withColumns({n: F.lag(c, d).over(w) for n, (c, d) in wanted.items()})
    return found.where(F.col(BUCKET) == F.col("__home")).select(*df.columns, *wanted)


def rolling_mean(
    df: DataFrame, keys: list[str], order: list[str], value: str, out: str, rows: int, *, number: str | None = None,
    size: int = 100_000,
) -> DataFrame:
    """Mean over the current and the `rows - 1` preceding rows present, one row being enough; nulls are not counted.

    Without `number` a group is one task's work: for tables at period grain (one row per entity and season), whose groups
    the calendar bounds. With `number`, the row number in the group, groups can be of any length, see `neighbours`.
    """
    if number is None:
        w = W.partitionBy(*keys).orderBy(*order_columns(order)).rowsBetween(-(rows - 1), 0)
        return df.withColumn(out, F.avg(value).over(w))
    w = W.partitionBy(*keys, BUCKET).orderBy(number).rowsBetween(-(rows - 1), 0)
    found = _with_halo(df, number, size, rows - 1).withColumn(out, F.avg(value).over(w))
    return found.where(F.col(BUCKET) == F.col("__home")).select(*df.columns, out)


def around_events(
    df: DataFrame, keys: list[str], number: str, event: str, reach: int, offset: str = "offset",
    wanted: dict[str, tuple[str, int]] | None = None, *, size: int = 100_000,
) -> DataFrame:
    """Rows within `reach` positions of each flagged row, with their offset from it; a row near two events comes twice.

    `number` is the row number in the group, without gaps; `wanted` are neighbours' values to add, as in `neighbours`. Each row
    looks at the flags of the rows round it, so the events need no join.
    """
    near = range(-reach, reach + 1)
    flags = {f"__event{d}": (event, d) for d in near}
    found = neighbours(df, keys, number, flags | (wanted or {}), size=size)
    offsets = F.array(*[F.when(F.col(f"__event{d}"), F.lit(d)) for d in near])
    return found.withColumn(offset, F.explode(F.array_compact(offsets))).drop(*flags)
