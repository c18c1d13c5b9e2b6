"""Group aggregates put back on rows, first or best row per key, exact quantiles and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from paddock.operators.keys import ALL, any_null, null_spread, present, with_balanced_bucket, with_keys_only, without_nan
from paddock.operators.ordered import running_totals
from paddock.operators.selection import refined_quantiles


def attach_group_stats(df: DataFrame, keys: list[str], stats: dict[str, Column]) -> DataFrame:
    """Add aggregates of the row's group, such as the team mean. Rows with a null key get null.

    The aggregate combines before its shuffle, so no group is gathered; its rows are joined back by equality, a join
    that splits a hot key.
    """
    table = with_keys_only(df, keys).groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return df.join(table, keys, "left").select(*df.columns, *stats)


def attach_bounded_stats(df: DataFrame, keys: list[str], stats: dict[str, Column]) -> DataFrame:
    """As attach_group_stats, for groups whose grain bounds them (a team's drivers in a race): one shuffle, no join.

    Rows with a null key are no group and can be many; they are spread by their content.
    """
    w = W.partitionBy(*keys, null_spread(df, keys))
    return df.withColumns({n: F.when(~any_null(keys), c.over(w)) for n, c in stats.items()}).select(*df.columns, *stats)


def attach_bounded_first(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Replace the columns by those of the group's first row by `order`, for groups whose grain bounds them; null without a key."""
    first = F.first(F.struct(*columns)).over(W.partitionBy(*keys, null_spread(df, keys)).orderBy(*order))
    found = df.withColumn("__first", F.when(~any_null(keys), first))
    return found.withColumns({c: F.col(f"__first.{c}") for c in columns}).drop("__first")


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by `order`.

    The row_number filter lets Spark keep one row per key in each map task before the shuffle, so copies
    of one key do not gather in a task.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def exact_quantiles(
    df: DataFrame, keys: list[str], aggs: dict[str, Column], quantiles: dict[str, tuple[str, float]], *, bounded: bool = False
) -> DataFrame:
    """Group aggregates together with exact interpolated quantiles, one row per group. NaN counts as no value.

    With `bounded` the caller states that the grain bounds every group (the stops of a driver in a race): one aggregate
    holds a group's values. Otherwise groups can be of any size, and passes over cells of the number line find the
    values, see `selection`.
    """
    data = with_keys_only(df, keys) if keys else df.withColumn(ALL, F.lit(0))
    by = keys or [ALL]
    named = [c.alias(n) for n, c in aggs.items()]
    if bounded:
        exact = [F.percentile(present(F.col(c)), p).alias(n) for n, (c, p) in quantiles.items()]
        return data.groupBy(*by).agg(*named, *exact).select(*keys, *aggs, *quantiles)
    result = data.groupBy(*by).agg(F.count(F.lit(1)).alias("__rows"), *named)
    if keys:
        return result.join(refined_quantiles(data, by, quantiles), by, "left").select(*keys, *aggs, *quantiles)
    return result.join(F.broadcast(refined_quantiles(df, [], quantiles))).select(*aggs, *quantiles)  # a row each


def value_ranks(df: DataFrame, value: str, weight: Column | None = None) -> DataFrame:
    """Each distinct value with its count and its average rank over all rows (ties share the mean rank).

    `weight` is the number of rows a row stands for, when `df` is already counted, without null or NaN values. Values are cut into
    buckets of about equal numbers of distinct values, however near they lie to each other.
    """
    rows = df.where(without_nan(df, value).isNotNull()) if weight is None else df
    n = F.sum(weight if weight is not None else F.lit(1)).cast("long")
    counted = rows.groupBy(value).agg(n.alias("n"))
    cut = with_balanced_bucket(counted, value, "__at")
    return running_totals(cut, [], [value], {"upto": "n"}, bucket=F.col("__at")).select(
        value, "n", (F.col("upto") - (F.col("n") - 1) / 2).alias("avg_rank")
    )
