"""Grouped summaries: cross-tabs, pivots, bins, shares, conditional rates, per-column profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from paddock.operators.groups import exact_quantiles, keep_first
from paddock.operators.keys import value_bucket, with_keys_only
from paddock.operators.selection import column_profile


def count_rows(*keys: str):
    """Row count per key combination, null keys left out."""
    return lambda df: with_keys_only(df, list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def grouped(df: DataFrame, keys: list[str], aggs: dict[str, Column]) -> DataFrame:
    """groupBy that leaves out rows with a null key."""
    return with_keys_only(df, keys).groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def rounded(df: DataFrame, columns: Sequence[str], digits: int | None) -> DataFrame:
    """Round the columns; None leaves them as they are."""
    if digits is None:
        return df
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def crosstab(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Row counts of `row` against the listed values of `column`, zero where a pair does not occur."""
    return grouped(df, [row], {f"{column}_{v}": F.count_if(F.col(column) == v) for v in values})


def pivot_mean(df: DataFrame, row: str, column: str, values: Sequence[str], measure: str) -> DataFrame:
    """Mean of the measure for each listed value of `column`, one output column per value."""
    return with_keys_only(df, [row]).groupBy(row).pivot(column, list(values)).agg(F.avg(measure))


def binned_mean(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """Mean of y in equal-width bins of x. The last bin includes its upper edge; empty bins stay, with null."""
    data = with_keys_only(
        df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")), ["x", "y"]
    )
    ends = data.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    low, high = ends.select("lo").scalar(), ends.select("hi").scalar()
    placed = data.withColumn(
        "bin", F.least(F.width_bucket("x", low, high, F.lit(bins)), F.lit(bins)).cast("int")
    )
    found = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean_y"))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    width = (high - low) / bins
    return every.join(found, "bin", "left").select(
        "bin",
        (low + (F.col("bin") - 1) * width).alias("low"),
        (low + F.col("bin") * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
        "mean_y",
    )


def share_of_total(df: DataFrame, outer: list[str], inner: list[str]) -> DataFrame:
    """Count per (outer, inner) and its share of the outer group.

    The window runs over the counted table, one row per combination, not over the data.
    """
    counted = grouped(df, [*outer, *inner], {"n": F.count(F.lit(1))})
    return counted.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(*outer)))


def conditional_rate(df: DataFrame, keys: list[str], hit: Column, base: Column, out: str) -> DataFrame:
    """Percentage of base rows that are also hits; null for a group without base rows."""
    counted = grouped(df, keys, {"hits": F.count_if(hit & base), "base": F.count_if(base)})
    return counted.withColumn(out, F.try_divide(F.col("hits") * 100.0, F.col("base")))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def keep_max(df: DataFrame, keys: list[str], measure: str, ties: list[str]) -> DataFrame:
    """The row with the greatest measure per key, ties by the given columns."""
    return keep_first(df, keys, [F.col(measure).desc(), *[F.col(t).asc() for t in ties]])


def factorize(df: DataFrame, category: str, order: list[str], out: str) -> DataFrame:
    """Integer code of each category, numbered by where it first appears in the given order (a number first).

    The categories are first reduced to one row each; numbering runs over those rows.
    """
    from paddock.operators.ordered import row_numbers

    names = [f"__o{i}" for i in range(len(order))]
    first = with_keys_only(df, [category]).groupBy(category).agg(F.min(F.struct(*order)).alias("__at"))
    flat = first.select(category, *[F.col(f"__at.{o}").alias(n) for o, n in zip(order, names)])
    numbered = row_numbers(flat, [], [*names, category], "__nr", bucket=value_bucket(F.col(names[0])))
    return numbered.select(category, (F.col("__nr") - 1).cast("int").alias(out))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and share of every column, in one pass over the data."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in df.columns]
    )
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("nulls")) for c in df.columns
    ])
    return counts.select("rows", F.inline(pairs)).select(
        "column_name", "rows", "nulls", F.try_divide(F.col("nulls").cast("double"), F.col("rows")).alias("share")
    )


def mean_null_share(df: DataFrame) -> DataFrame:
    """Null percentage averaged over the columns."""
    return null_profile(df).agg((F.avg("share") * 100).alias("null_percent"))


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How many rows repeat an earlier row in the given (or all) columns."""
    counted = df.groupBy(*(columns or df.columns)).agg(F.count(F.lit(1)).alias("__n"))
    return counted.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicates"),
    )


def describe_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum, exact quartiles and maximum of each column, as rows. NaN is no value."""
    found = column_profile(df, list(columns), {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return found.select("column_name", F.col("n").alias("count"), "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct count, commonest value and its frequency of text columns, as rows."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])
    counted = df.select(F.inline(cells)).where("v is not null").groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("v")))  # ties: first in text order
    found = counted.groupBy("column_name").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), best.alias("b"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    zero = F.lit(0).cast("long")
    return names.join(found, "column_name", "left").select(
        "column_name", F.coalesce("count", zero).alias("count"), F.coalesce("unique", zero).alias("unique"),
        F.col("b.v").alias("top"), (-F.col("b.neg")).alias("freq"))


def count_violations(df: DataFrame, probes: dict[str, Column]) -> DataFrame:
    """Rows that break each named rule, in one pass; one output row per rule."""
    counted = df.agg(*[F.count_if(p).alias(n) for n, p in probes.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in probes])
    return counted.select(F.inline(pairs))


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls by the exact column median, read back as a scalar subquery."""
    wanted = {f"__m_{c}": (c, 0.5) for c in columns}
    medians = exact_quantiles(df.select(*columns), [], {}, wanted)
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), medians.select(f"__m_{c}").scalar()) for c in columns
    })


def fill_nulls(df: DataFrame, numbers: Sequence[str] = (), texts: Sequence[str] = ()) -> DataFrame:
    """Sentinels: 0 for numbers, Unknown for texts."""
    out = df.fillna(0, list(numbers)) if numbers else df
    return out.fillna("Unknown", list(texts)) if texts else out


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Row and column count per table."""
    one = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).cast("int").alias("columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, one)


def schema_rows(df_by_name: dict[str, DataFrame]) -> list[tuple[str, str, str]]:
    """(table, column, type) of every column; reads no data."""
    return [(t, f.name, f.dataType.simpleString()) for t, df in df_by_name.items() for f in df.schema.fields]


def drop_ghost_columns(df: DataFrame) -> DataFrame:
    """Drop unnamed header cells (`_c5`, `Unnamed: 5`, blank) whose column holds nothing."""
    unnamed = [c for c in df.columns if not c.strip() or c.startswith(("_c", "Unnamed:"))]
    if not unnamed:
        return df
    filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in unnamed]).first()
    return df.drop(*[c for c in unnamed if filled[c] == 0])


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def rename_known(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename what is there; names not in the table are ignored."""
    return df.withColumnsRenamed(names)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def mostly_null(df: DataFrame, share: float = 0.3) -> DataFrame:
    return null_profile(df).where(F.col("share") > share)

