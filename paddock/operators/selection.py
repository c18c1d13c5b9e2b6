"""Exact quantiles of groups of any size by counting passes that narrow to the wanted values.

Every pass counts rows by cell of the number line, with the least and greatest value of each cell, and finds the cells
that hold the wanted positions. The first pass has 2^12 cells for each doubling, the second cuts the cells that were found
into 2^20 each, and what is left in one of those are about 2^20 distinct doubles at most, which the third pass counts. So what is shuffled and what meets in one place is bounded by the number type, not by the rows or
the number of distinct values, and nothing is sorted. A cell whose least and greatest value agree is finished; if all are,
the later passes have nothing to look for and adaptive execution drops them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from paddock.operators.keys import coarse_cell, fine_cell, present

COLUMN, VALUE = "__column", "__value"
FIND = """aggregate(__cells, named_struct('at', __want.at, 'lo', cast(null AS double), 'hi', cast(null AS double)),
    (s, c) -> CASE WHEN s.lo IS NOT NULL THEN s WHEN s.at < c.n THEN named_struct('at', s.at, 'lo', c.lo, 'hi', c.hi)
    ELSE named_struct('at', s.at - c.n, 'lo', s.lo, 'hi', s.hi) END)"""
PARTS = ("n", "mean", "std", "min", "max")


def long_values(df: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """(group, column number, value) rows; null and NaN are no values."""
    cells = F.array(*[F.struct(F.lit(i).alias(COLUMN), present(F.col(c)).alias(VALUE)) for i, c in enumerate(values)])
    return df.select(*by, F.inline(cells)).where(f"{VALUE} IS NOT NULL")


def _counted(rows: DataFrame, keys: list[str], cell: Column, *more: Column) -> DataFrame:
    v = F.col(VALUE)
    return rows.groupBy(*keys, cell.alias("__part")).agg(
        F.count(F.lit(1)).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"), *more).drop("__part")


def _sorted_cells(counted: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group with its cells in order; cells do not overlap, so their least values order them."""
    fields = [c for c in ("lo", "hi", "n", "mean", "var") if c in counted.columns]
    return counted.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("__cells"))


def _found(wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The cell of each wanted position: `at` within the cell, `lo` and `hi` of the cell."""
    found = wanted.withColumn("__found", F.expr(FIND))
    return found.select(*keys, F.struct("__want.q", "__want.side", F.col("__found.at").alias("at")).alias("__want"),
                        "__found.lo", "__found.hi")


def _next_pass(
    found: DataFrame, rows: DataFrame, keys: list[str], cells: list[Callable[[Column], Column]], finer: Callable[[Column], Column],
    small: bool,
) -> DataFrame:
    """Count the rows in the cells that are not finished by a finer cell, and find the positions there."""
    names = [f"__cell{i}" for i in range(len(cells))]
    open_ = found.where("lo < hi").select("*", *[c(F.col("lo")).alias(n) for c, n in zip(cells, names)])
    by = [*keys, *names]
    targets = open_.select(*by).distinct()
    here = rows.select("*", *[c(F.col(VALUE)).alias(n) for c, n in zip(cells, names)])
    inside = here.join(F.broadcast(targets) if small else targets, by, "left_semi")
    folded = _sorted_cells(_counted(inside, by, finer(F.col(VALUE))), by)
    return _found(open_.select(*by, "__want").join(F.broadcast(folded) if small else folded, by), keys)


def _folded(rows: DataFrame, keys: list[str], moments: bool) -> DataFrame:
    more = [F.avg(VALUE).alias("mean"), F.var_pop(VALUE).alias("var")] if moments else []
    return _sorted_cells(_counted(rows, keys, coarse_cell(F.col(VALUE)), *more), keys)


def _picked(folded: DataFrame, rows: DataFrame, by: list[str], values: list[str], quantiles: dict[str, tuple[str, float]]) -> DataFrame:
    """One row per group with the two values round each wanted position, interpolated."""
    keys, names = [*by, COLUMN], list(quantiles)
    total = F.expr("aggregate(__cells, 0L, (s, c) -> s + c.n)")
    wants, fractions = [], []
    for q, (column, p) in enumerate(quantiles.values()):
        at = (total - 1).cast("double") * p
        for side, k in enumerate((F.floor(at), F.ceil(at))):
            wants.append(F.struct(F.lit(q).alias("q"), F.lit(side).alias("side"), k.alias("at"), F.lit(values.index(column)).alias("column")))
        fractions.append(at - F.floor(at))
    mine = F.filter(F.array(*wants), lambda w: w["column"] == F.col(COLUMN))
    small = not by  # one row per column; groups can be many
    first = _found(folded.select(*keys, "__cells", F.explode(mine).alias("__want")), keys)
    second = _next_pass(first, rows, keys, [coarse_cell], fine_cell, small)
    third = _next_pass(second, rows, keys, [coarse_cell, fine_cell], lambda v: v, small)
    done = first.where("lo = hi").unionAll(second.where("lo = hi")).unionAll(third)
    share = folded.select(*keys, F.array(*fractions).alias("__fractions"))
    v, q, side = F.col("lo") + F.lit(0.0), F.col("__want.q"), F.col("__want.side")  # -0.0 becomes 0.0
    sides = done.groupBy(*by).agg(*[
        F.max(F.when((q == i) & (side == s), v)).alias(f"__{s}_{n}") for i, n in enumerate(names) for s in (0, 1)])
    parts = share.groupBy(*by).agg(*[
        F.max(F.when(F.col(COLUMN) == values.index(quantiles[n][0]), F.col("__fractions")[i])).alias(f"__f_{n}") for i, n in enumerate(names)])
    both = sides.join(parts, by) if by else sides.crossJoin(parts)  # without groups each side is one row
    low, high, part = ([F.col(f"__{x}_{n}") for n in names] for x in (0, 1, "f"))
    return both.select(*by, *[(a + (b - a) * f).alias(n) for a, b, f, n in zip(low, high, part, names)])


def refined_quantiles(df: DataFrame, by: list[str], quantiles: dict[str, tuple[str, float]]) -> DataFrame:
    """Interpolated quantiles, one row per group that has values; maps output name to (column, share)."""
    values = list(dict.fromkeys(c for c, _ in quantiles.values()))
    rows = long_values(df, by, values)
    return _picked(_folded(rows, [*by, COLUMN], False), rows, by, values, quantiles)


def column_profile(df: DataFrame, columns: list[str], quantiles: dict[str, float]) -> DataFrame:
    """One row per column: column_name, n, mean, std, min, max and the quantiles, from the same counted cells.

    Cells carry their count, mean and variance, which merge without loss, so the data are read once for all figures but
    those quantiles whose cells the first pass does not finish. A column without values has n 0 and nulls.
    """
    rows = long_values(df, [], columns)
    folded = _folded(rows, [COLUMN], True)
    n = "aggregate(__cells, 0L, (s, c) -> s + c.n)"
    mean = f"aggregate(__cells, 0D, (s, c) -> s + c.n * c.mean) / {n}"
    figures = folded.select(COLUMN, "__cells", F.expr(n).alias("n"), F.expr(mean).alias("mean"))
    squares = F.expr("aggregate(__cells, 0D, (s, c) -> s + c.n * (c.var + (c.mean - mean) * (c.mean - mean)))")
    figures = figures.select(
        COLUMN, "n", "mean", F.when(F.col("n") > 1, F.sqrt(squares / (F.col("n") - 1))).alias("std"),
        F.col("__cells")[0]["lo"].alias("min"), F.array_max(F.transform("__cells", lambda c: c["hi"])).alias("max"))
    wide = _picked(folded, rows, [], columns, {f"{c}\n{q}": (c, p) for c in columns for q, p in quantiles.items()})
    each = F.array(*[
        F.struct(F.lit(i).alias(COLUMN), F.lit(c).alias("column_name"), *[F.col(f"`{c}\n{q}`").alias(q) for q in quantiles])
        for i, c in enumerate(columns)])
    found = wide.select(F.inline(each)).join(F.broadcast(figures), COLUMN, "left")  # a row per column
    return found.select("column_name", F.coalesce("n", F.lit(0)).cast("long").alias("n"), *PARTS[1:], *quantiles)
