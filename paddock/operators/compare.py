"""Typed comparison of two tables by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from paddock.operators.joins import require_unique

MISSING, ADDED, CHANGED = "missing", "added", "changed"


def _differs(left: Column, right: Column, kind: T.DataType, tolerance: float) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        a, b = left.cast("double"), right.cast("double")
        near = a.eqNullSafe(b) | (F.abs(a - b) <= tolerance * F.greatest(F.lit(1.0), F.abs(a), F.abs(b)))
        return ~F.coalesce(near, F.lit(False))
    return ~left.eqNullSafe(right)


def table_diff(
    expected: DataFrame, found: DataFrame, keys: Sequence[str], *, columns: Sequence[str] | None = None, tolerance: float = 1e-9
) -> DataFrame:
    """One row per difference: the keys, `kind` (missing, added, changed), `column`, and both values as text.

    Rows are matched by their keys, null matching null; a key must not repeat on either side. Whole numbers, texts, dates
    and flags are compared as they are, with the left side's type, numbers with a fraction by a relative tolerance. `columns`
    are the ones to compare, by default all that both sides have; a column of one side only is a difference in every row if it is
    listed. Equal tables give no row.
    """
    keys = list(keys)
    both = [c for c in expected.columns if c in found.columns and c not in keys]
    wanted = list(columns) if columns is not None else both
    types = {f.name: f.dataType for f in [*found.schema.fields, *expected.schema.fields]}
    sides = []
    for name, df in (("expected", expected), ("found", found)):
        require_unique(df, keys, name)
        cells = [(F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(types[c]).alias(c) for c in wanted]
        sides.append(df.select(*[F.col(f"`{k}`").cast(types[k]).alias(f"__{name}_{k}") for k in keys],
                               F.struct(F.lit(True).alias("__there"), *cells).alias(f"__{name}")))
    left, right = sides
    same = [F.col(f"__expected_{k}").eqNullSafe(F.col(f"__found_{k}")) for k in keys]
    old, new = F.col("__expected"), F.col("__found")
    row = F.when(new.isNull(), F.lit(MISSING)).when(old.isNull(), F.lit(ADDED))
    entry = lambda kind, column, a, b: F.struct(kind.alias("kind"), column.alias("column"), a.alias("expected"), b.alias("found"))
    nothing = F.lit(None).cast("string")
    changed = [
        F.when(_differs(old[c], new[c], types[c], tolerance),
               entry(F.lit(CHANGED), F.lit(c), old[c].cast("string"), new[c].cast("string"))) for c in wanted]
    cells = F.array_compact(F.array(*changed)) if changed else F.array().cast(
        "array<struct<kind:string,column:string,expected:string,found:string>>")
    found_rows = F.when(row.isNotNull(), F.array(entry(row, nothing, nothing, nothing))).otherwise(cells)
    out = left.join(right, same, "full").select(
        *[F.coalesce(f"__expected_{k}", f"__found_{k}").alias(k) for k in keys], F.explode(found_rows).alias("__d"))
    return out.select(*keys, "__d.*")
