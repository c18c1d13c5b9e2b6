"""Statistical tests and regressions as aggregates.

Each test returns one row: test, statistic, df, n, effect and `tail`, the kind of p-value it takes.
p-values are added to the few finished rows by `report`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from paddock.functions import tails
from paddock.functions.tails import p_value, rank_sum_upper, student_two_sided
from paddock.operators.groups import value_ranks
from paddock.operators.ordered import running_totals
from paddock.operators.keys import present, with_balanced_bucket, with_keys_only, without_nan

# The tail functions travel with the tasks, so that workers need no copy of this package.
cloudpickle.register_pickle_by_value(tails)


def _row(df: DataFrame, test: str, tail: str | Column, statistic: Column, dof: Column, n: Column, effect: Column) -> DataFrame:
    return df.select(
        F.lit(test).alias("test"), (F.lit(tail) if isinstance(tail, str) else tail).alias("tail"),
        statistic.cast("double").alias("statistic"), dof.cast("double").alias("df"),
        n.cast("long").alias("n"), effect.cast("double").alias("effect"),
    )


def frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each combination of the columns with its number of rows, `weight`.

    Tests on columns of few values can share this one aggregate, by `weight="weight"`: its shuffle is written once and read
    by each.
    """
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("weight"))


def _weight(weight: str | None) -> Column:
    return F.lit(1).cast("long") if weight is None else F.col(weight)


def spearman(df: DataFrame, x: str, y: str, weight: str | None = None) -> DataFrame:
    """Rank correlation with average ranks for ties. Rows with a null or NaN on either side are left out.

    Equal pairs are counted first, so the joins below work on distinct pairs; ranks come from the same
    counted pairs, whose shuffle Spark reuses. The mean rank is (n+1)/2, hence one pass over the pairs gives the correlation.
    `weight` names the number of rows that a row stands for.
    """
    both = df.select(without_nan(df, x).alias("x"), without_nan(df, y).alias("y"), _weight(weight).alias("w"))
    # Incomplete pairs weigh nothing and go after the count, so that a shared table of frequencies stays as it is.
    complete = F.col("x").isNotNull() & F.col("y").isNotNull()
    pairs = both.groupBy("x", "y").agg(F.sum(F.when(complete, F.col("w"))).alias("w")).where("w > 0")
    ranked = pairs
    for side in ("x", "y"):
        ranks = value_ranks(pairs, side, F.col("w"))
        ranks = ranks.select(side, F.col("avg_rank").alias(f"r{side}"))
        ranked = ranked.join(ranks, side, "left")
    sums = ranked.agg(
        F.sum("w").alias("n"),
        *[F.sum(F.col("w") * F.col(a) * F.col(b)).alias(f"s{a}{b}") for a, b in (("rx", "ry"), ("rx", "rx"), ("ry", "ry"))],
    )
    n = F.col("n").cast("double")
    centre = n * ((n + 1) / 2) * ((n + 1) / 2)
    sxy, sxx, syy = (F.col(c) - centre for c in ("srxry", "srxrx", "sryry"))
    spread = (sxx > centre * 1e-12) & (syy > centre * 1e-12)  # a constant column has no correlation
    out = sums.withColumn("rho", F.when(spread, sxy / (F.sqrt(sxx) * F.sqrt(syy))))
    rho = F.col("rho")
    return _row(out, "Spearman", "rho", rho, n - 2, F.col("n"), rho)


def _moments(df: DataFrame, samples: dict[str, Column], weight: str | None) -> DataFrame:
    """m, v and n (mean, sample variance, rows) of each named sample, in one row.

    With `weight`, rows of one value count as many. Variances are merged from those of the values, whose own is nothing:
    squares of the distances from a mean that a first, cheap aggregate finds, so that nothing cancels out.
    """
    if weight is None:
        return df.agg(*[c for name, v in samples.items() for c in (
            F.avg(v).alias(f"m{name}"), F.var_samp(v).alias(f"v{name}"), F.count(v).alias(f"n{name}"))])
    w = F.col(weight)
    first = df.agg(F.struct(*[F.try_divide(F.sum(v * w), F.sum(F.when(v.isNotNull(), w))).alias(f"m{name}") for name, v in samples.items()]).alias("m"))
    means = F.col("__m")
    # Joined, not a subquery: a subquery would count the shared table again. The row of means comes once for all rows.
    rows = df.crossJoin(F.broadcast(first.withColumnRenamed("m", "__m")))
    sums = rows.agg(F.first("__m").alias("__m"), *[c for name, v in samples.items() for c in (
        F.coalesce(F.sum(F.when(v.isNotNull(), w)), F.lit(0)).alias(f"n{name}"),
        F.sum((v - means[f"m{name}"]) * (v - means[f"m{name}"]) * w).alias(f"s{name}"))])
    return sums.select(*[c for name in samples for c in (
        means[f"m{name}"].alias(f"m{name}"), F.col(f"n{name}"),
        F.when(F.col(f"n{name}") > 1, F.col(f"s{name}") / (F.col(f"n{name}") - 1)).alias(f"v{name}"))])


def welch(df: DataFrame, value: str, first: Column, second: Column, weight: str | None = None) -> DataFrame:
    """Two-sample t with unequal variances; effect is Cohen's d. Both samples in one pass. NaN is no value."""
    v = present(F.col(value))
    s = _moments(df, {"1": F.when(first, v), "2": F.when(second, v)}, weight)
    m1, v1, n1, m2, v2, n2 = (F.col(c) for c in ("m1", "v1", "n1", "m2", "v2", "n2"))
    e1, e2 = F.try_divide(v1, n1), F.try_divide(v2, n2)
    dof = F.try_divide((e1 + e2) * (e1 + e2), F.try_divide(e1 * e1, n1 - 1) + F.try_divide(e2 * e2, n2 - 1))
    return _row(
        s, "Welch t", "t", F.try_divide(m1 - m2, F.sqrt(e1 + e2)), dof, n1 + n2,
        F.try_divide(m1 - m2, F.sqrt((v1 + v2) / 2)),
    )


def one_sample_t(df: DataFrame, value: Column | str, mean: float = 0.0, weight: str | None = None) -> DataFrame:
    s = _moments(df, {"": present(F.col(value) if isinstance(value, str) else value)}, weight)
    n, diff = F.col("n"), F.col("m") - mean
    return _row(s, "one-sample t", "t", F.try_divide(diff, F.sqrt("v") / F.sqrt("n")), n - 1, n, diff)


def chi_squared(df: DataFrame, row: str, column: str, values: Sequence, yates: bool = True, weight: str | None = None) -> DataFrame:
    """Independence of `row` and `column`, the latter limited to the listed values.

    Two aggregates and no join: the first gives the table, the second reduces it. With observed count O,
    row total R, column total C: chi2 = n * (sum(O^2 / (R*C)) - 1). A 2x2 table gets Yates' correction,
    where all four cells deviate equally from expectation.
    """
    cells = [f"o{i}" for i in range(len(values))]
    counted = F.col(row).isNotNull()
    table = (
        df.groupBy(row)
        .agg(*[F.coalesce(F.sum(F.when(counted & (F.col(column) == v), _weight(weight))), F.lit(0)).cast("double").alias(c)
               for v, c in zip(values, cells)])
        .withColumn("r", reduce(lambda a, b: a + b, [F.col(c) for c in cells]))
        .where("r > 0")
    )
    s = table.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("r").alias("n"), F.sum(1 / F.col("r")).alias("inv_r"),
        F.min_by("r", row).alias("r"), *[F.min_by(c, row).alias(c) for c in cells],
        *[F.sum(c).alias(f"c_{c}") for c in cells],
        *[F.sum(F.col(c) * F.col(c) / F.col("r")).alias(f"q_{c}") for c in cells],
    )
    n = F.col("n")
    used = reduce(lambda a, b: a + b, [F.when(F.col(f"c_{c}") > 0, 1).otherwise(0) for c in cells])
    terms = [F.coalesce(F.try_divide(F.col(f"q_{c}"), F.col(f"c_{c}")), F.lit(0.0)) for c in cells]
    plain = n * (reduce(lambda a, b: a + b, terms) - 1)
    dof = (F.col("rows") - 1) * (used - 1)
    statistic = plain
    if yates:  # two rows, and two columns that occur
        occurs = [F.col(f"c_{c}") > 0 for c in cells]
        deviation = F.coalesce(*[
            F.when(o, F.abs(F.col(c) - F.try_divide(F.col("r") * F.col(f"c_{c}"), n))) for o, c in zip(occurs, cells)])
        less = deviation - F.least(F.lit(0.5), deviation)
        inv_c = reduce(lambda a, b: a + b, [F.when(o, 1 / F.col(f"c_{c}")).otherwise(0.0) for o, c in zip(occurs, cells)])
        statistic = F.when((dof == 1) & (F.col("rows") == 2), less * less * n * F.col("inv_r") * inv_c).otherwise(plain)
    return _row(s, "chi-squared", "chi2", F.when(dof > 0, statistic), dof, n, F.lit(None))


def mann_whitney(
    df: DataFrame, value: str, first: Column, second: Column, alternative: str, weight: str | None = None
) -> DataFrame:
    """U of the first sample; `effect` is the normal score with tie and continuity correction.

    Values are counted per sample, then one running total says how many of the second sample lie below.
    Values may lie as near to each other as they like: the running total goes over buckets of about equal numbers of
    distinct values. An empty sample gives null statistics.
    """
    v, w = present(F.col(value)), _weight(weight)
    counted = df.where(v.isNotNull() & (first | second)).groupBy(v.alias("v")).agg(*[
        F.coalesce(F.sum(F.when(side, w)), F.lit(0)).alias(n) for n, side in (("a", first), ("b", second))])
    placed = running_totals(with_balanced_bucket(counted, "v", "at"), [], ["v"], {"upto": "b"}, bucket=F.col("at"))
    t = (F.col("a") + F.col("b")).cast("double")
    s = placed.agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("n1"), F.coalesce(F.sum("b"), F.lit(0)).alias("n2"),
        F.sum(F.col("a") * (F.col("upto") - F.col("b") / 2.0)).alias("u1"),
        F.sum(t * t * t - t).alias("ties"),
    )
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n, both = n1 + n2, (F.col("n1") > 0) & (F.col("n2") > 0)
    larger = F.col("u1") if alternative == "greater" else n1 * n2 - F.col("u1")
    sigma = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1))))
    z = F.try_divide(larger - n1 * n2 / 2 - 0.5, sigma)
    # As is usual, small samples without ties take the exact distribution of U.
    exact = both & (F.col("ties") == 0) & (F.least(n1, n2) <= 8)
    tail = F.when(exact, F.concat_ws(":", F.lit("u"), F.lit(alternative), F.col("n1"), F.col("n2"))).otherwise("z_upper")
    return _row(s, "Mann-Whitney U", tail, F.when(both, F.col("u1")), F.lit(None), n, F.when(both, z))


def least_squares(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """Ordinary least squares with intercept: one row per term with coefficient, error, t, p, and R2.

    One aggregate yields count, means and covariances; the small linear system is solved on that one row.
    """
    names = [y, *xs]
    data = with_keys_only(df.select(*[F.col(c).cast("double").alias(c) for c in names]), names)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    moments = data.agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(c) for c in names]).alias("means"),
        F.array(*[F.covar_pop(a, b) for a, b in pairs]).alias("covs"),
    )
    terms = list(xs)
    schema = "term string, coef double, std_err double, t double, p_value double, r_squared double, n long"

    def solve(batches):
        import numpy as np

        for batch in batches:
            for n, means, covs in zip(batch["n"], batch["means"], batch["covs"]):
                k = len(terms)
                if n <= k + 1:
                    continue
                cov = np.zeros((k + 1, k + 1))
                cov[np.triu_indices(k + 1)] = covs
                cov = cov + np.triu(cov, 1).T
                sxx, sxy, syy = cov[1:, 1:] * n, cov[1:, 0] * n, cov[0, 0] * n
                inverse = np.linalg.pinv(sxx, hermitian=True)
                dof = n - np.linalg.matrix_rank(sxx, hermitian=True) - 1
                slope = inverse @ sxy
                mean_x = np.asarray(means[1:])
                residual = syy - slope @ sxy
                variance = residual / dof
                coef = np.concatenate([[means[0] - slope @ mean_x], slope])
                spread = np.concatenate([[1 / n + mean_x @ inverse @ mean_x], np.diag(inverse)])
                error = np.sqrt(variance * spread)
                with np.errstate(divide="ignore", invalid="ignore"):
                    t = coef / error
                yield pd.DataFrame({
                    "term": ["const", *terms], "coef": coef, "std_err": error, "t": t,
                    "p_value": [student_two_sided(v, dof) if np.isfinite(v) else None for v in t],
                    "r_squared": 1 - residual / syy if syy else None, "n": n,
                })

    return moments.mapInPandas(solve, schema)


def _add_p_values(log: DataFrame) -> DataFrame:
    """p of finished test rows: a handful of numbers."""
    def p_of(kind, stat, score, dof):
        if pd.isna(stat):
            return None
        if kind == "rho":
            if abs(stat) >= 1:
                return 0.0
            return p_value("t", stat * (dof / ((1 - stat) * (1 + stat))) ** 0.5, dof)
        if kind.startswith("u:"):
            _, alternative, n1, n2 = kind.split(":")
            u = stat if alternative == "greater" else int(n1) * int(n2) - stat
            return rank_sum_upper(int(u), int(n1), int(n2))
        if kind.startswith("z"):
            return p_value(kind, score, None)
        return p_value(kind, stat, dof)

    @F.pandas_udf("double")
    def p_values(tail: pd.Series, statistic: pd.Series, effect: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series([p_of(*r) for r in zip(tail, statistic, effect, df)], dtype="float64")

    column = p_values("tail", "statistic", "effect", "df")
    return log.withColumn("p_value", F.when(~F.isnan(column), column))


def report(tests: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """Result log: one row per hypothesis with p, stars and verdict. Maps id to (text, test row)."""
    rows = [
        t.select(F.lit(h).alias("hypothesis_id"), F.lit(text).alias("hypothesis_text"), *t.columns)
        for h, (text, t) in tests.items()
    ]
    log = reduce(DataFrame.unionByName, rows)
    p = F.col("p_value")
    return (
        _add_p_values(log)
        .withColumn("significant", F.coalesce(p < 0.05, F.lit(False)))
        .withColumn("stars", F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").when(p.isNotNull(), "ns"))
        .withColumn(
            "verdict",
            F.when(p.isNull(), "insufficient data").when(p < 0.05, "REJECT H0").otherwise("FAIL TO REJECT H0"),
        )
        .drop("tail")
    )


def log_summary(log: DataFrame) -> DataFrame:
    """How many tests, how many significant, and the rate in percent. Untestable rows are not counted."""
    return log.where("p_value is not null").agg(
        F.count(F.lit(1)).alias("tests"),
        F.count_if("significant").alias("significant"),
        F.count_if(~F.col("significant")).alias("not_significant"),
        F.try_divide(F.count_if("significant") * 100.0, F.count(F.lit(1))).alias("rate_percent"),
    )
