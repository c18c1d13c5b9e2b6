"""Queries that run the statistical tests and regressions on race entries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from paddock.operators import hypotheses as H, summaries as S
from paddock.plans import hypotheses, metrics
from paddock.plans.catalog import E, GAPS, PITS, TABLE, query
from paddock.plans.catalog_events import pits
from paddock.plans.catalog_results import gaps, standings
from paddock.plans.views import Tables, entries

CORE = ("test", "statistic", "df", "n", "effect")


def _core(row: DataFrame) -> DataFrame:
    return row.select(*CORE)


FACTORS = ("grid", "positionOrder", "points", "era", "is_win", "is_dnf")  # columns of few values


def frequencies(t: Tables) -> DataFrame:
    """How many entries have each combination of the tested columns; several tests share this one table."""
    return H.frequencies(entries(t, *FACTORS), FACTORS)


def spearman(t: Tables, counted: DataFrame | None = None) -> DataFrame:
    if counted is not None:
        return H.spearman(counted, "grid", "positionOrder", "weight")
    return H.spearman(entries(t, "grid", "positionOrder"), "grid", "positionOrder")


def welch(t: Tables, counted: DataFrame | None = None) -> DataFrame:
    sides = F.col("grid") <= 5, F.col("grid") > 5
    if counted is not None:
        return H.welch(counted, "points", *sides, "weight")
    return H.welch(entries(t, "points", "grid"), "points", *sides)


def one_sample(t: Tables, counted: DataFrame | None = None) -> DataFrame:
    if counted is not None:
        return H.one_sample_t(counted, F.col("points") - 25, weight="weight")
    return H.one_sample_t(entries(t, "points"), F.col("points") - 25)


def chi2_rxc(t: Tables, counted: DataFrame | None = None) -> DataFrame:
    if counted is not None:
        return H.chi_squared(counted, "era", "is_win", [0, 1], weight="weight")
    return H.chi_squared(entries(t, "era", "is_win"), "era", "is_win", [0, 1])


def chi2_2x2(t: Tables, counted: DataFrame | None = None) -> DataFrame:
    e = entries(t, "era", "is_dnf") if counted is None else counted
    two = e.withColumn("era", F.when(F.col("era").isin("V10", "Hybrid"), F.col("era")))  # a null era is not counted
    return H.chi_squared(two, "era", "is_dnf", [0, 1], weight=None if counted is None else "weight")


def mann_whitney(t: Tables, counted: DataFrame | None = None) -> DataFrame:
    """On standings, which no table of entries has."""
    return H.mann_whitney(
        standings(t, wins=False), "points", F.col("championship_pos") <= 5, F.col("championship_pos") > 5, "greater",
    )


SPEARMAN = f"""WITH {E}, r AS (SELECT
  rank() OVER (ORDER BY grid) + (count(*) OVER (PARTITION BY grid) - 1) / 2 AS rx,
  rank() OVER (ORDER BY "positionOrder") + (count(*) OVER (PARTITION BY "positionOrder") - 1) / 2 AS ry FROM e)
SELECT 'Spearman' AS test, corr(rx, ry) AS statistic, count(*) - 2.0::DOUBLE AS df, count(*) AS n,
  corr(rx, ry) AS effect FROM r"""
WELCH = f"""WITH {E}, m AS (SELECT avg(points) FILTER (WHERE grid <= 5) AS m1, avg(points) FILTER (WHERE grid > 5) AS m2,
  var_samp(points) FILTER (WHERE grid <= 5) AS v1, var_samp(points) FILTER (WHERE grid > 5) AS v2,
  count(*) FILTER (WHERE grid <= 5) AS n1, count(*) FILTER (WHERE grid > 5) AS n2 FROM e)
SELECT 'Welch t' AS test, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS statistic,
  pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS df, n1 + n2 AS n,
  (m1 - m2) / sqrt((v1 + v2) / 2) AS effect FROM m"""
ONE_SAMPLE = f"""WITH {E}
SELECT 'one-sample t' AS test, (avg(points) - 25) / (stddev_samp(points) / sqrt(count(*))) AS statistic,
  count(*) - 1.0::DOUBLE AS df, count(*) AS n, avg(points) - 25 AS effect FROM e"""
CHI2_RXC = f"""WITH {E}, o AS (SELECT era, is_win, count(*) AS o FROM e GROUP BY ALL), x AS (
  SELECT o, sum(o) OVER (PARTITION BY era) * sum(o) OVER (PARTITION BY is_win) / sum(o) OVER () AS x FROM o)
SELECT 'chi-squared' AS test, sum(pow(o - x, 2) / x) AS statistic,
  (SELECT (count(DISTINCT era) - 1) * (count(DISTINCT is_win) - 1) FROM o)::DOUBLE AS df, CAST(sum(o) AS BIGINT) AS n,
  NULL::DOUBLE AS effect FROM x"""
CHI2_2X2 = f"""WITH {E}, o AS (
  SELECT era, is_dnf, count(*) AS o FROM e WHERE era IN ('V10', 'Hybrid') GROUP BY ALL), x AS (
  SELECT o, sum(o) OVER (PARTITION BY era) * sum(o) OVER (PARTITION BY is_dnf) / sum(o) OVER () AS x FROM o)
SELECT 'chi-squared' AS test, sum(pow(abs(o - x) - least(0.5, abs(o - x)), 2) / x) AS statistic, 1.0::DOUBLE AS df,
  CAST(sum(o) AS BIGINT) AS n, NULL::DOUBLE AS effect FROM x"""
MANN_WHITNEY = f"""WITH {TABLE}, r AS (
  SELECT championship_pos <= 5 AS a, points,
    rank() OVER (ORDER BY points) + (count(*) OVER (PARTITION BY points) - 1) / 2 AS r FROM standing), u AS (
  SELECT sum(r) FILTER (WHERE a) - count(*) FILTER (WHERE a) * (count(*) FILTER (WHERE a) + 1) / 2 AS u,
    (count(*) FILTER (WHERE a))::DOUBLE AS n1, (count(*) FILTER (WHERE NOT a))::DOUBLE AS n2 FROM r), ties AS (
  SELECT sum(c * c * c - c) AS t FROM (SELECT count(*)::DOUBLE AS c FROM r GROUP BY points))
SELECT 'Mann-Whitney U' AS test, u AS statistic, NULL::DOUBLE AS df, CAST(n1 + n2 AS BIGINT) AS n,
  (u - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - t / ((n1 + n2) * (n1 + n2 - 1)))) AS effect
FROM u, ties"""

TESTS = {
    "spearman": (spearman, SPEARMAN), "welch_t": (welch, WELCH), "one_sample_t": (one_sample, ONE_SAMPLE),
    "chi2_rxc": (chi2_rxc, CHI2_RXC), "chi2_2x2": (chi2_2x2, CHI2_2X2), "mann_whitney": (mann_whitney, MANN_WHITNEY),
}
for _name, (_build, _sql) in TESTS.items():
    query(_name, _sql, "statistic df effect")(lambda t, build=_build: _core(build(t)))


@query("chi2_poles", CHI2_RXC.replace("FROM e GROUP BY ALL", "FROM e WHERE grid = 1 GROUP BY ALL"), "statistic df effect")
def _chi2_poles(t: Tables) -> DataFrame:
    """Pole to win by era, on pole sitters only."""
    poles = entries(t, "era", "is_win", "grid").where("grid = 1")
    return _core(H.chi_squared(poles, "era", "is_win", [0, 1]))


@query("chi2_teams", CHI2_2X2.replace("era, is_dnf", "grp, is_dnf").replace("PARTITION BY era", "PARTITION BY grp").replace(
    "FROM e WHERE era IN ('V10', 'Hybrid')",
    "FROM (SELECT CAST(\"constructorId\" < 7 AS INT) AS grp, is_dnf FROM e)"), "statistic df effect")
def _chi2_teams(t: Tables) -> DataFrame:
    """Retirements of a listed set of teams against the others."""
    e = entries(t, "constructorId", "is_dnf")
    e = e.withColumn("listed", F.col("constructorId").isin(list(range(7))).cast("int"))
    return _core(H.chi_squared(e, "listed", "is_dnf", [0, 1]))


@query("spearman_pits", f"""WITH {PITS}, r AS (SELECT
  rank() OVER (ORDER BY total_pit_sec) + (count(*) OVER (PARTITION BY total_pit_sec) - 1) / 2 AS rx,
  rank() OVER (ORDER BY first_pit_lap) + (count(*) OVER (PARTITION BY first_pit_lap) - 1) / 2 AS ry FROM pits)
SELECT 'Spearman' AS test, corr(rx, ry) AS statistic, count(*) - 2.0::DOUBLE AS df, count(*) AS n,
  corr(rx, ry) AS effect FROM r""", "statistic df effect")
def _spearman_pits(t: Tables) -> DataFrame:
    return _core(H.spearman(pits(t), "total_pit_sec", "first_pit_lap"))


@query("welch_gap", f"""WITH {GAPS}, g AS (
  SELECT "driverId", median(q1_vs_team_avg_ms) AS gap, avg(points) AS ppr FROM gaps GROUP BY ALL), s AS (
  SELECT ppr, gap < (SELECT median(gap) FROM g) AS below FROM g), m AS (
  SELECT avg(ppr) FILTER (WHERE below) AS m1, avg(ppr) FILTER (WHERE NOT below) AS m2,
    var_samp(ppr) FILTER (WHERE below) AS v1, var_samp(ppr) FILTER (WHERE NOT below) AS v2,
    count(*) FILTER (WHERE below) AS n1, count(*) FILTER (WHERE NOT below) AS n2 FROM s)
SELECT 'Welch t' AS test, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS statistic,
  pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS df, n1 + n2 AS n,
  (m1 - m2) / sqrt((v1 + v2) / 2) AS effect FROM m""", "statistic df effect")
def _welch_gap(t: Tables) -> DataFrame:
    """Points per race of drivers with a below-median gap to their team, against the rest."""
    drivers = metrics.gap_and_points(gaps(t), entries(t, "driverId", "points"))
    return _core(H.welch(drivers, "ppr", F.col("below_median"), ~F.col("below_median")))


# 5, 1 and 0.1 percent critical values of |z| two-sided, z one-sided, chi2 with 3 and with 1 df.
CRITICAL = {
    "two": (1.959963985, 2.575829304, 3.290526731), "one": (1.644853627, 2.326347874, 3.090232306),
    "chi3": (7.814727903, 11.34486673, 16.2662362), "chi1": (3.841458821, 6.634896601, 10.82756617),
}
# What each test compares with which critical value. The t tests have far too many degrees of freedom to differ from z.
SCORES = {
    "spearman": ("abs(statistic) * sqrt(df / (1 - statistic * statistic))", "two"),
    "welch_t": ("abs(statistic)", "two"), "one_sample_t": ("abs(statistic)", "two"),
    "chi2_rxc": ("statistic", "chi3"), "chi2_2x2": ("statistic", "chi1"), "mann_whitney": ("effect", "one"),
}


def _log_sql() -> str:
    parts = []
    for name, (score, kind) in SCORES.items():
        c5, c1, c01 = CRITICAL[kind]
        parts.append(
            f"SELECT '{name}' AS hypothesis_id, test, statistic, n, CASE WHEN {score} > {c01} THEN '***' "
            f"WHEN {score} > {c1} THEN '**' WHEN {score} > {c5} THEN '*' ELSE 'ns' END AS stars, "
            f"CASE WHEN {score} > {c5} THEN 'REJECT H0' ELSE 'FAIL TO REJECT H0' END AS verdict FROM ({TESTS[name][1]})"
        )
    return " UNION ALL ".join(parts)


def log(t: Tables) -> DataFrame:
    counted = frequencies(t)
    return H.report({name: (name, build(t, counted)) for name, (build, _) in TESTS.items()})


@query("hypothesis_log", _log_sql(), "statistic")
def _hypothesis_log(t: Tables) -> DataFrame:
    return log(t).select("hypothesis_id", "test", "statistic", "n", "stars", "verdict")


@query("hypothesis_summary", f"""SELECT count(*) AS tests, count(*) FILTER (WHERE stars <> 'ns') AS significant,
  count(*) FILTER (WHERE stars = 'ns') AS not_significant, count(*) FILTER (WHERE stars <> 'ns') * 100.0 / count(*)
  AS rate_percent FROM ({_log_sql()})""", "rate_percent")
def _hypothesis_summary(t: Tables) -> DataFrame:
    return H.log_summary(log(t))


@query("ols_simple", f"""WITH {E}, m AS (
  SELECT regr_slope(points, grid) AS b, regr_intercept(points, grid) AS a, regr_r2(points, grid) AS r2,
    regr_sxx(points, grid) AS sxx, regr_syy(points, grid) AS syy, avg(grid) AS mx, count(*) AS n FROM e), s AS (
  SELECT *, (syy - b * b * sxx) / (n - 2) AS v FROM m), rows AS (
  SELECT 'const' AS term, a AS coef, sqrt(v * (1 / n + mx * mx / sxx)) AS std_err, r2, n FROM s UNION ALL
  SELECT 'grid', b, sqrt(v / sxx), r2, n FROM s)
SELECT term, coef, std_err, coef / std_err AS t, r2 AS r_squared, n FROM rows""", "coef std_err t r_squared")
def _ols_simple(t: Tables) -> DataFrame:
    return H.least_squares(entries(t, "points", "grid"), "points", ["grid"]).drop("p_value")


def _ols2_sql(ctes: str, y: str, x: str, z: str, source: str, names: tuple[str, str]) -> str:
    return f"""WITH {ctes}, d AS (SELECT {y} AS y, {x} AS x, {z} AS z FROM {source}), m AS (
  SELECT count(*) AS n, avg(x) AS mx, avg(z) AS mz, avg(y) AS my, var_pop(x) * count(*) AS xx, var_pop(z) * count(*) AS zz,
    covar_pop(x, z) * count(*) AS xz, covar_pop(x, y) * count(*) AS xy, covar_pop(z, y) * count(*) AS zy,
    var_pop(y) * count(*) AS yy FROM d), b AS (
  SELECT *, xx * zz - xz * xz AS det, (zz * xy - xz * zy) / (xx * zz - xz * xz) AS bx,
    (xx * zy - xz * xy) / (xx * zz - xz * xz) AS bz FROM m), s AS (
  SELECT *, (yy - bx * xy - bz * zy) / (n - 3) AS v, 1 - (yy - bx * xy - bz * zy) / yy AS r2 FROM b), rows AS (
  SELECT 'const' AS term, my - bx * mx - bz * mz AS coef,
    sqrt(v * (1 / n + (mx * mx * zz - 2 * mx * mz * xz + mz * mz * xx) / det)) AS std_err, r2, n FROM s UNION ALL
  SELECT '{names[0]}', bx, sqrt(v * zz / det), r2, n FROM s UNION ALL
  SELECT '{names[1]}', bz, sqrt(v * xx / det), r2, n FROM s)
SELECT term, coef, std_err, coef / std_err AS t, r2 AS r_squared, n FROM rows"""


ERA_CODES = E + """, codes AS (
  SELECT era, row_number() OVER (ORDER BY min("raceId"), era) - 1 AS code FROM e GROUP BY era)"""


@query("ols_multi", _ols2_sql(ERA_CODES, "points", "grid", "code", "e JOIN codes USING (era)", ("grid", "era_code")),
       "coef std_err t r_squared")
def _ols_multi(t: Tables) -> DataFrame:
    e = entries(t, "points", "grid", "era", "raceId")
    codes = S.factorize(e, "era", ["raceId"], "era_code")
    coded = e.select("points", "grid", "era").join(codes, "era", "left")
    return H.least_squares(coded, "points", ["grid", "era_code"]).drop("p_value")


@query("ols_pit", _ols2_sql(PITS, "total_pit_sec", "first_pit_lap", "total_stops", "pits", ("first_pit_lap", "total_stops")),
       "coef std_err t r_squared")
def _ols_pit(t: Tables) -> DataFrame:
    return H.least_squares(pits(t), "total_pit_sec", ["first_pit_lap", "total_stops"]).drop("p_value")


POINTED = PITS + """, pointed AS (
  SELECT pits.*, c_acctbal AS points FROM pits JOIN customer ON "driverId" = c_custkey WHERE c_acctbal IS NOT NULL)"""


@query("ols_points", _ols2_sql(POINTED, "points", "first_pit_lap", "total_stops", "pointed", ("first_pit_lap", "total_stops")),
       "coef std_err t r_squared")
def _ols_points(t: Tables) -> DataFrame:
    """What a driver's account holds, as points, on the first stop and the number of stops."""
    points = t.customer.select(F.col("c_custkey").alias("driverId"), F.col("c_acctbal").alias("points"))
    return hypotheses.pit_model(pits(t).join(points, "driverId", "left")).drop("p_value")
