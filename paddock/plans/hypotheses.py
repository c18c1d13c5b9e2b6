"""The published hypothesis tests, regressions and KPI tables over the joined tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from paddock.operators import hypotheses as tests
from paddock.operators.summaries import binned_mean, factorize, grouped, pivot_mean, rounded
from paddock.functions.rules import ERAS, flag
from paddock.plans import metrics

# Team names counted as top teams.
TOP_TEAMS = ["Ferrari", "McLaren", "Williams", "Mercedes", "Lotus", "RBR", "Red Bull Racing"]

# The hypotheses as worded.
TEXTS = {
    "H1": "Qualifying (grid) position correlates with finishing position",
    "H2": "Grid P1-P5 starters score significantly more points than lower positions",
    "H3": "Driver alpha scores significantly differ from zero (elite driver skill detectable)",
    "H4": "Pole-to-win conversion rate differs significantly by era (V10 vs V8 vs Hybrid)",
    "H5": "One-stop strategies result in better (lower) finish positions than two-stop strategies",
    "H6": "Longer pit durations are associated with smaller position gains",
    "H8": "DNF rates differ significantly between V10 and Hybrid eras",
    "H9": "Top teams have significantly lower DNF rates than midfield constructors",
    "H10": (
        "Championship contenders score significantly more points per race than non-contenders "
        "(higher DNF opportunity cost)"
    ),
}


def _with_winner(j3: DataFrame) -> DataFrame:
    return j3.dropna(subset=["era", "grid"]).withColumn("is_winner", flag(F.col("positionOrder") == 1))


def _with_change(j5: DataFrame) -> DataFrame:
    """Grid 0 is kept here, unlike in grid_vs_finish."""
    return j5.withColumn("position_change", F.col("grid") - F.col("positionOrder"))


def run_tests(j: dict[str, DataFrame], *, poles_only: bool = False) -> dict[str, DataFrame]:
    """One test row per hypothesis. `poles_only` restricts H4 to pole sitters, which its wording means."""
    j1, j3, j5 = j["J1_master_race_results"], j["J3_qualifying_analysis"], j["J5_pit_strategy"]
    entries, table = j["J7_reliability_dnf"], j["J4_championship_progression"]
    h4 = _with_winner(j3).where("grid = 1") if poles_only else _with_winner(j3)
    pits = j5.dropna(subset=["total_stops", "positionOrder"])
    scored = table.dropna(subset=["is_dnf", "points"]).where("is_dnf = 0")
    top = entries.dropna(subset=["is_dnf"]).withColumn("is_top_team", flag(F.col("constructor_name").isin(TOP_TEAMS)))
    return {
        "H1": tests.spearman(j1, "grid", "positionOrder"),
        "H2": tests.welch(j1, "points", F.col("grid") <= 5, F.col("grid") > 5),
        "H3": tests.one_sample_t(j["J2_driver_alpha"], "driver_alpha"),
        "H4": tests.chi_squared(h4, "era", "is_winner", [0, 1]),
        "H5": tests.mann_whitney(
            pits, "positionOrder", F.col("total_stops") == 1, F.col("total_stops") == 2, "less"
        ),
        "H6": tests.spearman(_with_change(j5), "total_pit_sec", "position_change"),
        "H8": tests.chi_squared(entries.where(F.col("era").isin("V10", "Hybrid")), "era", "is_dnf", [0, 1]),
        "H9": tests.chi_squared(top, "is_top_team", "is_dnf", [0, 1]),
        "H10": tests.mann_whitney(
            scored, "points", F.col("championship_pos") <= 5, F.col("championship_pos") > 5, "greater"
        ),
    }


def hypothesis_log(j: dict[str, DataFrame]) -> DataFrame:
    return tests.report({h: (TEXTS[h], row) for h, row in run_tests(j).items()})


def pit_model(j5: DataFrame) -> DataFrame:
    """Points on the lap of the first stop and the number of stops."""
    return tests.least_squares(j5, "points", ["first_pit_lap", "total_stops"])


def regressions(j: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Points on grid; points on grid and era code; points on first stop and number of stops."""
    j1 = j["J1_master_race_results"].dropna(subset=["grid", "points", "era"])
    codes = factorize(j1, "era", ["resultId"], "era_code")
    return {
        "grid": tests.least_squares(j["J1_master_race_results"], "points", ["grid"]),
        "grid_era": tests.least_squares(j1.join(codes, "era", "left"), "points", ["grid", "era_code"]),
        "pit": pit_model(j["J5_pit_strategy"]),
    }


def proposed(j: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Questions the exploration left open: teammate gap and points, stops and finish in the latest era,
    mechanical retirements by decade, and a season's rank against the next season's points."""
    j1, j5 = j["J1_master_race_results"], j["J5_pit_strategy"]
    by_gap = metrics.gap_and_points(j["J3_qualifying_analysis"], j1)
    season = grouped(j1, ["constructorId", "year"], {"points": F.sum("points")})
    return {
        "gap_points": tests.welch(by_gap, "ppr", F.col("below_median"), ~F.col("below_median")),
        "stops_finish": tests.spearman(j5.where("era = 'Hybrid'"), "total_stops", "positionOrder"),
        "mechanical_by_decade": metrics.mechanical_rate(j1),
        "carry_over": metrics.carry_over(season, ["constructorId"]),
    }


def pit_duration_bins(j5: DataFrame) -> DataFrame:
    return binned_mean(_with_change(j5), "total_pit_sec", "position_change", 9)


def kpi_pit_strategy(j5: DataFrame, digits: int | None = 2) -> DataFrame:
    out = grouped(j5, ["constructor_name"], {
        "avg_pit_duration": F.avg("total_pit_sec"), "pit_duration_std": F.stddev_samp("total_pit_sec"),
        "avg_finish_pos": F.avg("positionOrder"), "avg_points": F.avg("points"),
    })
    columns = ["avg_pit_duration", "pit_duration_std", "avg_finish_pos", "avg_points"]
    return rounded(out, columns, digits).orderBy("avg_pit_duration", "constructor_name")


def kpi_by_era(j8: DataFrame, digits: int | None = 2) -> DataFrame:
    out = grouped(j8, ["era"], {
        "reliability_index": F.avg("reliability_index"), "entries": F.sum("entries"),
        "total_dnfs": F.sum("total_dnfs"), "pts_lost_to_dnf": F.avg("pts_lost_to_dnf"),
    })
    return rounded(out, ["reliability_index", "pts_lost_to_dnf"], digits).orderBy(F.desc("reliability_index"), "era")


def kpi_driver_career(j2: DataFrame) -> DataFrame:
    return j2.select("full_name", "total_races", "driver_alpha", "career_alpha").dropna().orderBy(
        F.desc("driver_alpha"), "full_name"
    )


def reliability_pivot(j8: DataFrame) -> DataFrame:
    return pivot_mean(j8, "constructor_name", "era", [name for _, _, name in ERAS], "reliability_index")


def build_all(j: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All report tables: test log, KPIs, regressions, the bins and pivot behind the charts, and the open questions."""
    fits = regressions(j)
    terms = reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("model"), *df.columns) for n, df in fits.items()])
    open_ = proposed(j)
    compared = tests.report({n: (n, open_[n]) for n in ("gap_points", "stops_finish")})
    return {
        "hypothesis_testing_results": hypothesis_log(j),
        "KPI_pit_strategy": kpi_pit_strategy(j["J5_pit_strategy"]),
        "KPI_dnf_by_era": kpi_by_era(j["J8_constructor_reliability"]),
        "KPI_driver_career": kpi_driver_career(j["J2_driver_alpha"]),
        "regression_terms": terms,
        "pit_duration_bins": pit_duration_bins(j["J5_pit_strategy"]),
        "reliability_pivot": reliability_pivot(j["J8_constructor_reliability"]),
        "open_questions": compared,
        "mechanical_by_decade": open_["mechanical_by_decade"],
        "rank_carry_over": open_["carry_over"],
    }
