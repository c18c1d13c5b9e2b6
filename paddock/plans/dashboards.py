"""Dashboard files: joined tables under their published column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paddock.functions.rules import percent_of
from paddock.operators.joins import require_unique
from paddock.operators.keys import with_keys_only
from paddock.operators.summaries import missing_columns, mostly_null, rename_known
from paddock.plans import metrics
from paddock.plans.joined import Options

# Published column names.
COMMON = {
    "full_name": "Driver", "constructor_name": "Constructor", "race_name": "RaceName", "year": "Season",
    "era": "Era",
}
PLACE = {"country": "Country", "circuit_name": "Circuit"}
ALPHA_SEASON = COMMON | {
    "season_points": "SeasonPoints", "races": "RacesThisSeason", "wins": "SeasonWins",
    "podiums": "SeasonPodiums", "dnfs": "SeasonDNFs", "avg_finish_pos": "AvgFinishPos",
    "avg_grid_pos": "AvgGridPos", "avg_grid_delta": "AvgGridDelta", "ppr": "PointsPerRace",
    "constructor_avg_ppr": "ConstructorAvgPPR", "driver_alpha": "DriverAlpha", "career_alpha": "CareerAlpha",
    "win_rate": "WinRate", "dnf_rate": "DNFRate", "total_races": "CareerTotalRaces",
}
PIT_STRATEGY = COMMON | PLACE | {
    "total_stops": "TotalStops", "strategy": "Strategy", "median_pit_sec": "MedianPitSec",
    "total_pit_sec": "TotalPitSec", "min_pit_ms": "MinPitMs", "first_pit_lap": "FirstPitLap",
    "last_pit_lap": "LastPitLap", "pit_time_per_stop_sec": "AvgSecPerStop", "positionOrder": "FinishPosition",
    "points": "Points", "grid": "GridPosition", "laps": "TotalLaps", "is_dnf": "DNF",
    "grid_vs_finish": "GridDelta", "status": "Status", "dnf_category": "DNFCategory",
}
LAP_BY_LAP = COMMON | {
    "lap_time_sec": "LapTimeSec", "position": "TrackPosition", "position_change": "PositionChange",
    "pit_stop_lap": "IsPitLap", "pit_duration_ms": "PitDurationMs",
}
RELIABILITY_DNF = COMMON | PLACE | {
    "nationality_driver": "DriverNationality", "grid": "GridPosition", "positionOrder": "FinishPosition",
    "laps": "LapsCompleted", "total_race_laps": "TotalRaceLaps", "laps_pct_completed": "LapsPctCompleted",
    "status": "Status", "dnf_category": "DNFCategory", "is_dnf": "IsDNF", "is_win": "IsWin",
    "is_podium": "IsPodium", "potential_points_lost": "PotentialPointsLost",
}
CONSTRUCTOR_RELIABILITY = COMMON | {
    "entries": "Entries", "total_dnfs": "TotalDNFs", "mechanical_dnfs": "MechanicalDNFs",
    "accident_dnfs": "AccidentDNFs", "other_dnfs": "OtherDNFs", "total_points": "TotalPoints",
    "total_wins": "TotalWins", "pts_lost_to_dnf": "PtsLostToDNF", "dnf_rate": "DNFRate",
    "mechanical_dnf_rate": "MechDNFRate", "reliability_index": "ReliabilityIndex",
    "rolling3_reliability": "Rolling3Reliability", "era_reliability": "EraReliability",
    "era_mech_dnf_rate": "EraMechDNFRate",
}
CHAMPIONSHIP = COMMON | {
    "country": "Country", "round": "Round", "points": "Points", "is_win": "IsWin", "is_podium": "IsPodium",
    "is_dnf": "IsDNF", "positionOrder": "FinishPosition", "grid": "GridPosition",
    "cumulative_points": "CumulativePoints", "cumulative_wins": "CumulativeWins",
    "championship_pos": "ChampionshipPosition", "gap_to_leader": "GapToLeader",
}

# Columns each output must have.
# Fixed values.
REQUIRED = {
    "DB1_driver_alpha_season": ["Driver", "Season", "Constructor", "Era", "DriverAlpha", "PointsPerRace"],
    "DB1_driver_career_summary": ["Driver", "CareerAlpha", "WinRate", "TotalRaces"],
    "DB2_pit_strategy": ["Driver", "Season", "TotalStops", "Strategy", "FinishPosition", "MedianPitSec"],
    "DB2_lap_by_lap": ["Driver", "Season", "lap", "LapTimeSec", "TrackPosition"],
    "DB3_reliability_dnf": ["Driver", "Season", "Era", "DNFCategory", "IsDNF"],
    "DB3_constructor_reliability": ["Constructor", "Season", "Era", "ReliabilityIndex", "DNFRate"],
    "DB4_championship_story": [
        "Driver", "Season", "Round", "CumulativePoints", "ChampionshipPosition", "GapToLeader",
    ],
    "DB4_circuit_map": ["circuit_name", "country", "lat", "lng"],
    "MASTER_tableau_ready": [
        "full_name", "year", "era", "points", "is_win", "is_dnf", "dnf_category", "driver_alpha",
        "championship_pos", "q1_ms",
    ],
}


def pit_strategy(j5: DataFrame) -> DataFrame:
    """With how early in the race, by the driver's own laps, the first stop came."""
    return rename_known(j5, PIT_STRATEGY).withColumn("FirstStopPct", percent_of("FirstPitLap", "TotalLaps"))


def master(j: dict[str, DataFrame], options: Options = Options()) -> DataFrame:
    """Flat table at race-entry grain; the qualifying and alpha keys must be unique."""
    gaps, alpha = j["J3_qualifying_analysis"], j["J2_driver_alpha"]
    require_unique(gaps, ["raceId", "driverId"], "J3")
    require_unique(alpha, ["driverId", "year", "constructorId"], "J2")
    order = [F.col("round"), F.col("resultId")] if options.keep == "first" else [F.desc("round"), F.desc("resultId")]
    return metrics.master(
        j["J1_master_race_results"], gaps, j["J4_championship_progression"], alpha, order
    )


def wide_master(j: dict[str, DataFrame], options: Options = Options()) -> DataFrame:
    """The documented wider flat table: every column of the joined tables at entry grain, alpha of the team with most races.

    Everything that is joined must have unique keys, or entries would repeat.
    """
    from paddock.operators.summaries import keep_max

    for name, keys in (("J3_qualifying_analysis", ["raceId", "driverId"]), ("J5_pit_strategy", ["raceId", "driverId"]),
                       ("J7_reliability_dnf", ["resultId"]), ("J8_constructor_reliability", ["constructorId", "year"])):
        require_unique(with_keys_only(j[name], keys), keys, name)

    order = [F.col("resultId")] if options.keep == "first" else [F.desc("resultId")]
    parts = [
        (keep_max(j["J2_driver_alpha"], ["driverId", "year"], "races", ["constructorId"]), ["driverId", "year"]),
        (j["J3_qualifying_analysis"], ["raceId", "driverId"]),
        (metrics.keep_first(j["J4_championship_progression"], ["raceId", "driverId"], order), ["raceId", "driverId"]),
        (j["J5_pit_strategy"], ["raceId", "driverId"]),
        (j["J7_reliability_dnf"], ["resultId"]),
        (j["J8_constructor_reliability"], ["constructorId", "year"]),
    ]
    out = j["J1_master_race_results"]
    for table, keys in parts:  # a column that is there already is the entry's own
        out = out.join(table.select(*keys, *[c for c in table.columns if c not in out.columns]), keys, "left")
    return out


def season_with_career(season: DataFrame, career: DataFrame) -> DataFrame:
    """Season rows next to the driver's career row, as the first dashboard links them."""
    extra = [c for c in career.columns if c not in season.columns]
    return season.join(career.select("driverId", *extra), "driverId", "left")


def entries_with_team(entries: DataFrame, team: DataFrame, season: str = "Season") -> DataFrame:
    """Entries next to the row of their team's season, as the third dashboard links them."""
    extra = [c for c in team.columns if c not in entries.columns]
    return entries.join(team.select("constructorId", season, *extra), ["constructorId", season], "left")


def build_all(j: dict[str, DataFrame], options: Options = Options()) -> dict[str, DataFrame]:
    j1, j2, j3 = (j[n] for n in ("J1_master_race_results", "J2_driver_alpha", "J3_qualifying_analysis"))
    return {
        "DB1_driver_alpha_season": rename_known(j2, ALPHA_SEASON),
        "DB1_driver_career_summary": metrics.career_summary(j1, j2, j3),
        "DB2_pit_strategy": pit_strategy(j["J5_pit_strategy"]),
        "DB2_lap_by_lap": rename_known(j["J6_lap_by_lap"].where("is_racing_lap"), LAP_BY_LAP),
        "DB3_reliability_dnf": rename_known(j["J7_reliability_dnf"], RELIABILITY_DNF),
        "DB3_constructor_reliability": rename_known(j["J8_constructor_reliability"], CONSTRUCTOR_RELIABILITY),
        "DB4_championship_story": rename_known(j["J4_championship_progression"].drop("resultId"), CHAMPIONSHIP),
        "DB4_circuit_map": metrics.circuit_map(j1, ["circuitId", "circuit_name", "country", "lat", "lng"]),
        "MASTER_tableau_ready": master(j, options),
    }


def gate(outputs: dict[str, DataFrame], max_null_share: float = 0.3) -> dict[str, dict]:
    """Missing required columns and mostly-null columns of each output."""
    return {
        name: {
            "missing": missing_columns(df, REQUIRED.get(name, [])),
            "mostly_null": [r["column_name"] for r in mostly_null(df, max_null_share).collect()],
        }
        for name, df in outputs.items()
    }
