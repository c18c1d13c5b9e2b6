"""Cleaned tables to enriched tables and the eight joined analysis tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from paddock.functions import rules, text, times
from paddock.operators.joins import Dimension, attach_distinct, require_unique, star_join, with_membership
from paddock.operators.keys import any_null, with_keys_only
from paddock.plans import metrics

RACE_COLUMNS = ["race_name", "year", "round", "circuitId", "era"]


@dataclass(frozen=True)
class Options:
    """Where the published variants differ.

    dnf_rule: "position" (position 0) or "status" (status not among the finished ones, or no position).
    status_rule: "exact" (the word Finished, or a leading +) or "prefix" (any text that begins so).
    mechanical: the status texts that count as mechanical.
    points_regimes: the season's own scale, or the 2010 scale for all seasons.
    pit_filter: "valid" or "all" stops on the lap table.
    keep: which of a driver's rows in one race the master table takes, "first" or "last".
    """

    dnf_rule: str = "position"
    status_rule: str = "exact"
    mechanical: tuple[str, ...] = tuple(rules.MECHANICAL)
    points_regimes: tuple = tuple(rules.POINTS)
    pit_filter: str = "valid"
    keep: str = "first"


STATUS_VARIANT = Options(
    dnf_rule="status", status_rule="prefix", mechanical=tuple(rules.MECHANICAL_WIDE),
    points_regimes=tuple(rules.POINTS_2010_ALWAYS), pit_filter="all", keep="last",
)


def enrich(clean: dict[str, DataFrame], options: Options = Options()) -> dict[str, DataFrame]:
    """Names without clashes, eras, categories, flags and milliseconds on the cleaned tables."""
    t = dict(clean)
    t["races"] = (
        t["races"].drop("url", "time").withColumnRenamed("name", "race_name")
        .withColumns({"era": rules.bucket_label("year"), "date": times.date_or_null(F.col("date").cast("string"))})
    )
    t["drivers"] = _drivers(t["drivers"])
    t["constructors"] = t["constructors"].withColumnRenamed("name", "constructor_name")
    t["circuits"] = t["circuits"].withColumnRenamed("name", "circuit_name")
    prefixes = ("+",) if options.status_rule == "exact" else ("+", "Finished")
    t["status"] = t["status"].withColumn(
        "dnf_category", rules.retirement_category("status", options.mechanical, finished_prefixes=prefixes)
    )
    t["results"] = _results(t["results"], t["status"], options)
    q = t["qualifying"].withColumns({f"q{i}_ms": times.lap_time_ms(f"q{i}") for i in (1, 2, 3)})
    t["qualifying"] = q.withColumn("best_qual_ms", F.coalesce("q3_ms", "q2_ms", "q1_ms"))
    t["pit_stops"] = t["pit_stops"].withColumns({
        "duration_ms": F.col("milliseconds"), "is_valid_stop": rules.within("milliseconds", rules.PIT_MS),
    })
    t["lap_times"] = t["lap_times"].withColumn("is_racing_lap", rules.within("milliseconds", rules.RACING_LAP_MS))
    return t


def _drivers(df: DataFrame) -> DataFrame:
    if "full_name" not in df.columns:
        df = df.withColumn("full_name", text.joined_name("forename", "surname"))
    df = df.withColumn("dob", times.birth_date(F.col("dob").cast("string")))
    return df if "birth_year" in df.columns else df.withColumn("birth_year", F.year("dob"))


def _results(results: DataFrame, status: DataFrame, options: Options) -> DataFrame:
    if options.dnf_rule == "position":
        return results.withColumns(metrics.result_flags())
    finished = status.where(F.col("dnf_category") == rules.FINISHED_DNF)
    known = with_membership(results, finished, "statusId", "statusId", "__finished")
    retired = F.col("position").isNull() | ~F.col("__finished")
    return known.withColumns({
        **metrics.result_flags(retired), "dnf": retired, "finished_flag": ~retired, "points_scored": F.col("points") > 0,
    }).drop("__finished")


def master_results(t: dict[str, DataFrame]) -> DataFrame:
    """One row per race entry. Dimension keys must be unique, or the join would add rows."""
    for name, key in (("races", "raceId"), ("circuits", "circuitId"), ("drivers", "driverId"),
                      ("constructors", "constructorId"), ("status", "statusId")):
        require_unique(t[name], [key], name)
    return star_join(t["results"], [
        Dimension(t["races"], {"raceId": "raceId"}, ["race_name", "year", "round", "circuitId", "date", "era"]),
        Dimension(t["circuits"], {"circuitId": "circuitId"}, ["circuit_name", "location", "country", "lat", "lng"]),
        Dimension(t["drivers"], {"driverId": "driverId"}, ["full_name", "nationality", "dob", "birth_year"], "_driver"),
        Dimension(t["constructors"], {"constructorId": "constructorId"}, ["constructor_name", "nationality"], "_constructor"),
        Dimension(t["status"], {"statusId": "statusId"}, ["status", "dnf_category"]),
    ])


def driver_alpha(j1: DataFrame) -> DataFrame:
    return metrics.with_career(metrics.with_alpha(metrics.season_stats(j1)))


def qualifying_analysis(t: dict[str, DataFrame]) -> DataFrame:
    joined = star_join(t["qualifying"], [
        Dimension(t["races"], {"raceId": "raceId"}, RACE_COLUMNS),
        Dimension(t["circuits"], {"circuitId": "circuitId"}, ["circuit_name", "country"]),
        Dimension(t["drivers"], {"driverId": "driverId"}, ["full_name", "nationality"]),
        Dimension(t["constructors"], {"constructorId": "constructorId"}, ["constructor_name"]),
    ]).join(
        t["results"].select("raceId", "driverId", "positionOrder", "points", "grid", "is_dnf", "grid_vs_finish"),
        ["raceId", "driverId"], "left",
    )
    return metrics.team_gap(joined)


def championship(j1: DataFrame) -> DataFrame:
    """Several entries of a driver in one race follow each other in resultId order."""
    columns = [
        "resultId", "year", "raceId", "round", "race_name", "country", "era", "driverId", "full_name",
        "constructorId", "constructor_name", "points", "is_win", "is_podium", "is_dnf", "positionOrder", "grid",
    ]
    return metrics.standings(j1.select(*columns), tie_order=["resultId"])


def pit_strategy(t: dict[str, DataFrame]) -> DataFrame:
    """Team and status come from the race entry, so the results are joined before those dimensions."""
    entry = ["constructorId", "positionOrder", "points", "grid", "laps", "is_dnf", "grid_vs_finish", "statusId"]
    joined = star_join(metrics.pit_summary(t["pit_stops"].where("is_valid_stop")), [
        Dimension(t["races"], {"raceId": "raceId"}, RACE_COLUMNS),
        Dimension(t["circuits"], {"circuitId": "circuitId"}, ["circuit_name", "country"]),
        Dimension(t["drivers"], {"driverId": "driverId"}, ["full_name"]),
        Dimension(t["results"], {"raceId": "raceId", "driverId": "driverId"}, entry),
    ])
    return star_join(joined, [
        Dimension(t["constructors"], {"constructorId": "constructorId"}, ["constructor_name"]),
        Dimension(t["status"], {"statusId": "statusId"}, ["status", "dnf_category"]),
    ])


LAP_KEYS = ["raceId", "driverId"]


def lap_by_lap(t: dict[str, DataFrame], options: Options = Options()) -> DataFrame:
    """Laps with their pit stop, if any, and the places gained on each lap.

    Names and stops are first put on one row per driver and race, whose stops are a short list. Laps then meet that row in one
    join by (race, driver), look their stop up in its list, and the lag over the same keys needs no other layout: laps
    are shuffled once, and not at all if they are stored in buckets of these keys (`sources.tables.save_bucketed`).
    """
    laps = t["lap_times"]
    whole = with_keys_only(laps, LAP_KEYS)
    entries = _lap_entries(t, whole.select(*LAP_KEYS).distinct(), options)
    # A lap without a race or driver has no entry; what it does have is looked up for it alone.
    rest = laps.where(any_null(LAP_KEYS))
    alone = _lap_entries(t, rest.select(*LAP_KEYS).distinct(), options)
    renamed = alone.withColumnsRenamed({k: f"__{k}" for k in LAP_KEYS})
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in LAP_KEYS]
    parts = [whole.join(entries, LAP_KEYS, "left"), rest.join(renamed, same, "left").drop(*[f"__{k}" for k in LAP_KEYS])]
    return _with_stops(parts[0]).unionByName(_with_stops(parts[1]))


def _lap_entries(t: dict[str, DataFrame], keys: DataFrame, options: Options) -> DataFrame:
    stops = t["pit_stops"] if options.pit_filter == "all" else t["pit_stops"].where("is_valid_stop")
    lists = with_keys_only(stops, [*LAP_KEYS, "lap"]).groupBy(*LAP_KEYS).agg(
        F.collect_list(F.struct("lap", F.col("milliseconds").alias("pit_duration_ms"), "is_valid_stop")).alias("__stops"))
    named = star_join(keys, [
        Dimension(t["races"], {"raceId": "raceId"}, ["year", "round", "race_name", "era"]),
        Dimension(t["drivers"], {"driverId": "driverId"}, ["full_name"]),
    ])
    named = attach_distinct(named, t["results"], LAP_KEYS, ["constructorId"])
    named = star_join(named, [Dimension(t["constructors"], {"constructorId": "constructorId"}, ["constructor_name"])])
    return named.join(lists, LAP_KEYS, "left")


def _with_stops(laps: DataFrame) -> DataFrame:
    """Laps with the list of their race's stops: one row per stop on the lap or one without, and places gained."""
    mine = F.filter("__stops", lambda s: s["lap"] == F.col("lap"))
    out = laps.withColumn("__stop", F.explode_outer(mine)).withColumns({
        "pit_duration_ms": F.col("__stop.pit_duration_ms"), "is_valid_stop": F.col("__stop.is_valid_stop"),
        "pit_stop_lap": F.col("__stop").isNotNull(), "lap_time_sec": F.col("milliseconds") / 1000,
    }).drop("__stop", "__stops")
    return metrics.position_changes(out, LAP_KEYS, ["lap", "constructorId", "pit_duration_ms"], bounded=True)


def reliability_entries(j1: DataFrame, options: Options = Options()) -> DataFrame:
    columns = [
        "resultId", "raceId", "race_name", "year", "round", "era", "date", "driverId", "full_name",
        "nationality_driver", "constructorId", "constructor_name", "nationality_constructor", "circuit_name",
        "country", "grid", "positionOrder", "laps", "points", "statusId", "status", "dnf_category", "is_dnf",
        "is_win", "is_podium",
    ]
    out = metrics.race_completion(j1.select(*columns))
    return metrics.with_points_lost(out, rules.points_table(j1.sparkSession, options.points_regimes))


def constructor_reliability(j7: DataFrame) -> DataFrame:
    return metrics.reliability_index(metrics.retirement_counts(j7, metrics.TEAM_SEASON))


def build_all(t: dict[str, DataFrame], options: Options = Options()) -> dict[str, DataFrame]:
    """All joined tables over enriched tables. The job writes J1 and J7 once and reads them back."""
    j1 = master_results(t)
    j7 = reliability_entries(j1, options)
    return {
        "J1_master_race_results": j1,
        "J2_driver_alpha": driver_alpha(j1),
        "J3_qualifying_analysis": qualifying_analysis(t),
        "J4_championship_progression": championship(j1),
        "J5_pit_strategy": pit_strategy(t),
        "J6_lap_by_lap": lap_by_lap(t, options),
        "J7_reliability_dnf": j7,
        "J8_constructor_reliability": constructor_reliability(j7),
    }
