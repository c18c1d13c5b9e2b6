"""Measures on race entries, shared by every preset.

An entry table has the columns raceId, driverId, full_name, constructorId, constructor_name, year, round,
era, grid, position, positionOrder, points, laps, dnf_category and the 0/1 flags of `result_flags`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paddock.functions import rules
from paddock.functions.rules import ACCIDENT_DNF, MECHANICAL_DNF, OTHER_DNF, flag, percent_of, ratio
from paddock.operators.groups import attach_bounded_first, attach_bounded_stats, attach_group_stats, exact_quantiles, keep_first
from paddock.operators.ordered import min_rank, neighbours, previous_values, rolling_mean, running_totals
from paddock.operators.intervals import attach_by_range, require_disjoint
from paddock.operators.keys import any_null, with_keys_only
from paddock.operators.summaries import grouped

SEASON_KEYS = ["driverId", "full_name", "year", "constructorId", "constructor_name", "era"]


def result_flags(retired: Column | None = None) -> dict[str, Column]:
    """0/1 flags and places gained; a start from grid 0 has no places gained."""
    retired = F.col("position") == 0 if retired is None else retired
    return {
        "is_dnf": flag(retired),
        "is_win": flag(F.col("positionOrder") == 1),
        "is_podium": flag(F.col("positionOrder") <= 3),
        "is_points_finish": flag(F.col("points") > 0),
        "is_pole": flag(F.col("grid") == 1),
        "grid_vs_finish": F.when(F.col("grid") != 0, F.col("grid") - F.col("positionOrder")).cast("double"),
    }


def season_stats(entries: DataFrame, keys: Sequence[str] = SEASON_KEYS) -> DataFrame:
    out = grouped(entries, list(keys), {
        "races": F.count("raceId"),
        "season_points": F.sum("points"),
        "wins": F.sum("is_win"),
        "podiums": F.sum("is_podium"),
        "dnfs": F.sum("is_dnf"),
        "avg_finish_pos": F.avg("positionOrder"),
        "avg_grid_pos": F.avg("grid"),
        "avg_grid_delta": F.avg("grid_vs_finish"),
    })
    return out.withColumns({
        "ppr": ratio("season_points", "races"),
        "win_rate": ratio("wins", "races"),
        "dnf_rate": ratio("dnfs", "races"),
    })


def with_alpha(season: DataFrame) -> DataFrame:
    """Points per race above the mean of the team's drivers in that season."""
    out = attach_bounded_stats(season, ["constructorId", "year"], {"constructor_avg_ppr": F.avg("ppr")})
    return out.withColumn("driver_alpha", F.col("ppr") - F.col("constructor_avg_ppr"))


def with_career(alpha: DataFrame) -> DataFrame:
    """Career figures on each season row."""
    out = attach_bounded_stats(alpha, ["driverId"], {
        "career_alpha": F.avg("driver_alpha"),
        "avg_ppr": F.avg("ppr"),
        "total_races": F.sum("races"),
        "career_wins": F.sum("wins"),
        "career_dnfs": F.sum("dnfs"),
    })
    return out.withColumn("career_dnf_rate", ratio("career_dnfs", "total_races")).drop("career_dnfs")


def career_stats(alpha: DataFrame) -> DataFrame:
    """One row per driver over the season rows; rates of sums, means of seasons."""
    out = grouped(alpha, ["driverId", "full_name"], {
        "total_seasons": F.count("year"),
        "total_races": F.sum("races"),
        "career_points": F.sum("season_points"),
        "career_wins": F.sum("wins"),
        "career_podiums": F.sum("podiums"),
        "career_dnfs": F.sum("dnfs"),
        "career_alpha": F.avg("driver_alpha"),
        "avg_ppr": F.avg("ppr"),
    })
    return out.withColumns({
        "career_win_rate": ratio("career_wins", "total_races"),
        "career_dnf_rate": ratio("career_dnfs", "total_races"),
    })


def team_gap(qualifying: DataFrame) -> DataFrame:
    """First-session time against the team's mean in that race, and which sessions were reached.

    A team enters a few drivers in a race, so a window sees them all after one shuffle.
    """
    out = attach_bounded_stats(qualifying, ["raceId", "constructorId"], {"__team": F.avg("q1_ms")})
    return out.withColumns({
        "q1_vs_team_avg_ms": F.col("q1_ms") - F.col("__team"),
        "reached_q2": F.col("q2_ms").isNotNull().cast("int"),
        "reached_q3": F.col("q3_ms").isNotNull().cast("int"),
    }).drop("__team")


def qualifying_record(gaps: DataFrame, min_sessions: int) -> DataFrame:
    """Share of sessions faster than the team, for drivers with enough sessions. A driver's career bounds the group."""
    out = exact_quantiles(
        gaps.where(F.col("q1_vs_team_avg_ms").isNotNull()),
        ["driverId"],
        {"q_sessions": F.count("q1_vs_team_avg_ms"), "q1_faster": F.count_if(F.col("q1_vs_team_avg_ms") < 0)},
        {"MedianQ1Ms": ("q1_ms", 0.5)}, bounded=True,
    )
    return out.where(F.col("q_sessions") >= min_sessions).withColumn(
        "QualWinPct", F.col("q1_faster") / F.col("q_sessions") * 100
    )


def standings(entries: DataFrame, tie_order: list[str] | None = None, *, complete: bool = False) -> DataFrame:
    """Running points and wins of a driver in a season, rank in the round and gap to the leader.

    `tie_order` orders several rows of a driver in one round. Rows without season, round or driver stay, without
    a standing. A driver's season and a round's drivers are bounded by the calendar and the grid, so each is one window.
    With `complete` the caller states that no row lacks a key, and nothing is looked for. Entries without is_win have no wins.
    """
    keys = ["year", "round", "driverId"]
    ran = running_totals(
        with_keys_only(entries, keys), ["year", "driverId"], ["round", *(tie_order or [])],
        {"cumulative_points": "points"} | ({"cumulative_wins": "is_win"} if "is_win" in entries.columns else {}),
    )
    led = min_rank(ran, ["year", "round"], "cumulative_points", "championship_pos", best="__lead", bounded=True)
    placed = led.withColumn("gap_to_leader", F.col("__lead") - F.col("cumulative_points")).drop("__lead")
    return placed if complete else placed.unionByName(entries.where(any_null(keys)), allowMissingColumns=True)


def pit_summary(valid_stops: DataFrame) -> DataFrame:
    """Stops, time and laps per race and driver. The highest stop number counts, even if that stop is invalid."""
    out = exact_quantiles(
        valid_stops, ["raceId", "driverId"],
        {
            "total_stops": F.max("stop"),
            "total_pit_ms": F.sum("milliseconds"),
            "min_pit_ms": F.min("milliseconds"),
            "first_pit_lap": F.min("lap"),
            "last_pit_lap": F.max("lap"),
        },
        {"median_pit_ms": ("milliseconds", 0.5)}, bounded=True,
    )
    return out.withColumns({
        "total_pit_sec": F.col("total_pit_ms") / 1000,
        "median_pit_sec": F.col("median_pit_ms") / 1000,
        "strategy": rules.stop_strategy("total_stops"),
    }).withColumn("pit_time_per_stop_sec", ratio("total_pit_sec", "total_stops"))


LAPS = 100_000  # laps of a group that are ordered together


def by_laps(lap: str = "lap") -> Column:
    """Bucket of a lap number."""
    return F.floor(F.col(lap) / LAPS)


def position_changes(laps: DataFrame, keys: list[str], order: list[str], *, bounded: bool = False, number: str | None = None) -> DataFrame:
    """Position on the previous lap and places gained since (positive is a gain). `order` begins with the lap.

    With `bounded` the keys name a driver's laps in one race, which one window sees. With `number`, laps numbered without
    gaps, ranges of laps with copies at their borders do. Otherwise laps may be missing and any number of them follow.
    """
    if number is not None:
        out = neighbours(laps, keys, number, {"prev_position": ("position", 1)}, size=LAPS)
    else:
        out = previous_values(laps, keys, order, {"prev_position": "position"}, bucket=None if bounded else by_laps(order[0]))
    return out.withColumn("position_change", F.col("prev_position") - F.col("position"))


def race_completion(entries: DataFrame) -> DataFrame:
    out = attach_bounded_stats(entries, ["raceId"], {"total_race_laps": F.max("laps")})
    return out.withColumn("laps_pct_completed", percent_of("laps", "total_race_laps"))


def with_points_lost(entries: DataFrame, scales: DataFrame) -> DataFrame:
    """Points the final position would have brought, for retirements only, from a table of scales by season and place.

    The table has first_year, last_year, place, points; its seasons must not overlap within a place.
    """
    require_disjoint(scales, ["place"], "first_year", "last_year")
    names = {"points": "__lost", "place": "__place"}
    found = attach_by_range(
        entries.withColumn("__year", F.col("year").cast("int")).withColumn("__at", F.col("positionOrder").cast("int")),
        scales.withColumnsRenamed(names), "__year", "first_year", "last_year", ["__lost"], {"__at": "__place"})
    lost = F.when(F.col("is_dnf") == 1, F.coalesce("__lost", F.lit(0.0))).otherwise(F.lit(0.0))
    return found.withColumn("potential_points_lost", lost).select(*entries.columns, "potential_points_lost")


def retirement_counts(entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Entries, retirements by kind, points and wins per group; all are sums, so groups can be merged."""
    kind = lambda name: F.count_if(F.col("dnf_category") == name)
    return entries.groupBy(*keys).agg(
        F.count("resultId").alias("entries"),
        F.sum("is_dnf").alias("total_dnfs"),
        kind(MECHANICAL_DNF).alias("mechanical_dnfs"),
        kind(ACCIDENT_DNF).alias("accident_dnfs"),
        kind(OTHER_DNF).alias("other_dnfs"),
        F.sum("points").alias("total_points"),
        F.sum("is_win").alias("total_wins"),
        F.sum("potential_points_lost").alias("pts_lost_to_dnf"),
    )


COUNTS = ["entries", "total_dnfs", "mechanical_dnfs", "accident_dnfs", "other_dnfs", "total_points", "total_wins",
          "pts_lost_to_dnf"]
TEAM_SEASON = ["constructorId", "constructor_name", "year", "era"]


def reliability_index(counts: DataFrame) -> DataFrame:
    """Team seasons with retirement counts and rates, 3-season rolling mean, and rates of the team's era.

    `counts` holds retirement counts on a grain of a team season or finer. Era figures are sums over the
    team's season rows, kept on those rows by a window; a team has few seasons.
    """
    season = with_keys_only(counts, ["constructorId", "era"]).groupBy(*TEAM_SEASON).agg(
        *[F.sum(c).alias(c) for c in COUNTS]
    )
    era = attach_bounded_stats(season, ["constructorId", "era"], {
        "__entries": F.sum("entries"), "__dnfs": F.sum("total_dnfs"), "__mech": F.sum("mechanical_dnfs"),
    })
    rates = with_keys_only(era, ["constructor_name", "year"]).withColumns({
        "dnf_rate": ratio("total_dnfs", "entries"),
        "mechanical_dnf_rate": ratio("mechanical_dnfs", "entries"),
        "reliability_index": 1 - ratio("total_dnfs", "entries"),
        "era_reliability": 1 - ratio("__dnfs", "__entries"),
        "era_mech_dnf_rate": ratio("__mech", "__entries"),
    }).drop("__entries", "__dnfs", "__mech")
    return rolling_mean(
        rates, ["constructorId"], ["year", "constructor_name"], "reliability_index", "rolling3_reliability", 3
    )


def career_summary(
    entries: DataFrame, alpha: DataFrame, gaps: DataFrame | None = None, min_sessions: int = 30
) -> DataFrame:
    """Dashboard row per driver: totals, rates, career alpha, qualifying record.

    Without `gaps` the entries themselves carry the qualifying times and gaps, and one aggregate gives totals and record.
    Names must go with the driver; they are taken from the aggregate's rows.
    """
    totals = {
        "TotalRaces": F.count("raceId"),
        "TotalPoints": F.sum("points"),
        "TotalWins": F.sum("is_win"),
        "TotalPodiums": F.sum("is_podium"),
        "TotalDNFs": F.sum("is_dnf"),
        "AvgFinishPos": F.avg("positionOrder"),
        "AvgGridDelta": F.avg("grid_vs_finish"),
    }
    names = [c for c in ("full_name",) if c in entries.columns]
    if gaps is None:
        faster = F.col("q1_vs_team_avg_ms")
        timed = entries.withColumn("__q1", F.when(faster.isNotNull(), F.col("q1_ms")))
        enough = F.col("__sessions") >= min_sessions
        out = exact_quantiles(
            timed, ["driverId", *names], totals | {"__sessions": F.count(faster), "__faster": F.count_if(faster < 0)},
            {"__median": ("__q1", 0.5)}, bounded=True,
        ).withColumns({
            "QualWinPct": F.when(enough, ratio("__faster", "__sessions") * 100), "MedianQ1Ms": F.when(enough, F.col("__median")),
        }).drop("__sessions", "__faster", "__median")
    else:
        record = qualifying_record(gaps, min_sessions).select("driverId", "QualWinPct", "MedianQ1Ms")
        out = grouped(entries, ["driverId", *names], totals).join(record, "driverId", "left")
    career = grouped(alpha, ["driverId"], {"CareerAlpha": F.avg("driver_alpha")})
    return out.withColumns({
        "PPR": ratio("TotalPoints", "TotalRaces"),
        "WinRate": ratio("TotalWins", "TotalRaces"),
        "PodiumRate": ratio("TotalPodiums", "TotalRaces"),
        "DNFRate": ratio("TotalDNFs", "TotalRaces"),
    }).join(career, "driverId", "left").withColumnsRenamed({n: "Driver" for n in names})


def circuit_map(entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Races, years and mean winner's points per place; null if no winner is known.

    Entries are first reduced to one row per race, so the distinct race count is a plain count.
    """
    races = grouped(entries, [*keys, "raceId"], {
        "__y0": F.min("year"), "__y1": F.max("year"),
        "__p": F.sum(F.when(F.col("is_win") == 1, F.col("points"))),
        "__n": F.count(F.when(F.col("is_win") == 1, F.col("points"))),
    })
    return races.groupBy(*keys).agg(
        F.count("raceId").alias("TotalRaces"),
        F.min("__y0").alias("FirstYear"),
        F.max("__y1").alias("LastYear"),
        F.try_divide(F.sum("__p"), F.sum("__n")).alias("AvgPointsWinner"),
    )


GAP_FIGURES = ["q1_ms", "q2_ms", "q3_ms", "best_qual_ms", "q1_vs_team_avg_ms", "reached_q2", "reached_q3"]


def attach_first_gap(gaps: DataFrame, order: list[str]) -> DataFrame:
    """The qualifying figures of a driver's first row in the race, by `order`, on each of the driver's rows there.

    Rows without race or driver have none. A window in the shuffle that the team's mean has already made, instead of a join.
    """
    return attach_bounded_first(gaps, ["raceId", "driverId"], order, GAP_FIGURES)


def master(entries: DataFrame, gaps: DataFrame | None, table: DataFrame, alpha: DataFrame, order: Sequence[Column], *,
           standing_keys: Sequence[str] = ("raceId", "driverId"), alpha_by_standing: bool = False) -> DataFrame:
    """Entries with qualifying gaps, standings (first row per key in the given order) and alpha attached.

    Without `gaps` the entries themselves carry the qualifying figures. With `alpha_by_standing` the caller states that every
    entry with alpha has a standing, whose key has driver and year: alpha is joined to the fewer standings, as a list over the
    driver's teams in the year, and each entry takes its team's rows from it.
    """
    keys = list(standing_keys)
    kept = keep_first(table, keys, list(order)).select(
        *keys, "cumulative_points", "championship_pos", "gap_to_leader"
    )
    if gaps is not None:
        entries = entries.join(gaps.select("raceId", "driverId", *GAP_FIGURES), ["raceId", "driverId"], "left")
    if alpha_by_standing:
        figures = ["driver_alpha", "constructor_avg_ppr", "ppr"]
        listed = alpha.groupBy("driverId", "year").agg(F.collect_list(F.struct("constructorId", *figures)).alias("__teams"))
        found = entries.join(kept.join(listed, ["driverId", "year"], "left"), keys, "left")
        own = F.filter("__teams", lambda x: x["constructorId"] == F.col("constructorId"))
        return found.withColumn("__team", F.explode_outer(own)).select(
            *[c for c in found.columns if c != "__teams"], *[F.col(f"__team.{c}") for c in figures])
    return (
        entries.join(kept, keys, "left")
        .join(
            alpha.select("driverId", "year", "constructorId", "driver_alpha", "constructor_avg_ppr", "ppr"),
            ["driverId", "year", "constructorId"], "left",
        )
    )


def stint_laps(laps: DataFrame) -> DataFrame:
    """Stint number and lap within the stint. A stint starts on the flagged lap and on the first lap."""
    flagged = laps.withColumn("__pit", F.col("pit_stop_lap").cast("long"))
    numbered = running_totals(flagged, ["driverId"], ["lap"], {"stint": "__pit"}, bucket=by_laps()).drop("__pit")
    started = attach_group_stats(numbered, ["driverId", "stint"], {"__start": F.min("lap")})
    return started.withColumn("lap_in_stint", F.col("lap") - F.col("__start") + 1).drop("__start")


def leader_counts(table: DataFrame) -> DataFrame:
    return grouped(table.where("championship_pos = 1"), ["driverId"], {"rounds_led": F.count(F.lit(1))})


def champion_points(table: DataFrame) -> DataFrame:
    """Champion's points per season: the running total at the season's last round, first rank."""
    last = attach_bounded_stats(
        grouped(table, ["year", "round"], {"points": F.max("cumulative_points")}),
        ["year"], {"__last": F.max("round")},
    )
    return last.where("round = __last").select("year", "points")


def mechanical_rate(entries: DataFrame) -> DataFrame:
    """Share of entries with a mechanical retirement, by decade."""
    out = grouped(entries.withColumn("decade", rules.decade("year")), ["decade"], {
        "entries": F.count(F.lit(1)), "mechanical": F.count_if(F.col("dnf_category") == MECHANICAL_DNF),
    })
    return out.withColumn("mechanical_rate", ratio("mechanical", "entries"))


def carry_over(season_points: DataFrame, keys: Sequence[str] = ("driverId",)) -> DataFrame:
    """Correlation of the rank in one season with the points of the next season present."""
    ranked = min_rank(season_points, ["year"], "points", "pos", bounded=True)
    before = previous_values(ranked, list(keys), ["year"], {"before": "pos"})
    return before.agg(F.count("before").alias("n"), F.corr("before", "points").alias("corr"))


def gap_and_points(gaps: DataFrame, entries: DataFrame) -> DataFrame:
    """Per driver the median gap to the team, points per race, and whether the gap is below the median driver's."""
    gap = exact_quantiles(
        gaps.where(F.col("q1_vs_team_avg_ms").isNotNull()), ["driverId"], {},
        {"median_gap": ("q1_vs_team_avg_ms", 0.5)}, bounded=True,
    )
    middle = exact_quantiles(gap, [], {}, {"m": ("median_gap", 0.5)}).select("m").scalar()
    points = grouped(entries, ["driverId"], {"ppr": F.avg("points")})
    return gap.join(points, "driverId", "left").withColumn("below_median", F.col("median_gap") < middle)


def strategy_by_place(entries: DataFrame, place: str, finish: str, points: str) -> DataFrame:
    """Mean and median finish, mean points and count for each place and pit strategy."""
    return exact_quantiles(
        entries, [place, "strategy"],
        {"n": F.count(F.lit(1)), "mean_finish": F.avg(finish), "mean_points": F.avg(points)},
        {"median_finish": (finish, 0.5)},
    )


def career_gap_seconds(gaps: DataFrame) -> DataFrame:
    """Mean gap to the team in seconds, per driver with a gap."""
    return grouped(gaps.where(F.col("q1_vs_team_avg_ms").isNotNull()), ["driverId"], {
        "sessions": F.count(F.lit(1)), "mean_gap_sec": F.avg("q1_vs_team_avg_ms") / 1000,
    })
