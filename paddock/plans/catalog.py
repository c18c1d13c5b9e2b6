"""Registry of the named queries, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from paddock.plans.views import Tables
from paddock.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SCALE = 1e6  # six decimals
EXACT = 9e9  # larger doubles have no sixth decimal that could be cut


def query(name: str, sql: str | None = None, doubles: str = ""):
    """Register `build(tables)`. Doubles are rounded alike on both sides; `doubles` names them for the SQL."""
    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            configure(spark)
            return round_doubles(build(Tables(spark, folder)))

        QUERIES[name] = run
        if sql:
            rounds = ", ".join(f'CASE WHEN abs("{c}") < {EXACT} THEN floor("{c}" * {SCALE} + 0.5) / {SCALE} ELSE "{c}" END AS "{c}"' for c in doubles.split())
            ORACLES[name] = f"SELECT * REPLACE ({rounds}) FROM (\n{sql}\n)" if rounds else sql
        return build

    return register


def round_doubles(df: DataFrame) -> DataFrame:
    """Six decimals by plain arithmetic: the rounding functions of engines part ways on values like 4.1546875."""
    return df.select(*[
        F.when(F.abs(F.col(f"`{f.name}`")) < EXACT, F.floor(F.col(f"`{f.name}`") * SCALE + 0.5) / SCALE)
        .otherwise(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


# Race entries in SQL, the counterpart of views.entries.
E = """e AS (
  SELECT l_orderkey AS "raceId", l_orderkey AS "resultId", l_suppkey AS "driverId", s_nationkey AS "constructorId",
    n_name AS constructor_name, s_name AS full_name,
    CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS round,
    CASE WHEN year(o_orderdate) <= 1996 THEN 'Pre-V10' WHEN year(o_orderdate) <= 1998 THEN 'V10'
         WHEN year(o_orderdate) <= 2000 THEN 'V8' ELSE 'Hybrid' END AS era,
    l_linenumber AS "positionOrder", CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_linenumber END AS position,
    CAST(l_partkey % 8 AS INT) AS grid, l_quantity AS points, l_extendedprice AS laps,
    l_returnflag || l_linestatus AS status,
    CASE WHEN l_returnflag = 'A' THEN 'Finished' WHEN l_returnflag || l_linestatus = 'RF' THEN 'Mechanical DNF'
         WHEN l_returnflag || l_linestatus = 'RO' THEN 'Accident DNF' ELSE 'Other DNF' END AS dnf_category,
    CAST(l_returnflag = 'R' AS INT) AS is_dnf, CAST(l_linenumber = 1 AS INT) AS is_win,
    CAST(l_linenumber <= 3 AS INT) AS is_podium, CAST(l_quantity > 0 AS INT) AS is_points_finish,
    CAST(l_partkey % 8 = 1 AS INT) AS is_pole,
    CASE WHEN l_partkey % 8 <> 0 THEN CAST(l_partkey % 8 - l_linenumber AS DOUBLE) END AS grid_vs_finish,
    l_extendedprice AS q1_ms, nullif(l_discount, 0) AS q2_ms, nullif(l_tax, 0) AS q3_ms,
    coalesce(nullif(l_tax, 0), nullif(l_discount, 0), l_extendedprice) AS best_qual_ms
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation ON s_nationkey = n_nationkey)"""

# Stops and laps in SQL, the counterparts of views.pit_stops and views.laps.
PS = """ps AS (
  SELECT strftime(ts, '%Y-%m-%d') AS "raceId", user_id AS "driverId", hour(ts) AS lap,
    row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY ts, event_id) AS stop,
    CAST(round(value * 1000) AS BIGINT) AS milliseconds,
    round(value * 1000) BETWEEN 2000 AND 120000 AS is_valid_stop
  FROM events WHERE event_type = 'purchase')"""
L = """l AS (
  SELECT user_id AS "driverId", event_id, value, CAST(floor(value) % 20 AS INT) AS position,
    event_type = 'error' AS pit_stop_lap,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS lap
  FROM events WHERE user_id IS NOT NULL)"""

SEASON = E + """, season AS (
  SELECT "driverId", full_name, year, "constructorId", constructor_name, era, count(*) AS races,
    sum(points) AS season_points, CAST(sum(is_win) AS BIGINT) AS wins, CAST(sum(is_podium) AS BIGINT) AS podiums,
    CAST(sum(is_dnf) AS BIGINT) AS dnfs, avg("positionOrder") AS avg_finish_pos, avg(grid) AS avg_grid_pos,
    avg(grid_vs_finish) AS avg_grid_delta, sum(points) / count(*) AS ppr, sum(is_win) / count(*) AS win_rate,
    sum(is_dnf) / count(*) AS dnf_rate
  FROM e GROUP BY ALL), alpha AS (
  SELECT *, avg(ppr) OVER (PARTITION BY "constructorId", year) AS constructor_avg_ppr,
    ppr - avg(ppr) OVER (PARTITION BY "constructorId", year) AS driver_alpha
  FROM season)"""
SEASON_DOUBLES = "season_points avg_finish_pos avg_grid_pos avg_grid_delta ppr win_rate dnf_rate"

TABLE = E + """, rounds AS (
  SELECT year, round, "driverId", sum(points) AS points, CAST(sum(is_win) AS BIGINT) AS is_win
  FROM e GROUP BY ALL), running AS (
  SELECT *, sum(points) OVER w AS cumulative_points, CAST(sum(is_win) OVER w AS BIGINT) AS cumulative_wins
  FROM rounds WINDOW w AS (PARTITION BY year, "driverId" ORDER BY round)), standing AS (
  SELECT *, CAST(rank() OVER (PARTITION BY year, round ORDER BY cumulative_points DESC) AS INT) AS championship_pos,
    max(cumulative_points) OVER (PARTITION BY year, round) - cumulative_points AS gap_to_leader
  FROM running)"""

GAPS = E + """, gaps AS (
  SELECT *, q1_ms - avg(q1_ms) OVER (PARTITION BY "raceId", "constructorId") AS q1_vs_team_avg_ms,
    CAST(q2_ms IS NOT NULL AS INT) AS reached_q2, CAST(q3_ms IS NOT NULL AS INT) AS reached_q3
  FROM e)"""

LOST = E + """, lost AS (
  SELECT *, CASE WHEN is_dnf = 0 THEN 0.0::DOUBLE ELSE coalesce(CAST(CASE
    WHEN year <= 1996 THEN [8, 6, 4, 3, 2] WHEN year <= 1998 THEN [9, 6, 4, 3, 2, 1]
    WHEN year <= 2000 THEN [10, 8, 6, 5, 4, 3, 2, 1] ELSE [25, 18, 15, 12, 10, 8, 6, 4, 2, 1] END["positionOrder"]
    AS DOUBLE), 0.0) END AS potential_points_lost
  FROM e)"""

TEAMS = LOST + """, team AS (
  SELECT "constructorId", constructor_name, year, era, count(*) AS entries, CAST(sum(is_dnf) AS BIGINT) AS total_dnfs,
    count(*) FILTER (WHERE dnf_category = 'Mechanical DNF') AS mechanical_dnfs,
    count(*) FILTER (WHERE dnf_category = 'Accident DNF') AS accident_dnfs,
    count(*) FILTER (WHERE dnf_category = 'Other DNF') AS other_dnfs, sum(points) AS total_points,
    CAST(sum(is_win) AS BIGINT) AS total_wins, sum(potential_points_lost) AS pts_lost_to_dnf
  FROM lost GROUP BY ALL), reliability AS (
  SELECT *, total_dnfs / entries AS dnf_rate, mechanical_dnfs / entries AS mechanical_dnf_rate,
    1 - total_dnfs / entries AS reliability_index,
    avg(1 - total_dnfs / entries) OVER (PARTITION BY "constructorId" ORDER BY year
      ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling3_reliability,
    1 - sum(total_dnfs) OVER o / sum(entries) OVER o AS era_reliability,
    sum(mechanical_dnfs) OVER o / sum(entries) OVER o AS era_mech_dnf_rate
  FROM team WINDOW o AS (PARTITION BY "constructorId", era))"""

PITS = PS + """, pits AS (
  SELECT "raceId", "driverId", max(stop) AS total_stops, CAST(sum(milliseconds) AS BIGINT) AS total_pit_ms,
    median(milliseconds) AS median_pit_ms, min(milliseconds) AS min_pit_ms, CAST(min(lap) AS INT) AS first_pit_lap,
    CAST(max(lap) AS INT) AS last_pit_lap, sum(milliseconds) / 1000 AS total_pit_sec,
    median(milliseconds) / 1000 AS median_pit_sec,
    CASE max(stop) WHEN 1 THEN '1-Stop' WHEN 2 THEN '2-Stop' WHEN 3 THEN '3-Stop' ELSE '4+ Stops' END AS strategy,
    sum(milliseconds) / 1000 / max(stop) AS pit_time_per_stop_sec
  FROM ps WHERE is_valid_stop GROUP BY ALL)"""
