"""Further queries: strategy by place, averages of measures, joins of two tables, mostly empty columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paddock.functions import rules
from paddock.operators import summaries as S
from paddock.operators.groups import exact_quantiles
from paddock.operators.joins import Dimension, attach_distinct, star_join
from paddock.operators.ordered import min_rank, running_totals
from paddock.plans import joined, metrics
from paddock.plans.catalog import GAPS, L, PITS, SEASON, TEAMS, query
from paddock.plans.catalog_events import pits
from paddock.plans.catalog_results import alpha, gaps, reliability
from paddock.plans.views import ERAS, Tables, laps

ENTERED = PITS + """, entered AS (
  SELECT p.*, c_name, n_name AS place FROM pits p LEFT JOIN customer ON p."driverId" = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey)"""


def entered(t: Tables) -> DataFrame:
    """Pit summaries with the driver's name and place."""
    return star_join(pits(t), [
        Dimension(t.customer, {"driverId": "c_custkey"}, ["c_name", "c_nationkey"]),
        Dimension(t.nation, {"c_nationkey": "n_nationkey"}, ["n_name"], rename={"n_name": "place"}),
    ])


@query("pit_entries", f"""WITH {ENTERED}
SELECT "raceId", "driverId", total_stops, total_pit_ms, strategy, c_name, place FROM entered""")
def _pit_entries(t: Tables) -> DataFrame:
    return entered(t).select("raceId", "driverId", "total_stops", "total_pit_ms", "strategy", "c_name", "place")


@query("strategy_by_place", f"""WITH {ENTERED}
SELECT place, strategy, count(*) AS n, avg(first_pit_lap) AS mean_finish, avg(pit_time_per_stop_sec) AS mean_points,
  median(first_pit_lap) AS median_finish FROM entered WHERE place IS NOT NULL GROUP BY ALL""",
       "mean_finish mean_points median_finish")
def _strategy_by_place(t: Tables) -> DataFrame:
    return metrics.strategy_by_place(entered(t), "place", "first_pit_lap", "pit_time_per_stop_sec")


@query("one_stop_rate", f"""WITH {ENTERED}
SELECT place, count(*) FILTER (WHERE strategy = '1-Stop' AND first_pit_lap < 12) AS hits,
  count(*) FILTER (WHERE strategy = '1-Stop') AS base,
  count(*) FILTER (WHERE strategy = '1-Stop' AND first_pit_lap < 12) * 100.0
    / nullif(count(*) FILTER (WHERE strategy = '1-Stop'), 0) AS one_stop_pct
FROM entered WHERE place IS NOT NULL GROUP BY ALL""", "one_stop_pct")
def _one_stop_rate(t: Tables) -> DataFrame:
    return S.conditional_rate(
        entered(t), ["place"], F.col("first_pit_lap") < 12, F.col("strategy") == "1-Stop", "one_stop_pct")


@query("first_stop_mean", f"""WITH {PITS}
SELECT strategy, count(*) AS n, avg(first_pit_lap / nullif(last_pit_lap, 0) * 100) AS mean_first_stop_pct
FROM pits GROUP BY ALL""", "mean_first_stop_pct")
def _first_stop_mean(t: Tables) -> DataFrame:
    share = pits(t).withColumn("share", rules.percent_of("first_pit_lap", "last_pit_lap"))
    return S.grouped(share, ["strategy"], {"n": F.count(F.lit(1)), "mean_first_stop_pct": F.avg("share")})


@query("gap_seconds", f"""WITH {GAPS}
SELECT "driverId", count(*) AS sessions, avg(q1_vs_team_avg_ms) / 1000 AS mean_gap_sec
FROM gaps WHERE q1_vs_team_avg_ms IS NOT NULL GROUP BY ALL""", "mean_gap_sec")
def _gap_seconds(t: Tables) -> DataFrame:
    return metrics.career_gap_seconds(gaps(t))


@query("mean_alpha", f"""WITH {SEASON}
SELECT era, count(*) AS n, avg(driver_alpha) AS mean_alpha FROM alpha GROUP BY ALL""", "mean_alpha")
def _mean_alpha(t: Tables) -> DataFrame:
    return S.grouped(alpha(t), ["era"], {"n": F.count(F.lit(1)), "mean_alpha": F.avg("driver_alpha")})


@query("mean_reliability", f"""WITH {TEAMS}
SELECT era, count(*) AS n, avg(reliability_index) AS mean_reliability FROM reliability GROUP BY ALL""", "mean_reliability")
def _mean_reliability(t: Tables) -> DataFrame:
    return S.grouped(reliability(t), ["era"], {"n": F.count(F.lit(1)), "mean_reliability": F.avg("reliability_index")})


@query("distinct_right_side", """
SELECT o_orderkey, o_custkey, l_returnflag, l_linestatus FROM orders
  LEFT JOIN (SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem) ON o_orderkey = l_orderkey""")
def _distinct_right_side(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag", "l_linestatus")
    return attach_distinct(t.orders.select("o_orderkey", "o_custkey"), lines, ["o_orderkey"], ["l_returnflag", "l_linestatus"])


@query("three_key_join", f"""WITH {L}, days AS (
  SELECT user_id AS "driverId", CAST(ts AS DATE) AS day, hour(ts) AS hour, count(*) AS n, sum(value) AS total
  FROM events WHERE user_id IS NOT NULL GROUP BY ALL),
p AS (SELECT user_id AS "driverId", CAST(ts AS DATE) AS day, hour(ts) AS hour, count(*) AS stops
  FROM events WHERE event_type = 'purchase' AND user_id IS NOT NULL GROUP BY ALL)
SELECT d."driverId", strftime(d.day, '%Y-%m-%d') AS day, CAST(d.hour AS INT) AS hour, n, stops, stops IS NOT NULL AS stopped
FROM days d LEFT JOIN p ON d."driverId" = p."driverId" AND d.day = p.day AND d.hour = p.hour""")
def _three_key_join(t: Tables) -> DataFrame:
    keys = ["driverId", "day", "hour"]
    rows = t.events.where("user_id is not null").select(
        F.col("user_id").alias("driverId"), F.date_format("ts", "yyyy-MM-dd").alias("day"), F.hour("ts").alias("hour"), "event_type")
    every = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    stops = rows.where("event_type = 'purchase'").groupBy(*keys).agg(F.count(F.lit(1)).alias("stops"))
    return every.join(stops, keys, "left").withColumn("stopped", F.col("stops").isNotNull())


@query("mostly_null", """
SELECT column_name, nrows AS rows, nulls, nulls / nrows AS share FROM (
  SELECT unnest(['discount', 'tax', 'quantity']) AS column_name, unnest([
    count(*) FILTER (WHERE nullif(l_discount, 0) IS NULL), count(*) FILTER (WHERE l_tax < 0.05),
    count(*) FILTER (WHERE l_quantity IS NULL)]) AS nulls, count(*) AS nrows FROM lineitem)
WHERE nulls / nrows > 0.3""", "share")
def _mostly_null(t: Tables) -> DataFrame:
    gappy = t.lineitem.select(
        F.expr("nullif(l_discount, 0)").alias("discount"), F.expr("CASE WHEN l_tax >= 0.05 THEN l_tax END").alias("tax"),
        F.col("l_quantity").alias("quantity"))
    return S.mostly_null(gappy)


@query("null_ranks", """
WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_suppkey, nullif(l_discount, 0) AS v FROM lineitem),
r AS (SELECT *, sum(v) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM v)
SELECT l_orderkey, l_linenumber, total, CASE WHEN v IS NOT NULL THEN CAST(rank() OVER (
  PARTITION BY l_suppkey, v IS NULL ORDER BY v DESC) AS INT) END AS place FROM r""", "total")
def _null_ranks(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_suppkey", F.expr("nullif(l_discount, 0)").alias("v"))
    ran = running_totals(rows, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], {"total": "v"},
                         bucket=F.floor(F.col("l_orderkey") / 100_000))
    return min_rank(ran, ["l_suppkey"], "v", "place").select("l_orderkey", "l_linenumber", "total", "place")


@query("lap_join", """
WITH stops AS (
  SELECT event_id AS race, CAST(user_id % 100 + 1 AS BIGINT) AS driver, CAST(hour(ts) % 7 + 1 AS BIGINT) AS lap,
    CAST(round(value * 1000) AS BIGINT) AS ms FROM events WHERE round(value * 1000) BETWEEN 2000 AND 120000), lines AS (
  SELECT l_orderkey, l_suppkey, l_linenumber, min(l_partkey % 20) AS place, min(l_extendedprice) AS l_extendedprice
  FROM lineitem GROUP BY ALL), laps AS (
  SELECT l_orderkey AS "raceId", l_suppkey AS "driverId", CAST(l_linenumber AS BIGINT) AS lap, CAST(place AS INT) AS position,
    CAST(year(o_orderdate) AS INT) AS year, s_name AS full_name, s_nationkey AS "constructorId", n_name AS constructor_name,
    floor(l_extendedprice) / 1000 AS lap_time_sec, ms AS pit_duration_ms
  FROM lines LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN stops ON race = l_orderkey AND driver = l_suppkey AND stops.lap = l_linenumber)
SELECT *, pit_duration_ms IS NOT NULL AS pit_stop_lap, lag(position) OVER w AS prev_position,
  lag(position) OVER w - position AS position_change
FROM laps WINDOW w AS (PARTITION BY "raceId", "driverId" ORDER BY lap, pit_duration_ms NULLS FIRST)""", "lap_time_sec")
def _lap_join(t: Tables) -> DataFrame:
    """The joined lap table, built from order lines as laps and events as pit stops."""
    order = F.col("l_orderkey").alias("raceId"), F.col("l_suppkey").alias("driverId")
    stops = t.events.select(
        F.col("event_id").alias("raceId"), (F.col("user_id") % 100 + 1).cast("long").alias("driverId"),
        (F.hour("ts") % 7 + 1).cast("long").alias("lap"), F.round(F.col("value") * 1000).cast("bigint").alias("milliseconds"),
    ).withColumn("is_valid_stop", rules.within("milliseconds", rules.PIT_MS))
    tables = {
        "lap_times": t.lineitem.groupBy(*order, F.col("l_linenumber").cast("long").alias("lap")).agg(
            F.min(F.col("l_partkey") % 20).cast("int").alias("position"), F.floor(F.min("l_extendedprice")).alias("milliseconds")),
        "races": t.orders.select(
            F.col("o_orderkey").alias("raceId"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("round"),
            F.col("o_orderpriority").alias("race_name"), rules.bucket_label(F.year("o_orderdate"), ERAS).alias("era")),
        "drivers": t.supplier.select(F.col("s_suppkey").alias("driverId"), F.col("s_name").alias("full_name")),
        "results": t.lineitem.select(*order).join(
            t.supplier.select(F.col("s_suppkey").alias("driverId"), F.col("s_nationkey").alias("constructorId")), "driverId"),
        "constructors": t.nation.select(F.col("n_nationkey").alias("constructorId"), F.col("n_name").alias("constructor_name")),
        "pit_stops": stops,
    }
    return joined.lap_by_lap(tables).select(
        "raceId", "driverId", "lap", "position", "year", "full_name", "constructorId", "constructor_name", "lap_time_sec",
        "pit_duration_ms", "pit_stop_lap", "prev_position", "position_change")


@query("nan_ranks", """
WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, nullif(l_discount, 0) AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CASE WHEN v IS NOT NULL THEN CAST(rank() OVER (
  PARTITION BY v IS NULL ORDER BY v DESC) AS INT) END AS place FROM v""", "l_extendedprice")
def _nan_ranks(t: Tables) -> DataFrame:
    """Ranks over a whole column in which NaN stands for what is not known."""
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_discount")).alias("v"))
    return min_rank(rows, [], "v", "place").drop("v")


@query("nan_quantiles", """
SELECT l_returnflag, count(*) AS n, median(nullif(l_discount, 0)) AS mid, quantile_cont(nullif(l_discount, 0), 0.9) AS high,
  quantile_cont(CASE WHEN l_tax > 0.02 THEN l_extendedprice END, 0.25) AS low FROM lineitem GROUP BY ALL""", "mid high low")
def _nan_quantiles(t: Tables) -> DataFrame:
    nan = F.lit(float("nan"))
    rows = t.lineitem.select(
        "l_returnflag", F.nanvl(F.when(F.col("l_discount") == 0, nan).otherwise(F.col("l_discount")), nan).alias("v"),
        F.when(F.col("l_tax") > 0.02, F.col("l_extendedprice")).otherwise(nan).alias("w"))
    return exact_quantiles(rows, ["l_returnflag"], {"n": F.count(F.lit(1))}, {"mid": ("v", 0.5), "high": ("v", 0.9), "low": ("w", 0.25)})
