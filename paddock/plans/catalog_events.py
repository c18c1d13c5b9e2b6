"""Queries on pit stops and laps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paddock.functions import rules
from paddock.operators import summaries as S
from paddock.operators.groups import exact_quantiles
from paddock.operators.ordered import around_events
from paddock.plans import metrics
from paddock.plans.catalog import L, PITS, PS, query
from paddock.plans.views import Tables, laps, pit_stops


def pits(t: Tables) -> DataFrame:
    return metrics.pit_summary(pit_stops(t).where("is_valid_stop"))


@query("pit_summary", f"WITH {PITS} SELECT * FROM pits",
       "median_pit_ms total_pit_sec median_pit_sec pit_time_per_stop_sec")
def _pit_summary(t: Tables) -> DataFrame:
    return pits(t)


@query("strategy_reward", f"""WITH {PITS}
SELECT strategy, count(*) AS n, avg(total_pit_sec) AS avg_total, median(total_pit_sec) AS median_total,
  avg(first_pit_lap) AS avg_first_lap FROM pits GROUP BY ALL""", "avg_total median_total avg_first_lap")
def _strategy_reward(t: Tables) -> DataFrame:
    return exact_quantiles(
        pits(t), ["strategy"],
        {"n": F.count(F.lit(1)), "avg_total": F.avg("total_pit_sec"), "avg_first_lap": F.avg("first_pit_lap")},
        {"median_total": ("total_pit_sec", 0.5)},
    )


@query("range_flags", f"""WITH {PS}
SELECT "raceId", "driverId", stop, lap, milliseconds, is_valid_stop,
  milliseconds BETWEEN 60000 AND 300000 AS is_racing_lap FROM ps""")
def _range_flags(t: Tables) -> DataFrame:
    return pit_stops(t).select(
        "raceId", "driverId", "stop", F.col("lap").cast("long").alias("lap"), "milliseconds", "is_valid_stop",
        rules.within("milliseconds", rules.RACING_LAP_MS).alias("is_racing_lap"),
    )


@query("lap_events", f"""WITH {L}, p AS (SELECT DISTINCT "driverId", lap, value * 1000 AS pit_duration_ms
  FROM l WHERE pit_stop_lap)
SELECT l."driverId", l.lap, l.position, p.pit_duration_ms, p.lap IS NOT NULL AS pit_stop_lap,
  lag(l.position) OVER w AS prev_position, lag(l.position) OVER w - l.position AS position_change
FROM l LEFT JOIN p ON l."driverId" = p."driverId" AND l.lap = p.lap
WINDOW w AS (PARTITION BY l."driverId" ORDER BY l.lap)""", "pit_duration_ms")
def _lap_events(t: Tables) -> DataFrame:
    numbered = laps(t)
    stops = numbered.where("pit_stop_lap").select(
        "driverId", "lap", (F.col("value") * 1000).alias("pit_duration_ms"), F.lit(True).alias("pit_stop_lap")
    ).distinct()
    joined = numbered.select("driverId", "lap", "position").join(stops, ["driverId", "lap"], "left")
    joined = joined.withColumn("pit_stop_lap", F.coalesce("pit_stop_lap", F.lit(False)))
    return metrics.position_changes(joined, ["driverId"], ["lap"], number="lap")


@query("event_study", f"""WITH {L}, c AS (
  SELECT *, lag(position) OVER (PARTITION BY "driverId" ORDER BY lap) - position AS change FROM l)
SELECT CAST(c.lap - p.lap AS INT) AS "offset", count(*) AS n, avg(c.position) AS avg_position, avg(c.change) AS avg_change
FROM l p JOIN c ON p."driverId" = c."driverId" AND c.lap BETWEEN p.lap - 2 AND p.lap + 2
WHERE p.pit_stop_lap GROUP BY ALL""", "avg_position avg_change")
def _event_study(t: Tables) -> DataFrame:
    near = around_events(
        laps(t), ["driverId"], "lap", "pit_stop_lap", 2, wanted={"prev_position": ("position", 1)}, size=metrics.LAPS)
    near = near.withColumn("position_change", F.col("prev_position") - F.col("position"))
    return near.groupBy("offset").agg(
        F.count(F.lit(1)).alias("n"), F.avg("position").alias("avg_position"),
        F.avg("position_change").alias("avg_change"),
    )


STINTS = L + """, s AS (
  SELECT *, CAST(sum(CAST(pit_stop_lap AS INT)) OVER (PARTITION BY "driverId" ORDER BY lap) AS BIGINT) AS stint FROM l),
  st AS (SELECT *, lap - min(lap) OVER (PARTITION BY "driverId", stint) + 1 AS lap_in_stint FROM s)"""


@query("stint_slope", f"""WITH {STINTS}
SELECT "driverId", count(*) AS laps, count(DISTINCT stint) AS stints, max(lap_in_stint) AS longest,
  regr_slope(value, lap_in_stint) AS slope FROM st GROUP BY ALL""", "slope")
def _stint_slope(t: Tables) -> DataFrame:
    stints = S.grouped(metrics.stint_laps(laps(t)), ["driverId", "stint"], {
        "n": F.count(F.lit(1)), "longest": F.max("lap_in_stint"), "sx": F.sum("lap_in_stint"),
        "sy": F.sum("value"), "sxy": F.sum(F.col("value") * F.col("lap_in_stint")),
        "sxx": F.sum(F.col("lap_in_stint") * F.col("lap_in_stint")),
    })
    total = stints.groupBy("driverId").agg(
        F.sum("n").alias("laps"), F.count(F.lit(1)).alias("stints"), F.max("longest").alias("longest"),
        *[F.sum(c).alias(c) for c in ("sx", "sy", "sxy", "sxx")],
    )
    top = F.col("laps") * F.col("sxy") - F.col("sx") * F.col("sy")
    bottom = (F.col("laps") * F.col("sxx") - F.col("sx") * F.col("sx")).cast("double")
    return total.select("driverId", "laps", "stints", "longest", F.when(bottom != 0, top / bottom).alias("slope"))


@query("lap_flag", """
SELECT CASE WHEN value < 60 THEN 'suspiciously_fast' WHEN value > 300 THEN 'slow_or_pitlap' ELSE 'normal' END AS lap_flag,
  count(*) AS n FROM events GROUP BY ALL""")
def _lap_flag(t: Tables) -> DataFrame:
    flagged = t.events.select(rules.lap_flag("value", (60, 300)).alias("lap_flag"))
    return S.count_rows("lap_flag")(flagged).orderBy(F.desc("n"))


@query("group_percentiles", """
SELECT event_type, count(*) AS n, quantile_cont(value, 0.25) AS p25, median(value) AS p50,
  quantile_cont(value, 0.75) AS p75, quantile_cont(value, 0.95) AS p95 FROM events GROUP BY ALL""", "p25 p50 p75 p95")
def _group_percentiles(t: Tables) -> DataFrame:
    wanted = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
    return exact_quantiles(
        t.events.select("event_type", "value"), ["event_type"], {"n": F.count(F.lit(1))},
        {n: ("value", p) for n, p in wanted.items()},
    )


@query("stops_per_race", f"""WITH {PITS}
SELECT total_stops, count(*) AS drivers, count(DISTINCT "raceId") AS races FROM pits GROUP BY ALL""")
def _stops_per_race(t: Tables) -> DataFrame:
    per_race = S.grouped(pits(t), ["total_stops", "raceId"], {"n": F.count(F.lit(1))})
    return per_race.groupBy("total_stops").agg(F.sum("n").alias("drivers"), F.count(F.lit(1)).alias("races"))


@query("first_stop_share", f"""WITH {PITS}
SELECT "raceId", "driverId", strategy, first_pit_lap / nullif(last_pit_lap, 0) * 100 AS first_stop_pct FROM pits""",
       "first_stop_pct")
def _first_stop_share(t: Tables) -> DataFrame:
    return pits(t).select(
        "raceId", "driverId", "strategy", rules.percent_of("first_pit_lap", "last_pit_lap").alias("first_stop_pct")
    )


@query("pit_labels", f"""WITH {PITS}, days AS (
  SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS "raceId", user_id AS "driverId" FROM events)
SELECT d."raceId", d."driverId", p.strategy IS NOT NULL AS has_pit_data, coalesce(p.strategy, 'No Pit Data') AS strategy
FROM days d LEFT JOIN pits p ON d."raceId" = p."raceId" AND d."driverId" = p."driverId" """)
def _pit_labels(t: Tables) -> DataFrame:
    days = t.events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("raceId"), F.col("user_id").alias("driverId")
    ).distinct()
    out = days.join(pits(t).select("raceId", "driverId", "strategy"), ["raceId", "driverId"], "left")
    return out.select(
        "raceId", "driverId", F.col("strategy").isNotNull().alias("has_pit_data"),
        rules.strategy_or_none("strategy").alias("strategy"),
    )
