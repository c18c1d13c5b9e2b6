"""The analysis views over the order, event and dimension tables.

Race entries are order lines: a race is an order, a driver a supplier, a team the supplier's nation. Pit
stops and laps are events. Each view builds only the joins its wanted columns need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paddock.functions import rules
from paddock.operators.ordered import row_numbers
from paddock.operators.summaries import grouped
from paddock.plans.metrics import result_flags

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Fixed values of this preset: eras, points scales and status sets on the order tables.
ERAS = [(1900, 1996, "Pre-V10"), (1997, 1998, "V10"), (1999, 2000, "V8"), (2001, 2100, "Hybrid")]
ERA_NAMES = [name for _, _, name in ERAS]
POINTS = [
    (0, 1996, [8, 6, 4, 3, 2]),
    (1997, 1998, [9, 6, 4, 3, 2, 1]),
    (1999, 2000, [10, 8, 6, 5, 4, 3, 2, 1]),
    (2001, 9999, [25, 18, 15, 12, 10, 8, 6, 4, 2, 1]),
]
FINISHED_PREFIX, MECHANICAL, ACCIDENT = "A", ["RF"], ["RO"]


class Tables:
    """Parquet tables of a folder, opened when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._open = spark, folder.rstrip("/"), {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._open[name]


FROM_ORDERS = {"year", "round", "era"}
FROM_SUPPLIER = {"constructorId", "full_name", "constructor_name"}
FROM_NAMES = {"full_name", "constructor_name"}


def attach_team(t: Tables, df: DataFrame, driver: str = "driverId", names: bool = True) -> DataFrame:
    """Add constructorId, and with `names` also full_name and constructor_name, of the driver.

    On an aggregate by driver this joins one row per driver instead of every entry.
    """
    supplier = t.supplier.select(
        F.col("s_suppkey").alias(driver), F.col("s_nationkey").alias("constructorId"),
        *([F.col("s_name").alias("full_name")] if names else []),
    )
    out = df.join(supplier, driver, "left")
    return attach_team_name(t, out) if names else out


def attach_team_name(t: Tables, df: DataFrame) -> DataFrame:
    nation = t.nation.select(F.col("n_nationkey").alias("constructorId"), F.col("n_name").alias("constructor_name"))
    return df.join(nation, "constructorId", "left")


def entries(t: Tables, *columns: str, parts: int | None = None) -> DataFrame:
    """Race entries with the wanted columns. `parts` cuts the join with the races into so many tasks."""
    need = set(columns)
    df = t.lineitem if parts is None else t.lineitem.repartition(parts, "l_orderkey")
    if need & FROM_ORDERS:
        orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
        df = df.join(orders if parts is None else orders.repartition(parts, "l_orderkey"), "l_orderkey", "left")
    if need & FROM_SUPPLIER:
        df = attach_team(t, df.withColumnRenamed("l_suppkey", "driverId"), names=bool(need & FROM_NAMES))
    else:
        df = df.withColumnRenamed("l_suppkey", "driverId")

    year = F.year("o_orderdate")
    base = {
        "raceId": F.col("l_orderkey"), "resultId": F.col("l_orderkey"), "driverId": F.col("driverId"),
        "positionOrder": F.col("l_linenumber"),
        "position": F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("l_linenumber")),
        "grid": (F.col("l_partkey") % 8).cast("int"),
        "points": F.col("l_quantity"), "laps": F.col("l_extendedprice"),
        "status": F.concat("l_returnflag", "l_linestatus"),
        "q1_ms": F.col("l_extendedprice"), "q2_ms": F.nullif("l_discount", F.lit(0.0)),
        "q3_ms": F.nullif("l_tax", F.lit(0.0)),
        "constructorId": F.col("constructorId") if need & FROM_SUPPLIER else None,
        "full_name": F.col("full_name") if need & FROM_NAMES else None,
        "constructor_name": F.col("constructor_name") if need & FROM_NAMES else None,
        "year": year if need & FROM_ORDERS else None,
        "round": F.month("o_orderdate") if need & FROM_ORDERS else None,
        "era": rules.bucket_label(year, ERAS) if need & FROM_ORDERS else None,
    }
    out = df.select(*[c.alias(n) for n, c in base.items() if c is not None])
    derived = result_flags() | {
        "dnf_category": rules.retirement_category(
            "status", MECHANICAL, ACCIDENT, finished=(), finished_prefixes=(FINISHED_PREFIX,), titled=False
        ),
        "best_qual_ms": F.coalesce("q3_ms", "q2_ms", "q1_ms"),
    }
    return out.withColumns({n: c for n, c in derived.items() if n in need}).select(*columns)


def round_totals(t: Tables) -> DataFrame:
    """Points and wins per season, round and driver."""
    e = entries(t, "year", "round", "driverId", "points", "is_win")
    return grouped(e, ["year", "round", "driverId"], {"points": F.sum("points"), "is_win": F.sum("is_win")})


def pit_stops(t: Tables) -> DataFrame:
    """Purchases as stops: a race is a day, a lap an hour; the stop number counts the driver's day."""
    e = t.events.where("event_type = 'purchase'").select(
        F.date_format("ts", "yyyy-MM-dd").alias("raceId"), F.col("user_id").alias("driverId"), "ts", "event_id",
        F.hour("ts").alias("lap"), F.round(F.col("value") * 1000).cast("bigint").alias("milliseconds"),
    )
    numbered = row_numbers(e, ["raceId", "driverId"], ["ts", "event_id"], "stop", bucket=F.col("lap"))
    return numbered.withColumn("is_valid_stop", rules.within("milliseconds", rules.PIT_MS))


def laps(t: Tables) -> DataFrame:
    """All events of a user as that driver's laps; errors are pit laps."""
    e = t.events.select(
        F.col("user_id").alias("driverId"), "ts", "event_id", "value",
        (F.floor("value") % 20).cast("int").alias("position"),
        (F.col("event_type") == "error").alias("pit_stop_lap"),
    ).where("driverId is not null")
    return row_numbers(e, ["driverId"], ["ts", "event_id"], "lap", bucket=F.to_date("ts"))
