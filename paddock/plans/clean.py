"""Raw tables to cleaned tables, one function per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paddock.functions import rules, text, times
from paddock.operators.groups import keep_first
from paddock.operators.summaries import drop_ghost_columns, fill_nulls, impute_median, strip_headers


def _strip(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: text.strip(c) for c in columns})


def _cast(df: DataFrame, to: str, columns: list[str]) -> DataFrame:
    """Decimal text is read as double, so that whole-number types truncate; whole numbers are read as they are."""
    plain = {c: F.col(c).cast("double").cast(to) for c in columns}
    if to == "double":
        return df.withColumns(plain)
    return df.withColumns({c: F.coalesce(F.col(c).try_cast("bigint").cast(to), plain[c]) for c in columns})


def _first_per(df: DataFrame, key: str | list[str]) -> DataFrame:
    """One row per key; among repeats the least in column order, so that the choice is repeatable."""
    keys = [key] if isinstance(key, str) else key
    return keep_first(df, keys, [F.col(c) for c in df.columns if c not in keys])


def circuits(raw: DataFrame) -> DataFrame:
    df = _strip(drop_ghost_columns(raw).drop("url", "alt"), ["circuitRef", "name", "location", "country"])
    df = _cast(_cast(df, "int", ["circuitId"]), "double", ["lat", "lng"])
    return _first_per(df.withColumn("country", text.title_case("country")), "circuitId")


def circuit_probes() -> dict[str, Column]:
    return {
        "lat_out_of_range": (F.col("lat") < -90) | (F.col("lat") > 90),
        "lng_out_of_range": (F.col("lng") < -180) | (F.col("lng") > 180),
    }


def constructors(raw: DataFrame) -> DataFrame:
    df = _strip(drop_ghost_columns(raw).drop("url"), ["constructorRef", "name", "nationality"])
    df = _cast(df, "int", ["constructorId"]).withColumn("nationality", text.title_case("nationality"))
    return _first_per(df, "constructorId")


def constructor_results(raw: DataFrame) -> DataFrame:
    df = _cast(raw.drop("status"), "int", ["constructorResultsId", "raceId", "constructorId", "points"])
    return _first_per(df, "constructorResultsId")


def _standings(raw: DataFrame, key: str, entity: str) -> DataFrame:
    df = _cast(drop_ghost_columns(raw), "int", [key, "raceId", entity, "points", "position", "wins"])
    return _first_per(df.withColumn("is_classified", text.is_numeric_text("positionText")), key)


def constructor_standings(raw: DataFrame) -> DataFrame:
    return _standings(raw, "constructorStandingsId", "constructorId")


def driver_standings(raw: DataFrame) -> DataFrame:
    return _standings(raw, "driverStandingsId", "driverId")


def standings_probes() -> dict[str, Column]:
    return {"position_below_1": F.col("position") < 1, "negative_wins": F.col("wins") < 0}


def drivers(raw: DataFrame) -> DataFrame:
    """Drivers without a readable date of birth are left out."""
    df = _strip(raw.drop("url"), ["driverRef", "forename", "surname", "nationality"])
    df = _cast(fill_nulls(_cast(df, "double", ["number"]), numbers=["number"]), "int", ["driverId", "number"])
    df = df.withColumns({
        "code": text.short_code(text.null_if_missing("code"), "surname"),
        "dob": times.birth_date("dob"),
        "nationality": text.title_case("nationality"),
        "full_name": text.joined_name("forename", "surname"),
    }).withColumn("birth_year", F.year("dob"))
    return _first_per(df.dropna(subset=["dob"]), "driverId")


def lap_times(raw: DataFrame) -> DataFrame:
    df = _cast(_cast(raw, "int", ["raceId", "driverId", "lap", "position"]), "long", ["milliseconds"])
    return _first_per(df.withColumn("lap_flag", rules.lap_flag("milliseconds")), ["raceId", "driverId", "lap"])


def lap_probes(tolerance_ms: int = 50) -> dict[str, Column]:
    return {
        "lap_below_1": F.col("lap") < 1,
        "position_below_1": F.col("position") < 1,
        "time_text_differs": F.abs(times.lap_time_whole_ms("time") - F.col("milliseconds")) > tolerance_ms,
    }


def pit_stops(raw: DataFrame) -> DataFrame:
    """Median imputation of the numeric columns comes before the durations are parsed."""
    numbers = ["raceId", "driverId", "stop", "lap", "milliseconds"]
    df = fill_nulls(_cast(strip_headers(raw).distinct(), "double", numbers), texts=["time"])
    df = impute_median(df, numbers)
    return df.withColumns({
        "time": times.time_of_day_or_null("time"),
        "duration": text.number_or_null("duration"),
        **{c: F.col(c).cast("bigint" if c == "milliseconds" else "int") for c in numbers},
    })


def qualifying(raw: DataFrame) -> DataFrame:
    """Missing lap times stay null."""
    df = strip_headers(raw).distinct()
    df = _cast(df, "int", ["qualifyId", "raceId", "driverId", "constructorId", "number", "position"])
    return df.withColumns({q: text.null_if_missing(q) for q in ("q1", "q2", "q3")})


def races(raw: DataFrame) -> DataFrame:
    df = fill_nulls(strip_headers(raw).distinct(), texts=["name", "url", "time"])
    df = _cast(_strip(df, ["name", "url", "time"]), "int", ["raceId", "year", "round", "circuitId"])
    return df.withColumn("date", times.date_or_null("date", "yyyy-MM-dd"))


def results(raw: DataFrame) -> DataFrame:
    zeroed = ["number", "position", "milliseconds", "fastestLap", "rank", "points"]
    whole = ["resultId", "raceId", "driverId", "constructorId", "number", "grid", "position", "positionOrder",
             "laps", "fastestLap", "rank", "statusId"]
    df = strip_headers(raw).distinct().withColumn("fastestLapSpeed", text.number_or_null("fastestLapSpeed"))
    df = fill_nulls(_cast(df, "double", zeroed), numbers=zeroed, texts=["time", "fastestLapTime"])
    df = impute_median(df, ["fastestLapSpeed"])
    return _cast(_cast(df, "int", whole), "long", ["milliseconds"])


def seasons(raw: DataFrame) -> DataFrame:
    return _cast(fill_nulls(strip_headers(raw).distinct(), texts=["url"]), "int", ["year"])


def status(raw: DataFrame) -> DataFrame:
    df = fill_nulls(strip_headers(raw).distinct(), texts=["status"])
    return _cast(df, "int", ["statusId"]).withColumn("status", text.title_case(text.strip("status")))


CLEANERS = {
    "circuits": circuits, "constructors": constructors, "constructor_results": constructor_results,
    "constructor_standings": constructor_standings, "driver_standings": driver_standings, "drivers": drivers,
    "lap_times": lap_times, "pit_stops": pit_stops, "qualifying": qualifying, "races": races,
    "results": results, "seasons": seasons, "status": status,
}


def clean_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: CLEANERS[name](df) for name, df in raw.items()}
