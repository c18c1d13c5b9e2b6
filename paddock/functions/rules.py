"""Domain rules as expressions: eras, retirement categories, points scales, flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paddock.functions.text import _col, strip, title_case

# First year, last year, name of each engine era.
ERAS = [
    (1900, 1994, "Pre-V10"),
    (1995, 2005, "V10"),
    (2006, 2013, "V8"),
    (2014, 2100, "Hybrid"),
]

# First season, last season, points by finishing position from 1.
POINTS = [
    (0, 1959, [8, 6, 4, 3, 2]),
    (1960, 1960, [8, 6, 4, 3, 2, 1]),
    (1961, 1990, [9, 6, 4, 3, 2, 1]),
    (1991, 2002, [10, 6, 4, 3, 2, 1]),
    (2003, 2009, [10, 8, 6, 5, 4, 3, 2, 1]),
    (2010, 9999, [25, 18, 15, 12, 10, 8, 6, 4, 2, 1]),
]
POINTS_2010_ALWAYS = [(0, 9999, [25, 18, 15, 12, 10, 8, 6, 4, 2, 1])]

# Status texts that mean a mechanical retirement.
MECHANICAL = [
    "Alternator", "Battery", "Brake Duct", "Brakes", "Broken Wing", "Clutch", "Crankshaft", "Cv Joint",
    "Differential", "Driveshaft", "Drivetrain", "Electrical", "Electronics", "Engine", "Engine Fire",
    "Engine Misfire", "Ers", "Exhaust", "Front Wing", "Fuel", "Fuel Leak", "Fuel Pressure", "Fuel Pump",
    "Fuel System", "Gearbox", "Halfshaft", "Handling", "Hydraulics", "Ignition", "Injection", "Mechanical",
    "Oil Leak", "Oil Line", "Oil Pressure", "Oil Pump", "Out Of Fuel", "Overheating", "Pneumatics",
    "Power Loss", "Power Unit", "Radiator", "Rear Wing", "Stalled", "Steering", "Suspension", "Technical",
    "Throttle", "Transmission", "Turbo", "Tyre", "Tyre Puncture", "Vibrations", "Water Leak", "Water Pump",
    "Wheel", "Wheel Bearing", "Wheel Nut", "Wheel Rim",
]
# The other published list of mechanical texts differs in these.
MECHANICAL_WIDE = sorted((set(MECHANICAL) - {"Fuel"}) | {"Distributor", "Fuel Rig"})

# Status texts that mean an accident.
ACCIDENT = [
    "Accident", "Collision", "Collision Damage", "Fatal Accident", "Fire", "Heat Shield Fire", "Safety",
    "Spun Off",
]

FINISHED_DNF, MECHANICAL_DNF, ACCIDENT_DNF, OTHER_DNF = "Finished", "Mechanical DNF", "Accident DNF", "Other DNF"

# Inclusive bounds in milliseconds.
PIT_MS = (2_000, 120_000)
RACING_LAP_MS = (60_000, 300_000)
LAP_FLAG_MS = (60_000, 600_000)


def bucket_label(value: Column | str, ranges: Sequence[tuple[int, int, str]] = ERAS, default: str = "Unknown") -> Column:
    """Name of the inclusive range that holds the value."""
    v, out = _col(value), F
    for low, high, name in ranges:
        out = out.when(v.between(low, high), F.lit(name))
    return out.otherwise(F.lit(default))


def bucket_order(label: Column | str, ranges: Sequence[tuple[int, int, str]] = ERAS) -> Column:
    """Chronological sort key of a range name: 1.., the last number for anything else."""
    names = [name for _, _, name in ranges]
    out = F
    for i, name in enumerate(names[:-1], 1):
        out = out.when(_col(label) == name, F.lit(i))
    return out.otherwise(F.lit(len(names)))


def retirement_category(
    status: Column | str, mechanical: Sequence[str] = MECHANICAL, accident: Sequence[str] = ACCIDENT, *,
    finished: Sequence[str] = ("Finished",), finished_prefixes: Sequence[str] = ("+",), titled: bool = True,
) -> Column:
    """Sort a status text into finished, mechanical, accident or other; null is other.

    `titled=False` compares codes as they are instead of in Title Case.
    """
    s = strip(status)
    t = title_case(s) if titled else s
    done = s.isin(*finished)
    for prefix in finished_prefixes:
        done = done | s.startswith(prefix)
    return (
        F.when(done, FINISHED_DNF)
        .when(t.isin(*mechanical), MECHANICAL_DNF)
        .when(t.isin(*accident), ACCIDENT_DNF)
        .otherwise(OTHER_DNF)
    )


def points_for(
    season: Column | str, position: Column | str, regimes: Sequence[tuple[int, int, Sequence[int]]] = POINTS
) -> Column:
    """Points of a finishing position under the scale of its season; 0 outside the scale."""
    year, index, out = _col(season), _col(position).cast("int") - 1, F
    for first, last, scale in regimes:
        points = F.array(*[F.lit(float(p)) for p in scale])
        out = out.when(year.between(first, last) & (index >= 0), F.get(points, index))
    return F.coalesce(out.otherwise(F.lit(0.0)), F.lit(0.0))


def points_table(spark: SparkSession, regimes: Sequence[tuple[int, int, Sequence[int]]] = POINTS) -> DataFrame:
    """The scales as a lookup table: first and last season, place, points."""
    rows = [(first, last, place, float(p)) for first, last, scale in regimes for place, p in enumerate(scale, 1)]
    return spark.createDataFrame(rows, "first_year int, last_year int, place int, points double")


def flag(predicate: Column) -> Column:
    """1 where true, 0 where false or unknown."""
    return F.coalesce(predicate.cast("int"), F.lit(0))


def within(value: Column | str, bounds: tuple[float, float]) -> Column:
    """Inclusive range test; an unknown value is outside."""
    return F.coalesce(_col(value).between(*bounds), F.lit(False))


def percent_of(part: Column | str, whole: Column | str) -> Column:
    """part / whole * 100 where whole is positive, else null."""
    return F.when(_col(whole) > 0, _col(part) / _col(whole) * 100)


def ratio(part: Column | str, whole: Column | str) -> Column:
    return F.try_divide(_col(part).cast("double"), _col(whole).cast("double"))


def lap_flag(ms: Column | str, bounds: tuple[float, float] = LAP_FLAG_MS) -> Column:
    return (
        F.when(_col(ms) < bounds[0], "suspiciously_fast")
        .when(_col(ms) > bounds[1], "slow_or_pitlap")
        .otherwise("normal")
    )


def stop_strategy(stops: Column | str) -> Column:
    n = _col(stops)
    return F.when(n == 1, "1-Stop").when(n == 2, "2-Stop").when(n == 3, "3-Stop").otherwise("4+ Stops")


def strategy_or_none(strategy: Column | str) -> Column:
    return F.coalesce(_col(strategy), F.lit("No Pit Data"))


def contender(position: Column | str) -> Column:
    """Label of the leading five of the championship."""
    return F.when(_col(position) <= 5, "Title Contender").otherwise("Non-Contender")


def decade(year: Column | str) -> Column:
    return (F.floor(_col(year) / 10) * 10).cast("int")


def clip(value: Column | str, low: float, high: float) -> Column:
    """Limit to [low, high]; null stays null."""
    v = _col(value)
    return F.when(v < low, F.lit(float(low))).when(v > high, F.lit(float(high))).otherwise(v)

