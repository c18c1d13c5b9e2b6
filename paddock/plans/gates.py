"""The rules that tables must keep, by table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paddock.functions import times
from paddock.operators.checks import Rule, at_most, expected_nulls, null_shares
from paddock.plans import clean
from paddock.plans.dashboards import REQUIRED

MOSTLY_NULL = 0.3  # share of nulls from which an output column is reported
BIRTH_DATES_MISSING = 1  # drivers whose date of birth is known to be unreadable


def raw_rules(name: str) -> list[Rule]:
    """Rules on raw text, before cleaning leaves rows out."""
    if name != "drivers":
        return []
    unreadable = F.count_if(times.birth_date("dob").isNull())
    return [Rule("dob_unreadable", unreadable, BIRTH_DATES_MISSING, BIRTH_DATES_MISSING, columns=("dob",))]


def cleaned_rules(name: str) -> list[Rule]:
    """Ranges, tolerances and null counts of the cleaned tables."""
    probes = {
        "circuits": clean.circuit_probes, "lap_times": clean.lap_probes, "driver_standings": clean.standings_probes,
        "constructor_standings": clean.standings_probes,
    }
    found = [at_most(rule, breaks) for rule, breaks in probes[name]().items()] if name in probes else []
    keys = {
        "circuits": ["circuitId"], "constructors": ["constructorId"], "drivers": ["driverId", "dob"], "races": ["raceId", "year"],
        "results": ["resultId", "raceId", "driverId"], "lap_times": ["raceId", "driverId", "lap"], "status": ["statusId"],
    }
    return found + [expected_nulls(c, 0) for c in keys.get(name, [])]


def output_rules(df: DataFrame) -> list[Rule]:
    return null_shares(df.columns, MOSTLY_NULL)


def required(name: str) -> list[str]:
    return REQUIRED.get(name, [])
