import datetime as dt

import pytest
from pyspark.sql import functions as F

from paddock.functions import rules, tails, text, times


def column(spark, values, expression, type_="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_strip_title_and_missing(spark):
    assert column(spark, ["  a b\t", None], text.strip) == ["a b", None]
    assert column(spark, ["great britain", "UK"], text.title_case) == ["Great Britain", "Uk"]
    assert column(spark, ["nan", "No Time", " ", "x ", None], text.null_if_missing) == [None, None, None, "x", None]


def test_code_and_name(spark):
    rows = spark.createDataFrame(
        [(" ham ", "Lewis", "Hamilton"), (None, "Juan", "Fangio"), ("  ", "A", "B"), (None, None, "Solo")],
        "code string, first string, last string",
    )
    got = rows.select(text.short_code("code", "last"), text.joined_name("first", "last")).collect()
    assert [tuple(r) for r in got] == [("HAM", "Lewis Hamilton"), ("FAN", "Juan Fangio"), ("B", "A B"), ("SOL", None)]


def test_numbers_in_text(spark):
    assert column(spark, ["12", " 1.5 ", "E", "nan", "", None], text.number_or_null) == [12.0, 1.5, None, None, None, None]
    assert column(spark, ["12", "R", "1.0", None], text.is_numeric_text) == [True, False, False, None]


def test_dates(spark):
    values = ["07/01/1985", "1896-12-28", "1/2/1990", "31/31/1990", "nan", None]
    expected = [dt.date(1985, 1, 7), dt.date(1896, 12, 28), dt.date(1990, 2, 1), None, None, None]
    assert column(spark, values, times.birth_date) == expected
    assert column(spark, ["23:59:59", "24:00:00", "1:02:03", None], times.time_of_day_or_null) == ["23:59:59", None, None, None]


def test_lap_times(spark):
    values = ["1:26.572", "59.5", "nan", "No Time", "a:b", "", None]
    got = column(spark, values, times.lap_time_ms)
    assert got[:2] == pytest.approx([86572.0, 59500.0])
    assert got[2:] == [None] * 5
    assert column(spark, ["1:26.572", "59.5", "x"], times.lap_time_whole_ms) == [86572, None, None]


def test_eras(spark):
    years = [1899, 1950, 1994, 1995, 2005, 2006, 2013, 2014, 2101, None]
    names = ["Unknown", "Pre-V10", "Pre-V10", "V10", "V10", "V8", "V8", "Hybrid", "Unknown", "Unknown"]
    assert column(spark, years, rules.bucket_label, "int") == names
    assert column(spark, ["Pre-V10", "V10", "V8", "Hybrid", "?"], rules.bucket_order) == [1, 2, 3, 4, 4]


def test_retirement_category(spark):
    values = ["Finished", "+1 Lap", " engine ", "Spun off", "Disqualified", "Fuel", "Fuel rig", "Finished late", None]
    exact = ["Finished", "Finished", "Mechanical DNF", "Accident DNF", "Other DNF", "Mechanical DNF", "Other DNF",
             "Other DNF", "Other DNF"]
    assert column(spark, values, rules.retirement_category) == exact
    wide = lambda c: rules.retirement_category(c, rules.MECHANICAL_WIDE, finished_prefixes=("+", "Finished"))
    assert column(spark, values, wide) == exact[:5] + ["Other DNF", "Mechanical DNF", "Finished", "Other DNF"]
    assert len(rules.MECHANICAL) == 58 and len(rules.MECHANICAL_WIDE) == 59 and len(rules.ACCIDENT) == 8


def test_points_scales(spark):
    rows = spark.createDataFrame(
        [(1955, 1), (1959, 6), (1960, 6), (1961, 1), (1990, 7), (1991, 1), (2003, 2), (2009, 8), (2010, 1), (2017, 10),
         (2017, 11), (2017, 0), (2017, None), (None, 1)], "y int, p int",
    )
    got = [r[0] for r in rows.select(rules.points_for("y", "p")).collect()]
    assert got == [8, 0, 1, 9, 0, 10, 8, 1, 25, 1, 0, 0, 0, 0]


def test_ranges_flags_and_labels(spark):
    assert column(spark, [1999, 2000, 120000, 120001, None], lambda c: rules.within(c, rules.PIT_MS), "int") == [
        False, True, True, False, False]
    assert column(spark, [59999, 60000, 600000, 600001, None], rules.lap_flag, "int") == [
        "suspiciously_fast", "normal", "normal", "slow_or_pitlap", "normal"]
    assert column(spark, [1, 2, 3, 4, None], rules.stop_strategy, "int") == [
        "1-Stop", "2-Stop", "3-Stop", "4+ Stops", "4+ Stops"]
    assert column(spark, [-9.0, 1.0, 9.0, None], lambda c: rules.clip(c, -3, 3), "double") == [-3.0, 1.0, 3.0, None]
    assert column(spark, [0, 2, None], lambda c: rules.percent_of(F.lit(1), c), "int") == [None, 50.0, None]


@pytest.mark.parametrize("rho, n, p", [
    (0.1838639248520369, 23777, 7.97003710812313e-180),
    (-0.024768834943672813, 2782, 0.19153990424884387),
])
def test_published_correlation_p_values(rho, n, p):
    t = rho * ((n - 2) / ((1 - rho) * (1 + rho))) ** 0.5
    assert tails.student_two_sided(t, n - 2) == pytest.approx(p, rel=1e-9)


def test_tails():
    assert tails.chi_squared_upper(0.9008402633254528, 3) == pytest.approx(0.8252250294157957, rel=1e-12)
    assert tails.chi_squared_upper(217.27509962215746, 1) == pytest.approx(3.5544e-49, rel=1e-4)
    assert tails.chi_squared_upper(0, 2) == 1
    assert tails.normal_upper(1.6448536269514722) == pytest.approx(0.05, rel=1e-12)
    assert tails.student_two_sided(2.2281388519649385, 10) == pytest.approx(0.05, rel=1e-10)
    assert tails.student_two_sided(0, 5) == pytest.approx(1)
    assert tails.p_value("t", None, 3) is None
