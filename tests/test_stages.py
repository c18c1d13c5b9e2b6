"""Rules measured while writing, restart, seasons replaced one by one, lookups by range, stored buckets, comparison of tables."""

import csv
import os
import shutil

import pytest
from pyspark.sql import functions as F

import season_files
from paddock.functions.rules import POINTS, points_for, points_table
from paddock.operators import checks, compare, intervals
from paddock.operators.joins import JoinAddsRows
from paddock.plans import clean, dashboards, job, joined, metrics
from paddock.sources import marks, tables as sources


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("stages")
    (base / "raw").mkdir()
    facts = season_files.build(base / "raw")
    cleaned = job.run_clean(spark, str(base / "raw"), str(base / "clean"))
    return base, facts, cleaned, job.run_joins(cleaned, str(base / "joins"))


def files(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_rules_are_measured_by_the_write(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None)], "x int, y string")
    rules = [checks.at_most("small", F.col("x") < 3, 1), checks.expected_nulls("y", 2), checks.expected_nulls("z", 0), *checks.null_shares(["x", "y"])]
    watch = checks.Watch("t", df, rules, ["x", "w"])
    watch.df.write.parquet(str(tmp_path / "t"))
    found = {f.rule: (f.found, f.broken) for f in watch.findings()}
    assert found == {"w_missing": (1, True), "small": (2, True), "y_nulls": (2, False), "x_mostly_null": (0, False),
                     "y_mostly_null": (pytest.approx(2 / 3), True)}
    assert watch.rows == 3 and spark.read.parquet(str(tmp_path / "t")).columns == ["x", "y"]
    assert checks.as_table(spark, watch.findings()).where("broken").count() == 3
    empty = checks.Watch("e", df.where("x > 9"), rules)
    empty.df.write.parquet(str(tmp_path / "e"))
    assert {f.rule for f in empty.findings() if f.broken} == {"y_nulls"}


def test_join_that_adds_rows_fails_the_stage(spark, made, tmp_path):
    base, facts, cleaned, _ = made
    kept = checks.RowsKept("j", spark.range(10), lambda left: left.join(spark.range(5).withColumn("y", F.lit(1)), "id", "left"))
    kept.df.write.parquet(str(tmp_path / "kept"))
    assert kept.require() == 10
    twice = checks.RowsKept("j", spark.range(10), lambda left: left.join(spark.range(3).unionAll(spark.range(3)), "id", "left"))
    twice.df.write.parquet(str(tmp_path / "twice"))
    with pytest.raises(JoinAddsRows, match="10 rows before its joins, 13 behind"):
        twice.require()

    def broken(left):
        return left.join(cleaned["races"].select("raceId").unionAll(cleaned["races"].select("raceId")), "raceId", "left")

    folder = job.Folder(spark, str(tmp_path / "stage"), "s")
    with pytest.raises(JoinAddsRows):
        folder.step("J", lambda: checks.RowsKept("J", cleaned["results"], broken))
    assert folder.marks.read("J", "s") is None


def test_run_reports_findings(spark, made, tmp_path):
    base, facts, _, _ = made
    raw = tmp_path / "raw"
    shutil.copytree(base / "raw", raw)
    rows = list(csv.reader(open(raw / "drivers.csv", newline="", encoding="latin-1")))
    rows[1][6] = ""
    with open(raw / "drivers.csv", "w", newline="", encoding="latin-1") as f:
        csv.writer(f).writerows(rows)
    folders = [str(tmp_path / n) for n in ("clean", "joins", "production", "reports")]
    done = job.run_checked(spark, "all", *folders, raw_dir=str(raw))
    broken = {(f.table_name, f.rule): f.found for f in done.broken}
    assert broken["raw drivers", "dob_unreadable"] == 2 and broken["driver_standings", "negative_wins"] == 1
    assert ("MASTER_tableau_ready", "q1_ms_mostly_null") not in broken or broken["MASTER_tableau_ready", "q1_ms_mostly_null"] > 0.3
    assert all(not f.rule.endswith("_missing") for f in done.broken)
    assert done.as_table().where("table_name = 'lap_times' AND rule = 'time_text_differs' AND NOT broken").count() == 1
    listing = {r["table_name"]: r["broken_rules"] for r in job.run(spark, "production", *folders[:3]).collect()}
    assert any(rule.endswith("_mostly_null") for rule in listing["DB3_reliability_dnf"] + listing["MASTER_tableau_ready"] + listing["DB2_pit_strategy"])
    reports = {p.name for p in (tmp_path / "reports").iterdir()}
    assert {"regression_terms", "pit_duration_bins", "reliability_pivot", "open_questions", "mechanical_by_decade", "rank_carry_over"} <= reports
    terms = sources.read_csv(spark, f"{folders[3]}/regression_terms").collect()
    assert [(r["model"], r["term"]) for r in terms] == [("grid", "const"), ("grid", "grid"), ("grid_era", "const"), ("grid_era", "grid"),
                                                       ("grid_era", "era_code"), ("pit", "const"), ("pit", "first_pit_lap"), ("pit", "total_stops")]
    assert sources.read_csv(spark, f"{folders[3]}/pit_duration_bins").count() == 9
    assert sources.read_csv(spark, f"{folders[3]}/open_questions").count() == 2
    wide = spark.read.parquet(f"{folders[2]}/MASTER_wide")
    assert wide.count() == len(facts["results"]) and len(wide.columns) == len(set(wide.columns)) >= 70


def test_wide_master_needs_unique_keys(made):
    _, _, _, j = made
    with pytest.raises(JoinAddsRows, match="J5"):
        dashboards.wide_master(j | {"J5_pit_strategy": j["J5_pit_strategy"].unionAll(j["J5_pit_strategy"])})


def test_broken_run_goes_on_where_it_stopped(spark, made, tmp_path, monkeypatch):
    base, facts, _, _ = made
    folders = [str(tmp_path / n) for n in ("clean", "joins", "production")]

    def broken(*_):
        raise RuntimeError("power cut")

    with monkeypatch.context() as m:
        m.setattr(joined, "pit_strategy", broken)
        with pytest.raises(RuntimeError):
            job.run(spark, "all", *folders, raw_dir=str(base / "raw"))
    first = files(tmp_path)
    assert any(n.startswith("joins/J1") for n in first) and not any(n.startswith("joins/J5") for n in first)
    done = job.run_checked(spark, "all", *folders, raw_dir=str(base / "raw"), resume=True)
    second = files(tmp_path)
    assert {n: t for n, t in second.items() if n in first} == first  # nothing that was done is written again
    assert {r["table_name"] for r in done.inventory.collect()} >= set(job.JOINED)
    assert any(f.rule == "negative_wins" and f.broken for f in done.findings)  # remembered, not measured again
    job.run(spark, "all", *folders, raw_dir=str(base / "raw"), resume=True)
    assert files(tmp_path) == second
    os.utime(base / "raw" / "status.csv", (1, 1))  # another file: everything that follows is built anew
    job.run(spark, "all", *folders, raw_dir=str(base / "raw"), resume=True)
    assert not set(files(tmp_path)) & set(second)


def test_marks(spark, tmp_path):
    m = marks.Marks(spark, str(tmp_path))
    assert m.read("a", "x") is None
    m.write("a", "x", [["ü", 1]])
    assert m.read("a", "x") == [["ü", 1]] and m.read("a", "y") is None
    m.clear("a")
    assert m.read("a", "x") is None


def test_one_season_is_replaced(spark, made, tmp_path):
    base, facts, cleaned, _ = made
    shutil.copytree(base / "joins", tmp_path / "joins")
    before = files(tmp_path / "joins")
    year = 1994
    better = cleaned["results"].join(cleaned["races"].where(F.col("year") == year).select("raceId", F.lit(True).alias("hit")), "raceId", "left")
    better = better.withColumn("points", F.when(F.col("hit"), F.col("points") + 100).otherwise(F.col("points"))).drop("hit")
    job.refresh_season(cleaned | {"results": better.select(*cleaned["results"].columns)}, str(tmp_path / "joins"), year)
    after = files(tmp_path / "joins")
    for name in ("J1_master_race_results", "J3_qualifying_analysis", "J4_championship_progression", "J7_reliability_dnf"):
        others = {n: t for n, t in before.items() if n.startswith(name) and f"year={year}" not in n}
        assert others and {n: t for n, t in after.items() if n in others} == others
        assert not {n for n in before if n.startswith(name) and f"year={year}" in n} & set(after)
    whole = job.run_joins(cleaned | {"results": better.select(*cleaned["results"].columns)}, str(tmp_path / "whole"))
    for name in job.JOINED:
        stored = spark.read.parquet(f"{tmp_path}/joins/{name}").select(*whole[name].columns)
        assert stored.exceptAll(whole[name]).count() == whole[name].exceptAll(stored).count() == 0, name


def test_points_from_a_table(spark):
    cases = [(y, p, d) for y in (None, 1949, 1950, 1959, 1960, 1990, 1991, 2003, 2009, 2010, 2030) for p in (None, 0, 1, 5, 6, 10, 11) for d in (0, 1, None)]
    df = spark.createDataFrame(cases, "year int, positionOrder int, is_dnf int")
    found = metrics.with_points_lost(df, points_table(spark)).withColumn(
        "expected", F.when(F.col("is_dnf") == 1, points_for("year", "positionOrder", POINTS)).otherwise(0.0))
    assert found.count() == len(cases) and found.where("NOT potential_points_lost <=> expected").count() == 0
    wrong = points_table(spark, [(1950, 1960, [8, 6]), (1960, 1970, [9])])
    with pytest.raises(intervals.OverlappingRanges):
        metrics.with_points_lost(df, wrong)
    for rows in ([(1, 9), (2, 3), (5, 6)], [(4, 3)], [(None, 3)]):
        with pytest.raises(intervals.OverlappingRanges):
            intervals.require_disjoint(spark.createDataFrame(rows, "a int, b int"), [], "a", "b")
    names = spark.createDataFrame([(1, 3, "low"), (4, 9, "high")], "a int, b int, name string")
    got = intervals.attach_by_range(spark.createDataFrame([(0,), (1,), (3,), (4,), (None,)], "x int"), names, "x", "a", "b", ["name"])
    assert {r["x"]: r["name"] for r in got.collect()} == {0: None, 1: "low", 3: "low", 4: "high", None: None}


def test_laps_in_buckets_are_not_shuffled(spark, made, tmp_path):
    base, facts, cleaned, j = made
    t = joined.enrich(cleaned)
    lap = sources.save_bucketed(t["lap_times"], "stored_laps", str(tmp_path / "laps"), joined.LAP_KEYS, ["lap"], 8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as it is made
    try:
        query = joined.lap_by_lap(t | {"lap_times": lap})
        plan = query._jdf.queryExecution().executedPlan()
        # Walk down: every exchange must lie above something else than the scan of the laps.
        text = plan.toString().split("\n")
        scans = [k for k, line in enumerate(text) if "FileScan" in line and "stored_laps" in line and "isnotnull(raceId" in line]
        assert scans
        for k in scans:
            depth, above = len(text[k]) - len(text[k].lstrip(" :+-")), []
            for line in reversed(text[:k]):
                d = len(line) - len(line.lstrip(" :+-"))
                if d < depth:
                    above.append(line)
                    depth = d
            assert not any("Exchange hashpartitioning" in line for line in above), above
        assert query.count() == j["J6_lap_by_lap"].count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    columns = j["J6_lap_by_lap"].columns
    assert query.select(*columns).exceptAll(j["J6_lap_by_lap"]).count() == 0
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in t["lap_times"].schema.fields)
    again = sources.open_bucketed(spark, "stored_laps_again", str(tmp_path / "laps"), ddl, joined.LAP_KEYS, ["lap"], 8)
    assert again.exceptAll(lap).count() == 0 and again.count() == lap.count()
    spark.sql("DROP TABLE stored_laps")
    spark.sql("DROP TABLE stored_laps_again")


def test_laps_without_race_or_driver(spark, made):
    _, _, cleaned, _ = made
    t = joined.enrich(cleaned)
    odd = t["lap_times"].limit(2).withColumn("driverId", F.lit(None).cast("int")).unionAll(t["lap_times"].limit(1).withColumn("raceId", F.lit(None).cast("int")))
    got = joined.lap_by_lap(t | {"lap_times": t["lap_times"].unionAll(odd)})
    assert got.count() == joined.lap_by_lap(t).count() + 3
    assert got.where("driverId IS NULL AND year IS NOT NULL AND full_name IS NULL AND NOT pit_stop_lap").count() == 2
    assert got.where("raceId IS NULL AND year IS NULL AND full_name IS NOT NULL").count() == 1


def test_table_differences(spark):
    schema = "k int, n string, v double, w long, d date"
    old = spark.createDataFrame([(1, "a", 1.0, 9007199254740993, None), (2, "b", 2.0, 1, None), (None, "c", None, 2, None), (4, "d", 1e9, 3, None)], schema)
    new = spark.createDataFrame([(1, "a", 1.0 + 1e-12, 9007199254740992, None), (None, "x", 3.0, 2, None), (5, "e", 0.0, 0, None), (4, "d", 1e9 + 1, 3, None)], schema)
    got = {tuple(r) for r in compare.table_diff(old, new, ["k"]).collect()}
    assert got == {(1, "changed", "w", "9007199254740993", "9007199254740992"), (2, "missing", None, None, None), (5, "added", None, None, None),
                   (None, "changed", "n", "c", "x"), (None, "changed", "v", None, "3.0")}
    assert compare.table_diff(old, new, ["k"], tolerance=1e-15).where("column = 'v'").count() == 3
    assert compare.table_diff(old, old, ["k"]).count() == compare.table_diff(old, old.select("k"), ["k"]).count() == 0
    assert compare.table_diff(old, new.drop("n"), ["k"], columns=["n"]).where("kind = 'changed'").count() == 3
    with pytest.raises(JoinAddsRows):
        compare.table_diff(old, new.unionAll(new), ["k"])


GOLDEN = os.environ.get("PADDOCK_GOLDEN_DIR")  # a folder with raw and published cleaned files


@pytest.mark.skipif(not GOLDEN, reason="no published files")
@pytest.mark.parametrize("table, key", [("constructors", "constructorId"), ("seasons", "year"), ("status", "statusId")])
def test_published_cleaned_files(spark, table, key):
    raw = sources.load_raw(spark, f"{GOLDEN}/raw", clean.CLEANERS, partial=True)[table]
    published = sources.load_table(spark, f"{GOLDEN}/processed", table)
    assert compare.table_diff(published, clean.CLEANERS[table](raw), [key]).collect() == []
