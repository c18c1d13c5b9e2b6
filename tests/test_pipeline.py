"""Raw files through every stage, checked against loops over the same rows."""

import datetime as dt
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import season_files
from paddock.functions.rules import POINTS
from paddock.operators import summaries as S
from paddock.plans import clean, dashboards, hypotheses, job, joined, metrics
from paddock.plans.catalog import round_doubles
from paddock.sources import tables as sources

MECH, ACC, OTHER = "Mechanical DNF", "Accident DNF", "Other DNF"


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("season")
    raw = base / "raw"
    raw.mkdir()
    facts = season_files.build(raw)
    cleaned = job.run_clean(spark, str(raw), str(base / "clean"))
    joins = job.run_joins(cleaned, str(base / "joins"))
    production = job.run_production(joins, str(base / "production"))
    return base, facts, cleaned, joins, production


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_cleaned_tables(run):
    _, facts, c, _, _ = run
    assert set(c) == set(clean.CLEANERS)
    assert sorted(rows(c["circuits"], "circuitId", "country", "circuitRef")) == [
        (1, "Brazil", "a"), (2, "United Kingdom", "b"), (3, "Italy", "c")]
    assert c["circuits"].columns == ["circuitId", "circuitRef", "name", "location", "country", "lat", "lng"]
    assert c["constructors"].columns == ["constructorId", "constructorRef", "name", "nationality"]
    assert rows(c["constructors"].where("constructorId = 1"), "name", "nationality") == [("Team 1", "Great British")]
    assert sorted(rows(c["constructor_results"], "points")) == [(3,), (14,)]
    assert sorted(rows(c["constructor_standings"], "positionText", "is_classified")) == [("1", True), ("E", False)]
    d = {r["driverId"]: r for r in c["drivers"].collect()}
    assert 8 not in d and len(d) == 7
    assert d[7]["dob"] == dt.date(1896, 12, 28) and d[3]["dob"] == dt.date(1960, 2, 3) and d[3]["birth_year"] == 1960
    assert (d[1]["code"], d[4]["code"], d[1]["number"], d[2]["number"]) == ("LAS", "D4", 0, 12)
    assert d[1]["full_name"] == "First1 Last1"
    assert c["lap_times"].count() == len(facts["laps"])
    assert dict(rows(c["lap_times"].groupBy("lap_flag").count(), "lap_flag", "count"))["suspiciously_fast"] > 0
    assert c["seasons"].count() == len(season_files.YEARS)
    assert ("+1 Lap",) in rows(c["status"], "status")
    assert {r["q2"] for r in c["qualifying"].collect() if r["position"] >= 6} == {None}
    r = c["results"]
    assert r.where("position is null or milliseconds is null or fastestLapSpeed is null").count() == 0
    speeds = sorted(x["fastestLapSpeed"] for x in facts["results"] if x["fastestLapSpeed"] != "")
    middle = (speeds[(len(speeds) - 1) // 2] + speeds[len(speeds) // 2]) / 2
    assert {x[0] for x in rows(r.where("positionOrder = 5"), "fastestLapSpeed")} == {middle}


def test_probes(run):
    _, _, c, _, _ = run
    assert {tuple(r) for r in S.count_violations(c["driver_standings"], clean.standings_probes()).collect()} == {
        ("position_below_1", 1), ("negative_wins", 1)}
    assert all(r["violations"] == 0 for r in S.count_violations(c["lap_times"], clean.lap_probes()).collect())
    assert all(r["violations"] == 0 for r in S.count_violations(c["circuits"], clean.circuit_probes()).collect())


def test_race_entries(run):
    _, facts, _, j, _ = run
    j1 = {r["resultId"]: r for r in j["J1_master_race_results"].collect()}
    assert len(j1) == len(facts["results"])
    names = {1: "Finished", 2: "Finished", 3: MECH, 4: ACC, 5: OTHER}
    for r in facts["results"]:
        got = j1[r["resultId"]]
        assert got["is_dnf"] == int(r["position"] == "")
        assert got["is_win"] == int(r["positionOrder"] == 1) and got["is_podium"] == int(r["positionOrder"] <= 3)
        assert got["grid_vs_finish"] == (None if r["grid"] == 0 else r["grid"] - r["positionOrder"])
        assert got["dnf_category"] == names[r["statusId"]]
        assert (got["full_name"] is None) == (r["driverId"] == 8)
    assert {r["era"] for r in j1.values()} == {"Pre-V10", "V10", "V8", "Hybrid"}
    assert j["J1_master_race_results"].columns.count("nationality_driver") == 1


def test_season_alpha(run):
    _, facts, _, j, _ = run
    groups = defaultdict(list)
    for r in facts["results"]:
        if r["driverId"] != 8:  # no name, so in no group
            groups[r["driverId"], r["year"], r["constructorId"]].append(r)
    ppr = {k: sum(r["points"] for r in g) / len(g) for k, g in groups.items()}
    teams = defaultdict(list)
    for (d, y, t), v in ppr.items():
        teams[t, y].append(v)
    alpha = {k: v - sum(teams[k[2], k[1]]) / len(teams[k[2], k[1]]) for k, v in ppr.items()}
    got = {(r["driverId"], r["year"], r["constructorId"]): r for r in j["J2_driver_alpha"].collect()}
    assert set(got) == set(ppr)
    for k, r in got.items():
        assert r["ppr"] == pytest.approx(ppr[k]) and r["driver_alpha"] == pytest.approx(alpha[k])
        mine = [v for kk, v in alpha.items() if kk[0] == k[0]]
        assert r["career_alpha"] == pytest.approx(sum(mine) / len(mine))
        assert r["total_races"] == sum(len(g) for kk, g in groups.items() if kk[0] == k[0])


def test_qualifying(run):
    _, facts, _, j, _ = run
    q1 = {}
    teams = defaultdict(list)
    for q in facts["qualifying"]:
        m, s = q[6].split(":")
        q1[q[0]] = (int(m) * 60 + float(s)) * 1000
        teams[q[1], q[3]].append(q1[q[0]])
    got = {r["qualifyId"]: r for r in j["J3_qualifying_analysis"].collect()}
    for q in facts["qualifying"]:
        mean = sum(teams[q[1], q[3]]) / len(teams[q[1], q[3]])
        r = got[q[0]]
        assert r["q1_vs_team_avg_ms"] == pytest.approx(q1[q[0]] - mean, abs=1e-6)
        assert r["reached_q3"] == int(q[5] == 1) and r["reached_q2"] == int(q[5] < 6)
        if q[5] == 1:
            assert r["best_qual_ms"] == 59250.0


def test_championship(run):
    _, facts, _, j, _ = run
    running, points = defaultdict(float), {}
    for r in sorted(facts["results"], key=lambda r: (r["year"], r["round"], r["resultId"])):
        running[r["year"], r["driverId"]] += r["points"]
        points[r["resultId"]] = running[r["year"], r["driverId"]]
    rounds = defaultdict(list)
    for r in facts["results"]:
        rounds[r["raceId"]].append(points[r["resultId"]])
    got = {r["resultId"]: r for r in j["J4_championship_progression"].collect()}
    for r in facts["results"]:
        mine, field = points[r["resultId"]], rounds[r["raceId"]]
        row = got[r["resultId"]]
        assert row["cumulative_points"] == mine
        assert row["championship_pos"] == 1 + sum(p > mine for p in field)
        assert row["gap_to_leader"] == max(field) - mine


def test_pit_strategy(run):
    _, facts, _, j, _ = run
    groups = defaultdict(list)
    for race, driver, stop, lap, _, _, ms in facts["pits"]:
        if 2000 <= ms <= 120000:
            groups[race, driver].append((stop, lap, ms))
    got = {(r["raceId"], r["driverId"]): r for r in j["J5_pit_strategy"].collect()}
    assert set(got) == set(groups)
    for k, g in groups.items():
        ms = sorted(x[2] for x in g)
        r = got[k]
        assert r["total_stops"] == max(x[0] for x in g)
        assert r["total_pit_sec"] == pytest.approx(sum(ms) / 1000)
        assert r["median_pit_ms"] == (ms[(len(ms) - 1) // 2] + ms[len(ms) // 2]) / 2
        assert r["strategy"] == {1: "1-Stop", 2: "2-Stop", 3: "3-Stop"}.get(r["total_stops"], "4+ Stops")
        assert r["constructor_name"] is not None and r["first_pit_lap"] == min(x[1] for x in g)


def test_lap_by_lap(run):
    _, facts, _, j, _ = run
    position = {(r, d, lap): p for r, d, lap, p, _, _ in facts["laps"]}
    pit = {(r, d, lap): ms for r, d, _, lap, _, _, ms in facts["pits"] if ms <= 120000}
    got = {(r["raceId"], r["driverId"], r["lap"]): r for r in j["J6_lap_by_lap"].collect()}
    assert set(got) == set(position)
    for k, r in got.items():
        before = position.get((k[0], k[1], k[2] - 1))
        assert r["prev_position"] == before
        assert r["position_change"] == (None if before is None else before - position[k])
        assert r["pit_stop_lap"] == (k in pit) and r["pit_duration_ms"] == pit.get(k)


def scale(year, place):
    points = next(s for a, b, s in POINTS if a <= year <= b)
    return float(points[place - 1]) if place <= len(points) else 0.0


def test_reliability(run):
    _, facts, _, j, _ = run
    most = defaultdict(int)
    for r in facts["results"]:
        most[r["raceId"]] = max(most[r["raceId"]], r["laps"])
    got = {r["resultId"]: r for r in j["J7_reliability_dnf"].collect()}
    for r in facts["results"]:
        row = got[r["resultId"]]
        assert row["laps_pct_completed"] == pytest.approx(r["laps"] / most[r["raceId"]] * 100)
        assert row["potential_points_lost"] == (scale(r["year"], r["positionOrder"]) if r["position"] == "" else 0.0)
    seasons = defaultdict(list)
    for r in facts["results"]:
        seasons[r["constructorId"], r["year"]].append(r["position"] == "")
    index = {k: 1 - sum(v) / len(v) for k, v in seasons.items()}
    teams = {(r["constructorId"], r["year"]): r for r in j["J8_constructor_reliability"].collect()}
    assert set(teams) == set(index)
    for (t, y), r in teams.items():
        years = sorted(yy for tt, yy in index if tt == t and yy <= y)[-3:]
        assert r["reliability_index"] == pytest.approx(index[t, y])
        assert r["rolling3_reliability"] == pytest.approx(sum(index[t, yy] for yy in years) / len(years))
        assert r["entries"] == len(seasons[t, y])
        era = [x for (tt, yy), v in seasons.items() if tt == t and (yy <= 1994) == (y <= 1994)
               and (y <= 1994 or yy == y) for x in v]
        assert r["era_reliability"] == pytest.approx(1 - sum(era) / len(era))


def test_dashboards(run):
    _, facts, _, j, p = run
    assert set(p) == set(dashboards.REQUIRED)
    assert all(g["missing"] == [] for g in dashboards.gate(p).values())
    assert p["MASTER_tableau_ready"].count() == len(facts["results"])
    assert p["DB2_lap_by_lap"].where("LapTimeSec < 60").count() == 0
    row = p["DB2_pit_strategy"].first()
    assert row["FirstStopPct"] == pytest.approx(row["FirstPitLap"] / row["TotalLaps"] * 100)
    circuits = {r["circuitId"]: r for r in p["DB4_circuit_map"].collect()}
    assert set(circuits) == {1, 2} and circuits[1]["TotalRaces"] == 10 and circuits[1]["FirstYear"] == 1959
    assert circuits[1]["circuit_name"] == "Autódromo A" and circuits[2]["AvgPointsWinner"] == 9.0
    career = {r["driverId"]: r for r in p["DB1_driver_career_summary"].collect()}
    assert 8 not in career and career[1]["QualWinPct"] is None
    assert career[1]["TotalRaces"] == sum(r["driverId"] == 1 for r in facts["results"])
    linked = dashboards.entries_with_team(p["DB3_reliability_dnf"], p["DB3_constructor_reliability"])
    assert linked.count() == len(facts["results"]) and "Rolling3Reliability" in linked.columns
    linked = dashboards.season_with_career(p["DB1_driver_alpha_season"], p["DB1_driver_career_summary"])
    assert linked.count() == j["J2_driver_alpha"].count() and "PodiumRate" in linked.columns
    wide = dashboards.wide_master(j)
    assert wide.count() == len(facts["results"])
    assert {"rolling3_reliability", "strategy", "win_rate"} <= set(wide.columns)


def test_status_variant(run, spark):
    base, facts, c, _, _ = run
    t = joined.enrich(c, joined.STATUS_VARIANT)
    assert t["results"].where("dnf <> (statusId >= 3)").count() == 0
    assert t["results"].where("is_dnf <> cast(dnf as int) or finished_flag = dnf").count() == 0
    j = joined.build_all(t, joined.STATUS_VARIANT)
    stops = {(r, d, lap) for r, d, _, lap, _, _, _ in facts["pits"]}
    assert j["J6_lap_by_lap"].where("pit_stop_lap").count() == len(stops)
    lost = rows(j["J7_reliability_dnf"].where("is_dnf = 1 and year = 1959"), "positionOrder", "potential_points_lost")
    assert all(p == scale(2015, o) for o, p in lost)
    last = dashboards.master(j, joined.STATUS_VARIANT)
    assert last.count() == len(facts["results"])


def test_hypotheses(run):
    _, _, _, j, _ = run
    log = {r["hypothesis_id"]: r for r in hypotheses.hypothesis_log(j).collect()}
    assert list(log) == ["H1", "H2", "H3", "H4", "H5", "H6", "H8", "H9", "H10"]
    assert all(r["p_value"] is None or 0 <= r["p_value"] <= 1 for r in log.values())
    assert abs(log["H3"]["statistic"]) < 1e-6  # alpha sums to zero within each team season
    assert log["H9"]["verdict"] == "insufficient data"  # none of the named teams takes part
    assert "H4" in hypotheses.run_tests(j, poles_only=True)
    terms = {n: [r["term"] for r in df.collect()] for n, df in hypotheses.regressions(j).items()}
    assert terms == {"grid": ["const", "grid"], "grid_era": ["const", "grid", "era_code"],
                     "pit": ["const", "first_pit_lap", "total_stops"]}
    open_questions = {n: df.first() for n, df in hypotheses.proposed(j).items()}
    assert open_questions["gap_points"]["n"] == 8 and open_questions["carry_over"]["n"] == 15
    assert open_questions["mechanical_by_decade"]["entries"] > 0
    assert hypotheses.pit_duration_bins(j["J5_pit_strategy"]).count() == 9
    assert hypotheses.kpi_by_era(j["J8_constructor_reliability"]).count() == 4
    assert hypotheses.reliability_pivot(j["J8_constructor_reliability"]).columns == [
        "constructor_name", "Pre-V10", "V10", "V8", "Hybrid"]


def test_job_stages(run, spark, tmp_path):
    base, facts, _, _, _ = run
    source = tmp_path / "clean"
    folders = [str(tmp_path / n) for n in ("joins", "production", "reports")]
    listing = {r["table_name"]: r["rows"] for r in job.run(spark, "all", str(source), *folders, raw_dir=str(base / "raw")).collect()}
    assert listing["J1_master_race_results"] == len(facts["results"]) and len(listing) == 17
    again = job.run(spark, "production", str(source), *folders[:2])
    assert {r["table_name"]: r["rows"] for r in again.collect()} == listing
    report = sources.read_csv(spark, f"{folders[2]}/hypothesis_testing_results")
    assert report.count() == 9
    with pytest.raises(ValueError):
        job.run(spark, "nothing", "", "", "")


def test_probes_and_letters(run):
    _, _, c, _, _ = run
    assert "Autódromo A" in [r["name"] for r in c["circuits"].collect()]
    found = {(r["table_name"], r["rule"]): r["violations"] for r in job.probe(c).collect()}
    assert found[("driver_standings", "negative_wins")] == 1 and found[("circuits", "lat_out_of_range")] == 0


def test_whole_numbers_stay_exact(spark):
    df = spark.createDataFrame([("9007199254740993",), ("12.7",), (None,)], "x string")
    assert [r["x"] for r in clean._cast(df, "bigint", ["x"]).collect()] == [9007199254740993, 12, None]


def test_rows_without_season_keep_their_place(spark):
    rows = [(1, 1, 5, 10.0, 1), (1, 2, 5, 4.0, 0), (1, 1, 6, 12.0, 0), (1, 2, 6, None, 0), (None, 1, 5, 3.0, 0)]
    df = spark.createDataFrame(rows, "year int, round int, driverId int, points double, is_win int")
    found = {(r["year"], r["round"], r["driverId"]): (r["cumulative_points"], r["championship_pos"], r["gap_to_leader"])
             for r in metrics.standings(df).collect()}
    assert found == {(1, 1, 5): (10.0, 2, 2.0), (1, 2, 5): (14.0, 1, 0.0), (1, 1, 6): (12.0, 1, 0.0), (1, 2, 6): (12.0, 2, 2.0),
                     (None, 1, 5): (None, None, None)}


def test_large_doubles_are_not_cut(spark):
    df = spark.createDataFrame([(1e13,), (1e15 + 0.5,), (1.23456789,), (-2.5e12,)], "x double")
    assert [r["x"] for r in round_doubles(df).collect()] == [1e13, 1e15 + 0.5, 1.234568, -2.5e12]


def test_file_lookup(spark, tmp_path):
    (tmp_path / "Cleaned Status.csv").write_text("statusId,status\n1,Finished\n")
    assert sources.load_table(spark, str(tmp_path), "status").dtypes == [("statusId", "int"), ("status", "string")]
    with pytest.raises(FileNotFoundError, match="Cleaned_Races.csv"):
        sources.load_table(spark, str(tmp_path), "races")
    with pytest.raises(FileNotFoundError, match="not recognised .'cleaned_status'"):
        sources.load_raw(spark, str(tmp_path), ["status"])
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "lapTimes.csv").write_text("raceId\n1\n")
    with pytest.raises(FileNotFoundError, match="absent .'status'"):
        sources.load_raw(spark, str(tmp_path / "raw"), ["status", "lap_times"])
    assert set(sources.load_raw(spark, str(tmp_path / "raw"), ["status", "lap_times"], partial=True)) == {"lap_times"}
    assert ("status", "statusId", "int") in S.schema_rows({"status": sources.load_table(spark, str(tmp_path), "status")})


def test_wrongly_encoded_read_is_opt_in(spark, tmp_path):
    (tmp_path / "circuits.csv").write_text("circuitId,name\n1,Autódromo\n", encoding="utf-8")
    name = lambda **kw: sources.load_table(spark, str(tmp_path), "circuits", **kw).first()["name"]
    assert name() == "Autódromo"
    assert name(encoding="ISO-8859-1") == "AutÃ³dromo"


def test_repeated_dimension_key_fails_the_join(run):
    _, _, c, _, _ = run
    t = joined.enrich(c)
    t["races"] = t["races"].unionByName(t["races"].limit(1))
    with pytest.raises(ValueError, match="races"):
        joined.master_results(t)


def test_expected_null_count(run, spark):
    base, _, _, _, _ = run
    raw = sources.load_raw(spark, str(base / "raw"), clean.CLEANERS)["drivers"]
    from paddock.functions.times import birth_date

    assert raw.select(F.count_if(birth_date("dob").isNull())).first()[0] == 1
