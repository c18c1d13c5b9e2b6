"""Quantiles by narrowing, balanced buckets, neighbours across borders, and NaN as no value."""

import math
import random

import pytest
from pyspark.sql import functions as F

from paddock.operators import groups, hypotheses, keys, ordered, selection, summaries

NAN, INF = float("nan"), float("inf")
ODD = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1e-300, 1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0), 2.0,
       math.nextafter(2.0, 0), 4.0, 8.0, 1e15, 1e15 + 0.125, -1.0, -3.5, 1.7976931348623157e308, -1.7976931348623157e308, INF, -INF]


def interpolated(values, p):
    values = sorted(v for v in values if v is not None and not math.isnan(v))
    at = (len(values) - 1) * p
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low + (high - low) * (at - math.floor(at)) if low != high else low


def near_values(n, seed=5):
    """Distinct values that differ by less than a thousandth of a thousandth."""
    rng = random.Random(seed)
    return [1e9 + 1e5 * rng.random() for _ in range(n)]


def test_cells_never_fall(spark):
    rng = random.Random(2)
    values = ODD + [rng.choice([-1, 1]) * 2.0 ** rng.randint(-1060, 1000) * (1 + rng.random() * rng.choice([1, 1e-9])) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    v = F.col("v")
    rows = df.select(v, keys.coarse_cell(v).alias("c"), keys.fine_cell(v).alias("f"), keys.balanced_bucket(df, "v", 8).alias("b")).collect()
    rows.sort(key=lambda r: (r["v"], r["c"], r["f"]))
    for a, b in zip(rows, rows[1:]):
        assert (a["c"], a["f"]) <= (b["c"], b["f"]) and a["b"] <= b["b"]
    exact = {}
    for r in rows:  # some 20 bits are left within a fine cell
        if abs(r["v"]) > 1e-300 and not math.isinf(r["v"]):
            size = math.frexp(abs(r["v"]))[1]
            low = exact.setdefault((r["c"], r["f"]), r["v"])
            assert abs(r["v"] - low) <= 2.0 ** (size - 1 - 31)


@pytest.mark.parametrize("shape", ["near", "spread", "ties", "odd"])
def test_quantiles_of_all_kinds(spark, shape):
    rng = random.Random(9)
    values = {"near": near_values(20_000), "spread": [rng.lognormvariate(0, 9) * rng.choice([-1, 1]) for _ in range(20_000)],
              "ties": [float(rng.randint(0, 9)) for _ in range(20_000)],
              "odd": [*ODD[:-2], None, NAN, NAN]}[shape]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "k int, v double").repartition(7)
    wanted = {f"q{int(p * 1000)}": ("v", p) for p in (0.0, 0.001, 0.25, 0.5, 0.9, 1.0)}
    whole = groups.exact_quantiles(df, [], {"n": F.count("v")}, wanted).collect()
    assert len(whole) == 1 and all(whole[0][n] == interpolated(values, p) for n, (_, p) in wanted.items())
    for bounded in (False, True):
        for r in groups.exact_quantiles(df, ["k"], {}, wanted, bounded=bounded).collect():
            mine = [v for i, v in enumerate(values) if i % 3 == r["k"]]
            assert all(r[n] == pytest.approx(interpolated(mine, p), rel=1e-15) for n, (_, p) in wanted.items())


def test_quantiles_need_no_window_and_shuffle_cells_only(spark):
    df = spark.createDataFrame([(v,) for v in near_values(50_000)], "v double").repartition(6)
    query = groups.exact_quantiles(df, [], {}, {"mid": ("v", 0.5)})
    query.collect()
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    folded = selection._folded(selection.long_values(df, [], ["v"]), [selection.COLUMN], False)
    assert folded.select(F.size("__cells")).first()[0] < 10  # all values lie in a few coarse cells


def test_groups_without_values_keep_their_row(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (2, NAN), (None, 5.0)], "k int, v double")
    for bounded in (False, True):
        got = {r["k"]: (r["n"], r["m"]) for r in groups.exact_quantiles(df, ["k"], {"n": F.count(F.lit(1))}, {"m": ("v", 0.5)}, bounded=bounded).collect()}
        assert got == {1: (1, 2.0), 2: (2, None)}
    empty = groups.exact_quantiles(df.limit(0), [], {"n": F.count("v")}, {"m": ("v", 0.5)}).collect()
    assert len(empty) <= 1 and all(r["m"] is None for r in empty)


def test_profile_merges_cells(spark):
    rng = random.Random(4)
    values = [1e8 + rng.random() for _ in range(3000)]
    df = spark.createDataFrame([(v, float(i % 4), None, NAN) for i, v in enumerate(values)], "a double, b double, c double, d double")
    got = {r["column_name"]: r for r in summaries.describe_numbers(df, ["a", "b", "c", "d"]).collect()}
    mean = math.fsum(values) / len(values)
    std = math.sqrt(math.fsum((v - mean) ** 2 for v in values) / (len(values) - 1))
    a = got["a"]
    assert a["mean"] == pytest.approx(mean, rel=1e-14) and a["std"] == pytest.approx(std, rel=1e-6)
    assert (a["count"], a["min"], a["max"], a["q50"]) == (3000, min(values), max(values), interpolated(values, 0.5))
    assert (got["b"]["q25"], got["b"]["q75"], got["b"]["max"]) == (0.75, 2.25, 3.0)
    assert got["c"]["count"] == got["d"]["count"] == 0 and got["c"]["mean"] is None and got["d"]["q50"] is None


def test_near_values_are_dealt_evenly(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    df = spark.range(1_000_000).select((F.lit(1e9) + F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1e9 * 1e5).alias("v"))
    sizes = [r["count"] for r in df.groupBy(keys.balanced_bucket(df, "v", 32).alias("b")).count().collect()]
    assert sum(sizes) == 1_000_000 and max(sizes) < 2 * 1_000_000 / 32 and len(sizes) >= 30


def test_ranks_of_near_values(spark):
    values = near_values(4000) + near_values(500)  # the second ones tie with the first
    df = spark.createDataFrame([(v, -v, 1.0) for v in values], "x double, y double, w double").repartition(3)
    order = sorted(set(values))
    place, ranks = 0, {}
    for v in order:
        n = values.count(v) if v in values[4000:] else 1
        ranks[v] = place + (n + 1) / 2
        place += n
    got = {r["x"]: r["avg_rank"] for r in groups.value_ranks(df, "x").collect()}
    assert got == ranks
    assert hypotheses.spearman(df, "x", "y").first()["statistic"] == pytest.approx(-1)
    low = order[2000]
    u = hypotheses.mann_whitney(df, "x", F.col("x") >= low, F.col("x") < low, "greater").first()["statistic"]
    assert u == sum(v >= low for v in values) * sum(v < low for v in values)


def test_nan_has_no_rank_and_no_place(spark):
    values = [-2.0, 0.0, 3.0, 5.0, INF, -INF, NAN, None]
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(values)], "i int, v double, k int")
    for by, bounded in (([], False), (["k"], False), (["k"], True), ([], True)):
        found = ordered.min_rank(df, by, "v", "r", best="b", bounded=bounded).collect()
        assert {r["i"]: r["r"] for r in found} == {4: 1, 3: 2, 2: 3, 1: 4, 0: 5, 5: 6, 6: None, 7: None}
        assert {r["b"] for r in found} == {INF}
    assert groups.exact_quantiles(df.where("v is null or abs(v) < 9 or isnan(v)"), [], {}, {"m": ("v", 0.5)}).first()["m"] == 1.5
    assert {r["v"]: r["avg_rank"] for r in groups.value_ranks(df, "v").collect()} == {-INF: 1, -2.0: 2, 0.0: 3, 3.0: 4, 5.0: 5, INF: 6}


def test_weighted_tests_equal_plain_ones(spark):
    rng = random.Random(6)
    rows = [(rng.randint(0, 3), float(rng.randint(0, 6)), rng.choice(["a", "b", None]), rng.randint(0, 1)) for _ in range(900)]
    rows += [(None, 1.0, "a", 1), (1, None, "b", 0), (2, NAN, "a", 1)]
    df = spark.createDataFrame(rows, "x int, y double, g string, f int")
    counted = hypotheses.frequencies(df, ["x", "y", "g", "f"])
    assert counted.count() < 180
    first, second = F.col("x") <= 1, F.col("x") > 1
    pairs = [
        lambda d, w: hypotheses.spearman(d, "x", "y", w), lambda d, w: hypotheses.welch(d, "y", first, second, w),
        lambda d, w: hypotheses.one_sample_t(d, F.col("y") - 3, weight=w), lambda d, w: hypotheses.chi_squared(d, "g", "f", [0, 1], weight=w),
        lambda d, w: hypotheses.chi_squared(d, "x", "f", [0, 1], weight=w),
        lambda d, w: hypotheses.mann_whitney(d, "y", first, second, "greater", w),
    ]
    for test in pairs:
        a, b = test(df, None).first(), test(counted, "weight").first()
        assert (a["test"], a["tail"], a["n"]) == (b["test"], b["tail"], b["n"])
        for c in ("statistic", "df", "effect"):
            assert a[c] == (None if b[c] is None else pytest.approx(b[c], rel=1e-9))
    none = hypotheses.welch(counted.limit(0), "y", first, second, "weight").first()
    assert none["statistic"] is None and none["n"] == 0


@pytest.mark.parametrize("size", [4, 7, 1000])
def test_neighbours_across_borders(spark, size):
    rng = random.Random(1)
    rows = [(k, n, rng.randint(0, 99), rng.random() < 0.2) for k in "ab" for n in range(1, 40 if k == "a" else 4)]
    by = {(k, n): v for k, n, v, _ in rows}
    df = spark.createDataFrame(rows, "k string, n int, v int, e boolean").repartition(5)
    got = ordered.neighbours(df, ["k"], "n", {"before": ("v", 1), "after": ("v", -2)}, size=size).collect()
    assert sorted((r["k"], r["n"], r["before"], r["after"]) for r in got) == sorted(
        (k, n, by.get((k, n - 1)), by.get((k, n + 2))) for k, n in by) if None not in by.values() else False
    near = ordered.around_events(df, ["k"], "n", "e", 2, wanted={"before": ("v", 1)}, size=size).collect()
    events = [(k, n) for k, n, _, e in rows if e]
    assert sorted((r["k"], r["n"], r["offset"]) for r in near) == sorted(
        (k, n + d, d) for k, n in events for d in range(-2, 3) if (k, n + d) in by)
    mean = ordered.rolling_mean(df, ["k"], ["n"], "v", "m", 3, number="n", size=size)
    assert {(r["k"], r["n"]): r["m"] for r in mean.collect()} == {
        (k, n): pytest.approx(sum(x) / len(x)) for k, n in by for x in [[by[k, m] for m in (n - 2, n - 1, n) if (k, m) in by]]}


def test_neighbours_shuffle_once(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.floor(F.col("id") / 3) + 1).alias("n"), "id")
    plan = ordered.around_events(df.withColumn("e", F.col("id") % 50 == 0), ["k"], "n", "e", 2)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Join" not in text
    with pytest.raises(ValueError):
        ordered.neighbours(df, ["k"], "n", {"x": ("id", 9)}, size=5)


def test_bounded_stats_and_null_keys(spark):
    rows = [(1, 1, 2.0), (1, 1, 4.0), (2, 1, 8.0), (None, 1, 1.0), (None, 1, 3.0), (2, None, 5.0)]
    df = spark.createDataFrame(rows, "a int, b int, v double")
    for attach in (groups.attach_bounded_stats, groups.attach_group_stats):
        got = attach(df, ["a", "b"], {"m": F.avg("v"), "n": F.count("v")}).collect()
        assert sorted(map(tuple, got), key=str) == sorted([
            (1, 1, 2.0, 3.0, 2), (1, 1, 4.0, 3.0, 2), (2, 1, 8.0, 8.0, 1), (None, 1, 1.0, None, None), (None, 1, 3.0, None, None),
            (2, None, 5.0, None, None)], key=str)
    plan = groups.attach_bounded_stats(df, ["a"], {"m": F.avg("v")})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Union" not in plan
