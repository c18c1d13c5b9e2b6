"""Operators against brute force, ordered ones with whole groups and with groups cut into buckets."""

import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from paddock.operators import groups, joins, keys, ordered, summaries

BUCKETS = [None, "floor(t / 4)"]


def column(bucket):
    return None if bucket is None else F.expr(bucket)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def data(spark):
    """One key holds a third of the rows; values tie often; some values are null."""
    rng = random.Random(3)
    rows = [
        (i, "hot" if i % 3 == 0 else f"k{rng.randrange(30)}", rng.randrange(12), rng.choice([None, 1.5, 2.0, 7.25]))
        for i in range(600)
    ]
    df = spark.createDataFrame(rows, "id int, k string, t int, v double").repartition(5).cache()
    return rows, df


def by_key(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        out[r[1]].append(r)
    return out


@pytest.mark.parametrize("bucket", BUCKETS)
def test_running_totals_and_numbers(data, bucket):
    rows, df = data
    expected = []
    for group in by_key(rows).values():
        total = 0
        for n, r in enumerate(group, 1):
            total += r[2]
            expected.append((r[0], total, n))
    got = ordered.running_totals(df, ["k"], ["t", "id"], {"total": "t"}, bucket=column(bucket))
    got = got.join(ordered.row_numbers(df.select("id", "k", "t"), ["k"], ["t", "id"], "n", bucket=column(bucket)), "id")
    assert rows_of(got, "id", "total", "n") == sorted(expected, key=repr)


@pytest.mark.parametrize("bucket", BUCKETS)
def test_previous_values_with_nulls(data, bucket):
    rows, df = data
    expected = []
    for group in by_key(rows).values():
        before = (None, None)
        for r in group:
            expected.append((r[0], before[0], before[1]))
            before = (r[3], r[0])
    got = ordered.previous_values(df, ["k"], ["t", "id"], {"pv": "v", "pid": "id"}, bucket=column(bucket))
    assert rows_of(got, "id", "pv", "pid") == sorted(expected, key=repr)


@pytest.mark.parametrize("descending", [True, False])
def test_min_rank(data, descending):
    rows, df = data
    expected = []
    for group in by_key(rows).values():
        for r in group:
            ahead = sum((o[2] > r[2]) if descending else (o[2] < r[2]) for o in group)
            expected.append((r[0], ahead + 1))
    got = ordered.min_rank(df, ["k"], "t", "rank", descending=descending)
    assert rows_of(got, "id", "rank") == sorted(expected, key=repr)


@pytest.mark.parametrize("bucket", [None, "-floor(t / 4)"])
def test_descending_order(data, bucket):
    rows, df = data
    expected = []
    for group in by_key(rows).values():
        for n, r in enumerate(sorted(group, key=lambda r: (-r[2], r[0])), 1):
            expected.append((r[0], n))
    got = ordered.row_numbers(df, ["k"], ["-t", "id"], "n", bucket=column(bucket))
    assert rows_of(got, "id", "n") == sorted(expected, key=repr)


def test_group_stats_leave_null_keys_alone(spark, data):
    rows, df = data
    nulls = spark.createDataFrame([(1000 + i, None, i, 1.0) for i in range(20)], df.schema)
    got = groups.attach_group_stats(df.unionByName(nulls), ["k"], {"m": F.max("t"), "n": F.count("v")})
    expected = [
        (r[0], max(o[2] for o in g), sum(o[3] is not None for o in g)) for g in by_key(rows).values() for r in g
    ] + [(1000 + i, None, None) for i in range(20)]
    assert rows_of(got, "id", "m", "n") == sorted(expected, key=repr)


def interpolated(values, p):
    values = sorted(v for v in values if v is not None)
    if not values:
        return None
    at = (len(values) - 1) * p
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


def test_quantiles(data):
    rows, df = data
    got = groups.exact_quantiles(
        df, ["k"], {"n": F.count("v")}, {"mid": ("v", 0.5), "high": ("v", 0.9), "t_low": ("t", 0.25)}
    )
    found = {r["k"]: r for r in got.collect()}
    assert set(found) == set(by_key(rows))
    for k, g in by_key(rows).items():
        assert found[k]["n"] == sum(r[3] is not None for r in g)
        for name, index, p in (("mid", 3, 0.5), ("high", 3, 0.9), ("t_low", 2, 0.25)):
            assert found[k][name] == pytest.approx(interpolated([r[index] for r in g], p)), (k, name)


def test_whole_column_quantile(data):
    rows, df = data
    got = groups.exact_quantiles(df, [], {}, {"mid": ("v", 0.5)}).first()["mid"]
    assert got == interpolated([r[3] for r in rows], 0.5)


def test_average_ranks(data):
    rows, df = data
    values = [r[2] for r in rows]
    got = {r["t"]: (r["n"], r["avg_rank"]) for r in groups.value_ranks(df, "t").collect()}
    for v in set(values):
        below, same = sum(o < v for o in values), values.count(v)
        assert got[v] == (same, below + (same + 1) / 2)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-5, 5)), min_size=1, max_size=60))
def test_running_totals_on_any_rows(spark, pairs):
    rows = [(i, k, t) for i, (k, t) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "id int, k int, t int")
    got = ordered.running_totals(df, ["k"], ["t", "id"], {"s": "t"}, bucket=keys.value_bucket(F.col("t")))
    expected = [
        (i, sum(o[2] for o in rows if o[1] == k and (o[2], o[0]) <= (t, i))) for i, k, t in rows
    ]
    assert rows_of(got, "id", "s") == sorted(expected, key=repr)


def test_nulls_have_no_rank_and_add_nothing(spark):
    rows = [(i, "a" if i < 30 else None, i % 10, None if i % 3 == 0 else float(i % 7)) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, k string, t int, v double")
    group = [r for r in rows if r[1] == "a"]
    for descending in (True, False):
        ranked = ordered.min_rank(df, ["k"], "v", "rank", descending=descending)
        expected = [(r[0], None if r[3] is None or r[1] is None else 1 + sum(
            o[3] is not None and (o[3] > r[3] if descending else o[3] < r[3]) for o in group)) for r in rows]
        assert rows_of(ranked, "id", "rank") == sorted(expected, key=repr)
    plain, cut = (ordered.running_totals(df, ["k"], ["t", "id"], {"s": "v"}, bucket=column(b)) for b in BUCKETS)
    assert rows_of(plain, "id", "s") == rows_of(cut, "id", "s")
    before = [ordered.previous_values(df, ["k"], ["t", "id"], {"p": "v"}, bucket=column(b)) for b in BUCKETS]
    assert rows_of(before[0], "id", "p") == rows_of(before[1], "id", "p")


def test_value_buckets_never_fall(spark):
    values = sorted([-1e300, -5.5, -1.0, -1e-9, 0.0, 1e-9, 0.5, 1.0, 1.0005, 2.0, 1e6, 1e6 + 1, 9e15, 1e300])
    found = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").orderBy("v").select(keys.value_bucket(F.col("v"))).collect()]
    assert found == sorted(found) and len(set(found)) > 8


def test_keep_first_is_limited_before_the_shuffle(data):
    rows, df = data
    kept = groups.keep_first(df, ["k"], [F.col("t"), F.col("id")])
    assert rows_of(kept, "id") == sorted([(g[0][0],) for g in by_key(rows).values()], key=repr)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_rolling_mean_counts_rows_not_years(spark):
    df = spark.createDataFrame([(1, 2000, 1.0), (1, 2001, 2.0), (1, 2005, 6.0), (1, 2006, 10.0), (2, 2000, 5.0)],
                               "team int, year int, x double")
    got = ordered.rolling_mean(df, ["team"], ["year"], "x", "m", 3)
    assert rows_of(got, "team", "year", "m") == [
        (1, 2000, 1.0), (1, 2001, 1.5), (1, 2005, 3.0), (1, 2006, 6.0), (2, 2000, 5.0)]


def test_around_events(spark):
    df = spark.createDataFrame([(1, n, n == 3, 10 * n) for n in range(1, 6)], "d int, lap int, pit boolean, x int")
    got = ordered.around_events(df, ["d"], "lap", "pit", 1)
    assert rows_of(got, "offset", "lap", "x") == [(-1, 2, 20), (0, 3, 30), (1, 4, 40)]


def test_star_join_suffixes_and_missing_keys(spark):
    fact = spark.createDataFrame([(1, 10, 5), (2, 11, None)], "id int, a int, b int")
    left = spark.createDataFrame([(10, "x", "British")], "aid int, a_name string, nationality string")
    right = spark.createDataFrame([(5, "y", "Italian")], "bid int, b_name string, nationality string")
    got = joins.star_join(fact, [
        joins.Dimension(left, {"a": "aid"}, ["a_name", "nationality"], "_driver"),
        joins.Dimension(right, {"b": "bid"}, ["b_name", "nationality"], "_constructor"),
    ])
    assert got.columns == ["id", "a", "b", "a_name", "nationality_driver", "b_name", "nationality_constructor"]
    assert rows_of(got, *got.columns) == [
        (1, 10, 5, "x", "British", "y", "Italian"), (2, 11, None, None, None, None, None)]


def test_unique_gate(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    with pytest.raises(joins.JoinAddsRows):
        joins.require_unique(df, ["k"], "t")
    assert joins.require_unique(df.distinct(), ["k"], "t").count() == 2


def test_summaries_leave_out_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", None)], "k string, v int")
    assert rows_of(summaries.grouped(df, ["k"], {"n": F.count(F.lit(1)), "s": F.sum("v")}), "k", "n", "s") == [
        ("a", 2, 3), ("b", 1, None)]
    assert rows_of(summaries.duplicate_rows(df.unionByName(df)), "rows", "distinct_rows", "duplicates") == [(8, 4, 4)]
    assert rows_of(summaries.null_profile(df), "column_name", "nulls") == [("k", 1), ("v", 1)]
    assert summaries.mean_null_share(df).first()[0] == 25.0
    assert rows_of(summaries.mostly_null(df, 0.2), "column_name") == [("k",), ("v",)]


def test_binned_mean_closes_the_last_bin_and_keeps_empty_ones(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 3.0), (9.0, 5.0), (8.5, 7.0)], "x double, y double")
    got = {r["bin"]: (r["n"], r["mean_y"]) for r in summaries.binned_mean(df, "x", "y", 9).collect()}
    assert got[9] == (2, 6.0) and got[1] == (1, 1.0) and got[2] == (1, 3.0) and got[5] == (0, None) and len(got) == 9


def test_factorize_by_first_appearance(spark):
    df = spark.createDataFrame([(3, "b"), (1, "z"), (2, "b"), (9, "a"), (4, None)], "i int, c string")
    assert rows_of(summaries.factorize(df, "c", ["i"], "code"), "c", "code") == [("a", 2), ("b", 1), ("z", 0)]


def test_ghost_columns_and_headers(spark):
    df = spark.createDataFrame([(1, None, "x")], "id int, _c5 string, ` name ` string")
    assert summaries.strip_headers(summaries.drop_ghost_columns(df)).columns == ["id", "name"]
    kept = spark.createDataFrame([(1, "full")], "id int, _c1 string")
    assert summaries.drop_ghost_columns(kept).columns == ["id", "_c1"]


def test_renames_ignore_what_is_absent(spark):
    df = spark.createDataFrame([(1,)], "year int")
    assert summaries.rename_known(df, {"year": "Season", "dnf": "DNF"}).columns == ["Season"]
    assert summaries.missing_columns(df, ["year", "era"]) == ["era"]


def test_single_row_spread_is_null(spark):
    df = spark.createDataFrame([("a", 1.0)], "k string, v double")
    got = summaries.describe_numbers(df, ["v"]).first()
    assert got["std"] is None and got["q50"] == 1.0


def test_impute_and_fill(spark):
    df = spark.createDataFrame([(1.0, "a"), (4.0, None), (None, "b")], "x double, s string")
    assert rows_of(summaries.impute_median(df, ["x"]), "x") == [(1.0,), (2.5,), (4.0,)]
    assert rows_of(summaries.fill_nulls(df, ["x"], ["s"]), "x", "s") == [(0.0, "b"), (1.0, "a"), (4.0, "Unknown")]
