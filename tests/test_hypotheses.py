import math

import pytest
from pyspark.sql import functions as F

from paddock.operators import hypotheses as H


def pairs(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def table(spark, cells):
    """One row per observation of a contingency table {(row, column): count}."""
    rows = [(r, c) for (r, c), n in cells.items() for _ in range(n)]
    return spark.createDataFrame(rows, "r string, c int")


def test_published_chi_squared_with_yates(spark):
    counts = spark.createDataFrame([("H", 0, 1301), ("H", 1, 346), ("V", 0, 2331), ("V", 1, 1669)], "r string, c int, n int")
    df = counts.select("r", "c", F.explode(F.sequence(F.lit(1), "n")))
    row = H.chi_squared(df, "r", "c", [0, 1]).first()
    assert row["statistic"] == pytest.approx(217.27509962215746, rel=1e-12)
    assert row["df"] == 1 and row["n"] == 5647
    assert H.chi_squared(df, "r", "c", [0, 1], yates=False).first()["statistic"] == pytest.approx(218.1769, abs=1e-4)


def test_chi_squared_without_correction_above_one_df(spark):
    row = H.chi_squared(table(spark, {("a", 0): 10, ("a", 1): 20, ("b", 0): 20, ("b", 1): 10, ("c", 0): 15, ("c", 1): 15}),
                        "r", "c", [0, 1]).first()
    assert row["statistic"] == pytest.approx(20 / 3) and row["df"] == 2


def test_yates_never_overshoots(spark):
    row = H.chi_squared(table(spark, {("a", 0): 5, ("a", 1): 5, ("b", 0): 5, ("b", 1): 6}), "r", "c", [0, 1]).first()
    assert row["statistic"] == pytest.approx(0, abs=1e-12)


def test_chi_squared_needs_two_categories(spark):
    assert H.chi_squared(table(spark, {("a", 0): 5, ("a", 1): 5}), "r", "c", [0, 1]).first()["statistic"] is None


def test_mann_whitney_counts_pairs(spark):
    a, b = [1, 2, 2, 5, 7], [2, 3, 3, 9]
    df = spark.createDataFrame([("a", x) for x in a] + [("b", x) for x in b], "g string, v int")
    wins = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    ties = sum(n ** 3 - n for n in (3, 2))
    sigma = math.sqrt(20 / 12 * (10 - ties / (9 * 8)))
    for alternative, u in (("greater", wins), ("less", 20 - wins)):
        row = H.mann_whitney(df, "v", F.col("g") == "a", F.col("g") == "b", alternative).first()
        assert row["statistic"] == wins
        assert row["effect"] == pytest.approx((u - 10 - 0.5) / sigma)


def test_mann_whitney_degenerate_samples(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "g string, v int")
    tied = H.mann_whitney(df, "v", F.col("g") == "a", F.col("g") == "b", "less").first()
    assert tied["statistic"] == 1.0 and tied["effect"] is None
    empty = H.mann_whitney(df, "v", F.col("g") == "a", F.col("g") == "z", "less").first()
    assert empty["statistic"] is None


def test_spearman_with_ties(spark):
    xy = [(1, 3), (2, 1), (2, 2), (4, 5), (5, 5), (None, 1), (9, None)]
    row = H.spearman(spark.createDataFrame(xy, "x int, y int"), "x", "y").first()
    rx, ry = [1, 2.5, 2.5, 4, 5], [3, 1, 2, 4.5, 4.5]
    top = sum((a - 3) * (b - 3) for a, b in zip(rx, ry))
    expected = top / math.sqrt(sum((a - 3) ** 2 for a in rx) * sum((b - 3) ** 2 for b in ry))
    assert row["statistic"] == pytest.approx(expected) and row["n"] == 5


def test_spearman_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1, i) for i in range(7)], "x int, y int")
    assert H.spearman(df, "x", "y").first()["statistic"] is None


def test_welch_and_effect(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 6.0), ("b", 1.0), ("b", 0.0), ("b", None)], "g string, v double")
    row = H.welch(df, "v", F.col("g") == "a", F.col("g") == "b").first()
    v1, v2 = 7.0, 0.5
    assert row["statistic"] == pytest.approx(2.5 / math.sqrt(v1 / 3 + v2 / 2))
    assert row["effect"] == pytest.approx(2.5 / math.sqrt((v1 + v2) / 2))
    assert row["df"] == pytest.approx((v1 / 3 + v2 / 2) ** 2 / ((v1 / 3) ** 2 / 2 + (v2 / 2) ** 2 / 1))


def test_least_squares_recovers_a_plane(spark):
    rows = [(x, z, 2.0 + 3.0 * x - z + ((x * 7 + z * 3) % 5 - 2) * 0.1) for x in range(6) for z in range(6)]
    df = spark.createDataFrame(rows, "x int, z int, y double")
    got = {r["term"]: r for r in H.least_squares(df, "y", ["x", "z"]).collect()}
    import numpy as np

    X = np.array([[1, r[0], r[1]] for r in rows], float)
    y = np.array([r[2] for r in rows])
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    residual = y - X @ beta
    cov = residual @ residual / (len(y) - 3) * np.linalg.inv(X.T @ X)
    for i, term in enumerate(("const", "x", "z")):
        assert got[term]["coef"] == pytest.approx(beta[i], rel=1e-9)
        assert got[term]["std_err"] == pytest.approx(math.sqrt(cov[i, i]), rel=1e-9)
    assert got["x"]["r_squared"] == pytest.approx(1 - residual @ residual / ((y - y.mean()) @ (y - y.mean())))
    assert got["x"]["p_value"] < 1e-20 and got["x"]["n"] == 36


def test_report_and_summary(spark):
    rows = [
        ("Spearman", "rho", 0.1838639248520369, 23775.0, 23777, None),
        ("chi-squared", "chi2", 0.9008402633254528, 3.0, 7516, None),
        ("Mann-Whitney U", "z_upper", 100.0, None, 50, 2.0),
        ("Mann-Whitney U", "z_upper", None, None, 0, None),
    ]
    schema = "test string, tail string, statistic double, df double, n long, effect double"
    log = H.report({f"H{i}": ("text", spark.createDataFrame([r], schema)) for i, r in enumerate(rows)})
    got = {r["hypothesis_id"]: r for r in log.collect()}
    assert got["H0"]["p_value"] == pytest.approx(7.97003710812313e-180, rel=1e-9) and got["H0"]["stars"] == "***"
    assert got["H1"]["p_value"] == pytest.approx(0.8252250294157957) and got["H1"]["verdict"] == "FAIL TO REJECT H0"
    assert got["H2"]["stars"] == "*" and got["H2"]["significant"]
    assert got["H3"]["verdict"] == "insufficient data" and got["H3"]["p_value"] is None
    assert tuple(H.log_summary(log).first()) == (3, 2, 1, pytest.approx(200 / 3))


def test_small_samples_take_the_exact_distribution(spark):
    df = spark.createDataFrame([("a", x) for x in (1, 2, 3)] + [("b", x) for x in (4, 5, 6)], "g string, v int")
    found = {alt: H.report({"H": ("t", H.mann_whitney(df, "v", F.col("g") == "a", F.col("g") == "b", alt))}).first()["p_value"]
             for alt in ("less", "greater")}
    assert found["less"] == pytest.approx(0.05) and found["greater"] == pytest.approx(1.0)


def test_yates_looks_at_the_columns_that_occur(spark):
    cells = {("a", 0): 10, ("a", 1): 20, ("b", 0): 20, ("b", 1): 14}
    two, three = (H.chi_squared(table(spark, cells), "r", "c", v).first() for v in ([0, 1], [5, 0, 1]))
    assert two["statistic"] == pytest.approx(three["statistic"]) and three["df"] == 1


def test_constant_predictor_does_not_stop_the_fit(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0), (2.0, 4.1, 7.0), (3.0, 5.9, 7.0), (4.0, 8.2, 7.0)], "x double, y double, c double")
    found = {r["term"]: r for r in H.least_squares(df, "y", ["x", "c"]).collect()}
    alone = {r["term"]: r for r in H.least_squares(df, "y", ["x"]).collect()}
    assert found["x"]["coef"] == pytest.approx(alone["x"]["coef"]) and found["x"]["p_value"] == pytest.approx(alone["x"]["p_value"])
    assert found["c"]["coef"] == pytest.approx(0)


def test_a_small_sample_is_exact_beside_any_other(spark):
    df = spark.createDataFrame([("a", 30_000.5)], "g string, v double").unionAll(spark.range(20_000).selectExpr("'b'", "double(id)"))
    two = spark.createDataFrame([("a", 9_000.5), ("a", 9_001.5)], "g string, v double").unionAll(spark.range(5_001).selectExpr("'b'", "double(id)"))
    for data, expected in ((df, 1 / 20_001), (two, 1 / math.comb(5_003, 2))):
        test = H.mann_whitney(data, "v", F.col("g") == "a", F.col("g") == "b", "greater")
        assert H.report({"H": ("t", test)}).first()["p_value"] == pytest.approx(expected, rel=1e-12)


def test_exact_distribution_against_all_orders():
    from itertools import combinations

    for m in range(1, 5):
        for n in range(1, 8):
            found = [sum(p) - m * (m - 1) // 2 for p in combinations(range(m + n), m)]
            for u in range(m * n + 1):
                expected = sum(x >= u for x in found) / len(found)
                assert H.rank_sum_upper(u, m, n) == H.rank_sum_upper(u, n, m) == expected
    assert H.rank_sum_upper(8 * 10**9, 8, 10**9) == pytest.approx(1 / math.comb(10**9 + 8, 8), rel=1e-12)
    assert H.rank_sum_upper(4 * 10**6, 8, 10**6) == pytest.approx(0.5, abs=1e-3)
