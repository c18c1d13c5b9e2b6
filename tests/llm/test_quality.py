"""Quality classifier."""

import zlib
from collections import defaultdict

import brute
import duckdb
import numpy as np
import pytest
from data import documents

from paddock.llm import quality, queries

LARGER = "/root/testdata/sf0.1"
TEXT = "doc_id long, text string"


def test_held_out_accuracy(spark):
    scored = {r.doc_id: r for r in queries.QUERIES["op12_quality"](spark, LARGER).collect()}
    marked = duckdb.sql(f"SELECT doc_id, quality FROM '{LARGER}/labels.parquet'").fetchall()
    held = [(scored[k], y) for k, y in marked if zlib.crc32(str(k).encode()) % 3 == 1]
    assert len(held) > 1000 and all(r.held_out for r, _ in held)
    assert sum(r.held_out for r in scored.values()) == sum(zlib.crc32(str(k).encode()) % 3 == 1 for k in scored)
    assert len(scored) == 10_000 and all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in scored.values())
    good = np.array([y for _, y in held], bool)
    called = np.array([r.predicted for r, _ in held], bool)
    assert np.mean(called[good]) >= 0.98 and np.mean(~called[~good]) >= 0.9
    # Calibrated: rows with scores near p are good in about p of the cases, all in all.
    scores = np.array([r.score for r, _ in held])
    assert abs(scores.mean() - good.mean()) < 0.03 and np.mean((scores - good) ** 2) < 0.03


def plain_sums(texts: list[str]) -> dict:
    found: dict = defaultdict(int)
    for text in texts:
        hashes = [int(h) for h in quality.WordHashes().of(text)]
        for k, own in enumerate(hashes):
            for other in hashes[max(0, k - quality.NEAR):k] + hashes[k + 1:k + 1 + quality.NEAR]:
                found[own >> 50, quality.WIDTH] += 1
                for s in range(quality.SIGNS):
                    found[own >> 50, other >> 6 * s & 63] += 2 * (other >> 32 + s & 1) - 1
    return {k: v for k, v in found.items() if v}


@pytest.mark.parametrize("flush", [50, 1000, 1 << 20])
def test_neighbour_sums_against_plain_version(spark, monkeypatch, flush):
    texts = [t or "" for _, t in documents() if len(t or "") < 2000][:60] + ["", "one", "one two", "a b c d e f g h i j k"]
    if flush == 1 << 20:
        table = quality.neighbour_sums(spark.createDataFrame(list(enumerate(texts)), TEXT).repartition(3))
    else:
        monkeypatch.setattr(quality, "FLUSH", flush)
        sums = quality.Neighbours()
        for t in texts:
            sums.add(quality.WordHashes().of(t))
        sums.flush()
        table = sums.table[:quality.ROWS]
    assert {(int(i), int(j)): int(table[i, j]) for i, j in np.argwhere(table)} == plain_sums(texts)


def test_pooling_in_parts(monkeypatch):
    vectors = np.random.default_rng(1).normal(size=(quality.ROWS, quality.WIDTH)).astype(np.float32)
    hashes = quality.WordHashes().of(brute.LONG)
    some = vectors[quality.row_of(hashes)].astype(float)
    for size in (1 << 16, 1000):
        monkeypatch.setattr(quality, "LONGEST", size)
        plain = [*some.mean(0), *some.std(0), *(some[1:] * some[:-1]).mean(0), np.log1p(len(some))]
        assert len(plain) == quality.FEATURES and np.allclose(quality.pooled(hashes, vectors), plain, atol=1e-6)
    assert not quality.pooled(hashes[:0], vectors).any()


def test_network_learns_what_is_not_linear():
    random = np.random.default_rng(2)
    x = random.normal(size=(3000, 6))
    y = x[:, 0] * x[:, 1] > 0
    made = quality.train(x[:2000], y[:2000], np.ones(2000), passes=120)
    assert np.mean((made.probability(x[2000:]) >= 0.5) == y[2000:]) > 0.9
    noisy = np.where(random.random(1000) < 0.25, ~y[2000:], y[2000:])
    sharp = quality.Network(made.center, made.scale, made.first, made.first_bias, 5 * made.second, 5 * made.second_bias)
    soft = quality.calibrated(sharp, x[2000:], noisy, np.ones(1000))
    loss = lambda n: np.mean((n.probability(x[2000:]) - noisy) ** 2)
    assert soft.temperature > 2 and loss(soft) < loss(sharp)


def test_edge_rows(spark):
    edge = brute.edge_rows()
    df = spark.createDataFrame(edge, brute.SCHEMA)
    texts = [(k, "calm words in a row" if k % 2 else "x## y%% z$$ ++") for k in range(100, 160)]
    marks = spark.createDataFrame([(k, k % 2, 0) for k in range(100, 160)] + [(101, 0, 0), (None, 1, 0), (103, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.learn(df.select("doc_id", "text").unionAll(spark.createDataFrame(texts, TEXT)), marks)
    found = quality.quality(df, model)
    rows = found.collect()
    assert len(rows) == len(edge) and found.columns == [*df.columns, "held_out", "score", "predicted", "n_words"]
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1 and all(0 <= r.score <= 1 for r in rows)
    assert not any(r.held_out for r in rows if r.doc_id is None)
    called = {r.doc_id: r.predicted for r in quality.quality(spark.createDataFrame(texts, TEXT), model).collect()}
    assert called == {k: k % 2 for k, _ in texts}
    assert quality.quality(df.limit(0), model).collect() == []
    clash = quality.quality(brute.clashing(spark), model)
    assert clash.count() == 2 and clash.columns.count("score") == 1
    none = quality.learn(df, marks.limit(0))
    assert {r.score for r in quality.quality(df, none).collect()} == {0.5}
    assert quality.learn(df.limit(0), marks).network.temperature == 1.0
