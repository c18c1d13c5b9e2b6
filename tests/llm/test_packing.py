"""Packing, and the pipeline that ends with it."""

import zlib
from collections import defaultdict

import brute
import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from data import FOLDER, documents, rows
from tokenizers import Tokenizer

from paddock.llm import packing

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check_pieces(pieces, texts, window=1024):
    """Every id in exactly one piece, sequences gapless, full or of a power of two."""
    ids = [TOKENIZER.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
    expected = sorted(zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids)
    sequences, by_start = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        by_start[(p.doc_id, p.doc_tokens)].append(p)
        assert zlib.crc32(p["ids"]) == p.ids_crc32 and len(p["ids"]) == 4 * p.length
    odd = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window and at & (at - 1) == 0
        odd += at < window
    assert odd <= window.bit_length() - 1
    assert sum(p.length for p in pieces) == sum(map(len, ids))
    return expected, by_start


@pytest.mark.parametrize("window", [16, 1024])
def test_every_id_in_one_piece(spark, window):
    texts = [t for _, t in documents()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces = packing.packed(df, window=window, keep_ids=True).collect()
    expected, docs = check_pieces(pieces, texts, window)
    found = []
    for parts in docs.values():
        parts.sort(key=lambda p: p.start)
        assert [p.start for p in parts] == list(np.cumsum([0, *(p.length for p in parts[:-1])]))
        found.append(zlib.crc32(b"".join(p["ids"] for p in parts)))
    assert sorted(found) == expected


def test_edge_rows(spark):
    edge = brute.edge_rows()
    check_pieces(packing.packed(spark.createDataFrame(edge, brute.SCHEMA), keep_ids=True).collect(), [r[1] for r in edge])
    assert packing.packed(spark.createDataFrame([], brute.SCHEMA)).collect() == []
    assert packing.packed(brute.clashing(spark)).count() > 0


def test_fast_encoder_equals_the_library(spark):
    coder = packing.encoder(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    odd = ["<|endoftext|> in a text<|endoftext|>", "  spaces   and\n\n\nlines \t\ttabs ", "it's I'LL we'd 123456 ½ ²x", "ﬁ İ ǅ   ​ x",
           "a\u0000b\u0085c", "日本語のテキスト 😀😃 é", "'s 's", "　　x", "z" * 12_000 + " y", " ", "\n"]
    for text in [*odd, *(t or "" for _, t in documents())]:
        assert coder.encode(text).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("counts", [
    np.random.default_rng(1).poisson(1, 1024), np.random.default_rng(2).poisson(200, 1024), np.eye(1024, dtype=int)[700] * 1_000_001,
    np.zeros(1024, int), np.eye(1024, dtype=int)[5] * 3, np.eye(1024, dtype=int)[512] * 10**12 + 1,
])
def test_plan(counts):
    counts = counts.copy()
    counts[0] = 0
    plan = packing.make_plan(counts)
    total = int((counts * np.arange(1024)).sum())
    assert sum(r[2] * (r[4] - r[3]) for r in plan.records) == total
    assert plan.sequences <= total // 1024 + 10 and len(plan.records) < 60_000
    for tail, n in enumerate(counts):  # each part of each tail is placed once
        by_start = sorted((r[1], r[3], r[4], r[2]) for r in plan.records if r[0] == tail)
        assert sum((hi - lo) * length for _, lo, hi, length in by_start) == n * tail


def test_combinations_meet_the_histogram():
    counts = np.zeros(1024, int)
    counts[[600, 424, 300, 700, 24]] = [1000, 1000, 500, 500, 500]
    combos = packing.combinations(1024, counts > 0)
    used = packing.solve(combos, counts.astype(float))
    back = np.zeros(1024)
    for combo, x in zip(combos, used):
        for n in combo[combo > 0]:
            back[n] += x
    assert np.abs(back - counts).max() < 25
    plan = packing.make_plan(counts)
    whole = sum(r[4] - r[3] for r in plan.records if r[1] == 0 and r[2] == r[0])
    assert whole >= 0.98 * counts.sum()


def test_pipeline_stages_against_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    left = {}
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        out = step(spark, docs, FOLDER)
        out.write.parquet(f"{tmp_path}/{k}")
        left[name] = (docs, spark.read.parquet(f"{tmp_path}/{k}"))
        docs = left[name][1]
    for name, (before, after) in left.items():
        assert name == "packing" or after.columns == before.columns
    text_of = lambda df: {r.doc_id: r.text for r in df.collect()}

    labels = dict(rows("SELECT doc_id, toxic FROM labels"))
    kept = set(text_of(left["toxicity"][1]))
    assert sum(k in kept for k, y in labels.items() if not y) >= 0.98 * sum(not y for y in labels.values())
    assert sum(k not in kept for k, y in labels.items() if y) >= 0.7 * sum(labels.values())

    before, after = sorted(text_of(left["line_dedup"][0]).items()), text_of(left["line_dedup"][1])
    expected = {k: t for (k, old), (n, t) in zip(before, brute.cut_lines(before, 10)) if n == 0 or t.replace("\n", " ").strip(" ")}
    assert after == expected

    before, after = sorted(text_of(left["near_dedup"][0]).items()), text_of(left["near_dedup"][1])
    groups = brute.near_components(before, 5)
    assert after == {k: t for n, (k, t) in enumerate(before) if groups[n] == n or not brute.words(t)}

    items = rows("SELECT item_id, text FROM benchmark")
    before, after = text_of(left["decontamination"][0]), text_of(left["decontamination"][1])
    assert after == {k: t for k, t in before.items() if not brute.overlaps(t, items)}

    tokens = sum(len(TOKENIZER.encode(t or "", add_special_tokens=False).ids) + 1 for t in after.values())
    pieces = left["packing"][1].collect()
    assert sum(p.length for p in pieces) == tokens and {p.doc_id for p in pieces} == set(after)
    ran = corpus_pipeline.run(spark, FOLDER)
    key = lambda p: (p.doc_id, p.start, p.length, p.ids_crc32)
    again = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(key, ran.collect())) == sorted(map(key, pieces))  # a later run leaves it readable
    assert sorted(map(key, again.collect())) == sorted(map(key, pieces))


def test_pipeline_stages_of_edge_rows(spark, tmp_path):
    docs = spark.createDataFrame(brute.edge_rows(), brute.SCHEMA)
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.count() > 0
    docs = spark.createDataFrame([], brute.SCHEMA)
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, FOLDER).write.parquet(f"{tmp_path}/empty{k}")
        docs = spark.read.parquet(f"{tmp_path}/empty{k}")
    assert docs.count() == 0
