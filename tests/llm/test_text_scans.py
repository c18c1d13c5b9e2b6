"""Operators that look at each text on its own."""

import random

import brute
import public_tokenizers
import pytest
import sentencepiece
from compare import differences
from data import FOLDER, connect, documents

from paddock.llm import license_scan, pii, queries, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_transducer_counts_as_the_library(library):
    counter, random_ = token_counts.Transducer(MODEL), random.Random(3)
    letters = [" "] * 4 + list("abcdefghijklmnopqrstuvwxyzABC.,!?éßü\n\t\r▁0123<>/s[]日本ﬁ😀\u0000の")
    pieces = ["the", "tion", " ", "  ", "    ", "er", "</s>", "ing", "in", "and ", "return", "\n"]
    for k in range(3000):
        text = "".join(random_.choices(pieces if k % 3 else letters, k=random_.randint(1, 30)))
        marked = token_counts.SPACE + text.replace(" ", token_counts.SPACE)
        size = random_.randint(1, 9)
        chunks = [counter.chunk_map(marked[i:i + size]) for i in range(0, len(marked), size)]
        assert counter.whole(marked) == counter.composed(chunks) == len(library.encode(text)), text


def test_transducer_forgets_states(library, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    monkeypatch.setattr(token_counts, "MAX_SEGMENTS", 5)
    monkeypatch.setattr(token_counts, "MAX_PAIRS", 20)
    counter = token_counts.Transducer(MODEL)
    for text in ("interesting things happen here now", "a" * 300, "mississippi  rivers   flow\nslowly"):
        assert counter.whole(token_counts.SPACE + text.replace(" ", token_counts.SPACE)) == len(library.encode(text))


@pytest.mark.parametrize("chunk", [1 << 16, 1000])
def test_token_counts_of_edge_rows(spark, library, chunk):
    rows = brute.edge_rows()
    found = token_counts.token_counts(spark.createDataFrame(rows, brute.SCHEMA), MODEL, chunk_chars=chunk)
    expected = sorted((r[0] if r[0] is not None else -1, len((r[1] or "").encode()), len(library.encode(r[1] or ""))) for r in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens) for r in found.collect()) == expected
    assert all(r.over_limit == (r.n_tokens > 4096) for r in found.collect())


def test_token_counts_of_documents(spark, library):
    found = {r.doc_id: r.n_tokens for r in queries.QUERIES["op2_token_counts"](spark, FOLDER).collect()}
    assert found == {k: len(library.encode(t or "")) for k, t in documents()}


@pytest.mark.parametrize("name", ["op1_line_dedup", "op3_license_scan", "op9_pii"])
def test_queries_equal_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), connect(), queries.ORACLES[name]) is None


def test_license_phrases_and_templates(spark):
    texts = [
        "The MIT License. mit license; MIT  licenses", "GNU General-Public\nLicense apache LICENSE", None, "", "mit mit license license",
        "This program is free software: you can really redistribute it and/or modify it under terms of the GNU General Public License as "
        "published by the Free Software Foundation", "Mİt license", "general public general public license",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in license_scan.license_spans(df).collect()}
    assert (found[0].n_base, found[0].first_word, found[0].last_word, found[0].labels) == (2, 1, 3, "mit")
    assert (found[1].n_base, found[1].base_labels, found[1].first_word, found[1].last_word) == (2, "apache,gpl", 1, 4)
    assert (found[2].n_words, found[2].n_base, found[2].first_word, found[2].labels, found[2].score) == (0, 0, None, "", 0.0)
    assert found[3].n_words == 0 and found[4].n_base == 1
    assert found[5].labels == "gpl" and found[5].n_base == 1
    assert any(0.6 <= s.coverage < 1 and s.label == "gpl" and s.first_word == 0 for s in found[5].spans)
    assert found[6].n_base == 0 and found[7].first_word == 2


def test_licenses_of_edge_rows(spark):
    rows = brute.edge_rows()
    assert license_scan.license_spans(spark.createDataFrame(rows, brute.SCHEMA)).count() == len(rows)
    assert license_scan.license_spans(spark.createDataFrame([], brute.SCHEMA)).collect() == []
    assert license_scan.license_spans(brute.clashing(spark)).count() == 2


PERSONAL = [
    "call +1 (456) 555-2186 or mail a.b@c.de_x@y.org now", "1.2.3.4.5.6.7.8 and 256.1.1.1 and 0001.2.3.004",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111222", "x@y@z.com a@b a@.c é@ü.de ü1@b.c", "+1+12345678+123 456-", None, "",
    "1 " * 400 + "7" * 20_000, "a" * 5000 + "@b.c" + "1.1.1." * 500, "😀 日本 q@r.st 😀 10.0.0.1", "DE89 3704 0044 0532 0130 00 and GB82WEST12345698765433",
    "a@b.c_d@e.f" * 300, "call +1234567890 bank 9.9.9.9 " * 700,
]


def test_personal_data_against_plain_expressions(spark):
    rows = list(enumerate(PERSONAL))
    found = {r.doc_id: r.spans for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for key, text in rows:
        base = [(s.kind, s.start, s.end) for s in found[key] if s.kind in pii.BASE]
        assert base == brute.pii(text), key
        assert all(s.text == text[s.start:s.end] for s in found[key])
    assert [(s.kind, s.start) for s in found[10] if s.kind == "iban"] == [("iban", 0)]
    assert [s.score for s in found[0]] == [1.0, 0.7, 1.0] and found[9][0].score == pii.VALID


def test_personal_data_of_edge_rows(spark):
    rows = brute.edge_rows()
    found = pii.digest(pii.find_pii(spark.createDataFrame(rows, brute.SCHEMA)))
    assert found.count() == len(rows)
    assert pii.digest(pii.find_pii(spark.createDataFrame([], brute.SCHEMA))).collect() == []
    assert pii.digest(pii.find_pii(brute.clashing(spark))).count() == 2


def test_account_numbers_before_other_words(spark):
    texts = {
        "GB82 WEST 1234 5698 7654 32 Please": "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000 EUR 500": "DE89370400440532013000",
        "DE89 3704 0044 0532 0130 00 BIC COBADEFF": "DE89 3704 0044 0532 0130 00", "to NO9386011117947 7 X1, now": "NO9386011117947",
        "x MT84MALT011000012345MTLCAST001S.": "MT84MALT011000012345MTLCAST001S", "DE893704004405320130001": None, "XDE89370400440532013000": None,
        "DE89370400440532013000ab": None, "DE88370400440532013000 ": None,
    }
    found = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {list(texts)[r.doc_id]: next((s.text for s in r.spans if s.kind == "iban"), None) for r in found} == texts
    assert all(list(texts)[r.doc_id][s.start:s.end] == s.text for r in found for s in r.spans)


def test_license_scan_in_linear_time(spark):
    """The time of one long text grows with its length, not with the square."""
    import time

    def seconds(words: int) -> float:
        text = " ".join(f"w{k % 9973} x" for k in range(words // 2)) + " the mit license "
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.perf_counter()
        assert [r.base_labels for r in license_scan.license_spans(df).collect()] == ["mit"]
        return time.perf_counter() - start

    seconds(40_000)
    assert min(seconds(160_000) for _ in range(2)) < 4 * min(seconds(40_000) for _ in range(2)) + 2
