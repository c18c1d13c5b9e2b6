"""Two tokenizers on the same bytes."""

import brute
import public_tokenizers
import pytest
import sentencepiece
from data import FOLDER, documents
from tokenizers import Tokenizer

from paddock.llm import alignment, queries

FILES = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILES[2])
    letters = alignment.byte_letters()

    def bytes_a(i: int) -> bytes:
        return bytes(letters[c] for c in a.id_to_token(i)) if i != 50256 else b"<|endoftext|>"

    def bytes_b(i: int) -> bytes:
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    return lambda t: a.encode(t, add_special_tokens=False).ids, bytes_a, b.encode, bytes_b


def found(df, **more) -> list[tuple]:
    out = alignment.token_alignment(df, *FILES, **more)
    assert out.columns == ["doc_id", *alignment.COUNTED, "groups_sha256"]
    return sorted(map(tuple, out.collect()), key=str)


def test_own_columns_of_the_whole_table(spark, sides):
    got = {r.doc_id: tuple(r) for r in queries.QUERIES["op13_token_alignment"](spark, FOLDER).collect()}
    assert set(got) == {k for k, _ in documents()}
    short = [(k, t) for k, t in documents() if len(t or "") < 3000]  # the plain version compares all tokens with all
    for r in brute.aligned(short, *sides):
        assert (got[r[0]][:5], got[r[0]][7]) == (r[:5], r[7])


@pytest.mark.parametrize("block_chars", [1, 5000, 1 << 22])
def test_counts_against_plain_version(spark, sides, block_chars):
    rows = [(k, t) for k, t in documents() if len(t or "") < 1200][:70]
    rows += [(1000 + k, t) for k, t in rows[:9]] + [(1000, rows[0][1])]  # copies, and a row twice
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(df, block_chars=block_chars) == sorted(brute.aligned(rows, *sides), key=str)


def test_edge_rows(spark, sides):
    odd = [r[:2] for r in brute.edge_rows() if len(r[1] or "") < 20_000]
    odd += [(k, t) for k, t in enumerate([
        "<|endoftext|> and </s> <s>[INST] as text", "▁ is a space there", "  leading", "trailing  ", "tab\tline\r\n\x00",
        "é́ 한국어 \U0001f600\U0001f600", "a", " ", "<0x41>", "x" * 300 + " " * 300 + "y"], 100)]
    df = spark.createDataFrame(odd, "doc_id long, text string")
    assert found(df) == sorted(brute.aligned(odd, *sides), key=str)
    assert dict((r[0], r[1:]) for r in found(df))[101] == (0, 0, 0, 0, 0, 0, "")
    assert found(df.limit(0)) == []
    assert len(found(brute.clashing(spark))) == 2


def test_both_libraries_of_one_vocabulary_agree(sides):
    made = alignment.Aligner(FILES[0], FILES[1], public_tokenizers.PATTERN, FILES[2])
    for text in ["x" * 12_000, " " * 12_000 + "y", "a b " * 4000, "\n" * 6000 + "<|endoftext|>", "it's 12 o'clock 　 ok"]:
        assert made.encode_a(text).tolist() == sides[0](text)
