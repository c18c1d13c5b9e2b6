"""Alignment of two tokenizers on the same bytes, with corpus-wide counts of linked ids.

Every distinct text is tokenized and aligned once: rows are shuffled by their full text and aggregated, so copies
meet before any tokenizer runs. Offsets where tokens of both sides end cut a text into groups; the boundaries of
both sides together cut it into elementary ranges, each of which lies in one token of either side and so is one link.

Texts are aligned in blocks of a bounded number of characters. A block lists its distinct id pairs once, each with the
number of documents (copies counted) that hold it linked. These lists are what is summed over the corpus, and what the
sums are joined back to: a pair that almost every document holds is one row a block, not one a document. A text keeps
its links as positions in its block's list and gets its measures when the block meets its counts. Measures are joined to
the documents by the hash of the text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from paddock.llm.common import stored, text_or_empty

SHIFT = 32  # a pair of ids is a << SHIFT | b
LONGEST_RUN = 5000  # characters of one run from which the faster library is not asked
BLOCK_CHARS = 8 << 20
MEASURES = ("n_a", "n_b", "n_groups", "n_links")
COUNTED = (*MEASURES, "n_best", "count_sum")
ROW = ("block long, text_key binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
       "places binary, times binary, pair long, weight long")


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, the rest from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Side:
    """One tokenizer's ids as bytes, byte lengths and decimal numbers."""

    def __init__(self, entries: list[bytes]):
        self.bytes = np.array([*entries, b""], object)[:-1]  # one more entry, so that numpy keeps an array of objects
        self.length = np.array([len(x) for x in entries], np.int64)
        self.size = len(entries)

    def spells(self, ids: np.ndarray, text: bytes) -> bool:
        return b"".join(self.bytes[ids].tolist()) == text


class Aligner:
    """Tokenizes with both libraries and aligns what they give."""

    def __init__(self, byte_level: str, ranks: str, pattern: str, pieces: str):
        self.exact = Tokenizer.from_file(byte_level)
        self.exact.encode_special_tokens = True  # their strings in a text are plain text
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("text", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        letters, special = byte_letters(), self.exact.get_added_tokens_decoder()
        entries = [self.exact.id_to_token(k) or "" for k in range(self.exact.get_vocab_size())]
        self.a = Side([t.encode() if k in special else bytes(letters[c] for c in t) for k, t in enumerate(entries)])
        self.b = Side([
            bytes([int(self.pieces.id_to_piece(k)[3:5], 16)]) if self.pieces.is_byte(k)
            else self.pieces.id_to_piece(k).replace("▁", " ").encode() for k in range(self.pieces.get_piece_size())])
        # What a token writes into the digest: its number and what follows it, by (side, last of its group).
        marks = ((self.a, b",", b"|"), (self.b, b",", b";"))
        self.written = np.array([b"%d%s" % (k, m) for side, *after in marks for m in after for k in range(side.size)], object)

    def encode_a(self, text: str) -> np.ndarray:
        """Ids of the byte-level vocabulary. Both libraries give the same; the faster one is slow, or overflows its stack,
        on very long runs of letters or of white space."""
        if len(text) > LONGEST_RUN:
            lengths = [*map(len, text.split())]
            if max(len(text) - sum(lengths) - len(lengths), *lengths, 0) > LONGEST_RUN:
                return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.int64)
        return np.array(self.fast.encode_ordinary(text), np.int64)

    def align(self, text: str) -> tuple[tuple[int, int, int, int], str, np.ndarray, np.ndarray]:
        """(n_a, n_b, n_groups, n_links), digest of the groups, distinct linked pairs ascending, how often each is linked."""
        nothing = np.empty(0, np.int64)
        if not text:
            return (0, 0, 0, 0), "", nothing, nothing
        data = (" " + text).encode()
        a, b = self.encode_a(" " + text), np.array(self.pieces.encode(text), np.int64)
        if not (len(a) and len(b) and self.a.spells(a, data) and self.b.spells(b, data)):
            return (0, 0, 0, 0), "", nothing, nothing
        ends_a, ends_b = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        cuts = ends_a[np.isin(ends_a, ends_b, assume_unique=True)]
        borders = np.union1d(ends_a, ends_b)
        linked = a[np.searchsorted(ends_a, borders)] << SHIFT | b[np.searchsorted(ends_b, borders)]
        pairs, times = np.unique(linked, return_counts=True)
        counts = (len(a), len(b), len(cuts), len(borders))
        return counts, hashlib.sha256(self.groups(a, b, ends_a, ends_b, cuts)).hexdigest(), pairs, times

    def groups(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, cuts: np.ndarray) -> bytes:
        """`a1,a2|b1;a3|b2,b3`: the ids of each group, first those of one side, then those of the other."""
        in_a, in_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        before_a, before_b = np.searchsorted(ends_a, cuts, "right"), np.searchsorted(ends_b, cuts, "right")
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.concatenate([[0], before_b])[in_a]] = a + self.a.size * (ends_a == cuts[in_a])
        order[np.arange(len(b)) + before_a[in_b]] = 2 * self.a.size + b + self.b.size * (ends_b == cuts[in_b])
        return b"".join(self.written[order].tolist())[:-1]


@lru_cache(maxsize=1)
def aligner(byte_level: str, ranks: str, pattern: str, pieces: str) -> Aligner:
    return Aligner(byte_level, ranks, pattern, pieces)


def planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers, their low bytes first, then the next ones: most planes are zeros and compress to nothing."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


class Block:
    """Aligned texts until a bounded number of characters is reached."""

    def __init__(self):
        self.chars, self.rows, self.pairs, self.times, self.copies = 0, [], [], [], []

    def add(self, key: bytes, text: str, copies: int, found: tuple) -> None:
        counts, digest, pairs, times = found
        self.chars += len(text)
        self.rows.append((key, *counts, digest))
        self.pairs.append(pairs)
        self.times.append(times)
        self.copies.append(copies)

    def batches(self, number: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """A row for each text, then a row for each distinct pair of the block."""
        sizes = [len(p) for p in self.pairs]
        pairs, places = np.unique(np.concatenate(self.pairs), return_inverse=True)
        weights = np.zeros(len(pairs), np.int64)
        np.add.at(weights, places, np.repeat(np.array(self.copies, np.int64), sizes))
        own = np.split(places, np.cumsum(sizes)[:-1])
        columns = dict(zip(("text_key", *MEASURES, "groups_sha256"), zip(*self.rows)))
        columns["places"] = [planes(np.diff(x, prepend=0)) for x in own]  # ascending, so steps are small
        columns["times"] = [planes(x) for x in self.times]
        yield self._batch(schema, number, len(self.rows), columns)
        yield self._batch(schema, number, len(pairs), {"pair": pairs, "weight": weights})

    @staticmethod
    def _batch(schema: pa.Schema, number: int, size: int, columns: dict) -> pa.RecordBatch:
        columns = {"block": np.full(size, number, np.int64), **columns}
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def aligned_blocks(texts: DataFrame, files: tuple[str, str, str, str], block_chars: int) -> DataFrame:
    """Rows of blocks from distinct texts (text_key, text, copies): texts with their links, and pairs with their weights."""
    schema = to_arrow_schema(T.StructType.fromDDL(ROW))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        align = aligner(*files).align
        number, block = TaskContext.get().partitionId() << 33, Block()
        for batch in batches:
            for key, text, copies in zip(*(batch.column(n) for n in ("text_key", "text", "copies"))):
                said = text.as_py()
                block.add(key.as_py(), said, copies.as_py(), align(said))
                if block.chars >= block_chars:
                    yield from block.batches(number, schema)
                    number, block = number + 1, Block()
        if block.rows:
            yield from block.batches(number, schema)

    return texts.mapInArrow(run, ROW)


def measured(texts: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """Measures of the texts of one block from the corpus-wide counts of its pairs."""
    pairs = pairs.sort_values("pair")
    counts, best = pairs["n"].to_numpy(np.int64), pairs["best"].to_numpy(bool)
    n_best, count_sum = [], []
    for places, times in zip(texts["places"], texts["times"]):
        at, often = np.cumsum(unplaned(places)), unplaned(times)
        n_best.append(int(often[best[at]].sum()))
        count_sum.append(int((often * counts[at]).sum()))
    return texts[["text_key", *MEASURES, "groups_sha256"]].assign(n_best=n_best, count_sum=count_sum)


def token_alignment(
    docs: DataFrame, byte_level: str, ranks: str, pieces: str, pattern: str = public_tokenizers.PATTERN,
    id_column: str = "doc_id", text_column: str = "text", block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per input row: the id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `byte_level` and `ranks` are the same vocabulary for two libraries, `pieces` the other tokenizer's model. A null or empty
    text, and one whose joined tokens on either side are not a space and the text, has zeros and an empty digest.
    n_best counts the links whose pair is, corpus-wide, in as many documents as any pair of its first id; count_sum
    sums the pairs' counts over the links. Repeated rows count as documents of their own and each get a row; a null id stays
    null; other columns are not read. A block holds `block_chars` characters, or one longer text.
    """
    files = (byte_level, ranks, pattern, pieces)
    said = docs.select(F.col(f"`{id_column}`").alias("id"), text_or_empty(text_column).alias("text"))
    distinct = said.groupBy("text").agg(F.count("*").alias("copies")).select(text_key(F.col("text")).alias("text_key"), "text", "copies")
    blocks = stored(aligned_blocks(distinct, files, block_chars))
    texts = blocks.where("text_key IS NOT NULL").drop("pair", "weight").withColumnRenamed("block", "home")
    listed = blocks.where("pair IS NOT NULL").select("block", "pair", "weight")

    counts = stored(listed.groupBy("pair").agg(F.sum("weight").alias("n")))
    first = F.shiftright("pair", SHIFT)
    highest = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))  # at most a row per id of the vocabulary
    counted = counts.withColumn("a", first).join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))

    found = (
        texts.groupBy("home").cogroup(listed.select("block", "pair").join(counted, "pair").groupBy("block"))
        .applyInPandas(measured, "text_key binary, " + ", ".join(f"{c} long" for c in MEASURES) + ", groups_sha256 string, n_best long, count_sum long")
    )
    ids = said.select("id", text_key(F.col("text")).alias("text_key"))
    return ids.join(found, "text_key").select(F.col("id").alias(id_column), *COUNTED, "groups_sha256")
