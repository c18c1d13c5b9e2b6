"""Document fingerprints: one-permutation MinHash with optimal densification, packed low-order bits.

The word shingles of a text are hashed once. The top bits of a hash choose its bin, the least hash of each bin is
kept. A bin that stays empty takes the value of a bin that did not, found by probing bins in an order that is fixed for
each bin, so that equal sets borrow alike. Of every value only some low-order bits are stored. Two fingerprints
agree by chance in a bin with probability 2^-bits; the estimate of the similarity is corrected for that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from paddock.llm.common import WordHashes, ascii_words, map_rows, mixed, shingle_hashes, stored, text_or_empty

PROBES = 512  # probes of an empty bin that are looked at in one step
FIRST_PROBES = 16


class Fingerprints:
    """Fingerprints of texts and the likeness of two of them."""

    def __init__(self, width: int = 5, bins: int = 256, bits: int = 4):
        if bins & (bins - 1) or bins < 8 or bits not in (1, 2, 4, 8):
            raise ValueError("bins is a power of two from 8, bits is 1, 2, 4 or 8")
        self.width, self.bins, self.bits = width, bins, bits
        self.shift = np.uint64(64 - bins.bit_length() + 1)
        self.hashes = WordHashes()
        self.probes = self._probes(0)

    def _probes(self, step: int) -> np.ndarray:
        """For each bin the bins that it probes in this step."""
        number = np.arange(self.bins, dtype=np.uint64)[:, None] << np.uint64(32)
        tries = np.arange(step * PROBES, (step + 1) * PROBES, dtype=np.uint64)[None, :]
        return (mixed(number + tries + np.uint64(0x51ED)) >> self.shift).astype(np.int64)

    def _lenders(self, empty: np.ndarray, filled: np.ndarray) -> np.ndarray:
        """For each empty bin the first filled one that it probes."""
        out = np.empty(len(empty), np.int64)
        left, step = np.arange(len(empty)), 0
        for most in (FIRST_PROBES, PROBES):
            tried = self.probes[empty[left], :most]
            hit = filled[tried]
            found = hit.any(axis=1)
            out[left[found]] = tried[found, hit[found].argmax(axis=1)]
            left = left[~found]
            if not len(left):
                return out
        while len(left):
            step += 1
            tried = self._probes(step)[empty[left]]
            hit = filled[tried]
            found = hit.any(axis=1)
            out[left[found]] = tried[found, hit[found].argmax(axis=1)]
            left = left[~found]
        return out

    def of(self, text: str) -> str:
        """Hexadecimal fingerprint of a whole text; empty for a text without words."""
        shingles = np.sort(shingle_hashes(self.hashes.of(ascii_words(text)), self.width))
        if not len(shingles):
            return ""
        place = (shingles >> self.shift).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        low = np.zeros(self.bins, np.uint8)
        filled = np.zeros(self.bins, bool)
        low[place[first]] = (mixed(shingles[first]) & np.uint64((1 << self.bits) - 1)).astype(np.uint8)
        filled[place[first]] = True
        if len(first) < self.bins:
            empty = np.flatnonzero(~filled)
            low[empty] = low[self._lenders(empty, filled)]
        per_byte = 8 // self.bits
        packed = np.zeros(self.bins // per_byte, np.uint8)
        for k in range(per_byte):
            packed |= low[k::per_byte] << np.uint8(k * self.bits)
        return packed.tobytes().hex()

    def likeness(self, one: str, other: str) -> float:
        """Estimated Jaccard similarity; two empty fingerprints are alike, an empty and another one are not."""
        if not one or not other:
            return float(one == other)
        x = np.frombuffer(bytes.fromhex(one), np.uint8) ^ np.frombuffer(bytes.fromhex(other), np.uint8)
        mask = np.uint8((1 << self.bits) - 1)
        same = sum(int(np.count_nonzero((x >> np.uint8(k * self.bits)) & mask == 0)) for k in range(8 // self.bits))
        chance = 0.5 ** self.bits
        return float(max(0.0, (same / self.bins - chance) / (1 - chance)))


def fingerprint(text: Column, width: int = 5, bins: int = 256, bits: int = 4) -> Column:
    """Fingerprint of a text column; a null text counts as empty."""
    @F.pandas_udf("string")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        maker = Fingerprints(width, bins, bits)
        for texts in batches:
            yield texts.map(maker.of)

    return made(F.coalesce(text, F.lit("")))


def likeness(one: Column, other: Column, bins: int = 256, bits: int = 4) -> Column:
    """Estimated similarity (0 to 1) of two fingerprint columns; null beside a null."""
    @F.pandas_udf("double")
    def estimated(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        maker = Fingerprints(bins=bins, bits=bits)
        for xs, ys in batches:
            yield pd.Series([None if x is None or y is None else maker.likeness(x, y) for x, y in zip(xs, ys)], dtype="float64")

    return estimated(one, other)


def edited(text: str, following: str) -> str:
    """The text with its last quarter of code points replaced by the first as many of the following text."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


DONE, FIRST, LAST = 0, 1, 2


def against_next(
    docs: DataFrame, width: int = 5, bins: int = 256, bits: int = 4, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness; next is the row with the next id.

    One row per input row: the id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    Rows are ordered by id (null first), equal ids by text; after the last comes the first. Null texts count as
    empty. Rows are dealt out by ranges of the id, each task goes through its range in order and leaves its last row to
    be joined to the first of the next range.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), text_or_empty(text_column).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    columns = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    made = f"id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def compared(maker: Fingerprints, key, text: str, own: str, following: str, next_own: str) -> tuple:
        changed = edited(text, following)
        print_changed = own if changed == text else maker.of(changed)
        digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
        return (key, len(text), digest, own, print_changed, maker.likeness(own, print_changed), maker.likeness(own, next_own))

    def along(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        maker, before, part = Fingerprints(width, bins, bits), None, None
        nothing = (None,) * 6
        for batch in batches:
            out = []
            for key, text, part in zip(batch["id"], batch["text"], batch["part"]):
                own = maker.of(text)
                if before is None:
                    out.append((None, *nothing, FIRST, part, text))
                else:
                    out.append((*compared(maker, *before, text, own), DONE, part, None))
                before = (key, text, own)
            yield out
        if before is not None:
            yield [(before[0], *nothing, LAST, part, before[1])]

    def at_borders(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        maker = Fingerprints(width, bins, bits)
        for batch in batches:
            yield [compared(maker, key, text, maker.of(text), following, maker.of(following))
                   for key, text, following in zip(batch["id"], batch["text"], batch["following"])]

    dealt = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", "text")
    found = stored(map_rows(
        dealt.withColumn("part", F.spark_partition_id()), along, f"{made}, kind int, part int, text string"))
    # One first and one last row for each task, whatever the number of rows.
    by_part = Window.orderBy("part")
    ends = found.where(F.col("kind") != DONE).groupBy("part").agg(
        F.max(F.when(F.col("kind") == FIRST, F.col("text"))).alias("first"),
        F.max(F.when(F.col("kind") == LAST, F.col("text"))).alias("text"),
        F.max(F.when(F.col("kind") == LAST, F.col("id"))).alias("id"))
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("id", "text", F.coalesce(F.lead("first").over(by_part), F.first("first").over(whole)).alias("following"))
    result = found.where(F.col("kind") == DONE).select(*columns).unionAll(map_rows(ends, at_borders, made).select(*columns))
    return result.withColumnRenamed("id", id_column)

