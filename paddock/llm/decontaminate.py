"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive words: the words at its ones are hashed, those at its zeros may be anything, so
a passage is found although some of its words have been replaced. The masks are chosen by enumeration, so that however
the allowed replacements lie in a stretch, some mask meets none of them at some place in it. The seeds of the benchmark go into an index
(hash, item, position) and into a bit filter of fixed size. Each training text is hashed once with all masks;
positions that pass the filter are joined to the index by their hash. A hit fixes how text and item lie on each other;
there they are compared word by word, and a stretch of `min_words` words (the whole item if it is shorter) in which at
least `percent` of the words are equal is an overlap.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from paddock.llm.common import WordHashes, map_rows, mixed, odd_numbers, stored, text_or_empty

MOST_MASKS = 4  # for one length of stretch
ENUMERATED = 13  # words; masks for longer stretches are those of a part that has its share of the replacements
SHORTEST = 5  # items with fewer words are not looked for
FILTER_BITS = 24  # two filters of 2^24 bits
WORD = re.compile(r"\w+")
ITEM = "row long, item_id {id}, words binary"


def misses(size: int, percent: int) -> int:
    """How many of `size` words may differ."""
    return size - -(-percent * size // 100)


@cache
def cover(size: int, wrong: int) -> tuple[str, ...]:
    """Masks of which one finds any stretch of `size` words with up to `wrong` replaced, wherever these are.

    The heaviest masks of which MOST_MASKS are enough, taken greedily by the placements of replacements they find."""
    if size > ENUMERATED:
        # of so many parts of the stretch, one has no more than its share of the replacements
        size, wrong = ENUMERATED, wrong // (size // ENUMERATED)
    if wrong >= size:
        return ("1",)
    placements = [set(p) for p in combinations(range(size), wrong)]
    for weight in range(size - wrong, 1, -1):
        found = {}
        for span in range(weight, size + 1):
            for inner in combinations(range(1, span - 1), weight - 2):
                ones = (0, *inner, span - 1)
                shifted = [{at + k for k in ones} for at in range(size - span + 1)]
                found["".join("01"[k in ones] for k in range(span))] = {
                    n for n, p in enumerate(placements) if any(p.isdisjoint(x) for x in shifted)}
        chosen, left = [], set(range(len(placements)))
        while left and len(chosen) < MOST_MASKS:
            chosen.append(max(found, key=lambda m: len(found[m] & left)))
            left -= found[chosen[-1]]
        if not left:
            return tuple(chosen)
    return ("1",)


def masks_for(lengths: list[int], min_words: int, percent: int) -> dict[int, tuple[str, ...]]:
    """The masks for each length of stretch: `min_words` or that of a shorter item.

    Shorter items that may differ in equally many words share the masks of the shortest, so that they are few."""
    out: dict[int, tuple[str, ...]] = {}
    shortest: dict[int, int] = {}
    for n in sorted(set(lengths)):
        wrong = misses(n, percent)
        out[n] = cover(n if n >= min_words else shortest.setdefault(wrong, n), wrong)
    return out


def words_of(text: str, hashes: WordHashes) -> np.ndarray:
    return hashes.of(WORD.findall(text.lower()))


@cache
def _factors(mask: str) -> list[tuple[int, np.uint64]]:
    """Positions of the mask's ones, each with an odd factor of its own."""
    return [(k, f) for k, (bit, f) in enumerate(zip(mask, odd_numbers(len(mask), 1000 + int(mask, 2)))) if bit == "1"]


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the mask's words at each position where the mask fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k, factor in _factors(mask):
        total += words[k:k + n] * factor
    return mixed(total)


def _places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << FILTER_BITS) - 1)
    return hashes & low, (hashes >> np.uint64(FILTER_BITS)) & low


def _passing(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Positions whose hash is in both bit filters."""
    first, second = _places(hashes)
    one = np.uint64(1)
    at = np.flatnonzero((bits[0][first >> np.uint64(6)] >> (first & np.uint64(63))) & one)
    second = second[at]
    return at[((bits[1][second >> np.uint64(6)] >> (second & np.uint64(63))) & one).astype(bool)]


def _index(items: DataFrame, masks: dict[int, tuple[str, ...]], min_words: int) -> DataFrame:
    """hash, item row and position of every seed of the benchmark, with the masks for the item's length."""
    def run(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        for batch in batches:
            out = []
            for row, words in zip(batch["row"], batch["words"]):
                words = np.frombuffer(words, "<u8")
                for mask in masks.get(min(min_words, len(words)), ()) if len(words) >= SHORTEST else ():
                    out += [(int(h), row, at) for at, h in enumerate(seeds(words, mask).astype(np.int64))]
            yield out

    return map_rows(items, run, "hash long, item long, at int")


def _filter(index: DataFrame) -> np.ndarray:
    """The two bit filters. Their size does not depend on the benchmark: at most 2 * 2^FILTER_BITS bits come back."""
    low = (1 << FILTER_BITS) - 1
    places = index.select(F.inline(F.expr(
        f"array(struct(0 AS half, hash & {low}L AS place), "
        f"struct(1 AS half, shiftrightunsigned(hash, {FILTER_BITS}) & {low}L AS place))")))
    words = places.groupBy("half", F.expr("shiftright(place, 6)").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(place & 63 AS INT)))").alias("bits")).toPandas()
    bits = np.zeros((2, 1 << (FILTER_BITS - 6)), np.uint64)
    bits[words["half"].to_numpy(np.int64), words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return bits


def best_overlap(text: np.ndarray, item: np.ndarray, shift: int, min_words: int, percent: int) -> tuple[int, int, int] | None:
    """Where `item` lies on `text` from position `shift`: first and last + 1 text word of the stretches in which enough
    words are equal, and how many of them are; None without such a stretch."""
    size = min(min_words, len(item))
    start, end = max(0, shift), min(len(text), shift + len(item))
    if end - start < size:
        return None
    same = (text[start:end] == item[start - shift:end - shift]).astype(np.int64)
    sums = np.convolve(same, np.ones(size, np.int64), "valid")
    good = np.flatnonzero(100 * sums >= percent * size)
    if not len(good):
        return None
    first, last = int(good[0]), int(good[-1]) + size
    inside = same[first:last]
    ends = np.flatnonzero(inside)
    return start + first + int(ends[0]), start + first + int(ends[-1]) + 1, int(inside.sum())


def overlaps(
    docs: DataFrame, benchmark: DataFrame, min_words: int = 13, percent: int = 80,
    id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
) -> tuple[DataFrame, DataFrame]:
    """Where training texts overlap with benchmark items, and the texts themselves by a key.

    The first table has a row per text, item and way they lie on each other: row, item_id, first_word, end_word (in the
    text's words, end exclusive), n_same. The second has a row per input row: row, the id, text_hash, n_words; row
    joins the two. Words are runs of letters, digits and underscores in lower case. Null texts have no words. Items with
    fewer than five words, empty or null items are not looked for; equal items are each found.
    """
    item_type = benchmark.schema[item_column].dataType.simpleString()
    id_type = docs.schema[id_column].dataType.simpleString()

    def item_words(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        hashes = WordHashes()
        for batch in batches:
            yield [(row, key, words_of(text, hashes).astype("<u8").tobytes())
                   for row, key, text in zip(batch["row"], batch["id"], batch["text"])]

    items = stored(map_rows(
        benchmark.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{item_column}`").alias("id"),
                         text_or_empty(text_column).alias("text")),
        item_words, ITEM.format(id=item_type)))
    sizes = items.select((F.octet_length("words") / 8).cast("int").alias("n")).where(f"n >= {SHORTEST}").select(
        F.least("n", F.lit(min_words)).alias("n")).distinct()
    of_size = masks_for([r.n for r in sizes.collect()], min_words, percent)  # at most min_words lengths
    masks = list(dict.fromkeys(m for n in sorted(of_size) for m in of_size[n]))
    index = stored(_index(items, of_size, min_words))
    bits = docs.sparkSession.sparkContext.broadcast(_filter(index))  # of fixed size

    def regions(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        hashes = WordHashes()
        for batch in batches:
            out = []
            for row, key, text_hash, text in zip(batch["row"], batch["id"], batch["text_hash"], batch["text"]):
                words = words_of(text, hashes)
                found = []
                for mask in masks:
                    values = seeds(words, mask)
                    at = _passing(values, bits.value)
                    found += zip(at.tolist(), values[at].astype(np.int64).tolist())
                found.sort()
                parts, begin = [], 0
                for k in range(1, len(found) + 1):
                    if k == len(found) or found[k][0] - found[k - 1][0] > 2 * min_words:
                        first = max(0, found[begin][0] - min_words)
                        last = min(len(words), found[k - 1][0] + len(max(masks, key=len)) + min_words)
                        parts.append({"first": first, "words": words[first:last].astype("<u8").tobytes(),
                                      "hits": [{"at": a, "hash": h} for a, h in found[begin:k]]})
                        begin = k
                out.append((row, key, text_hash, len(words), parts))
            yield out

    texts = stored(map_rows(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_column}`").alias("id"),
                    text_or_empty(text_column).alias("text")).withColumn("text_hash", F.xxhash64("text")),
        regions, f"row long, id {id_type}, text_hash long, n_words long, "
                 "regions array<struct<first:int,words:binary,hits:array<struct<at:int,hash:long>>>>"))
    parts = texts.where("size(regions) > 0").select("row", F.inline("regions"))
    hits = parts.select("row", "first", F.inline("hits"))
    lying = hits.join(index.withColumnRenamed("at", "item_at"), "hash").select(
        "row", "first", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()

    def compare(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        for batch in batches:
            out = []
            for row, key, first, shift, text, item in zip(*(batch[c] for c in ("row", "item_id", "first", "shift", "words", "item_words"))):
                found = best_overlap(np.frombuffer(text, "<u8"), np.frombuffer(item, "<u8"), shift - first, min_words, percent)
                if found:
                    out.append((row, key, found[0] + first, found[1] + first, found[2]))
            yield out

    both = lying.join(parts.select("row", "first", "words"), ["row", "first"]).join(
        items.select(F.col("row").alias("item"), "item_id", F.col("words").alias("item_words")), "item")
    found = map_rows(both.select("row", "item_id", "first", "shift", "words", "item_words"), compare,
                     f"row long, item_id {item_type}, first_word long, end_word long, n_same long")
    return found.distinct(), texts.select("row", F.col("id").alias(id_column), "text_hash", "n_words")


def decontamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per input row: the id, text_hash, n_words, n_overlaps, n_items, items (ids, sorted, comma-joined),
    contaminated (there is an overlap). Takes the options of `overlaps`."""
    found, texts = overlaps(docs, benchmark, **options)
    per_text = found.groupBy("row").agg(
        F.count("*").alias("n_overlaps"),
        F.array_sort(F.collect_set("item_id")).alias("items"))
    zero = F.lit(0).cast("long")
    return texts.join(per_text, "row", "left").select(
        options.get("id_column", "doc_id"), "text_hash", "n_words", F.coalesce("n_overlaps", zero).alias("n_overlaps"),
        F.coalesce(F.size("items").cast("long"), zero).alias("n_items"),
        F.coalesce(F.array_join(F.col("items").cast("array<string>"), ","), F.lit("")).alias("items"),
        F.col("n_overlaps").isNotNull().alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, unchanged, whose text does not overlap with the benchmark."""
    key, text = options.get("id_column", "doc_id"), options.get("text_column", "text")
    bad = decontamination(docs, benchmark, **options).where("contaminated").select(
        F.col(key).alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    same = F.col(f"`{key}`").eqNullSafe(F.col("__id")) & (F.xxhash64(text_or_empty(text)) == F.col("__hash"))
    return docs.join(bad, same, "left_anti")
