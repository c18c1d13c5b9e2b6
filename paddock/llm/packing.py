"""Packing documents into sequences of a fixed number of tokens.

A document fills whole sequences with its first tokens; what is left, its tail, is shorter than a sequence. The
histogram of tail lengths is small whatever the number of documents. Combinations of two or three lengths that
fill a sequence exactly are enumerated, non-negative least squares finds how often each should be used so that the
histogram is met, and the counts are rounded. What the rounding leaves is packed greedily, longest first; the
greedy part may cut a tail to fill a sequence, and writes the last tokens as sequences of powers of two, which are
not padded. The plan speaks of ranks among the tails of one length, so its size does not depend on the documents either.
Tails get their ranks by counting in buckets.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from paddock.llm.common import map_rows, stored, text_or_empty

END = 0  # id that ends a document
ROWS_PER_BUCKET = 20_000
STEPS = 400


class Encoder:
    """Ids of the byte-level BPE vocabulary as the `tokenizers` library gives them without added special tokens.

    The faster `tiktoken` reads the same vocabulary and gives the same ids. Texts with very long unbroken runs, on
    which it is slow or fails, go to `tokenizers` itself.
    """

    LONGEST_RUN = 5000

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        self.exact = Tokenizer.from_file(vocabulary)
        special = {t.content: i for i, t in self.exact.get_added_tokens_decoder().items()}
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("text", pat_str=pattern, mergeable_ranks=merges, special_tokens=special)

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= self.LONGEST_RUN or max(map(len, text.split()), default=0) <= self.LONGEST_RUN:
            try:
                return np.array(self.fast.encode(text, allowed_special="all"), "<u4")
            except Exception:  # it gives up on some texts that the other library reads
                pass
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(maxsize=1)
def encoder(vocabulary: str, ranks: str, pattern: str) -> Encoder:
    return Encoder(vocabulary, ranks, pattern)


@dataclass
class Plan:
    """Where the tails go. A record places `length` tokens from `start` of the tails of length `tail` with ranks
    in [low, high): the tail of rank r in sequence `sequence` + r - low, from `offset`."""

    records: list[tuple[int, int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0

    def arrays(self) -> dict[tuple[int, int], np.ndarray]:
        """Records by (tail, start), in order of their ranks."""
        out: dict[tuple[int, int], list] = {}
        for tail, start, length, low, high, sequence, offset in sorted(self.records):
            out.setdefault((tail, start), []).append((low, high, length, sequence, offset))
        return {k: np.array(sorted(v), np.int64) for k, v in out.items()}


class Pool:
    """Pieces not yet placed, by length: intervals of (tail, start, low, high)."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.astype(np.int64).copy()
        self.parts: list[list[list[int]]] = [[[n, 0, 0, int(c)]] if c else [] for n, c in enumerate(counts)]

    def take(self, length: int, count: int) -> list[tuple[int, int, int, int]]:
        out = []
        self.counts[length] -= count
        while count:
            tail, start, low, high = self.parts[length][-1]
            got = min(count, high - low)
            out.append((tail, start, low, low + got))
            count -= got
            if low + got == high:
                self.parts[length].pop()
            else:
                self.parts[length][-1][2] = low + got
        return out

    def put(self, length: int, tail: int, start: int, low: int, high: int) -> None:
        self.parts[length].append([tail, start, low, high])
        self.counts[length] += high - low


def combinations(window: int, present: np.ndarray) -> np.ndarray:
    """Pairs and triples of present lengths that fill the window; a pair has 0 as its third length."""
    lengths = np.flatnonzero(present)
    a, b = np.meshgrid(lengths, lengths, indexing="ij")
    a, b = a[a >= b], b[a >= b]
    c = window - a - b
    ok = (c >= 0) & (c <= b)
    ok &= np.where(c > 0, present[np.clip(c, 0, window - 1)], True)
    return np.stack([a[ok], b[ok], c[ok]], axis=1)


def solve(combos: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often to use each combination: non-negative least squares by accelerated projected gradients."""
    if not len(combos):
        return np.empty(0)
    weights = (combos > 0).astype(float)
    scale = max(float(counts.max()), 1.0)
    target = counts / scale

    def used(x: np.ndarray) -> np.ndarray:
        return np.bincount(combos.ravel(), (x[:, None] * weights).ravel(), minlength=len(counts))

    degree = used(np.ones(len(combos)))
    x = y = np.zeros(len(combos))
    step, t = 1.0 / (3.0 * max(degree.max(), 1.0)), 1.0
    for _ in range(STEPS):
        miss = used(y) - target
        miss[0] = 0.0
        new = np.maximum(0.0, y - step * (miss[combos] * weights).sum(axis=1))
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / after * (new - x)
        x, t = new, after
    return x * scale


def make_plan(counts: np.ndarray) -> Plan:
    """Sequences for `counts[n]` tails of each length n below the window `len(counts)`."""
    window = len(counts)
    counts = counts.astype(np.int64).copy()
    counts[0] = 0
    pool, plan = Pool(counts), Plan()
    combos = combinations(window, counts > 0)
    wanted = solve(combos, counts.astype(float))
    for k in np.argsort(-wanted, kind="stable"):
        times = int(wanted[k] + 0.5)
        lengths = [int(n) for n in combos[k] if n]
        times = min([times, *(int(pool.counts[n]) // lengths.count(n) for n in lengths)])
        if times > 0:
            _place(plan, pool, [(n, n) for n in lengths], times)
    unit = 1 << int(pool.counts.max()).bit_length()
    while unit:  # patterns that repeat often first, so that there are few of them
        left = pool.counts // unit
        if int((left * np.arange(window)).sum()) < window:
            unit >>= 1
            continue
        uses, room = [], window
        while room:
            fits = np.flatnonzero(left[:room + 1])
            # the longest that fits, or else a part of the shortest that does not
            length = int(fits[-1] if len(fits) else np.flatnonzero(left)[0])
            uses.append((length, min(length, room)))
            left[length] -= 1
            room -= min(length, room)
        lengths = [n for n, _ in uses]
        _place(plan, pool, uses, min(int(pool.counts[n]) // lengths.count(n) for n in set(lengths)))
    rest = [n for n in range(window - 1, 0, -1) for _ in range(int(pool.counts[n]))]  # fewer tokens than a window
    size = 1 << (sum(rest).bit_length() - 1) if rest else 0
    while size:
        if sum(rest) >= size:
            uses, room = [], size
            while room:
                n = rest.pop(0)
                uses.append((n, min(n, room)))
                if n > room:
                    rest.insert(0, n - room)
                room -= min(n, room)
            _place(plan, pool, uses, 1)
        size >>= 1
    return plan


def _place(plan: Plan, pool: Pool, uses: list[tuple[int, int]], times: int) -> None:
    """Make `times` sequences, each of one piece for every (length, tokens used of it); what is cut off goes back."""
    offset, back = 0, []
    for length, used in uses:
        sequence = plan.sequences
        for tail, start, low, high in pool.take(length, times):
            plan.records.append((tail, start, used, low, high, sequence, offset))
            sequence += high - low
            if used < length:
                back.append((length - used, tail, start + used, low, high))
        offset += used
    for part in back:
        pool.put(*part)
    plan.sequences += times


def packed(
    docs: DataFrame, vocabulary: str | None = None, ranks: str | None = None, pattern: str | None = None,
    window: int = 1024, id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """Pack whole documents into sequences of at most `window` tokens.

    A document is the ids of its text followed by id 0; a null text is empty and has that id alone. One row per
    piece: the id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with `keep_ids` the ids as
    unsigned 32-bit little-endian integers. Every id of every row is in exactly one piece; repeated rows are documents
    of their own. Sequences are full but for at most log2(window) of them, which have a power of two of tokens each.
    """
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern = pattern or public_tokenizers.PATTERN
    id_type = docs.schema[id_column].dataType.simpleString()

    def cut(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        coder = encoder(vocabulary, ranks, pattern)
        for batch in batches:
            out = []
            for row, key, text in zip(batch["row"], batch["id"], batch["text"]):
                ids = np.append(coder.encode(text), np.uint32(END)).astype("<u4")
                small = ids.astype("<u2") if ids.max() < 1 << 16 else ids
                for start in range(0, len(ids), window):
                    piece = ids[start:start + window]
                    whole = len(piece) == window
                    kept = small[start:start + window].tobytes() if keep_ids or not whole else None
                    out.append((row, key, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), kept))
            yield out

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_column}`").alias("id"),
                       text_or_empty(text_column).alias("text"))
    fields = f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = stored(map_rows(rows, cut, f"row long, {fields}, ids binary"))
    tails = pieces.where(F.col("length") < window)

    lengths = tails.groupBy("length").agg(F.count("*").alias("n")).collect()  # fewer than `window` rows
    counts = np.zeros(window, np.int64)
    for r in lengths:
        counts[r["length"]] = r["n"]
    plan = make_plan(counts)
    records = docs.sparkSession.sparkContext.broadcast(plan.arrays())  # its size is bounded by the window's

    buckets = max(16, int(counts.sum()) // ROWS_PER_BUCKET)
    tails = tails.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    sizes = tails.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "bucket").orderBy("row")
    ranked = tails.withColumn("place", F.row_number().over(inside) - 1).join(bases, ["length", "bucket"])
    ranked = ranked.select("id", "start", "length", "ids_crc32", "doc_tokens", "ids", (F.col("base") + F.col("place")).alias("rank"))

    def place(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        found = records.value
        for batch in batches:
            out = []
            for key, base, tail, crc, total, ids, rank in zip(*(batch[c] for c in (
                    "id", "start", "length", "ids_crc32", "doc_tokens", "ids", "rank"))):
                at = 0
                while at < tail:
                    table = found[(tail, at)]
                    low, _, length, sequence, offset = table[np.searchsorted(table[:, 0], rank, "right") - 1].tolist()
                    width = len(ids) // tail
                    part = ids[at * width:(at + length) * width]
                    if length < tail:
                        crc = zlib.crc32(np.frombuffer(part, f"<u{width}").astype("<u4").tobytes())
                    out.append((key, base + at, length, crc, total, part if keep_ids else None, sequence + rank - low, offset))
                    at += length
            yield out

    ends = map_rows(ranked, place, f"{fields}, ids binary, sequence_id long, offset long")
    whole = pieces.where(F.col("length") == window).select(
        "id", "start", "length", "ids_crc32", "doc_tokens", "ids",
        (F.monotonically_increasing_id() + plan.sequences).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    both = ends.unionAll(whole).withColumnRenamed("id", id_column)
    if not keep_ids:
        return both.drop("ids")
    wide = F.udf(lambda ids, n: np.frombuffer(ids, f"<u{len(ids) // n}").astype("<u4").tobytes(), "binary")
    return both.withColumn("ids", wide("ids", "length"))
