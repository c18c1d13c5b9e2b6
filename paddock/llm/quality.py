"""Quality classifier: random-indexing word vectors, pooled per document, then a two-layer network with a temperature.

Random indexing gives each word a fixed sparse vector of a few signs, drawn from the word's hash, and adds up for each word
the vectors of its neighbours over the whole corpus. Words share a fixed number of rows by their hash, so the table has one
size whatever the vocabulary, no word is left out, and whole-number sums come out the same in any order. A task adds up
its texts in numpy and emits its table in slices; each slice is then summed as a stream. What a row has in
excess of its expectation, scaled to unit length, is its vector.

A document is the mean and the standard deviation of the vectors of its words and the mean product of adjacent ones, which
tells text that repeats itself. The network is fitted in numpy on a bounded
sample of labelled rows, of which Spark returns the pooled vectors, not the texts; a fifth of them is kept back and sets
the temperature by which its output becomes a probability.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from paddock.llm.common import map_rows, text_or_empty

FOLDS, HELD_OUT = 3, 1  # rows with this remainder of crc32(id as text) are never learned from
ROWS, WIDTH, SIGNS = 1 << 14, 64, 4  # rows that words share, numbers in a vector, signs in a word's own vector
FEATURES = 3 * WIDTH + 1
SLICES = 64
NEAR = 2  # neighbours on each side
FLUSH = 1 << 20  # words added up at once
LONGEST = 1 << 16  # words pooled at once
MAX_CACHED = 400_000
WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")  # runs of letters, of digits, of signs


class WordHashes(dict):
    """64-bit hash of a word as it is written, remembered; bounded in size."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MAX_CACHED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"), 11)
        return value

    def of(self, text: str) -> np.ndarray:
        words = WORD.findall(text)
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def row_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - ROWS.bit_length() + 1)).astype(np.int64)


class Neighbours:
    """Sums of the neighbours' vectors, a row for each word hash, and in the last column how many neighbours."""

    def __init__(self):
        self.table = np.zeros((ROWS + 1, WIDTH + 1), np.int64)  # the last row is that of the gaps between texts
        self.waiting, self.size = [], 0

    def add(self, hashes: np.ndarray) -> None:
        for at in range(0, len(hashes), FLUSH):  # a longer text in parts that overlap by the neighbourhood
            part = hashes[max(0, at - NEAR):at + FLUSH]
            self.waiting.append((part, min(at, NEAR)))
            self.size += len(part)
            if self.size >= FLUSH:
                self.flush()

    def flush(self) -> None:
        if not self.waiting:
            return
        gap = np.zeros(NEAR, np.uint64)
        hashes = np.concatenate([x for part, _ in self.waiting for x in (part, gap)])
        real = np.concatenate([x for part, _ in self.waiting for x in (np.ones(len(part), bool), np.zeros(NEAR, bool))])
        # Words that an earlier part of the same text has paired with each other already.
        seen = np.concatenate([x for part, old in self.waiting for x in (np.arange(len(part)) < old, np.zeros(NEAR, bool))])
        rows = np.where(real, row_of(hashes), ROWS) * (WIDTH + 1)
        places = [((hashes >> np.uint64(6 * k)) & np.uint64(WIDTH - 1)).astype(np.int64) for k in range(SIGNS)]
        signs = [((hashes >> np.uint64(32 + k)) & np.uint64(1)).astype(np.int8) * np.int8(2) - np.int8(1) for k in range(SIGNS)]
        cells, values = [], []
        for step in range(1, NEAR + 1):
            both = real[step:] & real[:-step] & ~(seen[step:] & seen[:-step])
            for own, other in ((slice(None, -step), slice(step, None)), (slice(step, None), slice(None, -step))):
                base = rows[own][both]
                for place, sign in zip(places, signs):
                    cells.append(base + place[other][both])
                    values.append(sign[other][both])
                cells.append(base + WIDTH)
                values.append(np.ones(len(base), np.int8))
        total = np.zeros(self.table.size)
        for at, value in zip(cells, values):
            total += np.bincount(at, value, self.table.size)  # whole numbers far below 2**53
        self.table += total.astype(np.int64).reshape(self.table.shape)
        self.waiting, self.size = [], 0


def neighbour_sums(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """The table over all texts; its size is fixed."""
    texts = docs.select(text_or_empty(text_column).alias("text"))
    shape = (ROWS // SLICES, WIDTH + 1)

    def added(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        sums, hashes = Neighbours(), WordHashes()
        for batch in batches:
            for text in batch["text"]:
                sums.add(hashes.of(text))
        sums.flush()
        parts = sums.table[:ROWS].reshape(SLICES, *shape)
        yield [(k, part.tobytes()) for k, part in enumerate(parts) if part.any()]

    def summed(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch["slice"], batch["sums"]):
                sums[k] = sums.get(k, 0) + np.frombuffer(data, np.int64)
        yield [(k, x.tobytes()) for k, x in sums.items()]

    schema = "slice int, sums binary"
    parts = map_rows(map_rows(texts, added, schema).repartition(SLICES, "slice"), summed, schema).collect()  # SLICES rows
    table = np.zeros((SLICES, *shape), np.int64)
    for part in parts:
        table[part["slice"]] = np.frombuffer(part["sums"], np.int64).reshape(shape)
    return table.reshape(ROWS, WIDTH + 1)


def word_vectors(table: np.ndarray) -> np.ndarray:
    """A vector for each row: its neighbours in excess of the expected ones, of unit length; shorter where few were met."""
    sums, met = table[:, :WIDTH].astype(float), table[:, WIDTH:].astype(float)
    excess = sums - met * (sums.sum(0) / max(1.0, met.sum()))
    length = np.linalg.norm(excess, axis=1, keepdims=True)
    return (excess / np.maximum(length, 1e-9) * (met / (met + 8))).astype(np.float32)


def pooled(hashes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """FEATURES numbers: mean and standard deviation of the vectors of a text's words, the mean product of the vectors of
    adjacent words, and the logarithm of the number of words. Zeros without words."""
    total, squares, products = (np.zeros(vectors.shape[1]) for _ in range(3))
    for at in range(0, len(hashes), LONGEST):
        some = vectors[row_of(hashes[at:at + LONGEST + 1])]  # with the next part's first word
        own = some[:LONGEST]
        total += own.sum(0, dtype=float)
        squares += np.einsum("ij,ij->j", own, own, dtype=float)
        products += np.einsum("ij,ij->j", some[1:], some[:-1], dtype=float)
    n = max(1, len(hashes))
    mean = total / n
    return np.concatenate([mean, np.sqrt(np.maximum(squares / n - mean * mean, 0)), products / max(1, len(hashes) - 1), [np.log1p(len(hashes))]])


@dataclass(frozen=True)
class Network:
    """Two layers; `temperature` divides the output before it becomes a probability."""

    center: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.center) / self.scale @ self.first + self.first_bias) @ self.second + self.second_bias

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x) / self.temperature, -500, 500)))


def train(x: np.ndarray, y: np.ndarray, weights: np.ndarray, hidden: int = 24, passes: int = 60, batch: int = 64,
          rate: float = 3e-3, decay: float = 1e-4, seed: int = 5) -> Network:
    """Fit by Adam on the weighted log loss. Without rows of both labels the output is the smoothed share of label 1."""
    inputs = x.shape[1]
    if not y.any() or y.all():
        share = (y.sum() + 1) / (len(y) + 2)
        return Network(np.zeros(inputs), np.ones(inputs), np.zeros((inputs, hidden)), np.zeros(hidden), np.zeros(hidden),
                       float(np.log(share / (1 - share))))
    random = np.random.default_rng(seed)
    center, scale = x.mean(0), x.std(0) + 1e-6
    z, weights = (x - center) / scale, weights / weights.mean()
    values = [random.normal(0, 1 / np.sqrt(inputs), (inputs, hidden)), np.zeros(hidden), random.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for _ in range(passes):
        order = random.permutation(len(z))
        for at in range(0, len(z), batch):
            k = order[at:at + batch]
            h = np.tanh(z[k] @ values[0] + values[1])
            error = weights[k] * (1 / (1 + np.exp(-(h @ values[2] + values[3]))) - y[k]) / len(k)
            back = np.outer(error, values[2]) * (1 - h * h)
            slopes = [z[k].T @ back + decay * values[0], back.sum(0), h.T @ error + decay * values[2], np.array([error.sum()])]
            step += 1
            for v, g, m, s in zip(values, slopes, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Network(center, scale, values[0], values[1], values[2], float(values[3][0]))


def calibrated(network: Network, x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> Network:
    """The network with the temperature that gives kept-back rows the least log loss."""
    if not y.any() or y.all():
        return network
    raw, sign = network.raw(x), np.where(y, 1.0, -1.0)
    loss = lambda t: float((weights * np.logaddexp(0, -sign * raw / t)).sum())
    best = min(np.geomspace(0.25, 16, 97), key=loss)
    return Network(network.center, network.scale, network.first, network.first_bias, network.second, network.second_bias, float(best))


@dataclass(frozen=True)
class Model:
    vectors: np.ndarray
    network: Network


def features(texts: DataFrame, vectors: np.ndarray, kept: list[str]) -> DataFrame:
    """The columns `kept`, n_words and the pooled vector of each row's `text`."""
    shared = texts.sparkSession.sparkContext.broadcast(vectors)  # ROWS x WIDTH numbers

    @F.pandas_udf("n_words long, pooled array<double>")
    def pool(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for some in batches:
            words = [hashes.of(t) for t in some]
            yield pd.DataFrame({"n_words": [len(w) for w in words], "pooled": [pooled(w, shared.value) for w in words]})

    found = texts.select(*[F.col(f"`{c}`") for c in kept], pool("text").alias("__found"))
    return found.select(*[F.col(f"`{c}`") for c in kept], "__found.n_words", "__found.pooled")


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, id_column: str = "doc_id", text_column: str = "text") -> Model:
    """Vectors from all documents, the network from labelled rows outside the held-out fold.

    At most `max_rows` ids of each label are learned from, those with the least hash, so their number does not grow with
    the input; weights restore the shares of the two. An id that is null, unlabelled or labelled both ways is left out; of
    several texts under one id the least one counts.
    """
    vectors = word_vectors(neighbour_sums(docs, text_column))
    fold = F.pmod(F.crc32(F.col("id").cast("string")), F.lit(FOLDS))
    marked = (
        labels.select(F.col(f"`{id_column}`").alias("id"), F.col("`quality`").alias("quality"))
        .where(F.col("id").isNotNull() & F.col("quality").isNotNull() & (fold != HELD_OUT))
        .groupBy("id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most")
        .select("id", (F.col("quality") == 1).alias("good"))
    )
    total = {r["good"]: r["count"] for r in marked.groupBy("good").count().collect()}  # two rows
    order = [F.xxhash64("id", F.lit("quality")), F.col("id")]
    chosen = marked.where("good").orderBy(*order).limit(max_rows).unionAll(marked.where("NOT good").orderBy(*order).limit(max_rows))
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), text_or_empty(text_column).alias("text"))
    sample = texts.join(F.broadcast(chosen), "id").groupBy("id", "good").agg(F.min("text").alias("text"))
    rows = sorted(features(sample, vectors, ["id", "good"]).collect(), key=lambda r: str(r["id"]))  # two times max_rows at most
    x = np.array([r["pooled"] for r in rows], float).reshape(len(rows), FEATURES)
    y = np.array([r["good"] for r in rows], bool)
    weights = np.where(y, total.get(True, 0) / max(1, y.sum()), total.get(False, 0) / max(1, (~y).sum()))
    back = np.array([xxhash.xxh3_64_intdigest(str(r["id"])) % 5 == 0 for r in rows], bool)
    return Model(vectors, calibrated(train(x[~back], y[~back], weights[~back]), x[back], y[back], weights[back]))


def quality(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row of `docs` with all its columns and held_out, score, predicted, n_words.

    score is the probability of label 1, predicted is 1 from 0.5. A null or empty text, or one of white space, has no words and
    a pooled vector of zeros, which has a score like any other. Columns of these names in `docs` are replaced. held_out
    is false for a null id. Repeated rows each get their row; equal texts have equal scores.
    """
    added, network = ("held_out", "score", "predicted", "n_words"), model.network
    kept = [c for c in docs.columns if c not in added]
    shared = docs.sparkSession.sparkContext.broadcast(model.vectors)

    @F.pandas_udf("score double, n_words long")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for texts in batches:
            words = [hashes.of(t) for t in texts]
            scores = [float(network.probability(pooled(w, shared.value))) for w in words]  # one by one: a batch may round otherwise
            yield pd.DataFrame({"score": scores, "n_words": [len(w) for w in words]})

    held_out = F.pmod(F.crc32(F.col(f"`{id_column}`").cast("string")), F.lit(FOLDS)) == HELD_OUT
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       scored(text_or_empty(text_column)).alias("__found"))
    return rows.select(*[F.col(f"`{c}`") for c in kept], "held_out", F.col("__found.score").alias("score"),
                       (F.col("__found.score") >= 0.5).cast("int").alias("predicted"), F.col("__found.n_words").alias("n_words"))
