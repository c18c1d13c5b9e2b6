"""Toxicity by compression distance: which of two zstandard dictionaries shortens the windows of a text more.

Each word is spelled by a code of fixed length, so that finding a short word in a dictionary saves as many bytes as
finding a long one. A word leans toxic if its rate among the toxic texts is many times that among the ordinary ones,
and by more than chance, copies left out on both sides; a word need not be absent from ordinary texts. Both dictionaries
begin with what is trained on the windows of ordinary texts. The toxic one goes on with windows of toxic texts, so many
that each word that leans toxic is there, the ordinary one with the same windows and noise for these words: what stands
around them is known to both, and both are of one size, by which zstandard chooses its tables. A window's gap is its
compressed length with the ordinary dictionary minus that with the toxic one. A text is described by the share of windows
whose gap reaches a threshold that it surely has. The threshold and the share from which a text is called toxic are
calibrated by cross-validation: every labelled text is judged by dictionaries that were trained without its fold.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from paddock.llm.common import text_or_empty

CODE = 12  # bytes that spell a word
FOLDS = 5
HELD_OUT = 0  # fold by crc32(id as text) mod FOLDS that is never learned from
LEANING = 8  # times the rate in ordinary texts, half a text added to each count
SURE = 6.63  # log-likelihood ratio that chance exceeds once in a hundred; what chance lets in is weighed down by calibration
TOXIC_WEIGHT = 0.25  # of toxic rows in calibration
EXAMPLES = 2  # windows kept for a word that leans toxic, where it has so many
MAX_CACHED = 50_000  # words, and windows, that a task remembers; nine of ten windows are met once, so more would only hold memory
WORD = re.compile(r"[^\W\d_]+")
GAPS = range(2, 9)


class Codes(dict):
    """The code of a word, remembered; bounded in size."""

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MAX_CACHED:
            self.clear()
        code = self[word] = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=CODE).digest()
        return code


@dataclass(frozen=True)
class Model:
    """All that scoring needs; `gap`, `slope`, `middle` are calibrated."""

    ordinary: bytes
    toxic: bytes
    window: int  # words
    level: int
    gap: int
    slope: float
    middle: float
    smallest: float  # shares below this count as this

    def score(self, share: float) -> float:
        x = self.slope * (np.log(max(share, self.smallest)) - self.middle)
        return float(1 / (1 + np.exp(-np.clip(x, -500, 500))))


class Gaps:
    """Compression gaps of windows with a pair of dictionaries."""

    def __init__(self, ordinary: bytes, toxic: bytes, window: int, level: int):
        self.window = window
        self.by_ordinary, self.by_toxic = (_compressor(x, level) for x in (ordinary, toxic))
        self.codes = Codes()
        self.known: dict[tuple, int] = {}

    def forget(self) -> None:
        self.codes.clear()
        self.known.clear()

    def _gap(self, words: tuple) -> int:
        if len(self.known) >= MAX_CACHED:
            self.known.clear()
        window = b"".join(map(self.codes.__getitem__, words))
        gap = self.known[words] = len(self.by_ordinary.compress(window)) - len(self.by_toxic.compress(window))
        return gap

    def counts(self, words: list[str]) -> dict[int, int]:
        """How many windows of a whole text have which gap."""
        found: dict[int, int] = {}
        known, n = self.known, self.window
        for at in range(0, len(words), n):
            window = tuple(words[at:at + n])
            gap = known.get(window)
            if gap is None:
                gap = self._gap(window)
            found[gap] = found.get(gap, 0) + 1
        return found


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def share_at(counts: dict[int, int], gap: int, z: float = 0.67) -> float:
    """The share of windows with a gap of at least `gap` that a text surely has: the lower end of Wilson's interval, one
    sided at 75%. So one odd window says much about a text of two windows and next to nothing about one of hundreds. 0 without
    such windows."""
    total, hits = sum(counts.values()), sum(n for g, n in counts.items() if g >= gap)
    if not hits:
        return 0.0
    share, z2 = hits / total, z * z
    middle, spread = share + z2 / (2 * total), z * (share * (1 - share) / total + z2 / (4 * total * total)) ** 0.5
    return max(0.0, (middle - spread) / (1 + z2 / total))


def _compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    raw = zstandard.ZstdCompressionDict(dictionary, zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(
        level=level, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False)


def _dictionary(windows: list[bytes], size: int, segment: int) -> bytes:
    """A trained dictionary; the windows themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, windows, k=segment, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(windows))[:size] or b" " * 8


def _windows(text: list[str], words: int) -> list[list[str]]:
    return [text[at:at + words] for at in range(0, len(text), words)]


def _spelled(words: list[str], codes: Codes) -> bytes:
    return b"".join(map(codes.__getitem__, words))


def _originals(texts: list[list[str]], sample: int = 8) -> tuple[Counter[str], int]:
    """How many texts have each word, and how many texts there are, without texts that share more than half of a fixed
    sample of their words with one before."""
    owner: dict[str, int] = {}
    having: Counter[str] = Counter()
    total = 0
    for number, text in enumerate(texts):
        words = frozenset(text)
        some = sorted(words, key=lambda w: hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest())[:sample]
        seen = Counter(owner[w] for w in some if w in owner)
        if seen and 2 * max(seen.values()) > len(some):
            continue
        owner.update(dict.fromkeys(some, number))
        having.update(words)
        total += 1
    return having, total


def _leaning(foul: tuple[Counter[str], int], clean: tuple[Counter[str], int]) -> set[str]:
    """The words whose rate in toxic texts is LEANING times that in ordinary ones or more, and surely so."""
    (often, fouls), (rare, cleans) = foul, clean
    total = fouls + cleans

    def sure(n: int, m: int) -> bool:
        parts = ((n, (n + m) * fouls / total), (m, (n + m) * cleans / total))
        return 2 * sum(x * np.log(x / mean) for x, mean in parts if x) >= SURE

    return {w for w, n in often.items()
            if (n + 0.5) / (fouls + 1) >= LEANING * (rare[w] + 0.5) / (cleans + 1) and sure(n, rare[w])}


def _examples(texts: list[list[str]], leaning: set[str], window: int) -> list[list[str]]:
    """The first windows of toxic texts that have each of the words; their number grows with that of the words only."""
    wanted, out = dict.fromkeys(leaning, EXAMPLES), {}
    for text in texts:
        for words in _windows(text, window):
            if any(wanted.get(w) for w in words) and tuple(words) not in out:
                out[tuple(words)] = words
                for w in words:
                    if w in wanted:
                        wanted[w] = max(0, wanted[w] - 1)
    return list(out.values())


def _train(texts: list[list[str]], toxic: np.ndarray, ordinary_bytes: int, window: int) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary."""
    codes = Codes()
    clean = [t for t, y in zip(texts, toxic) if not y]
    foul = [t for t, y in zip(texts, toxic) if y]
    leaning = _leaning(_originals(foul), _originals(clean))
    # A window that was seen before is a copy and left out.
    usual = list(dict.fromkeys(
        _spelled(w, codes) for t in clean for w in _windows([x for x in t if x not in leaning], window)))
    shared = _dictionary(usual, ordinary_bytes, 2 * CODE)
    del usual
    examples = _examples(foul, leaning, window)
    # No word has a digit, so these codes stand for nothing.
    around = b"".join(_spelled([f"{w}0" if w in leaning else w for w in words], codes) for words in examples)
    return shared + around, shared + b"".join(_spelled(words, codes) for words in examples)


def _auc(values: np.ndarray, labels: np.ndarray) -> float:
    ranks = pd.Series(values).rank().to_numpy()
    ones, zeros = labels.sum(), (~labels).sum()
    return (ranks[labels].sum() - ones * (ones + 1) / 2) / (ones * zeros) if ones and zeros else 0.5


def fit(
    texts: list[str], toxic: np.ndarray, folds: np.ndarray, weights: np.ndarray | None = None, window: int = 4,
    level: int = 3, ordinary_bytes: int = 112_640, smallest: float = 2e-3,
) -> Model:
    """Train the dictionaries and calibrate by cross-validation over `folds`; `weights` undo an uneven sample."""
    weights = np.ones(len(texts)) if weights is None else weights
    known: dict[str, str] = {}  # one string for each word
    words = [[known.setdefault(w, w) for w in words_of(t)] for t in texts]
    counts: list[dict[int, int]] = [{}] * len(texts)
    for f in sorted(set(folds.tolist())):
        others = folds != f
        gaps = Gaps(*_train([w for w, o in zip(words, others) if o], toxic[others], ordinary_bytes, window), window, level)
        for k in np.flatnonzero(~others):
            counts[k] = gaps.counts(words[k])
        del gaps  # before the next are trained
    best = (-1.0, 0.0, 0, 0.0)
    for gap in GAPS:
        x = np.log(np.maximum([share_at(c, gap) for c in counts], smallest)) if counts else np.empty(0)
        right, middle = _middle(x, toxic, weights)
        best = max(best, (round(right, 6), round(_auc(x, toxic), 6) if len(x) else 0.5, -gap, middle))
    ordinary, foul = _train(words, toxic, ordinary_bytes, window)
    return Model(ordinary, foul, window, level, -best[2], 2.0, best[3], smallest)


def _middle(x: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """The largest share of weight on its own side of a border, and the middle of the borders that reach it.

    Toxic rows make up TOXIC_WEIGHT of it, however rare they are. Without toxic rows no text is called toxic."""
    if not toxic.any():
        return 1.0, 1.0
    weights = weights * np.where(toxic, TOXIC_WEIGHT / weights[toxic].sum(), (1 - TOXIC_WEIGHT) / max(1e-9, weights[~toxic].sum()))
    values = np.unique(x)
    borders = np.concatenate([(values[1:] + values[:-1]) / 2, [1.0]])
    right = np.array([weights[(x > b) == toxic].sum() for b in borders]) / weights.sum()
    good = borders[right >= right.max() - 1e-12]
    return float(right.max()), float(good[len(good) // 2])


@lru_cache(maxsize=1)
def _gaps_of(model: Model) -> Gaps:
    return Gaps(model.ordinary, model.toxic, model.window, model.level)


def learn(
    docs: DataFrame, labels: DataFrame, max_toxic: int = 1500, max_ordinary: int = 3500,
    id_column: str = "doc_id", text_column: str = "text",
) -> Model:
    """Fit on a bounded sample of the labelled rows outside the held-out fold.

    The sample has at most `max_toxic` toxic and `max_ordinary` other rows, those with the smallest hash of
    their id, so its number of rows is the same at any input size; weights restore the shares of the two. Null ids and
    labels are not learned from. The texts of the sample are learned from and calibrated on whole, as they are scored.
    """
    fold = F.pmod(F.crc32(F.col("id").cast("string")), F.lit(FOLDS)).cast("int")
    marked = labels.select(F.col(f"`{id_column}`").alias("id"), (F.col("toxic") == 1).alias("toxic")).where(
        "id IS NOT NULL AND toxic IS NOT NULL").withColumn("fold", fold).where(F.col("fold") != HELD_OUT)
    total = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}  # two rows
    order = [F.xxhash64("id", F.lit("sample")), F.col("id")]
    chosen = marked.where("toxic").orderBy(*order).limit(max_toxic).unionAll(
        marked.where("NOT toxic").orderBy(*order).limit(max_ordinary))
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), text_or_empty(text_column).alias("text"))
    sample = texts.join(F.broadcast(chosen), "id").limit(2 * (max_toxic + max_ordinary)).toPandas()
    sample = sample.sort_values(["id", "text"], ignore_index=True)
    toxic = sample["toxic"].to_numpy(bool)
    weights = np.where(toxic, total.get(True, 0) / max(1, toxic.sum()), total.get(False, 0) / max(1, (~toxic).sum()))
    return fit(sample["text"].tolist(), toxic, sample["fold"].to_numpy(), weights)


def _scored(batches: Iterator[pd.Series], model: Model) -> Iterator[pd.DataFrame]:
    """score, windows, toxic_windows of each text. What was remembered on the way goes with the task: its Python worker
    lives on, and so would the words and windows beside what later steps need."""
    gaps = _gaps_of(model)
    try:
        for texts in batches:
            out = []
            for text in texts:
                counts = gaps.counts(words_of(text))
                out.append((model.score(share_at(counts, model.gap)), sum(counts.values()),
                            sum(n for g, n in counts.items() if g >= model.gap)))
            yield pd.DataFrame(out, columns=["score", "windows", "toxic_windows"])
    finally:
        gaps.forget()


def toxicity(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Every row of `docs` with all its columns and held_out, score, predicted, windows, toxic_windows.

    score is between 0 and 1 and rises with the share of windows nearer to the toxic dictionary; predicted is 1 from
    0.5. A null or empty text has no windows and the lowest score. Columns of these names in `docs` are replaced.
    held_out is false for a null id.
    """
    added = ("held_out", "score", "predicted", "windows", "toxic_windows")
    kept = [c for c in docs.columns if c not in added]

    @F.pandas_udf("score double, windows long, toxic_windows long")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from _scored(batches, model)

    held_out = F.pmod(F.crc32(F.col(f"`{id_column}`").cast("string")), F.lit(FOLDS)) == HELD_OUT
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       scored(text_or_empty(text_column)).alias("__found"))
    return rows.select(
        *[F.col(f"`{c}`") for c in kept], "held_out", F.col("__found.score").alias("score"),
        (F.col("__found.score") >= 0.5).cast("int").alias("predicted"), F.col("__found.windows").alias("windows"),
        F.col("__found.toxic_windows").alias("toxic_windows"))
