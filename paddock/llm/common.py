"""Helpers that several operators share: stored tables, row keys, word hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

MAX_CACHED_WORDS = 400_000  # entries of one task's word cache; it is emptied and filled anew beyond


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="paddock-llm-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only in local mode, where all tasks see it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
        return _own_folder()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


_group: list[str] | None = None  # where stored() notes its paths


@contextmanager
def noting(paths: list[str]) -> Iterator[None]:
    """Note the paths of all tables that are stored meanwhile, so that their owner can remove them."""
    global _group
    before, _group = _group, paths
    try:
        yield
    finally:
        _group = before


def stored(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write a table that later passes read, and go on from its files: lineage ends here, lost executors cost nothing."""
    path = f"{shared_folder(df.sparkSession)}/paddock-llm-{uuid.uuid4().hex}"
    if _group is not None:
        _group.append(path)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables that nothing will read again."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    paths.clear()


def remove(*tables: DataFrame) -> None:
    """Delete the files of stored tables that nothing will read again."""
    for df in tables:
        names = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        remove_paths(df.sparkSession, [n for n in names if "/paddock-llm-" in n])


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def map_rows(
    df: DataFrame, step: Callable[[Iterator[dict[str, list]]], Iterator[list[tuple]]], schema: str
) -> DataFrame:
    """Run `step` in each task over batches of rows: columns of plain values in, lists of row tuples out.

    Arrow carries the batches. Unlike in pandas, a long column with nulls stays exact.
    """
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = ({n: b.column(n).to_pylist() for n in b.schema.names} for b in batches)
        for rows in step(plain):
            columns = zip(*rows) if rows else [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


class WordHashes(dict):
    """64-bit hash of a word, remembered; bounded in size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def ascii_words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(count: int, seed: int) -> np.ndarray:
    """Fixed odd 64-bit multipliers, derived from a seed."""
    return mixed(np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))) | np.uint64(1)


def shingle_hashes(words: np.ndarray, width: int, seed: int = 7) -> np.ndarray:
    """Hash of every run of `width` words; of the whole sequence if it is shorter; empty without words."""
    n = len(words)
    if n == 0:
        return words
    size = min(width, n)
    factors = odd_numbers(size, seed)
    total = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        total = total + mixed(words[k:n - size + 1 + k] + factors[k]) * factors[k]
    return mixed(total)
