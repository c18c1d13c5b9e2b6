"""A corpus from raw documents to packed sequences: toxicity, line dedup, near-duplicates, decontamination, packing."""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paddock.llm import common, decontaminate, line_dedup, near_dedup, packing, toxicity  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_working: dict[str, list[str]] = {}  # tables that the stage before has stored, by input folder


def stage(step: Stage, first: bool = False) -> Stage:
    """A stage that first removes the working tables of the stage before it, whose result has been written by now.

    The first stage begins a chain of its own and removes nothing, so an earlier run's result stays readable. Tables that
    `docs` itself is still read from stay as well.
    """
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        before = [] if first else _working.get(sf_dir, [])
        if before:
            read = set(re.findall(r"paddock-llm-[0-9a-f]+", " ".join(docs.inputFiles())))
            common.remove_paths(spark, [p for p in before if p.rsplit("/", 1)[-1] not in read])
        mine = _working[sf_dir] = []
        with common.noting(mine):
            return step(spark, docs, sf_dir)

    return run_stage


@partial(stage, first=True)
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.toxicity(docs, model).where("predicted = 0").select(*docs.columns)


@stage
def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeats(docs)


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.distinct_documents(docs)


@stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("line_dedup", cut_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

ORACLE_SQL = None  # SQL can express neither the toxicity scores nor the token ids


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each result is written and read again as the documents of the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, step in STAGES[:-1]:
        docs = common.stored(step(spark, docs, sf_dir))
        if before is not None:
            common.remove(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
