"""The operators of this package as named queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from paddock.llm import (
    alignment, chat_format, decontaminate, fingerprints, license_scan, line_dedup, near_dedup, packing, pii,
    quality, structure_repair, token_counts, toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_line_dedup", line_dedup.oracle())
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "removed",
                        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op2_token_counts")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts.token_counts(
        table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op3_license_scan", license_scan.oracle())
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_spans(table(spark, folder, "documents")).drop("spans")


@query("op4_packing")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


@query("op5_toxicity")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.learn(docs, table(spark, folder, "labels"))
    return toxicity.toxicity(docs, model).select("doc_id", "held_out", "score", "predicted", "windows", "toxic_windows")


@query("op6_chat_format")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat_format.read_back(*chat_format.format_conversations(rows))


@query("op7_near_dedup")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, folder, "documents"), width=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op9_pii", pii.oracle())
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, folder, "documents")))


@query("op8_decontamination")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.decontamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("text_hash")


@query("op10_fingerprints")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.against_next(table(spark, folder, "documents"))


@query("op11_structure_repair")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return structure_repair.repaired_after_damage(table(spark, folder, "conversations"))


@query("op12_quality")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.learn(docs, table(spark, folder, "labels"))
    return quality.quality(docs, model).select("doc_id", "held_out", "score", "predicted", "n_words")


@query("op13_token_alignment")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.token_alignment(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model"))


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
