"""A training corpus from raw documents, in five stages.

Every stage reads what its predecessor wrote. Toxicity rejects documents by their
score; near-dedup keeps one document of every group; decontamination rejects
documents with a benchmark passage; the secret scan replaces secrets by their
kind; packing turns what is left into sequences of token pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layertables.llm import decontam, packing, secrets, simhash, toxicity
from layertables.llm.common import table, written
from layertables.llm.tokens import public_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn_from=~toxicity.held_out())
    return toxicity.reject_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.reject_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_path("byte_bpe_50k.json"), end_id=0, max_tokens=2048)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: SQL can't express the learned score, the tokenizer or the fitted packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
