"""A training corpus from documents: clean, classify, deduplicate, decontaminate, pack.

Each stage is one of the operators in tessera.llm, works on all that its predecessor kept, and is
written as Parquet before the next one reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, packing, quality_model, quality_rules, simhash
from tessera.llm.common import table, written


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines; n_chars follows the text."""
    kept = quality_rules.clean(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in kept.columns else kept


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking accepts. It is learnt from the labelled documents as they came in, as the
    rules before have removed most of those that are not preferred."""
    return quality_model.accept(docs, quality_model.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), 0.3))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 64-bit fingerprints of four-word shingles at most four
    bits apart, or five-word shingles whose similarity is 0.8 or more, found by wide fingerprints."""
    return simhash.deduplicate(docs, distance=4, width=8, max_share=0.2, wide_shingle=5, least=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no span with a benchmark item."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"), min_items=1)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 ids."""
    return packing.pack(docs, 1024)


STAGES = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("near-duplicates", near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", pack),
]

#: Fingerprints, the classifier and the tokenizer have no SQL form; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
