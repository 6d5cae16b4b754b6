"""From raw documents to token ids, in five stages; each stage's result is stored and read again by the next.

The first four drop documents and return the columns of ``documents``; the last returns the ids and decoded texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hitlens.llm import chunk_codec, quality_ledger, simhash_variants, suffix_decontamination, toxicity_models
from hitlens.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current rule policy keeps."""
    return quality_ledger.kept_documents(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity_models.ordinary(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash_variants.deduplicated(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return suffix_decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, the text they decode to, and their count."""
    return chunk_codec.coded(docs, chunk_codec.model_path())


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("sentencepiece encoding and decoding", sentencepiece_codec),
]

# fitted models and hash fingerprints are beyond SQL; tests hold the pipeline against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
