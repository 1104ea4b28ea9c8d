"""A training corpus from raw documents: quality, near copies, benchmark passages, personal data, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import bpe, decontaminate, fertility, pii, simhash
from millrace.llm.queries import PIECES, WORD_BPE
from millrace.llm.words import fresh, stored

# SQL cannot express piece vocabularies or fingerprints; tests compare with plain Python.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    name = fresh(docs, "quality")
    judged = fertility.measured(docs, PIECES, name=name)
    return judged.where(F.col(name)["kept"]).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    return simhash.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more benchmark text than the contamination rule allows."""
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced; ``n_chars`` follows the text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of them and of the decoded text."""
    made = bpe.decode(bpe.encode(docs, WORD_BPE), WORD_BPE)
    return bpe.digests(made, "ids")


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_copies),
    ("benchmark decontamination", benchmark_free),
    ("personal data", no_personal_data),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
