"""The corpus pipeline: stages over the documents table, each on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import decontam, lines, quality, sentencepieces, simhash
from tallyhouse.llm.queries import tokenizer_file
from tallyhouse.llm.shared import stored

#: SQL cannot express the last stages; the tests hold the result against a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy rejects go."""
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go; a document stays, with the number of characters it has left."""
    left = lines.dedup(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.keep_one(docs, words=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the ids of the text."""
    vocabulary = sentencepieces.load(tokenizer_file())
    rows = sentencepieces.encode_documents(docs.select("doc_id", "lang", "source", "text"), vocabulary)
    return rows.select("doc_id", "lang", "source", "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("sentencepiece_encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between stages the rows are a Parquet table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
