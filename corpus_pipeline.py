"""A corpus from raw documents to token ids: five stages, each on what the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's docs. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandframe.llm import decontaminate, ngram_join, pii, quality, sentencepiece_scan
from strandframe.session import scratch_path

#: Near copies of the pipeline: shingles of five words, similarity of 0.8 or more.
NEAR = ngram_join.Rule(words=5, num=80, den=100)


def with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.quality_rules(docs).filter("kept").select(*docs.columns)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked documents the one with the smallest id; rows that repeat it go too."""
    return ngram_join.keep_first(docs, rule=NEAR)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents that consist of them mostly go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return with_length(decontaminate.remove_overlap(docs, benchmark)).select(*docs.columns)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return with_length(pii.redact(docs)).select(*docs.columns)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text."""
    model = sentencepiece_scan.Pieces.read(sentencepiece_scan.default_model())
    return sentencepiece_scan.encode(docs, model).select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_duplicates_stage),
    ("benchmark decontamination", decontamination_stage),
    ("personal data", personal_data_stage),
    ("SentencePiece encoding", tokens_stage),
]

#: Language model, link classes and merges are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
