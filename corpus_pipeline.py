"""Corpus pipeline: documents through four filtering stages and an encoding one, each written and read again as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm import minhash, pieces, positional, quality, secrets
from zoneflow.llm.scratch import Scratch

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
QUALITY_THRESHOLD = 0.3


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier scores below 0.3; it learns from the labels of rows that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~quality.held_out())
    return quality.accepted(docs, quality.fit(docs, labels), QUALITY_THRESHOLD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group: five-word shingles, similarity of 0.8 or more."""
    return minhash.keep_one(docs, minhash.Params(shingle=5, percent=80, rows=4, bands=28))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth of the words lie in 13-word windows of benchmark items."""
    return positional.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; a changed text's length is counted anew."""
    changed = secrets.redact(docs)
    return changed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else changed


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode each text; the rows hold the ids beside the documents' columns but the text."""
    return pieces.encode(docs, PIECE_MODEL).drop("text")


STAGES = [
    ("quality_classifier", quality_filter),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("secret_scans", redact_secrets),
    ("sentencepiece", encode_pieces),
]

# The classifier, whose weights come from an iterative fit, has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; returns the last stage's rows."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs
