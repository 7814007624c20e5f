"""The corpus pipeline: quality, near duplicates, personal data, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result to the
shared folder as Parquet and reads it again for the next stage. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm import minhash, mixing, packing, private, quality
from parlance.llm.common import stored, table
from parlance.llm.queries import (
    BYTE_END,
    BYTE_TOKENIZER,
    CAPACITY,
    MIX_EPOCHS,
    MIX_WEIGHTS,
    SEED,
    SIMILARITY,
    tokenizer_path,
    training_labels,
)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rates at one half or more."""
    model = quality.train(training_labels(spark, sf_dir, docs))
    return quality.score(docs, model).where(F.col("score") >= 0.5).select("document.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return minhash.deduplicate(docs, SIMILARITY)


def clean_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that give it away replaced; ``n_chars`` follows the text."""
    cleaned = private.clean(docs)
    return cleaned.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.mix(docs, MIX_WEIGHTS, MIX_EPOCHS, SEED)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in the sequences."""
    packed = packing.pack_documents(docs, tokenizer_path(BYTE_TOKENIZER), BYTE_END, CAPACITY)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", clean_private),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# A learned model, sampled signatures and a tokenizer are beyond SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
