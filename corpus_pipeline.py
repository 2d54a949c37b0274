"""A corpus pipeline over ``documents``: toxic documents go, repeated lines go, one document of each group of near
copies stays, secrets are masked, and what is left is packed into sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headroom.functions.sizing import stored
from headroom.llm import jaccard_join, line_dedup, packing, secret_scan, toxicity

TOXIC = 0.7
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Toxicity, masking and packing are learned or computed by models that SQL cannot state.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at or above ``TOXIC`` go; the labels of the corpus teach the score."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs.select(*COLUMNS), model, name="toxic_score")
    return scored.where(F.col("toxic_score") < TOXIC).drop("toxic_score")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go; documents stay, however short they get."""
    return _counted(line_dedup.drop_lines(docs.select(*COLUMNS)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.75 of five-word shingles that of the smallest id stays."""
    return jaccard_join.one_of_each(docs.select(*COLUMNS))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; documents stay."""
    return _counted(secret_scan.mask(docs.select(*COLUMNS)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their place in sequences of 1024 tokens."""
    placed = packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written as Parquet and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
