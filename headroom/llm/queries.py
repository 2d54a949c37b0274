"""The registered queries ``opN_...`` of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_codec, cap_filters, fingerprints, jaccard_join, license_scan, line_dedup, packing, secret_scan, spelling_variants, suffix_dedup, token_files, toxicity, vector_codes
from .common import documents

LINE_SQL = r"""
WITH lines AS (SELECT doc_id, unnest(generate_series(1, len(l))) AS k, unnest(l) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
firsts AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT doc_id, k, line, coalesce(doc_id <> first, false) AS gone FROM keyed LEFT JOIN firsts USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM marked GROUP BY doc_id
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op8_line_dedup": LINE_SQL}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded and decoded again: how many ids, and digests of the ids and of the decoded bytes."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = bpe_codec.encode(documents(spark, folder), ranks, public_tokenizers.PATTERN)
    return bpe_codec.decode(tokens, ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), bpe_codec.ids_sha256(F.col("ids")).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the size of their set of 5-word shingles and the component that its links reach."""
    return jaccard_join.similar_sets(documents(spark, folder), width=5, share=(75, 100))


@query
def op3_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the bytes of 100-byte strings that also start earlier."""
    out = suffix_dedup.drop_repeats(documents(spark, folder), width=100)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token files of all documents, read back: where each starts, its length, the crc32 of its ids."""
    path = token_files.token_files(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.with_crc(token_files.read_tokens(spark, path))


@query
def op5_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how like they are."""
    return fingerprints.fingerprints(documents(spark, folder))


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of all documents; labels of held-out rows are not learned from."""
    docs = documents(spark, folder)
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scored = toxicity.score(docs.select("doc_id", "text"), model, keep=("doc_id",))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in all documents: counts and digest of the fixed patterns' spans, and all spans."""
    found = secret_scan.scan(documents(spark, folder).select("doc_id", "text"), keep=("doc_id",))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = secret_scan.joined(F.col("spans"), secret_scan.KINDS[:3])
    return found.select("doc_id", *map(count, secret_scan.KINDS[:3]), F.sha2(base, 256).alias("base_sha256"), secret_scan.joined(F.col("spans"), secret_scan.KINDS).alias("spans"))


@query
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the lines that an earlier document has."""
    out = line_dedup.drop_lines(documents(spark, folder).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op9_cap_filters(spark: SparkSession, folder: str) -> DataFrame:
    """All vectors with their links of cosine 0.93 or more within the label, and the component these reach."""
    return cap_filters.near_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"), threshold=0.93)


@query
def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    placed = packing.packed_documents(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """All words of seven letters or more that occur twice or more, with the more frequent words they vary."""
    return spelling_variants.spelling_variants(documents(spark, folder))


@query
def op12_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License wordings in all documents: where the fixed phrases stand, and the labels of all signature rules."""
    found = license_scan.scan(documents(spark, folder).select("doc_id", "text"))
    base = F.transform("base", lambda p: p["label"])
    more = F.transform("detections", lambda d: d["label"])
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda p: p["start"])).alias("first_word"), F.array_max(F.transform("base", lambda p: p["start"])).alias("last_word"),
        license_scan.label_list(base).alias("base_labels"), license_scan.label_list(F.concat(base, more)).alias("labels"), "score")


@query
def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of all vectors, their errors, and a digest of the codebooks."""
    coded, books = vector_codes.compress(spark.read.parquet(f"{folder}/embeddings.parquet"))
    return coded.select(
        F.col("id").alias("vec_id"), vector_codes.hex_code(F.col("code")).alias("code"), "error", "label_error",
        F.lit(vector_codes.codebooks_sha256(books)).alias("codebooks_sha256"))
