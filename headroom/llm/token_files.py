"""Token ids as Parquet files: list columns, chosen encodings and row groups, metadata readable without the ids."""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sizing import scratch
from .common import id_text, text_slices
from .words_bpe import file_encoder, id_column, with_end

TOKENS = "doc_id long, part int, row long, before long, n_tokens long, ids array<int>"


def encode_documents(docs: DataFrame, tokenizer_json: str, words: bool, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every whole text in ascending ``doc_id`` order, ``end_id`` last.

    Range-partitioned by ``doc_id``; ``part`` is the partition, ``row`` the place in it and ``before`` the
    ids of the part's earlier rows. A null text is empty; rows of equal ``doc_id`` are ordered by text; null
    ids come first. Only rows of one Arrow slice and a bounded cache are in memory.
    """
    content = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # one tokenizer file, under 2 MB

    def encode(batches, content=content):
        encoder = file_encoder(content.value, words)
        part, row, before = TaskContext.get().partitionId(), 0, 0
        for batch in text_slices(batches):
            ids, at = with_end(*encoder.encode(batch.column("text")), end_id)
            n, start = np.diff(at), before + at[:-1]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.full(len(n), part, np.int32)), pa.array(row + np.arange(len(n))), pa.array(start), pa.array(n), id_column(ids, at)],
                names=["doc_id", "part", "row", "before", "n_tokens", "ids"])
            row, before = row + len(n), int(start[-1] + n[-1])

    # the range partitioner samples its input, so the texts are partitioned before they are encoded
    ordered = id_text(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(encode, TOKENS)


def write_tokens(tokens: DataFrame, path: str, row_group_bytes: int = 16 << 20, page_bytes: int = 256 << 10, dictionary: bool = True) -> None:
    """Write the id lists. Ids are dictionary-coded while a chunk's dictionary fits a page, else (or with
    ``dictionary=False``) delta-coded; column and offset indexes let a reader skip pages by ``doc_id`` or ``part``."""
    (tokens.write.option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
     .option("parquet.dictionary.page.size", 1 << 20).option("parquet.enable.dictionary", str(dictionary).lower())
     .option("parquet.writer.version", "PARQUET_2_0").option("compression", "zstd").parquet(path))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, part, row, start, n_tokens)``: the id columns are not read. ``start`` counts the ids of all rows before.

    Starts inside a part are stored; the totals of the parts, one row for each file, are summed up and broadcast.
    """
    index = spark.read.schema(TOKENS).parquet(path).select("doc_id", "part", "row", "before", "n_tokens")
    return index.join(_bases(index), "part").select("doc_id", "part", "row", (F.col("base") + F.col("before")).alias("start"), "n_tokens")


def _bases(index: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    return F.broadcast(totals.select("part", F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base")))


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of the documents from ``first`` to ``last`` (both included); other pages are skipped."""
    tokens = spark.read.schema(TOKENS).parquet(path)
    bases = _bases(tokens.select("part", "n_tokens"))
    if first is not None:
        tokens = tokens.where(F.col("doc_id") >= first)
    if last is not None:
        tokens = tokens.where(F.col("doc_id") <= last)
    return tokens.join(bases, "part").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids")


def _crc(batches, column: str):
    for batch in batches:
        lists = batch.column(column)
        ids = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
        crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names if c != column), pa.array(crc, pa.int64())],
                                         names=[*(c for c in batch.schema.names if c != column), f"{column}_crc32"])


def with_crc(tokens: DataFrame, column: str = "ids") -> DataFrame:
    """The id lists replaced by the crc32 of their little-endian 32-bit bytes, as ``<column>_crc32``."""
    kept = [f for f in tokens.schema.fields if f.name != column]
    return tokens.mapInArrow(partial(_crc, column=column), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", `{column}_crc32` long")


def token_files(docs: DataFrame, tokenizer_file: str, end_id: int = 1, words: bool = True, path: str | None = None) -> str:
    """Encode ``docs`` and write the token files; returns their path (a new one in the shared folder by default)."""
    path = path or scratch(docs.sparkSession, "tokens")
    with open(tokenizer_file, encoding="utf-8") as f:
        content = f.read()
    write_tokens(encode_documents(docs, content, words, end_id), path)
    return path
