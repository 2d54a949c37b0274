"""Byte-level BPE over overlapping chunks: pre-tokenise in parallel, stitch where boundaries agree, encode, decode."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, spread, text_slices, worker_state
from .words_bpe import BYTE_PATTERN, RankEncoder, id_column

CHUNK_CHARS = 1 << 15
OVERLAP_CHARS = 1 << 9


def _encoder(content: bytes, pattern: str) -> RankEncoder:
    return worker_state(f"ranks_{hash((content, pattern))}", lambda: RankEncoder(content, pattern))


def boundaries(text: str, pattern) -> np.ndarray:
    """Where the pre-tokens of ``text`` begin, and its end; the matches of the pattern cover the text."""
    return np.concatenate([[0], np.cumsum([len(p) for p in pattern.findall(text)])]).astype(np.int64)


def _chunks(batches, chunk: int, overlap: int):
    """Rows of texts in chunks that each reach ``overlap`` characters into the next one."""
    for batch in text_slices(batches):
        out = []
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
            starts = range(0, max(1, len(text) - overlap), chunk)
            out.extend((row, k, a, text[a : a + chunk + overlap] if k + 1 < len(starts) else text[a:]) for k, a in enumerate(starts))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.string()), strict=True)], names=["row", "chunk", "start", "text"])


def _joints(batches, content, pattern: str, chunk: int, overlap: int):
    """Each chunk with its pre-token boundaries (places in the text) in its first and its last ``overlap`` characters."""
    for batch in text_slices(batches):
        cut = _encoder(content.value, pattern).pattern
        head, tail = [], []
        for start, text in zip(batch.column("start").to_pylist(), batch.column("text").to_pylist(), strict=True):
            b = boundaries(text, cut)
            # the last pre-token and the one before it may look different when more text follows
            head.append(start + b[:-2][b[:-2] <= overlap])
            tail.append(start + b[:-2][b[:-2] >= chunk])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(head, pa.list_(pa.int64())), pa.array(tail, pa.list_(pa.int64()))], names=[*batch.schema.names, "head", "tail"])


def _encode(batches, content, pattern: str, keep: list[str]):
    for batch in text_slices(batches):
        encoder = _encoder(content.value, pattern)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), id_column(*encoder.encode(batch.column("text")))], names=[*keep, "ids"])


def encode(docs: DataFrame, rank_file: str, pattern: str = BYTE_PATTERN, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the token ids of every row's whole text, a null text being empty, as the rank file's library gives.

    Texts of one chunk are encoded where they lie. Longer ones are cut into overlapping chunks, dealt over
    all tasks and pre-tokenised there. Two neighbours are stitched at the first boundary that both found in
    their overlap: the pattern looks ahead only, so from there on both agree. Each chunk then encodes the
    pieces between its two joints. A text with a joint that found no common boundary (a pre-token longer
    than the overlap) is put together again and encoded whole; a text fits a row, and so a task.
    """
    spark = docs.sparkSession
    with open(rank_file, "rb") as f:
        content = spark.sparkContext.broadcast(f.read())  # one rank file, under 1 MB
    base = id_text(docs, id_col, text_col)
    limit = chunk + overlap
    short = base.where(F.length("text") <= limit).mapInArrow(lambda b: _encode(b, content, pattern, ["doc_id"]), "doc_id long, ids array<int>")

    # rows may share an id, so long texts are named by a number of their own: id and text decide it, copies are alike
    long = base.where(F.length("text") > limit).withColumn("row", F.xxhash64("text", F.lit(7)))
    names = long.groupBy("row", "doc_id").agg(F.count("*").alias("copies"))
    distinct = long.dropDuplicates(["row"]).select("row", "text")
    cut = spread(distinct.mapInArrow(lambda b: _chunks(b, chunk, overlap), "row long, chunk int, start long, text string"), "row", "chunk")
    joints = cut.mapInArrow(lambda b: _joints(b, content, pattern, chunk, overlap), "row long, chunk int, start long, text string, head array<bigint>, tail array<bigint>")
    along = Window.partitionBy("row").orderBy("chunk")
    joints = joints.withColumn("begin", F.when(F.col("chunk") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect("head", F.lag("tail").over(along)))))
    joints = joints.withColumn("end", F.lead("begin").over(along)).withColumn("last", F.lead("chunk").over(along).isNull())
    lost = F.max(F.col("begin").isNull()).over(Window.partitionBy("row"))
    # where a joint is missing, every chunk gives its own characters and the text is encoded as one
    joints = joints.withColumn("lost", lost).withColumn("begin", F.when(F.col("lost"), F.col("start")).otherwise(F.col("begin")))
    joints = joints.withColumn("end", F.when(F.col("last"), F.col("start") + F.length("text")).when(F.col("lost"), F.col("start") + chunk).otherwise(F.col("end")))
    pieces = joints.select("row", "chunk", "lost", F.expr("substring(text, cast(begin - start + 1 as int), cast(end - begin as int))").alias("text"))
    whole = pieces.where("lost").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("chunk", "text"))).alias("c")).select("row", F.lit(0).alias("chunk"), F.array_join("c.text", "").alias("text"))
    pieces = pieces.where("not lost").select("row", "chunk", "text").unionByName(whole)
    parts = pieces.mapInArrow(lambda b: _encode(b, content, pattern, ["row", "chunk"]), "row long, chunk int, ids array<int>")
    texts = parts.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("c")).select("row", F.flatten("c.ids").alias("ids"))
    copies = texts.join(names, "row").select("doc_id", "ids", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")
    return short.unionByName(copies)


def decode(tokens: DataFrame, rank_file: str, column: str = "ids") -> DataFrame:
    """``tokens`` with ``decoded``, the bytes of the ids of ``column`` one after the other; null for null ids."""
    with open(rank_file, "rb") as f:
        content = tokens.sparkSession.sparkContext.broadcast(f.read())  # one rank file, under 1 MB

    tokens = tokens.drop("decoded")

    def table():
        import base64

        ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, content.value.splitlines())}
        return [ranks.get(k, b"") for k in range(max(ranks) + 1)]

    def run(batches):
        for batch in batches:
            words = worker_state(f"words_{hash(content.value)}", table)
            lists = batch.column(column)
            out = [None if ids is None else b"".join(map(words.__getitem__, ids.values.to_numpy(zero_copy_only=False).tolist())) for ids in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    return tokens.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema.fields) + ", decoded binary")


def ids_sha256(ids: Column) -> Column:
    """Hex SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)
