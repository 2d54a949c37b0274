"""Repeated lines lose all copies but those of the first document; a sharded minimal perfect hash answers which."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import stored
from .common import bound_batches, mix, text_slices

MIN_CHARS = 10
SHARD_KEYS = 50_000
SHARD_PROBES = 250_000
HEAVY = 4096
_GAMMA = 2.0


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit hash of the line, stripped of ASCII white space and A-Z lower-cased; None if the key is too short."""
    key = line.strip().lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bits, a key settles where it is alone.

    ``blob`` is all of it: the level sizes and the packed bits, about 4 bits a key.
    """

    def __init__(self, blob: bytes):
        levels = int(np.frombuffer(blob, "<u4", 1)[0])
        self.sizes = np.frombuffer(blob, "<u4", levels, 4).astype(np.int64)
        self.bits = np.unpackbits(np.frombuffer(blob, np.uint8, offset=4 + 4 * levels), count=int(self.sizes.sum())).astype(bool)
        self.rank = np.concatenate([[0], np.cumsum(self.bits)])

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> bytes:
        sizes, bits = [], []
        while len(keys):
            if len(sizes) > 200:
                raise ValueError("keys are not distinct")
            size = max(8, int(_GAMMA * len(keys)))
            place = cls._place(keys, len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            keys = keys[~alone[place]]
        packed = np.packbits(np.concatenate(bits)) if bits else np.zeros(0, np.uint8)
        return np.array([len(sizes), *sizes], "<u4").tobytes() + packed.tobytes()

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number from 0; -1 for some, and any number for other, keys that are not in it."""
        out = np.full(len(keys), -1, np.int64)
        open_, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(open_):
                break
            at = base + self._place(keys[open_], level, size)
            hit = self.bits[at]
            out[open_[hit]] = self.rank[at[hit]]
            open_, base = open_[~hit], base + size
        return out


class LineIndex:
    """One shard: the perfect hash over the low key halves; by its numbers the high halves, first documents and counts."""

    def __init__(self, blob: dict):
        self.hash = PerfectHash(blob["levels"])
        self.fingerprint = np.frombuffer(blob["fingerprints"], "<u8")
        self.first = np.frombuffer(blob["firsts"], "<i8")
        self.count = np.frombuffer(blob["counts"], "<u4")

    @staticmethod
    def build(lo: np.ndarray, hi: np.ndarray, first: np.ndarray, count: np.ndarray) -> dict:
        levels = PerfectHash.build(lo)
        at = PerfectHash(levels).index(lo)
        by = np.argsort(at)
        return {"levels": levels, "fingerprints": hi[by].astype("<u8").tobytes(), "firsts": first[by].astype("<i8").tobytes(),
                "counts": np.minimum(count[by], 2**32 - 1).astype("<u4").tobytes()}

    def probe(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is in the shard, and its first document."""
        at = self.hash.index(lo)
        there = at >= 0
        there[there] = self.fingerprint[at[there]] == hi[there]
        return there, np.where(there, self.first[np.maximum(at, 0)] if len(self.first) else 0, 0)


def _halves(keys: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(keys, "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _slice_lines(batch: pa.RecordBatch, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(low half, high half, doc_id) of the distinct keys of each document of a slice; rows without an id have none."""
    keys, docs, n = [], [], []
    for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
        if doc is not None and text:
            own = {k for line in text.split(b"\n") if (k := line_key(line, min_chars)) is not None}
            keys.extend(own)
            docs.append(doc)
            n.append(len(own))
    lo, hi = _halves(b"".join(keys))
    return lo, hi, np.repeat(np.array(docs, np.int64), n)


def line_counts(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``lo, hi, first, n``: keys found in at least two documents, their smallest document and the number of rows.

    Each slice of texts is reduced to its distinct keys before the shuffle, so a line of all documents
    is one row a slice.
    """
    def count(batches):
        for batch in text_slices(batches):
            lo, hi, doc = _slice_lines(batch, min_chars)
            order = np.lexsort((doc, hi, lo))
            lo, hi, doc = lo[order], hi[order], doc[order]
            new = np.ones(len(lo), bool)
            new[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
            at = np.flatnonzero(new)
            end = np.append(at[1:], len(lo)) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(lo[at].view(np.int64)), pa.array(hi[at].view(np.int64)), pa.array(doc[at]), pa.array(doc[end - 1] if len(at) else doc[at]), pa.array(end - at)],
                                             names=["lo", "hi", "first", "last", "n"])

    found = docs.mapInArrow(count, "lo long, hi long, first long, last long, n long")
    return found.groupBy("lo", "hi").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")).where("first <> last").drop("last")


def _shard_of(lo, hi, shards: int):
    return ((lo ^ (hi >> np.uint64(7))) % np.uint64(shards)).astype(np.int64)


SHARD = "shard int, levels binary, fingerprints binary, firsts binary, counts binary"


def build_shards(counts: DataFrame, shards: int) -> DataFrame:
    """One row per shard. Shards are dealt by hash and sized by the caller, so that each is a few megabytes."""
    def build(key, table):
        lo, hi = table.column("lo").to_numpy().view(np.uint64), table.column("hi").to_numpy().view(np.uint64)
        blob = LineIndex.build(lo, hi, table.column("first").to_numpy(), table.column("n").to_numpy())
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32())} | {k: pa.array([v], pa.binary()) for k, v in blob.items()})

    # the shard of a key is computed where the documents compute it: in numpy
    def number(batches):
        for b in batches:
            lo, hi = (b.column(c).to_numpy().view(np.uint64) for c in ("lo", "hi"))
            yield pa.RecordBatch.from_arrays([pa.array(_shard_of(lo, hi, shards), pa.int32()), *(b.column(c) for c in ("lo", "hi", "first", "n"))],
                                             names=["shard", "lo", "hi", "first", "n"])

    numbered = counts.select("lo", "hi", "first", "n").mapInArrow(number, "shard int, lo long, hi long, first long, n long")
    return numbered.groupBy("shard").applyInArrow(build, SHARD)


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, drop``: for each document, the 16-byte keys of the lines that it must lose.

    ``docs`` has ``doc_id`` and ``text``. The documents send each shard one packet of keys a slice; the shard
    probes its arrays and answers the documents. Keys of more than a ``HEAVY``-th of all probes, of which there
    are at most ``HEAVY``, are probed in every task by an index of their own, so no shard gets a hot line.
    """
    spark = docs.sparkSession
    counts = stored(line_counts(docs, min_chars), "lines")
    keys, probes = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    shards = max(1, math.ceil(keys / SHARD_KEYS), math.ceil(probes / SHARD_PROBES))
    limit = max(64, probes // HEAVY)
    heavy = counts.where(F.col("n") > limit).collect()  # at most HEAVY rows: their n sum to no more than probes
    index = spark.sparkContext.broadcast(LineIndex.build(
        *(np.array([getattr(r, c) for r in heavy], np.int64).view(np.uint64) for c in ("lo", "hi")), *(np.array([getattr(r, c) for r in heavy], np.int64) for c in ("first", "n"))))
    blobs = build_shards(counts.where(F.col("n") <= limit), shards)

    def packets(batches, index=index):
        known = LineIndex(index.value)
        for batch in text_slices(batches):
            lo, hi, doc = _slice_lines(batch, min_chars)
            there, first = known.probe(lo, hi)
            shard = np.where(there, -1, _shard_of(lo, hi, shards))
            order = np.argsort(shard, kind="stable")
            order = order[np.searchsorted(shard[order], -1, side="right") :]
            answer = np.flatnonzero(there & (first != doc))
            out = [(-1, np.stack([doc[answer].view(np.uint64), lo[answer], hi[answer]], 1).tobytes())] if len(answer) else []
            cuts = np.flatnonzero(np.diff(shard[order], prepend=-2))
            # a slice may hold short, empty or heavy lines only: then there is no cut and no end
            for a, b in zip(cuts, [*cuts[1:], *([len(order)] if len(order) else [])], strict=True):
                o = order[a:b]
                out.append((int(shard[o[0]]), np.stack([doc[o].view(np.uint64), lo[o], hi[o]], 1).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], names=["shard", "packet"])

    def probe(packets, blob):
        found = []
        if blob.num_rows:
            known = LineIndex(blob.to_pylist()[0])
            for raw in packets.column("packet").to_pylist():
                rows = np.frombuffer(raw, "<u8").reshape(-1, 3)
                there, first = known.probe(rows[:, 1].copy(), rows[:, 2].copy())
                found.append(rows[there & (first != rows[:, 0].view(np.int64))])
        return _answers(found)

    def direct(batches):
        for b in batches:
            yield from _answers([np.frombuffer(raw, "<u8").reshape(-1, 3) for raw in b.column("packet").to_pylist()]).to_batches()

    sent = stored(docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(packets, "shard int, packet binary"), "packets")
    light = sent.where("shard >= 0").groupBy("shard").cogroup(blobs.groupBy("shard")).applyInArrow(probe, "doc_id long, line binary")
    answers = light.unionByName(sent.where("shard < 0").mapInArrow(direct, "doc_id long, line binary"))
    return answers.groupBy("doc_id").agg(F.collect_set("line").alias("drop"))


def _answers(found: list[np.ndarray]) -> pa.Table:
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.uint64)
    raw = np.ascontiguousarray(rows[:, 1:]).tobytes()
    return pa.table({"doc_id": pa.array(rows[:, 0].copy().view(np.int64)), "line": pa.array([raw[k : k + 16] for k in range(0, len(raw), 16)], pa.binary())})


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """All rows and columns of ``docs`` with repeated lines gone, plus ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line without white space at both ends, A-Z lower-cased. Keys of at least ``min_chars``
    code points found in two documents or more lose all lines except in the document of the smallest id.
    A null text is one empty line; rows without an id neither count nor lose lines; rows that share an id
    are one document. ``n_lines`` and ``n_dropped`` replace columns of these names.
    """
    bound_batches(docs)
    others = [c for c in docs.columns if c not in (id_col, text_col, "n_lines", "n_dropped")]
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.struct(*others, F.lit(1).alias("__")).alias("row"))
    drops = repeated_lines(base.select("doc_id", "text"), min_chars)
    joined = base.join(drops, "doc_id", "left")

    def rewrite(batches):
        for batch in text_slices(batches):
            kept, total, gone = [], [], []
            for text, drop in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("drop").to_pylist(), strict=True):
                if not drop:
                    kept.append(text)
                    total.append(text.count(b"\n") + 1)
                    gone.append(0)
                    continue
                lines, drop = text.split(b"\n"), set(drop)
                left = [x for x in lines if line_key(x, min_chars) not in drop]
                kept.append(b"\n".join(left))
                total.append(len(lines))
                gone.append(len(lines) - len(left))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(kept, pa.binary()).cast(pa.string()), batch.column("row"), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                             names=["doc_id", "text", "row", "n_lines", "n_dropped"])

    row = base.schema["row"].dataType.simpleString()
    out = joined.mapInArrow(rewrite, f"doc_id long, text string, row {row}, n_lines long, n_dropped long")
    names = {id_col: F.col("doc_id").alias(id_col), text_col: F.col("text").alias(text_col)} | {c: F.col("row").getField(c).alias(c) for c in others}
    return out.select(*(names[c] for c in docs.columns if c in names), "n_lines", "n_dropped")
