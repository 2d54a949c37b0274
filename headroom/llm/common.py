"""Helpers of the corpus operators: Arrow slices, worker-side caches, word hashes, connected components."""

from __future__ import annotations

import ctypes
import sys
import types
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import forget, stored

SLICE_BYTES = 4 << 20
BATCH_ROWS = 1000
PARTITION_ROWS = 200_000


def documents(spark, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text``, whatever else the table holds; a null text is empty."""
    bound_batches(docs)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def bound_batches(docs: DataFrame) -> None:
    """Let Python workers get Arrow batches of at most ``BATCH_ROWS`` rows, so that long texts do not fill their memory."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``limit`` bytes of text. A longer text is a slice of its own, so memory follows the longest row.

    After the last one freed memory goes back to the system: an idle worker keeps no more than its state.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(np.maximum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), 1))
        at, done = 0, 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(size, done + limit, side="right")))
            yield batch.slice(at, end - at)
            at, done = end, int(size[end - 1])
    give_back()


def give_back() -> None:
    """Return what Arrow and the C library have freed but kept."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim is not None:
        trim(0)


def worker_state(name: str, make: Callable[[], object], alone: bool = False):
    """One object per Python worker and name, kept between the tasks it runs (models, caches).

    An object made ``alone`` drops what earlier stages have left in the worker.
    """
    home = sys.modules.setdefault("_headroom_worker", types.ModuleType("_headroom_worker"))
    if not hasattr(home, name):
        if alone:
            for old in [k for k in vars(home) if not k.startswith("__")]:
                delattr(home, old)
            give_back()
        setattr(home, name, make())
    return getattr(home, name)


def partitions_for(rows: int, per_partition: int = PARTITION_ROWS) -> int:
    return max(1, -(-rows // per_partition))


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Hash-partition by ``columns`` into the session's number of shuffle partitions."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def binary_column(parts: Sequence[bytes]) -> pa.Array:
    return pa.array(parts, type=pa.binary())


# Words and their hashes --------------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_P = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
_KEPT_POWERS = (1 << 20) + 1  # for slices of 1 MB; longer texts make their own


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def make(n):
        up, down = np.full(n, _P), np.full(n, _INVERSE)
        up[0] = down[0] = 1
        return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)

    return make(n) if n > _KEPT_POWERS else worker_state("powers", lambda: make(_KEPT_POWERS))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without nulls, one after the other, and its offsets from 0."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, of all rows, and each row's first word.

    The second array has one entry more than the column has rows. Polynomial prefix sums give every
    word's value in a few passes over the bytes; a word never crosses a row.
    """
    data, offsets = column_bytes(column)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(column) + 1, np.int64)
    word = ~_SPACE[data]
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < n]
    starts[inner] = word[inner]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    ends[inner[inner > 0] - 1] = word[inner[inner > 0] - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    value = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    return value, np.searchsorted(start, offsets)


def shingles(column: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word shingles of each row as sorted 64-bit hashes, and each row's first position.

    A row of fewer words is one shingle of all its words; a row without words has none.
    """
    value, first = word_hashes(column)
    rows = len(first) - 1
    words = np.diff(first)
    count = np.where(words >= width, words - width + 1, np.minimum(words, 1))
    at = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(rows), count)
    begin = first[row] + np.arange(at[-1]) - at[row]
    have = np.minimum(words[row], width)
    total = np.zeros(at[-1], np.uint64)
    padded = np.concatenate([value, np.zeros(width, np.uint64)])
    for k in range(width):
        total = np.where(k < have, mix(total * _P + padded[begin + k] + np.uint64(k + 1)), total)
    out, sizes = [], np.zeros(rows, np.int64)
    for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        own = np.sort(total[a:b])
        if len(own) > 1:
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        out.append(own)
        sizes[k] = len(own)
    return np.concatenate(out) if out else total, np.concatenate([[0], np.cumsum(sizes)])


# Frequency sketches ------------------------------------------------------------------------------

SKETCH_BLOCKS = 64


def _squeezed(counts: np.ndarray) -> bytes:
    """Counters in as few bytes each as the largest needs, compressed, behind that number of bytes."""
    x = counts.astype(np.min_scalar_type(int(counts.max(initial=0))))
    return bytes([x.itemsize]) + zlib.compress(x.tobytes(), 1)


def _counters(raw: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw[1:]), f"u{raw[0]}").astype(np.int64)


class Sketch:
    """Counters over hash buckets, kept by a task and sent in compressed blocks."""

    def __init__(self, bits: int):
        self.bits, self.counts = bits, np.zeros(1 << bits, np.int64)

    def add(self, hashes: np.ndarray) -> None:
        np.add.at(self.counts, (hashes >> np.uint64(64 - self.bits)).astype(np.int64), 1)

    def blocks(self) -> tuple[list[int], list[bytes]]:
        cut = self.counts.reshape(SKETCH_BLOCKS, -1)
        some = [k for k in range(SKETCH_BLOCKS) if cut[k].any()]
        return some, [_squeezed(cut[k]) for k in some]


def total_sketch(parts: DataFrame, bits: int) -> np.ndarray:
    """The sum of the ``block, counts`` rows of all tasks: ``2 ** bits`` counters, whatever the size of the table.

    Each block is summed up row by row where its rows meet; the driver gets one row per block.
    """
    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                x = _counters(raw)
                sums[block] = sums[block] + x if block in sums else x
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([_squeezed(x) for x in sums.values()], pa.binary())], names=["block", "counts"])

    out = np.zeros((SKETCH_BLOCKS, (1 << bits) // SKETCH_BLOCKS), np.int64)
    for r in spread(parts.select("block", "counts"), "block").mapInArrow(add, "block int, counts binary").collect():
        out[r.block] += _counters(bytes(r.counts))
    return out.ravel()


def bucketed(values: np.ndarray, count: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Sorted distinct hashes cut by their high bits: for each bucket all of them, and those counted more than once."""
    cut = np.searchsorted(values, np.array([k * (2**64 // buckets) for k in range(1, buckets)], np.uint64))
    parts = [(k, x.astype("<u8").tobytes(), x[c > 1].astype("<u8").tobytes()) for k, (x, c) in enumerate(zip(np.split(values, cut), np.split(count, cut), strict=True)) if len(x)]
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in parts], t) for k, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], names=["bucket", "grams", "again"])


def unpacked(column: pa.Array) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(x, "<u8") for x in column.to_pylist())])


class Bitmap:
    """Bits over hash buckets: what was added answers yes, most else answers no."""

    def __init__(self, bits: int):
        self.bits, self.there = bits, np.zeros(1 << bits, bool)

    def add(self, hashes: np.ndarray) -> None:
        self.there[(hashes >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def blocks(self) -> pa.RecordBatch:
        cut = np.packbits(self.there).reshape(SKETCH_BLOCKS, -1)
        some = [k for k in range(SKETCH_BLOCKS) if cut[k].any()]
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([zlib.compress(cut[k].tobytes(), 1) for k in some], pa.binary())], names=["block", "bits"])


BITS = "block int, bits binary"


def bit_blocks(hashes: np.ndarray, bits: int) -> pa.Table:
    """The blocks of a bitmap of ``hashes``; only those that have any are made, one after the other."""
    at, size, rows = np.sort(hashes >> np.uint64(64 - bits)).astype(np.int64), (1 << bits) // SKETCH_BLOCKS, []
    cut = np.searchsorted(at, np.arange(SKETCH_BLOCKS + 1) * size)
    for k in np.flatnonzero(np.diff(cut)).tolist():
        there = np.zeros(size, bool)
        there[at[cut[k] : cut[k + 1]] - k * size] = True
        rows.append((k, zlib.compress(np.packbits(there).tobytes(), 1)))
    return pa.table({"block": pa.array([r[0] for r in rows], pa.int32()), "bits": pa.array([r[1] for r in rows], pa.binary())})


def bitmap(values: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int) -> np.ndarray:
    """The packed bits of all hashes that ``hashes`` finds in the batches of ``values``; their size is fixed."""
    def note(batches):
        own = Bitmap(bits)
        for batch in batches:
            own.add(hashes(batch))
        yield own.blocks()

    return united(values.mapInArrow(note, BITS), bits)


def united(parts: DataFrame, bits: int) -> np.ndarray:
    """The packed bits of the ``block, bits`` rows of all tasks; the driver gets one row per block."""
    def unite(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                x = np.frombuffer(zlib.decompress(raw), np.uint8)
                found[block] = found[block] | x if block in found else x
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in found.values()], pa.binary())], names=["block", "bits"])

    out = np.zeros((SKETCH_BLOCKS, (1 << bits) // 8 // SKETCH_BLOCKS), np.uint8)
    for r in spread(parts, "block").mapInArrow(unite, BITS).collect():
        out[r.block] |= np.frombuffer(zlib.decompress(bytes(r.bits)), np.uint8)
    return out.ravel()


def in_bitmap(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes >> np.uint64(64 - (len(packed) * 8).bit_length() + 1)).astype(np.int64)
    return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def id_hashes(column: pa.Array) -> np.ndarray:
    return mix(column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))


def sifted(docs: DataFrame, ids: DataFrame, bits: int = 23, after: Callable | None = None, schema: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``docs`` (with ids) in two: rows whose ``doc_id`` may be in ``ids``, and rows whose is not; most texts need not be shuffled then.

    ``after`` is applied to the batches of the latter in the same worker and gives ``schema``: a second
    ``mapInArrow`` behind the first would keep twice as many workers.
    """
    packed = docs.sparkSession.sparkContext.broadcast(bitmap(ids.select("doc_id"), lambda b: id_hashes(b.column("doc_id")), bits))

    def part(wanted: bool):
        def sift(batches):
            for batch in batches:
                yield batch.filter(pa.array(in_bitmap(packed.value, id_hashes(batch.column("doc_id"))) == wanted))

        if after is not None and not wanted:
            return docs.mapInArrow(lambda batches: after(sift(batches)), schema)
        return docs.mapInArrow(sift, docs.schema)

    return part(True), part(False)


# Connected components ----------------------------------------------------------------------------


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "component") -> DataFrame:
    """``(node, component)`` of every node of undirected ``edges``; ``component`` is the smallest node reachable.

    Alternating star contraction: each node links its larger neighbours, then its smaller ones, to its smallest
    neighbour, until nothing changes. Hubs reduce map-side, joins back on them are split by adaptive execution,
    every round is written to the shared folder, and the driver sees two numbers a round.
    """
    star = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    star = stored(star, name)
    before = None
    while True:
        both = star.select("u", "v").unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # a node without larger neighbours passes nothing on: its own edge is kept by the smaller end
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        old, star = star, stored(small.where("u <> v").distinct(), name)
        forget(old)
        now = star.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == before:
            break
        before = now
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
