"""Repeated substrings over sparse suffix arrays: a logarithmic family of indexes, merge-scanned by new batches."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sizing import forget, stored
from .cap_filters import runs
from .common import _P, _powers, bitmap, bucketed, column_bytes, id_text, in_bitmap, mix, sifted, spread, text_slices, unpacked

WIDTH = 100
GRAM = 40
BATCHES = 3
SLICE = 256 << 10  # of text at a time: the arrays over its places take 80 times as much at their peak
BUCKET_BYTES = 256 << 20  # of text behind one bucket of the index
PIECE = 2048  # heads in a row of a stored array: Parquet pages and their codecs hold rows by the hundred
REPEAT_BITS = 25
HEAVY = 2000


class Anchors:
    """The indexed suffixes of some texts.

    Every string of ``width`` bytes selects one of the places in it, that of the least gram hash (the first
    of equal ones), so equal strings select the same place. Only selected places are indexed. ``lo`` is the
    start of the first string that selects a place, ``count`` the number of strings (their starts follow
    one another), ``gram`` the hash of the suffix's first bytes and ``region`` that of all bytes the strings cover.
    """

    def __init__(self, column: pa.Array, width: int, gram: int):
        data, offsets = column_bytes(column)
        n, span = len(data), width - gram + 1
        self.row = self.lo = self.count = np.zeros(0, np.int64)
        self.gram = self.region = np.zeros(0, np.uint64)
        if n < width:
            return
        up, down = _powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        value = mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
        packed = value >> np.uint64(32) << np.uint64(32) | np.arange(len(value), dtype=np.uint64)
        # the least of each span, from running minima of blocks forwards and backwards
        blocks = -(-len(packed) // span)
        full = np.full(blocks * span, np.uint64(2**64 - 1))
        full[: len(packed)] = packed
        full = full.reshape(blocks, span)
        ahead = np.minimum.accumulate(full, axis=1).ravel()
        back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = n - width + 1
        at = (np.minimum(back[:windows], ahead[span - 1 : span - 1 + windows]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        length = np.diff(offsets)
        own = np.maximum(length - width + 1, 0)
        row = np.repeat(np.arange(len(length)), own)
        start = np.arange(len(row)) - np.repeat(np.cumsum(own) - own, own) + offsets[row]
        at = at[start]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        self.count = np.diff(np.append(first, len(at)))
        begin, place, self.row = start[first], at[first], row[first]
        self.lo = begin - offsets[self.row]
        self.gram = mix(value[place])  # least values are small ones: mixed again, they fill all buckets
        stop = begin + self.count - 1 + width
        self.region = mix((sums[stop] - sums[begin]) * down[begin] + (place - begin).astype(np.uint64) * _P + self.count.astype(np.uint64))


# The family of indexes ---------------------------------------------------------------------------

LEVEL = "bucket int, grams binary"


class Family:
    """Sorted arrays of suffix heads in levels; a level of rank r stands for 2 ** r batches.

    A new batch is merge-scanned with every level, then becomes a level of rank 0; two levels of equal rank
    merge. All arrays are cut into the same buckets by the high bits, so each step works bucket by bucket.
    """

    def __init__(self, spark: SparkSession, buckets: int, width: int, gram: int):
        self.spark, self.buckets, self.width, self.gram = spark, buckets, width, gram
        self.levels: list[tuple[int, DataFrame]] = []
        self.written: list[DataFrame] = []

    def add(self, texts: DataFrame, last: bool) -> DataFrame:
        """Index a batch of ``text`` rows; returns its heads, in packed arrays, that it has twice or that a level has."""
        buckets, width, gram = self.buckets, self.width, self.gram
        fresh = texts.mapInArrow(lambda b: _heads(b, buckets, width, gram), "bucket int, grams binary, again binary")
        known = self.spark.createDataFrame([], LEVEL)
        for _, level in self.levels:
            known = known.unionByName(level)
        out = stored(fresh.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(_scanned, LEVEL + ", repeated binary"), "level")
        self.written.append(out)
        if not last:
            self.levels.append((0, out.select("bucket", "grams")))
            while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
                (rank, a), (_, b) = self.levels.pop(), self.levels.pop()
                merged = stored(a.unionByName(b).groupBy("bucket").applyInArrow(_merged, LEVEL), "level")
                self.levels.append((rank + 1, merged))
                self.written.append(merged)
        return out.select(F.col("repeated").alias("grams"))


def _heads(batches, buckets: int, width: int, gram: int):
    """For each bucket the heads of a slice, and those of them that it has more than once."""
    for batch in text_slices(batches, limit=SLICE):
        yield bucketed(*np.unique(Anchors(batch.column("text"), width, gram).gram, return_counts=True), buckets)


def _pieces(bucket: int, **arrays: np.ndarray) -> pa.Table:
    """Sorted arrays of a bucket as rows of at most ``PIECE`` heads, in order."""
    rows = max(1, *(-(-len(x) // PIECE) for x in arrays.values()))
    cut = {name: [x[k * PIECE : (k + 1) * PIECE].astype("<u8").tobytes() for k in range(rows)] for name, x in arrays.items()}
    return pa.table({"bucket": pa.array([bucket] * rows, pa.int32())} | {name: pa.array(x, pa.binary()) for name, x in cut.items()})


def _scanned(batch, level):
    """Merge a bucket of a batch into one sorted array and scan the levels' arrays with it."""
    heads, count = np.unique(unpacked(batch.column("grams")), return_counts=True)
    old = np.sort(unpacked(level.column("grams")), kind="stable")  # a merge of sorted runs
    known = old[np.minimum(np.searchsorted(old, heads), len(old) - 1)] == heads if len(old) else np.zeros(len(heads), bool)
    bucket = (batch if batch.num_rows else level).column("bucket")[0].as_py()
    return _pieces(bucket, grams=heads, repeated=np.union1d(heads[(count > 1) | known], unpacked(batch.column("again"))))


def _merged(table):
    return _pieces(table.column("bucket")[0].as_py(), grams=np.unique(unpacked(table.column("grams"))))


def repeated_heads(base: DataFrame, width: int, gram: int, batches: int, bucket_bytes: int) -> np.ndarray:
    """A bitmap, of fixed size, of the suffix heads that occur more than once; ``base`` is dealt into batches by ranges of ``doc_id``."""
    volume = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cuts = sorted(set(base.approxQuantile("doc_id", [k / batches for k in range(1, batches)], 0.01))) if batches > 1 else []
    family, out = Family(base.sparkSession, max(16, -(-volume // bucket_bytes)), width, gram), None
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = base
        if low is not None:
            part = part.where(F.col("doc_id") > low)
        if high is not None:
            part = part.where(F.col("doc_id") <= high)
        got = family.add(part.select("text"), high is None)
        out = got if out is None else out.unionByName(got)
    bits = bitmap(out, lambda b: unpacked(b.column("grams")), REPEAT_BITS)
    forget(*family.written)
    return bits


# Which bytes go ----------------------------------------------------------------------------------

FOUND = "doc_id long, lo int, count int, gram long, region long"


def _found(batches, heads, width: int, gram: int):
    """The anchors of repeated heads. Of equal regions in a slice all but the first are settled: they come without a head."""
    for batch in text_slices(batches, limit=SLICE):
        a = Anchors(batch.column("text"), width, gram)
        some = np.flatnonzero(in_bitmap(heads.value, a.gram))
        doc = batch.column("doc_id").to_numpy()[a.row[some]]
        lo, count, head, region = a.lo[some], a.count[some], a.gram[some], a.region[some]
        order = np.lexsort((lo, doc, region, head))
        doc, lo, count, head, region = doc[order], lo[order], count[order], head[order], region[order]
        new = np.ones(len(doc), bool)
        new[1:] = (head[1:] != head[:-1]) | (region[1:] != region[:-1])
        first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(doc) else np.zeros(0, np.int64)
        gone = (doc != doc[first]) | (lo != lo[first])
        twin = ~gone & ~new  # a row that repeats the document
        arrays = [pa.array(doc), pa.array(lo.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(head.view(np.int64), mask=gone), pa.array(region.view(np.int64), mask=gone)]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lo", "count", "gram", "region"]).filter(pa.array(~twin))


def _regions(batches, width: int):
    """The bytes behind the wanted anchors of each document."""
    for batch in text_slices(batches):
        rows = []
        for doc, text, spots in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spots").to_pylist(), strict=True):
            rows.extend((s["gram"], s["variants"], doc, s["lo"], text[s["lo"] : s["lo"] + s["count"] - 1 + width]) for s in spots)
        columns = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["gram", "variants", "doc_id", "lo", "bytes"])


SPAN = "doc_id long, start int, stop int"


def _spans(doc: list, start: list, width: int) -> pa.RecordBatch:
    start = np.array(start, np.int32)
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(start), pa.array(start + np.int32(width))], names=["doc_id", "start", "stop"])


def _few(batches, width: int):
    """Strings that an earlier region of the same head has, for heads of few variants."""
    for group in runs(batches, "gram"):
        seen: set[bytes] = set()
        docs, starts = [], []
        rows = sorted(zip(group.column("doc_id").to_pylist(), group.column("lo").to_pylist(), group.column("bytes").to_pylist(), strict=True))
        for k, (doc, lo, raw) in enumerate(rows):
            if k and rows[k - 1] == (doc, lo, raw):
                continue
            for at in range(len(raw) - width + 1):
                w = raw[at : at + width]
                if w in seen:
                    docs.append(doc)
                    starts.append(lo + at)
                else:
                    seen.add(w)
        if docs:
            yield _spans(docs, starts, width)


def _strings(batches, width: int):
    """All strings of the regions, by 128-bit digests, for heads of many variants."""
    for batch in batches:
        doc, start, key = [], [], []
        for d, lo, raw in zip(batch.column("doc_id").to_pylist(), batch.column("lo").to_pylist(), batch.column("bytes").to_pylist(), strict=True):
            for at in range(len(raw) - width + 1):
                doc.append(d)
                start.append(lo + at)
                key.append(hashlib.blake2b(raw[at : at + width], digest_size=16).digest())
        keys = np.frombuffer(b"".join(key), "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(start, pa.int32()), pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy())], names=["doc_id", "start", "a", "b"])


def repeated_spans(base: DataFrame, width: int = WIDTH, gram: int = GRAM, batches: int = BATCHES, bucket_bytes: int = BUCKET_BYTES, heavy: int = HEAVY) -> DataFrame:
    """``doc_id, start, stop``: byte spans covered by strings of ``width`` bytes that also start earlier; spans may overlap.

    Equal regions are settled by their first occurrence. Heads with several different regions compare their
    strings: those with few where they meet, those with more than ``heavy`` by one row a string, which
    reduces before the shuffle and has no common key.
    """
    spark = base.sparkSession
    heads = spark.sparkContext.broadcast(repeated_heads(base, width, gram, batches, bucket_bytes))
    found = stored(base.mapInArrow(lambda b: _found(b, heads, width, gram), FOUND), "anchors")
    variants = stored(found.where("gram is not null").groupBy("gram", "region").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first"), F.min_by("lo", "doc_id").alias("lo"), F.min_by("count", "doc_id").alias("count")), "variants")
    whole = found.where("gram is null").select("doc_id", "lo", "count").unionByName(
        found.where("gram is not null").join(variants.where("n > 1").select("gram", "region", "first"), ["gram", "region"]).where("doc_id <> first").select("doc_id", "lo", "count"))
    whole = whole.select("doc_id", F.col("lo").alias("start"), (F.col("lo") + F.col("count") - 1 + width).cast("int").alias("stop"))

    several = variants.groupBy("gram").agg(F.count("*").alias("variants")).where("variants > 1")
    spots = stored(variants.join(several, "gram").select(F.col("first").alias("doc_id"), "gram", "variants", "lo", "count"), "spots")
    by_doc = spots.groupBy("doc_id").agg(F.collect_list(F.struct("gram", "variants", "lo", "count")).alias("spots"))
    maybe, _ = sifted(base, spots)
    regions = stored(maybe.join(by_doc, "doc_id").mapInArrow(lambda b: _regions(b, width), "gram long, variants long, doc_id long, lo int, bytes binary"), "regions")
    few = spread(regions.where(F.col("variants") <= heavy).drop("variants"), "gram").sortWithinPartitions("gram").mapInArrow(lambda b: _few(b, width), SPAN)
    strings = regions.where(F.col("variants") > heavy).mapInArrow(lambda b: _strings(b, width), "doc_id long, start int, a long, b long")
    earliest = strings.groupBy("a", "b").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    many = strings.join(earliest, ["a", "b"]).where("doc_id <> first.doc_id or start <> first.start").select("doc_id", "start", (F.col("start") + width).cast("int").alias("stop"))
    spans = stored(whole.unionByName(few).unionByName(many), "spans")
    forget(found, variants, spots, regions)
    return spans


KEPT = "doc_id long, kept binary, n_bytes long, n_removed long, spans array<struct<start:bigint,stop:bigint>>"


def drop_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``doc_id, kept, n_bytes, n_removed, spans`` of every row; ``kept`` is binary, ``spans`` the maximal removed runs.

    A text is its UTF-8 bytes, a null text empty. A byte goes if a string of ``width`` bytes covers it that
    also starts earlier: in a document of smaller id, or before in the same one. Strings are judged on the
    input and do not cross documents. Rows without an id are kept whole and compared with nothing; a row
    that repeats another loses the same bytes, as neither is earlier.
    """
    base = id_text(docs, id_col, text_col)
    named = base.where("doc_id is not null")
    spans = repeated_spans(named, width, **settings)

    def cut(batches):
        for batch in text_slices(batches):
            out = []
            found = batch.column("cuts").to_pylist() if "cuts" in batch.schema.names else [None] * batch.num_rows
            for text, cuts in zip(batch.column("text").cast(pa.binary()).to_pylist(), found, strict=True):
                joined: list[list[int]] = []
                for a, b in sorted((c["start"], c["stop"]) for c in cuts or ()):
                    if joined and a <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], b)
                    else:
                        joined.append([a, b])
                kept, at = [], 0
                for a, b in joined:
                    kept.append(text[at:a])
                    at = b
                out.append((b"".join([*kept, text[at:]]), len(text), sum(b - a for a, b in joined), [{"start": a, "stop": b} for a, b in joined]))
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["doc_id", "kept", "n_bytes", "n_removed", "spans"])

    touched, rest = sifted(named, spans, after=cut, schema=KEPT)
    by_doc = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("cuts"))
    out = touched.join(by_doc, "doc_id", "left").select("doc_id", "text", "cuts").mapInArrow(cut, KEPT)
    return out.unionByName(rest).unionByName(base.where("doc_id is null").mapInArrow(cut, KEPT))
