"""Document fingerprints from modular prefix hashes: any span's value, and likeness by longest common extensions."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, spread, text_slices, worker_state

PRIMES = (2147483647, 2147483629)
BASES = (1000003, 998244341)
STEPS = 4  # checkpoints per doubling of the length
SLICE = 2 << 20
PARTS = 8  # id ranges per shuffle partition


def ladder(longest: int) -> np.ndarray:
    """The lengths at which fingerprints hold a prefix and a suffix value: 1, 2, 3, ... growing by 2 ** (1 / STEPS)."""
    top = max(1, longest)
    out = np.unique(np.floor(2.0 ** (np.arange(0, STEPS * top.bit_length() + 1) / STEPS)).astype(np.int64))
    return out[out <= top]


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    def make(n):
        def run(base, p):
            out = np.ones(1, np.uint64)
            while len(out) < n:
                out = np.concatenate([out, out * np.uint64(pow(base, len(out), p)) % np.uint64(p)])
            return out

        return [(run(b, p), run(pow(b, -1, p), p)) for b, p in zip(BASES, PRIMES, strict=True)]

    have = worker_state("fingerprint_powers", lambda: [make(1 << 16)])
    if len(have[0][0][0]) < n:
        have[0] = make(n)
    return have[0]


class PrefixHashes:
    """Prefix values of a sequence of numbers modulo two primes; ``span`` values depend on the span's content only."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.powers = _powers(self.n + 1)
        self.sums = []
        for p, (up, _) in zip(PRIMES, self.powers, strict=True):
            s = np.zeros(self.n + 1, np.uint64)
            np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: self.n] % np.uint64(p), out=s[1:])
            s %= np.uint64(p)
            self.sums.append(s)

    def span(self, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        """The values of the spans ``[a, b)``, one array for each prime."""
        return [(s[b] + np.uint64(p) - s[a]) % np.uint64(p) * down[a] % np.uint64(p) for p, s, (_, down) in zip(PRIMES, self.sums, self.powers, strict=True)]

    def joined(self, first: list[np.ndarray], length: np.ndarray, second: list[np.ndarray]) -> list[np.ndarray]:
        """The value of a span of ``length`` followed by another."""
        return [(x + up[length] * y) % np.uint64(p) for p, x, y, (up, _) in zip(PRIMES, first, second, self.powers, strict=True)]

    def equal(self, a: int, b: int, c: int, d: int) -> bool:
        return b - a == d - c and all(x == y for x, y in zip(self.span(np.array([a]), np.array([b])), self.span(np.array([c]), np.array([d])), strict=True))

    def common_extension(self, a: int, c: int) -> int:
        """Length of the longest common span that starts at both ``a`` and ``c``, by binary search."""
        low, high = 0, self.n - max(a, c)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.equal(a, a + mid, c, c + mid) else (low, mid - 1)
        return low


def _whole(values: list[np.ndarray]) -> np.ndarray:
    return values[0] | values[1] << np.uint64(31)


class Marks:
    """Fingerprints of many texts: length, value of the whole, values of the prefixes and suffixes on the ladder."""

    def __init__(self, n, whole, first, prefix, suffix):
        self.n, self.whole, self.first, self.prefix, self.suffix = n, whole, first, prefix, suffix

    def strings(self) -> list[str]:
        pre, suf, at = self.prefix.astype(">u4").tobytes().hex(), self.suffix.astype(">u4").tobytes().hex(), (self.first * 8).tolist()
        return [f"{n:x}:{w:016x}:{pre[a:b]}:{suf[a:b]}" for n, w, a, b in zip(self.n.tolist(), self.whole.tolist(), at[:-1], at[1:], strict=True)]

    @classmethod
    def of(cls, strings: list[str]) -> Marks:
        split = [x.split(":") for x in strings]
        first = np.concatenate([[0], np.cumsum([len(x[2]) // 8 for x in split])]).astype(np.int64)
        values = [np.frombuffer(bytes.fromhex("".join(x[k] for x in split)), ">u4").astype(np.uint32) for k in (2, 3)]
        return cls(np.array([int(x[0], 16) for x in split], np.int64), np.array([int(x[1], 16) for x in split], np.uint64), first, *values)

    def take(self, rows: np.ndarray) -> Marks:
        count = np.diff(self.first)[rows]
        first = np.concatenate([[0], np.cumsum(count)])
        at = np.arange(first[-1]) - np.repeat(first[:-1], count) + np.repeat(self.first[rows], count)
        return Marks(self.n[rows], self.whole[rows], first, self.prefix[at], self.suffix[at])


def _agreeing(x: np.ndarray, x_first: np.ndarray, y: np.ndarray, y_first: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """How many leading ladder values agree in each row: agreement never comes back, so a binary search finds it."""
    low, high = np.zeros(len(shared), np.int64), shared.copy()
    while (low < high).any():
        mid = (low + high + 1) // 2
        here = low < high
        same = np.zeros(len(shared), bool)
        same[here] = x[x_first[here] + mid[here] - 1] == y[y_first[here] + mid[here] - 1]
        low, high = np.where(same, mid, low), np.where(here & ~same, mid - 1, high)
    return low


def likeness(x: Marks, y: Marks) -> np.ndarray:
    """Share of the longer text in the longest common prefix and suffix, to the ladder's precision; 1 only for equal texts."""
    steps = ladder(int(max(x.n.max(initial=1), y.n.max(initial=1))))
    reach = np.concatenate([[0], steps])
    shared = np.minimum(np.diff(x.first), np.diff(y.first))
    common = sum(reach[_agreeing(a, x.first[:-1], b, y.first[:-1], shared)] for a, b in ((x.prefix, y.prefix), (x.suffix, y.suffix)))
    longest = np.maximum(np.maximum(x.n, y.n), 1)
    equal = (x.n == y.n) & (x.whole == y.whole)
    return np.where(equal, 1.0, np.minimum(common / longest, 1 - 1 / (longest + 1)))


def compare(a: str, b: str) -> float:
    """Likeness of two fingerprint strings."""
    return float(likeness(Marks.of([a]), Marks.of([b]))[0])


def _marks(h: PrefixHashes, n: np.ndarray, spans) -> Marks:
    """Marks of texts of ``n`` numbers; ``spans(row, a, b)`` gives the values of their spans."""
    steps = ladder(int(n.max(initial=1)))
    count = np.searchsorted(steps, n, side="right")
    first = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    row = np.repeat(np.arange(len(n)), count)
    length = steps[np.arange(first[-1]) - first[row]]
    fold = lambda values: (_whole(values) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    zero = np.zeros(len(length), np.int64)
    rows = np.arange(len(n))
    return Marks(n, _whole(spans(rows, np.zeros(len(n), np.int64), n)), first, fold(spans(row, zero, length)), fold(spans(row, n[row] - length, n[row])))


def text_marks(texts: list[str]) -> list[str]:
    """Fingerprints of texts."""
    n = np.array([len(t) for t in texts], np.int64)
    h = PrefixHashes(np.frombuffer("".join(texts).encode("utf-32-le"), "<u4"))
    at = np.concatenate([[0], np.cumsum(n)])
    return _marks(h, n, lambda row, a, b: h.span(at[row] + a, at[row] + b)).strings()


def _rows(batch: pa.RecordBatch, columns: list[str]) -> pa.RecordBatch:
    """Results for all rows but the last, each with the row after it."""
    texts = batch.column("text").to_pylist()
    alone = np.array([p is None for p in batch.column("part").to_pylist()])
    n = np.array([len(t) for t in texts], np.int64)
    h = PrefixHashes(np.frombuffer("".join(texts).encode("utf-32-le"), "<u4"))
    at = np.concatenate([[0], np.cumsum(n)])[:-1]
    following = np.where(alone[:-1], 0, n[1:])
    keep = n[:-1] - n[:-1] // 4
    taken = np.minimum(n[:-1] // 4, following)

    def edited(row, a, b):
        # a part of the own text, then a part of the next one
        cut, own, other = keep[row], at[row], at[row + 1]
        left = h.span(own + np.minimum(a, cut), own + np.minimum(b, cut))
        right = h.span(other + np.maximum(a - cut, 0), other + np.maximum(b - cut, 0))
        return h.joined(left, np.minimum(b, cut) - np.minimum(a, cut), right)

    plain = _marks(h, n, lambda row, a, b: h.span(at[row] + a, at[row] + b))
    changed = _marks(h, keep + taken, edited)
    rows = np.arange(len(n) - 1)
    own = plain.take(rows)
    empty = plain.take(rows + 1)
    if alone.any():
        empty = Marks.of(["0:0000000000000000::" if x else s for x, s in zip(alone, empty.strings(), strict=False)])
    sha = [hashlib.sha256((t[:k] + u[:m]).encode()).hexdigest() for t, u, k, m in zip(texts, texts[1:], keep.tolist(), taken.tolist(), strict=False)]
    arrays = [batch.column("doc_id")[:-1], pa.array(n[:-1]), pa.array(sha, pa.string()), pa.array(own.strings(), pa.string()), pa.array(changed.strings(), pa.string()),
              pa.array(likeness(own, changed)), pa.array(likeness(own, empty))]
    out = pa.RecordBatch.from_arrays(arrays, names=columns)
    return out.filter(pa.array(~batch.column("follower").to_numpy(zero_copy_only=False)[:-1]))


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every whole text's fingerprint, that of its edited text, and how like it is to that and to the next text.

    Next is by ascending id, after the last the first; rows that share an id follow one another by text.
    Rows without an id come back too, with an empty next text. A null text is empty. The edited text is the
    text whose last quarter of code points is replaced by the next text's first as many, or all.

    The ids are cut into ranges by approximate quantiles (bounded numbers). Each range also gets a copy of
    the first document after it, so that texts are shuffled once and neighbours meet in one partition.
    """
    spark = docs.sparkSession
    base = id_text(docs, id_col, text_col)
    parts = PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(base.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 1 / (4 * parts))))
    part = F.lit(0).cast("int")
    if len(cuts) > 1:
        from pyspark.ml.feature import Bucketizer

        base = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="doc_id", outputCol="range", handleInvalid="keep").transform(base)
        part = F.col("range").cast("int")
    base = base.select("doc_id", "text", F.when(F.col("doc_id").isNotNull(), part).alias("part"))
    firsts = sorted((r.part, r.first) for r in base.where("doc_id is not null").groupBy("part").agg(F.min("doc_id").alias("first")).collect())  # one row per range
    columns = [x.split()[0] for x in RESULT.split(", ")]
    rows = base.withColumn("follower", F.lit(False))
    if firsts:
        before = spark.createDataFrame([(firsts[k - 1][0], first) for k, (_, first) in enumerate(firsts)], "part int, doc_id long")
        after = base.where(F.col("doc_id").isin([f for _, f in firsts])).groupBy("doc_id").agg(F.min("text").alias("text"))
        rows = rows.unionByName(after.join(F.broadcast(before), "doc_id").select("doc_id", "text", "part", F.lit(True).alias("follower")))

    def run(batches):
        held = None
        for batch in text_slices(batches, limit=SLICE):
            batch = batch if held is None else pa.concat_batches([held, batch])
            if batch.num_rows > 1:
                yield _rows(batch, columns)
            held = batch.slice(batch.num_rows - 1)
        if held is not None and not held.column("follower")[0].as_py():  # a row without an id
            yield _rows(pa.concat_batches([held, held]), columns)

    # rows without an id are spread by their text
    dealt = spread(rows.withColumn("key", F.coalesce(F.col("part").cast("long"), F.xxhash64("text"))), "key")
    return dealt.sortWithinPartitions(F.col("part").desc_nulls_last(), "follower", "doc_id", "text").select("doc_id", "text", "part", "follower").mapInArrow(run, RESULT)
