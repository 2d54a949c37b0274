"""Near-duplicate vectors by spherical-cap filters: random product codes, list decoding, a join on filters, verification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import stored
from .common import components, spread, worker_state

RECALL = 0.999  # share of the pairs at the threshold that shall share a filter
PAIRS = 4000  # random pairs that this is measured on
BUCKET = 8  # vectors a filter of the largest label holds, on average
BLOCK = 1024


def codebook(dim: int, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random rotation and the unit code words of both halves; the same for every task."""
    def make():
        rng = np.random.default_rng(dim * 1_000_003 + words)
        rotation, _ = np.linalg.qr(rng.normal(size=(dim, dim)))
        half = dim // 2
        books = [rng.normal(size=(words, n)) for n in (half, dim - half)]
        return rotation, *(b / np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12) for b in books)

    return worker_state(f"codebook_{dim}_{words}", make)


def _products(vectors: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    dim = vectors.shape[1]
    rotation, left, right = codebook(dim, words)
    turned = vectors @ rotation
    return turned[:, : dim // 2] @ left.T, turned[:, dim // 2 :] @ right.T


def _first(values: np.ndarray, count: int) -> np.ndarray:
    """The places of the ``count`` largest values of each row, in order."""
    if count < values.shape[1]:
        some = np.argpartition(-values, count - 1, axis=1)[:, :count]
        some.sort(axis=1)  # equal values in order of their places
    else:
        some = np.broadcast_to(np.arange(values.shape[1]), values.shape)
    return np.take_along_axis(some, np.argsort(-np.take_along_axis(values, some, 1), axis=1, kind="stable"), 1)


def best_filters(vectors: np.ndarray, words: int, hits: int) -> np.ndarray:
    """For each unit vector the ``hits`` filters (pairs of code words) of largest summed products, ascending.

    The pair of the i-th best first and the j-th best second word has i * j - 1 pairs at least as good, so
    only pairs with i * j <= ``hits`` are looked at: about ``hits`` * ln(``hits``) of them, whatever ``words``.
    """
    hits = min(hits, words * words)
    count = min(hits, words)
    rank = np.arange(1, count + 1)
    i, j = np.nonzero(rank[:, None] * rank[None, :] <= hits)
    out = [np.zeros((0, hits), np.int64)]
    rows = max(1, (1 << 20) // max(words, len(i)))
    for begin in range(0, len(vectors), rows):
        a, b = _products(vectors[begin : begin + rows], words)
        x, y = _first(a, count), _first(b, count)
        at = _first(np.take_along_axis(a, x, 1)[:, i] + np.take_along_axis(b, y, 1)[:, j], hits)
        out.append(np.sort(np.take_along_axis(x, i[at], 1).astype(np.int64) * words + np.take_along_axis(y, j[at], 1), axis=1))
    return np.concatenate(out)


def decode(vectors: np.ndarray, words: int, height: float, least: int = 1) -> list[np.ndarray]:
    """For each unit vector all filters (pairs of code words) whose summed products reach ``height``, and its ``least`` best ones.

    The products with either half's words are sorted once; for each first word the second ones that reach
    the height are a prefix, found by binary search, so the work follows the list and not all pairs.
    """
    best = best_filters(vectors, words, least)
    if height == math.inf:
        return list(best)
    a, b = _products(vectors, words)
    order = np.argsort(-b, axis=1)
    out = []
    for x, y, o, own in zip(a, b, order, best, strict=True):
        count = np.searchsorted(-y[o], x - height, side="right")
        first = np.repeat(np.arange(words), count)
        second = o[np.arange(len(first)) - np.repeat(np.cumsum(count) - count, count)]
        out.append(np.union1d(first.astype(np.int64) * words + second, own))
    return out


def number_of_words(vectors: int, hits: int, bucket: int) -> int:
    """So many code words a half that ``bucket`` of the vectors meet in a filter, on average."""
    return max(8, math.ceil(math.sqrt(vectors * hits / bucket)))


def found_share(dim: int, words: int, hits: int, cosine: float, pairs: int = PAIRS) -> float:
    """Which share of random pairs of the cosine has one of its best filters in common, in the code itself."""
    rng = np.random.default_rng(dim)
    x, other = rng.normal(size=(2, pairs, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    other -= (other * x).sum(1, keepdims=True) * x
    other /= np.maximum(np.linalg.norm(other, axis=1, keepdims=True), 1e-12)
    a, b = best_filters(x, words, hits), best_filters(cosine * x + math.sqrt(max(0.0, 1 - cosine**2)) * other, words, hits)
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    return float((both[:, 1:] == both[:, :-1]).any(1).mean())


def hits_for(dim: int, vectors: int, cosine: float, recall: float, bucket: int) -> int:
    """The least number of filters a vector (in steps of 4) at which ``recall`` of the pairs of the cosine are found, among so many vectors."""
    hits = 4
    while hits < 4096 and found_share(dim, number_of_words(vectors, hits, bucket), hits, cosine) < recall:
        hits += 4 if hits < 64 else hits // 2
    return hits


def _unit(raw: list) -> np.ndarray | None:
    """The vector of length 1 in double precision; None if it is null, empty, zero or holds null or non-finite numbers."""
    if not raw or any(x is None for x in raw):
        return None
    v = np.array(raw, dtype=float)
    top = np.abs(v).max()
    if not np.isfinite(top) or top == 0:
        return None
    v /= top
    return v / np.linalg.norm(v)


MEMBER = "vec_id long, group string, vector binary, same binary"


def members(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, group, vector, same``: the vectors that can link; ``group`` is label and dimension, ``same`` a digest of the content."""
    def read(batches):
        for batch in batches:
            rows = []
            for i, label, raw in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "label", "vector")), strict=True):
                v = _unit(raw) if i is not None and label is not None else None
                if v is not None:
                    group, content = f"{label}/{len(v)}", v.astype("<f8").tobytes()
                    rows.append((i, group, content, xxhash.xxh3_128_digest(group.encode() + content)))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.binary(), pa.binary()), strict=True)], names=["vec_id", "group", "vector", "same"])

    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    return base.mapInArrow(read, MEMBER)


def runs(batches, *keys: str) -> Iterator[pa.Table]:
    """Consecutive rows of equal keys, across the Arrow batches of a sorted partition."""
    held: list[pa.RecordBatch] = []
    before = None
    for batch in batches:
        values = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        at = 0
        for k, v in enumerate(values):
            if v != before:
                if k > at:
                    held.append(batch.slice(at, k - at))
                if held:
                    yield pa.Table.from_batches(held)
                held, at, before = [], k, v
        if at < len(values):
            held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _roots(links: np.ndarray) -> np.ndarray:
    """The smallest row that each row reaches by links."""
    root = np.arange(len(links))
    reach = links | np.eye(len(links), dtype=bool)
    while True:
        new = np.where(reach, root[None, :], len(root)).min(1)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def _verified(table: pa.Table, threshold: float) -> tuple | None:
    """For the vectors of one cell: weighted numbers of links, and edges that connect them as the links do."""
    if table.num_rows < 2:
        return None
    table = table.sort_by("rep")
    rep, side, weight = (table.column(c).to_numpy() for c in ("rep", "side", "mult"))
    x = np.frombuffer(b"".join(table.column("vector").to_pylist()), "<f8").reshape(len(rep), -1)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    if table.column("lo")[0].as_py() != table.column("hi")[0].as_py():
        near &= side[:, None] != side[None, :]
    if not near.any():
        return None
    some = np.flatnonzero(near.any(1))
    near, rep, weight = near[np.ix_(some, some)], rep[some], weight[some]
    # a pair that shares several filters counts in the smallest of them
    here = table.column("filter")[0].as_py()
    lists = table.column("filters").take(pa.array(some)).combine_chunks()
    flat, row = lists.flatten().to_numpy(), np.repeat(np.arange(len(some)), lists.value_lengths().to_numpy())
    earlier = flat < here
    names, code = np.unique(flat[earlier], return_inverse=True)
    holds = np.zeros((len(some), len(names)), np.float32)
    holds[row[earlier], code] = 1
    counted = near & (holds @ holds.T == 0)
    root = rep[_roots(near)]
    return rep, (counted * weight[None, :]).sum(1), root


def near_vectors(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 recall: float = RECALL, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Vectors link if their labels are equal and their cosine, in double precision, is at least
    ``threshold``; null labels and ids and null, empty, zero or non-finite vectors link with nothing.
    Equal vectors are one class: its links are counted by members and never expanded. ``component_id`` is the smallest id
    reachable (null for a null id). A vector is in its best filters; how many is computed for the dimension and
    the size of the largest label, so that ``recall`` of the pairs at the threshold share one (of nearer pairs
    more do). Filters are so many that ``bucket`` vectors of the largest label meet in one on average; a larger
    bucket (vectors all alike) is cut into blocks and each pair of blocks is a task's work of its own. A cell
    gives one row per vector.
    """
    own = stored(members(vectors, id_col, vector_col, label_col), "vectors")
    classes = stored(own.groupBy("same").agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult"), F.first("group").alias("group"), F.first("vector").alias("vector")), "classes")
    groups = classes.groupBy("group").count().groupBy(F.substring_index("group", "/", -1).cast("int").alias("dim")).agg(F.max("count").alias("n"))
    hits = {r.dim: (r.n, hits_for(r.dim, r.n, threshold, recall, bucket)) for r in groups.collect()}  # one row a dimension
    code = {dim: (number_of_words(n, k, bucket), k) for dim, (n, k) in hits.items()}

    def filtered(batches):
        for batch in batches:
            groups = np.array([g.rpartition("/")[2] for g in batch.column("group").to_pylist()])
            for dim in np.unique(groups):
                part = batch.filter(pa.array(groups == dim))
                x = np.frombuffer(b"".join(part.column("vector").to_pylist()), "<f8").reshape(part.num_rows, -1)
                words, least = code[x.shape[1]]
                found = decode(x, words, math.inf, least)
                at = np.repeat(np.arange(len(found)), [len(f) for f in found])
                rows = part.take(pa.array(at))
                lists = pa.array(found, pa.list_(pa.int64())).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("rep", "mult", "group", "vector")), lists, pa.array(np.concatenate(found))], names=["rep", "mult", "group", "vector", "filters", "filter"])

    entries = stored(classes.select("rep", "mult", "group", "vector").mapInArrow(filtered, "rep long, mult long, group string, vector binary, filters array<bigint>, filter long"), "filters")
    sizes = entries.groupBy("group", "filter").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    cells = entries.join(sizes, ["group", "filter"]).withColumn("side", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("lo", F.least("side", "other")).withColumn("hi", F.greatest("side", "other"))

    def verify(batches):
        for table in runs(batches, "group", "filter", "lo", "hi"):
            got = _verified(table, threshold)
            if got is not None:
                yield pa.RecordBatch.from_arrays([pa.array(got[0]), pa.array(got[1].astype(np.int64)), pa.array(got[2])], names=["rep", "n", "root"])

    keys = ["group", "filter", "lo", "hi"]
    dealt = spread(cells.select("rep", "mult", "vector", "filters", "side", *keys), *keys).sortWithinPartitions(*keys)
    links = stored(dealt.mapInArrow(verify, "rep long, n long, root long"), "links")
    counts = links.groupBy("rep").agg(F.sum("n").alias("n"))
    found = components(links.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")), name="vector-component")
    by_class = classes.select("same", "rep", "mult").join(counts, "rep", "left").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    by_class = by_class.select("same", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    linked = own.select("vec_id", "same").join(by_class, "same").select("vec_id", "n_links", "component_id")
    # rows that repeat an id are vectors of their own but share what the id reaches
    linked = linked.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    every = vectors.select(F.col(id_col).cast("long").alias("vec_id"))
    out = every.join(linked, "vec_id", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
