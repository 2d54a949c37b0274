"""Vectors compressed to one byte a part: product codebooks by Lloyd's rounds over cover trees.

Each task cuts its vectors into blocks and builds, for every part of a block, a cover tree over the distinct
part vectors, whose subtrees are ranges of one order with cumulative sums. A round sends only the codebooks
to the trees: where the triangle inequality shows one entry to be nearest for a whole subtree, the subtree is
assigned and summed at once; other nodes descend, and leaves are compared exactly. All arithmetic that
decides is on integers.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import forget, stored
from .common import bound_batches

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE, LIMIT = 256, 1 << 26
LEAF = 8
BLOCK_ROWS, BLOCK_VALUES = 4096, 1 << 19
LABEL_SALTS = 8


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All integers of the ranges, one range after the other."""
    size = last - first
    return np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())


class CoverTree:
    """A cover tree over distinct integer points with weights.

    ``points`` are in tree order: a node owns ``first`` to ``last``, and its routing point is the first of them.
    Children lie within half the radius of their node's points, and their routing points are further apart.
    """

    FIELDS = ("points", "cum", "first", "last", "radius", "child", "children")

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, points: np.ndarray, weights: np.ndarray) -> tuple[CoverTree, np.ndarray]:
        """The tree, and for each place in its order the row of ``points`` there."""
        order = np.arange(len(points))
        ends, radius, child, children = [(0, len(points))], [], [], []
        far = [np.sqrt(((points - points[0]) ** 2).sum(1))]
        at = 0
        while at < len(ends):
            (first, last), d = ends[at], far[at]
            far[at] = None
            radius.append(float(d.max()))
            child.append(len(ends))
            if last - first > LEAF and radius[at] > 0:
                own, cover, groups = order[first:last], radius[at] / 2, []
                while True:
                    close = d <= cover
                    groups.append((own[close], d[close]))
                    own = own[~close]
                    if not len(own):
                        break
                    d = np.sqrt(((points[own] - points[own[0]]) ** 2).sum(1))
                order[first:last] = np.concatenate([g for g, _ in groups])
                for g, d in groups:
                    ends.append((first, first + len(g)))
                    far.append(d)
                    first += len(g)
            children.append(len(ends) - child[at])
            at += 1
        ends = np.array(ends, np.int64)
        held = points[order]
        cum = np.zeros((len(points) + 1, points.shape[1] + 1), np.int64)
        np.cumsum(np.column_stack([held * weights[order, None], weights[order]]), axis=0, out=cum[1:])
        tree = cls(points=held, cum=cum, first=ends[:, 0], last=ends[:, 1], radius=np.array(radius), child=np.array(child, np.int64), children=np.array(children, np.int64))
        return tree, order

    def assign(self, book: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``first, last, entry`` of ranges of the order that cover it: whole subtrees, then single points of leaves."""
        nodes = np.zeros(1, np.int64)
        while len(nodes):
            square = _squares(self.points[self.first[nodes]], book)
            away = np.sqrt(square.astype(float))
            nearest = square.argmin(1)
            two = np.partition(away, 1, axis=1)[:, :2] if len(book) > 1 else np.column_stack([away[:, 0], np.full(len(nodes), np.inf)])
            # d1 + r < d2 - r, with room for rounding: no other entry is as near to any point below
            whole = two[:, 0] + 2 * self.radius[nodes] < two[:, 1] * (1 - 1e-9)
            yield self.first[nodes[whole]], self.last[nodes[whole]], nearest[whole]
            nodes = nodes[~whole]
            leaf = self.children[nodes] == 0
            at = _ranges(self.first[nodes[leaf]], self.last[nodes[leaf]])
            if len(at):
                yield at, at + 1, _squares(self.points[at], book).argmin(1)
            nodes = nodes[~leaf]
            nodes = _ranges(self.child[nodes], self.child[nodes] + self.children[nodes])


def _squares(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of points to entries, exact."""
    out = np.zeros((len(points), len(book)), np.int64)
    for j in range(book.shape[1]):
        out += (points[:, j, None] - book[None, :, j]) ** 2
    return out


def _block(values: np.ndarray) -> bytes:
    """The trees of all parts of a block of integer vectors, and for each vector the place of its part in each tree."""
    arrays = {}
    for k, part in enumerate(np.split(values, PARTS, axis=1)):
        distinct, row, count = np.unique(part, axis=0, return_inverse=True, return_counts=True)
        tree, order = CoverTree.build(distinct, count)
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        arrays |= {f"{k}_{name}": getattr(tree, name) for name in CoverTree.FIELDS} | {f"{k}_place": place[row.ravel()]}
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _trees(raw: bytes) -> Iterator[tuple[int, CoverTree, np.ndarray]]:
    with np.load(io.BytesIO(raw)) as held:
        for k in range(PARTS):
            yield k, CoverTree(**{name: held[f"{k}_{name}"] for name in CoverTree.FIELDS}), held[f"{k}_place"]


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``id, label, values`` of the rows whose vector has only finite components, as integers."""
    ok = F.col(vector_col).isNotNull() & ~F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(F.col(vector_col), lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("long"))
    return vectors.where(ok).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), whole.alias("values"))


def blocks(rows: DataFrame, width: int) -> DataFrame:
    """One row for each block of a task's vectors: ids, labels and trees. Shorter vectors are filled up with 0."""
    label = rows.schema["label"].dataType.simpleString()
    many = max(1, min(BLOCK_ROWS, BLOCK_VALUES // width))

    def pack(held):
        table = pa.Table.from_batches(held).combine_chunks()
        lists = table.column("values").chunk(0)
        offsets = lists.offsets.to_numpy()
        size = np.diff(offsets)
        values = np.zeros((table.num_rows, width), np.int64)
        values[np.repeat(np.arange(len(size)), size), _ranges(np.zeros(len(size), np.int64), size)] = lists.values.to_numpy()[offsets[0] : offsets[-1]]
        ends = pa.array([0, table.num_rows], pa.int32())
        ids, labels = (pa.ListArray.from_arrays(ends, table.column(c).chunk(0)) for c in ("id", "label"))
        return pa.RecordBatch.from_arrays([ids, labels, pa.array([_block(values)], pa.binary())], names=["ids", "labels", "trees"])

    def build(batches):
        held, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                held.append(batch.slice(0, many - rows))
                rows, batch = rows + held[-1].num_rows, batch.slice(held[-1].num_rows)
                if rows == many:
                    yield pack(held)
                    held, rows = [], 0
        if held:
            yield pack(held)

    return rows.mapInArrow(build, f"ids array<bigint>, labels array<{label}>, trees binary")


def _means(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round. Each task adds up its blocks; the driver gets one row for each component of an entry."""
    sent = trees.sparkSession.sparkContext.broadcast(books)

    def add(batches):
        total = np.zeros((PARTS, books.shape[1], books.shape[2] + 1), np.int64)
        for batch in batches:
            for raw in batch.column("trees"):
                for k, tree, _ in _trees(raw.as_py()):
                    for first, last, entry in tree.assign(sent.value[k]):
                        np.add.at(total[k], entry, tree.cum[last] - tree.cum[first])
        part, entry, place = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (part, entry, place, total[part, entry, place])], names=["part", "entry", "place", "value"])

    sums = trees.select("trees").mapInArrow(add, "part long, entry long, place long, value long").groupBy("part", "entry", "place").agg(F.sum("value").alias("value"))
    total = np.zeros((PARTS, books.shape[1], books.shape[2] + 1), np.int64)
    for r in sums.collect():
        total[r.part, r.entry, r.place] = r.value
    sent.unpersist()
    count = total[:, :, -1:]
    return np.where(count > 0, total[:, :, :-1] // np.maximum(count, 1), books)


def _coded(trees: DataFrame, books: np.ndarray, label: str) -> DataFrame:
    sent = trees.sparkSession.sparkContext.broadcast(books)

    def code(batches):
        for batch in batches:
            for ids, labels, raw in zip(*(batch.column(c) for c in ("ids", "labels", "trees")), strict=True):
                codes = np.zeros((len(ids.values), PARTS), np.uint8)
                error = np.zeros(len(codes), np.int64)
                for k, tree, place in _trees(raw.as_py()):
                    own = np.zeros(len(tree.points), np.int64)
                    for first, last, entry in tree.assign(sent.value[k]):
                        own[_ranges(first, last)] = np.repeat(entry, last - first)
                    codes[:, k] = own[place]
                    error += ((tree.points - sent.value[k][own]) ** 2).sum(1)[place]
                yield pa.RecordBatch.from_arrays(
                    [ids.values, labels.values, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)], names=["id", "label", "code", "error"])

    return trees.mapInArrow(code, f"id bigint, label {label}, code binary, error bigint")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """``id, label, code, error, label_error`` of every usable vector, and the codebooks (part, entry, component).

    Components become ``floor(256 * x)``, held within ``LIMIT`` either way. Rows whose vector is null or has
    null or non-finite components go; all others stay, repeated rows and rows without id included. Vectors
    are filled up with 0 to a multiple of 16 components, at least 16, of the longest. The first codebooks are
    the parts of the 64 smallest ids (rows without id last, equal ids by their values), all rows if there are
    fewer. ``code`` has one byte for each part; ``label_error`` sums ``error`` over equal labels, nulls together.
    Other columns are not read. An empty table gives no rows.
    """
    bound_batches(vectors)
    rows = usable(vectors, id_col, vector_col, label_col)
    label = rows.schema["label"].dataType.simpleString()
    longest = rows.agg(F.max(F.size("values"))).first()[0] or 0
    width = max(1, -(-longest // PARTS)) * PARTS
    # bounded: one row for each entry of a codebook
    seeds = rows.orderBy(F.col("id").asc_nulls_last(), "values").select("values").limit(ENTRIES).collect()
    first = np.zeros((len(seeds), width), np.int64)
    for k, r in enumerate(seeds):
        first[k, : len(r["values"])] = r["values"]
    books = first.reshape(len(seeds), PARTS, width // PARTS).transpose(1, 0, 2).copy()
    trees = stored(blocks(rows, width), "trees")
    for _ in range(ROUNDS if len(seeds) else 0):
        books = _means(trees, books)
    coded = stored(_coded(trees, books, label), "codes")
    forget(trees)
    return _with_label_error(coded), books


def _with_label_error(coded: DataFrame) -> DataFrame:
    """Errors are summed before the shuffle; on the way back a label's rows are spread over several tasks."""
    sums = coded.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    sums = sums.select(F.col("label").alias("_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))).alias("_salt"))
    salt = F.pmod(F.xxhash64("id", "code"), F.lit(LABEL_SALTS)).cast("int")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label")) & (salt == F.col("_salt")), "left").drop("_label", "_salt")


def hex_code(code: Column) -> Column:
    """Two lower-case hex digits for each part."""
    return F.lower(F.hex(code))


def codebooks_sha256(books: np.ndarray) -> str:
    """Digest of all components as decimals, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
