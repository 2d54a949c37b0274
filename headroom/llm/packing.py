"""Packing of documents into sequences: best fit decreasing per partition, certified by lower bounds, gaps repacked."""

from __future__ import annotations

import zlib
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import stored
from .common import id_text, text_slices
from .words_bpe import file_encoder, id_column, with_end

CAPACITY = 1024
PART_PIECES = 16_384
PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; only the first may be shorter than the capacity."""
    head = n % capacity or capacity
    return [(0, min(n, head))] + [(a, capacity) for a in range(head, n, capacity)] if n else [(0, 0)]


def token_pieces(docs: DataFrame, tokenizer_json: str, end_id: int, capacity: int = CAPACITY, keep_ids: bool = False,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every whole text's ids and ``end_id``, in pieces of at most ``capacity``; a null text is empty.

    ``uid, doc_id, piece, start, length, ids_crc32`` and, with ``keep_ids``, ``ids``; ``uid`` numbers the
    pieces, so rows that repeat a ``doc_id`` stay apart. One pass, no shuffle.
    """
    content = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # one tokenizer file, under 2 MB

    def encode(batches, content=content):
        encoder, uid = file_encoder(content.value, False), TaskContext.get().partitionId() << 40
        for batch in text_slices(batches):
            ids, at = with_end(*encoder.encode(batch.column("text")), end_id)
            raw, rows, out = ids.data.cast("B"), [], []
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                for k, (start, length) in enumerate(cut_points(b - a, capacity)):
                    rows.append((uid, doc, k, start, length, zlib.crc32(raw[4 * (a + start) : 4 * (a + start + length)])))
                    out.append(a + start)
                    uid += 1
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
            if keep_ids:
                arrays.append(id_column(ids, np.array([*out, len(ids)])))
            yield pa.RecordBatch.from_arrays(arrays, names=["uid", "doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)

    return id_text(docs, id_col, text_col).mapInArrow(encode, PIECES + ", ids array<int>" * keep_ids)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: the largest of the volume bound and two families of dual feasible functions.

    ``f`` maps a length so that no set of lengths that fits one bin sums to more than the capacity; then the
    sum of ``f`` over all lengths, divided by the capacity, bounds the bins.
    """
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1).astype(np.int64), capacity) if len(lengths) else 0


def bound_of_counts(count: np.ndarray, capacity: int) -> int:
    """``lower_bound`` of ``count[n]`` pieces of each length ``n`` up to the capacity."""
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    above, volume = np.cumsum(count[::-1])[::-1], np.concatenate([[0], np.cumsum(count * size)])
    for cut in range(1, capacity // 2 + 1):  # longer than capacity - cut: a whole bin; shorter than cut: nothing
        whole = int(above[capacity - cut + 1])
        best = max(best, -(-(whole * capacity + int(volume[capacity - cut + 1] - volume[cut])) // capacity))
    for k in range(1, 33):  # rounding (k + 1) x / capacity down to multiples of 1 / k, exact multiples unchanged
        exact = (size * (k + 1)) % capacity == 0
        best = max(best, -(-int((count * np.where(exact, size * k, size * (k + 1) // capacity * capacity)).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; the lengths come in falling order.

    Bins are kept by the room they have left; a bit mask of the rooms in use gives the tightest in one step.
    """
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins = 0, 0
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k, n in enumerate(lengths.tolist()):
        fits = mask >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            own = rooms[room].pop()
            if not rooms[room]:
                mask &= ~(1 << room)
        else:
            own, room, bins = bins, capacity, bins + 1
        where[k], offset[k] = own, capacity - room
        left = room - n
        if left:
            rooms[left].append(own)
            mask |= 1 << left
    return where, offset


def _packed(capacity: int, seed: int):
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("uid", "ascending")])
        lengths = table.column("length").to_numpy()
        where, offset = best_fit_decreasing(lengths, capacity)
        bins = int(where.max()) + 1
        fill = np.bincount(where, weights=lengths, minlength=bins)
        full = fill == capacity
        if bins <= lower_bound(lengths, capacity):  # proven: all it can lose is what its emptiest bin leaves
            full[:] = True
            full[np.argmin(fill)] = fill.min() == capacity
        settled = full[where]
        part = table.column("part").to_numpy()
        sequence = (np.int64(seed) << 56) + (part.astype(np.int64) << 28) + where
        return pa.Table.from_arrays([table.column("uid"), table.column("length"), pa.array(sequence), pa.array(offset), pa.array(settled)],
                                    names=["uid", "length", "sequence_id", "offset", "settled"])

    return pack


def pack(pieces: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES, rounds: int = 6) -> DataFrame:
    """``uid, sequence_id, offset`` of every piece; pieces have a unique ``uid`` and a ``length`` up to the capacity.

    Pieces are dealt by hash into partitions of about ``part_pieces``, however many there are, and packed
    best fit decreasing. A partition whose bins equal its lower bound is proven optimal and keeps all but its
    emptiest bin; of the others the full bins are settled. The pieces of all other bins are exchanged: dealt
    anew, into partitions twice as large (up to ``2 ** (rounds - 1)`` times), and packed again, until all
    bins together equal the lower bound of all pieces, one partition held the rest, or ``rounds`` are over.
    ``certificate`` tells how far from the bound that is.
    """
    spark = pieces.sparkSession
    rest = pieces.select("uid", "length")
    count = _length_counts(rest, capacity)
    n, bound, closed, done = int(count.sum()), bound_of_counts(count, capacity), 0, None
    for seed in range(1, rounds + 1):
        if not n:
            break
        parts = max(1, -(-n // (part_pieces << (seed - 1))))
        dealt = rest.select("*", F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(parts)).cast("int").alias("part"))
        out = stored(dealt.groupBy("part").applyInArrow(_packed(capacity, seed), "uid long, length long, sequence_id long, offset long, settled boolean"), "packed")
        bins, kept, n = out.agg(*(F.count_if(F.expr(x)) for x in ("offset = 0", "offset = 0 and settled", "not settled"))).first()
        over = closed + bins <= bound or parts == 1 or seed == rounds
        settled = (out if over else out.where("settled")).select("uid", "sequence_id", "offset")
        done = settled if done is None else done.unionByName(settled)
        if over:
            break
        rest, closed = out.where("not settled").select("uid", "length"), closed + kept
    return done if done is not None else spark.createDataFrame([], "uid long, sequence_id long, offset long")


def _length_counts(pieces: DataFrame, capacity: int) -> np.ndarray:
    out = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():  # at most one row a length
        out[r.length] = r.n
    return out


def certificate(placed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """The sequences of ``placed`` (``length``, ``offset``) and the lower bound that no packing of its pieces can beat."""
    return placed.where("offset = 0").count(), bound_of_counts(_length_counts(placed, capacity), capacity)


def packed_documents(docs: DataFrame, tokenizer_file: str, end_id: int = 2, capacity: int = CAPACITY, **settings) -> DataFrame:
    """The pieces of all documents with the sequence and the place that each has.

    Empty tables give no rows. Rows that repeat a ``doc_id`` are packed as rows of their own.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        content = f.read()
    pieces = stored(token_pieces(docs, content, end_id, capacity), "pieces")
    return pieces.join(pack(pieces, capacity, **settings), "uid")


def sequences(placed: DataFrame) -> DataFrame:
    """One row per sequence: ``sequence_id, n_pieces, length, ids``; ``placed`` has the pieces' ids. A sequence is bounded by the capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.count("*").alias("n_pieces"), F.sum("length").alias("length"), parts.alias("parts")).select(
        "sequence_id", "n_pieces", "length", F.flatten(F.col("parts.ids")).alias("ids"))
