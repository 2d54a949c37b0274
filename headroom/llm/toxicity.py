"""Toxicity of documents: a factorization machine over hashed terms, fitted on a bounded sample of labels."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _LOWER, _P, _powers, bound_batches, column_bytes, id_text, mix, text_slices, worker_state

BITS = 18
FACTORS = 8
SAMPLE = 12_000
EPOCHS = 12
PREFIXES = (3, 4, 5, 6, 7, 8)
LEAST_ROWS = 8
LEAST_Z = 5.0
SLICE = 1 << 20

_LETTER = np.ones(256, dtype=bool)  # a-z, A-Z and all bytes beyond ASCII
_LETTER[:128] = False
_LETTER[65:91] = _LETTER[97:123] = True


def terms(column: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed terms of each row: (row, term), rows in order.

    Terms are the words (runs of letters, A-Z lower-cased) and, of longer words, their first few bytes,
    which invented and inflected forms share.
    """
    data, offsets = column_bytes(column)
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 2
    word = _LETTER[data]
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    inner = offsets[1:-1]
    inner = inner[(inner < n) & (inner > 0)]
    starts[inner] = word[inner]
    ends[inner - 1] = word[inner - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    length = end - start
    row = np.searchsorted(offsets, start, side="right") - 1
    values, rows = [], []
    for size in (0, *PREFIXES):
        own = np.flatnonzero(length > size)
        stop = start[own] + size if size else end[own]
        values.append(mix((sums[stop] - sums[start[own]]) * down[start[own]] * _P + np.uint64(size)))
        rows.append(row[own])
    term = np.concatenate(values) >> np.uint64(64 - bits)
    key = np.unique(np.concatenate(rows).astype(np.uint64) << np.uint64(bits) | term)
    return (key >> np.uint64(bits)).astype(np.int64), (key & np.uint64((1 << bits) - 1)).astype(np.int64)


def telling(pairs: list[np.ndarray], labels: np.ndarray, bits: int, least_rows: int = LEAST_ROWS, least_z: float = LEAST_Z) -> np.ndarray:
    """The terms whose share of rows differs between the labels by ``least_z`` standard errors; thousands of others differ by chance."""
    rows = np.bincount(np.concatenate(pairs), minlength=1 << bits)
    ones = np.bincount(np.concatenate([p for p, y in zip(pairs, labels, strict=True) if y == 1]), minlength=1 << bits)
    n1 = labels.sum()
    n0 = len(labels) - n1
    share = rows / len(labels)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n1 + 1 / n0))
    return np.flatnonzero((rows >= least_rows) & (np.abs(ones / n1 - (rows - ones) / n0) >= least_z * error))


class FactorizationMachine:
    """``bias + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j`` through the logistic function; ``x_i`` says that the term is there.

    Only the terms in ``ids`` count; the others' weights and factors are zero.
    """

    def __init__(self, bits: int, bias: float, ids: np.ndarray, w: np.ndarray, v: np.ndarray):
        self.bits, self.bias, self.ids, self.w, self.v = bits, bias, ids, w, v
        self.place = np.full(1 << bits, -1)
        self.place[ids] = np.arange(len(ids))

    def to_bytes(self) -> bytes:
        return np.concatenate([[self.bits, self.bias, len(self.ids)], self.ids, self.w, self.v.ravel()]).astype("<f8").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> FactorizationMachine:
        x = np.frombuffer(raw, "<f8")
        n = int(x[2])
        return cls(int(x[0]), float(x[1]), x[3 : 3 + n].astype(np.int64), x[3 + n : 3 + 2 * n], x[3 + 2 * n :].reshape(n, -1) if n else np.zeros((0, 1)))

    def logits(self, row: np.ndarray, at: np.ndarray, rows: int) -> np.ndarray:
        """``at`` are places in ``ids``."""
        v = self.v[at]
        total = np.stack([np.bincount(row, v[:, f], rows) for f in range(v.shape[1])], 1)
        return self.bias + np.bincount(row, self.w[at], rows) + 0.5 * ((total**2).sum(1) - np.bincount(row, (v * v).sum(1), rows))

    def scores(self, row: np.ndarray, term: np.ndarray, rows: int) -> np.ndarray:
        at = self.place[term]
        z = self.logits(row[at >= 0], at[at >= 0], rows)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    @classmethod
    def fit(cls, pairs: list[np.ndarray], labels: np.ndarray, bits: int, factors: int, epochs: int, rate: float = 0.1, decay: float = 1e-4, batch: int = 32) -> FactorizationMachine:
        """AdaGrad on the logistic loss over rows of terms; the same rows in the same order give the same model."""
        positive = float(labels.sum())
        bias = float(np.log((positive + 1) / (len(labels) - positive + 1)))
        if not 0 < positive < len(labels):
            return cls(bits, bias, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, factors)))
        rng = np.random.default_rng(7)
        ids = telling(pairs, labels, bits)
        model = cls(bits, bias, ids, np.zeros(len(ids)), rng.normal(0, 0.01, (len(ids), factors)))
        rows = [(at := model.place[p])[at >= 0] for p in pairs]
        gw, gv = np.full(len(ids), 1e-2), np.full((len(ids), factors), 1e-2)
        for epoch in range(epochs):
            order = rng.permutation(len(rows))
            step = rate / (1 + epoch)
            for begin in range(0, len(order), batch):
                own = order[begin : begin + batch]
                row = np.repeat(np.arange(len(own)), [len(rows[k]) for k in own])
                at = np.concatenate([rows[k] for k in own])
                error = 1 / (1 + np.exp(-np.clip(model.logits(row, at, len(own)), -30, 30))) - labels[own]
                v = model.v[at]
                total = np.stack([np.bincount(row, v[:, f], len(own)) for f in range(factors)], 1)
                touched, where = np.unique(at, return_inverse=True)
                dw = np.bincount(where, error[row]) + decay * model.w[touched]
                dv = error[row][:, None] * (total[row] - v)
                dv = np.stack([np.bincount(where, dv[:, f], len(touched)) for f in range(factors)], 1) + decay * model.v[touched]
                gw[touched] += dw * dw
                gv[touched] += dv * dv
                model.w[touched] -= step * dw / np.sqrt(gw[touched])
                model.v[touched] -= 0.3 * step * dv / np.sqrt(gv[touched])
                model.bias -= 0.1 * step * float(error.sum()) / len(own)
        return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS, factors: int = FACTORS, epochs: int = EPOCHS,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> bytes:
    """The machine's bytes (a weight and factors for each telling term), fitted on at most ``sample`` labelled rows that are not held out.

    The sample is the rows whose hashed id is smallest, so it is the same in every run. Ids with several
    labels take the largest; null ids and labels are left out. Without both labels the score is constant.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def extract(batches):
        for batch in text_slices(batches, limit=SLICE):
            row, term = terms(batch.column("text"), bits)
            at = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.ListArray.from_arrays(at, pa.array(term.astype(np.int32)))], names=["doc_id", "toxic", "terms"])

    rows = id_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic").mapInArrow(extract, "doc_id long, toxic int, terms array<int>")

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending")])
        pairs = [t.values.to_numpy() for t in table.column("terms")]
        model = FactorizationMachine.fit(pairs, table.column("toxic").to_numpy().astype(float), bits, factors, epochs)
        return pa.table({"model": pa.array([model.to_bytes()], pa.binary())})

    # one task by design: the sample is bounded
    found = rows.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(train, "model binary").collect()
    return bytes(found[0].model) if found else FactorizationMachine.fit([], np.zeros(0), bits, factors, 0).to_bytes()


def score(docs: DataFrame, model: bytes, bits: int = BITS, text_col: str = "text", name: str = "score", keep: tuple[str, ...] | None = None) -> DataFrame:
    """All rows of ``docs`` with ``score``, the probability that the label is 1; a null text is empty.

    ``keep`` names the columns to carry (all by default); a column named like the score is replaced. Nothing but the text is looked at; one pass, no shuffle.
    """
    bound_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by bits and factors
    kept = [c for c in (docs.columns if keep is None else keep) if c != name]
    others = [c for c in kept if c != text_col]
    base = docs.select(F.struct(*others, F.lit(1).alias("__")).alias("row"), F.col(text_col).alias("text"))
    with_text = text_col in kept

    def run(batches):
        machine = worker_state(f"machine_{hash(shared.value)}", lambda: FactorizationMachine.from_bytes(shared.value), alone=True)
        for batch in text_slices(batches, limit=SLICE):
            values = machine.scores(*terms(pc.fill_null(batch.column("text"), ""), bits), batch.num_rows)
            columns = [batch.column("row"), *([batch.column("text")] if with_text else []), pa.array(values)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", *(["text"] if with_text else []), "score"])

    out = base.mapInArrow(run, f"row {base.schema['row'].dataType.simpleString()}, " + "text string, " * with_text + "score double")
    return out.select(*(F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in kept), F.col("score").alias(name))
