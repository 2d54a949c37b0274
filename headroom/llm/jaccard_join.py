"""Similarity join of word-shingle sets: subsets for small sets, inverted lists for large ones, the boundary by cost."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import forget, stored
from .common import BITS, Sketch, bit_blocks, components, id_hashes, id_text, in_bitmap, mix, shingles, sifted, text_slices, total_sketch, united

WIDTH = 5
SHARE = (75, 100)
SKETCH_BITS = 22
SIEVE_BITS = 28  # of a bitmap at most: 32 MB
BUCKET_BYTES = 64 << 20  # of text behind one bucket of keys
BUCKET_BITS = 6  # at least
SIZES = 128  # the largest boundary that is considered
ROUNDS = 2
SLICE = 1 << 20
_TAG = np.uint64(0x51ED270B35AF1D4B)


def least_common(n, share: tuple[int, int] = SHARE):
    """A set of ``n`` that links shares at least this many members: ``n * share`` rounded up."""
    return -(-n * share[0] // share[1])


def levels_of(counts: np.ndarray) -> np.ndarray:
    """A number up to 127 for each counter that grows with its logarithm."""
    return np.minimum(127, np.round(4 * np.log2(1 + counts))).astype(np.uint8)


def boundary(sizes: dict[int, int], counts: np.ndarray, share: tuple[int, int] = SHARE) -> int:
    """The largest set size that is cheaper by subsets of two than by lists.

    ``sizes`` counts the sets by size (up to ``SIZES``), ``counts`` is the sketch of all members. An entry
    of a list costs one row and the members it meets there, on average the sketch's second moment without
    what chance collisions add; a subset costs one row and meets hardly anybody.
    """
    total = float(counts.sum())
    if not total:
        return 0
    meets = max(0.0, (float((counts.astype(float) ** 2).sum()) - total * total / len(counts)) / total - 1)
    tail = lambda n: n - least_common(n, share)
    lists = lambda n: (tail(n) + 1) * (1 + meets)
    subsets = lambda n: (tail(n) + 2) * (tail(n) + 1) / 2
    cost = {x: sum(h * subsets(n) for n, h in sizes.items() if 1 < n <= x) + sum(h * lists(n) for n, h in sizes.items() if n >= least_common(x + 1, share))
            for x in range(SIZES)}
    return min(cost, key=lambda x: (cost[x], x))


def in_order(members: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The members as numbers that sort by the corpus frequency of their bucket, rare ones first."""
    bits = len(levels).bit_length() - 1
    return np.sort(levels[(members >> np.uint64(64 - bits)).astype(np.int64)].astype(np.uint64) << np.uint64(56) | members >> np.uint64(8))


def set_keys(members: np.ndarray, levels: np.ndarray, light: int, share: tuple[int, int] = SHARE) -> tuple[np.ndarray, np.ndarray, int]:
    """The keys under which a set meets all sets that it may link with, their room, and the last member among its first ``tail + 1``.

    Two sets that link share at least one of their first ``tail + 1`` members in corpus order, and two of
    their first ``tail + 2``. A set of at most ``light`` members enters all pairs of the latter; larger
    ones, and those that may link with a larger one, enter the inverted lists of the former. A key's room
    is the number of members that the set can have in common with a set that shares none before the key
    (nor between the two members of a pair).
    """
    n = len(members)
    tail = n - least_common(n, share)
    first = in_order(members, levels)[: tail + 2]
    out, room = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    if n >= least_common(light + 1, share):
        out.append(mix(first[: tail + 1]))
        room.append(n - np.arange(tail + 1))
    if n <= light:
        a, b = np.triu_indices(len(first), 1)
        out.append(mix(first[a] * _TAG + first[b]))
        room.append(n - b + 1)
    return np.concatenate(out), np.concatenate(room), int(first[tail])


def _profile(batches, width: int, bits: int):
    """One row for each document (size and id of its set) and, at the end, the task's sketch."""
    sketch = Sketch(bits)
    for batch in text_slices(batches, limit=SLICE):
        members, at = shingles(batch.column("text"), width)
        sketch.add(members)
        sets = [xxhash.xxh3_64_intdigest(members[a:b].tobytes()) - 2**63 if b > a else None for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        none = pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("content"), pa.array(np.diff(at)), pa.array(sets, pa.int64()), *none], names=["doc_id", "content", "n", "set", "block", "counts"])
    blocks, counts = sketch.blocks()
    none = [pa.nulls(len(blocks), pa.int64())] * 4
    yield pa.RecordBatch.from_arrays([*none, pa.array(blocks, pa.int32()), pa.array(counts, pa.binary())], names=["doc_id", "content", "n", "set", "block", "counts"])


def _own_keys(batches, width: int, levels, light: int, share, cut: int, first):
    """For each slice: keys without their ``cut`` lowest bits, their room, names, sizes and last members of its sets of two or more members.

    Only rows whose id may be the first of its set's are read, and each set once a task.
    """
    seen: set[int] = set()
    for batch in text_slices(batches, limit=SLICE):
        batch = batch.filter(pa.array(in_bitmap(first.value, id_hashes(batch.column("doc_id")))))
        members, at = shingles(batch.column("text"), width)
        keys, rooms, rows = [], [], []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            own = members[a:b]
            name = xxhash.xxh3_64_intdigest(own.tobytes()) - 2**63
            if b - a > 1 and name not in seen:
                seen.add(name)
                found, room, last = set_keys(own, levels.value, light, share)
                keys.append(found >> np.uint64(cut))
                rooms.append(room)
                rows.append((name, b - a, last))
        if keys:
            yield keys, rooms, rows


def _key_buckets(batches, width: int, levels, light: int, share, cut: int, first):
    """The keys of each slice, dealt by their high bits, of which the bucket's number stands for all but 32.

    Those under which a set leads (``_leads``) and the others are apart; a key is sent three times at most, so that two are told from more.
    """
    for keys, rooms, rows in _own_keys(batches, width, levels, light, share, cut, first):
        need = [-(-2 * n * share[0] // sum(share)) for _, n, _ in rows]
        leads = np.concatenate([room >= least for room, least in zip(rooms, need, strict=True)])
        flat, parts = np.concatenate(keys), {}
        for k, chosen in enumerate((flat[leads], flat[~leads])):
            values, count = np.unique(chosen, return_counts=True)
            values = np.repeat(values, np.minimum(count, 3))
            buckets, at = np.unique(values >> np.uint64(32), return_index=True)
            for bucket, x in zip(buckets.tolist(), np.split(values.astype("<u4"), at[1:]), strict=True):
                parts.setdefault(bucket, [b"", b""])[k] = x.tobytes()
        yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), *(pa.array([p[k] for p in parts.values()], pa.binary()) for k in range(2))], names=["bucket", "leading", "other"])


def _repeated(table: pa.Table) -> pa.Table:
    """The keys of a bucket that are there more than once, whether a set leads under them, and whether they are there more than twice."""
    leading, other = (np.frombuffer(b"".join(table.column(c).to_pylist()), "<u4") for c in ("leading", "other"))
    keys, count = np.unique(np.concatenate([leading, other]), return_counts=True)
    keys, many = keys[count > 1], count[count > 1] > 2
    led = np.isin(keys, leading)
    high = table.column("bucket")[0].as_py() << 32 if table.num_rows else 0
    return pa.table({"key": pa.array(keys.astype(np.int64) + high), "led": pa.array(led), "many": pa.array(many)})


def _sieve(keys: DataFrame, bits: int) -> np.ndarray:
    """The packed bits of all rows of ``keys``; a task makes them block by block."""
    def note(batches):
        yield from bit_blocks(np.concatenate([np.zeros(0, np.uint64), *(id_hashes(b.column("key")) for b in batches)]), bits).to_batches()

    return united(keys.select("key").mapInArrow(note, BITS), bits)


def sieve_bits(rows: int) -> int:
    """Bits enough for one in 32 or fewer to be set, from 2 ** 20 to 2 ** ``SIEVE_BITS``."""
    return min(SIEVE_BITS, max(20, (32 * rows).bit_length()))


def _entries(batches, width: int, levels, light: int, share, cut: int, first, repeated):
    """A row (set, n, last) for each set, and a row (key, set, n, room) for each of its keys that others may have."""
    names = ["key", "set", "n", "room", "last"]
    for keys, rooms, rows in _own_keys(batches, width, levels, light, share, cut, first):
        own, sizes, last = (np.array([r[k] for r in rows], np.int64) for k in range(3))
        flat, count = np.concatenate(keys).view(np.int64), [len(k) for k in keys]
        kept = in_bitmap(repeated.value, id_hashes(pa.array(flat)))
        key = flat[kept]
        columns = key, np.repeat(own, count)[kept], np.repeat(sizes, count)[kept], np.concatenate(rooms)[kept]
        yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.nulls(len(key), pa.int64())], names=names)
        none = pa.nulls(len(rows), pa.int64())
        yield pa.RecordBatch.from_arrays([none, pa.array(own), pa.array(sizes), none, pa.array(last)], names=names)


def _linked(batches, width: int, share):
    """The pairs of texts whose sets link. A text that several neighbouring rows share is cut up once."""
    cached: dict[int, np.ndarray] = {}
    for batch in text_slices(batches, "a_text", SLICE):
        out_a, out_b = [], []
        for a, b, a_text, b_text in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "a_text", "b_text")), strict=True):
            if len(cached) > 64:
                cached = {}
            for name, text in ((a, a_text), (b, b_text)):
                if name not in cached:
                    cached[name] = shingles(pa.array([text], pa.string()), width)[0]
            x, y = cached[a], cached[b]
            both = len(np.intersect1d(x, y, assume_unique=True))
            if share[1] * both >= share[0] * (len(x) + len(y) - both):
                out_a.append(a)
                out_b.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])


def _may_link(n, m, share: tuple[int, int]):
    """The smaller set is large enough for the larger one."""
    return F.least(n, m) * share[1] >= F.greatest(n, m) * share[0]


def _needed(n, m, share: tuple[int, int]):
    """The members that sets of ``n`` and ``m`` must have in common to link."""
    return F.ceil((n + m) * share[0] / sum(share))


def _leads(share: tuple[int, int]):
    """An entry with room enough for a set as large as its own: the smaller set of a link has one under the first key both have."""
    return F.col("room") >= _needed(F.col("n"), F.col("n"), share)


def hubs(left: DataFrame, turn: int, share: tuple[int, int]) -> DataFrame:
    """``key, hub, m, c``: one set of each key, by chance among those that lead, or that whose members before the key are fewest, its size and component."""
    chance = F.shiftrightunsigned(F.xxhash64("set", F.lit(turn)), 1)
    by = F.when(_leads(share), -chance - 1).otherwise(chance) if turn % 2 == 0 else F.shiftleft(F.col("n") - F.col("room"), 40) + F.shiftrightunsigned(chance, 24)
    return left.groupBy("key").agg(F.min_by("set", by).alias("hub"), F.min_by("n", by).alias("m"), F.min_by("component", by).alias("c"))


def apart(left: DataFrame, share: tuple[int, int] = SHARE) -> DataFrame:
    """The pairs ``a, b`` of sets from different components that can link with a key of ``left`` as the first both have.

    The smaller set must lead, so keys of a passage that stands behind each set's own members emit nothing, however
    many sets hold it. Lists meet in bands of size: a set only sees those of its own band and the next one.
    """
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(1.01 * share[1] / share[0])))  # 1.01: one link spans less than a band
    small = left.where(_leads(share)).withColumn("band", F.explode(F.array(band, band + 1)))
    large = left.select("key", band.alias("band"), F.col("set").alias("other"), F.col("n").alias("m"), F.col("room").alias("space"), F.col("component").alias("c"))
    both = small.join(large, ["key", "band"]).where((F.col("n") < F.col("m")) | ((F.col("n") == F.col("m")) & (F.col("set") < F.col("other"))))
    both = both.where((F.col("component") != F.col("c")) & (F.least("room", "space") >= _needed(F.col("n"), F.col("m"), share)))
    return both.select(F.least("set", "other").alias("a"), F.greatest("set", "other").alias("b")).distinct()


def similar_sets(docs: DataFrame, width: int = WIDTH, share: tuple[int, int] = SHARE, bits: int = SKETCH_BITS, rounds: int = ROUNDS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    A document's set holds its distinct ``width``-word shingles (words ``[^\\x20\\x09-\\x0D]+``, A-Z
    lower-cased); fewer words are one shingle, no words none. Sets link when ``share[1] * common >=
    share[0] * united``; empty sets link with nothing. ``component_id`` is the smallest id reachable. Rows
    without an id are returned with a null component and link nobody; rows that share an id are judged by
    their own text. Members and sets are compared by 64-bit hashes.

    Equal sets are one node. A pair's texts are only compared if the keys of both leave it possible. In each
    of ``rounds`` rounds every key compares its sets with one of them only, its hub, so a key with a third of
    all sets costs a row for each; what is linked joins components, and keys whose sets are all in one
    component are done. Then the pairs from different components are compared for which the sizes and the
    members before a key leave room for a link (``apart``). Each link has such a key, so none is lost.
    """
    spark = docs.sparkSession
    base = id_text(docs, id_col, text_col)
    profile = stored(base.withColumn("content", F.xxhash64("text")).mapInArrow(lambda b: _profile(b, width, bits), "doc_id long, content long, n long, set long, block int, counts binary"), "sets")
    sets = profile.where("block is null").select("doc_id", "content", "n", "set")
    counts = total_sketch(profile.where("block is not null"), bits)
    sizes = {r.s: r.n for r in sets.where("n > 1").groupBy(F.least("n", F.lit(SIZES + 1)).alias("s")).agg(F.count("*").alias("n")).collect()}  # at most SIZES rows
    light = boundary(sizes, counts, share)
    levels = spark.sparkContext.broadcast(levels_of(counts))  # 2 ** bits bytes

    volume = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    owners = stored(sets.where("doc_id is not null").groupBy("set").agg(F.min(F.struct("doc_id", "content")).alias("one")).select("set", "one.*"), "owners")
    first = spark.sparkContext.broadcast(_sieve(owners.where("set is not null").select(F.col("doc_id").alias("key")), sieve_bits(owners.count())))
    cut = 32 - max(BUCKET_BITS, (volume // BUCKET_BYTES).bit_length())
    with_id = base.where("doc_id is not null")
    packed = with_id.mapInArrow(lambda b: _key_buckets(b, width, levels, light, share, cut, first), "bucket int, leading binary, other binary")
    common = stored(packed.groupBy("bucket").applyInArrow(_repeated, "key long, led boolean, many boolean"), "common")
    repeated = spark.sparkContext.broadcast(_sieve(common, sieve_bits(common.count())))
    entries = stored(with_id.mapInArrow(lambda b: _entries(b, width, levels, light, share, cut, first, repeated), "key long, set long, n long, room long, last long"), "entries")
    met = entries.where("key is not null").drop("last")
    shared = stored(met.join(common, "key").distinct(), "shared")
    forget(common)

    info = entries.where("key is null").groupBy("set").agg(F.max("n").alias("n"), F.max("last").alias("last"))
    lists = stored(shared.groupBy("set").agg(F.collect_list("key").alias("keys")).join(info, "set"), "lists")

    edges, tried = None, None
    forget(entries)
    left = stored(shared.where("led").drop("led").withColumn("component", F.col("set")), "left")  # no link has its first key elsewhere
    forget(shared)
    for turn in range(rounds + 1):
        if turn < rounds:
            pairs = left.join(hubs(left, turn, share), "key").where(F.col("component") != F.col("c")).where(_may_link(F.col("n"), F.col("m"), share))
            pairs = pairs.select(F.least("set", "hub").alias("a"), F.greatest("set", "hub").alias("b")).distinct()
        else:
            pairs = apart(left, share)
        pairs = _possible(pairs, lists, light, share)
        pairs = stored(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        wanted = pairs.select(F.col("a").alias("set")).union(pairs.select(F.col("b").alias("set"))).distinct()
        wanted = stored(wanted.join(owners, "set"), "wanted")
        texts = stored(_texts_of(base, wanted), "texts")  # of this turn only: a join with all that were compared would send them again
        with_texts = (pairs.join(texts.select(F.col("set").alias("a"), F.col("text").alias("a_text")), "a")
                      .join(texts.select(F.col("set").alias("b"), F.col("text").alias("b_text")), "b"))
        new = stored(with_texts.mapInArrow(lambda b: _linked(b, width, share), "a long, b long"), "links")
        edges = new if edges is None else edges.unionByName(new)
        component = stored(components(edges, name="set-component"), "components")
        forget(wanted, texts)
        if turn == rounds:
            break
        many = left.where("many")  # the two sets of another key have met, one of them as its hub
        placed = many.drop("component").join(component.withColumnRenamed("node", "set"), "set", "left").withColumn("component", F.coalesce("component", "set"))
        mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
        old, left = left, stored(placed.join(mixed, "key"), "left")
        forget(old)
        if not left.limit(1).count():
            break
    placed = sets.join(component.withColumnRenamed("node", "set"), "set", "left").withColumn("component", F.coalesce("component", "set"))
    smallest = placed.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    out = placed.join(smallest, "component", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))).alias("component_id"))


def _possible(pairs: DataFrame, lists: DataFrame, light: int, share: tuple[int, int]) -> DataFrame:
    """The pairs whose first members leave room for enough common ones.

    Of two sets take the one whose first members end earlier: those of them that the other set's first
    members lack are not in the other set at all. Sets that enter subsets are passed on.
    """
    side = lambda x: lists.select(F.col("set").alias(x), F.col("n").alias(f"n_{x}"), F.col("last").alias(f"last_{x}"), F.col("keys").alias(f"keys_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    n = F.when(F.col("last_a") <= F.col("last_b"), F.col("n_a")).otherwise(F.col("n_b"))
    behind = F.ceil(n * share[0] / share[1]) - 1  # members after the first ones
    enough = behind + F.size(F.array_intersect("keys_a", "keys_b")) >= _needed(F.col("n_a"), F.col("n_b"), share)
    return both.where((F.least("n_a", "n_b") <= light) | enough).select("a", "b")


def _texts_of(base: DataFrame, involved: DataFrame) -> DataFrame:
    """``set, text`` of the documents in ``involved``."""
    maybe, _ = sifted(base.where("doc_id is not null"), involved)
    return maybe.withColumn("content", F.xxhash64("text")).join(involved, ["doc_id", "content"]).select("set", "text")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """``docs`` without the documents that reach one of smaller id: one of each group stays, with all its columns."""
    found = similar_sets(docs, id_col=id_col, **settings)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)
