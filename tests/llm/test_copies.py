"""Operators 2, 3, 8 and 9 against brute force."""

import hashlib
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headroom.llm import cap_filters, common, jaccard_join, line_dedup, queries, suffix_dedup

from . import brute
from .conftest import ODD


def near_copies(seed=3, groups=12, size=25):
    """Groups of edited copies, passages that many texts share, and lone texts."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    passage = " ".join(rng.choices(words, k=60))
    out = []
    for _ in range(groups):
        own = rng.choices(words, k=rng.randint(3, 220))
        for _ in range(size):
            text = [rng.choice(words) if rng.random() < 0.012 else w for w in own]
            out.append(" ".join(text) + (" " + passage if rng.random() < 0.3 else ""))
    out += [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(100)] + [passage] * 5
    rng.shuffle(out)
    return list(enumerate(out))


def test_components(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 300)] + [(rng.randint(400, 900), rng.randint(400, 900)) for _ in range(300)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = brute.roots({x for p in links for x in p}, links)
    assert got == {k: v for k, v in want.items() if any(k in p and p[0] != p[1] for p in links)}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\n\x0bé", max_size=40)), max_size=6))
def test_shingle_sets(texts):
    column = pa.array([t or "" for t in texts], pa.string())
    members, at = common.shingles(column)
    assert np.diff(at).tolist() == [len(brute.shingles(t)) for t in texts]
    sets = [frozenset(members[a:b].tolist()) for a, b in zip(at, at[1:], strict=False)]
    for x, a in zip(texts, sets, strict=True):
        for y, b in zip(texts, sets, strict=True):
            assert (a == b) == (brute.shingles(x) == brute.shingles(y))


def test_jaccard_join_odd(odd):
    rows = jaccard_join.similar_sets(odd).collect()
    want = brute.jaccard(list({d: t for d, t in ODD if d is not None}.items()))
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows)
    expected = Counter((d, *want[d]) if d is not None else (None, len(brute.shingles(t)), None) for d, t in ODD)
    assert got == expected


def test_jaccard_join_near_copies(spark):
    docs = near_copies()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute.jaccard(docs)
    for settings_ in ({}, {"rounds": 0}):
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_sets(frame, **settings_).collect()} == want
    kept = {r.doc_id for r in jaccard_join.one_of_each(frame).collect()}
    assert kept == {v[1] for v in want.values()}


def test_jaccard_keys_meet_for_any_boundary():
    rng = np.random.default_rng(2)
    levels = rng.integers(0, 30, 1 << 10).astype(np.uint8)
    for _ in range(300):
        n = int(rng.integers(2, 60))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([rng.choice(a, max(1, int(len(a) * rng.uniform(0.8, 1))), replace=False), rng.integers(0, 2**63, int(rng.integers(0, 8))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 75 * (len(a) + len(b) - both) and set(a.tolist()) != set(b.tolist()):
            for light in (0, 5, 17, 100):
                (keys, room, _), (others, space, _) = (jaccard_join.set_keys(x, levels, light) for x in (a, b))
                need = -(-75 * (len(a) + len(b)) // 175)
                _, at, to = np.intersect1d(keys, others, return_indices=True)
                assert (np.minimum(room[at], space[to]) >= need).any()


def templates(documents, own, seed=9):
    """Texts of one template and words of their own before it, after it or on both sides."""
    rng = random.Random(seed)
    form = " ".join(f"form{k}" for k in range(54))
    out = []
    for d in range(documents):
        mine = [f"own{d}x{k}" for k in range(rng.choice(own))]
        cut = rng.choice((0, len(mine), len(mine) // 2))
        out.append((d, " ".join([*mine[:cut], form, *mine[cut:]])))
    return out


@pytest.mark.parametrize("own", [[10], [0, 3, 9, 12], [5, 40, 80]])
@pytest.mark.parametrize("rounds", [0, 2])
def test_jaccard_join_templates(spark, own, rounds):
    docs = templates(120, own)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_sets(frame, rounds=rounds).collect()} == brute.jaccard(docs)


def test_jaccard_template_emits_no_pairs(spark):
    """A passage that all sets hold behind members of their own is no candidate, whatever the number of sets."""
    levels = np.zeros(1 << 10, np.uint8)
    shared = np.arange(1, 51, dtype=np.uint64) << np.uint64(52)
    rows = []
    for d in range(300):
        mine = np.arange(1, 11, dtype=np.uint64) + np.uint64(1000 * d + 100)
        keys, room, _ = jaccard_join.set_keys(np.concatenate([shared, mine << np.uint64(8)]), levels, 0)
        rows += [(int(k), d, 60, int(r), d) for k, r in zip(keys.view(np.int64), room, strict=True)]
    left = spark.createDataFrame(rows, "key long, set long, n long, room long, component long")
    assert left.groupBy("key").count().where("count = 300").count() > 0
    assert jaccard_join.apart(left).count() == 0
    near = left.where("set < 3").withColumn("room", left.n)
    assert sorted(map(tuple, jaccard_join.apart(near).collect())) == [(0, 1), (0, 2), (1, 2)]


def test_jaccard_join_sends_no_key_twice(spark, monkeypatch):
    """Copies in several partitions send their set's keys once; two sets alone under a key are done when they have met."""
    form = " ".join(f"form{k}" for k in range(80))
    one, other = (f"{form} " + " ".join(f"{name}{k}" for k in range(25)) for name in ("one", "other"))
    docs = [*((d, one) for d in range(20)), (20, other)]
    kept, real = {}, jaccard_join.stored

    def noted(df, name="table"):
        out = real(df, name)
        kept.setdefault(name, []).append(out.collect())
        return out

    monkeypatch.setattr(jaccard_join, "stored", noted)
    monkeypatch.setattr(jaccard_join, "boundary", lambda *_: 0)  # lists only
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_sets(frame).collect()} == brute.jaccard(docs)
    sent = Counter((r.key, r.set) for r in kept["entries"][0] if r.key is not None)
    assert sent and max(sent.values()) == 1
    assert len({r.set for r in kept["left"][0]}) == 2 and kept["left"][1] == []


def test_jaccard_keys_of_three_sets_in_a_slice_are_told_from_two():
    levels = np.zeros(1 << 10, np.uint8)
    texts = [" ".join([*(f"form{k}" for k in range(12)), f"own{d}"]) for d in range(3)]
    first = np.full(1 << 17, 255, np.uint8)

    def found(rows):
        batch = pa.RecordBatch.from_arrays([pa.array(range(rows), pa.int64()), pa.array(texts[:rows])], names=["doc_id", "text"])
        packed = pa.Table.from_batches(jaccard_join._key_buckets([batch], 5, SimpleNamespace(value=levels), 200, jaccard_join.SHARE, 26, SimpleNamespace(value=first)))
        buckets = [jaccard_join._repeated(packed.filter(pc.equal(packed.column("bucket"), b))) for b in packed.column("bucket").unique()]
        return pa.concat_tables(buckets).to_pydict()

    two, three = found(2), found(3)
    assert two["key"] and not any(two["many"])
    assert set(two["key"]) <= set(three["key"]) and any(three["many"])


def test_jaccard_boundary_follows_the_cost():
    flat, steep = np.full(1024, 5), np.zeros(1024, int)
    steep[0] = 5120
    sizes = dict.fromkeys(range(2, 40), 10)
    assert jaccard_join.boundary(sizes, flat) < jaccard_join.boundary(sizes, steep)
    assert jaccard_join.boundary({}, np.zeros(1024, int)) == 0


def test_jaccard_join_query(spark, small, small_docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op2_ngram_jaccard_join(spark, small).collect()}
    assert got == brute.jaccard(small_docs)


def test_jaccard_join_empty(none):
    assert jaccard_join.similar_sets(none).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60), max_size=5))
def test_equal_strings_select_the_same_place(texts):
    column = pa.array(texts, pa.string())
    a = suffix_dedup.Anchors(column, 12, 5)
    place = {}
    for row, lo, count, gram in zip(a.row, a.lo, a.count, a.gram, strict=True):
        for s in range(lo, lo + count):
            w = texts[row][s : s + 12]
            assert len(w) == 12 and place.setdefault(w, gram) == gram
    assert sum(a.count) == sum(max(0, len(t) - 11) for t in texts)


def repeats(frame, **settings_):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffix_dedup.drop_repeats(frame, **settings_).collect())


def test_heads_fill_all_buckets():
    rng = np.random.default_rng(3)
    a = suffix_dedup.Anchors(pa.array(["".join(chr(97 + c) for c in rng.integers(0, 26, 200_000))]), 100, 40)
    count = np.bincount((a.gram >> np.uint64(60)).astype(int), minlength=16)
    assert count.min() > 0.7 * count.mean() and count.max() < 1.3 * count.mean()


def test_suffix_dedup_odd(odd):
    want = brute.repeats(list({d: t for d, t in ODD if d is not None}.items()))
    whole = lambda t: (len((t or "").encode()), 0, 0, hashlib.sha256((t or "").encode()).hexdigest())
    assert repeats(odd) == Counter((d, *(want[d] if d is not None else whole(t))) for d, t in ODD)


def test_suffix_dedup_passages(spark):
    docs = near_copies(9, 6, 12) + [(1000 + k, "x" * k) for k in range(90, 240, 30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = Counter((d, *v) for d, v in brute.repeats(docs).items())
    for settings_ in ({}, {"batches": 1}, {"batches": 4, "heavy": 2, "bucket_bytes": 1 << 12}):
        assert repeats(frame, **settings_) == want


def test_suffix_dedup_query(spark, small, small_docs):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op3_suffix_array_dedup(spark, small).collect()}
    assert got == brute.repeats(small_docs)


def test_suffix_dedup_empty(none):
    assert suffix_dedup.drop_repeats(none).count() == 0


def test_perfect_hash():
    keys = common.mix(np.arange(1, 20_000, dtype=np.uint64))
    index = line_dedup.PerfectHash(line_dedup.PerfectHash.build(keys))
    assert sorted(index.index(keys).tolist()) == list(range(len(keys)))
    assert line_dedup.PerfectHash(line_dedup.PerfectHash.build(keys[:0])).index(keys).max() == -1


def test_line_dedup_odd(odd):
    rows = line_dedup.drop_lines(odd).collect()
    want = brute.line_dedup([(d, t) for d, t in ODD if d is not None])
    whole = lambda t: ((t or "").count("\n") + 1, 0, hashlib.sha256((t or "").encode()).hexdigest())
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in rows)
    assert got == Counter((d, *(want[d] if d is not None else whole(t))) for d, t in ODD)
    assert all(r.row == "r" and r.drop == "d" and r.part == 3 for r in rows)


def test_line_dedup_hot_line(spark):
    docs = [(k, f"the same long line\nown line number {k}\n{'rare line of two' if k in (5, 90) else k}") for k in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = {r.doc_id: (r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in line_dedup.drop_lines(frame).collect()}
    assert got == brute.line_dedup(docs)


LONG_LINE = "one line of many words " * 20_000


@pytest.mark.parametrize("docs", [
    [(1, None)], [(1, "short"), (2, "short")], [(k, "one long line that all documents hold") for k in range(300)], [(1, LONG_LINE), (2, f"x\n{LONG_LINE}")], [(1, ""), (2, "\n\n")],
])
def test_line_dedup_few_keys(spark, docs):
    """Slices of null, short or heavy lines only, and of one long line."""
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    got = {r.doc_id: (r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in line_dedup.drop_lines(frame).collect()}
    assert got == brute.line_dedup(docs)


def test_line_dedup_query(spark, small, small_docs):
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in queries.op8_line_dedup(spark, small).collect()}
    assert got == brute.line_dedup(small_docs)


def test_line_dedup_empty(none):
    assert line_dedup.drop_lines(none).count() == 0


def test_near_vectors(spark):
    rng = np.random.default_rng(4)
    rows, k = [], 0
    for label in (0, 1, 2):
        for _ in range(40):
            base = rng.normal(size=24)
            for _ in range(int(rng.integers(1, 6))):
                rows.append((k, (base + rng.normal(size=24) * 0.12).astype("f4").tolist(), label))
                k += 1
    hot = rng.normal(size=24)
    rows += [(k + i, (hot + rng.normal(size=24) * 0.05).astype("f4").tolist(), 1) for i in range(150)]
    k += 150
    rows += [(k + i, hot.astype("f4").tolist(), 1) for i in range(40)]
    k += 40
    good = len(rows)
    rows += [(k, None, 1), (k + 1, [0.0] * 24, 1), (k + 2, [float("nan")] * 24, 1), (k + 3, [None] * 24, 1), (k + 4, hot.tolist(), None), (k + 5, [], 1), (k + 6, hot.tolist()[:10], 1), (None, hot.tolist(), 1)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, same string, n int")
    got = {r.vec_id: r for r in cap_filters.near_vectors(frame, block=32).collect()}
    x = np.array([np.array(r[1], "f8") / np.linalg.norm(r[1]) for r in rows[:good]])
    label = np.array([r[2] for r in rows[:good]])
    near = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    found = sum(got[i].n_links for i in range(good))
    assert found >= 0.95 * near.sum() and all(got[i].n_links <= near[i].sum() for i in range(good))
    root = brute.roots(range(good), [(a, b) for a, b in zip(*np.nonzero(near), strict=True)])
    assert sum(got[i].component_id != root[i] for i in range(good)) <= 0.03 * good
    for i in range(good, len(rows) - 1):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)
    assert cap_filters.near_vectors(frame.limit(0)).count() == 0


def test_list_decoding_finds_all():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(20, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rotation, left, right = cap_filters.codebook(16, 12)
    y = x @ rotation
    total = (y[:, :8] @ left.T)[:, :, None] + (y[:, 8:] @ right.T)[:, None, :]
    for k, found in enumerate(cap_filters.decode(x, 12, 0.5)):
        want = np.flatnonzero(total[k].ravel() >= 0.5)
        assert found.tolist() == (want.tolist() or [int(total[k].argmax())])


def test_near_vectors_finds_links_in_a_large_label(spark):
    """20,000 vectors of one label, half of them with a partner of cosine 0.93 to 0.99, against blocked brute force."""
    rng = np.random.default_rng(11)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    x = unit(rng.normal(size=(10_000, 64)))
    other = rng.normal(size=x.shape)
    other = unit(other - (other * x).sum(1, keepdims=True) * x)
    cosine = rng.uniform(0.931, 0.99, (10_000, 1))
    x = np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * other]).astype("f4")
    frame = spark.createDataFrame([(k, v, 1) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<float>, label int")
    got = np.array([r.n_links for r in cap_filters.near_vectors(frame).orderBy("vec_id").collect()])
    x = unit(x.astype("f8"))
    want = np.concatenate([(x[k : k + 2000] @ x.T >= 0.93).sum(1) - 1 for k in range(0, len(x), 2000)])
    assert want.sum() >= 20_000 and (got <= want).all()
    assert got.sum() >= 0.997 * want.sum()


def test_hits_grow_with_the_label():
    few, many = (cap_filters.hits_for(64, n, 0.93, 0.99, 8) for n in (1000, 200_000))
    assert few < many
    for n, hits in ((1000, few), (200_000, many)):
        assert cap_filters.found_share(64, cap_filters.number_of_words(n, hits, 8), hits, 0.93) >= 0.99
