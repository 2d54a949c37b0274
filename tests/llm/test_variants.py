"""Operators 11, 12 and 13 against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headroom.llm import license_rules, license_scan, queries, spelling_variants, vector_codes

from . import brute
from .conftest import ODD


def spelled(rows):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows)


def typos(seed=2, stems=60):
    """Words of few letters with many near words, some very frequent, some with marks of their own, one very long."""
    rng = random.Random(seed)
    out = ["Naïveté×÷ÿÀÀÀ ÉLÉPHANTESQUE élÉphantesque", "x" * 5000 + " " + "x" * 4999, "short words only", None, ""]
    for _ in range(stems):
        stem = "".join(rng.choice("abe") for _ in range(rng.randint(7, 11)))
        for _ in range(rng.randint(1, 10)):
            w = list(stem)
            for _ in range(rng.randint(0, 2)):
                k, how = rng.randrange(len(w)), rng.random()
                w[k : k + 1] = [] if how < 0.3 else [rng.choice("abe")] if how < 0.6 else [w[k], rng.choice("abe")]
            out.append(" ".join(["".join(w)] * rng.choice((1, 2, 3, 40))))
    out += ["abbabbaa " * 2, "abbabbab " * 30, "abbabbbb " * 400, "abbbbbbb " * 5000]  # a chain of forms
    return list(enumerate(out)) + [(0, out[0]), (None, out[0]), (1, out[1])]


def test_variants(spark):
    docs = typos()
    rows = spelling_variants.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    want = brute.spelling(docs)
    assert spelled(rows) == sorted(want) and any(w[1] != w[2] and w[1] for w in want) and max(w[4] for w in want) > 5


@pytest.mark.parametrize("least, most, frequent, limit", [(3, 5, 0, 2), (3, 6, 5, 10), (2, 4, 10_000, 3), (3, 3, 0, 1)])
def test_near_words(spark, least, most, frequent, limit):
    """The same pairs however the grams grow and the lists are cut."""
    words = sorted({w for _, t in typos(5, 25) if t for w in t.split() if 7 <= len(w) < 100})
    table = spark.createDataFrame(list(enumerate(words)), "id long, word string")
    got = {(r.a, r.b) for r in spelling_variants.near_words(table, least, most, frequent, limit).collect()}
    holes = {}
    for k, w in enumerate(words):
        for j in range(len(w) + 1):
            for x in {w[:j] + c + w[j:] for c in "abe"} | {w[:j] + c + w[j + 1 :] for c in "abe"} | {w[:j] + w[j + 1 :]}:
                holes.setdefault(x, set()).add(k)
    want = {(min(k, o), max(k, o)) for k, w in enumerate(words) for o in holes.get(w, ()) if o != k}
    assert got == want and len(want) > 50


@settings(max_examples=200, deadline=None)
@given(st.text("ab", min_size=7, max_size=14), st.integers(0, 13), st.sampled_from(["", "a", "b", "c"]), st.booleans(), st.sets(st.text("ab^$", min_size=3, max_size=5), max_size=30))
def test_near_words_share_a_list(word, place, letter, insert, often):
    place %= len(word)
    other = word[:place] + letter + word[place + (not insert) :]
    often = {g: len(g) for g in often}
    one, two = ({("<", f"^{w}$"[: p + len(g)]) for g, p in spelling_variants.signature(w, often)} | {(">", f"^{w}$"[p:]) for g, p in spelling_variants.signature(w, often)} for w in (word, other))
    assert len(other) < 7 or one & two


def test_variants_odd(spark, odd, none):
    assert spelled(spelling_variants.spelling_variants(odd).collect()) == sorted(brute.spelling(ODD))
    assert spelling_variants.spelling_variants(none).count() == 0


def test_variants_query(spark, small, small_docs):
    assert spelled(queries.op11_spelling_variants(spark, small).collect()) == sorted(brute.spelling(small_docs))


NOTES = [
    "Licensed under the Apache License, Version 2.0 (the \"License\"); see the LICENSE file.", "Released under the MIT License. Mit der Lizenz!", "SPDX-License-Identifier: GPL-2.0-only",
    "This work is licensed under the GNU Lesser General Public License, version 2.1, or the GNU General Public License v3.", "CC BY-NC 4.0; cc-by! CC-BY\nCC0 1.0 and Creative Commons Attribution-ShareAlike 3.0",
    "Copyright (c) 2020 someone. All Rights\tReserved. all rights reserved, ALL RIGHTS RESERVED", "general public licenses are not a general public license. Acc by", "no cue here", " \x00é ü×中文🙂 cc by ",
    "redistribution and use in source and binary forms WITHOUT WARRANTY OF ANY KIND " * 400, "the bsd license " * 700 + "all rights reserved",
]


def test_license_base(spark, odd, none):
    rows = license_scan.scan(odd).collect()
    got = Counter((r.doc_id, r.n_words, tuple((p.start, p.label) for p in r.base)) for r in rows)
    assert got == Counter((d, n, tuple(found)) for d, t in ODD for n, found in [brute.license_base(t)])
    assert all(r.row == "r" and r["drop"] == "d" and 0 <= r.score <= 1 for r in rows) and "base" in rows[0]
    assert license_scan.scan(none).count() == 0


def test_license_rules(spark):
    """Gates and suppression change nothing: the same as every rule on every text, contained ones removed."""
    rules = license_rules.rules()
    assert len(rules) > 400 and [r.tier for r in rules] == sorted(r.tier for r in rules)
    assert all(any(c.strip() in r.pattern for c in license_rules.CUES) for r in rules)
    rows = license_scan.scan(spark.createDataFrame(list(enumerate(NOTES)), "doc_id long, text string")).collect()
    for r in rows:
        assert [tuple(d) for d in r.detections] == brute.detections(NOTES[r.doc_id], rules), NOTES[r.doc_id][:80]
        assert [(p.start, p.label) for p in r.base] == brute.license_base(NOTES[r.doc_id])[1]
    labels = {r.doc_id: {d.label for d in r.detections} for r in rows}
    assert labels[0] >= {"apache-2.0"} and "apache" not in labels[0] and labels[1] == {"mit"} and labels[2] == {"gpl-2.0"}
    assert labels[3] == {"lgpl-2.1", "gpl-3.0"} and {"cc-by-nc-4.0", "cc0-1.0", "cc-by-sa-3.0"} <= labels[4] and not labels[7]


def test_license_query(spark, small, small_docs):
    rows = queries.op12_license_scan(spark, small).collect()
    for r, (d, t) in zip(sorted(rows, key=lambda r: r.doc_id), small_docs, strict=True):
        n, found = brute.license_base(t)
        starts = [k for k, _ in found]
        assert (r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word) == (d, n, len(found), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in found})) and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-40, 40), st.integers(-3, 3)), min_size=1, max_size=120), st.integers(1, 20), st.integers(0, 5))
def test_cover_tree(points, entries, seed):
    """Every point gets its nearest entry, ties to the lower one, and the sums are those of the points."""
    x, count = np.unique(np.array(points, np.int64), axis=0, return_counts=True)
    book = np.random.default_rng(seed).integers(-20, 20, (entries, 2))
    tree, order = vector_codes.CoverTree.build(x, count)
    assert sorted(order) == list(range(len(x))) and (tree.points == x[order]).all()
    got, total = np.full(len(x), -1), np.zeros((entries, 3), np.int64)
    for first, last, entry in tree.assign(book):
        for a, b, e in zip(first, last, entry, strict=True):
            assert (got[a:b] == -1).all()
            got[a:b] = e
            total[e] += tree.cum[b] - tree.cum[a]
    want = ((tree.points[:, None] - book[None]) ** 2).sum(2).argmin(1)
    assert (got == want).all()
    for e in range(entries):
        assert total[e].tolist() == [*(x[order] * count[order, None])[want == e].sum(0), count[order][want == e].sum()]
    for k in range(len(tree.first)):  # covering
        own = tree.points[tree.first[k] : tree.last[k]]
        assert np.sqrt(((own - own[0]) ** 2).sum(1)).max() <= tree.radius[k] + 1e-9


def vectors(seed=1, n=700, dim=48):
    rng = np.random.default_rng(seed)
    rows = [(int(k), (rng.normal(size=dim) * 0.2).astype("f4").tolist(), int(k % 3) if k % 11 else None) for k in rng.permutation(n)]
    return rows + [(n + k, rows[5][1], 1) for k in range(300)] + [(n, rows[7][1], 0), (n + 1, [0.0] * dim, 2)]


def test_vector_codes(spark):
    rows = vectors()
    bad = [(5000, None, 1), (5001, [float("nan")] * 48, 1), (5002, [None] * 48, 1), (5003, [float("-inf")] * 48, None)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows + bad], "vec_id long, embedding array<float>, label int, code string, part int").repartition(4)
    coded, books = vector_codes.compress(frame)
    want, own = brute.vector_codes(rows)
    assert (books == np.array(own)).all()
    got = coded.collect()
    assert Counter((r.id, bytes(r.code), r.error, r.label) for r in got) == Counter(want)
    total = Counter()
    for _, _, error, label in want:
        total[label] += error
    assert all(r.label_error == total[r.label] for r in got)


def test_vector_codes_odd(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert vector_codes.compress(spark.createDataFrame([], schema))[0].count() == 0
    assert vector_codes.compress(spark.createDataFrame([(1, None, 1), (2, [float("nan")], 1)], schema))[0].count() == 0
    # shorter vectors are filled up, rows without id come last, huge components are held, equal rows stay
    rows = [(None, [9.0] * 17, None), (3, [1.0], 1), (3, [1.0], 1), (2, [], 1), (1, [3e38, -3e38, 0.25], 2)]
    coded, books = vector_codes.compress(spark.createDataFrame(rows, schema))
    got = Counter((r.id, r.error) for r in coded.collect())
    assert books.shape == (16, 5, 2) and got == Counter({(None, 0): 1, (3, 0): 2, (2, 0): 1, (1, 0): 1})
    assert books[0, 0].tolist() == [vector_codes.LIMIT, -vector_codes.LIMIT] and books[1, 0].tolist() == [64, 0]


def test_vector_codes_query(spark, small):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    want, books = brute.vector_codes(rows)
    got = queries.op13_vector_codes(spark, small).collect()
    assert {(r.vec_id, r.code, r.error) for r in got} == {(v, c.hex(), e) for v, c, e, _ in want}
    assert {r.codebooks_sha256 for r in got} == {vector_codes.codebooks_sha256(np.array(books))}
