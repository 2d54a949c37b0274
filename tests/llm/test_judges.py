"""Operators 5, 6 and 7, and the pipeline."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from headroom.llm import fingerprints, packing, queries, secret_scan, toxicity

from . import brute
from .conftest import ODD


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab", min_size=1, max_size=80), st.data())
def test_spans_and_extensions(text, data):
    h = fingerprints.PrefixHashes(np.array([ord(c) for c in text]))
    a, c = (data.draw(st.integers(0, len(text))) for _ in range(2))
    want = 0
    while max(a, c) + want < len(text) and text[a + want] == text[c + want]:
        want += 1
    assert h.common_extension(a, c) == want
    assert h.equal(a, a + want, c, c + want)


def test_likeness():
    text = "".join(chr(97 + k * 7 % 23) for k in range(1000))
    marks = fingerprints.text_marks([text, text[:700] + text[:300], "z" * 1000, "", text])
    assert marks[0] == marks[4] and fingerprints.compare(marks[0], marks[4]) == 1
    assert 0.55 < fingerprints.compare(marks[0], marks[1]) < 0.8
    assert fingerprints.compare(marks[0], marks[2]) == fingerprints.compare(marks[0], marks[3]) == 0
    assert fingerprints.compare(marks[3], marks[3]) == 1


def test_fingerprints_odd(odd):
    rows = fingerprints.fingerprints(odd).collect()
    named = [(d, t) for d, t in ODD if d is not None]
    ordered = sorted((d, t or "") for d, t in named)
    want = Counter()
    for k, (d, t) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        q = len(t) // 4
        want[d, len(t), hashlib.sha256((t[: len(t) - q] + following[:q]).encode()).hexdigest()] += 1
    for d, t in ODD:
        if d is None:
            t = t or ""
            want[d, len(t), hashlib.sha256(t[: len(t) - len(t) // 4].encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    by = {r.doc_id: r.fingerprint for r in rows}
    assert by[1] == by[5] != by[6] and by[2] == by[3] and by[9] == by[10]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert {d: fingerprints.text_marks([t or ""])[0] for d, t in named} == {d: by[d] for d, _ in named}


def test_fingerprints_query(spark, small, small_docs):
    rows = {r.doc_id: r for r in queries.op5_document_fingerprints(spark, small).collect()}
    edited = brute.edited(small_docs)
    ids = sorted(rows)
    marks = dict(zip(ids, fingerprints.text_marks([t or "" for _, t in small_docs]), strict=True))
    for k, d in enumerate(ids):
        r = rows[d]
        assert r.edited_sha256 == hashlib.sha256(edited[d].encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (marks[d], fingerprints.text_marks([edited[d]])[0])
        assert r.near_edited == pytest.approx(fingerprints.compare(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(fingerprints.compare(r.fingerprint, marks[ids[(k + 1) % len(ids)]]))
    assert np.mean([r.near_edited for r in rows.values()]) > 0.6 > 0.1 > np.mean([r.near_next for r in rows.values()])


def test_fingerprints_empty(none, spark):
    assert fingerprints.fingerprints(none).count() == 0
    only = fingerprints.fingerprints(spark.createDataFrame([(3, "abcdefgh")], "doc_id long, text string")).collect()
    assert only[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and only[0].near_next == 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="aB c.é\n", max_size=30), max_size=5))
def test_terms(texts):
    row, term = toxicity.terms(pa.array(texts, pa.string()), 30)
    for k, t in enumerate(texts):
        own = {w.encode() for w in re.findall("[a-zé]+", t.replace("B", "b"))}
        want = {(0, w) for w in own} | {(n, w[:n]) for w in own for n in toxicity.PREFIXES if len(w) > n}
        assert len(term[row == k]) == len(want)


def test_machine_learns_interactions():
    """Label 1 only where both terms are: no weights without pairs can tell."""
    rng = np.random.default_rng(0)
    pairs, labels = [], []
    for _ in range(800):
        a, b = (int(x) for x in rng.random(2) < 0.5)
        pairs.append(np.array([1] * a + [2] * b + [3 + int(rng.integers(40))], np.int64))
        labels.append(float(a and b))
    machine = toxicity.FactorizationMachine.fit(pairs, np.array(labels), 8, 4, 30)
    machine = toxicity.FactorizationMachine.from_bytes(machine.to_bytes())
    row, term = np.repeat(np.arange(800), [len(p) for p in pairs]), np.concatenate(pairs)
    assert ((machine.scores(row, term, 800) > 0.5) == np.array(labels)).mean() > 0.99


def toxic_docs(n=900):
    rng = np.random.default_rng(3)
    words = [f"{a}{b}" for a in "bcdfghk" for b in ("al", "ore", "umi", "ine", "ath")]
    rows, labels = [], []
    for k in range(n):
        bad = rng.random() < 0.2
        text = list(rng.choice(words, int(rng.integers(5, 120))))
        if bad:
            text[:0] = rng.choice(["vile", "filthy", "cretin"], 2)
            rng.shuffle(text)
        rows.append((k, " ".join(text)))
        labels.append((k, int(bad)))
    return rows, labels


def test_toxicity_held_out(spark):
    rows, labels = toxic_docs()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 3 == 1]
    assert np.mean([(got[k] >= 0.7) == labels[k][1] for k in held]) > 0.98


def test_toxicity_does_not_see_held_out_labels(spark):
    rows, labels = toxic_docs(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    turned = [(k, 1 - y if zlib.crc32(str(k).encode()) % 3 == 1 else y) for k, y in labels]
    one, two = (toxicity.fit(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned))
    assert one == two


def test_toxicity_odd(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (3, None), (4, 0), (5, 1)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    rows = toxicity.score(odd, model).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(ODD) and all(0 <= r.score <= 1 and r.row == "r" for r in rows)
    assert toxicity.score(none, model).count() == 0
    for docs, known in ((none, labels), (odd, labels.limit(0))):
        assert {r.score for r in toxicity.score(odd, toxicity.fit(docs, known), keep=("doc_id",)).collect()} == {0.5}


def test_toxicity_query(spark, small, small_docs):
    rows = queries.op6_toxicity(spark, small).collect()
    assert len(rows) == len(small_docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for r in rows)


def base(text):
    spans = [(m.start(), 0, "assign", m.end()) for m in secret_scan.ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    return [(a, kind, b) for a, _, kind, b in sorted(spans)]


SECRETS = st.lists(st.sampled_from(["password", "API_KEY", "apikey", "Token", "secret", "ſecret", "toKen", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH12345678", "deadbeef", "0123456789", "abc-def_ghi", "é", "\n", "x"]), max_size=20)


@settings(max_examples=300, deadline=None)
@given(SECRETS)
def test_base_spans(parts):
    text = "".join(parts)
    runs = bool(secret_scan._has_run(pa.array([text]))[0])
    assert secret_scan.find_spans(text, runs=runs) == base(text)


def tokens(n, seed):
    rng = np.random.default_rng(seed)
    letters, digits = list("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), list("0123456789")
    return ["tk_" + "".join("".join(rng.choice(letters, 3)) + "".join(rng.choice(digits, 3)) for _ in range(4)) for _ in range(n)]


def test_automata_learn_a_format():
    automata = secret_scan.learn({"assign": tokens(200, 1)})
    assert len(automata[0].states) < 60
    assert np.mean([secret_scan.is_secret(x, automata) for x in tokens(200, 2)]) > 0.85
    assert not any(secret_scan.is_secret(x, automata) for x in ("an-ordinary-long-word", "2024-11-30T10-20-30", "version_1_2_3_release", "0123456789012345", "TK_ABC123ABC123ABC123"))


def test_scan_adds_learned_spans(spark):
    docs = [(k, f"token = {x} and words") for k, x in enumerate(tokens(120, 1))] + [(500 + k, f"look at é {x} here") for k, x in enumerate(tokens(30, 2))] + [(900, "no-secret-is-here-at-all 1234")]
    rows = {r.doc_id: r.spans for r in secret_scan.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all([(s["kind"], s["start"]) for s in rows[k]] == [("assign", 0)] for k in range(120))
    found = [k for k in range(500, 530) if [(s["kind"], s["start"], s["end"]) for s in rows[k]] == [("learned", 10, 37)]]
    assert len(found) >= 25 and rows[900] == []


def formats(seed, n=60):
    """Keys of 12 characters, dotted ones, of one class, longer than 256, and with a run of hex digits inside."""
    rng = np.random.default_rng(seed)
    some = lambda chars, k: "".join(rng.choice(list(chars), k))
    upper, digits, hexes = "GHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
    make = {
        "short": lambda: "k" + some(digits, 1) + "-" + some(upper, 4) + "-" + some(digits, 4),
        "dotted": lambda: "eyJ" + some(upper, 9) + "." + some(upper, 12) + "." + some(upper, 9),
        "letters": lambda: some(upper, 20),
        "long": lambda: "blob/" + some(digits, 300),
        "hex": lambda: "sk_live_" + some(hexes, 16) + "QWERTY",
    }
    return {name: [f() for _ in range(n)] for name, f in make.items()}


@pytest.mark.parametrize("kind", ["short", "dotted", "letters", "long", "hex"])
def test_learned_formats_without_keyword(spark, kind):
    known, new = formats(1)[kind], formats(2, 20)[kind]
    rows = [(k, f"token = {x} and") for k, x in enumerate(known)] + [(500 + k, f"see é {x}, or {x}.") for k, x in enumerate(new)]
    docs = spark.createDataFrame([*rows, (900, "An unremarkably longwinded sentence-with-hyphens. Ends.")], "doc_id long, text string")
    masked = {r.doc_id: r.text for r in secret_scan.mask(docs).collect()}
    clean = [k for k in range(20) if re.fullmatch(r"see é <\w+>, or <\w+>\.", masked[500 + k])]
    assert len(clean) >= 16 and masked[900] == "An unremarkably longwinded sentence-with-hyphens. Ends."


def test_scan_odd(odd, none):
    rows = secret_scan.scan(odd).collect()
    assert Counter((r.doc_id, r.text, tuple((s["start"], s["kind"], s["end"]) for s in r.spans)) for r in rows) == Counter((d, t, tuple(base(t or ""))) for d, t in ODD)
    masked = {r.doc_id: r.text for r in secret_scan.mask(odd).collect()}
    assert masked[15] == "<assign>" + '" <access> <hex>' and masked[1] == dict(ODD)[1]
    clash = secret_scan.mask(odd.select("doc_id", "text", F.lit(7).alias("spans")))
    assert clash.columns == ["doc_id", "text", "spans"] and {r.spans for r in clash.collect()} == {7}
    assert str(clash._jdf.queryExecution().executedPlan().toString()).count("MapInArrow") == 1  # one worker a task
    assert secret_scan.scan(none).count() == 0


def test_scan_query(spark, small, small_docs):
    rows = {r.doc_id: r for r in queries.op7_secret_scan(spark, small).collect()}
    for d, t in small_docs:
        want = base(t or "")
        assert rows[d].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, k, b in want).encode()).hexdigest()
        assert (rows[d].n_assign, rows[d].n_access, rows[d].n_hex) == tuple(sum(k == x for _, k, _ in want) for x in ("assign", "access", "hex"))


def test_pipeline_stages(spark, small, tmp_path):
    """Each stage against a plain version on what the one before it kept."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        path = str(tmp_path / str(k))
        stage(spark, docs, small).write.parquet(path)
        docs = spark.read.parquet(path)
        if k < 4:
            assert docs.columns == names
            after = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        if k == 0:
            labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
            assert all(after[d] == before[d] for d in after)
            assert sum(labels.get(d) == 0 for d in before.keys() - after.keys()) <= 2
        elif k == 1:
            want = brute.line_dedup(list(before.items()))
            assert {d: hashlib.sha256(t.encode()).hexdigest() for d, t in after.items()} == {d: v[2] for d, v in want.items()}
        elif k == 2:
            assert after == {d: before[d] for d, (_, c) in brute.jaccard(list(before.items())).items() if d == c}
        elif k == 3:
            assert after.keys() == before.keys() and all((after[d] == t) == (not base(t)) for d, t in before.items())
    rows = docs.collect()
    assert {r.doc_id for r in rows} == set(before)
    bound = packing.lower_bound(np.array([r.length for r in rows]), 1024)
    assert bound <= len({r.sequence_id for r in rows}) <= bound + 1
