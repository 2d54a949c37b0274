"""Operators 1, 4 and 10 against the tokenizer libraries on whole texts."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from headroom.llm import bpe_codec, packing, queries, token_files, words_bpe

from .conftest import ODD

RANKS, WORDS, BYTES = (public_tokenizers.path(x) for x in ("byte_bpe_multi_50k.tiktoken", "word_bpe_49k.json", "byte_bpe_50k.json"))


def library(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def by_ranks():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: e.encode_ordinary(text or "")


PIECES = st.lists(st.sampled_from(["word", "Word.", "ΣΑΣ", "İ", "don't", "it's'll", "12", "3a", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", " ", "　", "中文", "🙂", "é", "é", "...", ".,", "<|endoftext|>", "\0", "-"]), max_size=30)


@pytest.fixture(scope="module")
def encoders():
    with open(WORDS) as w, open(BYTES) as b, open(RANKS, "rb") as r:
        return words_bpe.FileEncoder(w.read(), True, 50), words_bpe.FileEncoder(b.read(), False, 50), words_bpe.RankEncoder(r.read(), public_tokenizers.PATTERN, 50)


@pytest.fixture(scope="module")
def libraries():
    return library(WORDS), library(BYTES)


@settings(max_examples=200, deadline=None)
@given(PIECES)
def test_units_encode_as_whole_texts(encoders, libraries, by_ranks, parts):
    text = "".join(parts)
    for encoder, whole in zip(encoders, (*libraries, by_ranks), strict=True):
        ids, at = encoder.encode(pa.array([text, "", text]))
        assert ids.tolist() == whole(text) * 2 and at.tolist() == [0, len(ids) // 2, len(ids) // 2, len(ids)]


def test_file_encoders_on_mixed_texts(encoders):
    rng = np.random.default_rng(1)
    bits = ["word", "Word.", "ΣΑΣ", "İx", "don't", "it's'll", "12", "3a", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", " ", "　", "中文", "🙂", "é", "é", "...", ".,", "<|endoftext|>", "\0", "-"]
    texts = ["".join(rng.choice(bits, 20)) for _ in range(400)] + ["", " ", "\n"]
    for encoder, path in ((encoders[0], WORDS), (encoders[1], BYTES)):
        whole = library(path)
        ids, at = encoder.encode(pa.array(texts))
        for k, t in enumerate(texts):
            assert ids[at[k] : at[k + 1]].tolist() == whole(t), t


def test_codec_with_small_chunks(spark, odd, by_ranks):
    """Chunks of 64 characters cut words, white space and the long run of one letter; the latter has no joint."""
    got = bpe_codec.decode(bpe_codec.encode(odd, RANKS, chunk=64, overlap=16), RANKS).collect()
    want = Counter((d, tuple(by_ranks(t))) for d, t in ODD)
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    assert all(bytes(r.decoded).decode() in {t or "" for _, t in ODD} for r in got)


def test_codec_query(spark, small, small_docs, by_ranks):
    rows = {r.doc_id: r for r in queries.op1_byte_bpe(spark, small).collect()}
    assert len(rows) == len(small_docs)
    for d, t in small_docs:
        ids = by_ranks(t)
        assert (rows[d].n_tokens, rows[d].ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert rows[d].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_codec_empty(none):
    assert bpe_codec.decode(bpe_codec.encode(none, RANKS), RANKS).count() == 0


def test_token_files(spark, odd, tmp_path):
    whole = library(WORDS)
    path = token_files.token_files(odd, WORDS, 1, path=str(tmp_path / "t"))
    rows = token_files.read_tokens(spark, path).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == Counter((d, (*whole(t), 1)) for d, t in ODD)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(rows, key=lambda r: r.start) if r.doc_id is not None]
    assert ids == sorted(ids)
    index = token_files.read_index(spark, path)
    assert {(r.doc_id, r.start) for r in index.collect()} == {(r.doc_id, r.start) for r in rows}
    assert "ids" not in index._jdf.queryExecution().executedPlan().toString()
    some = token_files.read_tokens(spark, path, 4, 6).collect()
    assert {(r.doc_id, r.start) for r in some} == {(r.doc_id, r.start) for r in rows if r.doc_id in (4, 5, 6)}


def test_token_files_are_coded_and_indexed(spark, odd, tmp_path):
    import glob

    import pyarrow.parquet as pq

    for dictionary, coding in ((True, "DICTIONARY"), (False, "DELTA_BINARY_PACKED")):
        path = str(tmp_path / coding)
        with open(WORDS) as f:
            token_files.write_tokens(token_files.encode_documents(odd, f.read(), True, 1), path, dictionary=dictionary)
        meta = [pq.ParquetFile(p).metadata for p in glob.glob(path + "/*.parquet")]
        chunks = [m.row_group(0).column(5) for m in meta if m.num_rows]
        assert all(any(coding in e for e in c.encodings) for c in chunks)
        assert all(c.has_offset_index for c in chunks)


def test_token_files_query(spark, small, small_docs):
    whole, at = library(WORDS), 0
    rows = {r.doc_id: r for r in queries.op4_token_files(spark, small).collect()}
    for d, t in small_docs:
        ids = [*whole(t), 1]
        assert tuple(rows[d])[:4] == (d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_token_files_empty(spark, none, tmp_path):
    path = token_files.token_files(none, WORDS, 1, path=str(tmp_path / "t"))
    assert token_files.read_tokens(spark, path).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60))
def test_best_fit_and_bound(lengths):
    lengths = np.sort(np.array(lengths))[::-1]
    where, offset = packing.best_fit_decreasing(lengths, 64)
    bins = int(where.max()) + 1
    for b in range(bins):
        own = sorted(zip(offset[where == b], lengths[where == b], strict=True))
        assert own[0][0] == 0 and all(x[0] + x[1] == y[0] for x, y in zip(own, own[1:], strict=False)) and sum(own[-1]) <= 64
    assert packing.lower_bound(lengths, 64) <= bins


def test_bounds_see_what_volume_does_not():
    assert packing.lower_bound(np.full(10, 600), 1024) == 10
    assert packing.lower_bound(np.full(9, 342), 1024) == 5  # two of them fit a bin: ceil(9 / 2)


def test_packing(spark, odd):
    whole = library(BYTES)
    pieces = packing.packed_documents(odd, BYTES, 2, capacity=256, part_pieces=16)
    rows = pieces.collect()
    want = Counter()
    for d, t in ODD:
        ids = [*whole(t), 2]
        head = len(ids) % 256 or 256
        cuts = [0, *range(min(head, len(ids)), len(ids), 256), len(ids)] if len(ids) > 256 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert own[0][0] == 0 and all(sum(x) == y[0] for x, y in zip(own, own[1:], strict=False)) and sum(own[-1]) <= 256
    bound = packing.lower_bound(np.array([r.length for r in rows]), 256)
    assert bound <= len(by) <= bound + 2
    assert packing.certificate(pieces, 256) == (len(by), bound)


def test_packed_sequences_have_their_ids(spark, odd):
    with open(BYTES) as f:
        pieces = packing.token_pieces(odd.where("doc_id < 9"), f.read(), 2, 256, keep_ids=True).cache()
    placed = pieces.join(packing.pack(pieces, 256), "uid")
    for r in packing.sequences(placed).collect():
        own = sorted((x.offset, list(x.ids)) for x in placed.where(F.col("sequence_id") == r.sequence_id).collect())
        assert list(r.ids) == [i for _, ids in own for i in ids] and r.length == len(r.ids)


def test_packing_empty(none):
    assert packing.packed_documents(none, BYTES).count() == 0
