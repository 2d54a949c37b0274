"""Encoding texts unit by unit: a unit is a word with the white space before it, and most units repeat.

In the split patterns used here a token never reaches from a non-space character into white space, so a
text may be cut before each run of white space and the units encoded one by one. Each worker keeps the
ids of pieces in a bounded cache that is shared by the tasks it runs.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import worker_state

# fixed values: the characters that the tokenizers' \s matches, and the two split patterns
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""

_UNIT = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
CACHE_PIECES = 400_000


def units(text: str) -> list[str]:
    """The text cut before every run of white space that follows another character."""
    return _UNIT.findall(text)


class Encoder:
    """Ids of texts: cut into units, units into pre-token pieces, pieces encoded once and kept, up to ``limit``.

    Units and pieces are handled by their distinct values in Arrow; Python sees the distinct pieces, and the
    units that are not a plain word with at most one mark at its end.
    """

    lead = " "  # may stand before the letters of a plain word

    def __init__(self, pattern: str, limit: int = CACHE_PIECES):
        import regex

        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.limit = limit

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each piece."""
        raise NotImplementedError

    def prepared(self, distinct: pa.Array) -> pa.Array:
        """What is done to units before they are split."""
        return distinct

    def cut(self, texts: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
        """The units of each text; the second array marks texts that ``slow_cut`` must cut instead."""
        slow = pc.match_substring_regex(texts, f"[{SPACES}][{SPACES}]|\\x00").to_numpy(zero_copy_only=False)
        marked = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n")
        return pc.split_pattern(marked, "\0"), slow

    slow_cut = staticmethod(units)

    def _split(self, distinct: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """All pieces of the distinct units, unit by unit, dictionary-coded, and how many each unit has."""
        word = pc.utf8_rtrim(distinct, characters=".,")
        marks = (pc.binary_length(distinct).to_numpy() - pc.binary_length(word).to_numpy()).astype(np.int64)
        letters = pc.utf8_ltrim(word, characters=self.lead) if self.lead else word
        lead = pc.binary_length(word).to_numpy() - pc.binary_length(letters).to_numpy()
        plain = (marks <= 1) & (lead <= 1) & pc.utf8_is_alpha(letters).to_numpy(zero_copy_only=False).astype(bool)
        odd = [self.pattern.findall(u) for u in distinct.filter(pa.array(~plain)).to_pylist()]
        count = np.where(plain, 1 + marks, 0)
        count[~plain] = [len(x) for x in odd]
        at = np.concatenate([[0], np.cumsum(count)])
        marked = plain & (marks == 1)
        source = np.empty(at[-1], np.int64)  # of each piece, its place in: words, marks, pieces of odd units
        source[at[:-1][plain]] = np.flatnonzero(plain)
        source[at[:-1][marked] + 1] = len(distinct) + np.flatnonzero(marked)
        other = np.repeat(~plain, count)
        source[other] = 2 * len(distinct) + np.arange(int(other.sum()))
        pool = pa.chunked_array([word, pc.utf8_slice_codeunits(distinct, -1, None), pa.array([p for x in odd for p in x], pa.string())]).combine_chunks()
        return pool.take(pa.array(source)).dictionary_encode(), count

    def lookup(self, pieces: list[str]) -> list[bytes]:
        out = list(map(self.known.get, pieces))
        new = [p for p, ids in zip(pieces, out, strict=True) if ids is None]
        if new:
            got = self.encode_pieces(new)
            fill = iter(got)
            out = [next(fill) if ids is None else ids for ids in out]
            if len(self.known) + len(new) > self.limit:  # the first half came first and so is the more frequent one
                for k in list(self.known)[self.limit // 2 :]:
                    del self.known[k]
            if len(self.known) + len(new) <= self.limit:
                self.known.update(zip(new, got, strict=True))
        return out

    def _encode_lists(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        coded = lists.flatten().dictionary_encode()
        pieces, count = self._split(self.prepared(coded.dictionary))
        offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
        ids_of = id_lists(self.lookup(pieces.dictionary.to_pylist()))
        of_unit = ids_of.take(pieces.indices)  # then piece by piece the ids of each distinct unit
        ends = np.concatenate([[0], np.cumsum(of_unit.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)])
        of_unit = pa.ListArray.from_arrays(pa.array(ends[offsets].astype(np.int32)), of_unit.flatten())
        ids = of_unit.take(coded.indices)
        ends = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)])
        at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)])
        return ids.flatten().to_numpy(zero_copy_only=False), ends[at]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, none of which is null, one text after the other, and where each text begins."""
        lists, slow = self.cut(texts)
        if not slow.any():
            return self._encode_lists(lists)
        mask = pa.array(slow)
        out: list = [None] * len(texts)
        for rows, part in ((np.flatnonzero(~slow), lists.filter(pc.invert(mask))),
                           (np.flatnonzero(slow), pa.array([self.slow_cut(t) for t in texts.filter(mask).to_pylist()], pa.list_(pa.string())))):
            ids, at = self._encode_lists(part)
            for k, row in enumerate(rows.tolist()):
                out[row] = ids[at[k] : at[k + 1]]
        return np.concatenate(out), np.concatenate([[0], np.cumsum([len(x) for x in out])])


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + k) for k, b in enumerate(moved)}


class FileEncoder(Encoder):
    """By a tokenizer file of the ``tokenizers`` library: its own model encodes the pre-split pieces.

    ``words=False``: byte-level file, white space belongs to the pieces. ``words=True``: a file that
    normalises (NFC, lower case) and drops white space.
    """

    def __init__(self, content: str, words: bool, limit: int = CACHE_PIECES):
        super().__init__(WORD_PATTERN if words else BYTE_PATTERN, limit)
        from tokenizers import Tokenizer

        self.words, self.letters = words, _byte_letters()
        self.lead = "" if words else " "
        self.bare = Tokenizer(Tokenizer.from_str(content).model)

    def cut(self, texts):
        return (pc.ascii_split_whitespace(texts), np.zeros(len(texts), bool)) if self.words else super().cut(texts)

    def prepared(self, distinct):
        if not self.words or not len(distinct):
            return distinct
        # each letter is lowered by itself: no final sigma
        return pa.array(unicodedata.normalize("NFC", " ".join(distinct.to_pylist())).replace("Σ", "σ").lower().split(" "), pa.string())

    def encode_pieces(self, pieces):
        out: list[bytes] = []
        for k in range(0, len(pieces), 50_000):
            part = [p.encode().decode("latin1").translate(self.letters) for p in pieces[k : k + 50_000]]
            got = self.bare.encode(part, is_pretokenized=True, add_special_tokens=False)
            raw, at = np.array(got.ids, dtype="<i4").tobytes(), 0
            for end in np.cumsum(np.bincount(np.array(got.word_ids, dtype=np.int64), minlength=len(part)) * 4).tolist():
                out.append(raw[at:end])
                at = end
        return out


class RankEncoder(Encoder):
    """By a rank file of byte-level BPE."""

    def __init__(self, content: bytes, pattern: str, limit: int = CACHE_PIECES):
        super().__init__(pattern, limit)
        import base64

        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode_pieces(self, pieces):
        one = self.bpe.encode_ordinary
        return [np.array(one(p), dtype="<i4").tobytes() for p in pieces]


def file_encoder(content: str, words: bool) -> FileEncoder:
    kind = f"encoder_{words}_{hash(content)}"
    return worker_state(kind, lambda: FileEncoder(content, words), alone=True)


def id_lists(encoded: list[bytes]) -> pa.ListArray:
    """Little-endian ids as an Arrow list column, without a Python number in between."""
    offsets = np.zeros(len(encoded) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in encoded], out=offsets[1:])
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(encoded))])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def with_end(ids: np.ndarray, at: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """``end_id`` after each text's ids."""
    return np.insert(ids, at[1:], end_id).astype("<i4", copy=False), at + np.arange(len(at))


def id_column(ids: np.ndarray, at: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids, pa.int32()))
