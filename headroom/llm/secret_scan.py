"""Secrets in texts: fixed patterns, and formats learned from what they label as probabilistic automata."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import stored
from .common import bound_batches, column_bytes, text_slices

# fixed values: the base patterns, the least lengths, and the order of the kinds
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "learned")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")  # the alphabet and the least length of the values that ``assign`` labels
SAMPLE = 500
SYMBOLS = 1 << 17  # of the values of a kind that are learned from, in all: the states of their prefix tree
ALPHA = 0.05
_RUN = np.zeros(256, bool)
_RUN[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"]] = True
_CLASS = {c: "0" for c in "0123456789"} | {c: "a" for c in "abcdef"} | {c: "z" for c in "ghijklmnopqrstuvwxyz"} | {c: "A" for c in "ABCDEF"} | {c: "Z" for c in "GHIJKLMNOPQRSTUVWXYZ"}


def shape(value: str) -> str:
    """One symbol a character: digits, a-f, g-z, A-F, G-Z, and marks as they are."""
    return "".join(_CLASS.get(c, c) for c in value)


# Learning ----------------------------------------------------------------------------------------


@dataclass(slots=True)
class State:
    ends: int = 0
    seen: int = 0
    counts: dict[str, int] = field(default_factory=dict)
    to: dict[str, int] = field(default_factory=dict)


def _differ(a: int, n: int, b: int, m: int, alpha: float) -> bool:
    """Hoeffding's bound: are the frequencies a / n and b / m too far apart to be one?"""
    return n > 0 and m > 0 and abs(a / n - b / m) > math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))


class Automaton:
    """A probabilistic automaton inferred from samples: compatible states of their prefix tree are merged.

    States that are kept are tried in order of discovery; a new one is merged with the first of them whose
    ends and continuations, followed down the tree, do not differ significantly, else it is kept.
    """

    def __init__(self, samples: Iterable[str], alpha: float = ALPHA):
        self.states = [State()]
        for s in samples:
            at = 0
            for c in s:
                here = self.states[at]
                here.seen += 1
                here.counts[c] = here.counts.get(c, 0) + 1
                if c not in here.to:
                    here.to[c] = len(self.states)
                    self.states.append(State())
                at = here.to[c]
            self.states[at].seen += 1
            self.states[at].ends += 1
        self.bad: set[tuple[int, int]] = set()
        self._merge_all(alpha)
        self.bad.clear()
        self.floor = -math.inf

    def _compatible(self, a: int, b: int, alpha: float) -> bool:
        """``bad`` keeps pairs known to differ until states change: formats of one length compare the same pairs again and again."""
        todo = [(a, b, None)]
        while todo:
            node = todo.pop()
            x, y = self.states[node[0]], self.states[node[1]]
            if y.seen * 2 <= math.log(2 / alpha):  # so few samples never differ from anything, nor do parts of them
                continue
            if node[:2] in self.bad or _differ(x.ends, x.seen, y.ends, y.seen, alpha) or any(
                    _differ(x.counts.get(c, 0), x.seen, y.counts.get(c, 0), y.seen, alpha) for c in {*x.counts, *y.counts}):
                if len(self.bad) > 1 << 20:
                    self.bad.clear()
                while node is not None:
                    self.bad.add(node[:2])
                    node = node[2]
                return False
            todo += [(x.to[c], y.to[c], node) for c in x.to if c in y.to]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the subtree ``b`` to the state ``a`` and what follows it."""
        self.bad.clear()
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            x, y = self.states[a], self.states[b]
            x.ends += y.ends
            x.seen += y.seen
            for c, n in y.counts.items():
                x.counts[c] = x.counts.get(c, 0) + n
            for c, child in y.to.items():
                if c in x.to:
                    todo.append((x.to[c], child))
                else:
                    x.to[c] = child

    def _merge_all(self, alpha: float) -> None:
        kept = [0]
        while True:
            inside = set(kept)
            new = next(((k, c, t) for k in kept for c, t in sorted(self.states[k].to.items()) if t not in inside), None)
            if new is None:
                break
            parent, c, blue = new
            for red in kept:
                if self._compatible(red, blue, alpha):
                    self.states[parent].to[c] = red
                    self._fold(red, blue)
                    break
            else:
                kept.append(blue)
        number = {k: i for i, k in enumerate(kept)}
        self.states = [self.states[k] for k in kept]
        for s in self.states:
            s.to = {c: number[t] for c, t in s.to.items()}

    def likelihood(self, value: str) -> float:
        """Mean log probability of a symbol; what was never seen is very unlikely but not impossible."""
        at, total = 0, 0.0
        for c in value:
            s = self.states[at]
            if c not in s.to:
                return -math.inf
            total += math.log(s.counts[c] / s.seen)
            at = s.to[c]
        s = self.states[at]
        return (total + math.log(max(s.ends, 0.01) / s.seen)) / (len(value) + 1)


def learn(credentials: dict[str, list[str]], alpha: float = ALPHA, share: float = 0.05) -> list[Automaton]:
    """One automaton for each kind with credentials; its floor lets all but a ``share`` of its own samples pass."""
    out = []
    for kind in sorted(credentials):
        shapes = sorted(shape(x) for x in credentials[kind])
        if shapes:
            a = Automaton(shapes, alpha)
            own = sorted(map(a.likelihood, shapes))
            a.floor = own[int(share * len(own))]
            out.append(a)
    return out


def is_secret(value: str, automata: list[Automaton]) -> bool:
    """Whether a token looks like the formats learned: as likely as their own samples, whatever its characters."""
    s = shape(value)
    return any(a.likelihood(s) >= a.floor for a in automata)


# Scanning ----------------------------------------------------------------------------------------


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and not overlapping within a kind, too short ones dropped."""
    found = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "api")):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    return found


def in_order(spans: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[1])))


def _tokens(run: str) -> Iterator[list[tuple[int, int]]]:
    """Ways to read a run of token characters, to be tried in turn: whole, without the points around it, in parts between points."""
    yield [(0, len(run))]
    if "." in run:
        inner = run.strip(".")
        start = run.index(inner) if inner else 0
        yield [(start, start + len(inner))]
        if "." in inner:
            ends = [m.start() for m in re.finditer(r"\.", run)]
            yield list(zip([0, *(e + 1 for e in ends)], [*ends, len(run)], strict=True))


def find_spans(text: str, automata: list[Automaton] = (), runs: bool = True) -> list[tuple[int, str, int]]:
    """All spans in order. ``runs=False`` says that the text has no run of 12 token characters.

    Tokens inside a fixed pattern's span are left to it; one that reaches beyond is scored whole.
    """
    found = base_spans(text)
    if runs:
        matches = list(CANDIDATE.finditer(text))
        # a run of hex digits lies in one run of token characters
        found += [(m.start() + h.start(), "hex", m.start() + h.end()) for m in matches if m.end() - m.start() >= LEAST["hex"]
                  for h in HEX.finditer(m.group()) if h.end() - h.start() >= LEAST["hex"]]
        if automata:
            own = sorted((a, b) for a, _, b in found)
            starts, reach = [a for a, _ in own], list(accumulate((b for _, b in own), max))

            def inside(a, b):
                k = bisect_right(starts, a)
                return k > 0 and reach[k - 1] >= b

            for m in matches:
                for parts in _tokens(m.group()):
                    learned = [(m.start() + a, "learned", m.start() + b) for a, b in parts if b - a >= LEAST["assign"]
                               and not inside(m.start() + a, m.start() + b) and is_secret(m.group()[a:b], automata)]
                    if learned:
                        found += learned
                        break
    return in_order(found)


def _has_run(column: pa.Array, least: int = LEAST["assign"]) -> np.ndarray:
    """Which rows hold a run of ``least`` token characters, by a pass over the bytes."""
    data, offsets = column_bytes(column)
    run = np.concatenate([[False], _RUN[data], [False]])
    edge = np.flatnonzero(run[1:] != run[:-1])
    start, end = edge[::2], edge[1::2]
    out = np.zeros(len(column), bool)
    # runs may cross rows here: a row is only ever marked too often
    for k in np.flatnonzero(end - start >= least):
        a, b = np.searchsorted(offsets, [start[k], end[k] - 1], side="right") - 1
        out[a : b + 1] = True
    return out


def credentials(docs: DataFrame, sample: int = SAMPLE, text_col: str = "text") -> dict[str, list[str]]:
    """For each kind up to ``sample`` distinct values that the fixed patterns label as credentials, those of smallest hash.

    Values are whole; so many are taken that they have at most ``SYMBOLS`` characters together.
    """
    bound_batches(docs)

    def extract(batches):
        for batch in text_slices(batches):
            out = set()
            for text, runs in zip(batch.column("text").to_pylist(), _has_run(batch.column("text")), strict=True):
                for a, kind, b in find_spans(text, runs=bool(runs)):
                    value = ASSIGN.fullmatch(text[a:b]).group(2) if kind == "assign" else text[a:b]
                    out.add((kind, value))
            kinds, values = zip(*sorted(out), strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string())], names=["kind", "value"])

    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = stored(texts.mapInArrow(extract, "kind string, value string").distinct(), "credentials")
    out = {}
    for kind in KINDS[:3]:
        first = found.where((F.col("kind") == kind) & (F.length("value") <= SYMBOLS)).orderBy(F.xxhash64("value"), "value")
        total = accumulate(r.n for r in first.select(F.length("value").alias("n")).limit(sample).collect())
        out[kind] = [r.value for r in first.select("value").limit(sum(n <= SYMBOLS for n in total)).collect()]
    return out


def scan(docs: DataFrame, automata: list[Automaton] | None = None, text_col: str = "text", keep: tuple[str, ...] | None = None, masked: bool = False) -> DataFrame:
    """``docs`` with ``spans``, an array of (kind, start, end) in code points, end exclusive, by start and kind.

    Kinds: ``assign``, ``access``, ``hex`` by the fixed patterns; ``learned``: tokens of 12 characters or more
    outside those or reaching beyond them, accepted by an automaton. ``automata`` are learned from ``docs`` unless given. A null text
    is empty. ``keep`` names the other columns to carry (all by default); a column ``spans`` is replaced.
    With ``masked`` the text comes back as ``mask`` describes, a null text as it is, made by the same worker.
    """
    automata = learn(credentials(docs, text_col=text_col)) if automata is None else automata
    bound_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(automata)  # bounded by the sample
    kept = [c for c in (docs.columns if keep is None else keep) if c != "spans"]
    others = [c for c in kept if c != text_col]
    base = docs.select(F.struct(*others, F.lit(1).alias("__")).alias("row"), F.col(text_col).alias("text"))
    with_text = text_col in kept

    def run(batches):
        for batch in text_slices(batches):
            text = pc.fill_null(batch.column("text"), "")
            spans = [[{"kind": k, "start": a, "end": b} for a, k, b in find_spans(t, shared.value, bool(r))] for t, r in zip(text.to_pylist(), _has_run(text), strict=True)]
            found = pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
            shown = batch.column("text")
            if masked:
                shown = pa.array([_masked(t, own) if own else t for t, own in zip(shown.to_pylist(), spans, strict=True)], pa.string())
            columns = [batch.column("row"), *([shown] if with_text else []), found]
            yield pa.RecordBatch.from_arrays(columns, names=["row", *(["text"] if with_text else []), "spans"])

    schema = f"row {base.schema['row'].dataType.simpleString()}, " + "text string, " * with_text + "spans array<struct<kind:string,start:bigint,end:bigint>>"
    out = base.mapInArrow(run, schema)
    return out.select(*(F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in kept), "spans")


def _masked(text: str, spans: list[dict]) -> str:
    at, parts = 0, []
    for s in spans:
        if s["start"] >= at:
            parts += [text[at : s["start"]], f"<{s['kind']}>"]
        at = max(at, s["end"])
    return "".join([*parts, text[at:]])


def mask(docs: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with each secret replaced by ``<kind>``; overlapping spans are one, named by the first. Other text stays.

    A column ``spans`` of ``docs`` stays as it is.
    """
    held = docs.withColumnRenamed("spans", "__spans")
    found = scan(held, text_col=text_col, masked=True, **settings).drop("spans").withColumnRenamed("__spans", "spans")
    return found.select(*(F.col(f"`{c}`") for c in docs.columns))


def joined(spans, kinds: tuple[str, ...]):
    """``kind:start:end`` of the spans of ``kinds``, comma-joined, as a column."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
