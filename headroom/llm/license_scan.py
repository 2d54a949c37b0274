"""License scan by ordered signature rules, in DataFrame functions only.

A text becomes its words, each followed by one space. Texts without any cue are done; of the others, only the rules
whose keyword the text has run. A detection is an interval of words; it is suppressed where a detection of the
same or a stronger tier contains it. All of it is one projection: no shuffle, and no state but one text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_rules import CUES, TIER_WEIGHTS, Rule, rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A match begins and ends with whole words, each followed by its space.
WORDS = r"(?<![^ ])(?:{}) "
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
BLOCK = 256
PLACE = "array<struct<start:bigint,end:bigint,label:string>>"
DETECTION = "array<struct<start:bigint,end:bigint,tier:int,rule:int,label:string>>"
OWN = ("n_words", "base", "detections", "score")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_text(text: Column) -> Column:
    """A-Z lower-cased, the words of the text, each followed by one space; empty without words."""
    return F.ltrim(F.regexp_replace(F.concat(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(" ")), NO_WORD, " "))


def word_count(words: Column) -> Column:
    return (F.char_length(words) - F.char_length(F.replace(words, F.lit(" "), F.lit("")))).cast("long")


def running(xs: Column, fold: Callable[[Column], Column], join: Callable[[Column, Column], Column], none: Column) -> Column:
    """``fold`` of all elements up to each one, by folds of whole blocks and of the rest of a block."""
    cuts = F.sequence(F.lit(0), F.greatest((F.size(xs) - 1) / BLOCK, F.lit(0)).cast("int"))
    blocks = F.transform(cuts, lambda b: fold(F.slice(xs, b * BLOCK + 1, F.lit(BLOCK))))

    def upto(blocks):
        at = lambda i: (i / BLOCK).cast("int")
        return F.transform(xs, lambda x, i: join(F.coalesce(fold(F.slice(blocks, F.lit(1), at(i))), none), fold(F.slice(xs, at(i) * BLOCK + 1, i % BLOCK + 1))))

    return let(blocks, upto)


def running_sum(xs: Column) -> Column:
    return running(xs, lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x), lambda a, b: a + b, F.lit(0).cast("long"))


def running_max(xs: Column) -> Column:
    return running(xs, F.array_max, F.greatest, F.lit(-1).cast("long"))


def places(words: Column, pattern: Column) -> Column:
    """All matches of a pattern of whole words, leftmost and not overlapping: word ``start``, ``end`` (exclusive) and text."""
    def numbered(gaps, hits):
        before = F.transform(hits, lambda h, i: word_count(F.get(gaps, i)) + F.when(i > 0, word_count(F.get(hits, i - 1))).otherwise(0))
        return let(before, lambda b: let(running_sum(b), lambda starts: F.transform(
            hits, lambda h, i: F.struct(F.get(starts, i).alias("start"), (F.get(starts, i) + word_count(h)).alias("end"), F.rtrim(h).alias("text")))))

    none = F.lit(None).cast("array<struct<start:bigint,end:bigint,text:string>>")
    found = let(F.regexp_extract_all(words, pattern, F.lit(0)), lambda hits: F.when(
        F.size(hits) > 0, let(F.split(words, pattern, -1), lambda gaps: numbered(gaps, hits))).otherwise(none))
    return F.coalesce(found, F.array().cast("array<struct<start:bigint,end:bigint,text:string>>"))


def has_any(words: Column, strings: Sequence[str]) -> Column:
    found = F.lit(False)
    for x in strings:
        found = found | F.contains(words, F.lit(x))
    return found


def base_places(words: Column) -> Column:
    """Where the fixed phrases stand, with their labels. No phrase ends with a word that begins one, so none overlap."""
    names = F.create_map(*[F.lit(x) for pair in BASE for x in pair])
    pattern = F.lit(WORDS.format("|".join(phrase for phrase, _ in BASE)))
    found = F.when(has_any(words, [f"{phrase} " for phrase, _ in BASE]), F.transform(
        places(words, pattern), lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.element_at(names, p["text"]).alias("label"))))
    return F.coalesce(found, F.array().cast(PLACE))


def _table(rules: Sequence[Rule]) -> Column:
    """The rules as one constant of the plan."""
    rows = [{"keyword": r.keyword, "pattern": WORDS.format(r.pattern), "tier": r.tier, "rule": k, "label": r.label} for k, r in enumerate(rules)]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<keyword:string,pattern:string,tier:int,rule:int,label:string>>")


def candidates(words: Column, rules: Sequence[Rule], cues: Sequence[str]) -> Column:
    """All matches of the rules whose keyword the text has, in order of start, then longest, strongest and earliest rule first."""
    keywords = F.array(*[F.lit(k) for k in sorted({r.keyword for r in rules})])

    def run(there):
        able = F.filter(_table(rules), lambda r: F.array_contains(there, r["keyword"]))
        found = F.flatten(F.transform(able, lambda r: F.transform(places(words, r["pattern"]), lambda p: F.struct(
            p["start"].alias("start"), (-p["end"]).alias("before"), r["tier"].alias("tier"), r["rule"].alias("rule"), r["label"].alias("label")))))
        return F.transform(F.array_sort(found), lambda d: F.struct(
            d["start"].alias("start"), (-d["before"]).alias("end"), d["tier"].alias("tier"), d["rule"].alias("rule"), d["label"].alias("label")))

    present = F.filter(keywords, lambda k: F.contains(words, F.concat(k, F.lit(" "))))
    found = F.when(has_any(words, cues), let(present, lambda there: F.when(F.size(there) > 0, run(there))))
    return F.coalesce(found, F.array().cast(DETECTION))


def survivors(found: Column) -> Column:
    """Detections that no detection before them in order contains which is of the same or a stronger tier."""
    def ends(tier):
        return running_max(F.transform(found, lambda d: F.when(d["tier"] <= tier, d["end"]).otherwise(F.lit(-1).cast("long"))))

    reach = F.array(*[ends(t) for t in range(len(TIER_WEIGHTS))])
    return F.when(F.size(found) < 2, found).otherwise(
        let(reach, lambda r: F.filter(found, lambda d, i: (i == 0) | (F.get(F.get(r, d["tier"]), i - 1) < d["end"]))))


def scan(docs: DataFrame, text_col: str = "text", signatures: Sequence[Rule] | None = None, cues: Sequence[str] | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words``, ``base`` (places of the fixed phrases), ``detections``, ``score``.

    Places and detections count words from 0, ``end`` is exclusive. A null or empty text has no words, no
    places and score 0; repeated rows are scanned each; columns of the four names are replaced.
    ``score`` is the chance that one of the labels found is right, each label weighing as its strongest tier.
    Own ``signatures`` come with ``cues``, strings one of which every match holds; by default their keywords.
    """
    if cues is None:
        cues = CUES if signatures is None else sorted({s.keyword for s in signatures})
    signatures = rules() if signatures is None else signatures
    weights = F.array(*[F.lit(w) for w in TIER_WEIGHTS])

    def score(found):
        labels = F.array_distinct(F.transform(found, lambda d: d["label"]))
        strongest = lambda name: F.array_min(F.transform(F.filter(found, lambda d: d["label"] == name), lambda d: d["tier"]))
        return F.lit(1.0) - F.aggregate(labels, F.lit(1.0), lambda s, name: s * (F.lit(1.0) - F.get(weights, strongest(name))))

    def all_of(words):
        kept = let(candidates(words, signatures, cues), survivors)
        return let(kept, lambda found: F.struct(
            word_count(words).alias("n_words"), base_places(words).alias("base"), found.alias("detections"), score(found).alias("score")))

    others = [c for c in docs.columns if c not in OWN]
    scanned = docs.withColumn("__scan", let(word_text(F.col(text_col)), all_of))
    return scanned.select(*others, *[F.col("__scan").getField(c).alias(c) for c in OWN])


def label_list(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")
