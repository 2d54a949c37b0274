"""Words of a corpus and their near words (one edit apart), found by a variable-length gram index.

A gram starts at every place of a padded word. It is ``LEAST`` code points long unless so short a gram is
frequent: then it grows, at most to ``MOST``. Which gram stands at a place depends only on the code points
the gram itself covers, so one edit changes no more grams than cover one place. That count is computed for
each word, and of two near words the rarest grams one more than it hold a common one at the same distance
from the start or from the end. Lists of words are merged on those grams, and each pair met is verified.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import forget, stored

LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST = 7
LEAST, MOST = 3, 5
#: A gram of more places than this grows; the dictionary of such grams holds at most ENTRIES of each size.
FREQUENT = 100
ENTRIES = 100_000
#: Lists of more words than this are cut further, by halves of the words.
LONG_LIST = 512
DROP_MODULUS = 31
FACTOR = 10


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """``word, n``: the words of at least ``shortest`` code points and how often each occurs, with one code point of some runs gone.

    A run's checksum with its document's id (no digits for a null id) says whether and where it loses one.
    """
    runs = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"([{LETTERS}]{{{shortest},}})"), F.lit(1)))
    found = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), runs.alias("run"))
    found = found.select("id", F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("run"))
    mark = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = F.pmod(F.col("mark"), F.char_length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    kept = found.withColumn("mark", mark).select(F.when(F.pmod(F.col("mark"), F.lit(DROP_MODULUS)) == 0, less).otherwise(F.col("run")).alias("word"))
    return kept.where(F.char_length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def dictionary(vocabulary: DataFrame, least: int = LEAST, most: int = MOST, frequent: int = FREQUENT, entries: int = ENTRIES) -> dict[str, int]:
    """The frequent grams of ``least`` to ``most`` code points of ``vocabulary (word)`` and at how many places they stand.

    At most ``entries`` grams of each size come back, whatever the vocabulary: more cannot stand at more than
    one in so many of all places. The limit only moves the size at which grams stop growing.
    """
    padded = F.concat(F.lit("^"), "word", F.lit("$"))
    windows = vocabulary.select(F.explode(F.regexp_extract_all(padded, F.lit(f"(?=(.{{{least},{most}}}))"), F.lit(1))).alias("window"))
    counts = windows.groupBy("window").agg(F.count(F.lit(1)).alias("often"))
    prefixes = F.transform(F.sequence(F.lit(least), F.char_length("window")), lambda k: F.substring("window", F.lit(1), k))
    grams = counts.select(F.explode(prefixes).alias("gram"), "often").groupBy("gram").agg(F.sum("often").alias("often"))
    grams = stored(grams.where(F.col("often") > frequent), "grams")
    places = vocabulary.agg(F.sum(F.char_length("word") + 3 - least)).first()[0] or 0
    out = {r.gram: r.often for r in grams.where(F.col("often") > places // entries).collect()}
    forget(grams)
    return out


def signature(word: str, often: dict[str, int], least: int = LEAST, most: int = MOST) -> list[tuple[str, int]]:
    """The rarest grams of a word and their places, one gram more than one edit can change.

    An edit changes only grams that cover its place, so the most grams over one place bound what it changes.
    """
    padded = f"^{word}$"
    found, ends = [], []
    for place in range(len(padded) - least + 1):
        end, last = place + least, min(place + most, len(padded))
        while end < last and padded[place:end] in often:
            end += 1
        gram = padded[place:end]
        found.append((often.get(gram, 0), gram, place))
        ends.append(end)
    # over the place before an end are the grams that began by then, less those that ended earlier
    over = max(min(end, len(found)) - k for k, end in enumerate(sorted(ends)))
    return [(gram, place) for _, gram, place in sorted(found)[: over + 1]]


def lists(vocabulary: DataFrame, often: dict[str, int], least: int = LEAST, most: int = MOST) -> DataFrame:
    """``list, side, known, size, id, word``: for each of its signature's grams a word stands in two lists.

    An edit after the gram leaves the word up to the gram's end as it is, an edit before it the word from
    the gram's start on. So one list holds the words that agree with the gram and all before it, the other
    those that agree with it and all after it. ``known`` is how many code points that are; ``list`` is a
    hash: what meets there is verified.
    """
    sent = vocabulary.sparkSession.sparkContext.broadcast(often)

    def sign(batches):
        for batch in batches:
            signed = [signature(w, sent.value, least, most) for w in batch.column("word").to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in signed])])
            grams = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array([g for x in signed for g, _ in x], pa.string()))
            places = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array([p for x in signed for _, p in x], pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("word"), grams, places], names=["id", "word", "grams", "places"])

    signed = vocabulary.select("id", "word").mapInArrow(sign, "id long, word string, grams array<string>, places array<int>")
    signed = signed.select("id", "word", F.char_length("word").alias("size"), F.explode(F.arrays_zip("grams", "places")).alias("g"))
    place, after = F.col("g.places"), F.col("g.places") + F.char_length("g.grams")
    # places count the mark before the word; a gram may hold a mark
    known = {"<": F.least(after - 1, F.col("size")), ">": F.least(F.col("size") - place + 1, F.col("size"))}
    same = {"<": F.substring("word", F.lit(1), known["<"]), ">": F.substring("word", F.col("size") - known[">"] + 1, F.col("size"))}
    sides = F.array(*[F.struct(
        F.xxhash64("g.grams", F.lit(side), place if side == "<" else F.col("size") - place, same[side]).alias("list"), F.lit(side).alias("side"), known[side].cast("int").alias("known"),
    ) for side in ("<", ">")])
    return signed.select("id", "word", "size", F.explode(sides).alias("s")).select("s.*", "size", "id", "word")


def cut_long_lists(listed: DataFrame, limit: int = LONG_LIST) -> DataFrame:
    """The same lists, those of more than ``limit`` words cut into lists of words that agree in more.

    Of the part in which the words of a list may differ, an edit leaves one half of the shorter word as it
    is. A word may be the shorter one, or the longer one by a code point, so it stands under four halves.
    """
    many = listed.groupBy("list").agg(F.count(F.lit(1)).alias("_many")).where(F.col("_many") > limit).select("list", F.lit(True).alias("_cut"))
    lists = []
    for shorter in (F.col("size"), F.col("size") - 1):
        half = F.floor((shorter - F.col("known")) / 2).cast("int")
        for side in ("<", ">"):
            # what is known and the half beside it; the other half, from the other end
            more = F.when(F.col("side") == side, F.col("known") + half).otherwise(shorter - F.col("known") - half)
            text = F.substring("word", F.lit(1), more) if side == "<" else F.substring("word", F.col("size") - more + 1, F.col("size"))
            lists.append(F.xxhash64("list", shorter, F.lit(side), text))
    joined = listed.join(many, "list", "left")
    return joined.select(F.explode(F.when(F.col("_cut"), F.array(*lists)).otherwise(F.array("list"))).alias("list"), "size", "id", "word")


def near_words(vocabulary: DataFrame, least: int = LEAST, most: int = MOST, frequent: int = FREQUENT, limit: int = LONG_LIST) -> DataFrame:
    """``a, b``: ids of all pairs of words of ``vocabulary (id, word)`` that differ by exactly one code point, each pair once.

    Two words of a list are verified where they meet, so only near pairs leave the join. Words must have at
    least ``least + most - 2`` code points: then every word has more grams than one edit can change.
    """
    often = dictionary(vocabulary, least, most, frequent)
    listed = stored(lists(vocabulary, often, least, most), "lists")
    cut = cut_long_lists(listed, limit)
    left = cut.select("list", *[F.col(c).alias(f"l_{c}") for c in ("size", "id", "word")])
    right = cut.select(F.col("list").alias("other"), *[F.col(c).alias(f"r_{c}") for c in ("size", "id", "word")])
    longer = F.col("r_size") - F.col("l_size")
    turn = (longer == 1) | ((longer == 0) & (F.col("l_id") < F.col("r_id")))
    near = F.levenshtein("l_word", "r_word", 1) == 1
    met = left.join(right, (F.col("list") == F.col("other")) & turn & near)
    pairs = stored(met.select(F.least("l_id", "r_id").alias("a"), F.greatest("l_id", "r_id").alias("b")).distinct(), "near-words")
    forget(listed)
    return pairs


def variants(counted: DataFrame, factor: int = FACTOR, near: DataFrame | None = None) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of all words of ``counted (id, word, n)``.

    The form of a word is its near word of largest ``n`` (ties: smallest), if that is at least ``factor`` times
    its own. Counts grow by the factor from word to form, so chains are short: their length follows from the
    largest count, and each round of following forms doubles what has been followed.
    """
    pairs = near_words(counted.select("id", "word")) if near is None else near
    ends = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    theirs = counted.select(F.col("id").alias("b"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form", F.col("b").alias("form_id"))).alias("best")
    known = ends.join(theirs, "b").groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), best).withColumnRenamed("a", "id")
    joined = counted.join(known, "id", "left")
    taken = (-F.col("best.less")) >= F.col("n") * factor
    own = stored(joined.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(taken, F.col("best.form")).alias("form"),
        F.when(taken, -F.col("best.less")).alias("form_n"), F.when(taken, F.col("best.form_id")).alias("form_id")), "forms")
    top = own.agg(F.max("n")).first()[0] or 1
    steps, reach = own.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("up")), 1
    while factor**reach < top:  # a chain of k forms needs a count of factor ** k
        up = steps.select(F.col("id").alias("up"), F.col("up").alias("further"))
        steps, reach = stored(steps.join(up, "up", "left").select("id", F.coalesce("further", "up").alias("up")), "roots"), 2 * reach
    roots = steps.join(own.select(F.col("id").alias("up"), F.col("word").alias("root")), "up").select("id", "root")
    return own.join(roots, "id", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = 2, factor: int = FACTOR) -> DataFrame:
    """All words of at least seven code points that occur ``times`` or more, with their forms.

    A null text has no words; rows that share an id, and rows without one, count like any other. An empty
    table, or one without words, gives no rows. Other columns are not read.
    """
    counted = words(docs, id_col, text_col).where(F.col("n") >= times)
    # written once with its ids, so that every later read sees the same
    counted = stored(counted.withColumn("id", F.monotonically_increasing_id()), "vocabulary")
    return variants(counted, factor)

