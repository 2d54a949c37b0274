"""Exact interpolated quantiles without collecting a group.

Groups of at most ``accuracy`` values are sorted whole: their size is counted first. In larger ones the
values at the wanted ranks are found by distributed selection. Each pass takes cuts from a mergeable sketch
of the values still in question, counts every bin between two cuts and every cut itself exactly, and goes on
inside the bin that holds the rank. A cut is a bin of its own, so heavy ties end the search instead of
holding it up, and counts, not sketches, say where a rank lies. No task ranks or holds a large group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions.sizing import forget, stored
from .segments import bin_of

_ACCURACY = 10_000
_CUTS = 1_000
#: A table of so many ranks is sent to all executors; so many cuts of a bracket are compared one by one.
_FEW = 2_000
_UNROLLED = 64


def _attach(rows: DataFrame, table: DataFrame, keys: Sequence[str], more: Column | None = None, salts: int = P.SALTS, few: bool | None = None) -> DataFrame:
    """Inner join of a small table to the rows, NULL keys included; a hot key's rows are spread over ``salts``.

    A table of ``few`` rows goes to all executors, which needs no salts; else both sides are shuffled.
    """
    salts = 1 if few else salts
    mine = table.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in table.columns if c not in keys]).withColumn(
        "_r_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    meet = F.col("_salt") == F.col("_r_salt")
    for k in keys:
        meet = meet & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_x"), F.lit(salts)).cast("int"))
    if few is not None:
        # said here, as a stored column of few values is a tiny file of many rows, which the optimiser would send to all
        salted, mine = (salted, F.broadcast(mine)) if few else (salted.hint("merge"), mine)
    return salted.join(mine, meet if more is None else meet & more).drop("_salt", "_r_salt", *[f"_r_{k}" for k in keys])


def _ranks(probs: Sequence[float], n: Column) -> Column:
    """For each probability the two ranks, from 0, that its quantile lies between, and how far."""
    h = [F.lit(float(p)) * (n - F.lit(1).cast("double")) for p in probs]
    return F.array(*[F.struct(
        F.lit(float(p)).alias("prob"), F.floor(x).cast("long").alias("_k"), F.least(F.floor(x).cast("long") + 1, n - 1).alias("_next"), (x - F.floor(x)).alias("_part"),
    ) for p, x in zip(probs, h, strict=True)])


def _near_ranks(sketch: DataFrame, state: DataFrame, bracket: Sequence[str], cuts: int) -> DataFrame:
    """``bracket, _cuts``: of a bracket's sketch the cuts just before and behind the ranks looked for in it.

    Only where the search goes on depends on them: a rank that they miss is in one of the bins beside them.
    """
    asked = state.groupBy(*bracket).agg(F.collect_list(F.col("_rank") - F.col("_below")).alias("_asked"))
    theirs = asked.select(*[F.col(c).alias(f"_r{c}") for c in bracket], "_asked")
    meet = F.lit(True)
    for c in bracket:
        meet = meet & F.col(c).eqNullSafe(F.col(f"_r{c}"))
    at = lambda r: F.floor(r * F.lit(cuts) / F.col("_many")).cast("int")
    last = F.size("_all") - 1
    pick = lambda r: F.array(*[F.get("_all", F.greatest(F.lit(0), F.least(at(r) + step, last))) for step in (-2, 1)])
    near = F.array_sort(F.array_distinct(F.flatten(F.transform("_asked", pick))))
    return sketch.join(theirs, meet).select(*bracket, near.alias("_cuts"))


def select_ranks(data: DataFrame, keys: Sequence[str], wanted: DataFrame, accuracy: int = _ACCURACY, cuts: int = _CUTS) -> DataFrame:
    """``keys, _rank, _value``: the values of ``data (keys, _x)`` at the ranks of ``wanted (keys, _rank, _low, _high)``.

    ``_low`` and ``_high`` are the least and greatest value of the group. The driver sees one number a pass,
    how many ranks are left. Raises if a rank is in no bin, which only a change of ``data`` in between can cause.
    """
    state = stored(wanted.withColumn("_below", F.lit(0).cast("long")), "ranks")
    found, many = [state.where("_low = _high")], state.count()
    state = state.where("_low < _high")
    left = state.count()
    done = many - left
    grid = [i / cuts for i in range(1, cuts)]
    while left:
        few = left <= _FEW
        bracket = [*keys, "_low", "_high"]
        inside = stored(_attach(data, state.select(*bracket).distinct(), keys, (F.col("_x") >= F.col("_low")) & (F.col("_x") <= F.col("_high")), few=few), "inside")
        sketch = inside.groupBy(*bracket).agg(F.count(F.lit(1)).alias("_many"), F.percentile_approx("_x", grid, accuracy).alias("_all"))
        sketch = stored(_near_ranks(sketch, state, bracket, cuts), "cuts")
        most = sketch.agg(F.max(F.size("_cuts"))).first()[0] or 0
        placed = _attach(inside, sketch, bracket, few=few)
        at = bin_of(F.col("_x"), F.col("_cuts"), 32)
        if most <= _UNROLLED:
            at = sum([F.coalesce((F.get("_cuts", F.lit(i)) < F.col("_x")).cast("int"), F.lit(0)) for i in range(most)], F.lit(0))
        placed = placed.withColumn("_at", at)
        # an open bin before each cut, and the cut itself
        bins = placed.withColumn("_bin", F.col("_at") * 2 + F.coalesce((F.get("_cuts", F.col("_at")) == F.col("_x")).cast("int"), F.lit(0)))
        counts = bins.groupBy(*bracket, "_bin").agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_least"), F.max("_x").alias("_most"))
        over = Window.partitionBy(*bracket).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
        counts = counts.withColumn("_upto", F.sum("_n").over(over))
        theirs = counts.select(*[F.col(c).alias(f"_r{c}") for c in bracket], "_n", "_upto", "_least", "_most")
        meet = (F.col("_rank") < F.col("_below") + F.col("_upto")) & (F.col("_rank") >= F.col("_below") + F.col("_upto") - F.col("_n"))
        for c in bracket:
            meet = meet & F.col(c).eqNullSafe(F.col(f"_r{c}"))
        narrowed = state.join(theirs, meet).select(
            *keys, "_rank", F.col("_least").alias("_low"), F.col("_most").alias("_high"), (F.col("_below") + F.col("_upto") - F.col("_n")).alias("_below"))
        narrowed = stored(narrowed, "ranks")
        forget(inside, sketch)
        found.append(narrowed.where("_low = _high"))
        state = narrowed.where("_low < _high")
        now = state.count()
        done += found[-1].count()
        if done + now != many:
            raise RuntimeError(f"{many - done - now} ranks are in no bin: the table has changed")
        left = now
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select(*keys, "_rank", F.col("_low").alias("_value"))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    name: str = "quantile",
    accuracy: int = _ACCURACY,
    cuts: int = _CUTS,
) -> DataFrame:
    """Long table ``keys, prob, quantile`` with linear interpolation; NULL values are ignored, NULL keys are a group.

    The values are stored, unless ``df`` is a stored table itself.
    """
    data = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_x"))
    data = data if hasattr(df, "stored_at") else stored(data, "values")
    blend = lambda a, b, part: a + (b - a) * part
    sizes = data.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_low"), F.max("_x").alias("_high"))
    large = stored(sizes.where(F.col("_n") > accuracy), "sizes")
    some = not large.isEmpty()
    # sorted whole: proven to hold at most `accuracy` values
    small = data
    if some:
        hit = F.lit(True)
        theirs = large.select(*[F.col(k).alias(f"_l_{k}") for k in keys])
        for k in keys:
            hit = hit & F.col(k).eqNullSafe(F.col(f"_l_{k}"))
        small = data.join(theirs, hit, "left_anti") if keys else data.limit(0)
    sorted_ = small.groupBy(*keys).agg(F.array_sort(F.collect_list("_x")).alias("_all")).where(F.size("_all") > 0)
    each = sorted_.select(*keys, "_all", F.explode(_ranks(probs, F.size("_all").cast("long"))).alias("_t"))
    out = each.select(*keys, F.col("_t.prob").alias("prob"), blend(
        F.get("_all", F.col("_t._k").cast("int")), F.get("_all", F.col("_t._next").cast("int")), F.col("_t._part")).alias(name))
    if not some:
        return out
    targets = large.select(*keys, "_low", "_high", F.explode(_ranks(probs, F.col("_n"))).alias("_t"))
    ranks = targets.select(*keys, "_low", "_high", F.explode(F.array("_t._k", "_t._next")).alias("_rank")).distinct()
    picked = select_ranks(data, keys, ranks, accuracy, cuts)
    wide = targets.select(*keys, "_t.*")
    for side in ("_k", "_next"):
        theirs = picked.select(*[F.col(k).alias(f"_p_{k}") for k in keys], F.col("_rank"), F.col("_value").alias(f"_at{side}"))
        meet = F.col(side) == F.col("_rank")
        for k in keys:
            meet = meet & F.col(k).eqNullSafe(F.col(f"_p_{k}"))
        wide = wide.join(theirs, meet).drop("_rank", *[f"_p_{k}" for k in keys])
    return out.unionByName(wide.select(*keys, "prob", blend(F.col("_at_k"), F.col("_at_next"), F.col("_part")).alias(name)))


def quantile_columns(long: DataFrame, keys: Sequence[str], names: dict[float, str], value: str = "quantile") -> DataFrame:
    """Turn the long result into one column per quantile."""
    picks = [F.max(F.when(F.col("prob") == F.lit(float(p)), F.col(value))).alias(n) for p, n in names.items()]
    return long.groupBy(*keys).agg(*picks)


def melt(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), name: str = "metric", value: str = "value") -> DataFrame:
    """Metric columns to rows."""
    return df.unpivot([F.col(k) for k in keys], [F.col(c) for c in columns], name, value)
