"""Ordered work on long series without ever holding one series in one task.

One entity may own a large share of all rows, so nothing here partitions by entity alone.

* A *segment* is a span of time of one entity, computed from the row itself. Running values
  (fills, totals, positions) are computed inside segments and corrected by a small table with
  one row per entity and segment that carries the state over from earlier segments.
* A *chunk* is a run of row positions of one entity. Windows with a bounded look-back run
  inside chunks; the few rows before a chunk's start are copied into it and dropped afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .. import params as P

SEG = "_segment"
CHUNK = "_chunk"
HALO = "_halo"


def segment_of(ts: Column | str, hours: int = P.SEGMENT_HOURS) -> Column:
    """Number of the time span a timestamp or date falls in."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    if hours % 24 == 0:
        return F.floor(F.unix_date(F.to_date(ts)) / F.lit(hours // 24)).cast("long")
    return F.floor((F.unix_date(F.to_date(ts)) * 24 + F.hour(ts)) / F.lit(hours)).cast("long")


def with_segment(df: DataFrame, ts: str, hours: int = P.SEGMENT_HOURS) -> DataFrame:
    return df.withColumn(SEG, segment_of(ts, hours))


def attach_by_segment(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join a table with one row per (entity, segment) to the rows."""
    mine = table.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in table.columns if c not in keys])
    cond = [F.col(k) == F.col(f"_r_{k}") for k in keys]
    return df.join(mine, cond, "left").drop(*[f"_r_{k}" for k in keys])


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    seg: str,
    order: Sequence[str],
    values: dict[str, Column],
) -> DataFrame:
    """Add ``name`` = sum of ``values[name]`` over all rows of the keys up to and including this one.

    ``seg`` must be a coarse, order-preserving function of the leading ``order`` column.
    """
    staged = df.withColumns({f"_v_{n}": c for n, c in values.items()})
    sums = staged.groupBy(*keys, seg).agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in values])
    before = Window.partitionBy(*keys).orderBy(seg).rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(*keys, seg, *[F.sum(f"_s_{n}").over(before).alias(f"_c_{n}") for n in values])
    here = Window.partitionBy(*keys, seg).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = staged.withColumns({f"_l_{n}": F.sum(f"_v_{n}").over(here) for n in values})
    joined = attach_by_segment(local, carried, [*keys, seg])
    total = {
        n: F.when(F.col(f"_l_{n}").isNull() & F.col(f"_c_{n}").isNull(), None).otherwise(
            F.coalesce(F.col(f"_l_{n}"), F.lit(0)) + F.coalesce(F.col(f"_c_{n}"), F.lit(0))
        )
        for n in values
    }
    drop = [f"_{p}_{n}" for n in values for p in ("v", "l", "c")]
    return joined.withColumns(total).drop(*drop)


def with_position(
    df: DataFrame,
    entity: Sequence[str],
    ts: str,
    order: Sequence[str] | None = None,
    name: str = "position",
    hours: int = P.SEGMENT_HOURS,
) -> DataFrame:
    """1-based position of each row in its entity's order."""
    order = order or [ts]
    out = running_totals(with_segment(df, ts, hours), entity, SEG, order, {name: F.lit(1).cast("long")})
    return out.drop(SEG)


def neighbours(
    df: DataFrame,
    entity: Sequence[str],
    ts: str,
    values: dict[str, Column],
    order: Sequence[str] | None = None,
    before: str | None = "_prev_",
    after: str | None = "_next_",
    hours: int | None = P.SEGMENT_HOURS,
) -> DataFrame:
    """Nearest non-NULL of each value at or before (``_prev_x``) and at or after (``_next_x``) the row.

    Both directions use growing frames: the backward one runs on descending order. Without ``hours`` an entity
    is not cut into segments, which saves carrying values over; for series that the calendar bounds.
    """
    order = list(order or [ts])
    if hours is None:
        near = {}
        for n, c in values.items():
            for name, by in ((before, order), (after, [F.desc(o) for o in order])):
                if name:
                    near[f"{name}{n}"] = F.last(c, ignorenulls=True).over(Window.partitionBy(*entity).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0))
        return df.withColumns(near)
    staged = with_segment(df, ts, hours).withColumns({f"_v_{n}": c for n, c in values.items()})
    keys = [*entity, SEG]
    place = F.struct(*order) if len(order) > 1 else F.col(order[0])
    ends = []
    for n in values:
        held = F.when(F.col(f"_v_{n}").isNotNull(), place)
        if before:
            ends.append(F.max_by(f"_v_{n}", held).alias(f"_last_{n}"))
        if after:
            ends.append(F.min_by(f"_v_{n}", held).alias(f"_first_{n}"))
    summary = staged.groupBy(*keys).agg(*ends)
    past = Window.partitionBy(*entity).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    future = Window.partitionBy(*entity).orderBy(F.desc(SEG)).rowsBetween(Window.unboundedPreceding, -1)
    carry = []
    for n in values:
        if before:
            carry.append(F.last(f"_last_{n}", ignorenulls=True).over(past).alias(f"_cb_{n}"))
        if after:
            carry.append(F.last(f"_first_{n}", ignorenulls=True).over(future).alias(f"_ca_{n}"))
    carried = summary.select(*keys, *carry)
    up = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*keys).orderBy(*[F.desc(o) for o in order]).rowsBetween(Window.unboundedPreceding, 0)
    local = {}
    for n in values:
        if before:
            local[f"{before}{n}"] = F.last(f"_v_{n}", ignorenulls=True).over(up)
        if after:
            local[f"{after}{n}"] = F.last(f"_v_{n}", ignorenulls=True).over(down)
    joined = attach_by_segment(staged.withColumns(local), carried, keys)
    final = {}
    for n in values:
        if before:
            final[f"{before}{n}"] = F.coalesce(F.col(f"{before}{n}"), F.col(f"_cb_{n}"))
        if after:
            final[f"{after}{n}"] = F.coalesce(F.col(f"{after}{n}"), F.col(f"_ca_{n}"))
    drop = [f"_v_{n}" for n in values] + [f"_cb_{n}" for n in values] + [f"_ca_{n}" for n in values]
    return joined.withColumns(final).drop(SEG, *drop)


def day_position(ts: str) -> Column:
    """Row position of a gap-free daily series: consecutive days are consecutive integers."""
    return F.unix_date(F.to_date(F.col(ts))).cast("long")


#: ``regular=BUILT``: the caller has made the daily axis itself (``fill_calendar``), so it need not be checked.
BUILT = "built"


def gap_free(df: DataFrame, entity: Sequence[str], ts: str) -> bool:
    """Whether every entity has each day from its first to its last exactly once.

    One aggregate per entity: as many rows as days, and their hashes cancel those of the days out.
    """
    day = F.unix_date(F.to_date(F.col(ts)))
    per = df.groupBy(*entity).agg(
        F.count(F.lit(1)).alias("_n"), F.count(day).alias("_held"), F.min(day).alias("_a"), F.max(day).alias("_b"), F.bit_xor(F.xxhash64(day)).alias("_h"))
    days = F.aggregate(F.sequence("_a", "_b"), F.lit(0).cast("long"), lambda s, d: s.bitwiseXOR(F.xxhash64(d)))
    right = (F.col("_n") == F.col("_held")) & (F.col("_n") == F.col("_b") - F.col("_a") + 1)
    return per.where(~F.when(right, days == F.col("_h")).otherwise(False)).isEmpty()


def row_positions(
    df: DataFrame, entity: Sequence[str], ts: str, regular: bool | str, order: Sequence[str] | None = None, hours: int = P.SEGMENT_HOURS,
) -> DataFrame:
    """Add ``_pos``, consecutive for consecutive rows of an entity.

    A gap-free daily panel takes it from the date, without a shuffle. ``regular=True`` says that the panel
    should be one: it is checked, and numbered like any other where days are missing or repeated.
    """
    if regular == BUILT or (regular and gap_free(df, entity, ts)):
        return df.withColumn("_pos", day_position(ts))
    return with_position(df, entity, ts, order, "_pos", hours)


def open_chunks(df: DataFrame, position: str | Column, lookback: int, rows: int = P.CHUNK_ROWS) -> DataFrame:
    """Give each row its chunk and copy the last ``lookback`` rows of a chunk into the next one."""
    pos = F.col(position) if isinstance(position, str) else position
    rows = max(rows, lookback)
    own = F.floor(pos / F.lit(rows)).cast("long")
    into = F.when(F.floor((pos + lookback) / F.lit(rows)).cast("long") > own, F.array(own, own + 1)).otherwise(F.array(own))
    return df.withColumn("_own", own).withColumn(CHUNK, F.explode(into)).withColumn(HALO, F.col(CHUNK) != F.col("_own")).drop("_own")


def close_chunks(df: DataFrame) -> DataFrame:
    """Drop the copied rows."""
    return df.filter(~F.col(HALO)).drop(CHUNK, HALO)


def chunk_window(entity: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*entity, CHUNK).orderBy(*order)


def with_row_windows(
    df: DataFrame,
    entity: Sequence[str],
    ts: str,
    lookback: int,
    columns,
    regular: bool | str = False,
    order: Sequence[str] | None = None,
    rows: int = P.CHUNK_ROWS,
    hours: int = P.SEGMENT_HOURS,
) -> DataFrame:
    """Add window columns that look back at most ``lookback`` rows of the same entity.

    ``columns`` maps a window specification to ``{name: column}``. A gap-free daily panel
    (``regular``, see ``row_positions``) takes positions from the date and needs a single shuffle;
    other panels are numbered first.
    """
    order = list(order or [ts])
    open_, by = open_chunks(row_positions(df, entity, ts, regular, order, hours), "_pos", lookback, rows), ["_pos"]
    made = columns(chunk_window(entity, by))
    open_ = open_.withColumns(made)
    return close_chunks(open_).drop("_pos")


def name_bounds(values: DataFrame, column: str, bins: int = 1024) -> Column:
    """About ``bins`` sorted values of a column with distinct values, as a scalar array.

    They only say where to cut the order into bins, so which ones are taken never changes a result.
    """
    many = values.agg(F.greatest(F.lit(1).cast("long"), F.floor(F.count(F.lit(1)) / F.lit(bins)).cast("long")))
    taken = values.filter(F.pmod(F.xxhash64(column), many.scalar()) == 0)
    return taken.agg(F.array_sort(F.collect_list(column)).alias("_b")).select("_b").scalar()


def bin_of(value: Column, bounds: Column, coarse: int = 64) -> Column:
    """Index of the bin of a value among sorted bounds, by two short scans instead of one long one."""
    anchors = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(bounds) - 1, F.lit(0)), F.lit(coarse)), lambda i: F.get(bounds, i)
    )
    block = F.greatest(F.size(F.filter(anchors, lambda b: b < value)) - 1, F.lit(0))
    inner = F.slice(bounds, block * coarse + 1, coarse)
    return block * coarse + F.size(F.filter(inner, lambda b: b < value))


def overall_totals(
    df: DataFrame, column: str, values: dict[str, Column], distinct: DataFrame | None = None, bins: int = 1024
) -> DataFrame:
    """Running sums over a whole table with distinct values of ``column``, in its order, without one big sort."""
    placed = df.withColumn("_bounds", name_bounds(df if distinct is None else distinct, column, bins))
    placed = placed.withColumn(SEG, bin_of(F.col(column), F.col("_bounds"))).drop("_bounds")
    return running_totals(placed, [], SEG, [column], values).drop(SEG)


def last_before(df: DataFrame, column: str, values: dict[str, str], bins: int = 1024) -> DataFrame:
    """``column`` and, per value, the last non-NULL one among the rows before it in ``column`` order."""
    placed = df.withColumn("_bounds", name_bounds(df, column, bins))
    placed = placed.withColumn(SEG, bin_of(F.col(column), F.col("_bounds"))).drop("_bounds")
    tails = placed.groupBy(SEG).agg(
        *[F.max_by(v, F.when(F.col(v).isNotNull(), F.col(column))).alias(f"_e_{n}") for n, v in values.items()]
    )
    over_bins = Window.orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(SEG, *[F.last(f"_e_{n}", ignorenulls=True).over(over_bins).alias(f"_c_{n}") for n in values])
    here = Window.partitionBy(SEG).orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumns({f"_l_{n}": F.last(v, ignorenulls=True).over(here) for n, v in values.items()})
    both = attach_by_segment(local, carried, [SEG])
    return both.select(column, *[F.coalesce(f"_l_{n}", f"_c_{n}").alias(n) for n in values])


def attach_entity_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str], spread: str, salts: int = P.SALTS) -> DataFrame:
    """Left join one row per entity back to its rows, a hot entity's rows being spread over ``salts``.

    ``spread`` is a column that differs between the rows of one entity. With one salt, for entities that own
    few rows each, rows that lie together by the keys stay where they are.
    """
    if salts == 1:
        mine = stats.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in stats.columns if c not in keys])
        return df.join(mine, [F.col(k) == F.col(f"_r_{k}") for k in keys], "left").drop(*[f"_r_{k}" for k in keys])
    salted = stats.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    mine = salted.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col("_salt").alias("_r_salt"),
                         *[c for c in stats.columns if c not in keys])
    salt = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    cond = [F.col(k) == F.col(f"_r_{k}") for k in keys] + [F.col("_salt") == F.col("_r_salt")]
    return df.withColumn("_salt", salt).join(mine, cond, "left").drop("_salt", "_r_salt", *[f"_r_{k}" for k in keys])
