"""Nearest-in-time joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fogline.operators.scan import time_segment
from fogline.session import cut_lineage

_ALL = Window.unboundedPreceding
_FAR = Window.unboundedFollowing


#: Bits of the number of segments under one wider segment; seconds that times may span, ten thousand years.
_SIBLINGS, _SPAN = 18, 320_000_000_000
#: Segments that are put into one where right rows are copied to all in their reach: with reach as wide as a segment, 1.5 copies.
_TOGETHER = 4


def _wider_levels(keys: Sequence[str], segment_seconds: int) -> int:
    """How often segments are put together: not at all within a key, else until one window holds the rest."""
    bits = max(1, _SPAN // segment_seconds).bit_length()
    return 0 if keys else max(0, -(-bits // _SIBLINGS) - 1)


def _carried(ends: DataFrame, keys: Sequence[str], wider: int) -> DataFrame:
    """(keys, __seg, __in, __out): the last row before each segment and the first one after it.

    A prefix maximum on several levels: 2 ** _SIBLINGS neighbouring segments form a wider one, what lies inside it is found
    by a window over these siblings, and what lies outside comes from the same question about the wider segments. So no window
    spans more than the siblings of one segment, with keys or without, and each level has fewer rows than the one below.
    """
    # On the last level all that is left are siblings.
    up = F.shiftright(F.col("__seg"), _SIBLINGS) if wider else F.shiftright(F.col("__seg") + F.lit(1 << 61), 62)
    rows = ends.withColumn("__up", up)
    among = Window.partitionBy(*keys, "__up")
    near = rows.select(
        *keys,
        "__seg",
        "__up",
        F.last("__last", ignorenulls=True).over(among.orderBy("__seg").rowsBetween(_ALL, -1)).alias("__in"),
        F.last("__first", ignorenulls=True).over(among.orderBy(F.col("__seg").desc()).rowsBetween(_ALL, -1)).alias("__out"),
    )
    if not wider:
        return near.drop("__up")
    together = rows.groupBy(*keys, F.col("__up").alias("__seg")).agg(
        F.max_by("__last", F.when(F.col("__last").isNotNull(), F.col("__seg"))).alias("__last"),
        F.min_by("__first", F.when(F.col("__first").isNotNull(), F.col("__seg"))).alias("__first"),
    )
    far = _carried(together, keys, wider - 1).select(
        *keys, F.col("__seg").alias("__up"), F.col("__in").alias("__far_in"), F.col("__out").alias("__far_out")
    )
    return near.join(far, [*keys, "__up"]).select(
        *keys, "__seg", F.coalesce("__in", "__far_in").alias("__in"), F.coalesce("__out", "__far_out").alias("__out")
    )


def asof_candidates(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    tie_order: Sequence[str],
    segment_seconds: int = 3600,
    same_ts: str = "last",
) -> DataFrame:
    """Left rows plus ``__bwd`` (newest right row not after) and ``__fwd`` (oldest one after).

    Both are structs of all right columns or NULL. Right rows are first reduced to one per
    (keys, timestamp): with ``same_ts='last'`` backward takes the last and forward the first
    duplicate in ``tie_order``, with ``'first'`` both take the first. Times are cut into
    segments; what lies outside a segment reaches it as at most two carry rows, so neither a
    busy key nor a busy period ends up in a single task, and no key is matched pair by pair. Making the frame runs no job.
    """
    keys = list(keys)
    usable = right.dropna(subset=[*keys, right_ts]) if keys else right.dropna(subset=[right_ts])
    # Keys stand beside the payload all the way, so they are no part of it. Where it has an order it is its own rank.
    held = list(dict.fromkeys([*[c for c in tie_order if c not in keys], *[c for c in usable.columns if c not in keys]]))
    payload = F.struct(*held)
    ordered = "map<" not in usable.schema.simpleString()
    least = F.min(payload) if ordered else F.min_by(payload, F.struct(*tie_order))
    last = least if same_ts != "last" else F.max(payload) if ordered else F.max_by(payload, F.struct(*tie_order))
    rights = (
        usable.groupBy(*keys, F.col(right_ts).alias("__ts"))
        .agg(last.alias("__b"), least.alias("__f"))
        .withColumn("__seg", time_segment(F.col("__ts"), segment_seconds))
    )
    if ordered:  # written once where both are the same row
        rights = rights.withColumn("__f", F.when(~F.col("__f").eqNullSafe(F.col("__b")), F.col("__f")))
    ahead = F.coalesce("__f", "__b")
    # Only distinct probe times are scanned, so copies of a left row add nothing here.
    lefts = (
        left.dropna(subset=[*keys, left_ts])
        .select(*keys, F.col(left_ts).alias("__ts"))
        .distinct()
        .withColumn("__seg", time_segment(F.col("__ts"), segment_seconds))
    )

    # Summary per (keys, segment) over both sides: a segment may hold left rows only.
    ends = (
        rights.select(*keys, "__seg", "__ts", "__b", "__f")
        .unionByName(lefts.select(*keys, "__seg"), allowMissingColumns=True)
        .groupBy(*keys, "__seg")
        .agg(
            # What comes before a segment is only looked back at, what comes after only ahead.
            F.max_by(F.struct("__ts", "__b"), "__ts").alias("__last"),
            F.min_by(F.struct("__ts", ahead.alias("__f")), "__ts").alias("__first"),
        )
    )
    carried = _carried(ends, keys, _wider_levels(keys, segment_seconds))
    none = F.lit(None).cast(rights.schema["__b"].dataType)
    carries = (
        carried.select(
            *keys,
            "__seg",
            F.inline(
                F.array(
                    F.struct(F.col("__in.__ts").alias("__ts"), F.col("__in.__b").alias("__b"), none.alias("__f")),
                    F.struct(F.col("__out.__ts").alias("__ts"), none.alias("__b"), F.col("__out.__f").alias("__f")),
                )
            ),
        )
        .where(F.col("__ts").isNotNull())
    )
    known = rights.unionByName(carries)

    stream = (
        known.withColumn("__kind", F.lit(0))
        .unionByName(lefts.withColumn("__kind", F.lit(1)), allowMissingColumns=True)
    )
    up = Window.partitionBy(*keys, "__seg").orderBy("__ts", "__kind").rowsBetween(_ALL, 0)
    down = (
        Window.partitionBy(*keys, "__seg")
        .orderBy(F.col("__ts").desc(), F.col("__kind").desc())
        .rowsBetween(_ALL, 0)
    )
    found = (
        stream.withColumn("__bwd", F.last("__b", ignorenulls=True).over(up))
        .withColumn("__fwd", F.last(ahead, ignorenulls=True).over(down))
        .where(F.col("__kind") == 1)
        .select(*keys, F.col("__ts").alias(left_ts), "__bwd", "__fwd")
    )

    def whole(c: str) -> Column:
        parts = [F.col(k) if k in keys else F.col(f"{c}.`{k}`").alias(k) for k in usable.columns]
        return F.when(F.col(c).isNotNull(), F.struct(*parts))

    # One match row per (keys, time): a many-to-one join that adaptive execution can split.
    return left.join(found, [*keys, left_ts], "left").withColumns({c: whole(c) for c in ("__bwd", "__fwd")})


def _within_reach(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    tie_order: Sequence[str],
    segment_seconds: int,
    reach_seconds: float,
) -> DataFrame:
    """As ``asof_candidates``, but right rows farther than ``reach_seconds``, at most a segment, may be missing.

    Both sides are shuffled once. A left row travels whole, so nothing has to be joined back; a right row goes to the segments in
    its reach, so nothing has to be carried. Segments are ``_TOGETHER`` times as wide as asked for, as narrow ones would send nearly
    every right row three times; a busy key is still spread by time. Rows of equal time stand in ``tie_order`` inside the window
    and are not reduced before. Left rows without key or time are left out.
    """
    keys = list(keys)
    ties = [c for c in tie_order if c not in keys]
    # The payload is what a window hands on as it is: a struct made there would travel beside the columns it is made of.
    payload = F.struct(*dict.fromkeys([*ties, *[c for c in right.columns if c not in keys]]))
    rest = [c for c in left.columns if c not in keys and c != left_ts]
    micros, reach = F.unix_micros("__ts"), int(reach_seconds * 1_000_000)
    at = lambda t: F.floor(t / F.lit(_TOGETHER * segment_seconds * 1_000_000)).cast("bigint")
    rights = (
        right.dropna(subset=[*keys, right_ts])
        .select(*keys, F.col(right_ts).alias("__ts"), payload.alias("__right"))
        .withColumn("__seg", F.explode(F.sequence(at(micros - reach), at(micros + reach))))
        .withColumn("__kind", F.lit(0))
    )
    lefts = (
        left.dropna(subset=[*keys, left_ts])
        .select(*keys, F.col(left_ts).alias("__ts"), F.struct(*rest).alias("__left") if rest else F.lit(None).alias("__left"))
        .withColumn("__seg", at(micros))
        .withColumn("__kind", F.lit(1))
    )
    # At equal times right rows come first; a payload that has an order is its own rank, and the greatest comes last.
    ordered = "map<" not in right.schema.simpleString()
    order = ["__ts", "__kind", *(["__right"] if ordered else [f"__right.`{c}`" for c in ties])]
    among = Window.partitionBy(*keys, "__seg")
    up, down = (among.orderBy(*[F.asc(c) for c in order]), among.orderBy(*[F.desc(c) for c in order]))
    newest = lambda w: F.last("__right", ignorenulls=True).over(w.rowsBetween(_ALL, 0))
    found = (
        rights.unionByName(lefts, allowMissingColumns=True)
        .withColumn("__b", newest(up))
        .withColumn("__f", newest(down))
        .where(F.col("__kind") == 1)
    )

    def mine(c: str) -> Column:
        if c in keys:
            return F.col(c).cast(left.schema[c].dataType).alias(c)
        return (F.col(f"__left.`{c}`") if c in rest else F.col("__ts")).alias(c)

    def whole(side: str) -> Column:
        parts = [F.col(c) if c in keys else F.col(f"{side}.`{c}`").alias(c) for c in right.columns]
        return F.when(F.col(side).isNotNull(), F.struct(*parts))

    return found.select(*[mine(c) for c in left.columns], whole("__b").alias("__bwd"), whole("__f").alias("__fwd"))


def asof_nearest(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    tolerance_seconds: float,
    tie_order: Sequence[str],
    segment_seconds: int = 3600,
) -> DataFrame:
    """Left join to the right row nearest in time within a tolerance; equal distance goes back.

    Left rows with a NULL key or time are dropped. Adds the right columns that are not keys,
    ``matched`` and ``join_time_delta_sec`` (left minus right).
    """
    keys = list(keys)
    usable = left.dropna(subset=[*keys, left_ts])
    if tolerance_seconds <= segment_seconds:
        found = _within_reach(usable, right, keys, left_ts, right_ts, tie_order, segment_seconds, tolerance_seconds)
    else:
        found = asof_candidates(usable, right, keys, left_ts, right_ts, tie_order, segment_seconds)
    micros = F.unix_micros(left_ts)
    back = micros - F.unix_micros(f"__bwd.{right_ts}")
    ahead = F.unix_micros(f"__fwd.{right_ts}") - micros
    limit = F.lit(int(tolerance_seconds * 1_000_000))
    nearer = F.when(
        F.col("__bwd").isNotNull() & (F.col("__fwd").isNull() | (back <= ahead)), F.col("__bwd")
    ).otherwise(F.col("__fwd"))
    best = found.withColumn("__best", nearer)
    delta = micros - F.unix_micros(f"__best.{right_ts}")
    best = best.withColumn("__best", F.when(F.abs(delta) <= limit, F.col("__best")))
    extra = [c for c in right.columns if c not in keys]
    return best.select(
        *left.columns,
        *[F.col(f"__best.`{c}`").alias(c) for c in extra],
        F.col("__best").isNotNull().alias("matched"),
        (F.when(F.col("__best").isNotNull(), delta) / F.lit(1e6)).alias("join_time_delta_sec"),
    )




# Interval cover: base-32 blocks of microseconds; eleven levels span more than 1,000 years.
_BASE = 32
_LEVELS = 11


def _floor_div(c: Column, n: int) -> Column:
    return F.call_function("div", c - F.pmod(c, F.lit(n)), F.lit(n))


def _ceil_div(c: Column, n: int) -> Column:
    return _floor_div(c + F.lit(n - 1), n)


def _covering_blocks(start_us: Column, end_us: Column, levels: int) -> Column:
    """Blocks (level, number) that tile the closed range [start, end] exactly.

    A level contributes what the next coarser level cannot cover: at most 31 blocks on
    either side.
    """
    none = F.array().cast("array<struct<level:int,block:bigint>>")

    def run(first: Column, stop: Column, level: int) -> Column:
        blocks = F.transform(
            F.sequence(first, stop - 1), lambda b: F.struct(F.lit(level).alias("level"), b.alias("block"))
        )
        return F.when(first < stop, blocks).otherwise(none)

    pieces = []
    for level in range(levels):
        size = _BASE**level
        first, stop = _ceil_div(start_us, size), _floor_div(end_us + 1, size)
        if level + 1 == levels:
            pieces.append(run(first, stop, level))
            continue
        inner_first = _ceil_div(start_us, size * _BASE) * _BASE
        inner_stop = _floor_div(end_us + 1, size * _BASE) * _BASE
        sides = F.concat(run(first, inner_first, level), run(inner_stop, stop, level))
        pieces.append(F.when(inner_first < inner_stop, sides).otherwise(run(first, stop, level)))
    return F.concat(*pieces)


def _latest_open_start(points: DataFrame, spans: DataFrame, ts: str, segment_seconds: int) -> DataFrame:
    """(ts, __open): the span with the latest start among those that hold the point.

    Spans that no point falls into are dropped first: the next point after a span's start
    must not lie beyond its end. The others are tiled by blocks and each block keeps only its
    latest start; a point looks up the one block that holds it on every level. No point
    meets a span directly.
    """
    ahead = asof_candidates(spans, points, [], "__start", ts, [ts], segment_seconds)
    meets = F.coalesce(F.unix_micros(f"__bwd.{ts}") == F.col("__from_us"), F.lit(False)) | F.coalesce(
        F.unix_micros(f"__fwd.{ts}") <= F.col("__to_us"), F.lit(False)
    )
    used = ahead.where(meets).select("__span", "__start", "__from_us", "__to_us", "__listed")
    tiled = (
        used.withColumn("__tile", F.explode(_covering_blocks(F.col("__from_us"), F.col("__to_us"), _LEVELS)))
        .groupBy("__tile.block", "__tile.level")
        .agg(F.max(F.struct("__from_us", (-F.col("__listed")).alias("__rank"), "__span")).alias("__top"))
    )
    levels = F.array(
        *[
            F.struct(F.lit(n).alias("level"), _floor_div(F.unix_micros(ts), _BASE**n).alias("block"))
            for n in range(_LEVELS)
        ]
    )
    return (
        points.select(ts, F.inline(levels))
        .join(tiled, ["block", "level"])
        .groupBy(ts)
        .agg(F.max("__top").alias("__top"))
        .select(ts, F.col("__top.__span").alias("__open"))
    )


def interval_nearest(
    points: DataFrame,
    intervals: DataFrame,
    ts: str,
    start: str,
    end: str,
    listed: str,
    before_seconds: int = 120,
    after_seconds: int = 300,
    segment_seconds: int = 15,
) -> DataFrame:
    """Match every point to one interval.

    One job runs here, which pins every point's neighbours. Segments are short, so points of one hour are spread over a few
    hundred windows, and no window holds all rows.

    Candidates satisfy ``start - before <= ts <= end + after``; the one whose start is nearest
    wins, the first listed on ties (confidence 'high'). With no candidate the nearest start
    of all is taken ('low-nearest'). ``end`` must not lie before ``start``. Adds the interval
    columns and ``confidence``.
    """
    packed = intervals.select(
        F.col(start).alias("__start"),
        F.col(end).alias("__end"),
        F.col(listed).alias("__listed"),
        *[F.col(c) for c in intervals.columns],
    ).dropna(subset=["__start", "__end"])
    span = F.struct(*packed.columns)
    spans = packed.select(
        span.alias("__span"),
        "__start",
        "__listed",
        F.unix_micros("__start").alias("__from_us"),
        (F.unix_micros("__end") + F.lit(after_seconds * 1_000_000)).alias("__to_us"),
    )
    # Used twice below: pinned once instead of computed again within each use.
    around = cut_lineage(
        asof_candidates(points, packed, [], ts, "__start", ["__listed"], segment_seconds, same_ts="first")
    )
    us = F.unix_micros(ts)
    # Usually the newest start is still open; only the other points need the search.
    open_end = F.unix_micros("__bwd.__end") + F.lit(after_seconds * 1_000_000)
    is_open = F.coalesce(open_end >= us, F.lit(False))
    closed = around.where(F.col("__bwd").isNotNull() & ~is_open).select(ts).distinct()
    searched = _latest_open_start(closed, spans, ts, segment_seconds)
    found = around.join(searched, ts, "left").withColumn("__open", F.when(is_open, F.col("__bwd")).otherwise(F.col("__open")))

    def ranked(candidate: str, allowed: Column) -> Column:
        distance = F.abs(us - F.unix_micros(f"{candidate}.__start"))
        entry = F.struct(
            distance.alias("distance"), F.col(f"{candidate}.__listed").alias("listed"), F.col(candidate).alias("span")
        )
        return F.when(F.col(candidate).isNotNull() & allowed, entry)

    # A start after the point counts while it is at most `before` ahead; its end is later still.
    soon = F.unix_micros("__fwd.__start") - us <= F.lit(before_seconds * 1_000_000)
    overlap = F.least(ranked("__open", F.lit(True)), ranked("__fwd", soon))
    nearest = F.least(ranked("__bwd", F.lit(True)), ranked("__fwd", F.lit(True)))
    best = found.withColumn("__overlap", overlap).withColumn("__best", F.coalesce("__overlap", nearest))
    return best.select(
        *points.columns,
        *[F.col(f"__best.span.`{c}`").alias(c) for c in intervals.columns],
        F.when(F.col("__overlap").isNotNull(), F.lit("high"))
        .when(F.col("__best").isNotNull(), F.lit("low-nearest"))
        .alias("confidence"),
    )
