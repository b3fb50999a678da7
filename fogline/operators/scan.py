"""Ordered scans that do not depend on how large one key is.

A plain window puts a whole key into one task. Here every key is cut into ordered segments;
a segment starts with a small *carry row* computed from per-segment summaries, so the window
itself only ever spans one (key, segment). Summaries aggregate on the map side and hold one
row per (key, segment).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fogline.operators.keys import selective_first
from fogline.session import cut_lineage

_START = Window.unboundedPreceding


def time_segment(ts: Column, width_seconds: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(width_seconds * 1_000_000)).cast("bigint")


def scan_in_segments(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segment: Column,
    previous: tuple[str, str] | None = None,
    before: tuple[str, str] | None = None,
) -> DataFrame:
    """Ordered scan within ``keys``; NULL key values form one group.

    ``previous=(value, out)`` adds the previous row's value, ``before=(weight, out)`` the sum
    of the weights of all earlier rows. ``segment`` must not decrease along ``order``.
    """
    keys, order = selective_first(keys), list(order)
    rows = df.withColumn("__seg", segment)
    by_segment = Window.partitionBy(*keys).orderBy("__seg")
    summaries, carried = [], []
    if previous:
        rows = rows.withColumn("__v", F.col(previous[0]))
        summaries.append(F.max(F.struct(*order, "__v")).alias("__tail"))
        carried.append(F.lag("__tail.__v").over(by_segment).alias("__v"))
    if before:
        rows = rows.withColumn("__w", F.col(before[0]))
        summaries.append(F.sum("__w").alias("__total"))
        carried.append(F.sum("__total").over(by_segment.rowsBetween(_START, -1)).alias("__w"))
    carries = (
        rows.groupBy(*keys, "__seg")
        .agg(*summaries)
        .select(*keys, "__seg", F.lit(0).alias("__kind"), F.lag("__seg").over(by_segment).alias("__from"), *carried)
        .where(F.col("__from").isNotNull())
        .drop("__from")
    )
    out = rows.withColumn("__kind", F.lit(1)).unionByName(carries, allowMissingColumns=True)
    within = Window.partitionBy(*keys, "__seg").orderBy("__kind", *order)
    if previous:
        out = out.withColumn(previous[1], F.lag("__v").over(within))
    if before:
        total = F.sum("__w").over(within.rowsBetween(_START, -1))
        out = out.withColumn(before[1], F.coalesce(total, F.lit(0)))
    return out.where(F.col("__kind") == 1).drop("__seg", "__kind", "__v", "__w")


def range_segments(df: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Range-partition by ``order``, number the pieces in ``__seg`` and pin the result.

    Spark samples the order columns to place the borders, so pieces stay even whatever the
    distribution, as long as ``order`` is total. The checkpoint makes later passes agree on
    the borders even if tasks are rerun.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn("__seg", F.spark_partition_id())
    return cut_lineage(ranged)


def running_total(
    df: DataFrame, order: Sequence[str], weight: Column, out: str, parts: int | None = None
) -> DataFrame:
    """Inclusive running sum of ``weight`` over the whole table in ``order``.

    ``parts`` defaults to the session's shuffle partitions.
    """
    pieces = range_segments(df, order, parts).withColumn("__w", weight)
    totals = pieces.groupBy("__seg").agg(F.sum("__w").alias("__total"))
    # One row per range piece, so this single-task window stays as small as the partition count.
    before = totals.select(
        "__seg",
        F.coalesce(
            F.sum("__total").over(Window.orderBy("__seg").rowsBetween(_START, -1)), F.lit(0)
        ).alias("__before"),
    )
    within = Window.partitionBy("__seg").orderBy(*order).rowsBetween(_START, 0)
    return (
        pieces.join(F.broadcast(before), "__seg")
        .withColumn(out, F.sum("__w").over(within) + F.col("__before"))
        .drop("__seg", "__w", "__before")
    )


def ordinal(df: DataFrame, order: Sequence[str], out: str = "ordinal", parts: int | None = None) -> DataFrame:
    """1-based position of every row in the total order given by ``order``."""
    return running_total(df, order, F.lit(1).cast("bigint"), out, parts)


def sample_every_k(
    df: DataFrame, order: Sequence[str], every_k: int, first_n: int | None = None, parts: int | None = None
) -> DataFrame:
    """Every k-th row in order, beginning with the first; optionally only the first n of those."""
    if every_k < 1:
        raise ValueError("every_k must be at least 1")
    numbered = ordinal(df, order, "__pos", parts)
    chosen = numbered.where(F.pmod(F.col("__pos") - 1, F.lit(every_k)) == 0)
    if first_n is not None:
        chosen = chosen.where(F.col("__pos") <= first_n * every_k)
    return chosen.drop("__pos")
