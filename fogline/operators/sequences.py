"""Order-dependent diagnostics on transit observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fogline.functions.temporal import seconds_between
from fogline.operators.keys import CANONICAL_KEY, selective_first
from fogline.operators.latest import first_per_key
from fogline.operators.scan import scan_in_segments, time_segment

STOP_SEGMENT = 256


def arrival_crossings(
    observations: DataFrame, keys: Sequence[str] = CANONICAL_KEY, segment_seconds: int = 3600
) -> DataFrame:
    """Every snapshot at which a predicted arrival moved from the future to now or the past."""
    keys = list(keys)
    columns = [*keys, "route_id", "stop_id", "snapshot_ts", "arrival_time_predicted"]
    # Copies of an observation cannot produce a crossing, so they go before the ordered scan.
    seen = (
        observations.dropna(subset=["trip_id", "stop_sequence", "snapshot_ts", "arrival_time_predicted"])
        .select(*dict.fromkeys(columns))
        .distinct()
        .withColumn("horizon_sec", seconds_between(F.col("arrival_time_predicted"), F.col("snapshot_ts")))
    )
    scanned = scan_in_segments(
        seen,
        keys,
        ["snapshot_ts", "arrival_time_predicted", "route_id", "stop_id"],
        time_segment(F.col("snapshot_ts"), segment_seconds),
        previous=("horizon_sec", "prev_horizon_sec"),
    )
    return scanned.where((F.col("prev_horizon_sec") > 0) & (F.col("horizon_sec") <= 0))


def inferred_arrivals(
    observations: DataFrame, keys: Sequence[str] = CANONICAL_KEY, segment_seconds: int = 3600
) -> DataFrame:
    """First crossing per key."""
    crossings = arrival_crossings(observations, keys, segment_seconds)
    return (
        first_per_key(crossings, keys, ["snapshot_ts", "arrival_time_predicted"])
        .withColumnRenamed("snapshot_ts", "inferred_arrival_snapshot_ts")
        .withColumnRenamed("arrival_time_predicted", "inferred_arrival_time_predicted")
    )


def sequence_gaps(df: DataFrame, keys: Sequence[str], seq: str = "stop_sequence") -> DataFrame:
    """How completely the observed numbers of a key fill their own min..max range."""
    keys = list(keys)
    seen = df.dropna(subset=[keys[0], seq]).select(*keys, F.col(seq).cast("bigint").alias("__s")).distinct()
    stepped = scan_in_segments(
        seen, keys, ["__s"], F.floor(F.col("__s") / F.lit(STOP_SEGMENT)), previous=("__s", "__prev")
    )
    expected = F.col("max_seq") - F.col("min_seq") + 1
    return (
        stepped.groupBy(*keys)
        .agg(
            F.count("*").alias("n_distinct"),
            F.min("__s").alias("min_seq"),
            F.max("__s").alias("max_seq"),
            F.coalesce(F.max(F.col("__s") - F.col("__prev") - 1), F.lit(0)).alias("max_gap"),
        )
        .withColumn("expected_contiguous", expected)
        .withColumn("n_missing", F.col("expected_contiguous") - F.col("n_distinct"))
        .withColumn("fill_ratio", F.col("n_distinct") / F.col("expected_contiguous"))
        .withColumn("has_gap", F.col("n_missing") > 0)
    )


def gap_summary(gaps: DataFrame) -> DataFrame:
    """One row over the keys with at least two observed numbers."""
    usable = F.col("n_distinct") >= 2
    return gaps.agg(
        F.count("*").alias("n_trips"),
        F.count_if(usable).alias("n_analyzable"),
        F.avg(F.when(usable, F.col("has_gap").cast("int"))).alias("ratio_with_gaps"),
        F.avg(F.when(usable, (F.col("max_gap") <= 2).cast("int"))).alias("small_gap_share"),
        F.sum(F.when(usable, F.col("n_missing"))).alias("n_missing"),
    )


def stop_patterns(df: DataFrame, group: Sequence[str] = ("route_id", "direction_id"), trip: str = "trip_id") -> DataFrame:
    """Number of different ordered stop lists among the trips of a group.

    Repeated observations count in the list, as they do in the source analysis. A list is
    not collected: it is written as runs (start position, stop) and two sums of hashes over
    its runs identify it, so a trip of any length stays distributed.
    """
    group, keys = list(group), [*group, trip]
    counted = df.groupBy(*selective_first([*keys, "stop_sequence"]), "stop_id").agg(F.count("*").alias("__n"))
    chained = scan_in_segments(
        counted.withColumn("__stop", F.struct("stop_id")),
        keys,
        ["stop_sequence", "stop_id"],
        F.floor(F.coalesce(F.col("stop_sequence"), F.lit(0)) / F.lit(STOP_SEGMENT)),
        previous=("__stop", "__before"),
        before=("__n", "__start"),
    )
    opens = F.col("__before").isNull() | ~F.col("__before").eqNullSafe(F.col("__stop"))

    def fingerprint(seed: int):
        code = F.xxhash64(F.lit(seed), "__start", "stop_id").cast("decimal(38,0)")
        return F.sum(F.when(opens, code).otherwise(F.lit(0).cast("decimal(38,0)")))

    trips = chained.groupBy(*selective_first(keys)).agg(
        F.sum("__n").alias("__length"), fingerprint(1).alias("__a"), fingerprint(2).alias("__b")
    )
    return (
        trips.groupBy(*group, "__length", "__a", "__b")
        .count()
        .groupBy(*group)
        .agg(F.count("*").alias("n_distinct_patterns"), F.sum("count").alias("n_trips"))
    )


def stop_dimension_candidate(df: DataFrame) -> DataFrame:
    return df.select("route_id", "direction_id", "stop_sequence", "stop_id").distinct()


def route_consistency(df: DataFrame, by: Sequence[str] = ("route_id",)) -> DataFrame:
    """Do the trips of a route agree on their last stop number?"""
    last = df.groupBy("route_id", "direction_id", "trip_id").agg(F.max("stop_sequence").alias("last_stop"))
    # Counts per distinct value first, so a busy route is a handful of rows at the end.
    return (
        last.groupBy(*by, "last_stop")
        .agg(F.count("*").alias("__n"))
        .groupBy(*by)
        .agg(
            F.sum("__n").alias("n_trips"),
            F.min("last_stop").alias("min_last_stop"),
            F.max("last_stop").alias("max_last_stop"),
            F.count("last_stop").alias("n_distinct_last_stop"),
        )
    )
