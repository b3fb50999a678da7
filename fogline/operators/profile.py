"""Profiling: NULL rates, value counts, quantiles, histograms, dependencies, catalogue."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: rows, NULLs and NULL rate, in a single pass."""
    names = list(columns or df.columns)
    counts = df.agg(
        F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(names)]
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("null_count")) for i, c in enumerate(names)]
    )
    return counts.select("n_rows", F.inline(pairs)).select(
        "column_name",
        "n_rows",
        "null_count",
        F.try_divide(F.col("null_count"), F.col("n_rows")).alias("null_rate"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values per column through one grouped pass."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.inline(pairs))
        .groupBy("column_name", "value")
        .count()
        .groupBy("column_name")
        .agg(F.count("value").alias("n_distinct"))
    )


def value_counts(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n most frequent values, NULL included; ties go to the smaller value."""
    return (
        df.groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_rows"))
        .orderBy(F.desc("n_rows"), F.asc_nulls_last("value"))
        .limit(n)
    )


#: Borders that values are counted between in one pass, distinct values of the buckets in question that are listed in the end.
BORDERS, LISTED = 64, 100_000


def _place(v: Column, borders: Sequence[float], first: int = 0) -> Column:
    """2 k for the k-th border itself, 2 k + 1 between it and the next one, by halving."""
    if len(borders) == 1:
        return F.when(v == F.lit(float(borders[0])), 2 * first).otherwise(2 * first + 1)
    half = len(borders) // 2
    upper = _place(v, borders[half:], first + half)
    return F.when(v < F.lit(float(borders[half])), _place(v, borders[:half], first)).otherwise(upper)


def exact_ranks(values: DataFrame, column: str, ranks: Sequence[int]) -> dict[int, float]:
    """The values at these 0-based ranks of a column of doubles without NULLs, by counting in narrowing buckets.

    A pass gets borders from mergeable quantile summaries of the buckets that hold a wanted rank and counts the values between
    them; only the buckets that hold one go on. The counts are exact, so the result does not depend on the
    summaries. Each pass divides what is left by about ``BORDERS``; when the values of the last buckets are few, they are listed with their counts.
    Nothing is sorted or shuffled but counts.
    """
    found: dict[int, float] = {}
    wanted = sorted(set(ranks))
    # Buckets [low, high] in question with the number of smaller values; NaN is above all numbers.
    open_: list[tuple[float, float, int]] = [(float("-inf"), float("nan"), 0)]
    v = F.col(column)
    inside = lambda low, high: (v >= F.lit(low)) & (v <= F.lit(high))
    while wanted:
        parts = reduce(lambda a, b: a | b, [inside(low, high) for low, high, _ in open_])
        bucket = reduce(lambda c, i: c.when(inside(*open_[i][:2]), i), range(1, len(open_)), F.when(inside(*open_[0][:2]), 0))
        held = values.where(parts).select(v.alias(column), bucket.alias("b"))
        steps = [i / BORDERS for i in range(BORDERS + 1)]
        summary = held.groupBy("b").agg(
            F.percentile_approx(column, steps, 10 * BORDERS).alias("q"),
            F.min(column).alias("lo"),
            F.max(column).alias("hi"),
            F.approx_count_distinct(column).alias("d"),
        )
        by = {r["b"]: r for r in summary.collect()}
        if sum(r["d"] for r in by.values()) <= LISTED:
            counts: dict[int, list[tuple[float, int]]] = {}
            for r in held.groupBy("b", column).agg(F.count("*").alias("n")).collect():
                counts.setdefault(r["b"], []).append((r[column], r["n"]))
            for b, listed in counts.items():
                at = open_[b][2]
                for value, n in sorted(listed, key=lambda p: (math.isnan(p[0]), p[0])):
                    found.update({r: value for r in wanted if at <= r < at + n})
                    at += n
            break
        narrower = []
        for b, row in sorted(by.items()):
            low, high, before = open_[b]
            borders = sorted({row["lo"], *row["q"], row["hi"]}, key=lambda x: (math.isnan(x), x))
            at = before
            counted = held.where(F.col("b") == b).groupBy(_place(v, borders).alias("place")).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
            for r in counted.orderBy("place").collect():
                mine = [k for k in wanted if at <= k < at + r["n"]]
                if mine and r["place"] % 2 == 0:
                    found.update({k: borders[r["place"] // 2] for k in mine})
                elif mine:
                    narrower.append((r["lo"], r["hi"], at))
                at += r["n"]
        wanted = [k for k in wanted if k not in found]
        open_ = narrower
    return found


def describe(df: DataFrame, column: str, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """count, mean, std, min, exact linearly interpolated quantiles, max.

    The quantiles come from ``exact_ranks``: passes over the column that count between borders. No row is sorted, and neither a task nor
    the driver holds more than a bounded number of values. The passes run when the frame is made.
    """
    spark = df.sparkSession
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    whole = values.agg(F.count("*").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    n = whole["n"]
    at = {q: q * (n - 1) for q in quantiles}
    ranks = sorted({r for x in at.values() for r in (math.floor(x), math.ceil(x))}) if n else []
    known = exact_ranks(values, "v", ranks)

    def interpolated(q: float) -> float | None:
        if not n:
            return None
        low, high = known[math.floor(at[q])], known[math.ceil(at[q])]
        return low + (high - low) * (at[q] - math.floor(at[q]))

    names = [f"p{round(q * 100):02d}" for q in quantiles]
    schema = "count bigint, mean double, std double, min double, " + "".join(f"{c} double, " for c in names) + "max double"
    return spark.createDataFrame([(n, whole["mean"], whole["std"], whole["lo"], *map(interpolated, quantiles), whole["hi"])], schema)


def binned_histogram(df: DataFrame, column: Column, bins: int) -> DataFrame:
    """Equal-width bins over min..max; the maximum belongs to the last bin; empty bins are kept."""
    values = df.select(column.cast("double").alias("v")).where(F.col("v").isNotNull())
    ends = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    width = (hi - lo) / F.lit(bins)
    position = F.floor(F.try_divide(F.col("v") - lo, width)).cast("int")
    counts = (
        values.select(F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n_rows"))
    )
    spine = ends.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi"
    )
    step = (F.col("hi") - F.col("lo")) / F.lit(bins)
    return spine.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * step).alias("bin_start"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
    )


def fd_violations(df: DataFrame, keys: Sequence[str], value: str, out: str = "n_values", drop_null_keys: bool = True) -> DataFrame:
    """Keys that map to more than one distinct value."""
    rows = df.dropna(subset=list(keys)) if drop_null_keys else df
    return (
        rows.groupBy(*keys, value)
        .count()
        .groupBy(*keys)
        .agg(F.count(value).alias(out))
        .where(F.col(out) > 1)
    )


def catalog_profile(tables: Mapping[str, DataFrame], descriptions: Mapping[str, str] | None = None) -> DataFrame:
    """Columns, types, nullability, comments and row counts of named tables."""
    described = descriptions or {}
    parts = []
    for table, df in sorted(tables.items()):
        columns = F.array(
            *[
                F.struct(
                    F.lit(i + 1).alias("ordinal_position"),
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("data_type"),
                    F.lit(f.nullable).alias("is_nullable"),
                    F.lit(f.metadata.get("comment")).cast("string").alias("description"),
                )
                for i, f in enumerate(df.schema.fields)
            ]
        )
        parts.append(
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(table).alias("table_name"),
                F.lit(described.get(table)).cast("string").alias("table_description"),
                "row_count",
                F.inline(columns),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def capped(df: DataFrame, cap: int) -> DataFrame:
    """The outer row cap of an ad-hoc question."""
    return df.limit(cap)
