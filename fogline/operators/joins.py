"""Trip updates with vehicle positions, and join diagnostics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fogline.functions.temporal import seconds_between
from fogline.operators.checks import require_columns
from fogline.operators.keys import CANONICAL_KEY, selective_first

# What a vehicle position adds to a trip update.
VEHICLE_COLUMNS = (
    "vp_snapshot_ts",
    "position_timestamp",
    "vp_stop_id",
    "current_status",
    "vehicle_id",
    "vehicle_label",
    "latitude",
    "longitude",
    "bearing",
    "speed",
)


def normalise_key_types(df: DataFrame) -> DataFrame:
    """Common types on both sides, so a key column inferred differently still matches."""
    typed = {c: F.col(c).cast("string") for c in ("agency_id", "trip_id", "trip_start_time")}
    for c in ("direction_id", "stop_sequence"):
        # Text and float inputs ('7', 7.0) are read as numbers first; anything else is NULL.
        typed[c] = F.col(c).cast("string").try_cast("double").cast("bigint")
    typed["trip_start_date"] = F.date_format(F.col("trip_start_date").cast("string").try_cast("date"), "yyyy-MM-dd")
    return df.withColumns(typed)


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in selective_first(keys)])


def join_vehicle_positions(trip_updates: DataFrame, positions: DataFrame) -> DataFrame:
    """Left join on the canonical key, NULLs equal, plus the time between the two snapshots.

    Both inputs hold each key once (``require_unique``), so the row count of the left side
    is kept and no key can be heavy.
    """
    require_columns(trip_updates, CANONICAL_KEY, "TripUpdates input")
    require_columns(positions, CANONICAL_KEY, "VehiclePositions input")
    extra = [c for c in VEHICLE_COLUMNS if c in positions.columns]
    left = normalise_key_types(trip_updates)
    right = normalise_key_types(positions).select(*CANONICAL_KEY, *extra)
    joined = left.join(right, null_safe(left, right, CANONICAL_KEY), "left").select(
        *[left[c] for c in left.columns], *[right[c] for c in extra]
    )
    if "latest_snapshot_ts" in left.columns and "vp_snapshot_ts" in extra:
        joined = joined.withColumn(
            "tu_vp_snapshot_delta_sec", seconds_between(F.col("latest_snapshot_ts"), F.col("vp_snapshot_ts"))
        )
    return joined


def join_stats(trip_updates: DataFrame, positions: DataFrame, joined: DataFrame, match: str = "vehicle_id") -> DataFrame:
    """One row: input and output counts, match rate, and whether the left count was kept."""
    counts = joined.agg(
        F.count("*").alias("joined_rows"),
        F.count(match).alias("matched_rows"),
    )
    return counts.select(
        trip_updates.agg(F.count("*").alias("n")).scalar().alias("tripupdates_rows"),
        positions.agg(F.count("*").alias("n")).scalar().alias("vehiclepositions_rows"),
        "joined_rows",
        "matched_rows",
        F.try_divide(F.col("matched_rows"), F.col("joined_rows")).alias("vehicle_match_rate"),
    ).withColumn("left_rows_kept", F.col("joined_rows") == F.col("tripupdates_rows"))


def outcome_counts(
    left: DataFrame, right: DataFrame, keys: Sequence[str], by: Sequence[str] = (), side: str = "left"
) -> DataFrame:
    """Row counts of a full outer join by outcome, without building the join.

    Rows of both sides are counted per key in one grouped pass, NULL keys being equal. The
    rows a key would give are the product of its two counts, so a key repeated on both sides
    never expands into pairs. ``by`` splits the counts by columns of ``side``, e.g. an hour.
    """
    keys, by = selective_first(keys), list(by)
    main, other = (left, right) if side == "left" else (right, left)
    other_name = "right" if side == "left" else "left"
    tagged = main.select(*keys, *by, F.lit(1).alias("__m"), F.lit(0).alias("__o")).unionByName(
        other.select(*keys, F.lit(0).alias("__m"), F.lit(1).alias("__o")), allowMissingColumns=True
    )
    counted = tagged.groupBy(*keys, *by).agg(F.sum("__m").alias("__m"), F.sum("__o").alias("__o"))
    all_main, all_other = F.col("__m"), F.col("__o")
    if by:
        whole_key = Window.partitionBy(*keys)
        counted = counted.withColumns(
            {"__all_m": F.sum("__m").over(whole_key), "__all_o": F.sum("__o").over(whole_key)}
        )
        all_main, all_other = F.col("__all_m"), F.col("__all_o")
    has_main = F.col("__m") > 0
    outcome = (
        F.when(has_main & (all_other > 0), F.lit("both"))
        .when(has_main, F.lit(f"{side}_only"))
        .otherwise(F.lit(f"{other_name}_only"))
    )
    n_rows = F.when(has_main, F.col("__m") * F.greatest(all_other, F.lit(1))).otherwise(F.col("__o"))
    return (
        counted.where(has_main | (all_main == 0))
        .groupBy(*by, outcome.alias("outcome"))
        .agg(F.sum(n_rows).alias("n_rows"))
    )


def outer_join_rows(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join, NULL keys being equal, with ``outcome`` per row: both, left_only or right_only.

    Keys come once; a column of both sides is prefixed by its side. ``outcome_counts`` gives the totals without the rows.
    """
    both = [c for c in left.columns if c in right.columns and c not in keys]
    name = lambda side, c: f"{side}_{c}" if c in both else c
    l_rows = left.select(*[F.col(k).alias(f"__l_{k}") for k in keys], *[F.col(c).alias(name("left", c)) for c in left.columns if c not in keys], F.lit(True).alias("__l"))
    r_rows = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[F.col(c).alias(name("right", c)) for c in right.columns if c not in keys], F.lit(True).alias("__r"))
    same = reduce(lambda a, b: a & b, [F.col(f"__l_{k}").eqNullSafe(F.col(f"__r_{k}")) for k in selective_first(keys)])
    outcome = F.when(F.col("__r").isNull(), "left_only").when(F.col("__l").isNull(), "right_only").otherwise("both")
    rows = l_rows.join(r_rows, same, "full_outer")
    return rows.select(
        *[F.when(F.col("__l").isNull(), F.col(f"__r_{k}")).otherwise(F.col(f"__l_{k}")).alias(k) for k in keys],
        *[c for c in rows.columns if not c.startswith("__")],
        outcome.alias("outcome"),
    )


def unmatched_profile(rows: DataFrame, columns: Sequence[str], by: str = "outcome", top: int = 10) -> DataFrame:
    """Per outcome and column: rows, NULLs and their share, least and greatest value as text, and the most frequent values.

    ``top_values``: up to ``top`` structs (value, n_rows), most frequent first, NULL among them; ties go to the smaller value,
    NULL last. Rows are melted to (outcome, column, value) and counted once, on the map side first; every task cuts its part of a group to
    ``top`` candidates before the groups meet, so a column with very many values costs one row per value and no sort of them all.
    """
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") if dict(rows.dtypes)[c].startswith("timestamp") else F.col(c).cast("string")
    melted = rows.select(
        F.col(by).alias("__by"), F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), text(c).alias("value")) for c in columns]))
    )
    counted = melted.groupBy("__by", "column_name", "value").agg(F.count("*").alias("n"))
    group = ["__by", "column_name"]
    whole = counted.groupBy(*group).agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.min("value").alias("least"),
        F.max("value").alias("greatest"),
    )
    place = Window.partitionBy(*group).orderBy(F.desc("n"), F.asc_nulls_last("value"))
    first = (
        counted.withColumn("__place", F.row_number().over(place))
        .where(F.col("__place") <= top)
        .groupBy(F.col("__by").alias("__of"), F.col("column_name").alias("__column"))
        .agg(F.sort_array(F.collect_list(F.struct("__place", "value", "n"))).alias("__top"))
    )
    same = F.col("__by").eqNullSafe(F.col("__of")) & (F.col("column_name") == F.col("__column"))
    values = F.transform("__top", lambda t: F.struct(t["value"].alias("value"), t["n"].alias("n_rows")))
    return whole.join(first, same).select(
        F.col("__by").alias(by),
        "n_rows",
        "column_name",
        "n_null",
        "least",
        "greatest",
        F.try_divide(F.col("n_null"), F.col("n_rows")).alias("null_rate"),
        values.alias("top_values"),
    )


def outcome_rates(counts: DataFrame) -> DataFrame:
    """Add the share of every outcome in all rows."""
    total = counts.agg(F.sum("n_rows").alias("t"))
    return counts.withColumn("rate", F.try_divide(F.col("n_rows"), total.scalar()))


def hourly_outcomes(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, side: str = "left") -> DataFrame:
    """Hour of ``ts`` x outcome with zeros filled in; rows without that time are left out."""
    timed = (left if side == "left" else right).select(*keys, F.date_trunc("hour", F.col(ts)).alias("hour"))
    pair = (timed, right) if side == "left" else (left, timed)
    counts = outcome_counts(*pair, keys, by=["hour"], side=side).where(F.col("hour").isNotNull())
    only = f"{side}_only"
    # The other side's unmatched rows have no time on this side, so two outcomes remain.
    return counts.groupBy("hour").pivot("outcome", ["both", only]).agg(F.sum("n_rows")).na.fill(0, ["both", only])


def key_coverage(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: distinct keys on each side and on one side only."""
    keys = selective_first(keys)
    sides = left.select(*keys, F.lit(True).alias("__l"), F.lit(False).alias("__r")).unionByName(
        right.select(*keys, F.lit(False).alias("__l"), F.lit(True).alias("__r"))
    )
    seen = sides.groupBy(*keys).agg(F.max("__l").alias("__l"), F.max("__r").alias("__r"))
    return seen.agg(
        F.count_if("__l").alias("left_keys"),
        F.count_if("__r").alias("right_keys"),
        F.count_if(~F.col("__r")).alias("left_only_keys"),
        F.count_if(~F.col("__l")).alias("right_only_keys"),
    )


def key_match_rate(keys_df: DataFrame, positions: DataFrame, keys: Sequence[str], match: str, probe: str) -> DataFrame:
    """Share of (key x matching position) rows with a vehicle, and of the rest on stop 1.

    Works on counts per key, so repeated positions weigh as in the expanded join.
    """
    keys = selective_first(keys)
    rows = keys_df.select(*keys, F.lit(True).alias("__asked"), F.lit(0).alias("__n"), F.lit(0).alias("__with"))
    found = positions.select(
        *keys,
        F.lit(False).alias("__asked"),
        F.lit(1).alias("__n"),
        F.col(match).isNotNull().cast("int").alias("__with"),
    )
    counted = (
        rows.unionByName(found)
        .groupBy(*keys)
        .agg(F.max("__asked").alias("__asked"), F.sum("__n").alias("__n"), F.sum("__with").alias("__with"))
        .where("__asked")
    )
    # A key without any position still gives one row.
    joined = counted.select(F.col(probe).alias("__probe"), F.greatest("__n", F.lit(1)).alias("__n"), "__with")
    missing = F.col("__n") - F.col("__with")
    return joined.agg(
        F.sum("__n").alias("joined_rows"),
        F.sum("__with").alias("matched_rows"),
        F.sum(missing).alias("unmatched_rows"),
        F.sum(F.when(F.col("__probe") == 1, missing).otherwise(F.lit(0))).alias("unmatched_first_stop"),
    ).select(
        "joined_rows",
        "matched_rows",
        F.try_divide(F.col("matched_rows"), F.col("joined_rows")).alias("match_rate"),
        F.try_divide(F.col("unmatched_first_stop"), F.col("unmatched_rows")).alias("unmatched_first_stop_share"),
    )
