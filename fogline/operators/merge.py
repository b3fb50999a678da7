"""Keyed changes to tables, as pure functions (target, staging) -> new target."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fogline.operators.checks import QualityError, require_monotonic
from fogline.operators.keys import selective_first


def surrogate_key(keys: Sequence[str]) -> Column:
    """Stable id of a key: every part is tagged, so NULL differs from ''."""
    parts = [
        F.coalesce(F.concat(F.lit("v"), F.length(F.col(k).cast("string")), F.lit(":"), F.col(k).cast("string")), F.lit("n"))
        for k in keys
    ]
    return F.sha2(F.concat_ws("|", *parts), 256)


def upsert_by_key(
    target: DataFrame, staging: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None
) -> DataFrame:
    """Update the ``update`` columns of matched rows and insert the others.

    A staged key that occurs twice stops the job: which row would win is not defined. NULL keys never match, so such rows
    are all inserted. By default every column the staging table has beyond the keys is updated; columns it lacks
    keep the old value, or NULL on insert. Joins from the target are many-to-one, which adaptive execution can split
    when one key is heavy.
    """
    keys = list(keys)
    changes = [c for c in (update or staging.columns) if c not in keys and c in target.columns]
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    rest = [c for c in staging.columns if c not in keys and c in target.columns]
    twice = F.raise_error(F.concat(F.lit(f"staged more than once on {keys}: "), F.to_json(F.struct(*keys))))
    once = (
        staging.where(whole)
        .groupBy(*keys)
        .agg(F.count("*").alias("__n"), F.first(F.struct(F.lit(True).alias("__hit"), *rest)).alias("__row"))
        # In the rows themselves, so that no projection can leave the check out.
        .withColumn("__row", F.when(F.col("__n") > 1, twice).otherwise(F.col("__row")))
    )
    source = once.select(
        *keys, F.col("__row.__hit").alias("__hit"), *[F.col(f"__row.`{c}`").alias(f"__new_{c}") for c in changes]
    )
    merged = target.join(source, keys, "left").select(
        *[
            F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
            for c in target.columns
        ]
    )
    types = dict(target.dtypes)
    # Keys already present, found from the target side: a small staging table is broadcast
    # in both joins and the target is never shuffled.
    present = target.select(*keys).join(once.select(*keys), keys, "left_semi").distinct()
    fresh = once.join(present, keys, "left_anti").select(*keys, *[F.col(f"__row.`{c}`").alias(c) for c in rest])
    inserted = fresh.unionByName(staging.where(~whole).select(*keys, *rest)).select(
        *[
            (F.col(c) if c in staging.columns else F.lit(None)).cast(types[c]).alias(c)
            for c in target.columns
        ]
    )
    return merged.unionByName(inserted)


def upsert_latest(target: DataFrame, staging: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Upsert that never lets an older observation replace a newer one; NULL keys are equal.

    A staged row wins when the target has no time, or when its own time is not older. That
    is the greatest (time, is staged) per key, so the merge is one grouped ``max`` that
    shrinks on the map side instead of a join.
    """
    keys = list(keys)
    columns = target.columns
    types = dict(target.dtypes)
    aligned = staging.select(
        *[(F.col(c) if c in staging.columns else F.lit(None)).cast(types[c]).alias(c) for c in columns]
    )
    both = target.withColumn("__staged", F.lit(0)).unionByName(aligned.withColumn("__staged", F.lit(1)))
    payload = [c for c in columns if c not in keys]
    newest = F.max(F.struct(F.col(ts), F.col("__staged"), *[c for c in payload if c != ts]))
    picked = both.groupBy(*selective_first(keys)).agg(newest.alias("__row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"__row.`{c}`").alias(c) for c in columns])


def close_missing(
    target: DataFrame,
    active_ids: DataFrame,
    snapshot: dt.date,
    previous: dt.date,
    id_col: str = "rentcast_id",
    removed: str = "removed_date",
) -> DataFrame:
    """Close open rows whose id left the snapshot, at the previous snapshot date (00:00 UTC).

    A same-day retry changes nothing; an earlier snapshot is refused. Rows without an id
    match nothing and are closed as well.
    """
    if not require_monotonic(snapshot, previous):
        return target
    present = active_ids.select(id_col).dropna().distinct().withColumn("__present", F.lit(True))
    closed_at = F.to_timestamp(F.lit(previous.isoformat()))
    # Closed rows, usually the large majority, stay out of the join.
    checked = (
        target.where(F.col(removed).isNull())
        .join(present, id_col, "left")
        .withColumn(removed, F.when(F.col("__present").isNull(), closed_at).otherwise(F.col(removed)))
    )
    return target.where(F.col(removed).isNotNull()).unionByName(checked.select(*target.columns))


def replace_days(target: DataFrame, incoming: DataFrame, day: Column, days: Sequence[dt.date]) -> DataFrame:
    """Delete the given local days from the target and append the re-delivered rows.

    ``day`` is evaluated on both sides; a day without incoming rows ends up empty. Rows whose
    day is NULL stay.
    """
    wanted = day.isin(*[F.lit(d.isoformat()).cast("date") for d in days])
    kept = target.where(~F.coalesce(wanted, F.lit(False)))
    return kept.unionByName(incoming.select(*target.columns))


def update_foreign_keys(
    target: DataFrame, assigned: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Overwrite ``columns`` where an assignment row exists, even by NULL; never insert."""
    source = assigned.select(
        *keys, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in columns]
    )
    return target.join(source, list(keys), "left").select(
        *[
            F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )


def update_state(
    state: DataFrame,
    pipeline: str,
    snapshot: dt.date,
    expected: Column,
    loaded: Column,
    updated_at: Column,
) -> DataFrame:
    """New contents of the state table; refuses unless exactly one row carries the name."""
    hits = state.where(F.col("pipeline_name") == pipeline).limit(2).count()
    if hits != 1:
        raise QualityError(f"expected exactly one state row for {pipeline!r}, found {hits}")
    mine = F.col("pipeline_name") == pipeline
    values = {
        "last_successful_snapshot_date": F.lit(snapshot.isoformat()).cast("date"),
        "expected_active_count": expected,
        "loaded_active_count": loaded,
        "updated_at": updated_at,
    }
    return state.withColumns({c: F.when(mine, v).otherwise(F.col(c)) for c, v in values.items()})


def empty_like(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], df.schema)
