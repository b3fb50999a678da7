"""One row per key: newest, last or first.

All of these are a ``max``/``min`` over a struct that starts with the sort columns. Each map
task keeps one candidate per key before the shuffle, so a key that holds a large share of the rows costs one row
per task, not one giant group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fogline.operators.checks import require_columns
from fogline.operators.keys import CANONICAL_KEY, selective_first
# What the day table keeps of a prediction beside its key.
TRIP_UPDATE_COLUMNS = (
    "route_id",
    "stop_id",
    "snapshot_ts",
    "arrival_time_predicted",
    "departure_time_predicted",
    "arrival_delay_sec",
    "departure_delay_sec",
)


def until_last(closing: Sequence[str], wanted: Sequence[str]) -> list[str]:
    """The columns that close an order, up to the last wanted one: those behind it cannot change what is read of a winner."""
    return list(closing[: max((i + 1 for i, c in enumerate(closing) if c in wanted), default=0)])


def _pick(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], newest: bool, columns: Sequence[str] | None = None
) -> DataFrame:
    keys = list(keys)
    if columns is not None:
        if all(isinstance(o, str) for o in order) and "map<" not in df.schema.simpleString():
            ranked = until_last([*order, *[c for c in df.columns if c not in keys and c not in order]], columns)
            df, order = df.select(*keys, *ranked), [o for o in order if o in ranked]
        return _pick(df, keys, order, newest).select(*keys, *[c for c in columns if c not in keys])
    payload = [c for c in df.columns if c not in keys]
    plain = [o for o in order if isinstance(o, str)]
    if not payload:
        return df.select(*keys).distinct()
    ranked = [F.col(o) if isinstance(o, str) else o.alias(f"__order{i}") for i, o in enumerate(order)]
    # Remaining columns close the order, so equal sort keys still give one defined winner.
    closing = [f.name for f in df.schema if f.name in payload and "map<" not in f.dataType.simpleString()]
    rank = F.struct(*ranked, *[c for c in closing if c not in plain])
    if newest and plain == payload == list(order) and len(plain) == 1:
        # One value of fixed width is kept in a hash table; structs would be sorted.
        return df.groupBy(*selective_first(keys)).agg(F.max(payload[0]).alias(payload[0])).select(*df.columns)
    if len(closing) == len(payload):
        winner = (F.max if newest else F.min)(rank)
    else:  # maps have no order, so they travel beside the rank
        winner = (F.max_by if newest else F.min_by)(F.struct(*payload), rank)
    picked = df.groupBy(*selective_first(keys)).agg(winner.alias("__row"))
    return picked.select(*[_restore(c, keys) for c in df.columns])


def _restore(name: str, keys: Sequence[str]) -> Column:
    return F.col(name) if name in keys else F.col(f"__row.`{name}`").alias(name)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], columns: Sequence[str] | None = None
) -> DataFrame:
    """Row with the greatest ``order`` per key. NULL keys are equal; a NULL sort value loses.

    ``columns``: what is read of the row beside its key, all by default. The same row wins, but only what decides up to the
    last of them is shuffled.
    """
    return _pick(df, keys, order, newest=True, columns=columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    return _pick(df, keys, order, newest=False)


def keep_last(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """Drop duplicates keeping the row that came last in the source."""
    return latest_per_key(df, keys, [ordinal])


def latest_trip_updates(observations: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Newest prediction per canonical key, with the output columns of the day table or only these ``columns`` of them."""
    order = ["snapshot_ts", "blob_order", "blob_name"]
    require_columns(observations, [*CANONICAL_KEY, *order], "TripUpdates observations")
    needed = observations.select(*CANONICAL_KEY, *dict.fromkeys([*order, *TRIP_UPDATE_COLUMNS]))
    if columns is not None:
        columns = ["snapshot_ts" if c == "latest_snapshot_ts" else c for c in columns]
    newest = latest_per_key(needed, CANONICAL_KEY, order, columns)
    return newest.drop("blob_order", "blob_name").withColumnRenamed("snapshot_ts", "latest_snapshot_ts")


def latest_vehicle_positions(observations: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Newest position per canonical key; rows without trip, stop sequence or time are left out.

    ``columns`` as in ``latest_per_key``.
    """
    order = ["vp_snapshot_ts", "blob_order", "blob_name"]
    require_columns(observations, [*CANONICAL_KEY, *order], "VehiclePositions observations")
    known = observations.dropna(subset=["trip_id", "stop_sequence", "vp_snapshot_ts"])
    return latest_per_key(known, CANONICAL_KEY, order, columns)
