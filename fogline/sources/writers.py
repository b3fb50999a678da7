"""Writers: derived partitions, day files, marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from enum import Enum

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class Stage(Enum):
    """Derived stages of a transit day; the values are fixed folder names."""

    TRIP_UPDATES = "latest/TripUpdates"
    VEHICLE_POSITIONS = "latest/VehiclePositions"
    JOINED = "latest/joined"


class Agency(Enum):
    """Agencies with transit feeds; the values are fixed folder names."""

    MUNI = "muni"
    BART = "bart"


def day_folder(base: str, stage: Stage, agency: Agency, day: dt.date) -> str:
    """Where one agency's day of a stage lives. Built from known parts, so it cannot name anything else."""
    return "/".join((base.rstrip("/"), Stage(stage).value, Agency(agency).value, day.strftime("%Y-%m-%d")))


def replace_day(
    df: DataFrame, base: str, stage: Stage, agency: Agency, day: dt.date, shards: int = 16, sort: Sequence[str] = ()
) -> str:
    """Replace a day's folder by ``df``, each file sorted by ``sort``; other days and stages are not touched."""
    path = day_folder(base, stage, agency, day)
    dealt = df.repartition(shards, *sort) if sort else df.repartition(shards)
    (dealt.sortWithinPartitions(*sort) if sort else dealt).write.mode("overwrite").parquet(path)
    return path


def write_shards(df: DataFrame, path: str, shards: int | None = None, chunk_rows: int | None = None) -> None:
    """Parquet as a fixed number of files, or as files of at most ``chunk_rows`` rows."""
    writer = (df.repartition(shards) if shards else df).write.mode("overwrite")
    if chunk_rows:
        writer = writer.option("maxRecordsPerFile", chunk_rows)
    writer.parquet(path)


def write_ndjson_days(df: DataFrame, path: str, partition: str = "incident_date") -> None:
    """Newline JSON per day; re-written days replace their old files, other days stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).json(path)


def interleaved(df: DataFrame, columns: Sequence[str], out: str, bits: int = 16) -> DataFrame:
    """Add ``out``: the bits of the columns' ranks in turn, so rows near in any one column come near in its order.

    Ranks are places among a column's distinct values, spread over all bits; NULL comes first. The values of a column are listed once, so this
    is for columns with few of them, as ids of boundaries.
    """
    z = F.lit(0).cast("long")
    ranked = df
    for i, column in enumerate(columns):
        values = df.select(F.col(column).alias("__v")).distinct()
        # One row per distinct value of a dimension's id.
        place = F.percent_rank().over(Window.partitionBy().orderBy(F.col("__v").asc_nulls_first()))
        known = values.select("__v", F.floor(place * ((1 << bits) - 1)).cast("long").alias(f"__rank{i}"))
        ranked = ranked.join(F.broadcast(known), F.col(column).eqNullSafe(F.col("__v")), "left").drop("__v")
    for bit in range(bits):
        for i in range(len(columns)):
            one = F.shiftright(F.col(f"__rank{i}"), bits - 1 - bit).bitwiseAND(F.lit(1).cast("long"))
            z = F.call_function("shiftleft", z, F.lit(1)).bitwiseOR(one)
    return ranked.withColumn(out, z).drop(*[f"__rank{i}" for i in range(len(columns))])


def write_mart(
    df: DataFrame,
    path: str,
    partition: str = "event_date_pacific",
    sort: Sequence[str] = ("event_type",),
    cluster: Sequence[str] = ("neighborhood_id", "police_district_id"),
    row_group_bytes: int = 8 << 20,
) -> None:
    """Partitioned by day; inside files sorted by ``sort``, then by the interleaved ids of ``cluster``.

    So a filter on either boundary skips row groups, not only one on the first. ``rebalance`` lets adaptive execution split a very large day over several writers and
    pack small days together.
    """
    rows = interleaved(df, cluster, "__z") if cluster else df.withColumn("__z", F.lit(0))
    (
        rows.hint("rebalance", partition)
        .sortWithinPartitions(partition, *sort, "__z")
        .drop("__z")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.block.size", row_group_bytes)
        .partitionBy(partition)
        .parquet(path)
    )


def write_boundary_dimension(dim: DataFrame, path: str) -> None:
    """Boundary dimension (id, name, geometry WKT) as one CSV with a header under ``path``/csv."""
    dim.orderBy("id").coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path.rstrip('/')}/csv")
