"""The KPI roll-up: counts and delay summaries per boundary and day, kept up to date by the days that change.

A median is not additive, but a quantile summary (KLL sketch) merges: the summary of a period is the merge of those of its days. So
KPIs of any run of whole days read one small row per boundary and day and never the fact. Counts and shares are exact; the
median is off by at most ``rank_error`` in rank, and exact while a boundary has no more arrivals than a summary keeps.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fogline.plans.metrics import BOUNDARY, boundary_day_rollup, by_boundary
from fogline.schemas import BOUNDARY_COLUMNS
from fogline.sources.tables import FileTable

#: Values a summary keeps about, which set its size and its error.
KEPT = 4096
DAY = "event_date_pacific"


def rank_error(kept: int = KEPT) -> float:
    """Bound of the median's error in rank, as a share of all arrivals, for a merged summary (99 % of cases)."""
    return 2.5 / kept**0.9


def rollup_table(spark: SparkSession, path: str) -> FileTable:
    return FileTable(spark, path, partition=DAY)


def day_summaries(events: DataFrame, kept: int = KEPT) -> DataFrame:
    """``boundary_day_rollup`` with ``delays``: a mergeable summary of each boundary's delays, NULL where it has none."""
    timed = events.where((F.col("event_type") == "transit") & F.col("arrival_delay_sec").isNotNull())
    keys = [*BOUNDARY, DAY]
    delays = (
        by_boundary(timed.select(DAY, "arrival_delay_sec", *BOUNDARY_COLUMNS.values()))
        .groupBy(*keys)
        .agg(F.kll_sketch_agg_double("arrival_delay_sec", kept).alias("delays"))
    )
    return boundary_day_rollup(events).join(delays, keys, "left")


def refresh_rollup(table: FileTable, events: DataFrame, days: Sequence[dt.date], kept: int = KEPT) -> int:
    """Recompute the summaries of the days that changed, in one commit; a day without events disappears. Reruns change nothing."""
    changed = events.where(F.col(DAY).isin(*[F.lit(d) for d in days]))
    return table.replace_partitions(day_summaries(changed, kept), days)


def boundary_kpis_rollup(days: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """As ``metrics.boundary_kpis`` for the whole days start..end, from the roll-up alone."""
    merged = (
        days.where(F.col(DAY).between(F.lit(start), F.lit(end)))
        .groupBy(*BOUNDARY)
        .agg(
            F.sum("incidents_311").alias("incidents_311_total"),
            F.sum("police").alias("police_total"),
            F.sum("transit_arrivals").alias("transit_arrivals_total"),
            F.sum("transit_delayed_over_5_min").alias("__late"),
            F.sum("transit_with_delay").alias("__timed"),
            F.kll_merge_agg_double("delays").alias("__delays"),
        )
    )
    median = F.when(F.col("__timed") > 0, F.kll_sketch_get_quantile_double("__delays", F.lit(0.5)))
    return merged.select(
        *BOUNDARY,
        "incidents_311_total",
        "police_total",
        "transit_arrivals_total",
        median.alias("transit_median_delay_sec"),
        (F.try_divide(F.col("__late"), F.col("__timed")) * 100).alias("transit_pct_delay_over_300_sec"),
    )
