"""Boundary metrics for every boundary at once; one boundary is a filter on the result."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fogline.functions.geo import rings_geojson, wkt_rings
from fogline.functions.temporal import pacific_range_to_utc, tod_us, utc_to_pacific_date_text
from fogline.functions.text import blank_to_null
from fogline.schemas import BEDROOM_BUCKETS, BOUNDARY_COLUMNS

BOUNDARY = ("boundary_type", "boundary_id")


def by_boundary(df: DataFrame) -> DataFrame:
    """Each row once per boundary system; rows without an id in a system are left out of it."""
    pairs = F.array(
        *[
            F.struct(F.lit(kind).alias("boundary_type"), F.col(column).alias("boundary_id"))
            for kind, column in BOUNDARY_COLUMNS.items()
        ]
    )
    rest = [c for c in df.columns if c not in BOUNDARY_COLUMNS.values()]
    return df.select(*rest, F.inline(pairs)).where(F.col("boundary_id").isNotNull())


def select_events(
    events: DataFrame, start_date: str, end_date: str, start_time: str = "00:00", end_time: str = "23:59"
) -> DataFrame:
    """Inclusive Pacific dates and an inclusive Pacific time of day.

    The date bound repeats what the instants already say, so a table partitioned by Pacific
    date is pruned to the days asked for.
    """
    start_utc, end_utc = pacific_range_to_utc(start_date, end_date)
    first, last = (F.lit(dt.date.fromisoformat(d)) for d in (start_date, end_date))
    return events.where(
        F.col("event_date_pacific").between(first, last)
        & (F.col("event_ts_utc") >= start_utc)
        & (F.col("event_ts_utc") < end_utc)
        & F.col("event_tod_us").between(tod_us(start_time), tod_us(end_time))
    )


_KPI_COLUMNS = (
    *BOUNDARY,
    "incidents_311_total",
    "police_total",
    "transit_arrivals_total",
    "transit_median_delay_sec",
    "transit_pct_delay_over_300_sec",
)


def _kpi_counts(n: Column) -> list[Column]:
    def total(kind: str, condition: Column | None = None) -> Column:
        mine = F.col("event_type") == kind
        mine = mine if condition is None else mine & condition
        return F.sum(F.when(mine, n).otherwise(F.lit(0)))

    return [
        total("311").alias("incidents_311_total"),
        total("police").alias("police_total"),
        total("transit").alias("transit_arrivals_total"),
        total("transit", F.col("arrival_delay_sec") > 300).alias("__late"),
        total("transit", F.col("arrival_delay_sec").isNotNull()).alias("__timed"),
    ]


def _percent_late() -> Column:
    return (F.try_divide(F.col("__late"), F.col("__timed")) * 100).alias("transit_pct_delay_over_300_sec")


def boundary_kpis(events: DataFrame) -> DataFrame:
    """Counts, median delay and share of late arrivals per boundary.

    Rows shrink to counts per (boundary, domain, delay) on the map side: delays are whole
    seconds, so a boundary has a bounded number of them however many arrivals it sees. Both
    the totals and the median (the smallest delay that at least half the arrivals do not
    exceed) then come from those counts.
    """
    delay = F.when(F.col("event_type") == "transit", F.col("arrival_delay_sec"))
    counted = (
        by_boundary(events.select("event_type", delay.alias("arrival_delay_sec"), *BOUNDARY_COLUMNS.values()))
        .groupBy(*BOUNDARY, "event_type", "arrival_delay_sec")
        .agg(F.count("*").alias("n"))
    )
    ordered = Window.partitionBy(*BOUNDARY).orderBy("arrival_delay_sec")
    timed_n = F.when(F.col("arrival_delay_sec").isNotNull(), F.col("n")).otherwise(F.lit(0))
    ranked = counted.withColumn(
        "__upto", F.sum(timed_n).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("__all", F.sum(timed_n).over(Window.partitionBy(*BOUNDARY)))
    at_half = F.col("arrival_delay_sec").isNotNull() & (F.col("__upto") * 2 >= F.col("__all"))
    return (
        ranked.groupBy(*BOUNDARY)
        .agg(
            *_kpi_counts(F.col("n")),
            F.min(F.when(at_half, F.col("arrival_delay_sec"))).alias("transit_median_delay_sec"),
        )
        .select(*_KPI_COLUMNS[:-1], _percent_late())
    )


def boundary_kpis_approx(events: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """As ``boundary_kpis`` with a sketch for the median: one aggregate, no window."""
    delay = F.when(F.col("event_type") == "transit", F.col("arrival_delay_sec"))
    return (
        by_boundary(events.select("event_type", "arrival_delay_sec", *BOUNDARY_COLUMNS.values()))
        .groupBy(*BOUNDARY)
        .agg(
            *_kpi_counts(F.lit(1)),
            F.percentile_approx(delay, 0.5, accuracy).alias("transit_median_delay_sec"),
        )
        .select(*_KPI_COLUMNS[:-1], _percent_late())
    )


def category_histogram(events: DataFrame) -> DataFrame:
    """311 and police rows per boundary and category."""
    incidents = events.where(F.col("event_type").isin("311", "police"))
    return (
        by_boundary(incidents.select("event_type", "category", *BOUNDARY_COLUMNS.values()))
        .groupBy(*BOUNDARY, "event_type", "category")
        .agg(F.count("*").alias("category_count"))
    )


def category_top(histogram: DataFrame, n: int = 10) -> DataFrame:
    """The n largest categories per boundary and domain; equal counts go by name."""
    order = Window.partitionBy(*BOUNDARY, "event_type").orderBy(F.desc("category_count"), "category")
    return histogram.withColumn("category_rank", F.row_number().over(order)).where(F.col("category_rank") <= n)


def rental_comparison(
    rentals: DataFrame, start_date: str, end_date: str, as_of: Column, as_of_date: Column
) -> DataFrame:
    """Average price and listings per boundary and bedroom bucket, selected period vs now.

    One pass: both periods and all buckets are conditional aggregates, so empty buckets
    appear with zero listings. The time-of-day control does not apply to rentals.
    """
    start_utc, end_utc = pacific_range_to_utc(start_date, end_date)
    selected = (F.col("listed_date") < end_utc) & (
        F.col("removed_date").isNull() | (F.col("removed_date") > start_utc)
    )
    current = F.col("removed_date").isNull() & (F.col("listed_date") <= as_of)
    rows = by_boundary(
        rentals.where(F.col("bedroom_bucket").isin(*BEDROOM_BUCKETS) & (selected | current)).select(
            "bedroom_bucket",
            "price",
            selected.alias("__selected"),
            current.alias("__current"),
            *BOUNDARY_COLUMNS.values(),
        )
    )

    def cell(bucket: str, period: str) -> list[Column]:
        mine = (F.col("bedroom_bucket") == bucket) & F.col(f"__{period}")
        return [
            F.avg(F.when(mine, F.col("price"))).alias(f"{bucket}_{period}_avg"),
            F.count_if(mine).alias(f"{bucket}_{period}_n"),
        ]

    wide = rows.groupBy(*BOUNDARY).agg(
        *[c for b in BEDROOM_BUCKETS for p in ("selected", "current") for c in cell(b, p)]
    )
    buckets = F.array(
        *[
            F.struct(
                F.lit(i).alias("bucket_order"),
                F.lit(b).alias("bedroom_bucket"),
                F.col(f"`{b}_selected_avg`").alias("selected_average_price"),
                F.col(f"`{b}_selected_n`").alias("selected_listing_count"),
                F.col(f"`{b}_current_avg`").alias("current_average_price"),
                F.col(f"`{b}_current_n`").alias("current_listing_count"),
            )
            for i, b in enumerate(BEDROOM_BUCKETS)
        ]
    )
    return wide.select(*BOUNDARY, F.inline(buckets), as_of_date.alias("current_as_of"))


def _all_or_null(pick, *columns: str) -> Column:
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    return F.when(present, pick(*[F.col(c) for c in columns]))


def time_bounds(events: DataFrame) -> DataFrame:
    """One row: the overlap of the three domains if there is one, else their full range.

    As in the source, a domain without rows makes both ranges NULL.
    """
    kinds = {"311": "311", "police": "police", "transit": "transit"}
    ends = events.agg(
        *[
            pick(F.when(F.col("event_type") == k, F.col("event_ts_utc"))).alias(f"{name}_{k}")
            for k in kinds
            for name, pick in (("min", F.min), ("max", F.max))
        ]
    )
    lows, highs = [f"min_{k}" for k in kinds], [f"max_{k}" for k in kinds]
    ranges = ends.select(
        _all_or_null(F.least, *lows).alias("global_min_ts"),
        _all_or_null(F.greatest, *highs).alias("global_max_ts"),
        _all_or_null(F.greatest, *lows).alias("overlap_min_ts"),
        _all_or_null(F.least, *highs).alias("overlap_max_ts"),
    )
    overlaps = F.coalesce(F.col("overlap_min_ts") <= F.col("overlap_max_ts"), F.lit(False))
    return ranges.select(
        "*",
        F.when(overlaps, F.col("overlap_min_ts")).otherwise(F.col("global_min_ts")).alias("start_ts"),
        F.when(overlaps, F.col("overlap_max_ts")).otherwise(F.col("global_max_ts")).alias("end_ts"),
    )


def top_boundaries(
    events: DataFrame, boundaries: DataFrame, event_type: str, boundary_type: str = "neighborhoods", n: int = 10
) -> DataFrame:
    """Boundaries with the most events of a domain; counted by id first, named afterwards."""
    column = BOUNDARY_COLUMNS[boundary_type]
    counts = (
        events.where((F.col("event_type") == event_type) & F.col(column).isNotNull())
        .groupBy(F.col(column).alias("boundary_id"))
        .agg(F.count("*").alias("event_count"))
    )
    names = boundaries.where(F.col("boundary_type") == boundary_type).select("boundary_id", "boundary_name")
    return (
        counts.join(names, "boundary_id")
        .orderBy(F.desc("event_count"), "boundary_name", "boundary_id")
        .limit(n)
    )


def daily_trend(events: DataFrame, as_of_date: str, days: int, exclude_last_days: int = 0) -> DataFrame:
    """Events per Pacific day and domain from ``days`` before ``as_of_date``.

    ``exclude_last_days`` drops the newest days, which incident sources under-report.
    """
    as_of = dt.date.fromisoformat(as_of_date)
    day = F.col("event_date_pacific")
    wanted = (day >= F.lit(as_of - dt.timedelta(days=days))) & (day <= F.lit(as_of))
    if exclude_last_days:
        wanted = wanted & (day <= F.lit(as_of - dt.timedelta(days=exclude_last_days)))
    return events.where(wanted).groupBy("event_date_pacific", "event_type").agg(F.count("*").alias("event_count"))


def boundary_day_rollup(events: DataFrame) -> DataFrame:
    """Additive counts per boundary and Pacific day (the median is not additive)."""
    is_transit = F.col("event_type") == "transit"
    return (
        by_boundary(
            events.select("event_date_pacific", "event_type", "arrival_delay_sec", *BOUNDARY_COLUMNS.values())
        )
        .groupBy(*BOUNDARY, "event_date_pacific")
        .agg(
            F.count_if(F.col("event_type") == "311").alias("incidents_311"),
            F.count_if(F.col("event_type") == "police").alias("police"),
            F.count_if(is_transit).alias("transit_arrivals"),
            F.count_if(is_transit & F.col("arrival_delay_sec").isNotNull()).alias("transit_with_delay"),
            F.count_if(is_transit & (F.col("arrival_delay_sec") > 300)).alias("transit_delayed_over_5_min"),
        )
    )


def boundary_features(boundaries: DataFrame) -> DataFrame:
    """GeoJSON text per boundary that has a usable geometry."""
    named = F.coalesce(blank_to_null(F.col("boundary_name")), F.col("boundary_id"))
    return (
        boundaries.select(
            "boundary_type",
            F.col("boundary_id").alias("id"),
            named.alias("name"),
            "geometry",
            wkt_rings(F.col("geometry")).alias("__rings"),
        )
        .where(F.col("__rings").isNotNull())
        .select("boundary_type", "id", "name", rings_geojson(F.col("geometry"), F.col("__rings")).alias("geojson"))
    )


def feature_collection(features: DataFrame) -> DataFrame:
    """One document and one id -> name map per boundary system (the dimension is small)."""
    feature = F.concat(
        F.lit('{"type":"Feature","id":'),
        F.to_json(F.array("id")).substr(F.lit(2), F.length(F.to_json(F.array("id"))) - 2),
        F.lit(',"properties":'),
        F.to_json(F.struct("id", "name")),
        F.lit(',"geometry":'),
        F.col("geojson"),
        F.lit("}"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("name", "id", feature.alias("feature"))))
    return features.groupBy("boundary_type").agg(ordered.alias("__f")).select(
        "boundary_type",
        F.concat(
            F.lit('{"type":"FeatureCollection","features":['),
            F.array_join(F.transform("__f", lambda f: f["feature"]), ","),
            F.lit("]}"),
        ).alias("geojson"),
        F.map_from_entries(F.transform("__f", lambda f: F.struct(f["id"], f["name"]))).alias("id_to_name"),
    )


def incident_parity(events: DataFrame, source: DataFrame, event_type: str, ts: str, start: Column, end: Column) -> DataFrame:
    """Source rows and mart rows per boundary in a period; equal counts are expected."""

    def counts(df: DataFrame, when: str, out: str) -> DataFrame:
        ids = [F.col(c).cast("string").alias(c) for c in BOUNDARY_COLUMNS.values()]
        rows = df.where((F.col(when) >= start) & (F.col(when) < end)).select(*ids)
        return by_boundary(rows).groupBy(*BOUNDARY).agg(F.count("*").alias(out))

    mart = counts(events.where(F.col("event_type") == event_type), "event_ts_utc", "mart_rows")
    raw = counts(source, ts, "source_rows")
    zero = F.lit(0)
    return raw.join(mart, list(BOUNDARY), "full_outer").select(
        *BOUNDARY,
        F.lit(event_type).alias("event_type"),
        F.coalesce("source_rows", zero).alias("source_rows"),
        F.coalesce("mart_rows", zero).alias("mart_rows"),
        (F.coalesce("source_rows", zero) == F.coalesce("mart_rows", zero)).alias("equal"),
    )


def _one_boundary(df: DataFrame, boundary_type: str, boundary_id: str) -> DataFrame:
    """Rows of one boundary, counted under that boundary system only."""
    own = BOUNDARY_COLUMNS[boundary_type]
    others = {c: F.lit(None).cast("string") for c in BOUNDARY_COLUMNS.values() if c != own}
    return df.where(F.col(own) == boundary_id).withColumns(others)


def _asked(df: DataFrame, boundary_type: str, boundary_id: str) -> DataFrame:
    return df.sparkSession.range(1).select(
        F.lit(boundary_type).alias("boundary_type"), F.lit(boundary_id).alias("boundary_id")
    )


def boundary_totals(events: DataFrame, boundary_type: str, boundary_id: str) -> DataFrame:
    """KPIs of one boundary: always one row, zero counts where it has no events."""
    kpis = boundary_kpis(_one_boundary(events, boundary_type, boundary_id))
    totals = ["incidents_311_total", "police_total", "transit_arrivals_total"]
    return _asked(events, boundary_type, boundary_id).join(kpis, list(BOUNDARY), "left").na.fill(0, totals)


def boundary_rentals(
    rentals: DataFrame,
    boundary_type: str,
    boundary_id: str,
    start_date: str,
    end_date: str,
    as_of: Column,
    as_of_date: Column,
) -> DataFrame:
    """Rental comparison of one boundary: always all five buckets, in display order."""
    found = rental_comparison(
        _one_boundary(rentals, boundary_type, boundary_id), start_date, end_date, as_of, as_of_date
    ).drop("bucket_order", "current_as_of")
    buckets = F.posexplode(F.array(*[F.lit(b) for b in BEDROOM_BUCKETS])).alias("bucket_order", "bedroom_bucket")
    spine = _asked(rentals, boundary_type, boundary_id).select("*", buckets)
    return (
        spine.join(found, [*BOUNDARY, "bedroom_bucket"], "left")
        .na.fill(0, ["selected_listing_count", "current_listing_count"])
        .withColumn("current_as_of", as_of_date)
        .orderBy("bucket_order")
    )


def boundary_metrics(
    events: DataFrame,
    rentals: DataFrame,
    boundary_type: str,
    boundary_id: str,
    start_date: str,
    end_date: str,
    start_time: str,
    end_time: str,
    as_of: Column,
    as_of_date: Column,
) -> dict[str, DataFrame]:
    """Everything the dashboard shows for one boundary."""
    chosen = select_events(events, start_date, end_date, start_time, end_time)
    histogram = category_histogram(_one_boundary(chosen, boundary_type, boundary_id))

    def ordered(kind: str) -> DataFrame:
        mine = histogram.where(F.col("event_type") == kind).select("category", "category_count")
        return mine.orderBy(F.desc("category_count"), "category")

    return {
        "totals": boundary_totals(chosen, boundary_type, boundary_id),
        "hist_311": ordered("311"),
        "hist_police": ordered("police"),
        "rentals": boundary_rentals(
            rentals, boundary_type, boundary_id, start_date, end_date, as_of, as_of_date
        ),
    }


def default_date_range(events: DataFrame, today: dt.date) -> tuple[str, str]:
    """Pacific dates of the usable time bounds, or the last seven days where there are none."""
    bounds = time_bounds(events).select(
        utc_to_pacific_date_text(F.col("start_ts")).alias("first"),
        utc_to_pacific_date_text(F.col("end_ts")).alias("last"),
    ).first()
    if bounds["first"] is None or bounds["last"] is None:
        return (today - dt.timedelta(days=7)).isoformat(), today.isoformat()
    return bounds["first"], bounds["last"]
