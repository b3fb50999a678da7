"""Tables that change by commits, written in the session's shared folder and read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from fogline.functions.temporal import pacific_date
from fogline.operators import checks, merge
from fogline.plans import metrics, rollup
from fogline.plans.runs import recorded
from fogline.session import cut_lineage, ensure_checkpoint_dir
from fogline.sources.tables import FileTable
from workload.boundary import KPI_SQL
from workload.mutation import DAY_REPLACE_SQL
from workload.registry import query


def _table(t, **layout):
    """A table of this run: nothing else writes to its folder."""
    return FileTable(t.spark, f"{ensure_checkpoint_dir(t.spark)}/tables-{uuid.uuid4().hex}", **layout)


@query(
    "table_merge",
    """WITH recent AS (SELECT * FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 60 DAY),
       staged AS (SELECT o_orderdate, o_orderkey, o_totalprice + 1 AS o_totalprice FROM recent
                  UNION ALL SELECT o_orderdate, o_orderkey + (SELECT max(o_orderkey) FROM orders), o_totalprice FROM recent),
       rows AS (
         SELECT coalesce(t.o_orderdate, s.o_orderdate) AS d, coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
                CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
         FROM orders t FULL JOIN staged s ON t.o_orderdate = s.o_orderdate AND t.o_orderkey = s.o_orderkey)
       SELECT strftime(d, '%Y-%m-%d') AS o_orderdate, o_orderkey, o_totalprice FROM rows""",
)
def table_merge(t):
    """The orders of the last 60 days come again at another price, and as many new ones; only files of those days are rewritten."""
    key = ["o_orderdate", "o_orderkey"]
    orders = t.orders.select(F.to_date("o_orderdate").alias("o_orderdate"), "o_orderkey", "o_totalprice")
    table = _table(t, keys=key)
    table.replace(orders)
    last = orders.agg(F.max("o_orderdate").alias("d"), F.max("o_orderkey").alias("k"))
    recent = orders.where(F.col("o_orderdate") >= F.date_sub(last.select("d").scalar(), 60))
    staged = recent.withColumn("o_totalprice", F.col("o_totalprice") + 1).unionByName(
        recent.withColumn("o_orderkey", F.col("o_orderkey") + last.select("k").scalar())
    )
    table.merge(cut_lineage(staged), lambda old, new: merge.upsert_by_key(old, new, key))
    return table.read()


@query("table_replace_days", DAY_REPLACE_SQL)
def table_replace_days(t):
    """As ``day_replace``, by one commit to a table partitioned by day."""
    days = [dt.date(2024, 1, 11) + dt.timedelta(days=i) for i in range(10)]
    rows = t.police_incidents.select("police_incident_id", "incident_datetime", "incident_category")
    dated = rows.withColumn("day", pacific_date(F.col("incident_datetime")))
    table = _table(t, partition="day")
    table.replace(dated)
    again = dated.where(F.col("day").between(days[0], days[-1]) & (F.col("day") != dt.date(2024, 1, 15)))
    table.replace_partitions(again.withColumn("incident_category", F.lit("Redelivered")), days)
    return table.read().drop("day")


@query(
    "boundary_kpis_rollup",
    f"""SELECT boundary_type, boundary_id, incidents_311_total, police_total, transit_arrivals_total, transit_pct_delay_over_300_sec,
               true AS median_within
        FROM ({KPI_SQL.replace('chosen_by_boundary', 'gold_by_boundary')}) k""",
)
def boundary_kpis_rollup(t):
    """KPIs of all days from the roll-up; the median is held against the fact: its rank must be within the summary's bound."""
    days = _table(t, partition=rollup.DAY)
    days.replace(rollup.day_summaries(t.gold_events))
    kpis = rollup.boundary_kpis_rollup(days.read(), dt.date(1900, 1, 1), dt.date(2999, 12, 31))
    timed = t.gold_events.where((F.col("event_type") == "transit") & F.col("arrival_delay_sec").isNotNull())
    delays = metrics.by_boundary(timed.select("arrival_delay_sec", *metrics.BOUNDARY_COLUMNS.values()))
    median = F.col("transit_median_delay_sec")
    ranks = (
        delays.join(F.broadcast(kpis.select(*metrics.BOUNDARY, median)), list(metrics.BOUNDARY))
        .groupBy(*metrics.BOUNDARY)
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("arrival_delay_sec") < median).alias("below"),
            F.count_if(F.col("arrival_delay_sec") <= median).alias("upto"),
        )
    )
    error = F.lit(rollup.rank_error())
    within = (F.col("below") / F.col("n") - error <= 0.5) & (F.col("upto") / F.col("n") + error >= 0.5)
    return kpis.join(ranks, list(metrics.BOUNDARY), "left").select(
        *metrics.BOUNDARY,
        "incidents_311_total",
        "police_total",
        "transit_arrivals_total",
        "transit_pct_delay_over_300_sec",
        F.coalesce(within, median.isNull()).alias("median_within"),
    )


@query(
    "job_run_stats",
    """SELECT 'load_orders' AS job, 'done' AS outcome, NULL::VARCHAR AS error,
              'read=' || count(*) || ',read_open=' || count(*) FILTER (o_orderstatus = 'O') AS counts FROM orders
       UNION ALL SELECT 'load_lines', 'failed', 'QualityError', '' FROM region WHERE r_regionkey = 0
       UNION ALL SELECT 'merge_lines', 'done', NULL, 'staged=' || count(DISTINCT l_orderkey) FROM lineitem""",
)
def job_run_stats(t):
    """What three runs leave behind: a load, one that its key check stops, and a merge."""
    runs, orders = _table(t), _table(t, keys=["o_orderkey"])
    with recorded(t.spark, runs, "load_orders") as run:
        rows = cut_lineage(run.watch(t.orders.select("o_orderkey", "o_orderstatus"), "read", open=F.col("o_orderstatus") == "O"))
        orders.replace(rows)
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("o_orderstatus"))
    try:
        with recorded(t.spark, runs, "load_lines"):
            checks.require_unique(lines, ["o_orderkey"], "lines")
    except checks.QualityError:
        pass
    with recorded(t.spark, runs, "merge_lines") as run:
        staged = cut_lineage(run.watch(lines.groupBy("o_orderkey").agg(F.max("o_orderstatus").alias("o_orderstatus")), "staged"))
        orders.merge(staged, lambda old, new: merge.upsert_by_key(old, new, ["o_orderkey"]))
    listed = F.transform(F.array_sort(F.map_entries("counts")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return runs.read().select(
        "job", "outcome", F.nullif(F.regexp_extract("error", r"^(\w+):", 1), F.lit("")).alias("error"), F.array_join(listed, ",").alias("counts")
    )
