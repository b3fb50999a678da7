import datetime as dt
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fogline.plans import metrics, rollup
from fogline.sources import writers
from tests.test_metrics import U, event, events


def some_events(spark, n, days=(10, 11, 12, 13), seed=1):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        kind = rng.choice(["311", "police", "transit", "transit"])
        delay = rng.choice([None, float(rng.randrange(-200, 900))]) if kind == "transit" else None
        rows.append(event(kind, U(rng.choice(days), 12), nb=rng.choice([None, "1", "2"]), pd=rng.choice([None, "7"]), delay=delay))
    return events(spark, rows)


def kpis(df):
    return sorted(map(tuple, df.select(*metrics.BOUNDARY, "incidents_311_total", "police_total", "transit_arrivals_total", "transit_median_delay_sec", "transit_pct_delay_over_300_sec").collect()))


@pytest.fixture()
def day():
    return lambda n: dt.date(2026, 6, n)


def test_rollup_equals_the_fact_and_follows_its_days(spark, tmp_path, day):
    table = rollup.rollup_table(spark, str(tmp_path / "r"))
    facts = some_events(spark, 400)
    rollup.refresh_rollup(table, facts, [day(n) for n in range(9, 15)])
    whole = lambda f, a, b: metrics.boundary_kpis(f.where(F.col("event_date_pacific").between(F.lit(day(a)), F.lit(day(b)))))
    for a, b in ((10, 13), (11, 12), (10, 10)):
        assert kpis(rollup.boundary_kpis_rollup(table.read(), day(a), day(b))) == kpis(whole(facts, a, b))
    # One day changes, one loses all its events; the others keep their files.
    before = {r["file"] for r in table.files(table.state()).collect()}
    changed = facts.where(~F.col("event_date_pacific").isin(F.lit(day(11)), F.lit(day(12)))).unionByName(some_events(spark, 100, days=(11,), seed=2))
    rollup.refresh_rollup(table, changed, [day(11), day(12)])
    assert kpis(rollup.boundary_kpis_rollup(table.read(), day(10), day(13))) == kpis(whole(changed, 10, 13))
    after = {r["file"] for r in table.files(table.state()).collect()}
    assert len(before & after) >= 2
    plan = rollup.boundary_kpis_rollup(table.read(), day(10), day(13))._jdf.queryExecution().optimizedPlan().toString()
    assert "event_type" not in plan


def test_error_of_the_median_is_bounded(spark, tmp_path, day):
    rng = random.Random(5)
    delays = [float(int(rng.gauss(100, 300))) for _ in range(20_000)]
    facts = events(spark, [event("transit", U(10 + i % 4, 12), nb="1", delay=d) for i, d in enumerate(delays)])
    kept = 200
    got = rollup.boundary_kpis_rollup(rollup.day_summaries(facts, kept), day(1), day(30)).where("boundary_type = 'neighborhoods'").first()
    median = got["transit_median_delay_sec"]
    below, upto = (sum(d < median for d in delays) / len(delays), sum(d <= median for d in delays) / len(delays))
    assert below - rollup.rank_error(kept) <= 0.5 <= upto + rollup.rank_error(kept)
    assert got["transit_pct_delay_over_300_sec"] == pytest.approx(100 * sum(d > 300 for d in delays) / len(delays))


def read_share(path, column, value):
    """Share of the row groups whose range of values holds one."""
    groups = [
        pq.ParquetFile(f).metadata.row_group(g) for f in path.rglob("*.parquet") for g in range(pq.ParquetFile(f).metadata.num_row_groups)
    ]
    assert len(groups) > 20
    hit = 0
    for g in groups:
        stats = next(g.column(i).statistics for i in range(g.num_columns) if g.column(i).path_in_schema == column)
        hit += stats.min <= value <= stats.max
    return hit / len(groups)


def test_either_boundary_prunes_row_groups(spark, tmp_path):
    ddl = "event_date_pacific date, event_type string, neighborhood_id string, police_district_id string, pad string"
    rng = random.Random(1)
    rows = [(dt.date(2026, 6, 1), "311", str(rng.randrange(1, 118)), str(rng.randrange(1, 11)), f"{rng.random()}" * 3) for _ in range(40_000)]
    df = spark.createDataFrame(rows, ddl).repartition(1)
    writers.write_mart(df, str(tmp_path / "z"), row_group_bytes=32 << 10)
    writers.write_mart(df, str(tmp_path / "lexical"), sort=("event_type", "neighborhood_id", "police_district_id"), cluster=(), row_group_bytes=32 << 10)
    shares = {
        (kind, column): sum(read_share(tmp_path / kind, column, v) for v in values) / len(values)
        for kind in ("z", "lexical")
        for column, values in (("neighborhood_id", ("1", "50", "117")), ("police_district_id", ("1", "5", "10")))
    }
    assert shares["lexical", "police_district_id"] > 0.9
    assert shares["z", "police_district_id"] < 0.45 and shares["z", "neighborhood_id"] < 0.45
    assert spark.read.parquet(str(tmp_path / "z")).count() == 40_000
