from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from curbside import schemas
from curbside.operators import gold as G
from curbside.operators import quality as Q
from curbside.plans import reports as R
from curbside.session import shared_folder
from curbside.settings import Names
from curbside.sources import tables as T
from helpers import bronze, frame, physical_plan, silver, ts

NOW = ts("2024-01-15 12:00:00")
NAMES = Names("t1")


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    T.init_tables(spark, root, NAMES)
    T.init_tables(spark, root, NAMES)
    return root


def test_declared_tables(spark, catalog):
    dbs = [r[0] for r in T.list_databases(spark, "t1*").collect()]
    assert sorted(dbs) == ["t1_bronze", "t1_gold", "t1_silver"]
    assert sorted(r.tableName for r in T.list_tables(spark, "t1_gold").filter("not isTemporary").collect()) == [
        "city_ride_metrics", "driver_utilization", "funnel_analysis", "surge_pricing"]
    for name, (schema, parts) in T.DECLARED.items():
        df = spark.table(NAMES.table(name))
        assert sorted(df.columns) == sorted(schema.names) and df.columns[-len(parts):] == list(parts)
        assert {f.name: f.dataType for f in df.schema.fields} == {f.name: f.dataType for f in schema.fields}


def test_write_through_the_catalog(spark, catalog):
    name = NAMES.table("ride_events_clean")
    df = silver(spark, {}, {"ride_id": "R2", "city": "Miami"})
    df.select(*spark.table(name).columns).write.insertInto(name)
    hit = R.point_lookup(spark.table(name), "2024-01-15", "New York", "R1")
    assert hit.count() == 1
    plan = physical_plan(hit)
    filters = plan[plan.index("PartitionFilters"):]
    assert "event_date" in filters.split("PushedFilters")[0] and "city" in filters.split("PushedFilters")[0]
    assert "EqualTo(ride_id,R1)" in filters


def test_reports_run_as_sql_text(spark, catalog):
    name = NAMES.table("city_ride_metrics")
    gold = G.city_ride_metrics(silver(spark, {}, {"ride_id": "R2", "event_type": "trip_completed"}))
    gold.select(*spark.table(name).columns).write.insertInto(name)
    sql = spark.sql(f"""
        SELECT city, sum(total_rides) AS rides_last_hour, round(sum(total_gross_revenue), 2) AS gross_revenue_usd
        FROM {name} WHERE window_start >= timestamp'2024-01-15 10:30:00' - INTERVAL 1 HOUR GROUP BY city""")
    report = R.city_last_hour(spark.table(name), ts("2024-01-15 10:30:00"))
    assert sql.collect() == report.select(*sql.columns).collect()


def test_properties_and_registration(spark, catalog, tmp_path):
    name = NAMES.table("surge_pricing")
    T.set_properties(spark, name, {"owner.team": "pricing's", "feed": "true"})
    props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert props["owner.team"] == "pricing's" and props["feed"] == "true"
    path = str(tmp_path / "x")
    silver(spark, {}, {"city": "Miami"}).write.partitionBy("event_date", "city").parquet(path)
    T.register_files(spark, "t1_silver.copy", path)
    T.register_files(spark, "t1_silver.copy", path)
    assert spark.table("t1_silver.copy").count() == 2
    assert T.preview(spark.table("t1_silver.copy"), 1).count() == 1


def city_rows(spark, *rows):
    base = {"city": "Miami", "total_rides": 1, "completed_rides": 1, "total_gross_revenue": 10.0,
            "total_net_revenue": 8.2, "avg_fare": 10.0, "avg_surge_multiplier": 1.0, "completion_rate": 50.0}
    out = []
    for start, changes in rows:
        out.append(base | {"window_start": start, "window_start_date": start.date()} | changes)
    return frame(spark, schemas.CITY_RIDE_METRICS, *out)


def test_relative_bounds(spark):
    df = city_rows(spark, (NOW - timedelta(minutes=15), {}), (NOW - timedelta(minutes=16), {}),
                   (NOW - timedelta(hours=1), {}), (NOW - timedelta(hours=24), {}), (NOW - timedelta(hours=25), {}))
    assert R.city_dashboard(df, NOW).first().rides_last_15min == 1
    assert R.city_last_hour(df, NOW).first().rides_last_hour == 3
    assert R.hourly_revenue(df, NOW).agg(F.sum("total_rides")).first()[0] == 4


def test_week_over_week_ranges_share_a_day(spark):
    day = lambda n: ts("2024-01-15 00:00:00") - timedelta(days=n)
    df = city_rows(
        spark, (day(0), {}), (day(7), {"total_gross_revenue": 5.0}), (day(14), {"total_gross_revenue": 7.0}),
        (day(15), {"total_gross_revenue": 1000.0}), (day(0), {"city": "New"}),
        (day(8), {"city": "Gone"}), (day(1), {"city": "Tiny"}), (day(9), {"city": "Tiny", "total_gross_revenue": 0.5}))
    got = {r.city: tuple(r)[1:] for r in R.week_over_week(df, df, NOW).collect()}
    assert got["Miami"] == (15.0, 12.0, 3.0, 25.0)
    assert got["New"] == (10.0, None, None, None) and "Gone" not in got
    assert got["Tiny"] == (10.0, 0.5, 9.5, 950.0)


def test_peak_hours_break_ties_by_hour(spark):
    hour = lambda h: ts(f"2024-01-15 {h:02}:00:00")
    df = city_rows(spark, (hour(3), {"total_rides": 5}), (hour(1), {"total_rides": 5}),
                   (hour(2), {"total_rides": 2}), (hour(9), {"total_rides": 2}))
    row = R.peak_hours(df, NOW).first()
    assert (row.peak_hour, row.peak_rides_per_hr, row.off_peak_hour, row.off_peak_rides_per_hr) == (1, 5.0, 2, 2.0)


def test_demand_gap_mode_and_counts(spark):
    def row(minutes, tier, requests, drivers):
        start = NOW - timedelta(minutes=minutes)
        return {"city": "Miami", "window_start": start, "window_start_date": start.date(), "ride_requests": requests,
                "drivers_active": drivers, "demand_supply_ratio": 1.0, "surge_triggered": tier != "NORMAL",
                "surge_tier": tier}
    df = frame(spark, schemas.SURGE_PRICING, row(5, "NORMAL", 4, 1), row(10, "HIGH", 4, 1), row(99, "HIGH", 9, 1))
    got = R.demand_gap(df, NOW).first()
    assert got.dominant_surge_tier == "HIGH" and got.surge_trigger_count == 1
    assert (got.avg_ride_requests, got.avg_drivers_active, got.avg_unmet_demand) == (4.0, 1.0, 3.0)
    alerts = R.surge_alerts(df, NOW).collect()
    assert [(a.surge_tier, a.surge_status) for a in alerts] == [("HIGH", "🟠 HIGH")]
    assert R.surge_recent(df, interval=None).count() == 2


def test_reports_prune_window_dates(spark, tmp_path):
    path = str(tmp_path / "g")
    city_rows(spark, (NOW, {})).write.partitionBy("window_start_date", "city").parquet(path)
    plan = physical_plan(R.city_dashboard(spark.read.parquet(path), NOW))
    assert "window_start_date" in plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]


def test_dead_letter_rate(spark):
    day = NOW.date()
    ok = bronze(spark, *[{"kafka_offset": i, "ingestion_ts": NOW, "event_date": day} for i in range(19)])
    dead = bronze(spark, {"ingestion_ts": NOW, "event_date": day},
                  {"ingestion_ts": NOW - timedelta(hours=2), "event_date": day})
    row = Q.dead_letter_rate(ok, dead, NOW).first()
    assert (row.bronze_count, row.dead_letter_count, row.dead_letter_pct, row.alert_triggered) == (19, 1, 5.0, False)
    row = Q.dead_letter_rate(ok, dead, NOW, hours=None, days=1).first()
    assert (row.dead_letter_count, row.dead_letter_pct, row.alert_triggered) == (2, 9.52, True)
    none = Q.dead_letter_rate(ok.limit(0), dead.limit(0), NOW).first()
    assert (none.dead_letter_pct, none.alert_triggered) == (0.0, False)


def test_layer_checks(spark):
    s = silver(spark, {}, {"ride_id": "R2", "has_data_quality_issue": True}, {"ride_id": "R2"})
    empty = s.limit(0)
    row = Q.pipeline_metrics(bronze(spark, {}), s, empty).first()
    assert tuple(row) == (1, 3, 0, 33.33)
    assert {tuple(r) for r in Q.nonempty_check({"a": s, "b": empty}).collect()} == {("a", 3, True), ("b", 0, False)}
    assert [tuple(r) for r in Q.duplicate_keys(s).collect()] == [("R2", "ride_requested", 2)]
    assert tuple(Q.batch_quality(s).first()) == (2, 1)


def test_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert a.startswith(f"{base}/x-") and a != b

    class Cluster:
        conf = {"spark.sql.warehouse.dir": "hdfs:/warehouse/"}
    assert shared_folder(Cluster(), "x").startswith("hdfs:/warehouse/_shared/x-")
