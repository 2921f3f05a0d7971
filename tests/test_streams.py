import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from curbside import schemas
from curbside.operators import bronze as B
from curbside.operators import gold as G
from curbside.operators import silver as V
from curbside.plans.catalog import QUERIES
from curbside.plans.gold import read_gold, run_gold
from curbside.sources import rides as source
from curbside.sources.streams import (kafka_options, read_bronze_stream, read_event_stream, read_silver,
                                      read_silver_records)
from curbside.streaming import pipeline as P
from curbside.streaming.progress import PROGRESS, ProgressLog, active_queries, progress_row, with_health
from helpers import messages, silver, ts

ONCE = {"availableNow": True}


def rows(df, *cols):
    return sorted(map(tuple, df.select(*(cols or df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def inbox(spark, data, tmp_path_factory):
    """Message files in order of event time."""
    path = str(tmp_path_factory.mktemp("inbox") / "in")
    msgs = source.messages(source.ride_events(source.read_events(spark, data)))
    msgs.repartitionByRange(4, "offset").write.parquet(path)
    return path


@pytest.fixture
def pipeline(spark, inbox, tmp_path):
    root = str(tmp_path)
    def run():
        stream = read_event_stream(spark, "parquet", path=inbox, max_files_per_trigger=1)
        q = P.start_bronze(stream, f"{root}/events", f"{root}/dead", f"{root}/cp_b", name="b",
                           trigger=ONCE, ingestion_ts=F.col("timestamp"), audit_path=f"{root}/audit")
        q.awaitTermination()
        s = P.start_silver(read_bronze_stream(spark, f"{root}/events", 10), f"{root}/silver", f"{root}/cp_s",
                           name="s", trigger=ONCE, time_fallback=F.col("ingestion_ts"),
                           audit_path=f"{root}/audit")
        s.awaitTermination()
        return q, s
    return root, run


def test_bronze_and_silver(spark, data, pipeline):
    root, run = pipeline
    q, s = run()
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 4
    parsed = B.parse_events(source.messages(source.ride_events(source.read_events(spark, data))), F.col("timestamp"))
    events, dead = spark.read.parquet(f"{root}/events"), spark.read.parquet(f"{root}/dead")
    assert rows(events.select(*parsed.columns)) == rows(B.accepted(parsed))
    assert rows(dead.select(*parsed.columns, "dead_letter_reason")) == rows(B.rejected(parsed))
    audit = spark.read.parquet(f"{root}/audit").filter("layer = 'bronze'")
    assert audit.agg(F.sum("rows_in")).first()[0] == parsed.count()
    assert audit.agg(F.sum("rows_out")).first()[0] == events.count()
    # Bronze batches follow event time, so merging them gives what one pass gives.
    want = V.silver_from_bronze(B.accepted(parsed), F.col("ingestion_ts")).drop("silver_processed_ts")
    got = read_silver(spark, f"{root}/silver").drop("silver_processed_ts")
    keys = ["ride_id", "event_type"]
    assert got.groupBy(*keys).count().filter("count > 1").isEmpty()
    assert rows(got, *keys) == rows(want, *keys)
    assert rows(got, *keys, "ingestion_ts") == rows(want, *keys, "ingestion_ts")
    # Nothing new: nothing happens.
    before = read_silver_records(spark, f"{root}/silver").count(), events.count()
    run()
    assert (read_silver_records(spark, f"{root}/silver").count(), spark.read.parquet(f"{root}/events").count()) == before


def test_replayed_batch_changes_nothing(spark, tmp_path):
    root, inbox = str(tmp_path), str(tmp_path / "in")
    body = {"ride_id": "R1", "event_type": "ride_requested", "city": "Miami"}
    messages(spark, json.dumps(body), "{bad").write.parquet(inbox)

    def run():
        P.start_bronze(read_event_stream(spark, "parquet", path=inbox), f"{root}/events", f"{root}/dead",
                       f"{root}/cp", name=None, trigger=ONCE, ingestion_ts=F.col("timestamp")).awaitTermination()
    run()
    # The batch was written but its completion was not recorded: Spark runs it again.
    commit = tmp_path / "cp" / "commits"
    for f in commit.iterdir():
        f.unlink()
    run()
    assert spark.read.parquet(f"{root}/events").count() == 1
    assert spark.read.parquet(f"{root}/dead").count() == 1


def test_no_dead_letter_files_without_rejects(spark, tmp_path):
    root, inbox = tmp_path, str(tmp_path / "in")
    messages(spark, json.dumps({"ride_id": "R1", "event_type": "x", "city": "Miami"})).write.parquet(inbox)
    P.start_bronze(read_event_stream(spark, "parquet", path=inbox), f"{root}/events", f"{root}/dead",
                   f"{root}/cp", name=None, trigger=ONCE).awaitTermination()
    assert not (root / "dead").exists() and (root / "events").exists()


def stream_of(spark, tmp_path, *batches):
    """A silver stream that reads one batch per trigger, in order."""
    path = str(tmp_path / "silver_in")
    for i, df in enumerate(batches):
        df.coalesce(1).write.mode("append").parquet(f"{path}/b={i}")
    return spark.readStream.schema(schemas.SILVER).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("aggregate", [G.city_ride_metrics, G.driver_utilization, G.surge_pricing])
def test_stream_equals_batch_on_closed_windows(spark, data, tmp_path, aggregate):
    bronze = B.parse_events(source.messages(source.ride_events(source.read_events(spark, data))), F.col("timestamp"))
    rows_ = V.to_silver(V.clean(B.accepted(bronze), F.col("ingestion_ts"))).orderBy("event_ts").collect()
    cut = len(rows_) // 2
    parts = [spark.createDataFrame(p, schemas.SILVER) for p in (rows_[:cut], rows_[cut:])]
    plan = aggregate(stream_of(spark, tmp_path, *parts))
    root = str(tmp_path)
    P.start_aggregate(plan, f"{root}/out", f"{root}/cp", None, ONCE).awaitTermination()
    got = spark.read.parquet(f"{root}/out").drop("gold_processed_ts")
    want = aggregate(spark.createDataFrame(rows_, schemas.SILVER)).drop("gold_processed_ts")
    extra = got.exceptAll(want.select(*got.columns))
    missing = want.select(*got.columns).exceptAll(got)
    assert extra.isEmpty()
    last = max(r.event_ts for r in rows_)
    slack = timedelta(minutes=10 if aggregate is G.driver_utilization else 5)
    assert missing.filter(F.col("window_end") <= F.lit(last - slack)).isEmpty()
    assert got.count() > 0.8 * want.count()


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    def at(minute, ride):
        return {"ride_id": ride, "event_ts": ts(f"2024-01-15 10:{minute:02}:00")}
    stream = stream_of(
        spark, tmp_path, silver(spark, at(0, "a"), at(20, "b")), silver(spark, at(18, "ok")),
        silver(spark, at(0, "late"), at(17, "late but within")), silver(spark, at(59, "end")))
    root = str(tmp_path)
    P.start_aggregate(G.city_ride_metrics(stream), f"{root}/out", f"{root}/cp", None, ONCE).awaitTermination()
    got = [(r.window_start.minute, r.total_rides) for r in
           spark.read.parquet(f"{root}/out").orderBy("window_start").collect()]
    assert got == [(0, 1), (17, 1), (18, 1), (20, 1)]


def test_gold_run(spark, tmp_path):
    now, root = ts("2024-01-15 05:00:00"), str(tmp_path)
    def on(day, ride, **more):
        return {"ride_id": ride, "event_ts": ts(f"2024-01-{day} 00:02:00"), "event_date": ts(f"2024-01-{day}").date()} | more
    first = silver(spark, on(13, "old"), on(14, "a"), on(14, "b", event_type="driver_assigned"))
    for _ in range(2):  # repeating a run changes nothing
        run_gold(first, root, now)
        city = read_gold(spark, root, "city_ride_metrics")
        assert rows(city, "window_start_date", "total_rides") == [(ts("2024-01-14").date(), 2)]
    # Sliding windows that began before the cutoff are not written.
    assert {r.window_start_date.day for r in read_gold(spark, root, "driver_utilization").collect()} == {14}
    second = silver(spark, on(14, "a", city=None), on(14, "b"), on(14, "c"), on(15, "d"))
    for _ in range(2):
        run_gold(second, root, now, cache=False)
        assert rows(read_gold(spark, root, "city_ride_metrics"), "window_start_date", "city", "total_rides") == sorted([
            (ts("2024-01-14").date(), None, 1), (ts("2024-01-14").date(), "New York", 2),
            (ts("2024-01-15").date(), "New York", 1)], key=repr)


@pytest.mark.parametrize("name, day", [("city_ride_metrics", "window_start_date"), ("funnel_analysis", "event_date")])
def test_stored_aggregates_are_pruned_by_day(spark, tmp_path, name, day):
    run_gold(silver(spark, {"event_ts": ts("2024-01-15 00:02:00"), "event_date": ts("2024-01-15").date()}), str(tmp_path),
             ts("2024-01-15 05:00:00"))
    plan = read_gold(spark, str(tmp_path), name).filter(f"{day} = '2024-01-15'")._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({day}" in plan


def test_progress_rows(spark, tmp_path):
    listener = ProgressLog()
    spark.streams.addListener(listener)
    try:
        stream = stream_of(spark, tmp_path, silver(spark, {}), silver(spark, {"ride_id": "R2"}))
        q = stream.writeStream.format("noop").queryName("watched").option(
            "checkpointLocation", str(tmp_path / "cp")).start()
        q.processAllAvailable()
        running = active_queries(spark).filter("query_name = 'watched'").first()
        assert running.is_active and running.batch_id >= 0 and not running.stopped
        q.stop()
        deadline = 0
        import time
        while deadline < 50 and listener.to_df(spark).filter("stopped").isEmpty():
            time.sleep(0.2)
            deadline += 1
        got = listener.to_df(spark).filter("query_name = 'watched'")
        assert got.count() == 2 and got.filter("stopped").count() == 1
    finally:
        spark.streams.removeListener(listener)


def test_stalled_flag(spark):
    progress = [progress_row("q", n, {"batchId": b, "inputRowsPerSecond": r}) for n, b, r in
                (("early", 5, 0.0), ("stalled", 6, 0.0), ("busy", 6, 3.0), ("nan", 9, float("nan")))]
    df = with_health(spark.createDataFrame(progress, PROGRESS))
    assert {r.query_name for r in df.filter("stalled").collect()} == {"stalled", "nan"}


def test_health_counts_the_rows_and_knows_every_outcome(spark, data):
    got = QUERIES["stream_health"](spark, data)
    n = spark.read.parquet(f"{data}/events.parquet").count()
    assert got.filter("query_name = 'bronze'").agg(F.sum("num_input_rows")).first()[0] == n
    parts = got.filter("query_name LIKE 'partition-%'")
    assert {r.batch_id for r in parts.filter("stalled").collect()} == {6, 8} and {r.batch_id for r in parts.filter("stopped").collect()} == {9}


def test_batches_run_adaptively(spark, tmp_path):
    """Without it a batch that is written by day and city has one task for each pair, however large."""
    seen, before = [], spark.conf.get("spark.sql.adaptive.enabled")
    stream = stream_of(spark, tmp_path, silver(spark, {}))
    P._start(stream, lambda batch, _: seen.append(batch.sparkSession.conf.get("spark.sql.adaptive.enabled")), str(tmp_path / "cp"), None, ONCE).awaitTermination()
    assert seen == ["true"] and spark.conf.get("spark.sql.adaptive.enabled") == before


def test_batches_hold_only_what_they_write(spark, tmp_path, monkeypatch):
    """The raw text of every message was read from bronze, or made anew, and handed over with each batch."""
    root, seen = str(tmp_path), []
    for step in ("deduplicate", "newest_changes"):
        def noting(batch, *more, real=getattr(P, step)):
            seen.append(set(batch.columns))
            return real(batch, *more)
        monkeypatch.setattr(P, step, noting)
    body = {"ride_id": "R1", "event_type": "driver_assigned", "city": "Miami", "driver_id": "D"}
    bronze = B.accepted(B.parse_events(messages(spark, json.dumps(body)), F.col("timestamp")))
    bronze.write.parquet(f"{root}/bronze")
    P.start_silver(read_bronze_stream(spark, f"{root}/bronze"), f"{root}/silver", f"{root}/cp_s", name=None, trigger=ONCE).awaitTermination()
    P.start_gold(read_bronze_stream(spark, f"{root}/bronze"), f"{root}/gold", f"{root}/cp_g", name=None, trigger=ONCE,
                 tables=("surge_pricing",)).awaitTermination()
    assert len(seen) == 2 and not any(x & {"raw_value", "raw_key", "event_timestamp"} for x in seen)
    assert read_silver(spark, f"{root}/silver").first().ride_id == "R1"


def test_kafka_options():
    plain = kafka_options("host:1", group="g")
    assert plain["startingOffsets"] == "earliest" and plain["maxOffsetsPerTrigger"] == "50000"
    assert plain["failOnDataLoss"] == "false" and "kafka.security.protocol" not in plain
    assert kafka_options("host:1", security="SASL_SSL")["kafka.sasl.mechanism"] == "PLAIN"
