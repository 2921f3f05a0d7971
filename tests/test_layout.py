"""Validity intervals, bucketed upserts, lookups, clustering, rescued fields, catalog and triggers."""

import json
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from curbside import settings as S
from curbside.operators import bronze as B
from curbside.operators import history as H
from curbside.operators import silver as V
from curbside.operators import upsert
from curbside.plans import catalog
from curbside.plans.catalog import QUERIES, Inputs
from curbside.sources import rides as source
from curbside.sources.sinks import append_evolving, look_up, read_evolving, write_lookup, z_clustered
from curbside.sources.streams import read_bronze_stream, read_event_stream
from curbside.sources.tables import save_bucketed, table_detail, table_stats
from curbside.streaming import pipeline as P
from helpers import bronze, messages, silver, ts


def rows(df, *cols):
    return sorted(map(tuple, df.select(*(cols or df.columns)).collect()), key=repr)


def test_intervals_give_every_state(spark, data, tmp_path):
    parsed = B.parse_events(source.messages(source.ride_events(source.read_events(spark, data))), F.col("timestamp")).persist()
    fallback = F.col("ingestion_ts")
    H.store_intervals(H.validity_intervals(parsed, fallback), str(tmp_path / "held"))
    held = H.read_intervals(spark, str(tmp_path / "held"))
    first, last = parsed.agg(F.min("ingestion_ts"), F.max("ingestion_ts")).first()
    instants = [first - timedelta(hours=1), first, first + (last - first) / 3, first + (last - first) / 2, last, last + timedelta(days=3)]
    table = spark.createDataFrame([(x, i) for i, x in enumerate(instants)], "at timestamp, i int")
    states = H.states_at(held, table).persist()
    for i, x in enumerate(instants):
        want = H.silver_as_of(parsed, x, fallback)
        keep = [c for c in want.columns if c != "silver_processed_ts"]
        assert rows(states.filter(F.col("i") == i), *keep) == rows(want, *keep)
    assert states.filter("i = 0").isEmpty() and H.counts_at(held, table, "i").count() == states.select("i").distinct().count() > 3
    plan = H.counts_at(held, table, "i")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    parsed.unpersist()
    states.unpersist()


def test_intervals_of_ties(spark):
    at = lambda m: {"ingestion_ts": ts(f"2024-01-15 10:{m:02}:00")}
    frame = bronze(spark, at(1) | {"kafka_offset": 1}, at(1) | {"kafka_offset": 2, "city": "Miami"}, at(5) | {"kafka_offset": 0}, at(3) | {"ride_id": None})
    got = rows(H.validity_intervals(frame), "city", "valid_from", "valid_to")
    one, five = at(1)["ingestion_ts"].replace(tzinfo=None), at(5)["ingestion_ts"].replace(tzinfo=None)
    assert got == sorted([("Miami", one, five), ("New York", five, None)], key=repr)
    assert H.states_at(H.validity_intervals(frame), spark.createDataFrame([], "at timestamp")).isEmpty()


def ancestors(plan: str, name: str) -> list[list[str]]:
    """For each line of a plan that names something, the operators above it."""
    depth = lambda x: len(x) - len(x.lstrip(" :+-*(0123456789)"))
    lines = [x for x in plan.splitlines() if x.strip()]
    out = []
    for i, line in enumerate(lines):
        if name in line and "Scan" in line:
            above, level = [], depth(line)
            for other in reversed(lines[:i]):
                if depth(other) < level:
                    level = depth(other)
                    above.append(other)
            out.append(above)
    return out


def test_an_upsert_leaves_the_buckets_where_they_are(spark, tmp_path):
    state = silver(spark, *({"ride_id": f"R{i}"} for i in range(40)))
    batch = silver(spark, *({"ride_id": f"R{i}", "city": "Miami", "ingestion_ts": ts("2024-01-16 00:00:00")} for i in range(30, 50)))
    table = save_bucketed(state, "bucketed_state", S.SILVER_KEYS, 8, str(tmp_path / "state"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        merged = upsert.merge_newer(table, batch, S.SILVER_KEYS, source_is_unique=True)
        found = ancestors(merged._jdf.queryExecution().executedPlan().toString(), "bucketed_state")
        assert len(found) == 2
        for above in found:
            join = next(i for i, x in enumerate(above) if "Join" in x)
            assert not any("Exchange" in x for x in above[:join])
        assert rows(merged, "ride_id", "city") == rows(upsert.merge_newer(state, batch, S.SILVER_KEYS, source_is_unique=True), "ride_id", "city")
        assert merged.count() == 50 and merged.filter("city = 'Miami'").count() == 20
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sql("DROP TABLE bucketed_state")


def rows_scanned(df):
    """Rows that the scans of a plan gave, after it ran."""
    df.collect()

    def visit(plan):
        name = plan.nodeName()
        here = plan.metrics().apply("numOutputRows").value() if name.startswith("Scan parquet") else 0
        children = plan.children()
        return here + sum(visit(children.apply(i)) for i in range(children.size()))

    return visit(df._jdf.queryExecution().executedPlan())


def test_lookups_skip_row_groups(spark, tmp_path):
    table = spark.range(0, 200_000).select(F.sha1(F.col("id").cast("string")).alias("ride_id"), "id", (F.col("id") % 2).alias("part"), F.lit("x" * 20).alias("pad"))
    plain, fast = str(tmp_path / "plain"), str(tmp_path / "fast")
    table.write.partitionBy("part").parquet(plain)
    write_lookup(table, fast, "ride_id", ["part"], row_group_bytes=256 << 10)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        key = table.filter("id = 77777").first().ride_id
        one = lambda path: spark.read.parquet(path).filter((F.col("ride_id") == key) & (F.col("part") == 1))
        assert [r.id for r in one(fast).collect()] == [77777] == [r.id for r in one(plain).collect()]
        assert rows_scanned(one(fast)) * 5 < rows_scanned(one(plain))
        wanted = table.filter("id IN (5, 77777, 123456, 500000)").select("ride_id").union(spark.createDataFrame([("none",), (None,)], "ride_id string"))
        few = look_up(spark.read.parquet(fast), wanted, "ride_id")
        assert set(rows(few, "id")) == {(5,), (77777,), (123456,)} and rows_scanned(few) * 2 < 200_000
        many = look_up(spark.read.parquet(fast), wanted, "ride_id", most=1)
        assert rows(many, "id") == rows(few, "id") and many.columns == few.columns
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_clustering_by_several_columns(spark):
    frame = spark.range(4000).select(F.concat(F.lit("R-"), F.hash("id").cast("string")).alias("a"), F.pmod(F.hash("id", F.lit(1)), F.lit(50)).alias("b"),
                                     F.when(F.col("id") % 9 > 0, F.pmod(F.hash("id", F.lit(2)), F.lit(1000))).alias("c"))
    out = z_clustered(frame, ["a", "b", "c"], files=16)
    assert rows(out) == rows(frame)
    parts = out.groupBy(F.spark_partition_id().alias("p")).agg(F.min("b").alias("b0"), F.max("b").alias("b1"), F.min("c").alias("c0"), F.max("c").alias("c1")).collect()
    # A lookup by either column finds about half of the files or fewer to read.
    assert sum(r.b0 <= 10 <= r.b1 for r in parts) <= 0.7 * len(parts) and sum(r.c0 is not None and r.c0 <= 900 <= r.c1 for r in parts) <= 0.7 * len(parts)
    empty = z_clustered(frame.limit(0), ["a", "b"], files=2)
    assert empty.collect() == []


def jobs_of(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_clustering_measures_all_columns_at_once(spark):
    frame = spark.range(1000).select(*(F.concat(F.lit(x), F.hash("id", F.lit(ord(x))).cast("string")).alias(x) for x in "abcdef"))
    assert jobs_of(spark, "six", lambda: z_clustered(frame, list("abcdef"), 4)) == jobs_of(spark, "one", lambda: z_clustered(frame, ["a"], 4))


@pytest.mark.parametrize("name", ["catalog_rows", "table_stats"])
def test_layers_are_parsed_once(spark, data, name, monkeypatch):
    """Each layer used to parse all messages anew, seven times in all."""
    seen, parse = [], Inputs.parsed.fget
    monkeypatch.setattr(Inputs, "parsed", property(lambda self: seen.append(1) or parse(self)))
    QUERIES[name](spark, data)
    assert seen == [1]


def test_clustering_reads_stored_rows(spark, data, monkeypatch):
    read = []
    monkeypatch.setattr(catalog, "z_clustered", lambda df, *args, **more: read.extend(df.inputFiles()) or z_clustered(df, *args, **more))
    QUERIES["cluster_skipping"](spark, data)
    assert read and not any(x.endswith("/events.parquet") for x in read)


def test_rescued_fields(spark, tmp_path):
    known = {"ride_id": "R1", "event_type": "x", "city": "Miami"}
    parsed = B.parse_rescued(messages(spark, json.dumps(known), json.dumps(known | {"tip": 2.5, "app": {"v": [1, 2]}, "note": None}), "{bad", "[]", None))
    got = [tuple(r) for r in parsed.orderBy("kafka_offset").select(
        F.try_variant_get("rescued", "$.tip", "double"), F.try_variant_get("rescued", "$.app.v[1]", "int"), F.col("rescued").isNull()).collect()]
    assert got == [(None, None, True), (2.5, 2, False), (None, None, True), (None, None, True), (None, None, True)]
    path = str(tmp_path / "t")
    append_evolving(parsed.drop("rescued"), path)
    append_evolving(parsed, path)
    again = read_evolving(spark, path)
    assert again.filter("rescued IS NOT NULL").count() == 1 and again.count() == 10


def test_table_detail_and_stats(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = silver(spark, *({"ride_id": f"R{i}"} for i in range(7)))
    frame.repartition(3).write.parquet(path)
    stored = spark.read.parquet(path)
    detail = table_detail({"a": stored}).first()
    files = [x for x in (tmp_path / "t").iterdir() if x.suffix == ".parquet"]
    assert (detail.num_files, detail.row_count, detail.size_in_bytes) == (len(files), 7, sum(x.stat().st_size for x in files))
    assert rows(table_stats({"a": (stored, "event_ts"), "b": (stored.limit(0), "event_date")})) == [
        ("a", 7, ts("2024-01-15 10:00:00").replace(tzinfo=None)), ("b", 0, None)]


def test_processing_time_trigger_and_restart(spark, tmp_path):
    root = str(tmp_path)
    body = lambda i: json.dumps({"ride_id": f"R{i}", "event_type": "ride_requested", "city": "Miami"})

    def run():
        query = P.start_bronze(read_event_stream(spark, "parquet", path=f"{root}/in"), f"{root}/events", f"{root}/dead", f"{root}/cp",
                               name="restarted", trigger={"processingTime": "0 seconds"})
        query.processAllAvailable()
        active = [q.name for q in spark.streams.active]
        query.stop()
        return active

    messages(spark, body(1)).write.mode("append").parquet(f"{root}/in")
    assert run() == ["restarted"]
    time.sleep(0.1)
    messages(spark, body(2), start=1).write.mode("append").parquet(f"{root}/in")
    run()
    assert rows(spark.read.parquet(f"{root}/events"), "ride_id") == [("R1",), ("R2",)]
    assert read_bronze_stream(spark, f"{root}/events").isStreaming
    assert V.silver_from_bronze(spark.read.parquet(f"{root}/events")).count() == 2
