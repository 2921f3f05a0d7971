"""Aggregates kept up by retraction, windows closed in streams, and late rows."""

import dataclasses
import json
import os

import pytest
from pyspark.sql import functions as F

from curbside.operators import gold as G
from curbside.operators.retraction import HOUR, KEPT, SIGN
from curbside.sources.streams import read_event_stream
from curbside.operators import bronze as B
from curbside.streaming import pipeline as P
from curbside.streaming import kept as K
from curbside.streaming import windows as W
from curbside.streaming.kept import apply_images, read_kept
from helpers import frame, messages, silver, ts

ONCE = {"availableNow": True}


def event(sign, ride, at, **more):
    row = {"ride_id": ride, "event_ts": ts(f"2024-01-15 {at}"), "event_type": "trip_completed"} | more
    return sign, row


def images(spark, *rows):
    parts = [silver(spark, row).withColumn(SIGN, F.lit(sign)) for sign, row in rows]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def shown(df):
    return sorted((tuple(r) for r in df.drop("gold_processed_ts").collect()), key=repr)


def expected(spark, name, *rows):
    return shown(G.AGGREGATES[name](images(spark, *rows).drop(SIGN)))


A, B1, C = event(1, "A", "10:00:10", fare_amount=50.0), event(1, "B", "10:00:20", fare_amount=20.0), event(1, "C", "12:30:00", fare_amount=7.0)


@pytest.mark.parametrize("name", sorted(KEPT))
def test_withdrawn_records(spark, tmp_path, name):
    root = str(tmp_path)
    kinds = {"surge_pricing": ("ride_requested", "driver_assigned")}.get(name, ("trip_completed", "trip_completed"))
    first = [(1, row | {"event_type": kind}) for (_, row), kind in zip((A, B1, C), (kinds[0], kinds[1], kinds[0]))]
    apply_images(images(spark, *first), root, 0, [name])
    assert shown(read_kept(spark, root, name)) == expected(spark, name, *first)
    # The largest fare goes, a ride moves into another hour.
    moved = (1, first[0][1] | {"event_ts": ts("2024-01-15 11:59:59"), "fare_amount": 5.0})
    apply_images(images(spark, (-1, first[0][1]), moved), root, 1, [name])
    now = [first[1], first[2], moved]
    assert shown(read_kept(spark, root, name)) == expected(spark, name, *now)
    # The same batch once more, as after a failure.
    apply_images(images(spark, (-1, first[0][1]), moved), root, 1, [name])
    assert shown(read_kept(spark, root, name)) == expected(spark, name, *now)
    # Nothing is left in an hour, then something comes back.
    apply_images(images(spark, (-1, moved[1])), root, 2, [name])
    assert shown(read_kept(spark, root, name)) == expected(spark, name, *now[:2])
    for _ in range(2):
        apply_images(images(spark, moved), root, 3, [name])
        assert shown(read_kept(spark, root, name)) == expected(spark, name, *now)
    # Partials that were replaced before the last batch are gone.
    left = {(d.split("batch_id=")[1].split("/")[0], d.split(f"{HOUR}=")[1]) for d, _, _ in os.walk(f"{root}/_partials/{name}/rows") if f"{HOUR}=" in d}
    assert ("0", "2024-01-15-10") not in left and ("1", "2024-01-15-10") in left
    assert sorted(os.listdir(f"{root}/_partials/{name}/versions")) == [f"batch_id={i}" for i in (1, 2, 3)]


def test_a_batch_reads_only_the_hours_it_touches(spark, tmp_path):
    root = str(tmp_path)
    apply_images(images(spark, A, B1, C), root, 0, ["city_ride_metrics"])
    ruined = [os.path.join(d, f) for d, _, files in os.walk(root) for f in files if f"{HOUR}=2024-01-15-12" in d and f.endswith(".parquet")]
    assert len(ruined) >= 2
    kept_bytes = {f: open(f, "rb").read() for f in ruined}
    for f in ruined:
        with open(f, "wb") as file:
            file.write(b"not a parquet file")
    apply_images(images(spark, (-1, A[1]), event(1, "D", "10:01:00")), root, 1, ["city_ride_metrics"])
    for f, raw in kept_bytes.items():
        with open(f, "wb") as file:
            file.write(raw)
    assert shown(read_kept(spark, root, "city_ride_metrics")) == expected(spark, "city_ride_metrics", B1, C, event(1, "D", "10:01:00"))


@pytest.mark.parametrize("name", sorted(KEPT))
def test_sums_are_kept_by_window_and_key_and_members_are_shuffled_once(spark, tmp_path, name):
    """Every ride and fare had all the sums, which were shuffled, written and added up with it."""
    root, kept = str(tmp_path), KEPT[name]
    kind = "driver_assigned" if name == "surge_pricing" else "trip_completed"
    rows = [event(1, ride, "10:00:10", event_type=kind, fare_amount=fare) for ride in "ABC" for fare in (5.0, 6.0)]
    for batch in range(2):
        apply_images(images(spark, *rows), root, batch, [name])
    sums, members = (spark.read.parquet(f"{root}/_partials/{name}/{part}/batch_id=1") for part in ("sums", "rows"))
    assert sums.count() == sums.select("win", *kept.keys).distinct().count()
    assert not set(members.columns) & (set(kept.measures()) - set(kept.counts()))
    before = members.select(*kept.members_of(images(spark, *rows)).columns)
    plan = kept.members_left(before.unionByName(kept.members_of(images(spark, *rows))))._jdf.queryExecution().sparkPlan().toString()
    assert "RebalancePartitions" not in plan and "Repartition" not in plan
    assert shown(read_kept(spark, root, name)) == expected(spark, name, *rows, *rows)


@pytest.mark.parametrize("name", sorted(KEPT))
def test_partials_of_a_batch_are_worked_out_once(spark, tmp_path, monkeypatch, name):
    """Those of a first batch were worked out again when they were written."""
    seen = spark.sparkContext.accumulator(0)

    def counted(parts):
        for part in parts:
            seen.add(part.num_rows)
            yield part

    plain = KEPT[name].of_images
    noting = dataclasses.replace(KEPT[name])
    object.__setattr__(noting, "of_images", lambda images: (lambda more: more.mapInArrow(counted, more.schema))(plain(images)))
    monkeypatch.setitem(K.KEPT, name, noting)
    kinds = ("ride_requested", "driver_assigned") if name == "surge_pricing" else ("trip_completed", "trip_completed")
    rows = [(1, row | {"event_type": kind, "driver_id": d}) for (_, row), kind, d in zip((A, B1), kinds, ("D1", "D2"))]
    more = plain(images(spark, *rows)).count()
    for batch in range(2):
        apply_images(images(spark, *rows), str(tmp_path), batch, [name])
        assert seen.value == more * (batch + 1)


def test_gold_follows_late_corrections(spark, tmp_path):
    """A newer record moves a ride to another day; an older one that arrives later changes nothing."""
    root = str(tmp_path)

    def batch(i, day, ingested):
        body = {"ride_id": "R1", "event_type": "trip_completed", "city": "Miami", "driver_id": "D", "rider_id": "P", "trip_distance": 2.0,
                "fare_amount": 10.0, "surge_multiplier": 1.0, "timestamp": f"2024-01-{day}T10:00:00.000000+00:00"}
        df = messages(spark, json.dumps(body), start=i).withColumn("timestamp", F.lit(ts(f"2024-01-{ingested} 12:00:00")))
        df.coalesce(1).write.mode("append").parquet(f"{root}/in")

    def run():
        records = B.accepted(B.parse_events(read_event_stream(spark, "parquet", path=f"{root}/in"), F.col("timestamp")))
        P.start_gold(records, f"{root}/gold", f"{root}/cp", name=None, trigger=ONCE).awaitTermination()
        return {(r.window_start_date.day, r.completed_rides) for r in read_kept(spark, f"{root}/gold", "city_ride_metrics").collect()}

    batch(0, 15, 15)
    assert run() == {(15, 1)}
    batch(1, 16, 17)
    assert run() == {(16, 1)}
    batch(2, 14, 16)
    assert run() == {(16, 1)}
    assert run() == {(16, 1)}


def test_images_follow_the_newest_record(spark, tmp_path, monkeypatch):
    """Over several full sets, with each batch run twice, as after a failure."""
    monkeypatch.setattr(K, "SPAN", 2)
    newest, state = {}, []

    def record(ride, second, offset, fare):
        return {"ride_id": ride, "event_type": "trip_completed", "fare_amount": fare, "ingestion_ts": ts(f"2024-01-15 10:00:{second:02}"),
                "kafka_offset": offset, "kafka_partition": 0}

    for i in range(7):
        rows = [record(f"R{k % 4}", (i * 7 + k * 5) % 11, i * 10 + k, float(i * 10 + k)) for k in range(i, i + 3)] + [record("R9", i, i, 1.0)] * 2
        want = {}
        for x in rows:
            best = want.get(x["ride_id"], newest.get(x["ride_id"]))
            if best is None or (x["ingestion_ts"], x["kafka_offset"]) > (best["ingestion_ts"], best["kafka_offset"]):
                want[x["ride_id"]] = x
        signed = [(1, x["ride_id"], x["fare_amount"]) for x in want.values()]
        signed += [(-1, k, newest[k]["fare_amount"]) for k in want if k in newest]
        for _ in range(2):
            got = K.newest_changes(frame(spark, K.RECORD, *rows), str(tmp_path), i)
            assert sorted(map(tuple, got.select(SIGN, "ride_id", "fare_amount").collect())) == sorted(signed)
        newest |= want
        state.append(sorted(os.listdir(f"{tmp_path}/images")))
    assert state[-1] == ["batch_id=6"] and os.listdir(f"{tmp_path}/newest") == ["batch_id=5"]


@pytest.mark.parametrize("name", sorted(KEPT))
def test_kept_streams_run_nothing_for_single_keys(spark, tmp_path, name):
    """One call of Python for each key took two to three milliseconds."""
    root = str(tmp_path)
    body = {"ride_id": "R1", "event_type": "driver_assigned", "city": "Miami", "driver_id": "D"}
    messages(spark, json.dumps(body)).write.parquet(f"{root}/in")
    records = B.accepted(B.parse_events(read_event_stream(spark, "parquet", path=f"{root}/in"), F.col("timestamp")))
    query = P.start_gold(records, f"{root}/gold", f"{root}/cp", name=None, trigger=ONCE, tables=(name,))
    query.awaitTermination()
    assert [p["stateOperators"] for p in query.recentProgress if p["numInputRows"]] == [[]]


def test_only_one_type_is_remembered_and_all_move_the_watermark(spark, tmp_path):
    """The demand of a stream keeps the keys of requests only; a late trip end still closes their windows."""
    root = str(tmp_path)

    def batch(i, *events):
        bodies = [json.dumps({"ride_id": f"R{i}{n}", "event_type": kind, "city": "Miami", "driver_id": "D", "rider_id": "P", "trip_distance": 2.0,
                              "fare_amount": 10.0, "surge_multiplier": 1.0, "timestamp": f"2024-01-15T{at}.000000+00:00"}) for n, (kind, at) in enumerate(events)]
        messages(spark, *bodies, start=10 * i).coalesce(1).write.parquet(f"{root}/in/b={i}")

    batch(0, ("ride_requested", "10:00:10"), ("driver_assigned", "10:00:20"), ("trip_started", "10:00:30"))
    batch(1, ("trip_completed", "10:30:00"))
    records = B.accepted(B.parse_events(read_event_stream(spark, "parquet", path=f"{root}/in", max_files_per_trigger=1), F.col("timestamp")))
    query = P.start_aggregate(W.demand_with_supply(records, records), f"{root}/out", f"{root}/cp", None, ONCE)
    query.awaitTermination()
    got = spark.read.parquet(f"{root}/out").collect()
    assert [(r.ride_requests, r.drivers_active) for r in got] == [(1, 1)]
    kept = max(sum(s["numRowsTotal"] for s in p["stateOperators"] if s["operatorName"] == "dedupeWithinWatermark") for p in query.recentProgress)
    assert kept == 2
