import pytest
from pyspark.sql import functions as F

from curbside.operators import upsert as U
from curbside.operators.changes import apply_changes, changes_between
from helpers import naive, physical_plan, silver, ts

OLD, NEW = ts("2024-01-15 10:00:00"), ts("2024-01-15 11:00:00")
SCHEMA = "k string, e string, v int, at int"
KEYS = ["k", "e"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def merge(spark, target, source, **options):
    return U.merge_upsert(
        spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA), KEYS, **options)


def test_newer_wins(spark):
    target = [("older", "x", 1, 5), ("equal", "x", 1, 5), ("newer", "x", 1, 5), ("only", "x", 1, 5)]
    source = [("older", "x", 2, 4), ("equal", "x", 2, 5), ("newer", "x", 2, 6), ("fresh", "x", 2, 1)]
    got = rows(merge(spark, target, source, when="s.at > t.at"))
    assert got == [("equal", "x", 1, 5), ("fresh", "x", 2, 1), ("newer", "x", 2, 6),
                   ("older", "x", 1, 5), ("only", "x", 1, 5)]


def test_null_keys_match_nothing(spark):
    got = rows(merge(spark, [(None, "x", 1, 1), ("a", None, 1, 1)], [(None, "x", 2, 2), ("a", None, 2, 2)]))
    assert len(got) == 4


def test_ambiguous_source(spark):
    with pytest.raises(Exception, match="several source rows match one target row: a, x"):
        merge(spark, [("a", "x", 1, 1)], [("a", "x", 2, 2), ("a", "x", 3, 3)]).collect()
    # Repeated keys that match nothing are inserted, as MERGE does.
    assert len(rows(merge(spark, [("b", "x", 1, 1)], [("a", "x", 2, 2), ("a", "x", 3, 3)]))) == 3


def test_ambiguous_source_fails_under_filters_and_counts(spark):
    bad = merge(spark, [("a", "x", 1, 1)], [("a", "x", 2, 2), ("a", "x", 3, 3)])
    with pytest.raises(Exception, match="several source rows"):
        bad.count()
    good = merge(spark, [("a", "x", 1, 1)], [("a", "x", 2, 2), ("c", "x", 3, 3), ("c", "x", 3, 3)])
    assert good.filter("k is not null and v > 0").count() == 3


def test_idempotent(spark):
    target, source = [("a", "x", 1, 1)], [("a", "x", 2, 2), ("b", "x", 3, 3)]
    once = merge(spark, target, source)
    again = U.merge_upsert(once, spark.createDataFrame(source, SCHEMA), KEYS)
    assert rows(once) == rows(again) == [("a", "x", 2, 2), ("b", "x", 3, 3)]


def test_update_only_and_chosen_columns(spark):
    got = rows(merge(spark, [("a", "x", 1, 1)], [("a", "x", 7, 9), ("b", "x", 3, 3)],
                     set={"v": "s.v + t.v"}, insert=False))
    assert got == [("a", "x", 8, 1)]
    with pytest.raises(ValueError):
        merge(spark, [("a", "x", 1, 1)], [], set={"nope": F.lit(1)})


def test_delete_unmatched(spark):
    got = rows(merge(spark, [("a", "x", 1, 1), ("b", "x", 1, 1), (None, "x", 1, 1)],
                     [("a", "x", 2, 2), ("c", "x", 3, 3)], delete_unmatched_target=True))
    assert got == [("a", "x", 2, 2), ("c", "x", 3, 3)]


def test_many_target_rows_per_source_row(spark):
    df = silver(spark, {"ride_id": "R1"}, {"ride_id": "R2"}, {"ride_id": "R3", "driver_id": "D9"})
    updates = spark.createDataFrame([("D1", df.first().event_date, "Miami", "trip_started")],
                                    "driver_id string, event_date date, city string, event_type string")
    got = U.sync_drivers(df, updates).collect()
    assert sorted((r.ride_id, r.city, r.event_type) for r in got) == [
        ("R1", "Miami", "trip_started"), ("R2", "Miami", "trip_started")]


def test_small_source_is_not_shuffled_against_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("cast(id as string) k", "'x' e", "1 v", "1 at").write.parquet(path)
    target, source = spark.read.parquet(path), spark.createDataFrame([("5", "x", 2, 2)], SCHEMA)
    merged = U.merge_upsert(target, source.hint("broadcast"), KEYS, source_is_unique=True)
    assert merged.filter("v = 2").count() == 1 and merged.count() == 1000
    assert "BroadcastHashJoin" in physical_plan(merged)


def test_fare_correction(spark):
    df = silver(spark, {"fare_amount": 6000.0, "dq_fare_out_of_range": True, "has_data_quality_issue": True},
                {"ride_id": "R2", "fare_amount": 6000.0, "dq_fare_out_of_range": True, "city": "Miami"},
                {"ride_id": "R3"})
    got = {r.ride_id: r for r in U.correct_fares(df, F.col("city") == "New York", 1.1, 0.82).collect()}
    assert (round(got["R1"].fare_amount, 6), got["R1"].net_fare) == (6600.0, 5412.0)
    assert got["R1"].dq_fare_out_of_range is False and got["R1"].has_data_quality_issue is False
    assert got["R2"].fare_amount == 6000.0 and got["R3"].fare_amount == 20.0 and len(got) == 3


def test_silver_merge_updates_all_columns(spark):
    target = silver(spark, {"ingestion_ts": OLD, "dq_fare_out_of_range": True})
    source = silver(spark, {"ingestion_ts": NEW, "dq_fare_out_of_range": False, "city": "Miami"})
    row = U.merge_newer(target, source, ["ride_id", "event_type"]).first()
    assert (row.dq_fare_out_of_range, row.city, row.ingestion_ts) == (False, "Miami", naive("2024-01-15 11:00:00"))


def test_changes(spark):
    old = spark.createDataFrame([("a", "x", 1, 1), ("b", "x", 1, None), ("c", "x", 1, 1)], SCHEMA)
    new = spark.createDataFrame([("a", "x", 2, 1), ("b", "x", 1, None), ("d", "x", 1, 1)], SCHEMA)
    feed = changes_between(old, new, KEYS)
    assert rows(feed) == [
        ("a", "x", 1, 1, "update_preimage"), ("a", "x", 2, 1, "update_postimage"),
        ("c", "x", 1, 1, "delete"), ("d", "x", 1, 1, "insert")]
    assert rows(apply_changes(old, feed, KEYS)) == rows(new)


def test_changes_of_rows_without_a_key(spark):
    old = spark.createDataFrame([(None, "x", 1, 1)] * 3 + [(None, "x", 2, 2)], SCHEMA)
    new = spark.createDataFrame([(None, "x", 1, 1)] + [(None, "x", 3, 3)] * 2, SCHEMA)
    kinds = [r[-1] for r in rows(changes_between(old, new, KEYS, null_keys=True))]
    assert sorted(kinds) == ["delete"] * 3 + ["insert"] * 2


def test_many_copies_without_a_key(spark):
    old = spark.createDataFrame([(None, "x", 1, 1)], SCHEMA)
    new = spark.range(25001).selectExpr("cast(null as string) k", "'x' e", "1 v", "1 at")
    feed = changes_between(old, new, KEYS, null_keys=True)
    assert [tuple(r) for r in feed.groupBy("_change_type", "v").count().collect()] == [("insert", 1, 25000)]
    assert changes_between(new, new, KEYS, null_keys=True).isEmpty()


def test_changes_need_unique_keys(spark):
    one = spark.createDataFrame([("a", "x", 1, 1)], SCHEMA)
    for bad in ([("a", "x", 1, 1), ("a", "x", 2, 2)], [(None, "x", 1, 1)]):
        with pytest.raises(Exception, match="a key is NULL or repeated"):
            changes_between(one, spark.createDataFrame(bad, SCHEMA), KEYS).collect()


def test_one_scan_for_each_input(spark, tmp_path):
    silver(spark, {}, {"ride_id": "R2"}).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    fixed = U.correct_fares(stored, F.col("city") == "New York", 1.1, 0.82)
    assert physical_plan(fixed).count("FileScan") == 1
    assert physical_plan(changes_between(stored, stored, ["ride_id", "event_type"])).count("FileScan") == 2
