"""Random small tables against plain Python."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curbside.operators import gold as G
from curbside.operators import silver as V
from curbside.operators import upsert as U
from curbside.operators.changes import CHANGE, changes_between
from helpers import bronze, silver, ts
from datetime import timedelta

SCHEMA = "k string, e string, v int, at int"
FEW = settings(max_examples=8, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
KEY = st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from(["x", "y"]))
VALUE = st.tuples(st.integers(0, 3), st.integers(0, 3))


def table(draw_keys):
    """Rows with unique keys, and any number of rows without one."""
    return st.tuples(st.dictionaries(draw_keys, VALUE, max_size=6), st.lists(VALUE, max_size=3))


TABLE = table(KEY)


def to_rows(t):
    keyed = [(*k, *v) for k, v in t[0].items()]
    return keyed + [(None, "x", *v) for v in t[1]]


def make(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def bag(df):
    return Counter(map(tuple, df.collect()))


@FEW
@given(TABLE, TABLE, st.booleans(), st.booleans())
def test_merge(spark, target, source, insert, delete):
    t, s = to_rows(target), to_rows(source)
    index = {r[:2]: r for r in s if r[0] is not None}
    matched = {r[:2] for r in t if r[:2] in index}
    want = []
    for r in t:
        if r[:2] not in index:
            want += [] if delete else [r]
        else:
            want.append(index[r[:2]] if index[r[:2]][3] > r[3] else r)
    if insert:
        want += [r for r in s if r[:2] not in matched]
    got = U.merge_upsert(make(spark, t), make(spark, s), ["k", "e"], when="s.at > t.at",
                         insert=insert, delete_unmatched_target=delete)
    assert bag(got) == Counter(want)


@FEW
@given(TABLE, TABLE)
def test_change_feed_accounts_for_every_row(spark, old, new):
    a, b = to_rows(old), to_rows(new)
    feed = changes_between(make(spark, a), make(spark, b), ["k", "e"], null_keys=True).collect()
    out = Counter(tuple(r)[:4] for r in feed if r[CHANGE] in ("delete", "update_preimage"))
    come = Counter(tuple(r)[:4] for r in feed if r[CHANGE] in ("insert", "update_postimage"))
    assert Counter(a) - out + come == Counter(b)
    assert not out & come
    pre = Counter(r[:2] for r in feed if r[CHANGE] == "update_preimage")
    assert pre == Counter(r[:2] for r in feed if r[CHANGE] == "update_postimage")


@FEW
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 2), st.integers(0, 9)), min_size=1, max_size=15))
def test_deduplicate(spark, events):
    start = ts("2024-01-15 10:00:00")
    rows = [{"ride_id": r, "ingestion_ts": start + timedelta(seconds=s), "kafka_offset": o} for r, s, o in events]
    got = {(r.ride_id, (r.ingestion_ts - start.replace(tzinfo=None)).seconds, r.kafka_offset)
           for r in V.deduplicate(bronze(spark, *rows)).collect()}
    assert got == {(k, *max((s, o) for r, s, o in events if r == k)) for k in {e[0] for e in events}}


@FEW
@given(st.lists(st.tuples(st.sampled_from(["R1", "R2", "R3"]), st.sampled_from(["D1", "D2"]),
                          st.sampled_from(["ride_requested", "driver_assigned", "trip_completed"]),
                          st.integers(0, 20), st.integers(1, 9)), min_size=1, max_size=20))
def test_windows(spark, events):
    start = ts("2024-01-15 10:00:00")
    df = silver(spark, *[
        {"ride_id": r, "driver_id": d, "event_type": e, "event_ts": start + timedelta(minutes=m), "fare_amount": float(f)}
        for r, d, e, m, f in events])
    city = {r.window_start.minute: (r.total_rides, r.unique_rides, r.max_fare) for r in G.city_ride_metrics(df).collect()}
    for minute in {e[3] for e in events}:
        here = [e for e in events if e[3] == minute]
        assert city[minute] == (len(here), len({e[0] for e in here}), max(e[4] for e in here))
    assert len(city) == len({e[3] for e in events})
    drivers = {(r.driver_id, int((r.window_start - start.replace(tzinfo=None)).total_seconds() // 60)): r.unique_rides
               for r in G.driver_utilization(df).collect()}
    want = {}
    for r, d, _, m, _ in events:
        for w in range(m // 5 * 5 - 10, m + 1, 5):
            want.setdefault((d, w), set()).add(r)
    assert drivers == {k: len(v) for k, v in want.items()}
    surge = {r.window_start.minute: (r.ride_requests, r.drivers_active) for r in G.surge_pricing(df).collect()}
    for w in range(0, 25, 5):
        here = [e for e in events if w <= e[3] < w + 5]
        asked = sum(e[2] == "ride_requested" for e in here)
        active = len({e[1] for e in here if e[2] == "driver_assigned"})
        assert surge.get(w) == ((asked, active) if asked else None)
