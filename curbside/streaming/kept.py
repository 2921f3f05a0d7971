"""Stored aggregates that each micro-batch changes in the hours that it touches.

Below ``root`` lie, for each aggregate, its rows by day and hour, and the partials that they follow
from: sums, and members as ``rows``. Partials are kept in versions, one folder for each batch with the hours
it touched, and the table of versions names for every hour the batch whose partials hold. A batch reads the versions
before it and writes its own, so one that is replayed after a failure gives the same again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbside import schemas
from curbside import settings as S
from curbside.operators.retraction import HOUR, KEPT, SIGN, Partials
from curbside.operators.silver import NEWEST_FIRST, deduplicate
from curbside.session import remove

#: What of a record the kept aggregates need; its event time among them.
IMAGE = T.StructType([f for f in schemas.SILVER if f.name in (
    "ride_id", "driver_id", "city", "event_type", "trip_distance", "fare_amount", "net_fare", "surge_multiplier", "event_ts",
    "has_data_quality_issue")])
#: And what tells which record of a key is the newest.
RECORD = T.StructType([*IMAGE, *(schemas.BRONZE[x] for x in NEWEST_FIRST)])
SIGNED = T.StructType([T.StructField(SIGN, T.IntegerType()), *RECORD])
#: Batches after which all newest records are written as one set.
SPAN = 10
VERSIONS = "hour string, batch_id long, filled boolean"
MEMBERS, SUMS = "rows", "sums"


def newest_changes(cleaned: DataFrame, root: str, batch_id: int) -> DataFrame:
    """The images, with ``sign``, that a batch of cleaned records gives: the newest of each key counts.

    A record older than the one that counts gives nothing, whenever it arrives. Below ``root`` lie
    the images of each batch, and all newest records after each ``SPAN``th. A batch looks its keys up
    in those before it and writes its own, so one that is replayed after a failure gives the same again.
    """
    spark = cleaned.sparkSession
    history = read_newest(spark, root, batch_id)
    fresh = deduplicate(cleaned.select(*RECORD.names))
    if history is not None:
        fresh.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _images(fresh, history).write.mode("overwrite").parquet(_batch(root, "images", batch_id))
        if (batch_id + 1) % SPAN == 0:
            own = _read_images(spark, root, [batch_id])
            deduplicate(history.unionByName(own) if history else own).write.mode("overwrite").parquet(_batch(root, "newest", batch_id))
        if batch_id % SPAN == 0:
            for x in range(batch_id - SPAN, batch_id):
                remove(spark, _batch(root, "images", x))
            remove(spark, _batch(root, "newest", batch_id - SPAN - 1))
    finally:
        fresh.unpersist()
    return spark.read.schema(SIGNED).parquet(_batch(root, "images", batch_id)).select(SIGN, *IMAGE.names)


def _images(fresh: DataFrame, history: DataFrame | None) -> DataFrame:
    """A first batch has nothing to look its records up in."""
    if history is None:
        return fresh.select(F.lit(1).alias(SIGN), "*")
    before = deduplicate(history.join(fresh.select(*S.SILVER_KEYS), list(S.SILVER_KEYS), "left_semi"))
    pairs = _packed(fresh, "after").join(_packed(before, "before"), list(S.SILVER_KEYS), "left").filter(
        F.col("before").isNull() | (_place("after") > _place("before")))
    both = F.array(*(F.struct(F.lit(sign).alias(SIGN), F.col(x).alias("r")) for sign, x in ((-1, "before"), (1, "after"))))
    return pairs.select(F.inline(both)).filter("r IS NOT NULL").select(SIGN, "r.*")


def _packed(records: DataFrame, name: str) -> DataFrame:
    return records.select(*S.SILVER_KEYS, F.struct(*RECORD.names).alias(name))


def _place(name: str) -> Column:
    return F.struct(*(F.col(name)[x] for x in NEWEST_FIRST))


def read_newest(spark: SparkSession, root: str, batch_id: int) -> DataFrame | None:
    """The records that counted at some time since the last full set before a batch; the newest of a key counts now.

    None before the first batch.
    """
    first = batch_id - batch_id % SPAN
    found = [spark.read.schema(RECORD).parquet(_batch(root, "newest", first - 1))] if first else []
    if batch_id > first:
        found.append(_read_images(spark, root, range(first, batch_id)))
    return reduce(DataFrame.unionByName, found) if found else None


def _read_images(spark: SparkSession, root: str, batches: Iterable[int]) -> DataFrame:
    paths = [_batch(root, "images", x) for x in batches]
    return spark.read.schema(SIGNED).parquet(*paths).filter(F.col(SIGN) > 0).select(*RECORD.names)


def apply_images(images: DataFrame, root: str, batch_id: int, tables: Sequence[str] = tuple(KEPT)) -> None:
    """Adds a batch of images to the stored partials and writes the aggregates of the touched hours anew.

    Images are read twice for each table: pass stored or persisted ones.
    """
    for table in tables:
        _apply(images, f"{root}/{table}", f"{root}/_partials/{table}", batch_id, KEPT[table])


def _apply(images: DataFrame, path: str, partials_path: str, batch_id: int, kept: Partials) -> None:
    spark = images.sparkSession
    more, members = kept.of_images(images).persist(StorageLevel.MEMORY_AND_DISK), kept.members_of(images)
    try:
        touched = hours_of(more)
        versions = read_versions(spark, partials_path, batch_id - 1)
        earlier = versions.filter(F.col(HOUR).isin(touched) & F.col("filled")).collect()
        sums = kept.added(read_partials(spark, partials_path, SUMS, more, earlier), more) if earlier else more
        if earlier:
            members = members.unionByName(read_partials(spark, partials_path, MEMBERS, members, earlier))
        all_sums = _stored(sums.hint("rebalance", HOUR), _batch(partials_path, SUMS, batch_id))
        # Members are shuffled once: each task writes the hours that it has.
        all_members = _stored(kept.members_left(members), _batch(partials_path, MEMBERS, batch_id))
        filled = hours_of(all_members)
        rows = kept.aggregate(all_sums, all_members).persist(StorageLevel.MEMORY_AND_DISK)
        rows.hint("rebalance", "window_start_date", HOUR).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "window_start_date", HOUR).parquet(path)
        for hour in set(touched).difference(hours_of(rows)):
            remove(spark, f"{path}/window_start_date={hour[:10]}/{HOUR}={hour}")
        rows.unpersist()
        own = more.select(HOUR, F.lit(batch_id).cast("long").alias("batch_id"), F.col(HOUR).isin(filled).alias("filled")).distinct()
        versions.filter(~F.col(HOUR).isin(touched)).unionAll(own).coalesce(1).write.mode("overwrite").parquet(
            _batch(partials_path, "versions", batch_id))
        remove_replaced(spark, partials_path, batch_id)
    finally:
        more.unpersist()


def _stored(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(HOUR).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def remove_replaced(spark: SparkSession, partials_path: str, batch_id: int) -> None:
    """Removes what the batch before this one replaced: a replay of this one reads what that one left."""
    if batch_id < 2:
        return
    older, newer = ({(r.hour, r.batch_id) for r in read_versions(spark, partials_path, x).collect()} for x in (batch_id - 2, batch_id - 1))
    for hour, batch in older - newer:
        for part in (MEMBERS, SUMS):
            remove(spark, f"{_batch(partials_path, part, batch)}/{HOUR}={hour}")
    remove(spark, _batch(partials_path, "versions", batch_id - 3))


def hours_of(rows: DataFrame) -> list[str]:
    """As many as there are hours that a batch touches."""
    return [r[0] for r in rows.select(HOUR).distinct().collect()]


def _batch(path: str, part: str, batch_id: int) -> str:
    return f"{path}/{part}/batch_id={batch_id}"


def read_versions(spark: SparkSession, partials_path: str, batch_id: int) -> DataFrame:
    """(hour, batch_id, filled) as a batch left it: as many rows as there are hours."""
    if batch_id < 0:
        return spark.range(0).selectExpr("cast(NULL AS string) AS hour", "id AS batch_id", "false AS filled")
    return spark.read.schema(VERSIONS).parquet(_batch(partials_path, "versions", batch_id))


def read_partials(spark: SparkSession, partials_path: str, part: str, like: DataFrame, versions: Sequence[Row]) -> DataFrame:
    """The sums or members of some hours. Only their folders are listed and read."""
    paths = [f"{_batch(partials_path, part, r.batch_id)}/{HOUR}={r.hour}" for r in versions]
    schema = T.StructType([*(f for f in like.schema if f.name != HOUR), T.StructField(HOUR, T.StringType())])
    return spark.read.schema(schema).option("basePath", f"{partials_path}/{part}").parquet(*paths).select(*like.columns)


def read_kept(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A kept aggregate; a filter on its day reads the partitions of these days only."""
    schema = schemas.GOLD[table]
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(HOUR, T.StringType())])).parquet(f"{root}/{table}").select(*schema.names)
