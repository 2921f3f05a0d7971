"""Row changes between two states of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHANGE = "_change_type"
COPIES = 10_000


def changes_between(old: DataFrame, new: DataFrame, keys: Sequence[str], null_keys: bool = False) -> DataFrame:
    """Inserts, deletes and both images of updates; unchanged rows give nothing.

    Each side is read once. A key that one side holds twice raises an error. Rows with a NULL
    key have no identity: with ``null_keys`` equal ones cancel out and the rest are deletes and
    inserts, which reads both sides once more; without, they raise an error too.
    """
    names = old.columns
    new = new.select(*names)
    if not null_keys:
        return _keyed_changes(old, new, keys, names)
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return _keyed_changes(old.filter(keyed), new.filter(keyed), keys, names).unionAll(
        _unkeyed_changes(old.filter(~keyed), new.filter(~keyed), names))


def _keyed_changes(old: DataFrame, new: DataFrame, keys: Sequence[str], names: list[str]):
    row = F.struct(*names)
    sides = old.select(*keys, row.alias("row"), F.lit(True).alias("was")).unionAll(
        new.select(*keys, row.alias("row"), F.lit(False).alias("was")))
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    both = sides.groupBy(*keys).agg(
        F.max(F.when(F.col("was"), F.col("row"))).alias("before"),
        F.max(F.when(~F.col("was"), F.col("row"))).alias("after"),
        F.greatest(F.count_if("was"), F.count_if(~F.col("was"))).alias("copies"),
    ).withColumn("fault", F.when((F.col("copies") > 1) | ~known, F.raise_error(F.concat(
        F.lit("a key is NULL or repeated: "),
        F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])))))
    image = lambda kind, col: F.struct(F.lit(kind).alias("kind"), F.col(col).alias("row"))
    images = (
        F.when(F.col("fault").isNotNull() | F.col("before").eqNullSafe(F.col("after")), None)
        .when(F.col("before").isNull(), F.array(image("insert", "after")))
        .when(F.col("after").isNull(), F.array(image("delete", "before")))
        .otherwise(F.array(image("update_preimage", "before"), image("update_postimage", "after"))))
    return both.select(F.explode(images).alias("i")).select("i.row.*", F.col("i.kind").alias(CHANGE))


def _unkeyed_changes(old: DataFrame, new: DataFrame, names: list[str]) -> DataFrame:
    counted = (
        old.withColumn("_n", F.lit(-1)).unionAll(new.withColumn("_n", F.lit(1)))
        .groupBy(*names).agg(F.sum("_n").alias("_n")).filter("_n <> 0"))
    kind = F.when(F.col("_n") > 0, "insert").otherwise("delete")
    # Copies are written out in chunks that are first spread over the tasks.
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.abs("_n") - 1) / COPIES))).alias("_chunk")
    chunks = counted.select("*", kind.alias(CHANGE), chunk)
    chunks = chunks.repartition(F.xxhash64(*names, "_chunk"))
    left = F.least(F.lit(COPIES).cast("long"), F.abs("_n") - F.col("_chunk") * COPIES)
    copies = F.explode(F.sequence(F.lit(1).cast("long"), left)).alias("_copy")
    return chunks.select(*names, CHANGE, copies).drop("_copy")


def apply_changes(old: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The new state from the old one and a change feed with non-NULL keys."""
    gone = changes.filter(F.col(CHANGE).isin("delete", "update_preimage")).select(*keys)
    come = changes.filter(F.col(CHANGE).isin("insert", "update_postimage")).select(*old.columns)
    # A join on names puts the keys first.
    return old.join(gone, list(keys), "left_anti").select(*old.columns).unionAll(come)
