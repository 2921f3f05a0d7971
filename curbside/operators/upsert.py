"""Upsert of one DataFrame into another, with the rules of SQL MERGE.

The target is never grouped: it is joined to the source as the left side, so adaptive
execution can broadcast a small source or split a skewed target key, which a full outer
join would not allow. NULL keys match nothing: such rows are kept or inserted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys_equal(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys])


def _expr(e: Column | str) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def matched_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys present on both sides; reads only the key columns."""
    wanted = source.select(*keys).dropna(how="any")
    return target.select(*keys).join(wanted, list(keys), "left_semi").distinct()


def _fail_on_ambiguous(source: DataFrame, hits: DataFrame, keys: Sequence[str],
                       result: DataFrame) -> DataFrame:
    """No rows; raises if a matched key is not unique in the source.

    The row number keeps the optimizer from moving the error below the tests before it.
    """
    repeated = source.groupBy(*keys).count().filter("count > 1").join(hits, list(keys), "left_semi")
    message = F.concat(
        F.lit("several source rows match one target row: "),
        F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    error = F.raise_error(F.when(F.monotonically_increasing_id() >= 0, message))
    failing = repeated.filter(error.cast("boolean"))
    return failing.select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in result.schema.fields])


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    when: Column | str | None = None,
    set: Mapping[str, Column | str] | None = None,
    insert: bool = True,
    delete_unmatched_target: bool = False,
    source_is_unique: bool = False,
    hits: DataFrame | None = None,
) -> DataFrame:
    """The target after the merge, as a plan; nothing is written.

    ``when`` and ``set`` may refer to target columns as ``t.x`` and source columns as
    ``s.x``. Without ``set`` every non-key column the source has is replaced. ``when``
    limits the update only; a matched row that fails it is kept. Two source rows for one
    target row raise an error unless the caller vouches with ``source_is_unique``.
    ``hits`` passes in keys already known to match.
    """
    hits = matched_keys(target, source, keys) if hits is None else hits
    if set is None:
        set = {c: F.col(f"s.{c}") for c in target.columns if c in source.columns and c not in keys}
    unknown = [c for c in set if c not in target.columns]
    if unknown:
        raise ValueError(f"not target columns: {unknown}")

    marked = source.withColumn("_hit", F.lit(True)).alias("s")
    how = "inner" if delete_unmatched_target else "left"
    joined = target.alias("t").join(marked, _keys_equal("t", "s", keys), how)
    updated = F.col("s._hit").isNotNull()
    if when is not None:
        updated = updated & _expr(when)
    columns = []
    for f in target.schema.fields:
        old = F.col(f"t.{f.name}")
        if f.name in set:
            new = _expr(set[f.name]).cast(f.dataType)
            columns.append(F.when(updated, new).otherwise(old).alias(f.name))
        else:
            columns.append(old.alias(f.name))
    result = joined.select(*columns)

    if not source_is_unique:
        result = result.unionAll(_fail_on_ambiguous(source, hits, keys, result))
    if insert:
        fresh = source.join(hits, list(keys), "left_anti")
        result = result.unionAll(fresh.select(*[
            (F.col(f.name) if f.name in source.columns else F.lit(None)).cast(f.dataType)
            .alias(f.name) for f in target.schema.fields]))
    return result


NEWER = "s.ingestion_ts > t.ingestion_ts"


def merge_newer(target: DataFrame, source: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """Insert new keys; update all non-key columns where the source was ingested later."""
    return merge_upsert(target, source, keys, when=NEWER, **options)


def correct_fares(silver: DataFrame, scope: Column, factor: float, share: float,
                  processed_ts: Column | None = None) -> DataFrame:
    """Scale the out-of-range fares in ``scope`` and clear their flags; one pass over the rows."""
    fare = F.col("fare_amount") * factor
    wrong = F.coalesce(scope & F.col("dq_fare_out_of_range"), F.lit(False))
    changed = {
        "fare_amount": fare,
        "net_fare": F.round(fare * share, 2),
        "dq_fare_out_of_range": F.lit(False),
        "has_data_quality_issue": F.lit(False),
        "silver_processed_ts": F.current_timestamp() if processed_ts is None else processed_ts,
    }
    return silver.withColumns({c: F.when(wrong, new).otherwise(F.col(c)) for c, new in changed.items()})


def sync_drivers(silver: DataFrame, updates: DataFrame) -> DataFrame:
    """Set city and event type per driver and day; rows without an update are deleted."""
    return merge_upsert(
        silver, updates, ["driver_id", "event_date"],
        set={"city": "s.city", "event_type": "s.event_type"}, delete_unmatched_target=True)
