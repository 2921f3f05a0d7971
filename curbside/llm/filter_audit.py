"""What each of several filters removes, in every order in which they may be applied.

Documents are counted once by the set of filters that they fail. For each part these counts form a
tensor with one axis of two places, pass and fail, for each filter; every figure of every step of
every order is a contraction of it that takes pass, fail or all along each axis.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.llm.columns import SPACES

#: What a step takes along an axis: documents that pass a filter, that fail it, or all.
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
AUDIT = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
                   *((x, pa.int64()) for x in FIGURES)])
AUDIT_SQL = "part string, filter_order string, step int, " + ", ".join(f"{x} long" for x in FIGURES)

Filters = Callable[[Column, Column], Mapping[str, Column]]


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """The conditions under which a text fails: few words, repeated words, capitals, marks."""
    length = F.length(text)
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * (length - F.length(F.regexp_replace(text, "[A-Z]+", ""))) > 10 * length,
        "D": text.rlike("[#$%&*|]"),
    }


def failed_sets(docs: DataFrame, filters: Filters, ident: str, text: str, part: str) -> tuple[DataFrame, list[str]]:
    """(doc, part, digest, failed, n): rows alike are counted once; bit i of ``failed`` stands for filter i."""
    own = docs.select(F.col(ident).cast("long").alias("doc"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                      F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    fails = filters(F.col("text"), F.col("words"))
    bits = sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(fails.values())), F.lit(0))
    rows = own.withColumn("words", F.array_remove(F.split("text", SPACES), "")).select(
        "doc", "part", F.unhex(F.sha2("text", 256)).alias("digest"), bits.alias("failed"))
    return rows.groupBy("doc", "part", "digest", "failed").agg(F.count("*").alias("n")), list(fails)


def with_labels(rows: DataFrame, labels: DataFrame, ident: str) -> DataFrame:
    """``good`` and ``toxic`` of each row, 0 or 1. Rows without an id have no label and are spread over the tasks."""
    marks = labels.where(F.col(ident).isNotNull()).groupBy(F.col(ident).cast("long").alias("doc")).agg(
        *(F.max(F.when(F.col(x) == 1, 1).otherwise(0)).alias(y) for x, y in (("quality", "good"), ("toxic", "toxic"))))
    spread = F.when(F.col("doc").isNull(), F.xxhash64("digest")).otherwise(0)
    return rows.withColumn("spread", spread).join(marks.withColumn("spread", F.lit(0).cast("long")), ["doc", "spread"], "left").select(
        "doc", "part", "digest", "failed", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def failure_counts(docs: DataFrame, labels: DataFrame, filters: Filters = text_filters, ident: str = "doc_id",
                   text: str = "text", part: str = "lang") -> tuple[DataFrame, list[str]]:
    """(part, failed, n, good, toxic) and the filters' names, the last bit standing for copies.

    A copy is a text that a row with a smaller id has, in whatever part. Rows of equal texts are
    combined before each shuffle, so one text in a third of all rows is no larger than any other.
    """
    rows, names = failed_sets(docs, filters, ident, text, part)
    known = F.col("doc").isNotNull()
    texts = with_labels(rows, labels, ident).groupBy("digest", "part", "failed", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("unnamed"),
        F.min(F.when(known, F.struct("doc", "n"))).alias("first"))
    least = texts.groupBy("digest").agg(F.min("first.doc").alias("least"))
    first = F.when(F.col("first.doc") == F.col("least"), F.col("first.n")).otherwise(0)
    split = texts.join(least, "digest").withColumn("own", F.col("unnamed") + first)
    both = F.array(F.struct(F.col("failed"), F.col("own").alias("n")),
                   F.struct((F.col("failed") + (1 << len(names))).alias("failed"), (F.col("n") - F.col("own")).alias("n")))
    cells = split.select("part", "good", "toxic", F.inline(both))
    return cells.groupBy("part", "failed").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")), names


def contracted(tensor: np.ndarray, choices: np.ndarray) -> np.ndarray:
    """The sums of ``tensor`` [measure, filter, filter, ...] under ``choices`` [row, filter, place]."""
    axes = string.ascii_lowercase[:choices.shape[1]]
    terms = ",".join(["M" + axes, *("R" + x for x in axes)])
    return np.einsum(terms + "->RM", tensor, *np.moveaxis(choices, 1, 0))


def step_choices(size: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All orders of the filters and, order after order and step after step, what four figures take:
    documents kept by the step, removed by it, failing its filter, and failing no other."""
    orders = list(permutations(range(size)))
    rows = []
    for order in orders:
        for k, own in enumerate(order):
            before = {x: PASS for x in order[:k]}
            others = {x: PASS for x in order if x != own}
            for picked in (before | {own: PASS}, before | {own: FAIL}, {own: FAIL}, others | {own: FAIL}):
                rows.append([picked.get(x, ALL) for x in range(size)])
    return orders, np.array(rows, np.int64)


def audited(names: list[str]) -> Callable[[pa.Table], pa.Table]:
    def audit(counts: pa.Table) -> pa.Table:
        """All orders and steps of one part from its counts, at most one row for each set of filters."""
        size = len(names)
        tensor = np.zeros((3, 1 << size), np.int64)
        failed = counts.column("failed").to_numpy()
        for i, measure in enumerate(("n", "good", "toxic")):
            np.add.at(tensor[i], failed, counts.column(measure).to_numpy())
        # Bit 0 is the last axis of the reshaped counts; the filters' axes are wanted first to last.
        tensor = tensor.reshape(3, *(2,) * size).transpose(0, *range(size, 0, -1))
        orders, choices = step_choices(size)
        kept, removed, failing, alone = np.moveaxis(contracted(tensor, choices).reshape(-1, 4, 3), 1, 0)
        own = np.array(orders).ravel()
        shares = np.bincount(own, removed[:, 0].astype(np.float64), size)[own].astype(np.int64)
        steps = len(orders) * size
        part = counts.column("part")[0].as_py()
        return pa.table([[part] * steps, ["".join(names[x] for x in o) for o in orders for _ in o],
                         np.tile(np.arange(1, size + 1, dtype=np.int32), len(orders)), kept[:, 0], removed[:, 0],
                         failing[:, 0] - removed[:, 0], alone[:, 0], removed[:, 1], removed[:, 2], shares], schema=AUDIT)

    return audit


def filter_audit(docs: DataFrame, labels: DataFrame, filters: Filters = text_filters, copies: str = "E", ident: str = "doc_id",
                 text: str = "text", part: str = "lang") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    ``filters`` gives, for a text and its words, the condition under which each filter, named by one
    letter, rejects a document; ``copies`` names one more, which rejects texts that a smaller id
    has. For each value of ``part`` (NULL: empty) there is a row for each order of the filters and
    step of it, zeros included: documents left after the step, removed by it, failing its filter but
    removed before, failing its filter alone, removed ones labelled ``quality`` 1 and ``toxic`` 1,
    and what the step's filter removes in all orders together, at any step.

    A NULL text is empty. Words are runs of other than ASCII white space. Repeated rows count one by
    one and are no copies of each other; rows without an id have no label, are copies of nothing
    and have no copies. Several label rows of one id count as one. An empty table gives no rows.
    Other columns are not looked at. Memory and results of a task are bounded by the number of
    filters, texts of any length by what one row of Spark may hold.
    """
    counts, names = failure_counts(docs, labels, filters, ident, text, part)
    return counts.groupBy("part").applyInArrow(audited([*names, copies]), AUDIT_SQL)
