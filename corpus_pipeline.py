"""A training corpus in five stages: clean, deduplicate, decontaminate and pack documents.

Each stage works on what its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.llm.decontamination import decontaminate
from curbside.llm.lines import line_dedup
from curbside.llm.near_copies import near_copies
from curbside.llm.packing import pack_documents
from curbside.llm.rows import doc_of, restored, row_of, stored, table
from curbside.llm.toxicity import THRESHOLD, with_scores


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold of toxicity."""
    scored = with_scores(docs, table(spark, sf_dir, "labels"))
    return restored(scored.where(F.col("score") < THRESHOLD), docs, F.col("text"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document with a smaller id has; n_chars counts what is left."""
    kept = restored(line_dedup(docs), docs, F.col("kept"))
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies; repeated rows once."""
    marks = near_copies(docs).where("kept").select("doc", "row").distinct()
    return chosen(docs, marks, "left_semi", once=True)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    marks = decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select("doc", "row").distinct()
    return chosen(docs, marks, "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences."""
    return pack_documents(docs)


def chosen(docs: DataFrame, marks: DataFrame, how: str, once: bool = False) -> DataFrame:
    """The rows of ``docs`` that marks of (doc, row) keep or, by ``left_anti``, drop."""
    rows = docs.select(F.struct("*").alias("whole"), doc_of().alias("doc"), row_of().alias("row")).join(marks, ["doc", "row"], how)
    return (rows.dropDuplicates(["doc", "row"]) if once else rows).select("whole.*")


STAGES = [("toxicity", not_toxic), ("line dedup", without_repeated_lines), ("near copies", one_of_near_copies),
          ("decontamination", not_in_benchmark), ("packing", packed)]

#: SQL expresses neither the learned scores nor the packing; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not STAGES[-1][1]:
            docs = stored(docs, "stage-" + name.replace(" ", "-"))
    return docs
