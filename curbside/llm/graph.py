"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.rows import discard, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component): for each node of (a, b), the smallest node that it is linked with, itself included.

    Large stars and small stars take turns: each node's larger neighbours are hung on its smallest
    one, then its smaller ones are. Rounds grow with the logarithm of the nodes; a node with very
    many neighbours is combined before the shuffle, and its join is split by adaptive execution.
    """
    stars = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = stars.union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least).distinct()
        older, stars = stars, stored(small, "links")
        discard(older)
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            found = stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(stars.select("v", "v").distinct())
            found.stored_in = stars.stored_in
            return found
        before = now
