"""Benchmark decontamination by spaced seeds.

A seed is a pattern that looks at some words of a stretch and ignores the others, so that it still
hits where an ignored word was replaced. The hashes that all seeds give for the benchmark are joined
with those of the documents; around each hit the two texts are compared word by word, and a stretch
counts in which replaced words are outweighed by equal ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.llm.columns import MARKS, let, word_hashes
from curbside.llm.rows import doc_of, row_of, stored

# The words of a stretch that each seed looks at.
SEEDS = ([0, 1, 3, 4, 6, 7], [0, 2, 3, 5, 6, 9])
#: Equal words count 1, others as below; stretches of at least so much count, or a whole shorter item.
MISMATCH, LEAST = -3, 10
#: Benchmarks of up to so many characters are sent to all executors, some 10 MB of seeds; larger ones are joined by a shuffle.
BROADCAST_CHARS = 1 << 20
#: Items that more than so many of overlap with a document by the same worth are listed in one row.
COMMON = 8
#: Items of at most so many words are looked up as whole texts; longer ones inside texts.
WHOLE = 3
WIDTH = max(SEEDS[0]) + 1


def looked_at(hashes: Column, i: Column, kind: int, offsets: list[int]) -> Column:
    return F.xxhash64(F.lit(kind), *(F.get(hashes, i + x) for x in offsets))


def none() -> Column:
    return F.array().cast("array<bigint>")


def kinds_of(lengths: list[int]) -> list[tuple[int, int, list[int]]]:
    """For each kind of hash that documents have: its number, the words it needs, and those it looks at.

    Two spaced seeds, the second of which reads past the end at the last places, where the first is
    whole; and runs of as many words as items have that are too short for a spaced seed to do.
    """
    return [*((n, WIDTH, x) for n, x in enumerate(SEEDS)), *((100 + n, n, list(range(n))) for n in lengths)]


def seeds_of(hashes: Column, kinds: list[tuple[int, int, list[int]]]) -> Column:
    """The hashes of every kind at each place, one kind after the other; last a short text as a whole."""
    def every(kind: int, width: int, offsets: list[int]) -> Column:
        last = F.size(hashes) - width
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: looked_at(hashes, i, kind, offsets))).otherwise(none())

    whole = F.when(F.size(hashes).between(1, WHOLE), F.array(F.xxhash64(hashes))).otherwise(none())
    return F.concat(*(every(*x) for x in kinds), whole)


def place_of(at: Column, words: Column, kinds: list[tuple[int, int, list[int]]]) -> Column:
    """The place in a text of ``words`` words of the hash that ``seeds_of`` gives at ``at``."""
    place, start = F.lit(0), F.lit(0)
    steps = []
    for _, width, _ in kinds:
        room = F.greatest(words - width + 1, F.lit(0))
        steps.append((start, start + room))
        start = start + room
    for begin, end in reversed(steps):
        place = F.when((at >= begin) & (at < end), at - begin).otherwise(place)
    return place


def item_keys(items: DataFrame) -> DataFrame:
    """(seed, item_id, item_place): spaced seeds of long items, one hash of all words of the others."""
    spaced = kinds_of([])
    size = F.size("item")
    long = items.where(size >= LEAST).select("item_id", size.alias("n"), F.posexplode(seeds_of(F.col("item"), spaced)).alias("at", "seed"))
    keys = long.select("seed", "item_id", place_of(F.col("at"), F.col("n"), spaced).alias("item_place"))
    run = F.xxhash64(F.lit(-1))
    for n in range(WHOLE + 1, LEAST):
        run = F.when(size == n, looked_at(F.col("item"), F.lit(0), 100 + n, list(range(n)))).otherwise(run)
    short = items.where(size < LEAST).select(F.when(size <= WHOLE, F.xxhash64("item")).otherwise(run).alias("seed"), "item_id",
                                             F.lit(0).alias("item_place"))
    return keys.union(short)


def best_stretch(doc: Column, item: Column, shift: Column) -> Column:
    """The largest sum over a stretch of an item laid over a document from word ``shift`` on."""
    worth = F.transform(item, lambda x, i: F.when(F.get(doc, i + shift) == x, 1).otherwise(MISMATCH))
    start = F.struct(F.lit(0).alias("here"), F.lit(0).alias("best"))

    def step(state: Column, x: Column) -> Column:
        here = F.greatest(state["here"] + x, F.lit(0))
        return F.struct(here.alias("here"), F.greatest(state["best"], here).alias("best"))

    return F.aggregate(worth, start, step)["best"]


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame, ident: str = "doc_id", text: str = "text",
                       item_ident: str = "item_id", item_text: str = "text", common: int = COMMON) -> DataFrame:
    """(doc, row, item_id, words, item_ids): for each document and item that overlap, the best stretch.

    Words are runs of letters and digits in lower case. An overlap is a stretch in which equal
    words, less three times the others, come to 10 or to all words of a shorter item; items of 1
    to 3 words count only where they are a document's whole text. More than ``common`` items that a
    document overlaps with by the same worth share a row: ``item_id`` is the smallest of them and
    ``item_ids`` has all, in other rows the one. Rows without an id are compared
    like others, repeated rows once; hits are reduced to one for each document, item and shift.
    """
    items = benchmark.select(F.col(item_ident).alias("item_id"), word_hashes(F.col(item_text).cast("string"), MARKS).alias("item"))
    items = items.where("size(item) > 0")
    size = benchmark.agg(F.sum(F.length(F.col(item_text).cast("string")))).first()[0] or 0
    sent = F.broadcast if size <= BROADCAST_CHARS else (lambda x: x)
    # At most six numbers: the lengths of short items that occur.
    lengths = [r[0] for r in items.select(F.size("item").alias("n")).where(F.col("n").between(WHOLE + 1, LEAST - 1)).distinct().orderBy("n").collect()]
    kinds = kinds_of(lengths)
    rows = docs.select(doc_of(ident).alias("doc"), row_of(ident, text).alias("row"), F.col(text).cast("string").alias("text"))
    found = rows.select("doc", "row", F.inline(F.array(let(word_hashes(F.col("text"), MARKS), lambda x: F.struct(
        F.size(x).alias("n"), seeds_of(x, kinds).alias("seeds"))))))
    found = found.select("doc", "row", "n", F.posexplode("seeds").alias("at", "seed"))
    hits = stored(found.join(sent(item_keys(items)), "seed").select("doc", "row", "item_id", (
        place_of(F.col("at"), F.col("n"), kinds) - F.col("item_place")).alias("shift")).distinct(), "benchmark-hits")
    hashed = rows.join(hits.select("doc", "row").distinct(), ["doc", "row"], "left_semi").dropDuplicates(["doc", "row"]).select(
        "doc", "row", word_hashes(F.col("text"), MARKS).alias("words"))
    # Words of items are not shuffled where they can be sent; otherwise they are, being fewer than those of documents.
    near = hits.join(hashed, ["doc", "row"]).join(sent(items), "item_id") if size <= BROADCAST_CHARS else hits.join(items, "item_id").join(
        hashed, ["doc", "row"])
    scored = near.select(
        "doc", "row", "item_id", best_stretch(F.col("words"), F.col("item"), F.col("shift")).alias("words"),
        F.least(F.lit(LEAST), F.size("item")).alias("least"))
    best = scored.where("words >= least").groupBy("doc", "row", "item_id").agg(F.max("words").alias("words"))
    alike = best.groupBy("doc", "row", "words").agg(F.min("item_id").alias("first"), F.sort_array(F.collect_list(F.struct("item_id"))).alias("ids"))
    ids = F.col("ids.item_id")
    return alike.select("doc", "row", "words", F.inline(F.when(F.size("ids") <= common, F.transform(ids, lambda x: F.struct(
        x.alias("item_id"), F.array(x).alias("item_ids")))).otherwise(F.array(F.struct(F.col("first").alias("item_id"), ids.alias("item_ids")))))).select(
        "doc", "row", "item_id", "words", "item_ids")


def decontaminate(docs: DataFrame, benchmark: DataFrame, ident: str = "doc_id", text: str = "text",
                  item_ident: str = "item_id", item_text: str = "text", common: int = COMMON) -> DataFrame:
    """(doc_id, doc, row, contaminated, n_items, item_id, words) for each row of ``docs``.

    ``item_id`` is the item with the longest overlap, the smallest of such, and ``words`` its worth;
    ``n_items`` counts all items that overlap. NULL and empty texts and
    benchmarks have no words and overlap with nothing. Repeated rows get a row each. Other columns
    are not looked at; an empty table gives no rows. Texts are worked on whole, whatever their length.
    """
    overlaps = benchmark_overlaps(docs, benchmark, ident, text, item_ident, item_text, common)
    best = overlaps.groupBy("doc", "row").agg(
        F.sum(F.size("item_ids")).alias("n_items"), F.min(F.struct((-F.col("words")).alias("less"), "item_id")).alias("best"))
    own = docs.select(F.col(ident).alias("doc_id"), doc_of(ident).alias("doc"), row_of(ident, text).alias("row"))
    return own.join(best, ["doc", "row"], "left").select(
        "doc_id", "doc", "row", F.col("best").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.col("best.item_id").alias("item_id"), F.coalesce(-F.col("best.less"), F.lit(0)).alias("words"))
