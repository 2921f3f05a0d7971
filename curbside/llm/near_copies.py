"""Near-duplicate documents by a MinHash LSH forest.

Every tree sorts the documents by a signature of its own. Neighbours in a tree whose signatures
begin alike are candidates, and so is the first document of every region with a common beginning.
Links are confirmed on the full sets of shingles. Some trees do for most links; then the regions of
all trees that still hold several components are compared across these, in tasks that hold the
full sets of a region and pass on only links that join two components. Regions that are too crowded
for that go deeper: their documents get more trees, with longer beginnings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.graph import components
from curbside.llm.rows import NO_ID, blocks, discard, doc_of, keyed, partitions, row_of, stored, texts_of
from curbside.llm.words import window_hashes, word_hashes

TREES, DEPTH = 16, 6
#: Signatures must begin alike in so many values.
LEAST_DEPTH = 2
#: Trees whose neighbours are compared at once; the others serve where components are left apart.
FIRST_TREES = 6
#: Neighbours on either side, and the depths of regions whose first document is a candidate for all.
NEIGHBOURS, PIVOTS = 1, (2,)
#: A region with more shingles than this goes deeper; there a region is compared in parts of about so many.
CROWDED = 4 << 20
#: Trees for the documents of crowded regions: a pair of similarity 0.8 shares DEPTH values in none of them
#: with a probability of 1e-6.
DEEP_TREES = 45
#: Rows whose sets are compared at once.
AT_ONCE = 256
#: Bytes of texts whose sets are worked out at once.
SETS_BLOCK = 2 << 20
#: Partners that a document is compared with in one task.
PARTNERS = 256

_random = np.random.default_rng(4242)
FACTORS = _random.integers(0, 1 << 64, (TREES + DEEP_TREES) * DEPTH, np.uint64) | np.uint64(1)
SHIFTS = _random.integers(0, 1 << 64, (TREES + DEEP_TREES) * DEPTH, np.uint64)

SETS_SQL = "doc long, row long, n long, digest binary, signature binary"
FOREST = pa.schema([("a", pa.int64()), ("a_row", pa.int64()), ("b", pa.int64()), ("b_row", pa.int64()), ("tree", pa.int32()),
                    ("key", pa.binary()), ("doc", pa.int64()), ("row", pa.int64()), ("n", pa.int64())])
FOREST_SQL = "a long, a_row long, b long, b_row long, tree int, key binary, doc long, row long, n long"
PAIR = FOREST.names[:4]


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct shingles of ``words`` words, A-Z in lower case."""
    hashes, bounds = word_hashes([x.lower() for x in texts])
    shingles = window_hashes(hashes, words)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(shingles[a:b - words + 1]))
        elif b > a:
            out.append(np.array([xxhash.xxh3_64_intdigest(hashes[a:b].tobytes())], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signature(shingles: np.ndarray, first: int = 0, trees: int = TREES) -> bytes:
    """The smallest value under each hash function, tree after tree, in an order that bytes keep."""
    factors, shifts = (x[first * DEPTH:(first + trees) * DEPTH] for x in (FACTORS, SHIFTS))
    least = np.full(len(factors), (1 << 64) - 1, np.uint64)
    for at in range(0, len(shingles), 1024):
        values = shingles[at:at + 1024, None] * factors
        values += shifts
        np.minimum(least, values.min(0), out=least)
    return (least >> np.uint64(32)).astype(">u4").tobytes()


def set_rows(words: int) -> Callable:
    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=SETS_BLOCK):
            sets = shingle_sets(texts_of(block), words)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc"), block.column("row"), pa.array([len(x) for x in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary()),
                 pa.array([signature(x) for x in sets], pa.binary())], ["doc", "row", "n", "digest", "signature"])

    return describe


def similar_sizes(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def neighbours(percent: int, with_edges: bool) -> Callable:
    """Candidate pairs of rows sorted by tree and key; also the rows at the ends of the partition."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        pivots = {d: (0, 0, 0) for d in PIVOTS}
        tail: list[pa.RecordBatch] = []
        first = True
        for batch in batches:
            if not batch.num_rows:
                continue
            own = {x: batch.column(x).to_numpy() for x in ("tree", "doc", "row", "n")}
            own["key"] = np.frombuffer(b"".join(batch.column("key").to_pylist()), ">u4").reshape(-1, DEPTH)
            carried = 0 if held is None else len(held["doc"])
            rows = own if held is None else {k: np.concatenate([held[k], own[k]]) for k in own}
            tree, key, doc, row, n = (rows[x] for x in ("tree", "key", "doc", "row", "n"))
            alike = np.cumprod(key[1:] == key[:-1], axis=1).sum(1) * (tree[1:] == tree[:-1])
            common = np.r_[0, alike]
            pairs = [np.empty((0, 4), np.int64)]
            shared = alike
            for step in range(1, NEIGHBOURS + 1):
                at = np.flatnonzero(shared >= LEAST_DEPTH)
                at = at[at + step >= carried]
                at = at[similar_sizes(n[at], n[at + step], percent)]
                pairs.append(np.column_stack([doc[at], row[at], doc[at + step], row[at + step]]))
                shared = np.minimum(shared[:-1], alike[step:])
            for depth in PIVOTS:
                start = np.maximum.accumulate(np.where(common < depth, np.arange(len(doc)), -1))
                # The first row held over stands in the run of the pivot kept for it.
                if carried:
                    start[:int(np.argmax(common[1:] < depth)) + 1 if (common[1:] < depth).any() else len(doc)] = -1
                pivot, pivot_row, size = (np.where(start < 0, kept, x[start]) for kept, x in zip(pivots[depth], (doc, row, n)))
                at = np.flatnonzero((pivot != doc) & similar_sizes(n, size, percent))
                at = at[at >= carried]
                pairs.append(np.column_stack([pivot[at], pivot_row[at], doc[at], row[at]]))
                last = max(0, len(doc) - NEIGHBOURS)
                pivots[depth] = (int(pivot[last]), int(pivot_row[last]), int(size[last]))
            both = np.concatenate(pairs)
            both = both[both[:, 0] != both[:, 2]]
            turned = both[:, 0] > both[:, 2]
            both[turned] = both[turned][:, [2, 3, 0, 1]]
            both = np.unique(both, axis=0)
            held = {k: v[-NEIGHBOURS:] for k, v in rows.items()}
            none = pa.nulls(len(both))
            yield pa.RecordBatch.from_arrays([*(pa.array(both[:, i]) for i in range(4)), *(none.cast(f.type) for f in list(FOREST)[4:])],
                                             schema=FOREST)
            if with_edges and first:
                yield ends(batch.slice(0, NEIGHBOURS))
            first = False
            tail = [*tail, batch.slice(max(0, batch.num_rows - NEIGHBOURS))][-NEIGHBOURS:]
        if with_edges:
            for part in tail:
                yield ends(part)

    return find


def ends(batch: pa.RecordBatch) -> pa.RecordBatch:
    none = pa.nulls(batch.num_rows, pa.int64())
    return pa.RecordBatch.from_arrays([*[none] * 4, *(batch.column(f.name).cast(f.type) for f in list(FOREST)[4:])], schema=FOREST)


def tree_rows(sets: DataFrame) -> DataFrame:
    """(tree, key, doc, row, n): a row for each tree and distinct set."""
    width = 4 * DEPTH
    return sets.select(F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "signature", "doc", "row", "n").select(
        "tree", F.substring(F.col("signature"), F.col("tree") * width + 1, F.lit(width)).alias("key"), "doc", "row", "n")


def forest_pairs(trees: DataFrame, percent: int) -> DataFrame:
    """(a, a_row, b, b_row): candidates. Rows at the ends of partitions, two or so from each, are compared once more."""
    order = ("tree", "key", "doc", "row")
    names = FOREST.names[4:]
    found = stored(trees.select(*names).repartitionByRange(partitions(trees), *order).sortWithinPartitions(*order)
                   .mapInArrow(neighbours(percent, True), FOREST_SQL), "forest")
    across = (found.where("key is not null").select(*names).distinct().coalesce(1).sortWithinPartitions(*order)
              .mapInArrow(neighbours(percent, False), FOREST_SQL))
    return found.union(across).where("a is not null").select(*PAIR).distinct()


def linked(percent: int, words: int) -> Callable:
    """Of rows sorted so that a hub comes before its partners, the partners that it is linked with."""

    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.empty(0, np.uint64)
        for block in blocks(batches, limit=SETS_BLOCK):
            sets = shingle_sets(texts_of(block), words)
            pairs = []
            columns = (block.column(x).to_pylist() for x in ("a", "a_row", "b"))
            for a, a_row, b, shingles in zip(*columns, sets):
                if b is None:
                    hub, own = (a, a_row), shingles
                    continue
                if hub != (a, a_row):
                    raise ValueError("a hub is missing")
                both = len(own) + len(shingles)
                common = both - len(np.union1d(own, shingles))
                if 100 * common >= percent * (both - common):
                    pairs.append((a, b))
            yield link_rows(pairs)

    return confirm


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """The pairs whose full sets are similar. Each partner's text goes to its hub; hubs with many are split."""
    hubs = pairs.groupBy("a", "a_row").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("parts"))
    partners = pairs.join(hubs, ["a", "a_row"]).select(
        "a", "a_row", F.pmod(F.xxhash64("b", "b_row"), F.col("parts")).cast("int").alias("part"), "b", F.col("b").alias("doc"), F.col("b_row").alias("row"))
    heads = hubs.select("a", "a_row", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"),
                        F.col("a").alias("doc"), F.col("a_row").alias("row"))
    hub = ("a", "a_row", "part")
    return (partners.union(heads).join(texts, ["doc", "row"]).select(*hub, "b", "text")
            .repartition(*hub).sortWithinPartitions(*hub, F.asc_nulls_first("b"))
            .mapInArrow(linked(percent, words), "a long, b long"))


def region_links(sets: list[np.ndarray], component: np.ndarray, sides: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """Links between rows of different components that together join whatever all links between them join.

    With ``sides`` only rows of different sides are compared. Rows are taken in the order of their
    sizes, so that most blocks of rows need no comparison with each other; common shingles are
    counted by a product of matrices over the shingles that occur more than once.
    """
    size = np.array([len(x) for x in sets], np.int64)
    order = np.argsort(size, kind="stable")
    size, component = size[order], component[order].copy()
    sides = None if sides is None else sides[order]
    _, column, count = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(size)), size)
    often = count[column] > 1
    column, row = column[often], row[often]
    bounds = np.searchsorted(row, np.arange(0, len(size) + AT_ONCE, AT_ONCE))
    place = np.zeros(len(count), np.int64)
    found = []
    for i in range(len(bounds) - 1):
        rows_a = slice(i * AT_ONCE, min((i + 1) * AT_ONCE, len(size)))
        own = np.unique(column[bounds[i]:bounds[i + 1]])
        if not len(own):
            continue
        place[:] = -1
        place[own] = np.arange(len(own))
        left = None
        for j in range(i, len(bounds) - 1):
            rows_b = slice(j * AT_ONCE, min((j + 1) * AT_ONCE, len(size)))
            if 100 * size[rows_a].max() < percent * size[rows_b].min():
                break
            fit = component[rows_a, None] != component[rows_b]
            fit &= 100 * size[rows_a, None] >= percent * size[rows_b]
            if sides is not None:
                fit &= sides[rows_a, None] != sides[rows_b]
            if not fit.any():
                continue
            if left is None:
                left = matrix(row[bounds[i]:bounds[i + 1]] - rows_a.start, place[column[bounds[i]:bounds[i + 1]]], rows_a, len(own))
            right = left if i == j else matrix(row[bounds[j]:bounds[j + 1]] - rows_b.start, place[column[bounds[j]:bounds[j + 1]]], rows_b, len(own))
            common = (left @ right.T).astype(np.int64)
            fit &= 100 * common >= percent * (size[rows_a, None] + size[rows_b] - common)
            a, b = (x + y for x, y in zip(np.nonzero(fit), (rows_a.start, rows_b.start)))
            _, once = np.unique(np.column_stack([component[a], component[b]]), axis=0, return_index=True)
            for a, b in zip(a[once].tolist(), b[once].tolist()):
                if component[a] != component[b]:
                    component[component == component[b]] = component[a]
                    found.append((order[a], order[b]))
    return found


def matrix(row: np.ndarray, column: np.ndarray, rows: slice, columns: int) -> np.ndarray:
    """Which rows have which of some shingles; those without a column are left out."""
    out = np.zeros((rows.stop - rows.start, columns), np.float32)
    out[row[column >= 0], column[column >= 0]] = 1
    return out


def group_links(percent: int) -> Callable:
    """Links of the groups of rows sorted by group; each group is held whole, which CROWDED bounds."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch.column("group").to_numpy()
            starts = np.flatnonzero(np.diff(group, prepend=group[0] - 1)) if not held else np.flatnonzero(
                np.diff(group, prepend=held[-1].column("group")[0].as_py()))
            edges = [0, *starts[starts > 0].tolist(), batch.num_rows]
            pairs = []
            for a, b in zip(edges, edges[1:]):
                if a in starts and held:
                    pairs += links_of(held, percent)
                    held = []
                held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
            yield link_rows(pairs)
        if held:
            yield link_rows(links_of(held, percent))

    return find


def links_of(held: list[pa.Table], percent: int) -> list[tuple[int, int]]:
    rows = pa.concat_tables(held)
    doc, component, side = (rows.column(x).to_numpy() for x in ("doc", "component", "side"))
    if len(doc) < 2 or (component == component[0]).all():
        return []
    sets = [np.frombuffer(x, np.uint64) for x in rows.column("shingles").to_pylist()]
    apart = rows.column("apart")[0].as_py()
    return [(doc[a], doc[b]) for a, b in region_links(sets, component, side if apart else None, percent)]


def link_rows(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def described(texts: DataFrame, words: int, name: str, describe: Callable[[np.ndarray], bytes]) -> DataFrame:
    """(doc, row, ``name``): bytes that describe the set of each text."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found = [describe(x) for x in shingle_sets(texts_of(block), words)]
            yield pa.RecordBatch.from_arrays([block.column("doc"), block.column("row"), pa.array(found, pa.binary())], ["doc", "row", name])

    return texts.select("doc", "row", "text").mapInArrow(find, f"doc long, row long, {name} binary")


def mixed_regions(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(tree, region, doc, row, n, component, shingle_count) of regions that hold several components."""
    own = rows.join(labels, rows["doc"] == labels["node"], "left").select(
        "tree", "region", "doc", "row", "n", F.coalesce("component", "doc").alias("component"))
    regions = own.groupBy("tree", "region").agg(F.sum("n").alias("shingle_count"), F.min("component").alias("x"), F.max("component").alias("y"))
    return own.join(regions.where("x < y").select("tree", "region", "shingle_count"), ["tree", "region"])


def compared(mixed: DataFrame, texts: DataFrame, percent: int, words: int, crowded: int) -> DataFrame:
    """(a, b): links between components of a region, compared on full sets; at most one for each row of a group.

    A region of more than ``crowded`` shingles is dealt into parts, and each two parts are a group.
    """
    node = ["doc", "row"]
    parts = F.ceil(F.col("shingle_count") / crowded).cast("int")
    dealt = mixed.withColumn("side", F.pmod(F.xxhash64(*node), parts).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), parts - 1)))
    p, q = F.least("side", "other"), F.greatest("side", "other")
    groups = dealt.select(F.xxhash64("tree", "region", p, q).alias("group"), *node, "component", "side", (p != q).alias("apart"))
    sets = described(texts.join(mixed.select(*node).distinct(), node, "left_semi"), words, "shingles", np.ndarray.tobytes)
    return (groups.join(sets, node).select("group", "doc", "component", "side", "apart", "shingles").repartition("group").sortWithinPartitions("group")
            .mapInArrow(group_links(percent), "a long, b long"))


def deep_regions(far: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(tree, region, doc, row, n) in the trees that only documents of crowded regions have."""
    width = 4 * DEPTH
    own = far.select("doc", "row", "n").distinct()
    signed = described(texts.join(own, ["doc", "row"], "left_semi"), words, "signature", deep_signature).join(own, ["doc", "row"])
    trees = F.explode(F.sequence(F.lit(0), F.lit(DEEP_TREES - 1))).alias("tree")
    return signed.select(trees, "doc", "row", "n", "signature").select(
        (F.col("tree") + TREES).alias("tree"), F.substring(F.col("signature"), F.col("tree") * width + 1, F.lit(width)).alias("region"),
        "doc", "row", "n")


def deep_signature(shingles: np.ndarray) -> bytes:
    return signature(shingles, TREES, DEEP_TREES)


def cross_links(trees: DataFrame, texts: DataFrame, labels: DataFrame, percent: int, words: int, crowded: int) -> DataFrame:
    """(a, b): links between components that share a region in any tree.

    Regions of up to ``crowded`` shingles are compared whole. The documents of larger ones get
    DEEP_TREES more trees, in which a region shares DEPTH values.
    """
    rows = trees.select("tree", F.substring("key", 1, 4 * LEAST_DEPTH).alias("region"), "doc", "row", "n")
    mixed = stored(mixed_regions(rows, labels), "regions")
    near = stored(compared(mixed.where(F.col("shingle_count") <= crowded), texts, percent, words, crowded), "confirmed")
    far = mixed.where(F.col("shingle_count") > crowded)
    if far.isEmpty():
        discard(mixed)
        return near
    labels = components(near.union(labels.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    deep = stored(mixed_regions(deep_regions(far, texts, words), labels), "regions")
    all_links = stored(near.union(compared(deep, texts, percent, words, crowded)), "confirmed")
    discard(mixed, near, deep, labels)
    return all_links


def near_copies(docs: DataFrame, words: int = 5, percent: int = 80, ident: str = "doc_id", text: str = "text",
                crowded: int = CROWDED) -> DataFrame:
    """(doc_id, doc, row, n_shingles, component_id, kept) for each row of ``docs``.

    Documents are linked whose sets of distinct shingles of ``words`` words, A-Z in lower case, have
    100 * intersection >= ``percent`` * union. A text of fewer words has one shingle; texts without
    words, NULL among them, are linked with nothing. ``component_id`` is the smallest id that links
    lead to, and the row with that id is kept. Equal sets are one node from the start. Rows with one
    id count as one document, which has the links of all its texts; rows without an id have no
    component and are kept. Regions of up to ``crowded`` shingles are held whole in one task.
    Other columns are not looked at; an empty table gives no rows.
    """
    own = keyed(docs, ident, text)
    node = ["doc", "row"]
    sets = stored(own.mapInArrow(set_rows(words), SETS_SQL), "shingle-sets")
    known = sets.where((F.col("n") > 0) & (F.col("doc") != NO_ID))
    nodes = known.groupBy("digest").agg(F.min(F.struct(*node)).alias("first"))
    heads = known.join(nodes.select("first.doc", "first.row"), node, "left_semi").dropDuplicates(node)
    trees = tree_rows(heads)
    region = F.substring(F.col("key"), F.lit(1), F.lit(4 * LEAST_DEPTH))
    shared = trees.groupBy("tree", region.alias("region")).count().where("count > 1").select("tree", "region")
    crowd = stored(trees.withColumn("region", region).join(shared, ["tree", "region"], "left_semi").drop("region"), "trees")
    texts = stored(own.join(crowd.select(*node).distinct(), node, "left_semi").dropDuplicates(node), "candidates")
    pairs = forest_pairs(crowd.where(F.col("tree") < FIRST_TREES), percent)
    links = stored(confirmed(pairs, texts, percent, words), "confirmed")
    labels = components(links)
    more = cross_links(crowd, texts, labels, percent, words, crowded)
    # Rows of one document may have different sets.
    sets_of = known.join(nodes.select("digest", F.col("first.doc").alias("node")), "digest").select(*node, "node").distinct()
    split = sets_of.groupBy("doc").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x < y")
    same = sets_of.join(split, "doc").select(F.col("node").alias("a"), F.col("x").alias("b"))
    found_labels = components(links.union(more).union(same))
    discard(crowd, texts, links, more, labels)
    found = sets_of.join(found_labels, "node", "left").select(*node, F.coalesce("component", "node").alias("component"))
    rows = docs.select(F.col(ident).alias("doc_id"), doc_of(ident).alias("doc"), row_of(ident, text).alias("row"))
    counts = sets.select(*node, "n").distinct()
    return rows.join(counts, node).join(found, node, "left").select(
        "doc_id", *node, F.col("n").alias("n_shingles"),
        F.coalesce(F.col("component"), F.when(F.col("doc") != NO_ID, F.col("doc"))).alias("component_id")).withColumn(
            "kept", F.coalesce(F.col("doc") == F.col("component_id"), F.lit(True)))
