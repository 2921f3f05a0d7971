"""Byte-level BPE ids of whole tables, by one shuffle of distinct words, and the bytes of ids.

Texts are cut into pre-tokens. A block of texts keeps its distinct pre-tokens once and, for each
place of a text, which of them stands there; so what is shuffled by word is one entry for each block
that has it, however often it occurs. Where the entries of a word come together it is encoded, and
its ids go back to the blocks, whose places turn them into the ids of their texts. Decoding explodes
the distinct ids of a block, joins the table of token bytes and puts these in the places of the ids.
"""

from __future__ import annotations

import uuid
import zlib
from base64 import b64decode
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.llm.rows import blocks, partitions, texts_of
from curbside.session import shared_folder

#: Bytes of text in a block; a longer single text is a block by itself.
BLOCK = 4 << 20
#: Matches of a text are taken in one list up to so many bytes, one by one beyond.
LISTED = 1 << 20
#: Words of a bucket that a task remembers; it starts anew when they are more.
WORDS = 1 << 19
#: Ids that are decoded at once; a longer single text is decoded alone.
IDS = 1 << 20
#: A row for the texts of a block, with ``bucket`` NULL and the numbers of its words as they follow in the buckets, and
#: rows for its words by buckets of their hashes.
CUT = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.binary()),
                 ("places", pa.binary()), ("at", pa.binary()), ("lengths", pa.binary()), ("words", pa.binary())])
CUT_SQL = "block long, bucket int, doc_ids array<long>, counts binary, places binary, at binary, lengths binary, words binary"
#: How many ids each word of a bucket has, and all these ids.
PARTS = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("counts", pa.binary()), ("ids", pa.binary())])
PARTS_SQL = "block long, bucket int, counts binary, ids binary"
ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
#: The texts of a block of ids in one row, with ``id`` NULL, and after it a row for each distinct id.
SPELT = pa.schema([("doc_ids", pa.list_(pa.int64())), ("counts", pa.binary()), ("ids", pa.binary()), ("id", pa.int32())])
SPELT_SQL = "doc_ids array<long>, counts binary, ids binary, id int"
DECODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.binary())])


def default_path() -> str:
    """The rank file of the registered query; other files are given by path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@lru_cache(maxsize=2)
def rank_table(path: str) -> dict[bytes, int]:
    """The bytes of each token and its rank, which is its id."""
    with open(path, "rb") as file:
        return {b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, file)))}


@lru_cache(maxsize=2)
def splitter(pattern: str):
    """White space is what Unicode calls so: Python's own class has four control characters more."""
    import regex

    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


@lru_cache(maxsize=2)
def merger(path: str):
    """Merges the bytes of one word: the pattern takes whatever it is given as one piece."""
    import tiktoken

    return tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=rank_table(path), special_tokens={})


def pre_tokens_of(pattern: str) -> Callable[[str], Iterable[str]]:
    split = splitter(pattern)
    return lambda text: split.findall(text) if len(text) <= LISTED else (x.group() for x in split.finditer(text))


def chunks_of(text: str) -> list[str] | None:
    """Pieces at whose ends a pre-token of the default pattern ends, or None where white space is not that simple.

    No such pre-token holds white space but as its first character, so one ends before each single
    space between words, and a single line feed between words is one by itself.
    """
    out = []
    for line in text.split("\n"):
        words = line.split(" ")
        if words != line.split():
            return None
        out.append("\n")
        out.append(words[0])
        out += [" " + x for x in words[1:]]
    return out[1:]


class Vocabulary:
    """The distinct pre-tokens of a block by number, and those of chunks that were cut before."""

    def __init__(self, pattern: str) -> None:
        self.find, self.simple = pre_tokens_of(pattern), pattern == default_pattern()
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.chunks: dict[str, tuple[int, ...]] = {}

    def numbers(self, text: str) -> np.ndarray:
        chunks = chunks_of(text) if self.simple else None
        if chunks is None:
            return np.fromiter(map(self.number.__getitem__, self.find(text)), np.uint32)
        known = self.chunks
        for chunk in set(chunks).difference(known):
            alone = chunk[chunk[0] == " ":].isalpha()
            known[chunk] = (self.number[chunk],) if alone else tuple(map(self.number.__getitem__, self.find(chunk)))
        return np.fromiter(chain.from_iterable(map(known.__getitem__, chunks)), np.uint32)


def cut(pattern: str, limit: int, buckets: int) -> Callable:
    def pre_tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each block its texts, their pre-tokens by number, and the distinct ones, frequent ones first."""
        first = TaskContext.get().partitionId() << 32
        for number, block in enumerate(blocks(batches, limit=limit)):
            known = Vocabulary(pattern)
            found = [known.numbers(x.decode("utf-8", "replace")) for x in texts_of(block)]
            places, words = np.concatenate(found), [x.encode() for x in known.number]
            del known
            order = np.argsort(-np.bincount(places, minlength=len(words)), kind="stable")
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            at, rows = word_rows(first + number, words, place, buckets)
            yield pa.RecordBatch.from_pylist([{
                "block": first + number, "doc_ids": block.column("doc_id").to_pylist(), "at": at,
                "counts": packed(np.array([len(x) for x in found])), "places": packed(place[places])}, *rows], CUT)

    return pre_tokens


def word_rows(block: int, words: list[bytes], place: np.ndarray, buckets: int) -> tuple[bytes, list[dict]]:
    """The words of a block, one row for each bucket of hashes, and their numbers in the order of these rows."""
    bucket = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % buckets
    order = np.lexsort([place, bucket])
    edges = np.flatnonzero(np.diff(bucket[order].astype(np.int64), prepend=-1, append=buckets))
    rows = []
    for a, b in zip(edges, edges[1:]):
        own = [words[i] for i in order[a:b].tolist()]
        rows.append({"block": block, "bucket": int(bucket[order[a]]), "lengths": packed(np.array([len(x) for x in own])),
                     "words": zlib.compress(b"".join(own))})
    # Numbers ascend within a bucket, so the steps between them are small; at a bucket's end they turn around.
    return packed(np.diff(place[order].astype(np.int64), prepend=0) % (1 << 32)), rows


def packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 to 2**32 - 1, compressed byte by byte: the upper bytes of small ones are zero."""
    width = 4 if len(numbers) and numbers.max() >= 1 << 16 else 2
    planes = np.ascontiguousarray(numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return zlib.compress(bytes([width]) + planes.tobytes(), 1)


def unpacked(raw: bytes) -> np.ndarray:
    raw = zlib.decompress(raw)
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{raw[0]}").ravel().astype(np.int64)


def gathered(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` that begin at ``begin`` and have the given sizes, one after the other."""
    return values[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())]


def word_ids(path: str) -> Callable:
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The ids of the words of each row; rows of one bucket follow each other, and a word has one bucket."""
        encoding = merger(path)
        width = 2 if encoding.max_token_value < 1 << 16 else 4
        bucket, known = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("bucket")[i].as_py() != bucket or len(known) > WORDS:
                    bucket, known = batch.column("bucket")[i].as_py(), {}
                stops = np.cumsum(unpacked(batch.column("lengths")[i].as_py())).tolist()
                raw = zlib.decompress(batch.column("words")[i].as_py())
                words = [raw[a:b] for a, b in zip([0, *stops], stops)]
                for word in set(words).difference(known):
                    known[word] = np.array(encoding.encode_ordinary(word.decode()), f"<u{width}").tobytes()
                ids = [known[x] for x in words]
                yield pa.RecordBatch.from_arrays([
                    batch.column("block").slice(i, 1), batch.column("bucket").slice(i, 1),
                    pa.array([packed(np.array([len(x) // width for x in ids]))], pa.binary()),
                    pa.array([zlib.compress(bytes([width]) + b"".join(ids))], pa.binary())], schema=PARTS)

    return encode


def block_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """The document ids of each block, how many ids each text has and all these ids, from places and the ids of words."""
    for batch in batches:
        for row in range(batch.num_rows):
            doc_ids, counts, places, at, parts = (batch.column(x)[row] for x in ("doc_ids", "counts", "places", "at", "parts"))
            parts = sorted(parts.as_py() or (), key=lambda x: x["bucket"])
            size = np.concatenate([np.empty(0, np.int64), *(unpacked(x["counts"]) for x in parts)])
            ids = np.concatenate([np.empty(0, np.int32), *(flat_ids(x["ids"]) for x in parts)])
            at = np.cumsum(unpacked(at.as_py())) % (1 << 32)
            if len(at) != len(size):
                raise ValueError("a word of a block has no ids")
            order = np.argsort(at)
            begin, size = (np.cumsum(size) - size)[order], size[order]
            places, counts = unpacked(places.as_py()), unpacked(counts.as_py())
            each = size[places]
            bounds = np.r_[0, np.cumsum(each)][np.r_[0, np.cumsum(counts)]]
            yield doc_ids.values, np.diff(bounds), gathered(ids, begin[places], each)


def ids_of_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for doc_ids, counts, ids in block_ids(batches):
        bounds = pa.array(np.r_[0, np.cumsum(counts)], pa.int32())
        yield pa.RecordBatch.from_arrays([doc_ids, pa.ListArray.from_arrays(bounds, pa.array(ids))], schema=ENCODED)


def spelt_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of texts as SPELT says."""
    for found in block_ids(batches):
        yield from spelt(*found)


def flat_ids(raw: bytes) -> np.ndarray:
    raw = zlib.decompress(raw)
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int32)


def kept_by_block(frame: DataFrame) -> DataFrame:
    """Blocks in a table of buckets, so that what their words send back is joined without moving them again.

    A task writes a file for each block that it has, more or less.
    """
    spark = frame.sparkSession
    name = "pre_tokens_" + uuid.uuid4().hex
    frame.write.bucketBy(partitions(frame), "block").option("path", shared_folder(spark, "pre-tokens")).saveAsTable(name)
    return spark.table(name)


def blocks_with_ids(docs: DataFrame, path: str, pattern: str, ident: str, text: str, block: int) -> DataFrame:
    """What ``block_ids`` takes: blocks of texts, joined with the ids of their words."""
    rows = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    kept = kept_by_block(rows.mapInArrow(cut(pattern, block, partitions(rows)), CUT_SQL))
    words = kept.where("bucket is not null").select("block", "bucket", "lengths", "words")
    parts = words.repartition(partitions(words), "bucket").sortWithinPartitions("bucket").mapInArrow(word_ids(path), PARTS_SQL)
    own = parts.groupBy("block").agg(F.collect_list(F.struct("bucket", "counts", "ids")).alias("parts"))
    whole = kept.where("bucket is null").select("block", "doc_ids", "counts", "places", "at").join(own, "block", "left")
    return whole.select("doc_ids", "counts", "places", "at", "parts")


def encoded(docs: DataFrame, path: str, pattern: str, ident: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc_id, ids) for each row of ``docs``: the ids that the merges of a rank file give for each pre-token.

    ``path`` names a file of base64 tokens and ranks that workers can read, ``pattern`` matches the
    pre-tokens; strings of special tokens are ordinary text. NULL and empty texts have no ids.
    Repeated rows, rows with one id and rows without one are encoded one by one. Other columns are
    not looked at. An empty table gives no rows. A text beyond ``block`` bytes is a block by
    itself, whose matches are taken one by one.
    """
    return blocks_with_ids(docs, path, pattern, ident, text, block).mapInArrow(ids_of_texts, "doc_id long, ids array<int>")


def token_table(spark: SparkSession, path: str) -> DataFrame:
    """(id, token): the bytes of each id, as many rows as the vocabulary has."""
    ranks = rank_table(path)
    return spark.createDataFrame(pa.table({"id": pa.array(ranks.values(), pa.int32()), "token": pa.array(ranks.keys(), pa.binary())}))


def with_distinct_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of texts as SPELT says."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        start = 0
        for at, count in enumerate(batch.column("ids").value_lengths().fill_null(0).to_pylist()):
            if size and size + count > IDS:
                held.append(batch.slice(start, at - start))
                yield from joined_texts(held)
                held, size, start = [], 0, at
            size += count
        held.append(batch.slice(start))
    yield from joined_texts(held)


def joined_texts(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if sum(x.num_rows for x in held):
        rows = pa.Table.from_batches(held).combine_chunks()
        lists = rows.column("ids").combine_chunks()
        yield from spelt(rows.column("doc_id").combine_chunks(), lists.value_lengths().fill_null(0).to_numpy(), lists.flatten().to_numpy())


def spelt(doc_ids: pa.Array, counts: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    yield pa.RecordBatch.from_pylist([{"doc_ids": doc_ids.to_pylist(), "counts": packed(counts), "ids": ids.astype("<u4").tobytes()}], SPELT)
    distinct = pa.array(np.unique(ids), pa.int32())
    yield pa.RecordBatch.from_arrays([*(pa.nulls(len(distinct), SPELT.field(i).type) for i in range(3)), distinct], schema=SPELT)


def rejoined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids and bytes of each text of a block, from its row and those of its distinct ids with their tokens."""
    texts, parts = None, []
    for batch in batches:
        heads = set(np.flatnonzero(batch.column("id").is_null().to_numpy(zero_copy_only=False)).tolist())
        edges = sorted(heads | {0, batch.num_rows})
        for a, b in zip(edges, edges[1:]):
            if a in heads:
                if texts:
                    yield text_rows(texts, parts)
                texts, parts = batch.slice(a, 1).to_pylist()[0], []
                a += 1
            if a < b:
                parts.append(batch.slice(a, b - a))
    if texts:
        yield text_rows(texts, parts)


def text_rows(texts: dict, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    found = {i: token for part in parts for i, token in zip(part.column("id").to_pylist(), part.column("token").to_pylist())}
    if None in found.values():
        raise ValueError("an id is not in the table of tokens")
    ids, stops = np.frombuffer(texts["ids"], "<u4"), np.cumsum(unpacked(texts["counts"])).tolist()
    tokens = list(map(found.__getitem__, ids.tolist()))
    spans = list(zip([0, *stops], stops))
    return pa.RecordBatch.from_arrays([pa.array(texts["doc_ids"], pa.int64()), pa.array([texts["ids"][4 * a:4 * b] for a, b in spans], pa.binary()),
                                       pa.array([b"".join(tokens[a:b]) for a, b in spans], pa.binary())], schema=DECODED)


def with_tokens(blocks_of_ids: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) from rows as SPELT says.

    The table of tokens is broadcast: it has as many rows as the vocabulary, whatever the input. The
    join keeps the order of what it reads, so the ids of a block stay behind its texts and no
    shuffle follows.
    """
    return blocks_of_ids.join(F.broadcast(token_table(blocks_of_ids.sparkSession, path)), "id", "left").select(
        "doc_ids", "counts", "ids", "id", "token").mapInArrow(rejoined, "doc_id long, ids binary, text binary")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) for rows of (doc_id, ids): ids as little-endian unsigned 32-bit numbers, and their bytes.

    The distinct ids of a block of texts are exploded, joined with the table of tokens and put in
    the places of the ids. An id without a token raises an error. Bytes need not be valid UTF-8.
    Rows without ids have no bytes.
    """
    return with_tokens(rows.select("doc_id", "ids").mapInArrow(with_distinct_ids, SPELT_SQL), path)


def byte_pair_round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None, ident: str = "doc_id",
                         text: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc_id, ids, text): the ids of each row of ``docs`` and the bytes that they stand for, as ``encoded`` and ``decoded`` give them."""
    path = path or default_path()
    found = blocks_with_ids(docs, path, pattern or default_pattern(), ident, text, block)
    return with_tokens(found.mapInArrow(spelt_blocks, SPELT_SQL), path)
