"""Token ids in files of canonical Huffman codes.

Codes are limited in length and made from the counts of all ids. A file is a row of blocks, each
with a header, its documents' ids and lengths, a bit offset for every 256th id of each document,
and the codes. Blocks are independent of each other, and checkpoints let a block be decoded in many
places at once, by a table that the next 16 bits index.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.llm.rows import NO_ID, blocks, keyed, partitions, ranges, stored, texts_of
from curbside.llm.tokens import ENCODED_BYTES, default_path, encoder, with_end
from curbside.session import shared_folder

LONGEST = 16
CHECKPOINT = 256
#: Ids that a block holds at least, unless it is its file's last one.
BLOCK_IDS = 1 << 19
#: Ids of a file, about: some 30 MB, which a task reads as one value.
FILE_IDS = 1 << 24
# Fixed values of the format.
MAGIC = b"HUF1"
HEADER = struct.Struct("<4sIIQIIQ")  # magic, file, block, ids before it in the file, documents, ids, bytes of codes
SEPARATOR = b"\n"

TOKENS_SQL = "doc long, row long, n long, ids binary, seen array<int>, times array<long>"
CODED_SQL = "doc long, row long, n long, checks binary, codes binary"
READ_SQL = "file int, doc long, start long, n long, ids binary"


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """The code lengths of the smallest total, none over ``longest``; 0 for ids that do not occur.

    Package-merge: of the 2 n - 2 cheapest items of the last level, each level's share of single
    ids gets one bit more.
    """
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << longest:
        raise ValueError("more ids than codes of that length")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.int64)
    single, merged = [], weights
    single.append(np.ones(len(weights), bool))
    for _ in range(longest - 1):
        pairs = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, pairs])
        order = np.argsort(both, kind="stable")
        merged = both[order]
        single.append(order < len(weights))
    take = 2 * len(used) - 2
    for is_single in reversed(single):
        n = int(is_single[:take].sum())
        lengths[used[:n]] += 1
        take = 2 * (take - n)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of length, then of id."""
    codes = np.zeros(len(lengths), np.uint32)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    if len(order):
        room = np.uint64(1) << (LONGEST - lengths[order]).astype(np.uint64)
        codes[order] = (np.cumsum(room) - room) >> (LONGEST - lengths[order]).astype(np.uint64)
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value of the next 16 bits, the id and the length of its code."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    room = 1 << (LONGEST - lengths[order].astype(np.int64))
    ids, sizes = np.zeros(1 << LONGEST, np.uint32), np.ones(1 << LONGEST, np.uint8)
    ids[:room.sum()] = np.repeat(order, room)
    sizes[:room.sum()] = np.repeat(lengths[order], room)
    return ids, sizes


def coded(ids: np.ndarray, counts: np.ndarray, codes: np.ndarray, lengths: np.ndarray
          ) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The codes of some documents, each starting a new byte; first bytes; each id's bit offset in its document."""
    sizes = lengths[ids].astype(np.int64)
    sums = np.r_[0, np.cumsum(sizes)]
    heads = np.cumsum(counts) - counts
    bits = sums[heads + counts] - sums[heads]
    first = np.r_[0, np.cumsum((bits + 7) // 8)]
    inner = sums[:-1] - np.repeat(sums[heads], counts)
    at = inner + np.repeat(8 * first[:-1], counts)
    byte = at >> 3
    shifted = codes[ids].astype(np.int64) << (24 - sizes - (at & 7))
    out = np.zeros(first[-1] + 3, np.uint8)
    for i in range(3):
        out[i:] += np.bincount(byte, (shifted >> (16 - 8 * i)) & 255, len(out) - i).astype(np.uint8)
    return out[:first[-1]].tobytes(), first, inner


def tokenizer(path: str, end: int):
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(path)
        narrow = np.uint16 if codes.size <= 1 << 16 else np.uint32
        total = np.zeros(max(codes.size, end + 1), np.int64)
        schema = pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()),
                            ("seen", pa.list_(pa.int32())), ("times", pa.list_(pa.int64()))])
        for block in blocks(batches, "text", ENCODED_BYTES):
            ids, counts = with_end(*codes.encode(texts_of(block)), end)
            total += np.bincount(ids, minlength=len(total))
            raw, size = ids.astype(narrow).tobytes(), narrow().itemsize
            stops = (size * np.cumsum(counts)).tolist()
            empty = pa.nulls(len(counts))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc"), block.column("row"), pa.array(counts),
                 pa.array([raw[a:b] for a, b in zip([0, *stops], stops)], pa.binary()),
                 empty.cast(schema.field("seen").type), empty.cast(schema.field("times").type)], schema=schema)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], f.type) for x, f in zip((None, None, None, None, seen.tolist(), total[seen].tolist()),
                                                   schema)], schema=schema)

    return encode


def coder(lengths: bytes, narrow: str):
    """Codes each document by itself, so that sorting moves codes and not ids."""

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.frombuffer(lengths, np.uint8)
        codes = canonical_codes(sizes)
        for batch in blocks(batches, "ids", ENCODED_BYTES // 4):
            counts = batch.column("n").to_numpy()
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), narrow)
            raw, first, inner = coded(ids, counts, codes, sizes)
            heads = np.cumsum(counts) - counts
            checks = [inner[h:h + n:CHECKPOINT].astype(np.uint32).tobytes()
                      for h, n in zip(heads.tolist(), counts.tolist())]
            parts = [raw[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("row"), batch.column("n"), pa.array(checks, pa.binary()),
                 pa.array(parts, pa.binary())], ["doc", "row", "n", "checks", "codes"])

    return code


def block_writer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a file from its documents in order."""
    file, block, before, have = TaskContext.get().partitionId(), 0, 0, 0
    held: list[tuple[int, int, bytes, bytes]] = []

    def row() -> pa.RecordBatch:
        docs, counts, checks, codes = zip(*held)
        payload = b"".join(codes)
        header = HEADER.pack(MAGIC, file, block, before, len(docs), sum(counts), len(payload))
        return pa.RecordBatch.from_pydict({"block": pa.array(
            [b"".join([header, np.array(docs, np.int64).tobytes(), np.array(counts, np.uint32).tobytes(),
                       np.array([len(x) for x in codes], np.uint32).tobytes(), *checks, payload])], pa.binary())})

    for batch in batches:
        for doc in zip(*(batch.column(x).to_pylist() for x in ("doc", "n", "checks", "codes"))):
            held.append(doc)
            have += doc[1]
            if have >= BLOCK_IDS:
                yield row()
                block, before, have = block + 1, before + have, 0
                held.clear()
    if held:
        yield row()


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end: int = 1,
                      ident: str = "doc_id", text: str = "text") -> None:
    """Writes the ids of all texts, each followed by ``end``, into files below ``folder``.

    Files lie one after another in ascending order of the document ids, and so do the blocks in
    each; rows without an id come first, rows with one id in the order of a hash. NULL and empty
    texts have the id ``end`` alone. Repeated rows are written one by one, an empty table gives no
    blocks, other columns are not looked at. Files hold about ``FILE_IDS`` ids at most, unless one
    document has more. The codebook, a length for each id, is a file of its own, and so is the
    number of ids in each file.
    """
    spark = docs.sparkSession
    path = path or default_path()
    tokens = stored(keyed(docs, ident, text).mapInArrow(tokenizer(path, end), TOKENS_SQL), "tokens")
    # As many rows as the vocabulary has ids, whatever the number of documents.
    counted = (tokens.where("seen is not null").select(F.explode(F.arrays_zip("seen", "times")).alias("x"))
               .groupBy("x.seen").agg(F.sum("x.times").alias("times")).collect())
    size = max(encoder(path).size, end + 1)
    counts = np.zeros(size, np.int64)
    for seen, times in counted:
        counts[seen] = times
    lengths = code_lengths(counts)
    own = tokens.where("ids is not null")
    # Shares of the documents by rank, one for each file.
    place, n = ranges(own, max(partitions(docs), -(-int(counts.sum()) // FILE_IDS)))
    coded_docs = own.select("doc", "row", "n", "ids").mapInArrow(
        coder(lengths.tobytes(), "<u2" if size <= 1 << 16 else "<u4"), CODED_SQL)
    (coded_docs.repartitionById(n, place).sortWithinPartitions("doc", "row")
     .mapInArrow(block_writer, "block binary").select(F.col("block").cast("string"))
     .write.option("lineSep", SEPARATOR.decode()).text(folder + "/blocks"))
    own.groupBy(place.alias("file")).agg(F.sum("n").alias("n")).coalesce(1).write.parquet(folder + "/lengths")
    book = spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary")
    book.coalesce(1).write.parquet(folder + "/codebook")


def headers(content: bytes) -> Iterator[tuple[tuple, int]]:
    """The headers of a file and where each ends."""
    at = 0
    while at < len(content):
        head = HEADER.unpack_from(content, at)
        if head[0] != MAGIC:
            raise ValueError(f"no block at byte {at}")
        at += HEADER.size
        yield head, at
        sizes = np.frombuffer(content, np.uint32, head[4], at + 8 * head[4])
        checks = int(((sizes + (CHECKPOINT - 1)) // CHECKPOINT).sum())
        at += 16 * head[4] + 4 * checks + head[6] + len(SEPARATOR)


def decoded(content: bytes, head: tuple, at: int, table: tuple[np.ndarray, np.ndarray]
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The documents of a block, their numbers of ids and all ids."""
    _, _, _, _, n_docs, n_ids, n_bytes = head
    docs = np.frombuffer(content, np.int64, n_docs, at)
    counts = np.frombuffer(content, np.uint32, n_docs, at + 8 * n_docs).astype(np.int64)
    sizes = np.frombuffer(content, np.uint32, n_docs, at + 12 * n_docs).astype(np.int64)
    lanes = (counts + CHECKPOINT - 1) // CHECKPOINT
    at += 16 * n_docs
    bit = np.frombuffer(content, np.uint32, int(lanes.sum()), at).astype(np.int64)
    at += 4 * len(bit)
    raw = np.frombuffer(content[at:at + n_bytes] + b"\0\0\0", np.uint8).astype(np.uint32)
    three = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    bit += np.repeat(8 * (np.cumsum(sizes) - sizes), lanes)
    number = np.arange(len(bit)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    todo = np.minimum(np.repeat(counts, lanes) - CHECKPOINT * number, CHECKPOINT)
    target = np.repeat(np.cumsum(counts) - counts, lanes) + CHECKPOINT * number
    order = np.argsort(-todo, kind="stable")
    bit, target = bit[order], target[order]
    alive = np.searchsorted(-todo[order], -np.arange(CHECKPOINT), "left")
    ids, (symbol, length) = np.empty(n_ids, np.uint32), table
    for step in range(CHECKPOINT):
        n = alive[step]
        if not n:
            break
        here = bit[:n]
        window = three[here >> 3] >> (8 - (here & 7)) & 0xFFFF
        ids[target[:n] + step] = symbol[window]
        here += length[window]
    return docs, counts, ids


def decoder(lengths: bytes):
    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(np.frombuffer(lengths, np.uint8))
        for batch in batches:
            for content in batch.column("content").to_pylist():
                for head, at in headers(content):
                    docs, counts, ids = decoded(content, head, at, table)
                    stops = np.cumsum(counts)
                    raw = ids.tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(docs), head[1], np.int32)), pa.array(docs),
                         pa.array(head[3] + stops - counts), pa.array(counts),
                         pa.array([raw[4 * a:4 * b] for a, b in zip((stops - counts).tolist(), stops.tolist())],
                                  pa.binary())], ["file", "doc", "start", "n", "ids"])

    return decode


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the documents of written files, ids as unsigned 32-bit numbers."""
    book = spark.read.parquet(folder + "/codebook").first()[0]
    files = spark.read.format("binaryFile").load(folder + "/blocks").select("content")
    # A row for each file.
    lengths = spark.read.schema("file int, n long").parquet(folder + "/lengths").collect()
    base, before = [], 0
    for file, n in sorted(lengths):
        base.append((file, before))
        before += n
    starts = spark.createDataFrame(base, "file int, base long")
    found = files.mapInArrow(decoder(bytes(book)), READ_SQL).join(F.broadcast(starts), "file")
    return found.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"),
                        (F.col("base") + F.col("start")).alias("start"), F.col("n").alias("n_tokens"), "ids")


def token_round_trip(docs: DataFrame, path: str | None = None, end: int = 1) -> DataFrame:
    """Writes token files into the shared folder and reads them back."""
    folder = shared_folder(docs.sparkSession, "token-files")
    write_token_files(docs, folder, path, end)
    return read_token_files(docs.sparkSession, folder)
