"""WARC archives of pages: records are written in segments and put together again on reading.

A payload that other pages share is archived once; the others refer to it. A record longer than a
segment goes on in continuation records, which name the record that began it, are numbered, and the
last of which states the length of the whole. HTTP payloads are framed in chunks, files compressed.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.llm.rows import NO_ID, blocks, doc_of
from curbside.session import shared_folder

SEGMENT = 8192
CHUNK = 4096
#: A record has at most a segment and its fields, so this bounds a file to some 18 MB before compression.
RECORDS_PER_FILE = 2000
# Fixed values of the formats.
VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
GZIP = b"\x1f\x8b"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
HTTP_REVISIT = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

PARTS_SQL = ("origin string, number int, kind string, page long, refers_to long, digest string, size long, "
             "total long, block binary")
PARTS = pa.schema([("origin", pa.string()), ("number", pa.int32()), ("kind", pa.string()), ("page", pa.int64()),
                   ("refers_to", pa.int64()), ("digest", pa.string()), ("size", pa.int64()), ("total", pa.int64()),
                   ("block", pa.binary())])


def chunked(payload: bytes) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(x), x) for x in (payload[i:i + CHUNK] for i in range(0, len(payload), CHUNK))]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked message body; chunk extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        parts.append(body[line + 2:line + 2 + size])
        if len(parts[-1]) != size or body[line + 2 + size:line + 4 + size] != b"\r\n":
            raise ValueError("a chunk is cut short")
        at = line + 4 + size


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the blank lines that end it."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))])
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block


def name(page: int, row: int) -> str:
    return f"<urn:page:{page}:{row}>"


def segments(first: list[tuple[str, object]], origin: str, block: bytes, segment: int) -> list[bytes]:
    """The record, or its first segment and the continuation records."""
    if len(block) <= segment:
        return [record(first, block)]
    out = [record([*first, ("WARC-Segment-Number", 1)], block[:segment])]
    for number, at in enumerate(range(segment, len(block), segment), 2):
        fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", origin[:-1] + f":{number}>"), ("WARC-Date", DATE),
                  ("WARC-Segment-Origin-ID", origin), ("WARC-Segment-Number", number)]
        if at + segment >= len(block):
            fields.append(("WARC-Segment-Total-Length", len(block)))
        out.append(record(fields, block[at:at + segment]))
    return out


def record_writer(segment: int):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "payload"):
            firsts, others = [], []
            for page, row, url, payload, digest, target, target_row in zip(*(
                    block.column(x).to_pylist() for x in ("page", "row", "url", "payload", "digest", "target", "target_row"))):
                origin = name(page, row)
                fields = [("WARC-Type", "response" if target is None else "revisit"), ("WARC-Record-ID", origin),
                          ("WARC-Date", DATE), ("WARC-Target-URI", quote(url or "urn:none", safe=":/?#[]@!$&'()*+,;=%~")),
                          ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())]
                if target is None:
                    parts = segments([*fields, ("Content-Type", "application/http; msgtype=response")], origin,
                                     HTTP + chunked(payload or b""), segment)
                    firsts.append(parts[0])
                    others.extend(parts[1:])
                else:
                    firsts.append(record([*fields, ("WARC-Profile", PROFILE), ("WARC-Refers-To", name(target, target_row)),
                                          ("Payload-Length", len(payload)),
                                          ("Content-Type", "application/http; msgtype=response")], HTTP_REVISIT))
            yield pa.RecordBatch.from_pydict({"record": pa.array(firsts + others[::-1], pa.binary())})

    return write


def write_archives(pages: DataFrame, folder: str, ident: str = "page_id", payload: str = "html", url: str = "url",
                   shortest: int = 1000, segment: int = SEGMENT) -> None:
    """Writes a record for each page into archives below ``folder``.

    Of pages with equal payloads of at least ``shortest`` bytes, that with the largest id is a
    response and the others revisit it. NULL payloads are empty. Pages without an id are responses.
    """
    rows = pages.select(doc_of(ident).alias("page"), F.xxhash64(F.col(ident).cast("long"), F.col(url).cast("string"),
                        F.col(payload).cast("string")).alias("row"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary").alias("payload"))
    digests = rows.select("page", "row", F.sha1("payload").alias("digest"), F.length("payload").alias("size"))
    shared = digests.where((F.col("size") >= shortest) & (F.col("page") != NO_ID)).groupBy("digest").agg(
        F.max(F.struct("page", "row")).alias("last"), F.count("*").alias("n")).where("n > 1").select("digest", "last")
    targets = (digests.where((F.col("size") >= shortest) & (F.col("page") != NO_ID)).join(shared, "digest")
               .where("page < last.page").select("page", "row", F.col("last.page").alias("target"),
                                                 F.col("last.row").alias("target_row")).distinct())
    (rows.join(targets, ["page", "row"], "left").withColumn("digest", F.sha1("payload"))
     .mapInArrow(record_writer(segment), "record binary").select(F.col("record").cast("string"))
     .write.option("lineSep", END.decode()).option("maxRecordsPerFile", RECORDS_PER_FILE)
     .option("compression", "gzip").text(folder))


FIELD = re.compile(rb"([A-Za-z-]+):[ \t]*(.*)\r\n")
PAGE = re.compile(r"<urn:page:(-?\d+):")


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The fields, names in lower case, and the block of each record of an archive."""
    at = 0
    while at < len(content):
        stop = content.index(END, at) + len(END)
        if not content.startswith(VERSION, at):
            raise ValueError(f"no record at byte {at}")
        fields = {k.decode().lower(): v.decode() for k, v in FIELD.findall(content[at:stop])}
        size = int(fields["content-length"])
        yield fields, content[stop:stop + size]
        at = stop + size + len(END)


def page_of(identifier: str | None) -> int | None:
    return int(PAGE.match(identifier)[1]) if identifier else None


def archive_reader(payloads: bool):
    """Parts of records; whole ones are decoded at once."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                if content.startswith(GZIP):
                    content = gzip.decompress(content)
                out: dict[str, list] = {x: [] for x in PARTS.names}
                for fields, block in records(content):
                    origin = fields.get("warc-segment-origin-id", fields["warc-record-id"])
                    number = int(fields.get("warc-segment-number", 0))
                    kind, size, digest = fields["warc-type"], None, fields.get("warc-payload-digest")
                    digest = digest and base64.b32decode(digest.removeprefix("sha1:")).hex()
                    if kind == "revisit":
                        size, block = int(fields["payload-length"]), None
                    elif not number:
                        block = decoded(block, digest)
                        size, block = len(block), block if payloads else None
                    total = fields.get("warc-segment-total-length")
                    for key, value in zip(out, (origin, number, kind, page_of(origin), page_of(fields.get("warc-refers-to")),
                                                digest, size, total and int(total), block)):
                        out[key].append(value)
                yield pa.RecordBatch.from_pydict(out, PARTS)

    return read


def decoded(block: bytes, digest: str | None) -> bytes:
    """The payload of an HTTP message; it must have the stated digest."""
    head, _, body = block.partition(END)
    payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
    if digest and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError("a payload differs from its digest")
    return payload


def assembler(payloads: bool):
    """Records from their parts, in the order of their numbers."""

    def assemble(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                parts = row.pop("parts")
                if row.pop("number"):
                    if [x["number"] for x in parts] != list(range(1, len(parts) + 1)):
                        raise ValueError(f"segments of page {row['page']} are missing")
                    whole = b"".join(x["block"] for x in parts)
                    if parts[-1]["total"] != len(whole):
                        raise ValueError(f"page {row['page']} has {len(whole)} bytes and states {parts[-1]['total']}")
                    payload = decoded(whole, row["digest"])
                    row["size"] = len(payload)
                else:
                    payload = parts[0]["block"]
                row["payload"] = payload if payloads else None
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("page", pa.int64()), ("size", pa.int64()), ("digest", pa.string()), ("kind", pa.string()),
                ("refers_to", pa.int64()), ("payload", pa.binary())]))

    return assemble


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload) for each record.

    Continuation records are grouped by the record that they go on with, ordered by number, joined
    and compared with the stated length; chunks are taken apart and digests verified. A record that
    an archive holds twice is read once. Revisits have the size and digest of the payload that they
    refer to, and no payload of their own. Without ``payloads`` none is returned.
    """
    parts = spark.read.format("binaryFile").load(folder).select("content").mapInArrow(
        archive_reader(payloads), PARTS_SQL)
    whole = parts.groupBy("origin").agg(
        F.max("page").alias("page"), F.max("number").alias("number"), F.max("size").alias("size"),
        F.max("digest").alias("digest"), F.max("refers_to").alias("refers_to"),
        F.max(F.when(F.col("kind") != "continuation", F.col("kind"))).alias("kind"),
        F.sort_array(F.collect_set(F.struct("number", "total", "block"))).alias("parts")).drop("origin")
    read = whole.mapInArrow(assembler(payloads), "page long, size long, digest string, kind string, "
                            "refers_to long, payload binary")
    return read.select(F.when(F.col("page") != NO_ID, F.col("page")).alias("page_id"), F.col("size").alias("payload_bytes"),
                       F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to", "payload")


def archive_round_trip(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Writes archives into the shared folder and reads them back.

    Rows that are the same in id, address and payload are one page and give one row; rows with one
    id that differ give a row each. NULL payloads are empty; pages without an id are responses. An
    empty table gives no rows. Other columns are not looked at. A task holds an archive whole, of
    at most RECORDS_PER_FILE records of some SEGMENT bytes.
    """
    folder = shared_folder(pages.sparkSession, "warc")
    write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder, payloads)
