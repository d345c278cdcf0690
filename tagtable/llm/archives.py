"""WARC archives of Zstandard frames, one per record, with the dictionary in a leading skippable frame.

Writing goes through Spark's text writer, so it reaches any file system that Spark does and is committed as a
whole: a row is one record's frame as raw bytes, and the line separator is itself a skippable frame of length
0, which readers of Zstandard pass over. The first row of a file is the skippable frame of the dictionary,
which is trained on the first records of that file.

Of records with the same payload of at least ``LEAST`` bytes the one with the largest ``page_id`` is stored as
a response, the others as revisits without a payload that refer to it. Equal rows with the largest ``page_id``
are all responses.

Defined cases: a missing page counts as empty; a missing ``page_id`` is smaller than any other and reads back
as missing; a missing URL is left out; a page of any length is one record, which its archive holds whole; control characters in URLs are percent-encoded; other columns are not
stored; an empty table gives files without records.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from tagtable.llm.store import map_batches
from tagtable.session import shuffle_width

LEAST = 1000
DICTIONARY_MAGIC = 0x184D2A5D  # fixed value: the skippable frame of a dictionary in a WARC file
FRAME_MAGIC = 0xFD2FB528  # fixed value: a Zstandard frame
SKIPPABLE = range(0x184D2A50, 0x184D2A60)  # fixed values: frames that decoders skip
SEPARATOR = struct.pack("<II", 0x184D2A50, 0)
DICTIONARY_BYTES = 1 << 15
SAMPLES, SAMPLE_BYTES = 512, 1 << 22  # what a file's dictionary is trained on, at most
SALTS = 64
LEVEL = 3
ARCHIVE_BYTES = 1 << 28  # payload that an archive is made of, about


def frame_of(block: bytes, magic: int) -> bytes:
    return struct.pack("<II", magic, len(block)) + block


def dictionary_of(records: list[bytes]) -> bytes:
    """A dictionary from some records; raw bytes of the first record where there are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records).as_bytes()
    except (zstandard.ZstdError, ValueError, MemoryError):
        return (records[0] if records else b"")[:DICTIONARY_BYTES]


def record_id(page_id: int | None) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP header of its payload, but not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(0x21, 0x7F)))))
    if refers_to is not None:
        lines.append("WARC-Refers-To: " + record_id(refers_to))
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_roles(pages: DataFrame, parts: int | None = None) -> DataFrame:
    """``page_id, url, html, digest`` and ``refers_to``, the response's page for revisits; dealt to ``parts`` partitions.

    Rows of a payload that repeats are dealt to ``SALTS`` places. Small payloads, which have no revisits, are dealt out
    row by row and meet no other rows.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    read = pages.select("page_id", "url", payload.alias("html"), F.sha1(payload.cast("binary")).alias("digest"))
    large = F.octet_length("html") >= LEAST
    winners = (
        read.where(large)
        .groupBy("digest")
        .agg(F.max("page_id").alias("winner"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .select(
            F.col("digest").alias("_digest"),
            "winner",
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_own"),
        )
    )
    place = F.xxhash64("page_id", "url")
    read = read.withColumn("_key", F.when(large, F.col("digest")).otherwise(""))
    read = read.withColumn("_salt", F.when(large, F.pmod(place, F.lit(SALTS))).otherwise(place))
    if parts:
        read = read.repartition(parts, "_key", "_salt")
    joined = read.join(winners, (F.col("_key") == F.col("_digest")) & (F.col("_salt") == F.col("_own")), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("winner")), F.col("winner"))
    return joined.select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """One archive per partition, of which there are as many as payloads of about ``archive_bytes`` need."""
    size = pages.agg(F.sum(F.octet_length(F.col("html").cast("string")).cast("long"))).first()[0] or 0
    parts = max(shuffle_width(pages.sparkSession), -(-size // archive_bytes))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, held, size = None, [], 0
        for batch in batches:
            out = []
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for page_id, url, html, digest, refers_to in zip(*columns, strict=True):
                made = record(page_id, url, html.encode(), digest, refers_to)
                if coder:
                    out.append(coder.compress(made))
                    continue
                held.append(made)
                size += len(made)
                if len(held) == SAMPLES or size >= SAMPLE_BYTES:
                    coder, first = _start(held)
                    out += first
                    held = []
            yield _rows(out)
        if held:
            yield _rows(_start(held)[1])

    map_batches(with_roles(pages, parts), pack, "value binary").select(F.col("value").cast("string").alias("value")).write.option(
        "lineSep", SEPARATOR.decode()
    ).text(path)


def _start(held: list[bytes]) -> tuple[zstandard.ZstdCompressor, list[bytes]]:
    dictionary = dictionary_of(held)
    coder = zstandard.ZstdCompressor(LEVEL, zstandard.ZstdCompressionDict(dictionary), write_checksum=True, write_content_size=True)
    return coder, [frame_of(dictionary, DICTIONARY_MAGIC), *map(coder.compress, held)]


def _rows(values: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], names=["value"])


class ArchiveError(ValueError):
    """An archive whose frames, headers or lengths are not as they should be."""


def records_of(archive: bytes | memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record: the dictionary is loaded first, then a frame decoded per record."""
    view, at, decoder, leading = memoryview(archive), 0, zstandard.ZstdDecompressor(), True
    while at < len(view):
        if at + 8 > len(view):
            raise ArchiveError("an archive ends within a frame's header")
        magic, size = struct.unpack_from("<II", view, at)
        if magic in SKIPPABLE:
            if at + 8 + size > len(view):
                raise ArchiveError("a skippable frame is longer than its archive")
            if magic == DICTIONARY_MAGIC:
                if not leading:
                    raise ArchiveError("a dictionary comes after the first frame")
                block = bytes(view[at + 8 : at + 8 + size])
                if block[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary may be compressed itself
                    block = zstandard.ZstdDecompressor().decompress(block)
                decoder = zstandard.ZstdDecompressor(zstandard.ZstdCompressionDict(block))
            at += 8 + size
        elif magic == FRAME_MAGIC:
            reader = decoder.decompressobj()
            try:
                data = reader.decompress(view[at:])
            except zstandard.ZstdError as error:
                raise ArchiveError(f"a frame can't be decoded: {error}") from error
            if not reader.eof:
                raise ArchiveError("an archive ends within a frame")
            at = len(view) - len(reader.unused_data)
            yield parse(data)
        else:
            raise ArchiveError(f"no frame starts at byte {at}")
        leading = False


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record, which must fill its frame exactly."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise ArchiveError("a frame holds no WARC record")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(": ")
        if not colon or name in fields:
            raise ArchiveError(f"a header line is malformed: {line[:80]}")
        fields[name] = value
    for name in ("WARC-Type", "WARC-Record-ID", "Content-Length"):
        if name not in fields:
            raise ArchiveError(f"a record has no {name}")
    length = fields["Content-Length"]
    if not length.isdigit() or len(rest) != int(length) + 4 or rest[int(length) :] != b"\r\n\r\n":
        raise ArchiveError("a record's length differs from its Content-Length")
    return fields, rest[: int(length)]


def page_of(fields: dict[str, str], block: bytes) -> tuple:
    """``page_id, url, html, payload_bytes, payload_digest, record_type, refers_to`` of a record of ``record``."""
    http, found, payload = block.partition(b"\r\n\r\n")
    size = re.search(rb"\r\nContent-Length: (\d+)", http)
    digest = fields.get("WARC-Payload-Digest", "")
    if not found or not size or not digest.startswith("sha1:"):
        raise ArchiveError("a record has no HTTP header or no digest")
    stored = fields["WARC-Type"] == "response"
    if stored and (len(payload) != int(size[1]) or hashlib.sha1(payload).hexdigest() != digest[5:]):
        raise ArchiveError("a payload differs from its length or digest")
    ids = []
    for name in ("WARC-Record-ID", "WARC-Refers-To"):
        value = fields.get(name, "<urn:page:none>").removeprefix("<urn:page:").removesuffix(">")
        ids.append(None if value == "none" else int(value))
    html = payload.decode() if stored else None
    return ids[0], fields.get("WARC-Target-URI"), html, int(size[1]), digest[5:], fields["WARC-Type"], ids[1]


SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("html", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archives in a folder, each validated; an archive is read by one task."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows, size = [], 0
                for fields, block in records_of(archive.as_buffer()):
                    rows.append(page_of(fields, block))
                    size += len(block)
                    if size >= 1 << 22:
                        yield _pages(rows)
                        rows, size = [], 0
                yield _pages(rows)

    schema = "page_id long, url string, html string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return map_batches(spark.read.format("binaryFile").load(path).select("content"), unpack, schema)


def _pages(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True)], schema=SCHEMA)
