"""WARC archives with one Zstandard frame per record and a dictionary in a leading skippable frame.

An archive is one byte string: a skippable frame (magic 0x184D2A5D) with the
dictionary, then one Zstandard frame for each record.  ``write_archives``
gives archives as rows ``(archive, content)``, which Spark can keep in any
store; ``read_archives`` takes such rows, or files by way of Spark's
``binaryFile`` source, and validates every header and length.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise

#: Fixed values of the WARC 1.1 and Zstandard formats.
SKIPPABLE = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

ARCHIVE_BYTES = 16 << 20
DICT_BYTES = 32 << 10
TRAIN_BYTES = 1 << 20
STEP = 1 << 15

RECORDS = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
           "payload_digest string, payload binary")


class BadArchive(ValueError):
    """An archive that breaks the format."""


def _header_value(text: str) -> str:
    """A header value: control characters and white space are percent-encoded, so no value can end its line."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    if not (name.startswith("<urn:x-page:") and name.endswith(">")):
        raise BadArchive(f"record id {name!r}")
    return None if name[12:-1] == "null" else int(name[12:-1])


def encode_record(page_id: int | None, url: str | None, payload: bytes | None, size: int, sha1_hex: str,
                  refers_to: int | None, date: str) -> bytes:
    """One record; ``payload`` None makes it a revisit of the page ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    digest = base64.b32encode(bytes.fromhex(sha1_hex)).decode()
    fields = [("WARC-Type", "revisit" if payload is None else "response"), ("WARC-Record-ID", _name(page_id)),
              ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:
        fields.append(("WARC-Target-URI", _header_value(url)))
    if payload is None:
        fields += [("WARC-Refers-To", _name(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes, first: bytes) -> dict[str, str]:
    lines = head.split(b"\r\n")
    if not lines[0].startswith(first):
        raise BadArchive(f"first line {lines[0][:40]!r}")
    out = {}
    for line in lines[1:]:
        key, colon, value = line.partition(b":")
        if not colon or not key.strip():
            raise BadArchive(f"header line {line[:40]!r}")
        out[key.decode().strip().lower()] = value.decode().strip()
    return out


def decode_record(data: bytes) -> tuple[int | None, str | None, str, int | None, int, str, bytes | None]:
    """The fields of ``RECORDS`` of one decompressed frame; raises ``BadArchive`` where header, length or digest is wrong."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    if not blank:
        raise BadArchive("no end of headers")
    fields = _fields(head, VERSION)
    if missing := [k for k in NEED if k.lower() not in fields]:
        raise BadArchive(f"no header {missing[0]}")
    length = fields["content-length"]
    if not length.isdecimal() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise BadArchive(f"content length {length}, frame holds {len(rest) - 4}")
    http, blank, payload = rest[:-4].partition(b"\r\n\r\n")
    size = _fields(http, b"HTTP/").get("content-length", "") if blank else ""
    if not size.isdecimal():
        raise BadArchive("no payload length")
    method, _, digest = fields.get("warc-payload-digest", "").partition(":")
    try:
        sha1 = base64.b32decode(digest).hex() if method == "sha1" else ""
    except ValueError:
        sha1 = ""
    if len(sha1) != 40:
        raise BadArchive("no payload digest")
    kind, page = fields["warc-type"], _page(fields["warc-record-id"])
    url = fields.get("warc-target-uri")
    if kind == "response":
        if len(payload) != int(size) or hashlib.sha1(payload).hexdigest() != sha1:
            raise BadArchive(f"payload of {fields['warc-record-id']} does not fit its length or digest")
        return page, url, kind, None, int(size), sha1, payload
    if kind == "revisit":
        if payload or fields.get("warc-profile") != REVISIT_PROFILE or "warc-refers-to" not in fields:
            raise BadArchive(f"revisit {fields['warc-record-id']}")
        return page, url, kind, _page(fields["warc-refers-to"]), int(size), sha1, None
    raise BadArchive(f"record type {kind!r}")


def encode_archive(records: list[bytes], level: int = 3) -> bytes:
    """The archive of these records.  The dictionary is trained on the first
    ``TRAIN_BYTES`` of them (a documented bound); where they are too few or
    too alike to train one, the archive has none, as the format allows."""
    samples, held = [], 0
    for record in records:
        if held >= TRAIN_BYTES:
            break
        samples.append(record[:DICT_BYTES])
        held += len(samples[-1])
    lead, options = b"", {}
    try:
        dictionary = zstandard.train_dictionary(DICT_BYTES, samples)
    except zstandard.ZstdError:
        dictionary = None
    if dictionary is not None:
        packed = zstandard.ZstdCompressor(level=level).compress(dictionary.as_bytes())
        lead = struct.pack("<II", SKIPPABLE, len(packed)) + packed
        options["dict_data"] = dictionary
    frame = zstandard.ZstdCompressor(level=level, write_checksum=True, **options)
    return b"".join([lead, *map(frame.compress, records)])


def frames(content: bytes) -> Iterator[bytes]:
    """The decompressed records of an archive, one per frame."""
    view, at, options = memoryview(content), 0, {}
    if len(content) >= 8 and struct.unpack_from("<I", content)[0] == SKIPPABLE:
        size = struct.unpack_from("<I", content, 4)[0]
        lead = content[8:8 + size]
        if len(lead) != size:
            raise BadArchive("dictionary frame is cut short")
        at = 8 + size
        raw = zstandard.ZstdDecompressor().decompress(lead) if lead[:4] == FRAME_MAGIC else lead
        options["dict_data"] = zstandard.ZstdCompressionDict(raw)
    reader = zstandard.ZstdDecompressor(**options)
    while at < len(content):
        if content[at:at + 4] != FRAME_MAGIC:
            raise BadArchive(f"no frame at byte {at}")
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            piece = view[at:at + STEP]
            if not len(piece):
                raise BadArchive("last frame is cut short")
            try:
                parts.append(frame.decompress(piece))
            except zstandard.ZstdError as e:
                raise BadArchive(f"frame that ends after byte {at}: {e}") from e
            at += len(piece) - (len(frame.unused_data) if frame.eof else 0)
        yield b"".join(parts)


def plan_records(pages: DataFrame, min_revisit: int = 1000, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """``(page_id, url, payload, payload_bytes, payload_digest, refers_to)`` per row of ``pages``.

    Of rows with equal payloads of at least ``min_revisit`` bytes, those with
    the largest id are responses (``refers_to`` null) and the others refer to
    it.  A null id is smaller than any other; where all are null, all are
    responses.  Null html is an empty payload.  The table of repeated payloads
    is written first, so Spark broadcasts it only when its files are small.
    """
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"),
                       F.sha1("payload").alias("payload_digest"))
    groups = rows.where(F.col("payload_bytes") >= min_revisit).groupBy("payload_digest").agg(
        F.max("page_id").alias("newest"), F.count("*").alias("n")).where("n > 1 and newest is not null")
    groups = materialise(groups.drop("n"), "repeated-payloads")
    older = ~F.col("page_id").eqNullSafe(F.col("newest"))
    return rows.join(groups, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(F.col("newest").isNotNull() & older, F.col("newest")).alias("refers_to"))


def write_archives(records: DataFrame, date: str = "2024-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """``(archive, content)``: archives of about ``archive_bytes`` of records each, from ``plan_records`` rows.

    A task holds the records of one archive at a time; revisits carry no payload.
    """
    slim = records.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
                          "payload_bytes", "payload_digest", "refers_to")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, held, records = TaskContext.get().partitionId(), 0, 0, []

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([f"part-{part:05d}-{number:05d}.warc.zst"]), pa.array([encode_archive(records)], pa.binary())],
                names=["archive", "content"])

        for batch in batches:
            for i in range(batch.num_rows):
                page, url, payload, size, digest, refers = (batch.column(k)[i].as_py() for k in range(6))
                records.append(encode_record(page, url, payload, size, digest, refers, date))
                held += len(records[-1])
                if held >= archive_bytes:
                    yield archive()
                    number, held, records = number + 1, 0, []
        if records:
            yield archive()

    return slim.mapInArrow(scan, "archive string, content binary")


def read_archives(archives: DataFrame, content_col: str = "content", payloads: bool = True) -> DataFrame:
    """The records (``RECORDS``) of all archives; a broken archive raises ``BadArchive`` and names the fault.

    ``payloads`` False checks payloads but does not return them.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("payload", pa.binary())])
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for record in map(decode_record, frames(content.as_py() or b"")):
                    rows.append(record if payloads else (*record[:6], None))
                    held += len(record[6] or b"") + 100
                    if held >= 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    return archives.select(F.col(content_col)).mapInArrow(scan, RECORDS)


def read_files(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of ``.warc.zst`` files in any store that Spark reads (a file of up to 2 GB each)."""
    return read_archives(spark.read.format("binaryFile").load(path), "content", payloads)


def round_trip(pages: DataFrame, min_revisit: int = 1000) -> DataFrame:
    """Write every page as a record, keep the archives in the shared folder, and read them back."""
    return read_archives(materialise(write_archives(plan_records(pages, min_revisit)), "archives"), payloads=False)
