"""From legacy ARC archives to WARC archives.

An ARC file begins with a version block that tells which header lines follow: five fields in version 1, ten in
version 2, the last of them the length of the record. The converter reads records by these lengths and makes the WARC
records that stand for them: an identifier derived from what the record is, the date in ISO form, digests, and the type: of
records with equal payloads the one with the smallest id is the response, the others revisit it and carry no payload.

Archives are gzip files with one member per record. They are built in tasks, about ``size`` bytes of records each, and
written by Spark as text whose only line is the archive, ended by the zero byte that gzip takes for padding; they are
read as binary files. So they may lie in any store that Spark reaches.

Null payloads are empty. A null URL is written as ``-``. Rows without id are responses unless a row with an id has the same
payload; rows that share the smallest id are all responses. A record that cannot be read raises an error.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.tables import materialise, temporary
from starloom.session import scratch

SIZE = 16 << 20  # bytes of records in an archive, before compression
LEVEL = 3
# The fields of a header line by version, and the profile of revisits of equal payloads.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARC_DDL = "id string, url string, ip string, date string, mime string, header binary, payload binary, digest string"
WARC_DDL = "id string, url string, date string, record_id string, record_type string, payload binary, payload_bytes bigint, payload_digest string, refers_to string"


def sha1(data: bytes) -> str:
    """Bare base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _member(record: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def _one_line(value: str | None) -> str:
    return "-" if value is None else value.replace("\r", "%0D").replace("\n", "%0A")


def _packed(rows: Iterable[bytes], begin: Callable[[int], bytes], size: int) -> Iterator[bytes]:
    """Archives of the records, each begun with the record ``begin`` gives for its number."""
    parts, held, number = [], 0, 0
    for record in rows:
        if not parts:
            parts.append(_member(begin(number)))
        parts.append(_member(record))
        held += len(record)
        if held >= size:
            yield b"".join(parts)
            parts, held, number = [], 0, number + 1
    if parts:
        yield b"".join(parts)


def write_archives(rows: DataFrame, record: Callable, begin: Callable[[int], bytes], path: str, size: int = SIZE) -> str:
    """``rows`` as archives of ``record`` (a function of a row as a dict and the number of its archive) under ``path``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield record({n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)})

        for archive in _packed(records(), begin, size):
            yield pa.record_batch([pa.array([archive], pa.binary())], ["archive"])

    archives = rows.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
    archives.write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)
    return path


def read_archives(spark: SparkSession, path: str, parse: Callable, ddl: str, columns: list[str] | None = None) -> DataFrame:
    """The records of all archives under ``path``; ``parse`` gives dicts from an open file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    fields = spark.range(0).selectExpr(*[f"cast(null as {c.split()[1]}) {c.split()[0]}" for c in ddl.split(", ")])
    names = columns or fields.columns
    kinds = {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64()}
    types = [kinds[dict(fields.dtypes)[n]] for n in names]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[dict]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)], names)

        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for row in parse(open_archive(content.as_py())):
                    rows.append(row)
                    held += len(row["payload"] or b"") + 500
                    if held >= 4 << 20:
                        yield flush(rows)
                        rows, held = [], 0
                if rows:
                    yield flush(rows)

    return files.mapInArrow(run, fields.select(*names).schema)


def open_archive(content: bytes) -> io.BufferedReader:
    """A file to read, unpacked if it is gzip; the padding at the end is dropped."""
    if content[:2] == b"\x1f\x8b":
        return io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 16)
    return io.BufferedReader(io.BytesIO(content.rstrip(b"\0")))


def _exactly(file: io.BufferedReader, n: int) -> bytes:
    data = file.read(n)
    if len(data) != n:
        raise ValueError(f"record of {n} bytes ends after {len(data)}")
    return data


# --- ARC --------------------------------------------------------------------------------------------------


def arc_begin(version: int, date: str) -> Callable[[int], bytes]:
    """The version block of an archive."""

    def begin(number: int) -> bytes:
        block = f"{version} 0 starloom\n{ARC_FIELDS[version]}\n\n".encode()
        fields = {"URL": f"filedesc://{number}.arc", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain"}
        fields |= {"Result-code": "200", "Checksum": "-", "Location": "-", "Offset": "0", "Filename": f"{number}.arc", "Archive-length": str(len(block))}
        return " ".join(fields[f] for f in ARC_FIELDS[version].split()).encode() + b"\n" + block + b"\n"

    return begin


def arc_record(version: int, date: str) -> Callable[[dict], bytes]:
    """The record of a page: a header line, an HTTP header that carries the id, and the payload."""

    def record(row: dict) -> bytes:
        payload = row["payload"] or b""
        own = "" if row["id"] is None else f"X-Source-Id: {_one_line(row['id'])}\r\n"
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
        fields = {"URL": _one_line(row["url"]), "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/html"}
        fields |= {"Result-code": "200", "Checksum": sha1(block), "Location": "-", "Offset": "0", "Filename": "-", "Archive-length": str(len(block))}
        return " ".join(fields[f] for f in ARC_FIELDS[version].split()).encode() + b"\n" + block + b"\n"

    return record


def _http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP header, empty if there is none, and payload."""
    if block.startswith(b"HTTP/"):
        head, gap, payload = block.partition(b"\r\n\r\n")
        if gap:
            return head + gap, payload
    return b"", block


def _header_value(header: bytes, name: bytes) -> str | None:
    for line in header.split(b"\r\n"):
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name:
            return value.strip().decode("utf-8", "replace")
    return None


def parse_arc(file: io.BufferedReader) -> Iterator[dict]:
    """The records of an ARC file, read by the lengths that their header lines declare."""
    fields: list[str] = []
    while line := file.readline():
        if not line.strip():
            continue
        # Only the URL may hold a space, so the fields are counted from the end. The version block has its version's.
        text = line.rstrip(b"\r\n").decode("utf-8", "replace")
        if not fields:
            block = _exactly(file, int(text.rsplit(" ", 1)[-1]))
            version = int(block.split(b" ", 1)[0])
            if not text.startswith("filedesc://") or version not in ARC_FIELDS:
                raise ValueError(f"no version block of ARC: {text[:80]}")
            fields = ARC_FIELDS[version].split()
            continue
        values = text.rsplit(" ", len(fields) - 1)
        if len(values) != len(fields):
            raise ValueError(f"{len(values)} of {len(fields)} fields in an ARC header: {text[:80]}")
        got = dict(zip(fields, values, strict=True))
        header, payload = _http(_exactly(file, int(got["Archive-length"])))
        url = None if got["URL"] == "-" else got["URL"]
        own = _header_value(header, b"x-source-id")
        yield {"id": own, "url": url, "ip": got["IP-address"], "date": got["Archive-date"], "mime": got["Content-type"], "header": header, "payload": payload, "digest": sha1(payload)}


# --- WARC -------------------------------------------------------------------------------------------------


def iso_date(digits: str) -> str:
    """From the 14 digits of ARC; shorter ones are filled up as the earliest moment they can mean."""
    full = digits[:14] + "00000101000000"[len(digits[:14]) :]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def record_id(row: dict) -> str:
    """The same for the same record wherever and however often it is converted."""
    named = "\n".join(str(row[n]) for n in ("id", "url", "date", "digest"))
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, named)}>"


def _warc(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in headers if v is not None)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def warc_begin(number: int) -> bytes:
    block = b"software: starloom\r\nformat: WARC File Format 1.1\r\n"
    name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'warcinfo {number}')}>"
    return _warc([("WARC-Type", "warcinfo"), ("WARC-Record-ID", name), ("WARC-Date", iso_date("1970")), ("Content-Type", "application/warc-fields")], block)


def warc_record(row: dict) -> bytes:
    """A response, or a revisit of the response that ``first`` tells of."""
    payload, first = row["payload"] or b"", row["first"]
    revisit = first is not None and row["id"] != first["id"]
    block = (row["header"] or b"") + (b"" if revisit else payload)
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(row)),
        ("WARC-Date", iso_date(row["date"])),
        ("WARC-Target-URI", row["url"]),
        ("WARC-IP-Address", row["ip"]),
        ("WARC-Payload-Digest", "sha1:" + row["digest"]),
        ("WARC-Block-Digest", "sha1:" + sha1(block)),
        ("X-Source-Id", row["id"]),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response" if row["header"] else row["mime"]),
    ]
    if revisit:
        headers += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(first | {"digest": row["digest"]})),
            ("WARC-Refers-To-Target-URI", first["url"]),
            ("WARC-Refers-To-Date", iso_date(first["date"])),
            ("X-Refers-To-Source-Id", first["id"]),
        ]
    return _warc(headers, block)


def parse_warc(file: io.BufferedReader) -> Iterator[dict]:
    """The responses and revisits of a WARC file; payloads have to agree with their digests."""
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:80]!r}")
        headers = {}
        while (line := file.readline()).strip():
            key, _, value = line.partition(b":")
            headers[key.decode().lower()] = value.strip().decode("utf-8", "replace")
        block = _exactly(file, int(headers["content-length"]))
        kind = headers["warc-type"]
        if kind not in ("response", "revisit"):
            continue
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
        payload = None if kind == "revisit" else _http(block)[1]
        if payload is not None and sha1(payload) != digest:
            raise ValueError(f"payload of {headers['warc-record-id']} does not have its digest")
        yield {
            "id": headers.get("x-source-id"),
            "url": headers.get("warc-target-uri"),
            "date": headers["warc-date"],
            "record_id": headers["warc-record-id"],
            "record_type": kind,
            "payload": payload,
            "payload_bytes": int(headers["x-payload-length"]) if payload is None else len(payload),
            "payload_digest": digest,
            "refers_to": headers.get("x-refers-to-source-id"),
        }


# --- jobs -------------------------------------------------------------------------------------------------


def write_arc(rows: DataFrame, path: str, version: int = 1, date: str = "20240101000000", size: int = SIZE) -> str:
    """``rows`` (``id`` string, ``url``, ``payload`` binary) as ARC archives."""
    return write_archives(rows, arc_record(version, date), arc_begin(version, date), path, size)


def convert(spark: SparkSession, arc: str, warc: str, order: Callable[[Column], Column] = lambda c: c, least: int = 0, size: int = SIZE) -> str:
    """The ARC archives under ``arc`` as WARC archives under ``warc``.

    Of records with equal payloads of at least ``least`` bytes, all but the smallest by ``order`` of the id are revisits. A first
    reading gathers the digests alone; payloads are moved once, to meet what their digest was first seen in.
    """
    columns = ["id", "url", "date", "digest"]
    with temporary(spark):
        if least:
            seen = read_archives(spark, arc, parse_arc, ARC_DDL).filter(F.length("payload") >= least).select(*columns)
        else:
            seen = read_archives(spark, arc, parse_arc, ARC_DDL, columns)
        known = materialise(seen, "digests")
        first = F.min_by(F.struct("id", "url", "date"), F.struct(order(F.col("id")).alias("o"), F.col("id"), "url", "date"))
        shared = known.filter(F.col("id").isNotNull()).groupBy("digest").agg(first.alias("first"))
        often = known.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        roles = materialise(shared.join(often, "digest", "left_semi"), "responses")
        records = read_archives(spark, arc, parse_arc, ARC_DDL).join(roles, "digest", "left")
        return write_archives(records, warc_record, warc_begin, warc, size)


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    return read_archives(spark, path, parse_warc, WARC_DDL, columns)


def round_trip(rows: DataFrame, order: Callable[[Column], Column] = lambda c: c, columns: list[str] | None = None, version: int = 1) -> DataFrame:
    """``rows`` through ARC and WARC archives in the shared folder, as the records that are read back."""
    spark = rows.sparkSession
    arc = write_arc(rows, scratch(spark, "arc"), version)
    return read_warc(spark, convert(spark, arc, scratch(spark, "warc"), order), columns)
