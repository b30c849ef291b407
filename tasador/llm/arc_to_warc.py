"""Legacy archive converter: ARC (versions 1 and 2) to WARC.

An ARC archive is a version block followed by URL records: a header line whose
fields depend on the version that the block names, then as many bytes as the line
declares. ``parse_arc`` reads one by those lengths. The WARC counterparts of what
ARC lacks are synthesised: record ids (name-based UUIDs), ISO timestamps, record types,
block and payload digests. Records with equal payloads become one response and
revisits of it.

Archives are written as gzip files by Spark's text writer, whose line separator
is the blank line that ends a WARC record, and read back by the reader with the same
separator. Its pieces are put together again by the lengths that the records
declare, so a payload may itself hold such separators, and no file is ever held
whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_path, utf8, written

END = "\r\n\r\n"
#: The fields of a URL record's header line, by the version of its archive.
ARC_FIELDS = {
    1: ("url", "ip", "date", "mime", "length"),
    2: ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"),
}
ARC_TITLES = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:tasador:arc-to-warc")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc_header(version: int, url: str, date: str, mime: str, length: int, filename: str, offset: int) -> bytes:
    line = f"{url} 0.0.0.0 {date} {mime} {length}" if version == 1 else f"{url} 0.0.0.0 {date} {mime} 200 - - {offset} {filename} {length}"
    return line.encode() + b"\n"


def write_arc(name: str, version: int, date: str, pages: list[tuple[int | None, str | None, bytes]]) -> bytes:
    """An archive of (page id, url, payload): HTTP responses that carry the id
    in a header of their own. A url's blanks are percent-encoded, since they part
    the fields; a missing one is ``-``."""
    block = f"{version} 0 tasador\n{ARC_TITLES[version]}\n\n".encode()
    out = [arc_header(version, f"filedesc://{name}", date, "text/plain", len(block), name, 0), block]
    at = sum(map(len, out))
    for page, url, payload in pages:
        url = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "") or "-"
        head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"] + ([] if page is None else [f"X-Page-Id: {page}"])
        doc = "\r\n".join(head).encode() + b"\r\n\r\n" + payload
        record = b"\n" + arc_header(version, url, date, "text/html", len(doc), name, at) + doc
        out.append(record)
        at += len(record)
    return b"".join(out)


def parse_arc(data: bytes) -> Iterator[tuple[dict, int, bytes]]:
    """(header fields, offset, block) of every record of an archive, the version
    block first. A line feed parts records; lengths are taken from the header lines."""
    version, at = None, 0
    while at < len(data):
        if data[at : at + 1] == b"\n":
            at += 1
            continue
        end = data.index(b"\n", at)
        fields = data[at:end].decode("utf-8").split(" ")
        if version is None:
            if not fields[0].startswith("filedesc://"):
                raise ValueError("no version block at the head of the archive")
            version = int(data[end + 1 : data.index(b" ", end + 1)])
        names = ARC_FIELDS[version]
        if len(fields) != len(names):
            raise ValueError(f"{len(fields)} header fields at byte {at}; version {version} has {len(names)}")
        header, length = dict(zip(names, fields, strict=True)), int(fields[-1])
        block = data[end + 1 : end + 1 + length]
        if len(block) != length:
            raise ValueError(f"the archive ends within the record at byte {at}")
        yield header, at, block
        at = end + 1 + length


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head with its blank line, and body."""
    at = block.find(b"\r\n\r\n")
    return (b"", block) if at < 0 else (block[: at + 4], block[at + 4 :])


def http_field(head: bytes, name: str) -> int | None:
    m = re.search(rb"(?mi)^" + name.encode() + rb": *(-?\d+)\r?$", head)
    return int(m[1]) if m else None


def warc_date(date: str) -> str:
    """The ISO form of an ARC date of up to 14 digits."""
    d = (date + "00000101000000"[len(date) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


def arcs_of(pages: DataFrame, key: str, url: str, html: str, date: str, per_archive: int) -> DataFrame:
    """(archive, content): the pages in ARC archives, versions 1 and 2 in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, per_archive):
                rows = batch.slice(at, per_archive)
                name = f"pages-{part:06d}-{n:06d}.arc"
                content = write_arc(name, 1 + n % 2, date, list(zip(*(rows.column(k).to_pylist() for k in range(3)), strict=True)))
                n += 1
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary())], names=["archive", "content"])

    return pages.select(F.col(key).cast("long"), F.col(url).cast("string"), utf8(html)).mapInArrow(run, "archive string, content binary")


def records_of(arcs: DataFrame, payloads: bool = True) -> DataFrame:
    """The converted records of ARC archives (archive, content): page_id, id, url,
    date, head, payload (null if ``payloads`` is false), length, digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for header, at, block in parse_arc(content.as_py()):
                    if header["url"].startswith("filedesc://"):
                        continue
                    head, body = split_http(block)
                    rid = f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{name} {at} {header['url']}')}>"
                    rows.append((http_field(head, "X-Page-Id"), rid, header["url"], warc_date(header["date"]), head, body if payloads else None, len(body), sha1_base32(body)))
                if rows:
                    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["page_id", "id", "url", "date", "head", "payload", "length", "digest"])

    return arcs.select("archive", "content").mapInArrow(run, "page_id long, id string, url string, date string, head binary, payload binary, length long, digest string")


def warc_record(r: dict) -> bytes:
    """A record without the blank line that ends it. A revisit keeps the HTTP head alone."""
    revisit = r["refers_to"] is not None
    block = r["head"] if revisit else r["head"] + r["payload"]
    lines = [
        "WARC/1.0",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {r['id']}",
        f"WARC-Date: {r['date']}",
        f"WARC-Target-URI: {r['url']}",
        f"WARC-Payload-Digest: sha1:{r['digest']}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest", f"WARC-Refers-To: {r['refers_to']}", f"X-Refers-To-Page-Id: {r['refers_to_page']}", f"X-Payload-Length: {r['length']}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def convert(arcs: DataFrame, path: str, min_payload: int = 0, records_per_file: int = 4096) -> None:
    """Write the WARC counterparts of ARC archives (archive, content) to ``path``.
    Of records with equal payloads of at least ``min_payload`` bytes, those with the
    largest page id are responses, the others revisit the first of them."""
    facts = records_of(arcs, payloads=False).filter(F.col("length") >= min_payload)
    newest = facts.groupBy("digest", "length").agg(F.max(F.struct("page_id", "id")).alias("kept"), F.count("*").alias("n"))
    newest = written(newest.filter("n > 1").select(F.col("digest").alias("d"), F.col("length").alias("l"), F.col("kept.page_id").alias("kept_page"), F.col("kept.id").alias("kept_id")), "newest")
    records = records_of(arcs)
    other = ~F.col("page_id").eqNullSafe(F.col("kept_page")) & F.col("kept_id").isNotNull()
    records = records.join(newest, (F.col("digest") == F.col("d")) & (F.col("length") == F.col("l")), "left").select(
        "id", "url", "date", "head", F.when(~other, F.col("payload")).alias("payload"), "digest", "length", F.when(other, F.col("kept_id")).alias("refers_to"), F.when(other, F.col("kept_page")).alias("refers_to_page")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([warc_record(r) for r in rows], pa.binary())], names=["record"])

    text = records.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    text.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives at ``path``: page_id, record_type,
    payload_bytes, payload_digest (without its scheme), refers_to (a page id),
    payload (null for revisits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sep, file, rows = END.encode(), None, []
        head: bytes | None = None
        rest = b""  # of the record's end, when the block's last bytes were taken for its beginning
        body, need = [], 0

        def out() -> pa.RecordBatch:
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
            cols = zip(*rows, strict=True) if rows else [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"])

        for batch in batches:
            for name, piece in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                piece = piece.as_py()
                if name != file:
                    if head is not None:
                        raise ValueError(f"{file} ends within a record")
                    file, rest = name, b""
                if head is None:
                    if rest and not piece.startswith(rest):
                        raise ValueError(f"a record of {name} is longer than it declares")
                    piece, rest = piece[len(rest) :], b""
                    if not piece:
                        continue  # the end of the file
                    if not piece.startswith(b"WARC/1.0\r\n"):
                        raise ValueError(f"no record begins where one should in {name}")
                    head, body, need = piece, [], http_field(piece, "Content-Length")
                    continue
                body.append(piece)
                need -= len(piece)
                if need > 0:  # the separator is part of the block, or its head is
                    body.append(sep[:need])
                    need -= len(sep)
                    if need >= 0:
                        continue
                    rest = sep[-need:]
                elif need < 0:
                    raise ValueError(f"a record of {name} is longer than it declares")
                kind = re.search(rb"(?m)^WARC-Type: (\w+)", head)[1].decode()
                http, payload = split_http(b"".join(body))
                rows.append((
                    http_field(http, "X-Page-Id"),
                    kind,
                    http_field(head, "X-Payload-Length") if kind == "revisit" else len(payload),
                    re.search(rb"(?m)^WARC-Payload-Digest: sha1:(\w+)", head)[1].decode(),
                    http_field(head, "X-Refers-To-Page-Id"),
                    payload if kind == "response" else None,
                ))
                head = None
                if len(rows) == 256:
                    yield out()
                    rows.clear()
        if head is not None:
            raise ValueError(f"{file} ends within a record")
        yield out()

    raw = spark.read.option("lineSep", END).text(path)
    return raw.select(F.input_file_name(), F.col("value").cast("binary")).mapInArrow(run, "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def pages_to_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", date: str = "20240101000000", per_archive: int = 64, min_payload: int = 0) -> DataFrame:
    """Pack pages into ARC archives, convert those to WARC files at ``path`` and
    return the records read back.

    A null html is an empty payload; a null url is written ``-``. A null page id
    sorts below any other and comes back as null. Rows with the largest id of their
    payload are all responses if that id is repeated. Other columns are left out."""
    convert(arcs_of(pages, key, url, html, date, per_archive), path, min_payload)
    return read_warc(pages.sparkSession, path)
