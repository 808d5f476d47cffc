"""Legacy archives (ARC, version 1 and 2) to WARC.

An ARC file opens with a version block that names its version and the fields of its header lines. Version 1 lines
have URL, address, date, type and length; version 2 adds result code, checksum, location, offset and file name before
the length. The reader takes the fields by the names the file itself declares and the content by the declared length.

Conversion runs in two passes, so that payloads are never shuffled: the first reads the archives and emits a narrow
row a record (place, payload digest, identifier); Spark finds for each digest the record that keeps the payload; the
second pass deals those decisions to the files and rewrites each file into a WARC file beside it. Identifiers are
derived from file name and offset, dates from the 14-digit date, types from the URL and the decisions, digests
from block and payload, so a task that runs again writes the same bytes. Files are read and written one record at a time.

Defined results: a null payload is empty; a null id never wins; of repeated rows one record is the response and the
others revisit it; a null URL becomes ``unknown:``; an empty table gives no archives and no rows. Columns other
than id, URL and payload are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadweave.llm.common import fetch, kept_at, publish, whole

#: Field names of the two versions, and the profile of a revisit.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEVEL = 1
PAGE_HEADER = b"X-Page-Id"
SEEN = (
    "file string, at long, page_id long, url string, date string, record_id string, payload_digest string,"
    " payload_bytes long"
)
READ = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, record_id string,"
    " refers_to_record string, url string, date string, content_digest_ok boolean"
)


# --- ARC ---


def arc_head(name: str, version: int, date: str) -> bytes:
    """The version block that opens an archive."""
    body = f"{version} 0 loadweave\n{FIELDS[version]}\n".encode()
    return _arc_line(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", name, len(body)) + body + b"\n"


def _arc_line(version: int, url: str, address: str, date: str, kind: str, name: str, length: int) -> bytes:
    more = f"200 - - 0 {name} " if version == 2 else ""
    return f"{url} {address} {date} {kind} {more}{length}\n".encode()


def arc_record(version: int, name: str, url: str | None, date: str, page_id: int | None, payload: bytes) -> bytes:
    """A header line and an HTTP response with the payload."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n" % len(payload)
    if page_id is not None:
        head += PAGE_HEADER + b": %d\r\n" % page_id
    content = head + b"\r\n" + payload
    safe = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else "unknown:"
    return _arc_line(version, safe, "0.0.0.0", date, "text/html", name, len(content)) + content + b"\n"


def arc_records(stream) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, header fields and content of every record, the version block included."""
    at, names = 0, None
    while line := stream.readline():
        begin, at = at, at + len(line)
        if not line.strip():
            continue
        values = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        content = stream.read(int(values[-1]))
        at += len(content)
        if len(content) != int(values[-1]):
            raise ValueError(f"the record at {begin} is shorter than its declared length")
        if names is None:
            if not values[0].startswith("filedesc:"):
                raise ValueError("an ARC file opens with a filedesc record")
            version, declared = content.decode("utf-8", "replace").split("\n")[:2]
            names = declared.split()
            if int(version.split()[0]) not in FIELDS or names[-1] != "Archive-length":
                raise ValueError(f"unknown ARC version block: {content[:80]!r}")
        if len(values) != len(names):
            # A URL with bare spaces: everything before the last fields belongs to it.
            extra = len(values) - len(names)
            if extra < 0:
                raise ValueError(f"the header line at {begin} has too few fields")
            values = [" ".join(values[: extra + 1]), *values[extra + 1:]]
        yield begin, dict(zip(names, values)), content


# --- the parts of a record ---


def http_parts(content: bytes) -> tuple[bytes, bytes]:
    """Header block (blank line included) and payload; without an HTTP status line all is payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    end = re.search(rb"\r?\n\r?\n", content)
    return (content[: end.end()], content[end.end():]) if end else (content, b"")


def http_field(head: bytes, name: bytes) -> int | None:
    found = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*(-?\d+)[ \t]*\r?$", head)
    return int(found[1]) if found else None


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(name: str, at: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{at}')}>"


def warc_date(date: str) -> str:
    """ISO form of a 14-digit date; missing parts of a shorter one are their first values."""
    full = (re.sub(r"\D", "", date) + "00000101000000"[len(re.sub(r"\D", "", date)):])[:14]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def _archive_names(name: str) -> str:
    return re.sub(r"\.arc(\.gz)?$", "", name) + ".warc.gz"


# --- WARC ---


def warc_record(fields: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return b"WARC/1.1\r\n" + head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def warc_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record here: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode("utf-8", "replace").partition(":")
            fields[key.strip().lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]):
            raise ValueError("a WARC record is shorter than its declared length")
        yield fields, block


def convert_record(name: str, at: int, arc: dict[str, str], content: bytes, original: dict | None) -> bytes:
    """The WARC record of one ARC record; ``original`` names the response that a revisit repeats."""
    if arc["URL"].startswith("filedesc:"):
        fields = {"WARC-Type": "warcinfo", "Content-Type": "application/warc-fields", "WARC-Filename": _archive_names(name)}
        content = f"software: loadweave\r\nconverted-from: {name}\r\n".encode()
    else:
        head, payload = http_parts(content)
        kind = "response" if head or arc["URL"].startswith("dns:") else "resource"
        fields = {
            "WARC-Type": "revisit" if original else kind,
            "WARC-Target-URI": arc["URL"],
            "WARC-IP-Address": arc["IP-address"],
            "Content-Type": "application/http;msgtype=response" if head else arc["Content-type"],
            "WARC-Payload-Digest": f"sha1:{sha1(payload)}",
        }
        if original:
            fields |= {
                "WARC-Profile": REVISIT, "WARC-Refers-To": original["record_id"],
                "WARC-Refers-To-Target-URI": original["url"], "WARC-Refers-To-Date": warc_date(original["date"]),
            }
            content = head
    fields |= {
        "WARC-Record-ID": record_id(name, at), "WARC-Date": warc_date(arc["Archive-date"]),
        "WARC-Block-Digest": f"sha1:{sha1(content)}",
    }
    return warc_record(fields, content)


# --- jobs ---


def write_arcs(
    pages: DataFrame, folder: str, date: str = "20000101000000", id_col: str = "page_id", url_col: str = "url",
    payload_col: str = "html",
) -> DataFrame:
    """Write pages as legacy archives, a version 1 file (even ids) and a version 2 file (odd ids) a task.

    Returns the files: name, records.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        part = TaskContext.get().partitionId()
        names = {v: f"pages-{part:06d}-v{v}.arc.gz" for v in FIELDS}
        counts = dict.fromkeys(FIELDS, 0)
        with publish(folder, names[1]) as one, publish(folder, names[2]) as two:
            out = {1: one, 2: two}
            for v, stream in out.items():
                stream.write(gzip.compress(arc_head(names[v], v, date), LEVEL))
            for batch in (b for group in ((first,), batches) for b in group):
                for page_id, url, payload in zip(*(batch.column(i) for i in range(3))):
                    page_id = page_id.as_py()
                    v = 1 + (page_id or 0) % 2
                    record = arc_record(v, names[v], url.as_py(), date, page_id, payload.as_buffer().to_pybytes())
                    out[v].write(gzip.compress(record, LEVEL))
                    counts[v] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(names.values())), pa.array(list(counts.values()), pa.int64())], names=["name", "records"]
        )

    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        whole(payload_col).alias("payload"),
    )
    return kept_at(rows.mapInArrow(write, "name string, records long"), f"{folder}/files")


def _each_file(files: DataFrame) -> DataFrame:
    """The file names, one a task."""
    return files.select("name").repartition(max(1, files.count()))


def survey(files: DataFrame, folder: str) -> DataFrame:
    """A narrow row for each record of the archives, without its payload."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with fetch(folder, name) as file:
                    for at, fields, content in arc_records(gzip.GzipFile(fileobj=file)):
                        if fields["URL"].startswith("filedesc:"):
                            continue
                        head, payload = http_parts(content)
                        rows.append({
                            "file": name, "at": at, "page_id": http_field(head, PAGE_HEADER), "url": fields["URL"],
                            "date": fields["Archive-date"], "record_id": record_id(name, at),
                            "payload_digest": sha1(payload), "payload_bytes": len(payload),
                        })
                        if len(rows) >= 5_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    text, number = pa.string(), pa.int64()
    kinds = pa.schema([
        ("file", text), ("at", number), ("page_id", number), ("url", text), ("date", text), ("record_id", text),
        ("payload_digest", text), ("payload_bytes", number),
    ])
    return _each_file(files).mapInArrow(look, SEEN)


def decide(seen: DataFrame, min_bytes: int = 0) -> DataFrame:
    """For each record the response it repeats (null for responses): file, at, original.

    Of equal payloads of at least ``min_bytes`` bytes the record with the largest id is the response. The largest is
    combined before the shuffle, and the join carries narrow rows only, whose hot digests the planner splits.
    """
    large = seen.where(F.col("payload_bytes") >= min_bytes)
    best = large.groupBy("payload_digest").agg(F.max(F.struct("page_id", "record_id", "url", "date")).alias("original"))
    joined = seen.join(best, "payload_digest", "left")
    repeats = (F.col("payload_bytes") >= min_bytes) & (F.col("original.record_id") != F.col("record_id"))
    return joined.select("file", "at", F.when(repeats, F.col("original")).alias("original"))


def convert(decisions: DataFrame, files: int, folder: str) -> DataFrame:
    """Rewrite each archive as a WARC file; returns the files: name, records.

    The rows of decisions are narrow and say nothing about the work of a file, so they are dealt to as many tasks as there
    are files; adaptive execution would merge them into one by their size.
    """

    def rewrite(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        (name,) = key
        originals = dict(zip(rows["at"], rows["original"]))
        out_name, n = _archive_names(name), 0
        with fetch(folder, name) as file, publish(folder, out_name) as out:
            for at, fields, content in arc_records(gzip.GzipFile(fileobj=file)):
                original = originals.get(at)
                original = original.asDict() if hasattr(original, "asDict") else original
                out.write(gzip.compress(convert_record(name, at, fields, content, original or None), LEVEL))
                n += 1
        return pd.DataFrame({"name": [out_name], "records": [n]})

    dealt = decisions.repartition(max(1, files), "file")
    return dealt.groupBy("file").applyInPandas(rewrite, "name string, records long")


def read_warcs(files: DataFrame, folder: str) -> DataFrame:
    """A row per page record of the WARC files, from their headers and blocks alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with fetch(folder, name) as file:
                    for fields, block in warc_records(gzip.GzipFile(fileobj=file)):
                        if fields["warc-type"] == "warcinfo":
                            continue
                        head, payload = http_parts(block)
                        revisit = fields["warc-type"] == "revisit"
                        rows.append({
                            "page_id": http_field(head, PAGE_HEADER),
                            "payload_bytes": http_field(head, b"Content-Length") if revisit else len(payload),
                            "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
                            "record_type": fields["warc-type"], "record_id": fields["warc-record-id"],
                            "refers_to_record": fields.get("warc-refers-to"), "url": fields["warc-target-uri"],
                            "date": fields["warc-date"],
                            "content_digest_ok": fields["warc-block-digest"] == f"sha1:{sha1(block)}" and (
                                revisit or fields["warc-payload-digest"] == f"sha1:{sha1(payload)}"
                            ),
                        })
                        if len(rows) >= 5_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    text, number = pa.string(), pa.int64()
    kinds = pa.schema([
        ("page_id", number), ("payload_bytes", number), ("payload_digest", text), ("record_type", text),
        ("record_id", text), ("refers_to_record", text), ("url", text), ("date", text), ("content_digest_ok", pa.bool_()),
    ])
    return _each_file(files).mapInArrow(read, READ)


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write pages as ARC, convert them to WARC, read those back.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to (the response's page id).
    """
    arcs = write_arcs(pages, folder)
    seen = kept_at(survey(arcs, folder), f"{folder}/seen")
    warcs = kept_at(convert(decide(seen, min_bytes), arcs.count(), folder), f"{folder}/converted")
    records = kept_at(read_warcs(warcs, folder), f"{folder}/records")
    bad = records.where(~F.col("content_digest_ok")).count()
    if bad:
        raise ValueError(f"{bad} WARC records do not match their digests")
    named = records.where(F.col("record_type") == "response").select(
        F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"),
    )
    return records.join(named, "refers_to_record", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
    )
