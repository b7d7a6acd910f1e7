"""WARC archives of pages, written with an index and read back by byte ranges.

Every task writes one archive of gzip members, a record each, into a folder
that all executors share, and returns an index row per record: file, offset,
length, URL and digest. The index is a table; only files that it names count,
so an archive that a lost or repeated task left behind is never read. To read
records, the index is filtered, sorted by file and offset, and neighbouring byte
ranges are joined to few reads.

Of records with equal payloads the one with the largest page id is a response,
and the others are revisits that refer to it and hold no payload.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import saved, shared_folder

#: Payloads of fewer bytes are always responses.
LEAST = 0
DATE = "2025-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Ranges are joined over gaps of so many bytes, up to so many bytes in one read.
NEAR = 64 << 10
READ = 8 << 20
#: Index rows of one file are dealt to tasks in stretches of so many bytes.
STRETCH = 4 << 20
LEVEL = 5

INDEX = (
    "page_id long, path string, offset long, length long, url string, digest string, "
    "record_type string, refers_to long"
)
RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary, intact boolean"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(record_id: str) -> int | None:
    number = record_id.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def _uri(url: str | None, page_id: int | None) -> str:
    """A URL as one header line; characters that would break it are percent-encoded."""
    if not url:
        return _id(page_id).strip("<>")
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record(
    page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None
) -> tuple[bytes, str]:
    """One gzip member with a WARC record, and the payload's digest."""
    digest = base32_sha1(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_uri(url, page_id)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    else:
        block += payload
    lines.append(f"Content-Length: {len(block)}")
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    head = ("\r\n".join(lines) + "\r\n\r\n").encode()
    return squeeze.compress(head + block + b"\r\n\r\n") + squeeze.flush(), digest


def parse(member: bytes) -> dict:
    """The parts of one record; ``intact`` tells whether its lengths and digest hold."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    size = int(fields["Content-Length"])
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    stated = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    whole = kind == "revisit" or (len(payload) == stated and base32_sha1(payload) == digest)
    return {
        "page_id": _page(fields["WARC-Record-ID"]),
        "url": fields["WARC-Target-URI"],
        "record_type": kind,
        "refers_to": _page(fields["WARC-Refers-To"]) if kind == "revisit" else None,
        "payload_bytes": stated,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
        "intact": whole and rest[size:] == b"\r\n\r\n",
    }


def typed(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, url, html, record_type, refers_to); a null html is empty.

    Rows that share the largest id and the payload are all responses, as are
    payloads of null ids only.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("_sha", F.sha1("html"))
    newest = rows.groupBy(F.col("_sha").alias("_s")).agg(F.max("page_id").alias("_newest"))
    same = (
        (F.octet_length("html") < least)
        | F.col("_newest").isNull()
        | F.col("page_id").eqNullSafe(F.col("_newest"))
    )
    return rows.join(newest, F.col("_sha") == F.col("_s")).select(
        "page_id",
        "url",
        "html",
        F.when(same, "response").otherwise("revisit").alias("record_type"),
        F.when(~same, F.col("_newest")).alias("refers_to"),
    )


def _number(value) -> int | None:
    return None if value is None or value != value else int(value)


def write_archives(pages: DataFrame, folder: str | None = None, least: int = LEAST) -> DataFrame:
    """Write a record per page and return the index, itself written to the shared folder."""
    folder = folder or shared_folder(pages.sparkSession, "warc")

    def run(batches):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"
        out, at = None, 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, html, kind, refers in batch.itertuples(index=False):
                    page_id, refers = _number(page_id), _number(refers)
                    member, digest = record(page_id, url, html.encode(), kind, refers)
                    out = out or system.open_output_stream(f"{base}/{name}", compression=None)
                    out.write(member)
                    rows.append((page_id, f"{folder}/{name}", at, len(member), url, digest, kind, refers))
                    at += len(member)
                frame = pd.DataFrame(rows, columns=[c.split()[0] for c in INDEX.split(", ")])
                yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})
        finally:
            if out is not None:
                out.close()

    return saved(typed(pages, least).mapInPandas(run, INDEX), "warc-index")


def _ranges(rows: list) -> Iterator[tuple[int, int, list]]:
    """Neighbouring rows of one file, sorted by offset, as (from, to, rows)."""
    group: list = []
    low = high = 0
    for row in rows:
        if group and (row.offset - high > NEAR or row.offset + row.length - low > READ):
            yield low, high, group
            group = []
        if not group:
            low = row.offset
        high = row.offset + row.length
        group.append(row)
    if group:
        yield low, high, group


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that index rows name; without ``payloads`` these are checked and left out."""

    def run(batches):
        from pyarrow import fs

        for batch in batches:
            for path, part in batch.groupby("path", sort=False):
                system, name = fs.FileSystem.from_uri(path)
                rows = sorted(part.itertuples(index=False), key=lambda r: r.offset)
                with system.open_input_file(name) as file:
                    for low, high, group in _ranges(rows):
                        data = file.read_at(high - low, low)
                        found = [parse(data[r.offset - low : r.offset - low + r.length]) for r in group]
                        frame = pd.DataFrame(found)
                        if not payloads:
                            frame["payload"] = None
                        yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})

    stretch = F.floor(F.col("offset") / STRETCH)
    return (
        index.select("path", "offset", "length")
        .repartition("path", stretch)
        .sortWithinPartitions("path", "offset")
        .mapInPandas(run, RECORD)
    )


def archive_and_read(pages: DataFrame) -> DataFrame:
    """What the archives of ``pages`` hold, read back from them: a row per page, payloads checked."""
    return read_records(write_archives(pages), payloads=False).drop("payload")
