"""WARC archives: write, index, and read selected records by byte range.

*Write.*  Each page is one WARC/1.1 record in a gzip member of its own.  Of
records with equal payloads (SHA-1) of at least ``min_bytes`` bytes, that with
the smallest page_id is a response, the others are revisits without payload
that refer to it; smaller ones are all responses.  Spark's text writer puts the
members into the archive files: every record is followed by an empty gzip
member, whose last byte is always zero, and that byte is the line separator.
So any store that Spark writes to will do, and the files are valid ``.warc.gz``.

*Index first.*  The archives are streamed once, file by file, to a table of
file, offset, length, URL, payload digest, page_id and kind per record.

*Read.*  Index rows are brought together by file and slice of offsets, sorted,
and neighbouring ranges are coalesced (gaps up to ``max_gap``, reads up to
``max_read`` bytes); one read serves all records in it.

Null html is an empty payload.  Null page_ids come last where the smallest is
sought, and two rows with one page_id and payload share their verdict.  A null
URL leaves the header out.  Line breaks in URLs are percent-encoded.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from dataclasses import dataclass

import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin, scratch_path
from .common import NO_ID


@dataclass(frozen=True)
class WarcParams:
    min_bytes: int = 0           # smaller payloads are never revisits
    level: int = 6               # of gzip
    date: str = "2000-01-01T00:00:00Z"   # of every record: the tables have none
    max_gap: int = 64 << 10
    max_read: int = 8 << 20
    slice_bytes: int = 4 << 20   # records of one file and slice are read by one task
    task_bytes: int = 128 << 20  # that a task reads on average, at most


_EMPTY = bytes.fromhex("1f8b08000000000000ff03000000000000000000")   # an empty gzip member
_INDEX = "file string, offset long, length long, page_id long, url string, payload_digest string, record_type string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else int(page_id)}>"


def _id(name: str) -> int | None:
    found = re.search(r"urn:page:(-?\d+)", name or "")
    return int(found[1]) if found else None


def build_record(page_id, url, payload: bytes, sha1: str, refers_to, revisit: bool, p: WarcParams) -> bytes:
    """One uncompressed record.  A revisit keeps the HTTP header, whose
    Content-Length is that of the full payload, and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {p.date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{sha1}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_name(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of one uncompressed record; ``payload`` is None for a revisit."""
    head, body = data.split(b"\r\n\r\n", 1)
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:])
    http, payload = body[:int(fields["Content-Length"])].split(b"\r\n\r\n", 1)
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    revisit = fields["WARC-Type"] == "revisit"
    return {"page_id": _id(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": size,
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "record_type": fields["WARC-Type"],
            "refers_to": _id(fields.get("WARC-Refers-To")), "payload": None if revisit else payload}


def write_archive(pages: DataFrame, params: WarcParams = WarcParams(), path: str | None = None) -> str:
    """Write ``pages(page_id, url, html)``; returns the archive's folder."""
    p, spark = params, pages.sparkSession

    @F.pandas_udf("string")
    def sha1(html: pd.Series) -> pd.Series:
        return pd.Series([digest((x or "").encode("utf-8", "replace")) for x in html], dtype=object)

    @F.pandas_udf("binary")
    def member(page: pd.Series, url: pd.Series, html: pd.Series, sha: pd.Series, first: pd.Series) -> pd.Series:
        out = []
        for i, u, h, s, f in zip(page, url, html, sha, first, strict=True):
            i = None if int(i) == NO_ID else int(i)
            revisit = i is not None and i != f or i is None and f != NO_ID
            rec = build_record(i, u, (h or "").encode("utf-8", "replace"), s, int(f), revisit, p)
            out.append(gzip.compress(rec, p.level, mtime=0) + _EMPTY[:-1])
        return pd.Series(out, dtype=object)

    size = F.octet_length(F.coalesce("html", F.lit("")))
    rows = pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(NO_ID)).alias("id"), "url", "html", sha1("html").alias("sha"))
    # The digests are taken twice rather than the pages written once more; copies meet as ids and digests only.
    first = (rows.filter(size >= p.min_bytes).groupBy("sha").agg(F.min("id").alias("first"), F.count("*").alias("n"))
             .filter("n > 1").drop("n"))
    records = rows.join(first, "sha", "left").withColumn("first", F.when(size >= p.min_bytes, F.coalesce("first", "id")).otherwise(F.col("id")))
    path = path or scratch_path(spark, "warc")
    (records.select(member("id", "url", "html", "sha", "first").cast("string").alias("value"))
     .write.option("lineSep", "\x00").text(path))
    return path


def _open(path: str):
    """A random-access file of any store that Arrow reads (file, hdfs, s3, gs)."""
    fs, at = pyarrow.fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
    return fs.open_input_file(at)


def _scan_members(f):
    """(offset, length, uncompressed) of each non-empty gzip member of a stream."""
    at, start, buf, out, tool = 0, 0, b"", [], None
    while True:
        if not buf:
            buf = f.read(1 << 20)
            if not buf:
                break
        if tool is None:
            tool, start, out = zlib.decompressobj(31), at, []
        out.append(tool.decompress(buf))
        at += len(buf) - len(tool.unused_data)
        buf = tool.unused_data
        if tool.eof:
            tool = None
            data = b"".join(out)
            if data:
                yield start, at - start, data


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Index of an archive folder, sorted by place: a scratch table, which
    :func:`read_records` may read any number of times.  A user who keeps the
    archive writes it beside the files."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
             .filter("length > 0").select("path"))   # Spark packs the files into tasks by size

    def index(batches):
        for pdf in batches:
            for name in pdf.path:
                rows = []
                with _open(name) as f:
                    for offset, length, data in _scan_members(f):
                        r = parse_record(data)
                        rows.append((name, offset, length, r["page_id"], r["url"], r["payload_digest"], r["record_type"]))
                        if len(rows) == 5000:
                            yield _index_rows(rows)
                            rows = []
                yield _index_rows(rows)

    return pin(files.mapInPandas(index, _INDEX), "warc-index")


def _index_rows(rows) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in _INDEX.split(", ")])
    return out.astype({"offset": "int64", "length": "int64", "page_id": "Int64"})


def coalesced(ranges: list[tuple[int, int]], max_gap: int, max_read: int) -> list[tuple[int, int, list[int]]]:
    """Reads (begin, end, numbers of the ranges inside) for sorted (offset, length)."""
    out: list[list] = []
    for k, (at, n) in enumerate(ranges):
        if out and at - out[-1][1] <= max_gap and at + n - out[-1][0] <= max_read:
            out[-1][1] = max(out[-1][1], at + n)
            out[-1][2].append(k)
        else:
            out.append([at, at + n, [k]])
    return [(a, b, ks) for a, b, ks in out]


def read_records(spark: SparkSession, path: str, selected: DataFrame, params: WarcParams = WarcParams(), with_payload: bool = False) -> DataFrame:
    """Records of the ``selected`` index rows: page_id, url, payload_bytes,
    payload_digest, record_type, refers_to and, if asked for, payload (null for
    revisits).  A payload that doesn't match its digest or size is an error."""
    p = params
    kinds = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    names = [c.split()[0] for c in kinds.split(", ")]

    def fetch(batches):
        for pdf in batches:
            pdf = pdf.sort_values(["file", "offset"], kind="stable")
            for name, part in pdf.groupby("file", sort=False):
                places = list(zip(part["offset"].tolist(), part["length"].tolist(), strict=True))
                with _open(name) as f:
                    for begin, end, ks in coalesced(places, p.max_gap, p.max_read):
                        f.seek(begin)
                        data, rows = f.read(end - begin), []
                        for k in ks:
                            at = places[k][0] - begin
                            r = parse_record(gzip.decompress(data[at:at + places[k][1]]))
                            if r["payload"] is not None and (digest(r["payload"]), len(r["payload"])) != (r["payload_digest"], r["payload_bytes"]):
                                raise ValueError(f"damaged record at {places[k]} of {name}")
                            rows.append(r)
                        out = pd.DataFrame(rows, columns=[*names, "payload"]).astype({"page_id": "Int64", "refers_to": "Int64"})
                        yield out if with_payload else out[names]

    # Slices are dealt by what they hold, not by the size of their index rows.
    size = selected.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first().n
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // p.task_bytes))
    dealt = (selected.select("file", "offset", "length").repartition(tasks, "file", F.floor(F.col("offset") / p.slice_bytes))
             .sortWithinPartitions("file", "offset"))
    return dealt.mapInPandas(fetch, kinds + (", payload binary" if with_payload else ""))
