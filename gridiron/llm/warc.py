"""WARC archives with a two-level capture index.

Records are gzip members of archive files.  The index lists captures by reversed-host
URL key in blocks, each a gzip member of an index file; a file's directory holds the
first key and the place of each block.  Looking up a URL is a binary search over the
index files, one over a directory, and range reads of a block and of the record.

Files are written and read by the tasks through Arrow's file systems, so the folder may
be any that Arrow and all executors reach.  A task names its files uniquely and only a
finished stage's files are listed, so a repeated or failed task does no harm.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import uuid
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridiron.llm.common import new_path, written

CAPTURE = "key string, page_id long, record_type string, refers_to long, payload_digest string, file string, offset long, length long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def url_key(url: str | None) -> str:
    """`com,example,www)/path?query`; control characters and blanks are percent-encoded, null is empty."""
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    try:
        parts = urlsplit(url)
        host, port = parts.hostname, parts.port
    except ValueError:
        return url
    if not host:
        return url
    port = f":{port}" if port and port != {"http": 80, "https": 443}.get(parts.scheme) else ""
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(host.split("."))) + f"{port}){parts.path or '/'}{query}"


def record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    block = HTTP if revisit else HTTP + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 4, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, block = gzip.decompress(member).partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def page_of(urn: str | None) -> int | None:
    found = urn and urn.removeprefix("<urn:x-page:").removesuffix(">")
    return int(found) if found else None


@dataclass(frozen=True)
class Archive:
    """A folder with archive files, index files and their directories."""

    folder: str
    #: first and last key and path of each index file, in order: as many as the index had partitions
    routes: list[tuple[str, str, str]]


def with_originals(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, url, payload, digest, original: the smallest page_id of the same payload, if it is long enough and repeated."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    originals = (
        rows.where(F.octet_length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("original"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    originals = written(originals, "originals")  # a table, so that the join's hot digests can be split
    return rows.join(originals, "digest", "left").select("page_id", "url", "payload", "digest", "original")


def write_archive(
    pages: DataFrame,
    folder: str,
    least_bytes: int = 100,
    block_lines: int = 256,
    file_bytes: int = 1 << 30,
    date: str = "1970-01-01T00:00:00Z",
) -> Archive:
    """Writes a record per row of pages (page_id, url, html) and the index over them.

    Of rows with equal payloads of at least `least_bytes` bytes, those with the smallest
    page_id are responses and the others revisit records that refer to it.  A null html
    is an empty payload; rows without page_id or url, and repeated rows, get records
    like others (a null page_id never is the one referred to unless all are null).
    """

    def write(batches):
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        out, path, offset = None, "", 0
        for batch in batches:
            rows = {c: [] for c in ("key", "page_id", "record_type", "refers_to", "payload_digest", "file", "offset", "length")}
            for r in (r for at in range(0, batch.num_rows, 64) for r in batch.slice(at, 64).to_pylist()):  # few payloads at a time
                if out is None or offset >= file_bytes:
                    if out:
                        out.close()
                    path, offset = f"{root}/records-{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(path, compression=None)
                revisit = r["original"] is not None and r["original"] != r["page_id"]
                refers = r["original"] if revisit else None
                data = record(r["page_id"], r["url"], r["payload"], r["digest"], refers, revisit, date)
                out.write(data)
                values = (url_key(r["url"]), r["page_id"], "revisit" if revisit else "response", refers, r["digest"], path, offset, len(data))
                for column, value in zip(rows.values(), values):
                    column.append(value)
                offset += len(data)
            strings = {"key", "record_type", "payload_digest", "file"}
            arrays = [pa.array(v, pa.string() if k in strings else pa.int64()) for k, v in rows.items()]
            yield pa.RecordBatch.from_arrays(arrays, list(rows))
        if out:
            out.close()

    captures = written(with_originals(pages, least_bytes).mapInArrow(write, CAPTURE), "captures")
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.repartitionByRange(parts, "key", "page_id", "offset").sortWithinPartitions("key", "page_id", "file", "offset")

    def index(batches):
        system, root = fs.FileSystem.from_uri(folder)
        path, offset, directory, held = f"{root}/index-{uuid.uuid4().hex}", 0, [], []
        first = last = None
        with system.open_output_stream(path + ".cdx.gz", compression=None) as out:

            def block():
                nonlocal offset
                data = gzip.compress("\n".join(json.dumps(list(x.values())) for x in held).encode(), 6, mtime=0)
                out.write(data)
                directory.append((held[0]["key"], held[-1]["key"], offset, len(data)))
                offset += len(data)
                held.clear()

            for batch in batches:
                for r in batch.to_pylist():
                    first, last = (r["key"] if first is None else first), r["key"]
                    held.append(r)
                    if len(held) == block_lines:
                        block()
            if held:
                block()
        if directory:
            with system.open_output_stream(path + ".dir.gz", compression=None) as out:
                out.write(gzip.compress(json.dumps(directory).encode(), 6, mtime=0))
            yield pa.RecordBatch.from_pydict({"first": [first], "last": [last], "path": [path]})

    made = written(ordered.mapInArrow(index, "first string, last string, path string"), "index-files").collect()
    return Archive(folder, sorted((r.first, r.last, r.path) for r in made))


class _Index:
    """Finds the blocks that may hold a key; keeps the directory it read last."""

    def __init__(self, archive: Archive):
        self.system, _ = fs.FileSystem.from_uri(archive.folder)
        self.routes = archive.routes
        self.firsts, self.lasts = [r[0] for r in self.routes], [r[1] for r in self.routes]
        self.path = None

    def blocks(self, key: str):
        for _, _, path in self.routes[bisect_left(self.lasts, key) : bisect_right(self.firsts, key)]:
            if path != self.path:
                with self.system.open_input_stream(path + ".dir.gz", compression=None) as data:
                    self.directory = json.loads(gzip.decompress(data.read()))
                self.path, self.ends = path, [d[1] for d in self.directory]
            at = bisect_left(self.ends, key)
            while at < len(self.directory) and self.directory[at][0] <= key:
                yield key, path + ".cdx.gz", self.directory[at][2], self.directory[at][3]
                at += 1


def look_up(archive: Archive, urls: DataFrame) -> DataFrame:
    """The captures of each distinct URL of the first column; a null URL finds the captures without one.

    The blocks of a key are found by two binary searches and then dealt out by place, so
    that a key of very many captures is read by many tasks.
    """

    def keys(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"key": [url_key(u) for u in batch.column(0).to_pylist()]})

    def search(batches):
        index = _Index(archive)
        for batch in batches:
            found = [b for key in batch.column(0).to_pylist() for b in index.blocks(key)]
            if found:
                yield pa.RecordBatch.from_pydict(dict(zip(("key", "block", "at", "size"), zip(*found))))

    def read(batches):
        system, _ = fs.FileSystem.from_uri(archive.folder)
        place, lines = None, []
        names = [x.split()[0] for x in CAPTURE.split(", ")]
        kinds = [pa.string() if x.endswith("string") else pa.int64() for x in CAPTURE.split(", ")]
        for batch in batches:
            for want in batch.to_pylist():
                if place != (want["block"], want["at"]):
                    place = want["block"], want["at"]
                    with system.open_input_file(want["block"]) as data:
                        text = gzip.decompress(data.read_at(want["size"], want["at"])).decode()
                    lines = [json.loads(x) for x in text.split("\n")]
                    starts = [x[0] for x in lines]
                found = lines[bisect_left(starts, want["key"]) : bisect_right(starts, want["key"])]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

    wanted = urls.select(urls.columns[0]).mapInArrow(keys, "key string").distinct()
    parts = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_keys = wanted.repartitionByRange(parts, "key").sortWithinPartitions("key")
    blocks = sorted_keys.mapInArrow(search, "key string, block string, at long, size long")
    dealt = blocks.repartitionByRange(parts, "block", "at").sortWithinPartitions("block", "at", "key")
    return dealt.mapInArrow(read, CAPTURE)


def read_records(archive: Archive, captures: DataFrame, together: int = 4 << 20) -> DataFrame:
    """Reads captures' records: page_id, record_type, refers_to, payload_digest, payload (null for revisits).

    Neighbouring records of a file are read in one range.  A response's digest is that of
    the payload read, and one that differs from the header is an error.
    """

    def read(batches):
        system, _ = fs.FileSystem.from_uri(archive.folder)
        for batch in batches:
            places = batch.to_pylist()
            at = 0
            while at < len(places):
                start, past = places[at], at + 1
                end = start["offset"] + start["length"]
                while past < len(places) and places[past]["file"] == start["file"] and places[past]["offset"] == end and end - start["offset"] < together:
                    end += places[past]["length"]
                    past += 1
                with system.open_input_file(start["file"]) as data:
                    members = data.read_at(end - start["offset"], start["offset"])
                rows = []
                for p in places[at:past]:
                    headers, payload = parse(members[p["offset"] - start["offset"] :][: p["length"]])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    revisit = headers["WARC-Type"] == "revisit"
                    if not revisit and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"damaged record in {p['file']} at {p['offset']}")
                    rows.append((page_of(headers["WARC-Record-ID"]), headers["WARC-Type"], page_of(headers.get("WARC-Refers-To")), digest, None if revisit else payload))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
                names = ["page_id", "record_type", "refers_to", "payload_digest", "payload"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                at = past

    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = captures.select("file", "offset", "length").repartitionByRange(parts, "file", "offset")
    schema = "page_id long, record_type string, refers_to long, payload_digest string, payload binary"
    return placed.sortWithinPartitions("file", "offset").mapInArrow(read, schema)


def round_trip(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Writes pages to an archive in the shared folder, finds each URL in its index and reads the records back."""
    archive = write_archive(pages, new_path(pages.sparkSession, "archive"), least_bytes)
    records = read_records(archive, look_up(archive, pages.select("url")))
    records = written(records.withColumn("payload_bytes", F.octet_length("payload").cast("long")).drop("payload"), "records")
    responses = (
        records.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"))
        .agg(F.max("payload_bytes").alias("_bytes"))
    )
    responses = written(responses, "responses")  # then Spark can split the revisits of a response that very many refer to
    same = (F.col("refers_to") == F.col("_id")) & (F.col("payload_digest") == F.col("_digest"))
    return records.join(responses, same, "left").select(
        "page_id", F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )
