"""WARC archives from and to chunked record tables.

A payload travels as rows of (record, chunk number, bytes), cut by Spark, so that no Python process ever holds a whole one: the writer
streams the chunks of a record into its archive, the reader streams them out again, and both carry the payload's SHA-1 along from chunk to
chunk. An archive is a file of gzip members, one a record, as the format advises.

Records of equal payloads (of ``least_bytes`` at least) are written once: the smallest page is the response, the others are revisits
that refer to it. Which is which is found on digests alone; payloads are shuffled once, to spread the archives evenly. Archives are written under
a temporary name, renamed when whole, and listed in a manifest that holds one attempt of each task, so a repeated task does no harm.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.durable import keep, new_folder
from .anchors import integer_key

CHUNK, LEVEL = 64 << 10, 3
#: Fixed values of the format (WARC 1.1).
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
MANIFEST = "path string, records long, bytes long"


def chunked(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", chunk: int = CHUNK) -> DataFrame:
    """(id, row, url, size, digest, chunk, data): the payload of every row in chunks, one at least. A null payload is empty."""
    raw = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), F.col(url).alias("url"), raw.alias("raw"))
    sized = rows.select("id", "row", "url", "raw", F.octet_length("raw").cast("long").alias("size"), F.sha1("raw").alias("digest"))
    numbers = F.sequence(F.lit(0).cast("long"), F.floor(F.greatest(F.col("size") - 1, F.lit(0)) / chunk))
    each = sized.select("*", F.explode(numbers).alias("chunk"))
    return each.select("id", "row", "url", "size", "digest", "chunk", F.substring("raw", F.col("chunk").cast("int") * chunk + 1, F.lit(chunk)).alias("data"))


def revisits(pages: DataFrame, key: str = "page_id", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """(id, digest, refers_to) of the pages whose payload a smaller page has too."""
    raw = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    narrow = pages.select(F.col(key).cast("long").alias("id"), F.sha1(raw).alias("digest"), F.octet_length(raw).alias("size")).where(F.col("size") >= least_bytes)
    first = narrow.groupBy("digest").agg(F.min("id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "refers_to")
    return keep(narrow.select("id", "digest").join(keep(first), "digest").where("id > refers_to").select("id", "digest", "refers_to").distinct())


class Place:
    """Files of a folder that all executors share: a local path by plain files, any other by the file system of its scheme."""

    def __init__(self, folder: str) -> None:
        if folder.startswith("file:") or "://" not in folder:
            self.fs, self.root = None, re.sub(r"^file:/*", "/", folder)
        else:
            from pyarrow import fs

            self.fs, self.root = fs.FileSystem.from_uri(folder)

    def create(self, name: str):
        if self.fs is None:
            os.makedirs(self.root, exist_ok=True)
            return open(f"{self.root}/{name}", "wb")
        self.fs.create_dir(self.root)
        return self.fs.open_output_stream(f"{self.root}/{name}")

    def rename(self, old: str, new: str) -> None:
        (os.replace if self.fs is None else self.fs.move)(f"{self.root}/{old}", f"{self.root}/{new}")

    def open(self, name: str):
        return open(f"{self.root}/{name}", "rb") if self.fs is None else self.fs.open_input_stream(f"{self.root}/{name}")


class Member:
    """One record of an archive, written as a gzip member of its own while its chunks come in."""

    def __init__(self, out, page: int | None, url: str | None, size: int, digest: bytes, refers_to: int | None) -> None:
        self.out, self.gzip, self.want = out, zlib.compressobj(LEVEL, zlib.DEFLATED, 31), None if refers_to is not None else digest
        self.sha, self.bytes, self.size = hashlib.sha1(), 0, size
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
        name = f"<urn:page:{'' if page is None else page}>"
        fields = [
            ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", name), ("WARC-Date", DATE),
            ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else name[1:-1]),
            ("WARC-Payload-Digest", f"sha1:{base64.b32encode(digest).decode()}"),
            *([("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)] if refers_to is not None else []),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(http) + (size if refers_to is None else 0))),
        ]
        self.put(VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + http)

    def put(self, raw: bytes) -> None:
        out = self.gzip.compress(raw)
        self.bytes += len(out)
        self.out.write(out)

    def chunk(self, data: bytes) -> None:
        self.sha.update(data)
        self.put(data)

    def close(self) -> int:
        if self.want is not None and self.sha.digest() != self.want:
            raise ValueError("the chunks of a record don't make its payload")
        self.put(b"\r\n\r\n")
        out = self.gzip.flush()
        self.out.write(out)
        return self.bytes + len(out)


def writer(folder: str):
    """A mapInArrow function over chunk rows in order: writes an archive for the task, and yields its manifest row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        place, name = Place(folder), f"{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz"
        out, member, at, records, size = None, None, None, 0, 0
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in ("id", "row", "url", "size", "digest", "refers_to")}
                here = (row["row"].as_py(), row["id"].as_py())
                if here != at:
                    size += member.close() if member else 0
                    out = out or place.create(f"{name}.tmp")
                    member = Member(out, row["id"].as_py(), row["url"].as_py(), row["size"].as_py(), bytes.fromhex(row["digest"].as_py()), row["refers_to"].as_py())
                    at, records = here, records + 1
                if row["refers_to"].as_py() is None:
                    member.chunk(batch.column("data")[k].as_py())
        if out is not None:
            size += member.close()
            out.close()
            place.rename(f"{name}.tmp", name)
            yield pa.record_batch([pa.array([f"{folder}/{name}"]), pa.array([records]), pa.array([size])], ["path", "records", "bytes"])

    return run


def write(pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Writes a record per row and returns the manifest (path, records, bytes), one row an archive. The key is an integer, else a TypeError is raised.

    ``folder``: one that all executors reach; by default a new one in the shared folder. A null payload is empty, a null url is replaced by the record's name,
    and a null page is never the one referred to unless alone. Rows that repeat a page and payload are written each, as what the page is, under one name. Extra columns are not
    read. An empty table makes no archive.
    """
    integer_key(pages, key)
    folder = (folder or new_folder(pages.sparkSession, "warc")).rstrip("/")
    again = revisits(pages, key, payload, least_bytes)
    rows = chunked(pages, key, url, payload, chunk).join(again, ["id", "digest"], "left").where("refers_to is null or chunk = 0")
    data = F.when(F.col("refers_to").isNull(), F.col("data"))
    ready = rows.select("id", "row", "url", "size", "digest", "refers_to", "chunk", data.alias("data")).repartition("id", "digest")
    return keep(ready.sortWithinPartitions("id", "row", "chunk").mapInArrow(writer(folder), MANIFEST))


def records(stream, chunk: int = CHUNK) -> Iterator[tuple[dict[str, str], int, bytes, str | None]]:
    """(fields, chunk number, bytes, digest so far) of each payload chunk of an archive; a record without payload gives one empty chunk.

    Payloads are checked against their digests; fields have the payload's length, also of a revisit, as HTTP-Length.
    """
    while True:
        line = stream.readline()
        if not line:
            return
        if line != VERSION:
            raise ValueError("not a WARC record")
        fields = dict(_fields(stream))
        left = int(fields["Content-Length"])
        status = stream.readline()
        head = dict(_fields(stream))
        left -= len(status) + sum(len(k.encode()) + len(v.encode()) + 4 for k, v in head.items()) + 2
        fields["HTTP-Length"] = head["Content-Length"]
        sha, number = hashlib.sha1(), 0
        while left or not number:
            data = stream.read(min(left, chunk))
            if left and not data:
                raise ValueError("an archive ends within a record")
            left -= len(data)
            sha.update(data)
            so_far = f"sha1:{base64.b32encode(sha.digest()).decode()}"
            if not left and fields["WARC-Type"] == "response" and so_far != fields["WARC-Payload-Digest"]:
                raise ValueError("a payload's digest is wrong")
            yield fields, number, data, so_far
            number += 1
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record has a wrong length")


def _fields(stream) -> Iterator[tuple[str, str]]:
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode().rstrip("\r\n").partition(": ")
        yield name, value


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            folder, _, name = path.rpartition("/")
            with Place(folder).open(name) as raw, gzip.GzipFile(fileobj=raw) as stream:
                yield stream


def _spread(manifest: DataFrame) -> DataFrame:
    return manifest.select("path").repartition(max(1, manifest.count()))


def read(manifest: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of every record, payloads checked."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stream in _streams(batches):
            rows = []
            for fields, number, _, _ in records(stream):
                if not number:
                    rows.append((_page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], int(fields["HTTP-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"], _page(fields.get("WARC-Refers-To"))))
                    if len(rows) == 10_000:
                        yield table(rows)
                        rows = []
            yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    return _spread(manifest).mapInArrow(run, schema)


def read_chunks(manifest: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(page_id, record_type, chunk, data, digest): the payload chunks, each with the digest of the payload up to its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stream in _streams(batches):
            for fields, number, data, digest in records(stream, chunk):
                row = (_page(fields["WARC-Record-ID"]), fields["WARC-Type"], number, data, digest.removeprefix("sha1:"))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string())
                yield pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], ["page_id", "record_type", "chunk", "data", "digest"])

    return _spread(manifest).mapInArrow(run, "page_id long, record_type string, chunk long, data binary, digest string")
