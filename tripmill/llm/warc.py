"""Operator 5: a deterministic sharded WARC writer, and the reader of its archives.

Records are dealt to shards by ranges of the page id. The splitters come from a
sample chosen by a hash of the ids, so they, and with them every file, are the same
however the table is partitioned. A shard is sorted and written as files that roll
at a compressed size. HTTP headers, lengths, digests and record ids are made anew.
A file is written under a temporary name and moved when complete; only files that
the manifest table lists are part of the archive, so a task that is run again
replaces its files by the same bytes.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes the one with the
largest page id is a response and the others revisit it; among rows that also share
that id the first is the response. Null html is an empty payload. A null id sorts
first and is never preferred. Empty tables make an empty manifest. Other columns are
ignored. Memory: one record, and one Arrow batch.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import columns_here, stored, work_dir

MIN_REVISIT = 1000
#: Bytes of payload in a shard, and compressed bytes at which a file is closed.
SHARD_BYTES = 32 << 20
ROLL_BYTES = 64 << 20
MAX_SHARDS = 1 << 16
SAMPLES_PER_SHARD = 20
#: All records bear this date: it is part of the bytes that must not change.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n"

MANIFEST = "file string, shard bigint, records bigint, bytes bigint, sha1 string"
RECORDS = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string,"
    " refers_to bigint, file string"
)


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI, as Spark writes them."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record_id(page_id: int | None, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{copy}')}>"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    lines = [*headers, ("Content-Length", str(len(block)))]
    head = b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in lines)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + END + block + END + END) + packer.flush()


def page_record(
    page_id: int | None, url: str | None, payload: bytes, copy: int, refers_to: tuple | None
) -> bytes:
    """A response, or a revisit where ``refers_to`` holds the id of the response."""
    digest = hashlib.sha1(payload).digest()
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        + f"Content-Length: {len(payload)}\r\n\r\n".encode()
    )
    block = http if refers_to else http + payload
    headers = [
        ("WARC-Type", "revisit" if refers_to else "response"),
        ("WARC-Record-ID", record_id(page_id, copy)),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", base32(digest)),
        ("WARC-Block-Digest", base32(hashlib.sha1(block).digest())),
    ]
    if url:
        # Nothing in a URL may end the header line.
        headers.append(("WARC-Target-URI", "%20".join(url.split()) or "about:blank"))
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if refers_to:
        headers.append(("WARC-Profile", PROFILE))
        headers.append(("WARC-Refers-To", record_id(refers_to[0], 0)))
        if refers_to[0] is not None:
            headers.append(("X-Refers-To-Page-ID", str(refers_to[0])))
    return record(headers, block)


class Shard:
    """Writes one shard's files in turn."""

    def __init__(self, root: str, shard: int, roll_bytes: int) -> None:
        self.files, self.path = filesystem(root)
        self.shard, self.roll_bytes, self.number, self.out = shard, roll_bytes, 0, None

    def add(self, data: bytes) -> dict | None:
        """Append a record; the manifest row of the file that this one fills, if any."""
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.path}/_temporary/{self.name}.{uuid.uuid4().hex}"
            self.files.create_dir(f"{self.path}/_temporary", recursive=True)
            self.out = self.files.open_output_stream(self.temporary, compression=None)
            self.records, self.bytes, self.sha1 = 0, 0, hashlib.sha1()
            info = f"software: shard writer\r\nformat: WARC File Format 1.1\r\nfile: {self.name}\r\n"
            self._write(
                record(
                    [
                        ("WARC-Type", "warcinfo"),
                        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, self.name)}>"),
                        ("WARC-Date", DATE),
                        ("WARC-Filename", self.name),
                        ("Content-Type", "application/warc-fields"),
                    ],
                    info.encode(),
                )
            )
        self._write(data)
        self.records += 1
        return self.close() if self.bytes >= self.roll_bytes else None

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)
        self.sha1.update(data)

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.files.move(self.temporary, f"{self.path}/{self.name}")
        self.out, self.number = None, self.number + 1
        return {
            "file": self.name, "shard": self.shard, "records": self.records, "bytes": self.bytes,
            "sha1": self.sha1.hexdigest(),
        }


def shard_of(pages: DataFrame, shards: int, rows: int) -> Column:
    """The shard of a page id: its place among splitters sampled by a hash of the ids."""
    every = max(1, rows // (SAMPLES_PER_SHARD * shards))
    ids = F.col("page_id")
    picked = pages.where(ids.isNotNull() & (F.pmod(F.xxhash64(ids), F.lit(every)) == 0))
    sample = np.sort(columns_here(picked.select(ids).distinct())[0])
    splitters = sample[len(sample) * np.arange(1, shards) // shards] if len(sample) else sample

    @F.pandas_udf("bigint")
    def place(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        values = ids.fillna(0).to_numpy(dtype=np.int64)
        return pd.Series(np.where(known, np.searchsorted(splitters, values, side="right"), 0))

    return place(ids)


def write_archive(
    pages: DataFrame, root: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES
) -> DataFrame:
    """Write ``page_id, url, html`` below ``root``; the manifest, as a stored table."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    facts = pages.select("page_id", F.sha1("payload").alias("digest"), F.length("payload").alias("n"))
    facts = stored(facts, "payload-facts")
    rows, size = facts.agg(F.count("*"), F.sum("n")).first()
    shards = min(MAX_SHARDS, max(1, -(-int(size or 0) // shard_bytes)))
    many = facts.where(F.col("n") >= MIN_REVISIT).groupBy("digest").agg(
        F.max("page_id").alias("winner"), F.count("*").alias("copies")
    )
    notes = facts.join(many.where("copies > 1"), "digest").select("page_id", "digest", "winner").distinct()
    null = F.lit(None)
    both = notes.select(
        "page_id", F.lit(0).alias("kind"), "digest", "winner", null.cast("string").alias("url"),
        null.cast("binary").alias("payload"),
    ).unionByName(
        pages.select(
            "page_id", F.lit(1).alias("kind"), null.cast("string").alias("digest"),
            null.cast("bigint").alias("winner"), "url", "payload",
        )
    )
    dealt = both.withColumn("shard", shard_of(facts, shards, rows))
    dealt = dealt.repartitionById(shards, F.col("shard").cast("int"))
    dealt = dealt.sortWithinPartitions("shard", "page_id", "kind", "digest", "url", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, winners, copies, answered, done = None, (), {}, 0, set(), []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None or out.shard != row["shard"]:
                    done += [out.close()] if out else []
                    out, now = Shard(root, row["shard"], roll_bytes), ()
                page_id = row["page_id"]
                if now != (page_id,):
                    now, winners, copies, answered = (page_id,), {}, 0, set()
                if row["kind"] == 0:
                    winners[row["digest"]] = row["winner"]
                    continue
                digest = hashlib.sha1(row["payload"]).hexdigest()
                refers_to = None
                if digest in winners:
                    if winners[digest] != page_id or digest in answered:
                        refers_to = (winners[digest],)
                    answered.add(digest)
                data = page_record(page_id, row["url"], row["payload"], copies, refers_to)
                copies += 1
                done.append(out.add(data))
            done = [row for row in done if row]
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=fields)
            done = []
        done = [out.close()] if out else []
        if any(done):
            yield pa.RecordBatch.from_pylist([row for row in done if row], schema=fields)

    fields = pa.schema(
        [("file", pa.string()), ("shard", pa.int64()), ("records", pa.int64()), ("bytes", pa.int64()),
         ("sha1", pa.string())]
    )
    return stored(dealt.mapInArrow(run, MANIFEST), "warc-manifest")


def members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, decompressed one by one."""
    unpacker, parts = zlib.decompressobj(31), []
    while chunk := stream.read(1 << 20):
        while chunk:
            parts.append(unpacker.decompress(chunk))
            chunk = unpacker.unused_data
            if unpacker.eof:
                yield b"".join(parts)
                unpacker, parts = zlib.decompressobj(31), []
    if parts and any(parts):
        raise ValueError("the file ends inside a record")


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record; raises if length or digest is wrong."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    length = int(headers["Content-Length"])
    block = rest[:length]
    if rest[length:] != END + END:
        raise ValueError("wrong record length")
    want = headers.get("WARC-Block-Digest")
    if want and want != base32(hashlib.sha1(block).digest()):
        raise ValueError("wrong block digest")
    return headers, block


def read_archive(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """One row per page record of the files in the manifest, in the columns of ``RECORDS``."""
    count = manifest.count()

    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    def rows_of(name: str) -> Iterator[dict]:
        files, path = filesystem(root)
        with files.open_input_stream(f"{path}/{name}", compression=None) as stream:
            for data in members(stream):
                headers, block = parsed(data)
                if headers["WARC-Type"] == "warcinfo":
                    continue
                http, _, payload = block.partition(b"\r\n\r\n")
                length = int(http.rpartition(b"Content-Length: ")[2])
                digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:"))
                if headers["WARC-Type"] == "response" and (
                    len(payload) != length or hashlib.sha1(payload).digest() != digest
                ):
                    raise ValueError("wrong payload")
                yield {
                    "page_id": number(headers.get("X-Page-ID")),
                    "payload_bytes": length,
                    "payload_digest": digest.hex(),
                    "record_type": headers["WARC-Type"],
                    "refers_to": number(headers.get("X-Refers-To-Page-ID")),
                    "file": name,
                }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                for row in rows_of(name):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=fields)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=fields)

    fields = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.string())]
    )
    return manifest.select("file").repartition(max(1, min(count, 10_000))).mapInArrow(run, RECORDS)


def archived(pages: DataFrame) -> DataFrame:
    """Write an archive to a new folder of the shared place and read it back."""
    root = work_dir(pages.sparkSession, "warc")
    return read_archive(pages.sparkSession, root, write_archive(pages, root))
