"""WARC archives with per-record Zstandard compression and an embedded dictionary.

A file starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary, trained on the
file's own records; then comes one Zstandard frame per record, so each can be read by itself. Equal
payloads are stored once: the record with the smallest id is the response, the others are revisits
that refer to it.

Which record is the response is found by a grouping of payload digests, without the payloads. Tasks
write their own files, each holding about ``file_bytes`` of payload, under a name unique to the
attempt, and return a manifest row per file. Only files in the committed manifest are read, so a
task that is lost and run again leaves a stray file but no double record. Files are written through
``pyarrow.fs``, so the folder may be any store it knows.

Defined results: null html is an empty payload; null urls have no target header; a null id is never
chosen as response while another row has the same payload and an id; rows that repeat the smallest
id of their payload are all responses. An empty table writes no file and reads back no row.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replaystats.llm.text import batches, pick, small_batches
from replaystats.session import staging_root

# Fixed values of the format.
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DICTIONARY_BYTES = 32 << 10
SAMPLE_BYTES = 1 << 20  # of a file's records, spread over the file, for its dictionary
CHUNK = 1 << 20


@dataclass
class Record:
    kind: str
    ident: int | None
    digest: str
    length: int
    refers_to: int | None = None
    url: str | None = None
    payload: bytes | None = None


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(ident: int | None) -> bytes:
    return f"<urn:page:{'none' if ident is None else ident}>".encode()


def _ident(urn: bytes) -> int | None:
    text = urn[len(b"<urn:page:") : -1]
    return None if text == b"none" else int(text)


def serialise(record: Record, date: str) -> bytes:
    """The bytes of a record: WARC headers, HTTP headers and, for a response, the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % record.length
    block = http + (record.payload if record.kind == "response" else b"")
    headers = [
        (b"WARC-Type", record.kind.encode()),
        (b"WARC-Record-ID", _urn(record.ident)),
        (b"WARC-Date", date.encode()),
        (b"WARC-Payload-Digest", b"sha1:" + record.digest.encode()),
        (b"Content-Type", b"application/http; msgtype=response"),
        (b"Content-Length", b"%d" % len(block)),
    ]
    if record.url is not None:
        headers.append((b"WARC-Target-URI", quote(record.url, safe=":/?#[]@!$&'()*+,;=%~").encode()))
    if record.kind == "revisit":
        headers += [(b"WARC-Profile", REVISIT_PROFILE), (b"WARC-Refers-To", _urn(record.refers_to))]
    return VERSION + b"\r\n" + b"".join(n + b": " + v + b"\r\n" for n, v in headers) + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> Record:
    """The record of its bytes; a response's payload must match its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version != VERSION:
        raise ValueError("not a WARC record")
    headers = dict(line.split(b": ", 1) for line in lines)
    block = rest[: int(headers[b"Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(line.split(b": ", 1) for line in http.split(b"\r\n")[1:])[b"Content-Length"])
    kind = headers[b"WARC-Type"].decode()
    digest = headers[b"WARC-Payload-Digest"].decode().removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or digest32(payload) != digest):
        raise ValueError("a payload does not match its digest")
    return Record(
        kind,
        _ident(headers[b"WARC-Record-ID"]),
        digest,
        length,
        _ident(headers[b"WARC-Refers-To"]) if kind == "revisit" else None,
        headers[b"WARC-Target-URI"].decode() if b"WARC-Target-URI" in headers else None,
        payload if kind == "response" else None,
    )


def train(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary from records spread over the file; too few to train on serve as raw content."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    sample = [r[:CHUNK] for r in records[::step]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, level=3)
    except zstandard.ZstdError:
        raw = b"".join(sample)[-DICTIONARY_BYTES:]
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_file(out, records: list[bytes]) -> None:
    dictionary = train(records)
    body = dictionary.as_bytes()
    out.write(DICTIONARY_MAGIC + len(body).to_bytes(4, "little") + body)
    packer = zstandard.ZstdCompressor(level=3, dict_data=dictionary)
    for record in records:
        out.write(packer.compress(record))


def read_file(source) -> Iterator[bytes]:
    """Bytes of each record of a file, holding one record and one read chunk at a time."""
    head = source.read(8)
    if head[:4] != DICTIONARY_MAGIC:
        raise ValueError("the file does not start with a dictionary")
    body = source.read(int.from_bytes(head[4:], "little"))
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
    held = source.read(CHUNK)
    while held:
        frame, parts = unpacker.decompressobj(), []
        while not frame.eof:
            if not held:
                held = source.read(CHUNK)
                if not held:
                    raise ValueError("the last record is cut off")
            parts.append(frame.decompress(held))
            held = frame.unused_data if frame.eof else b""
        yield b"".join(parts)
        held = held or source.read(CHUNK)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system: that of the cluster's configuration where the name has none. So
    all machines mean the same place."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub("^file:/(?!/)", "file:///", full)


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def plan(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(id, url, html, digest, refers_to) per page; refers_to is null for responses. pages: (id, url, html)."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    keyed = pages.select("id", F.sha1(payload).alias("digest"), F.length(payload).alias("length"))
    first = keyed.filter(F.col("length") >= min_bytes).groupBy("digest").agg(F.min("id").alias("first"))
    # Few bytes a row: the payloads stay out of the join on a digest that many pages may share.
    follows = (
        keyed.filter(F.col("length") >= min_bytes)
        .join(first, "digest")
        .filter(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")))
        .select(F.col("id").alias("from_id"), F.col("digest").alias("from_digest"), "first")
        .distinct()
    )
    pages = pages.withColumn("digest", F.sha1(payload))
    found = pages.join(
        follows, F.col("id").eqNullSafe(F.col("from_id")) & (F.col("digest") == F.col("from_digest")), "left"
    )
    # A revisit needs no payload from here on, only its length.
    return found.select(
        "id",
        "url",
        F.when(F.col("first").isNull(), payload).alias("html"),
        F.length(payload).cast("long").alias("length"),
        F.col("digest"),
        F.col("first").alias("refers_to"),
    )


def write(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = 0,
    file_bytes: int = 16 << 20,
    date: datetime | None = None,
) -> DataFrame:
    """Write the archives below ``folder`` and return their manifest (path, records, bytes), committed
    as Parquet beside them. Payloads below ``min_bytes`` are never revisits."""
    spark = pages.sparkSession
    small_batches(spark)
    stamp = (date or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
    planned = plan(pick(pages, id_col, url_col, html_col).toDF("id", "url", "html"), min_bytes)
    folder = qualified(spark, folder)
    system, root = _open(folder)
    system.create_dir(root, recursive=True)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)

        def rows() -> Iterator[bytes]:
            for batch in source:
                for row in batch.to_pylist():
                    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
                    kind = "response" if row["refers_to"] is None else "revisit"
                    yield serialise(
                        Record(kind, row["id"], digest, row["length"], row["refers_to"], row["url"], row["html"]), stamp
                    )

        for records in batches(rows(), file_bytes, len):
            path = f"{base}/{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(path) as out:
                write_file(out, records)
            size = store.get_file_info(path).size
            yield pa.RecordBatch.from_pylist(
                [{"path": path, "records": len(records), "bytes": size}],
                schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
            )

    manifest = f"{folder}/manifest"
    planned.mapInArrow(run, "path string, records long, bytes long").write.parquet(manifest)
    return spark.read.schema("path string, records long, bytes long").parquet(manifest)


def read(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """(id, url, payload, payload_bytes, payload_digest, record_type, refers_to) per record of the
    manifest's files, one file a task. ``payloads=False`` checks payloads but returns nulls."""
    small_batches(manifest.sparkSession)
    folder = qualified(manifest.sparkSession, folder)
    schema = pa.schema(
        [
            ("id", pa.int64()),
            ("url", pa.string()),
            ("payload", pa.binary()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
        ]
    )

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _open(folder)
        for batch in source:
            for path in batch.column(0).to_pylist():
                with store.open_input_stream(path) as file:
                    for records in batches(map(parse, read_file(file)), CHUNK * 4, lambda r: 200 + r.length):
                        yield pa.RecordBatch.from_pylist(
                            [
                                {
                                    "id": r.ident,
                                    "url": r.url,
                                    "payload": r.payload if payloads else None,
                                    "payload_bytes": r.length,
                                    "payload_digest": r.digest,
                                    "record_type": r.kind,
                                    "refers_to": r.refers_to,
                                }
                                for r in records
                            ],
                            schema=schema,
                        )

    kinds = "id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    tasks = manifest.sparkSession.sparkContext.defaultParallelism * 4
    return manifest.select("path").repartition(tasks, "path").mapInArrow(run, kinds)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the shared place."""
    return f"{staging_root(spark)}/warc-{uuid.uuid4().hex}"
