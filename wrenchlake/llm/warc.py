"""Zstandard web archives: write them, and read them back record by record.

An archive (``.warc.zst``) is a skippable frame that holds the dictionary,
followed by one frame per record. The reader loads the dictionary from that
leading frame, decodes frame after frame, and checks every header and length:
the frame's content size, the version line, the mandatory headers,
``Content-Length`` against the block, the record's end mark, and the payload
digest of responses.

Of pages with equal payloads of at least ``REVISIT_BYTES`` the one with the
largest id is a response, the others revisit it.

Defined cases: a null html is an empty payload. A null id counts as smaller
than any other; its record carries no id. Rows that share both the largest id
and the payload are all responses. Pages without any row give archives without
records. Columns beyond id, url and html are ignored.
"""

from __future__ import annotations

import hashlib
import io
import os
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchlake.session import scratch_path

REVISIT_BYTES = 1000
# A task starts a new archive beyond this many bytes.
ARCHIVE_BYTES = 32 << 20
# The dictionary of an archive is trained on the first records of its task.
DICTIONARY_BYTES = 16 << 10
SAMPLE_BYTES = 2 << 20
LEVEL = 3

# Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
MANDATORY = (b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"Content-Length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def with_record_types(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_digest, payload_bytes, record_type, refers_to.

    Digests are counted first, on (digest, id) alone; only digests that occur
    more than once meet the pages again.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    own = own.withColumns({"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    groups = (
        own.filter(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    joined = own.join(groups, F.col("payload_digest") == F.col("_digest"), "left")
    revisit = F.col("_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.select(
        "page_id", "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        "payload_digest", "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_first")).alias("refers_to"),
    )


def _line(name: str, value: object) -> str:
    clean = str(value).replace("\r", " ").replace("\n", " ")
    return f"{name}: {clean}\r\n"


def record_urn(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record_bytes(row: dict) -> bytes:
    """One record: headers, block (HTTP headers and, for a response, the payload), end mark."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    block = http.encode() + (row["payload"] or b"")
    head = VERSION.decode() + "\r\n"
    head += _line("WARC-Type", row["record_type"]) + _line("WARC-Record-ID", record_urn(row["page_id"], row["payload_digest"]))
    head += _line("WARC-Date", DATE)
    if row["url"] is not None:
        head += _line("WARC-Target-URI", row["url"])
    if row["page_id"] is not None:
        head += _line("WARC-Page-Id", row["page_id"])
    head += _line("WARC-Payload-Digest", f"sha1:{row['payload_digest']}")
    if row["record_type"] == "revisit":
        head += _line("WARC-Profile", REVISIT_PROFILE)
        head += _line("WARC-Refers-To", record_urn(row["refers_to"], row["payload_digest"]))
        head += _line("WARC-Refers-To-Page-Id", row["refers_to"])
    head += _line("Content-Type", "application/http; msgtype=response") + _line("Content-Length", len(block))
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples' beginning where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES] or b"WARC"


class _Archive:
    """One archive under a hidden name, renamed when it is complete."""

    def __init__(self, fs: pafs.FileSystem, folder: str, name: str, dictionary: bytes):
        self._fs, self._final = fs, f"{folder}/{name}"
        self._hidden = f"{folder}/_{uuid.uuid4().hex}-{name}"
        self._out = fs.open_output_stream(self._hidden, compression=None)  # frames are made here
        self._out.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
        kind = zstandard.ZstdCompressionDict(dictionary)
        self._press = zstandard.ZstdCompressor(level=LEVEL, dict_data=kind, write_content_size=True, write_checksum=True)
        self.size = self.records = 0

    def add(self, record: bytes) -> None:
        frame = self._press.compress(record)
        self._out.write(frame)
        self.size += len(frame)
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self._out.close()
        self._fs.move(self._hidden, self._final)
        return self._final, self.records, self.size


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write archives below ``folder`` (a URI that every executor reaches); a plan that returns
    archive, records, bytes of each.

    Rows are sorted inside each task first, so a task that runs again writes
    the same archives under the same names over the earlier ones.
    """
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, where = pafs.FileSystem.from_uri(folder if "://" in folder else os.path.abspath(folder))
        task = TaskContext.get().partitionId()
        done, held, held_bytes = [], [], 0
        archive, dictionary = None, None

        def put(record: bytes) -> None:
            nonlocal archive
            if archive is None:
                archive = _Archive(fs, where, f"part-{task:06d}-{len(done):04d}.warc.zst", dictionary)
            archive.add(record)
            if archive.size >= archive_bytes:
                done.append(archive.close())
                archive = None

        for batch in batches:
            for at in range(batch.num_rows):
                record = record_bytes({name: batch.column(name)[at].as_py() for name in batch.schema.names})
                if dictionary is not None:
                    put(record)
                    continue
                held.append(record)
                held_bytes += len(record)
                if held_bytes >= SAMPLE_BYTES:
                    dictionary = _dictionary(held)
                    for early in held:
                        put(early)
                    held = []
        if held:
            dictionary = _dictionary(held)
            for early in held:
                put(early)
        if archive is not None:
            done.append(archive.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in done], pa.string()), *(pa.array([x[k] for x in done], pa.int64()) for k in (1, 2))],
            ["archive", "records", "bytes"],
        )

    ordered = records.sortWithinPartitions("page_id", "payload_digest", "url")
    return ordered.mapInArrow(run, "archive string, records long, bytes long")


def _fail(name: str, at: int, why: str) -> None:
    raise ValueError(f"{name}, byte {at}: {why}")


def archive_records(name: str, content: bytes) -> Iterator[dict]:
    """The records of one archive; raises ``ValueError`` at the first fault."""
    kind, at = None, 0
    if len(content) >= 8 and struct.unpack_from("<I", content)[0] == DICTIONARY_MAGIC:
        size = struct.unpack_from("<I", content, 4)[0]
        if 8 + size > len(content):
            _fail(name, 0, "the dictionary frame is cut off")
        raw = content[8 : 8 + size]
        if len(raw) >= 4 and struct.unpack_from("<I", raw)[0] == FRAME_MAGIC:  # the dictionary may itself be compressed
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        kind, at = zstandard.ZstdCompressionDict(raw), 8 + size
    view = memoryview(content)
    unpack = zstandard.ZstdDecompressor(dict_data=kind)
    while at < len(content):
        if len(content) - at < 4 or struct.unpack_from("<I", content, at)[0] != FRAME_MAGIC:
            _fail(name, at, "no frame starts here")
        stated = zstandard.get_frame_parameters(view[at : at + 18]).content_size
        one = unpack.decompressobj()
        out, fed = io.BytesIO(), at
        try:
            while not one.eof and fed < len(content):
                out.write(one.decompress(view[fed : fed + (1 << 16)]))
                fed = min(fed + (1 << 16), len(content))
        except zstandard.ZstdError as error:
            _fail(name, at, str(error))
        if not one.eof:
            _fail(name, at, "the frame is cut off")
        record = out.getvalue()
        if stated not in (zstandard.CONTENTSIZE_UNKNOWN, len(record)):
            _fail(name, at, f"the frame states {stated} bytes and holds {len(record)}")
        yield _parsed(name, at, record)
        at = fed - len(one.unused_data)


def _parsed(name: str, at: int, record: bytes) -> dict:
    head, found, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] not in (VERSION, b"WARC/1.0"):
        _fail(name, at, "no record header")
    headers: dict[bytes, bytes] = {}
    for line in lines[1:]:
        key, colon, value = line.partition(b":")
        if not colon or not key.strip():
            _fail(name, at, f"not a header: {line[:80]!r}")
        headers[key.strip().lower()] = value.strip()
    for key in MANDATORY:
        if key.lower() not in headers:
            _fail(name, at, f"{key.decode()} is missing")
    length = headers[b"content-length"]
    if not length.isdigit() or int(length) != len(rest) - 4 or rest[-4:] != b"\r\n\r\n":
        _fail(name, at, f"Content-Length is {length[:20]!r}, the block has {len(rest) - 4} bytes")
    http, found, payload = rest[:-4].partition(b"\r\n\r\n")
    if not found:
        _fail(name, at, "the block has no HTTP headers")
    http_headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:])}
    stated = http_headers.get(b"content-length", b"")
    if not stated.isdigit():
        _fail(name, at, "the HTTP headers lack Content-Length")
    kind = headers[b"warc-type"].decode()
    digest = headers.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode()
    if kind == "response":
        if int(stated) != len(payload):
            _fail(name, at, f"the payload has {len(payload)} bytes, stated are {int(stated)}")
        if digest != hashlib.sha1(payload).hexdigest():
            _fail(name, at, "the payload does not match its digest")
    elif kind == "revisit":
        if payload or b"warc-refers-to" not in headers:
            _fail(name, at, "a revisit has a payload or refers to nothing")
    else:
        _fail(name, at, f"unknown type {kind}")

    def number(key: bytes) -> int | None:
        return int(headers[key]) if key in headers else None

    return {
        "page_id": number(b"warc-page-id"),
        "url": headers[b"warc-target-uri"].decode() if b"warc-target-uri" in headers else None,
        "record_type": kind,
        "payload_digest": digest,
        "payload_bytes": int(stated),
        "refers_to": number(b"warc-refers-to-page-id"),
        "payload": payload if kind == "response" else None,
    }


RECORD = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long"


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """All records of the archives below ``folder``, which may lie in any store that Spark reads."""
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
         ("payload_bytes", pa.int64()), ("refers_to", pa.int64())] + ([("payload", pa.binary())] if with_payload else [])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                name = batch.column("path")[at].as_py()
                rows, size = [], 0
                for record in archive_records(name, batch.column("content")[at].as_py()):
                    rows.append({field: record[field] for field in schema.names})
                    size += len(record["payload"] or b"") if with_payload else 200
                    if size >= 1 << 22:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path", "content")
    return files.mapInArrow(run, RECORD + (", payload binary" if with_payload else ""))


def archive_pages(pages: DataFrame, folder: str | None = None) -> tuple[str, int, int]:
    """Write ``pages`` as archives; the folder, and how many archives and records it got."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)
    made = write_archives(with_record_types(pages), folder)
    count = made.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("records"), F.lit(0)).alias("records")).first()
    return folder, count["n"], count["records"]
