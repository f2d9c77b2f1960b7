"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing: each task rolls archives of about `ARCHIVE_BYTES` of payload, trains a dictionary on the
first records of each, and writes it before the records as a skippable frame (magic 0x184D2A5D, as
the Zstandard profile of WARC states). A record whose payload equals a larger page's is a revisit
that refers to it. File names carry the attempt, and only the manifest that Spark commits says which
files count, so a task that is run again leaves nothing behind that is read.

Reading: each archive is streamed in pieces, one frame is decoded at a time, and version, headers,
lengths and digests are checked. Memory is bounded by a piece and the longest record.

Folders are opened by `pyarrow.fs`, so they may be on any file system that it knows.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.tables import stored
from rivulet.operators.rowsets import shared_folder

ARCHIVE_BYTES = 256 << 20
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 32 << 10
LEVEL = 3
MIN_REVISIT_BYTES = 1000
SALTS = 32
# Rows of a batch that are taken into Python at once.
ROWS = 64
PIECE = 1 << 20
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "path string, records long, payload_bytes long"
RECORD = (
    "record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, "
    "payload_digest string, payload binary"
)


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, record_type and refers_to of every page.

    Digests are grouped without their pages and joined back to the pages of `min_bytes` or more, equal ones
    dealt over `SALTS` parts.
    Null html is an empty payload. Rows that repeat the largest page_id of their payload are all
    responses; a page without an id is the smallest.
    """
    html = F.coalesce("html", F.lit(""))
    pages = pages.select(
        "page_id", "url", html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes")
    ).withColumn("payload_digest", F.sha1("html"))
    holders = (
        pages.where(F.col("payload_bytes") >= min_bytes)
        .groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.max("page_id").alias("holder"), F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
        .drop("copies")
    )
    # A digest that very many pages share is met in `SALTS` places; shorter pages are never revisits and stay out.
    holders = holders.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    long = pages.where(F.col("payload_bytes") >= min_bytes)
    long = long.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    met = long.join(holders, (F.col("payload_digest") == F.col("digest")) & (F.col("salt") == F.col("part")), "left")
    met = met.unionByName(pages.where(F.col("payload_bytes") < min_bytes), allowMissingColumns=True)
    again = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    return met.withColumns(
        {
            "record_type": F.when(again, "revisit").otherwise("response"),
            "refers_to": F.when(again, F.col("holder")),
        }
    ).drop("digest", "holder", "salt", "part")


def _header_value(value: str) -> str:
    """A value that stays on its line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _record(row: dict) -> bytes:
    payload = row["html"].encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    revisit = row["record_type"] == "revisit"
    block = http.encode() + (b"" if revisit else payload)
    headers = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": _record_id(row["page_id"]),
        "WARC-Date": DATE,
        "WARC-Target-URI": None if row["url"] is None else _header_value(row["url"]),
        "WARC-Refers-To": _record_id(row["refers_to"]) if revisit else None,
        "WARC-Profile": PROFILE if revisit else None,
        "WARC-Payload-Digest": f"sha1:{row['payload_digest']}",
        "WARC-Block-Digest": f"sha1:{hashlib.sha1(block).hexdigest()}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers.items() if value is not None)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _dictionary(sample: list[bytes]) -> bytes:
    """Trained on the sample; the end of the sample itself where it is too small to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sample)[-DICTIONARY_BYTES:]


class _Archive:
    def __init__(self, folder: str):
        filesystem, root = pyarrow.fs.FileSystem.from_uri(folder)
        name = f"{uuid.uuid4().hex}.warc.zst"
        filesystem.create_dir(root, recursive=True)
        self.path, self.records, self.payload_bytes = f"{folder}/{name}", 0, 0
        self._out = filesystem.open_output_stream(f"{root}/{name}", compression=None)
        self._waiting: list[bytes] = []
        self._sampled = 0
        self._compressor = None

    def add(self, record: bytes) -> None:
        self.records += 1
        self.payload_bytes += len(record)
        if self._compressor:
            self._out.write(self._compressor.compress(record))
            return
        self._waiting.append(record)
        self._sampled += len(record)
        if self._sampled >= SAMPLE_BYTES:
            self._start()

    def _start(self) -> None:
        raw = _dictionary([record[: 64 << 10] for record in self._waiting])
        self._compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw))
        packed = zstandard.ZstdCompressor(level=LEVEL).compress(raw)
        self._out.write(struct.pack("<II", SKIPPABLE, len(packed)) + packed)
        for record in self._waiting:
            self._out.write(self._compressor.compress(record))
        self._waiting = []

    def close(self) -> dict:
        if self._waiting:
            self._start()
        self._out.close()
        return {"path": self.path, "records": self.records, "payload_bytes": self.payload_bytes}


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder as Spark resolves it, so that a path without a scheme is on the same file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    whole = path.getFileSystem(conf).makeQualified(path).toString()
    return re.sub("^file:/+", "file:///", whole)


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the pages of `with_revisits` as archives below `folder`; the manifest of what was written."""
    folder = _qualified(pages.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                for row in batch.slice(at, ROWS).to_pylist():
                    archive = archive or _Archive(folder)
                    archive.add(_record(row))
                    if archive.payload_bytes >= archive_bytes:
                        done.append(archive.close())
                        archive = None
        if archive:
            done.append(archive.close())
        if done:
            yield pa.RecordBatch.from_pylist(done)

    rows = pages.select("page_id", "url", "html", "payload_digest", "record_type", "refers_to")
    return stored(rows.mapInArrow(write, MANIFEST), "warc-manifest")


def _frames(stream, where: str) -> Iterator[bytes]:
    """The decoded frames of an archive, one by one."""
    head = stream.read(8)
    if not head:
        return
    magic, length = struct.unpack("<II", head.ljust(8, b"\0"))
    if magic != SKIPPABLE or len(head) < 8:
        raise ValueError(f"{where}: no dictionary in a leading skippable frame")
    raw = stream.read(length)
    if len(raw) != length:
        raise ValueError(f"{where}: the dictionary ends early")
    if raw.startswith(FRAME):
        raw = zstandard.ZstdDecompressor().decompress(raw)
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    left = b""
    while True:
        left = left or stream.read(PIECE)
        if not left:
            return
        if len(left) < 8:
            left += stream.read(PIECE)
        if left[1:4] == b"\x2a\x4d\x18" and left[0] >> 4 == 5:
            left = _skipped(stream, left, where)
            continue
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if not left:
                left = stream.read(PIECE)
                if not left:
                    raise ValueError(f"{where}: a frame ends early")
            parts.append(frame.decompress(left))
            left = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def _skipped(stream, left: bytes, where: str) -> bytes:
    length = 8 + int.from_bytes(left[4:8], "little")
    while len(left) < length:
        more = stream.read(PIECE)
        if not more:
            raise ValueError(f"{where}: a skippable frame ends early")
        length, left = length - len(left), more
    return left[length:]


def _parsed(frame: bytes, where: str, payloads: bool) -> dict:
    """The one record of a frame, its headers, lengths and digests checked."""

    def must(good, what: str) -> None:
        if not good:
            raise ValueError(f"{where}: {what}")

    head, parted, rest = frame.partition(b"\r\n\r\n")
    must(parted, "no end of the headers")
    version, *lines = head.split(b"\r\n")
    must(version == VERSION, f"version {version[:20]!r}")
    headers = {}
    for line in lines:
        name, colon, value = line.decode().partition(":")
        must(colon and name.lower() not in headers, f"header {line[:60]!r}")
        headers[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        must(name in headers, f"no {name}")
    kind = headers["warc-type"]
    must(kind in ("response", "revisit"), f"record type {kind!r}")
    must(headers["content-length"].isdigit(), "length is no number")
    length = int(headers["content-length"])
    must(len(rest) == length + 4 and rest.endswith(b"\r\n\r\n"), "length of the block")
    block = rest[:length]
    if "warc-block-digest" in headers:
        must(headers["warc-block-digest"] == f"sha1:{hashlib.sha1(block).hexdigest()}", "digest of the block")
    http, parted, payload = block.partition(b"\r\n\r\n")
    told = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
    must(parted and told, "no HTTP headers")
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        must(len(payload) == int(told[1]), "length of the payload")
        must(hashlib.sha1(payload).hexdigest() == digest, "digest of the payload")
    else:
        must(not payload and "warc-refers-to" in headers, "a revisit refers to its payload")
    return {
        "record_id": headers["warc-record-id"],
        "record_type": kind,
        "target_uri": headers.get("warc-target-uri"),
        "refers_to": headers.get("warc-refers-to"),
        "payload_bytes": int(told[1]),
        "payload_digest": digest,
        "payload": payload if payloads and kind == "response" else None,
    }


_SCHEMA = pa.schema(
    [(name, {"long": pa.int64(), "binary": pa.binary()}.get(kind, pa.string())) for name, kind in (x.split() for x in RECORD.split(", "))]
)


def spread(manifest: DataFrame) -> DataFrame:
    """The archives of a manifest dealt to as many tasks as there are archives, up to the number of shuffle
    partitions. Their rows are tiny: left to itself, Spark would give all archives to one task."""
    most = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(max(1, min(manifest.count(), most)))


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives named in `path`, which `spread` deals to tasks. Raises on a record
    that breaks the format."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                filesystem, name = pyarrow.fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with filesystem.open_input_stream(name, compression=None) as stream:
                    for frame in _frames(stream, path):
                        rows.append(_parsed(frame, path, payloads))
                        held += 200 + len(rows[-1]["payload"] or b"")
                        if held >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    return archives.select("path").mapInArrow(read, RECORD)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read their records back: page_id,
    payload_bytes, payload_digest, record_type, refers_to, target_uri. An empty table gives no rows."""
    written = write_archives(with_revisits(pages), shared_folder(spark, "warc"))
    page = lambda name: F.regexp_extract(name, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return read_archives(spread(written), payloads=False).select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
        "target_uri",
    )


SQL = f"""
WITH p AS (
    SELECT page_id, url, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages
), h AS (
    SELECT *, max(page_id) OVER (PARTITION BY html) AS holder FROM p
)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n >= {MIN_REVISIT_BYTES} AND page_id IS DISTINCT FROM holder THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {MIN_REVISIT_BYTES} AND page_id IS DISTINCT FROM holder THEN holder END AS refers_to,
       url AS target_uri
FROM h
"""
