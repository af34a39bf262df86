"""Deterministic sharded WARC writer and reader.

``write`` turns rows ``(key, uri, payload)`` into gzip members, one per record:

1. Digests and sizes are computed from the payload column alone; of equal payloads of at least ``least`` bytes the smallest key is
   the response, the others become revisits of it.  This is an aggregation and a join of narrow rows: one digest may own most rows.
2. Shards are ranges of the key, cut where the bytes of fixed-width key ranges add up to ``shard_bytes``; a range of more bytes than a shard is
   split again between its own smallest and largest key, until only single keys are larger.  So outlying keys do not matter, and borders
   depend on the data and parameters only, not on sampling, cluster or retries.
3. The payload is shuffled once, to its shard, with the revisit marks of step 1 as rows that sort just before their record.
   A task streams its sorted rows into files, starts the next file once ``file_bytes`` of compressed data are written,
   and regenerates every header and digest.
4. A file is written under a name of its own attempt and renamed when complete, so a retried or doubled task
   ends in the same bytes under the same name.  Each task returns the manifest rows of its files; the archive is what the
   manifest lists, and the manifest is complete when Spark's own commit marker is there.

``read`` streams the files that the manifest lists and checks sizes and digests against the headers.

Defined cases: null payload is an empty payload; payloads under ``least`` bytes are all responses; of rows equal in key and payload
the first is the response; null keys sort first, their record ids say ``null``, and they refer to nothing;
an empty table gives an empty archive.  Other columns are not looked at.  Keys are whole numbers.

The archive folder may be any that ``pyarrow.fs`` opens (a shared mount, hdfs, s3).
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.shared import bounded_batches
from orderloom.session import materialise

SHARD_BYTES = 64 << 20
FILE_BYTES = 16 << 20
LEAST_REVISIT = 100
#: Fixed-width key ranges whose byte counts decide the shard borders, before the heavy ones are split.
RANGES = 1 << 14
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard bigint, file string, records bigint, bytes bigint, sha256 string, first_key bigint, last_key bigint"
RECORD = (
    "file string, key bigint, uri string, record_type string, payload_bytes bigint, payload_digest string, "
    "refers_to bigint, payload binary"
)


def opened(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder; plain paths are local mounts, ``s3a`` is ``s3``."""
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def revisits(records: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``(key, digest, refers_to)`` of the keys that revisit a smaller key's payload; ``records`` has key, digest, size."""
    long = records.filter((F.col("size") >= least) & F.col("key").isNotNull()).select("key", "digest")
    first = long.groupBy("digest").agg(F.min("key").alias("refers_to"), F.max("key").alias("most"))
    first = first.filter(F.col("most") > F.col("refers_to")).select("digest", "refers_to")
    return long.join(first, "digest").filter(F.col("key") > F.col("refers_to")).distinct().select("key", "digest", "refers_to")


#: Names of ranges sort as their keys do: a number of so many digits per level.
DIGITS = 6


class Ranges:
    """Key ranges by name: fixed-width ones, and below them the pieces of the heavy ones, level by level."""

    def __init__(self, low: int, width: int):
        self.low, self.width = low, width
        self.levels: list[DataFrame] = []  # (range, range_low, range_width) of the ranges that are split on this level

    def name(self, rows: DataFrame) -> DataFrame:
        """Adds ``range``; null keys have the first one."""
        number = F.coalesce(F.floor((F.col("key") - self.low) / self.width) + 1, F.lit(0))
        rows = rows.withColumn("range", F.lpad(number.cast("string"), DIGITS, "0"))
        for split in self.levels:
            piece = F.floor((F.col("key") - F.col("range_low")) / F.col("range_width")).cast("string")
            name = F.concat_ws(".", "range", F.lpad(piece, DIGITS, "0"))  # the name itself where nothing is split
            rows = rows.join(split, "range", "left").withColumn("range", name).drop("range_low", "range_width")
        return rows


def shard_borders(records: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[Ranges, DataFrame]:
    """Ranges of at most ``shard_bytes`` (or of one key), and a written table ``(range, shard)``: a row for each range that has keys.

    Its size follows the number of shards, which is also the number of the writer's tasks; Spark broadcasts it if it may.
    """
    ends = records.agg(F.min("key").alias("low"), F.max("key").alias("high")).first()
    low, high = ends["low"] or 0, ends["high"] or 0
    ranges = Ranges(low, max(1, -(-(high - low + 1) // RANGES)))
    measures = [F.sum(F.col("size") + 512).alias("bytes"), F.min("key").alias("from"), F.max("key").alias("to")]
    while True:
        sized = materialise(ranges.name(records).groupBy("range").agg(*measures), "warc-ranges")
        pieces = F.least(F.lit(RANGES), F.ceil(F.col("bytes") / shard_bytes) * 4)
        width = F.ceil((F.col("to") - F.col("from") + 1) / pieces).cast("bigint").alias("range_width")
        heavy = sized.filter((F.col("bytes") > shard_bytes) & (F.col("from") < F.col("to")))
        if heavy.isEmpty():
            break
        ranges.levels.append(materialise(heavy.select("range", F.col("from").alias("range_low"), width), "warc-split"))
    # Bytes before a range: before its first-level range (at most RANGES + 1 of them), and within that.
    ahead = lambda w: F.coalesce(F.sum("bytes").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sized = sized.withColumn("top", F.substring("range", 1, DIGITS))
    tops = sized.groupBy("top").agg(F.sum("bytes").alias("bytes")).select("top", ahead(Window.orderBy("top")).alias("before"))
    placed = sized.withColumn("within", ahead(Window.partitionBy("top").orderBy("range"))).join(F.broadcast(tops), "top")
    shard = F.floor((F.col("before") + F.col("within")) / shard_bytes).cast("bigint")
    return ranges, materialise(placed.select("range", shard.alias("shard")), "warc-borders")


def _headers(fields: Iterable[tuple[str, object]]) -> bytes:
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"


def _record(key, uri, payload: bytes, digest: str, refers_to, size: int) -> bytes:
    """One record: a response with its HTTP head and payload, or a revisit with the head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + payload if refers_to is None else head
    name = lambda k: f"<urn:x-record:{'null' if k is None else k}>"
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", name(key)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "".join(c for c in (uri or "urn:x-no-uri") if c not in "\r\n")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("X-Payload-Length", size),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", name(refers_to))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]
    return _headers(fields) + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    """A gzip member without time or name, so equal input gives equal bytes."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _File:
    """An archive file under its attempt's name until ``close`` renames it."""

    def __init__(self, fs: pafs.FileSystem, folder: str, shard: int, part: int):
        self.fs, self.shard, self.name = fs, shard, f"shard-{shard:07d}-{part:05d}.warc.gz"
        self.final, self.temporary = f"{folder}/{self.name}", f"{folder}/_attempt-{uuid.uuid4().hex}-{self.name}"
        self.out, self.sum = fs.open_output_stream(self.temporary, compression=None), hashlib.sha256()
        self.bytes = self.records = 0
        self.first = self.last = None
        body = f"software: orderloom\r\nformat: WARC File Format 1.1\r\nisPartOf: shard {shard}\r\n".encode()
        head = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-file:{self.name}>"), ("WARC-Date", DATE)]
        head += [("WARC-Filename", self.name), ("Content-Type", "application/warc-fields"), ("Content-Length", len(body))]
        self._put(_headers(head) + body + b"\r\n\r\n")

    def _put(self, data: bytes) -> None:
        packed = _member(data)
        self.out.write(packed)
        self.sum.update(packed)
        self.bytes += len(packed)

    def add(self, key, data: bytes) -> None:
        self._put(data)
        self.first = key if not self.records else self.first
        self.last, self.records = key, self.records + 1

    def close(self) -> dict:
        self.out.close()
        self.fs.move(self.temporary, self.final)
        return {
            "shard": self.shard, "file": self.name, "records": self.records, "bytes": self.bytes,
            "sha256": self.sum.hexdigest(), "first_key": self.first, "last_key": self.last,
        }


def write(records: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, least: int = LEAST_REVISIT) -> None:
    """Write ``(key, uri, payload)`` rows, payload text or binary, as an archive into an empty folder."""
    spark = records.sparkSession
    bounded_batches(spark)
    payload = F.col("payload")
    if records.schema["payload"].dataType.simpleString() == "string":
        payload = F.encode(payload, "UTF-8")
    payload = F.coalesce(payload, F.to_binary(F.lit("")))
    key = F.col("key").cast("bigint").alias("key")
    narrow = records.select(key, F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("bigint").alias("size"))
    ranges, borders = shard_borders(narrow, shard_bytes)
    shards = (borders.agg(F.max("shard")).first()[0] or 0) + 1
    rows = records.select(key, F.col("uri").cast("string").alias("uri"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"), F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("refers_to"))
    marks = revisits(narrow, least).select("key", F.lit(None).cast("string").alias("uri"), F.lit(None).cast("binary").alias("payload"), "digest", F.lit(0).alias("kind"), "refers_to")
    dealt = (
        ranges.name(rows.unionByName(marks))
        .join(borders, "range")
        .drop("range")
        .repartitionById(int(shards), F.col("shard").cast("int"))
        .sortWithinPartitions("shard", F.col("key").asc_nulls_first(), "digest", "kind", "uri")
    )

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = opened(folder)
        done, out, part = [], None, 0
        before = mark = None  # the last record's (key, digest), and the mark that precedes a record
        for batch in batches:
            for row in batch.to_pylist():
                same = (row["key"], row["digest"])
                if row["kind"] == 0:
                    mark = (same, row["refers_to"])
                    continue
                size, refers = len(row["payload"]), None
                if mark and mark[0] == same:
                    refers = mark[1]
                elif before == same and size >= least and row["key"] is not None:
                    refers = row["key"]
                before = same
                if out is not None and (out.shard != row["shard"] or out.bytes >= file_bytes):
                    part = part + 1 if out.shard == row["shard"] else 0
                    done.append(out.close())
                    out = None
                out = out or _File(fs, path, row["shard"], part)
                out.add(row["key"], _record(row["key"], row["uri"], row["payload"], row["digest"], refers, size))
        if out is not None:
            done.append(out.close())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=_arrow(MANIFEST))

    fs, path = opened(folder)
    fs.create_dir(path, recursive=True)
    dealt.mapInArrow(put, MANIFEST).write.parquet(f"{folder}/manifest")
    # What failed attempts have left; the manifest is complete, so nobody writes any more.
    for found in fs.get_file_info(pafs.FileSelector(path)):
        if found.base_name.startswith("_attempt-"):
            fs.delete_file(found.path)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(","))])


def _members(stream: io.RawIOBase, piece: int = 1 << 20) -> Iterator[bytes]:
    """The unpacked gzip members of a stream, one at a time."""
    unpacker, parts = zlib.decompressobj(31), []
    data = stream.read(piece)
    while data:
        parts.append(unpacker.decompress(data))
        if unpacker.eof:
            yield b"".join(parts)
            data, unpacker, parts = unpacker.unused_data, zlib.decompressobj(31), []
            data = data or stream.read(piece)
        else:
            data = stream.read(piece)
    if parts and any(parts):
        raise ValueError("the archive ends within a record")


def _parsed(data: bytes, file: str) -> dict | None:
    """A record's columns, checked against its own headers; None for a file's own warcinfo record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    if lines[0] != "WARC/1.1" or len(rest) != int(fields["Content-Length"]) + 4:
        raise ValueError(f"broken record in {file}")
    if fields["WARC-Type"] == "warcinfo":
        return None
    block = rest[:-4]
    if "sha256:" + hashlib.sha256(block).hexdigest() != fields["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {fields['WARC-Record-ID']} in {file} is wrong")
    number = lambda f: None if f is None or "null" in f else int(f.strip("<>").rpartition(":")[2])
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["X-Payload-Length"])
    payload = block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else None
    if payload is not None and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']} in {file} is wrong")
    return {
        "file": file, "key": number(fields["WARC-Record-ID"]), "uri": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"], "payload_bytes": size, "payload_digest": digest,
        "refers_to": number(fields.get("WARC-Refers-To")), "payload": payload,
    }


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of an archive; with ``payloads=False`` they are checked but not returned."""
    schema = _arrow(RECORD)
    files = spark.read.parquet(f"{folder}/manifest")
    count = max(1, files.count())

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = opened(folder)
        for batch in batches:
            for listed in batch.to_pylist():
                rows, held, seen = [], 0, 0
                with fs.open_input_stream(f"{path}/{listed['file']}", compression=None) as stream:
                    for data in _members(stream):
                        row = _parsed(data, listed["file"])
                        if row is None:
                            continue
                        seen += 1
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row["payload"] or b"") + 256
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if seen != listed["records"]:
                    raise ValueError(f"{listed['file']} holds {seen} records, the manifest says {listed['records']}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.repartition(min(count, 10_000), "file").mapInArrow(load, RECORD)


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as an archive into ``folder`` and read back what each record says."""
    write(pages.select(F.col("page_id").alias("key"), F.col("url").alias("uri"), F.col("html").alias("payload")), folder)
    return read(pages.sparkSession, folder, payloads=False).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "file", "uri"
    )
