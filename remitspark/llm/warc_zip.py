"""Web archives packaged as ZIP files: WARC records in a stored member, with an index beside it.

An archive holds ``archive/data.warc.gz``, in which every record is a gzip member of its own,
and ``indexes/index.txt`` with the offset and length of every record. Both are stored, not
deflated, so a record is read by its range in the ZIP file without unpacking anything.

Writing: every task writes one archive through Spark's text writer, so that any file system
and any committer will do and a lost task leaves nothing behind. That writer takes lines of
bytes. The archive is cut into them where it has a line feed anyway; it ends with one, as its
ZIP comment.

Reading: the end record, the ZIP64 end record if there is one, and the central directory are
read from the end of each file; then the index; then the records, some megabytes of adjacent
ones at a time and spread over all tasks whatever the sizes of the archives.

Of records with one payload of ``MIN_REVISIT`` bytes or more, that with the largest id is a
response and the others are revisits of it. Defined results: a null payload is empty; null ids
come before all others and stay null; rows that share an id are records of their own, and if it
is the largest, all of them are responses. An empty table gives no archives and no rows. Other
columns are not read. A member that is not stored, or that the directory does not list, is an
error; so is a payload that doesn't have its digest.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from remitspark.llm.common import arrow_schema, small_batches, stored
from remitspark.tables import lookup

MIN_REVISIT = 1000
RANGE_BYTES = 4 << 20
LINE_BYTES = 1 << 20

#: Names and signatures of the formats.
DATA, INDEX = "archive/data.warc.gz", "indexes/index.txt"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LOCAL, CENTRAL, END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
END64, LOCATOR64, DESCRIPTOR = b"PK\x06\x06", b"PK\x06\x07", b"PK\x07\x08"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def roles(pages: DataFrame, id_col: str, payload_col: str, uri_col: str | None) -> DataFrame:
    """Rows (page_id, uri, payload, digest, payload_bytes, refers_to); refers_to is set for revisits."""
    payload = F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8")
    uri = F.col(uri_col).cast("string") if uri_col else F.lit(None).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), uri.alias("uri"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    large = rows.filter(F.col("payload_bytes") >= MIN_REVISIT).groupBy("digest")
    repeated = large.agg(F.max("page_id").alias("response"), F.count("*").alias("rows")).filter("rows > 1")
    found = lookup(rows, stored(repeated, "repeated"), ["digest"], "rows", _spread())
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    return found.withColumn("refers_to", refers).drop("response")


def _spread() -> Column:
    return F.coalesce(F.col("page_id").cast("string"), F.col("uri"), F.lit(""))


def _record(page_id: str | None, uri: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Target-URI": None if uri is None else " ".join(uri.split()),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Profile": REVISIT if refers_to is not None else None,
        "WARC-Refers-To": None if refers_to is None else f"<urn:page:{refers_to}>",
        # Of the full payload, which a revisit doesn't hold.
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
    }
    if refers_to is None:
        block += payload
    fields["Content-Length"] = str(len(block))
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class ZipWriter:
    """Bytes of a ZIP file with stored members whose sizes are not known beforehand."""

    def __init__(self, zip64: bool = False):
        self.at, self.entries, self.zip64 = 0, [], zip64

    def _out(self, data: bytes) -> bytes:
        self.at += len(data)
        return data

    def begin(self, name: str) -> bytes:
        self.name, self.began, self.size, self.crc = name.encode(), self.at, 0, 0
        # Sizes follow the data (bit 3); the name is UTF-8 (bit 11).
        head = struct.pack("<4s5H3L2H", LOCAL, 45, 0x0808, 0, 0, 33, 0, 0, 0, len(self.name), 0)
        return self._out(head + self.name)

    def data(self, data: bytes) -> bytes:
        self.size += len(data)
        self.crc = zlib.crc32(data, self.crc)
        return self._out(data)

    def end(self) -> bytes:
        self.entries.append((self.name, self.began, self.size, self.crc))
        wide = self.size >= FULL32
        return self._out(struct.pack("<4sL2Q" if wide else "<4s3L", DESCRIPTOR, self.crc, self.size, self.size))

    def close(self, comment: bytes) -> bytes:
        out, start = b"", self.at
        for name, began, size, crc in self.entries:
            extra = b""
            if self.zip64 or size >= FULL32 or began >= FULL32:
                extra = struct.pack("<2H3Q", 1, 24, size, size, began)
                size = began = FULL32
            head = struct.pack("<4s6H3L5H2L", CENTRAL, 45, 45, 0x0808, 0, 0, 33, crc, size, size, len(name), len(extra), 0, 0, 0, 0, began)
            out += head + name + extra
        length, n = len(out), len(self.entries)
        if self.zip64 or start + length >= FULL32 or n >= FULL16:
            out += struct.pack("<4sQ2H2L4Q", END64, 44, 45, 45, 0, 0, n, n, length, start)
            out += struct.pack("<4sLQL", LOCATOR64, 0, start + length, 1)
            n, length, start = FULL16, FULL32, FULL32
        out += struct.pack("<4s4H2LH", END, 0, 0, n, n, length, start, len(comment)) + comment
        return self._out(out)


def _lines(parts: Iterable[bytes]) -> Iterator[bytes]:
    """The bytes in lines without their last line feed, cut where there is one in the bytes."""
    held = bytearray()
    for part in parts:
        held += part
        if len(held) >= LINE_BYTES and (cut := held.rfind(b"\n")) >= 0:
            yield bytes(held[:cut])
            del held[: cut + 1]
    if held:
        yield bytes(held[:-1])  # the archive's comment is a line feed


def write_archives(rows: DataFrame, folder: str, zip64: bool = False) -> None:
    """One archive per partition of rows of :func:`roles`."""

    def archive(batches: Iterable[pa.RecordBatch]) -> Iterator[bytes]:
        writer, index = ZipWriter(zip64), []
        for batch in small_batches(batches, 64):
            if not writer.at:
                yield writer.begin(DATA)
            for row in batch.to_pylist():
                packed = _gzip(_record(row["page_id"], row["uri"], row["payload"], row["digest"], row["refers_to"]))
                index.append(f"{writer.size} {len(packed)}\n")
                yield writer.data(packed)
        if writer.at:
            yield writer.end()
            yield writer.begin(INDEX)
            yield writer.data("".join(index).encode())
            yield writer.end()
            yield writer.close(b"\n")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for line in _lines(archive(batches)):
            yield pa.RecordBatch.from_arrays([pa.array([line], pa.binary())], names=["value"])

    as_text = [F.col(c).cast("string").alias(c) for c in ("page_id", "refers_to")]
    lines = rows.select("uri", "payload", "digest", *as_text).mapInArrow(write, "value binary")
    lines.select(F.col("value").cast("string")).write.text(folder)


def _open(path: str) -> pa.NativeFile:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    system, name = pyarrow.fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return system.open_input_file(name)


def directory(file: pa.NativeFile) -> dict[str, tuple[int, int]]:
    """Where the data of each stored member begins in a ZIP file, and its size."""
    size = file.size()
    tail_at = max(0, size - 22 - FULL16)
    tail = file.read_at(size - tail_at, tail_at)
    at = tail.rfind(END)
    while at >= 0 and (len(tail) < at + 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end record: not a ZIP file")
    count, length, start = struct.unpack_from("<10xHLL", tail, at)
    if FULL16 == count or FULL32 in (length, start):
        signature, end64 = struct.unpack("<4s4xQ4x", file.read_at(20, tail_at + at - 20))
        if signature == LOCATOR64:
            count, length, start = struct.unpack("<32xQQQ", file.read_at(56, end64))
    central, members, at = file.read_at(length, start), {}, 0
    for _ in range(count):
        signature, method, packed, full, name_len, extra_len, note_len, began = struct.unpack_from("<4s6xH8xLLHHH8xL", central, at)
        if signature != CENTRAL:
            raise ValueError("the central directory is broken")
        name = central[at + 46 : at + 46 + name_len].decode()
        extra = central[at + 46 + name_len : at + 46 + name_len + extra_len]
        if FULL32 in (packed, full, began):
            full, packed, began = _wide(extra, full, packed, began)
        if method or packed != full:
            raise ValueError(f"{name} is not stored")
        name_here, extra_here = struct.unpack("<26xHH", file.read_at(30, began))
        members[name] = (began + 30 + name_here + extra_here, full)
        at += 46 + name_len + extra_len + note_len
    return members


def _wide(extra: bytes, *values: int) -> list[int]:
    """The values, those that are full replaced from the ZIP64 extra field, in order."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            return [next(wide) if value == FULL32 else value for value in values]
        at += 4 + length
    return list(values)


def _ranges(paths: DataFrame) -> DataFrame:
    """Rows (path, start, bounds): adjacent records of an archive, by their offsets from start."""
    schema = "path string, start long, bounds array<long>"

    def locate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with _open(path) as file:
                    members = directory(file)
                    data_at, _ = members[DATA]
                    index_at, index_len = members[INDEX]
                    index = np.array(file.read_at(index_len, index_at).split(), dtype=np.int64).reshape(-1, 2)
                ends = index.sum(axis=1)
                if (index[1:, 0] != ends[:-1]).any():
                    raise ValueError(f"{path}: the index has gaps")
                piece = index[:, 0] // RANGE_BYTES
                heads = np.append(np.flatnonzero(np.append(True, piece[1:] != piece[:-1])), len(index))
                for a, b in pairwise(heads.tolist()):
                    bounds = np.append(index[a:b, 0], ends[b - 1]) - index[a, 0]
                    row = [pa.array([path]), pa.array([data_at + index[a, 0]]), pa.array([bounds], pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(row, names=["path", "start", "bounds"])

    return paths.mapInArrow(locate, schema)


def _parsed(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"not a record: {version[:20]}")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    name = lambda field: fields[field][len("<urn:page:") : -1] if field in fields else None
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    if payload is not None and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not have its digest")
    length = len(payload) if payload is not None else int(fields["X-Payload-Length"])
    return {
        "page_id": name("WARC-Record-ID") or None, "uri": fields.get("WARC-Target-URI"), "record_type": kind, "payload_digest": digest,
        "payload_bytes": length, "refers_to": name("WARC-Refers-To"), "payload": payload,
    }


_TEXT = ("page_id", "uri", "record_type", "payload_digest", "refers_to")
RECORD = T.StructType(
    [T.StructField(name, T.StringType()) for name in _TEXT]
    + [T.StructField("payload_bytes", T.LongType()), T.StructField("payload", T.BinaryType())]
)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives in a folder; the payload is null for revisits."""
    files = spark.read.format("binaryFile").load(folder).filter("length > 0").select("path")
    ranges = stored(_ranges(files), "ranges")
    arrow = arrow_schema(RECORD)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            row = batch.to_pylist()[0]
            with _open(row["path"]) as file:
                data = file.read_at(row["bounds"][-1], row["start"])
            records = [_parsed(zlib.decompress(data[a:b], 31)) for a, b in pairwise(row["bounds"])]
            yield from small_batches([pa.RecordBatch.from_pylist(records, schema=arrow)], 256)

    parts = max(1, ranges.count())
    return ranges.repartition(min(parts, 8 * spark.sparkContext.defaultParallelism + parts // 8)).mapInArrow(read, RECORD)


#: What reading the archives of the pages gives.
ORACLE = f"""
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), digests AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM payloads
), largest AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS response FROM digests
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
    CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN revisit THEN response END AS refers_to
FROM (SELECT *, payload_bytes >= {MIN_REVISIT} AND page_id IS DISTINCT FROM response AS revisit FROM largest)
"""
