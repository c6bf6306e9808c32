"""WARC archives as seekable Zstandard: independent frames, a footer seek table, and a record index."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .common import save

#: Fixed values of the seekable Zstandard format and of the WARC standard.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "page_id long, record_id string, archive string, frame long, frame_at long, frame_bytes long, at long, bytes long"
RECORDS = "page_id long, record_type string, refers_to long, url string, payload_bytes long, payload_digest string, payload binary"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class SeekableWriter:
    """Groups records into Zstandard frames of about ``frame_bytes`` and ends the file with a seek table."""

    def __init__(self, out, frame_bytes: int, level: int):
        self.out, self.frame_bytes, self.zstd = out, frame_bytes, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames, self.pending, self.size, self.written = [], [], 0, 0
        self.waiting, self.index = [], []

    def add(self, key, record: bytes) -> None:
        if self.size and self.size + len(record) > self.frame_bytes:
            self.flush()
        self.waiting.append((key, len(self.frames), self.size, len(record)))
        self.pending.append(record)
        self.size += len(record)

    def flush(self) -> None:
        if not self.pending:
            return
        packed = self.zstd.compress(b"".join(self.pending))
        self.index += [(key, frame, self.written, len(packed), at, n) for key, frame, at, n in self.waiting]
        self.out.write(packed)
        self.frames.append((len(packed), self.size))
        self.written += len(packed)
        self.pending, self.waiting, self.size = [], [], 0

    def close(self) -> list:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()
        return self.index


def seek_table(file) -> list[tuple[int, int, int]]:
    """(offset, compressed bytes, bytes) of each frame, from the footer of an open random-access file."""
    end = file.size()
    n, flags, magic = struct.unpack("<IBI", file.read_at(9, end - 9))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the file")
    width = 12 if flags & 0x80 else 8
    raw, out, at = file.read_at(n * width, end - 9 - n * width), [], 0
    for i in range(n):
        packed, size = struct.unpack_from("<II", raw, i * width)
        out.append((at, packed, size))
        at += packed
    return out


def _record(kind: str, page_id, url, digest: str, refers_to, payload: bytes, record_id: str, refers_id, date: str) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if kind == "response" else http
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": date,
            "WARC-Target-URI": "".join(c if c > " " else f"%{ord(c):02X}" for c in url) if url else f"urn:page:{page_id}",
            "WARC-Payload-Digest": f"sha1:{digest}"}
    if page_id is not None:
        head["X-Page-ID"] = str(page_id)
    if kind == "revisit":
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<{refers_id}>"}
        if refers_to is not None:
            head["X-Refers-To-Page-ID"] = str(refers_to)
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict, bytes, int]:
    """(headers, block, end) of the record that begins at ``at``."""
    split = data.index(b"\r\n\r\n", at)
    lines = data[at:split].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record at {at}")
    head = dict(line.split(": ", 1) for line in lines[1:])
    end = split + 4 + int(head["Content-Length"])
    return head, data[split + 4:end], end + 4


def _record_id(page_id, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id} {digest}')}"


def write_warc(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0, frame_bytes: int = 1 << 20,
               archive_bytes: int = 256 << 20, level: int = 3, date: str = "1970-01-01T00:00:00Z",
               id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record per row of ``pages`` into archives under ``folder``; return their index (INDEX).

    The payload is the html in UTF-8, empty for null.  Among equal payloads of at least
    ``min_revisit_bytes`` bytes, the smallest page id is a response and all others revisit it; shorter ones
    are responses.  Rows repeated with the smallest id are responses too.  A null id is smallest only among
    null ids.  A null url becomes ``urn:page:<id>``.  An empty table writes nothing; other columns are ignored.

    A task streams its rows into archives of about ``archive_bytes`` (payload), named once per attempt: only
    the archives in the returned index are part of the result, so a repeated attempt does no harm.
    """
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "warc")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("html", 256)))
    first = rows.where(F.octet_length("html") >= min_revisit_bytes).groupBy("digest").agg(F.min("page_id").alias("first_id"))
    rows = rows.join(first.withColumn("known", F.lit(True)), "digest", "left").select(
        "page_id", "url", "html", "first_id",
        (F.col("known") & ~F.col("page_id").eqNullSafe(F.col("first_id"))).alias("again"))

    def run(batches):
        fs, root = pafs.FileSystem.from_uri(folder)
        writer = name = None
        size = 0

        def done():
            entries = writer.close()
            cols = list(zip(*[(k[0], k[1], name, *rest) for k, *rest in entries]))
            kinds = [pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 5]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=[f.split()[0] for f in INDEX.split(", ")])

        for batch in batches:
            for page_id, url, html, first_id, again in zip(*(batch.column(i) for i in range(5))):
                if writer is None:
                    fs.create_dir(root, recursive=True)
                    name, size = f"{uuid.uuid4().hex}.warc.zst", 0
                    writer = SeekableWriter(fs.open_output_stream(f"{root}/{name}", compression=None), frame_bytes, level)
                payload, page_id, first_id = html.as_buffer().to_pybytes(), page_id.as_py(), first_id.as_py()
                digest = sha1_base32(payload)
                record_id = _record_id(page_id, digest)
                kind = "revisit" if again.as_py() else "response"
                writer.add((page_id, record_id), _record(kind, page_id, url.as_py(), digest, first_id, payload, record_id, _record_id(first_id, digest), date))
                size += len(payload)
                if size >= archive_bytes:
                    yield done()
                    writer = None
        if writer is not None:
            yield done()

    index = save(rows.mapInArrow(run, INDEX), "warc-index")
    return index.withColumn("archive", F.concat(F.lit(folder + "/"), "archive"))


def _row(head: dict, block: bytes) -> tuple:
    kind, (http, _, payload) = head["WARC-Type"], block.partition(b"\r\n\r\n")
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
    if kind == "response" and (size != len(payload) or sha1_base32(payload) != digest):
        raise ValueError(f"damaged payload in {head['WARC-Record-ID']}")
    number = lambda k: int(head[k]) if k in head else None
    return (number("X-Page-ID"), kind, number("X-Refers-To-Page-ID"), head["WARC-Target-URI"], size, digest, payload if kind == "response" else None)


def _batches(rows):
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    pending, size = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*pending), kinds)], names=[f.split()[0] for f in RECORDS.split(", ")])

    for r in rows:
        pending.append(r)
        size += len(r[-1] or b"")
        if size > 4 << 20:
            yield batch()
            pending, size = [], 0
    if pending:
        yield batch()


def read_warc(archives: DataFrame, frames_per_task: int = 32, with_payload: bool = True) -> DataFrame:
    """All records (RECORDS) of the files in column ``archive``, by their seek tables.

    Each archive's frames are dealt out in groups; a task seeks to each of its frames and holds one at a
    time.  Payload digests are checked.  Revisits have a null payload and the size of the full one.  Null
    or repeated archives are read once or not at all.
    """
    spark = archives.sparkSession
    files = archives.select("archive").where("archive is not null").distinct()

    def groups(batches):
        for b in batches:
            for name in b.column(0).to_pylist():
                fs, path = pafs.FileSystem.from_uri(name)
                with fs.open_input_file(path) as f:
                    n = len(seek_table(f))
                at = list(range(0, n, frames_per_task))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64())], names=["archive", "frame"])

    def rows_of(name, frame):
        fs, path = pafs.FileSystem.from_uri(name)
        with fs.open_input_file(path) as f:
            for at, packed, size in seek_table(f)[frame:frame + frames_per_task]:
                data, here = zstandard.ZstdDecompressor().decompress(f.read_at(packed, at), max_output_size=size), 0
                while here < len(data):
                    head, block, here = parse_record(data, here)
                    row = _row(head, block)
                    yield row if with_payload else (*row[:-1], None)

    def read(batches):
        for b in batches:
            for name, frame in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield from _batches(rows_of(name, frame))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.mapInArrow(groups, "archive string, frame long").repartition(parts).mapInArrow(read, RECORDS)


def fetch(index: DataFrame) -> DataFrame:
    """The records (RECORDS) of some rows of a :func:`write_warc` index, each by one seek into its frame."""

    def rows_of(b):
        for name, at, packed, inside, n in zip(*(b.column(i).to_pylist() for i in range(5))):
            fs, path = pafs.FileSystem.from_uri(name)
            with fs.open_input_file(path) as f:
                data = zstandard.ZstdDecompressor().decompress(f.read_at(packed, at))
            head, block, _ = parse_record(data[inside:inside + n])
            yield _row(head, block)

    def run(batches):
        for b in batches:
            yield from _batches(rows_of(b))

    return index.select("archive", "frame_at", "frame_bytes", "at", "bytes").mapInArrow(run, RECORDS)


def round_trip(spark: SparkSession, pages: DataFrame, **kw) -> DataFrame:
    """Write ``pages`` and read every archive back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    index = write_warc(pages, **kw)
    return read_warc(index, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
