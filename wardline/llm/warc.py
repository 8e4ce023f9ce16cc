"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding some whole
records, closed by a seek table (a skippable frame that lists the size of
every frame, compressed and not), so any Zstandard reader can read it from
start to end and a reader with the table can jump to a frame.  An index maps
each record to its bundle, its frame and its offset inside the decompressed
frame: one record costs one frame, not one bundle.

Writing streams: a task holds one frame and passes a bundle on when it is
full.  A bundle belongs to one task attempt (its name is new each time); the
index names the bundles of attempts that succeeded, so what a lost executor
left behind is never read.

Equal payloads are stored once: the record with the smallest id is a
``response``, the others are ``revisit`` records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.tables import filesystem, pylist_batches, read, shared_path, shuffle_partitions, written

# Fixed values of the seekable format and of the archive format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:wardline:page:"

INDEX_SCHEMA = ("page_id long, bundle string, frame int, frame_at long, frame_bytes long, offset long, length long")
RECORD_SCHEMA = ("page_id long, url string, record_type string, refers_to long, payload_digest string, "
                 "payload_bytes long, payload binary")


def record_bytes(page_id, url: str | None, payload: bytes, sha1: bytes, refers_to: int | None,
                 date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC record.  A revisit keeps the HTTP header (with the payload's
    length) and leaves the payload out."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <{ID_PREFIX}{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(record: bytes) -> tuple:
    """(page_id, url, record_type, refers_to, payload_digest, payload_bytes,
    payload) of one record; a stored payload must match its digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC record at this offset")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: ([0-9]+)", http)[1])
    name = fields["WARC-Record-ID"][1 + len(ID_PREFIX):-1]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    refers = fields.get("WARC-Refers-To")
    if fields["WARC-Type"] == "response":
        digest, stored, size = base64.b32encode(hashlib.sha1(body).digest()).decode(), digest, len(body)
        if digest != stored:
            raise ValueError(f"payload of record {name} does not match its digest")
    else:
        body = None
    return (int(name) if name else None, fields.get("WARC-Target-URI"), fields["WARC-Type"],
            int(refers[1 + len(ID_PREFIX):-1]) if refers else None, digest, size, body)


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame for (compressed, decompressed) sizes."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def frame_table(file) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of every frame of an open
    bundle, from its seek table."""
    size = file.size()
    n, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != SEEKABLE_MAGIC or flags:
        raise ValueError("no seek table at the end of the bundle")
    table, at, out = file.read_at(8 * n, size - 9 - 8 * n), 0, []
    for packed, plain in struct.iter_unpack("<II", table):
        out.append((at, packed, plain))
        at += packed
    return out


class BundleWriter:
    """Writes records into bundles under ``root``; ``add`` and ``close`` give
    the index rows of records whose bundle is complete."""

    def __init__(self, root: str, frame_bytes: int, bundle_bytes: int, level: int):
        self.system, self.inside = filesystem(root)
        self.system.create_dir(self.inside, recursive=True)
        self.frame_bytes, self.bundle_bytes = frame_bytes, bundle_bytes
        self.zstd = zstandard.ZstdCompressor(level=level)
        self._start()

    def _start(self) -> None:
        self.name, self.file, self.frames, self.at, self.index = f"{uuid.uuid4().hex}.warc.zst", None, [], 0, []
        self.buffer, self.held, self.size = [], [], 0

    def _frame(self) -> None:
        if not self.held:
            return
        if self.file is None:
            self.file = self.system.open_output_stream(f"{self.inside}/{self.name}", compression=None)
        packed = self.zstd.compress(b"".join(self.buffer))
        self.file.write(packed)
        for page_id, offset, length in self.held:
            self.index.append((page_id, self.name, len(self.frames), self.at, len(packed), offset, length))
        self.frames.append((len(packed), self.size))
        self.at += len(packed)
        self.buffer, self.held, self.size = [], [], 0

    def add(self, page_id, record: bytes) -> list[tuple]:
        self.held.append((page_id, self.size, len(record)))
        self.buffer.append(record)
        self.size += len(record)
        if self.size >= self.frame_bytes:
            self._frame()
        return self.close() if self.at >= self.bundle_bytes else []

    def close(self) -> list[tuple]:
        self._frame()
        if self.file is None:
            return []
        self.file.write(seek_table(self.frames))
        self.file.close()
        done = self.index
        self._start()
        return done


def marked(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, sha1`` (hexadecimal) and ``refers_to``: null for
    a response.

    Only the digests that occur more than once are gathered; they go back to
    the pages by a join that AQE broadcasts or splits.  Payloads under
    ``least_bytes`` are all responses.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"), F.sha1(html.cast("binary")).alias("sha1"))
    firsts = rows.where(F.octet_length("html") >= least_bytes).groupBy("sha1") \
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")) \
        .where("n > 1 and first is not null").select("sha1", "first")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("first")), F.lit(None).cast("long")).otherwise(F.col("first"))
    return rows.join(written(firsts, "warc-equal"), "sha1", "left").select("page_id", "url", "html", "sha1",
                                                                           refers.alias("refers_to"))


def write(pages: DataFrame, root: str, least_bytes: int = 0, frame_bytes: int = 1 << 20,
          bundle_bytes: int = 64 << 20, level: int = 3) -> DataFrame:
    """Archive every row of ``pages`` (page_id, url, html) under ``root`` and
    return the written index (kept in ``root``/index).

    A null html is an empty payload; a null url leaves the header out; rows
    without an id are archived under an empty id and never referred to;
    repeated rows are each archived; an empty table gives an empty index.
    """
    def run(batches):
        names = ["page_id", "bundle", "frame", "frame_at", "frame_bytes", "offset", "length"]
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

        def rows(index):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*index), kinds)], names)
        writer = BundleWriter(f"{root}/bundles", frame_bytes, bundle_bytes, level)
        for batch in batches:
            for part in pylist_batches(batch, "html"):
                for page_id, url, html, sha1, refers in zip(*(c.to_pylist() for c in part.columns)):
                    payload = html.encode("utf-8", "surrogatepass")
                    record = record_bytes(page_id, url, payload, bytes.fromhex(sha1), refers)
                    if index := writer.add(page_id, record):
                        yield rows(index)
        if index := writer.close():
            yield rows(index)

    spark = pages.sparkSession
    marked(pages, least_bytes).mapInArrow(run, INDEX_SCHEMA).write.parquet(f"{root}/index")
    return spark.read.parquet(f"{root}/index")


def records(index: DataFrame, root: str, with_payload: bool = True) -> DataFrame:
    """Read the records of ``index`` back: one frame is fetched for the
    records it holds, each cut out at its offset and parsed."""
    def run(batches):
        system, inside = filesystem(f"{root}/bundles")
        zstd = zstandard.ZstdDecompressor()
        at, file, name, plain, table = None, None, None, b"", []
        for batch in batches:
            out, size = [], 0
            for _, bundle, frame, _, _, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if bundle != name:
                    file, name = system.open_input_file(f"{inside}/{bundle}"), bundle
                    table = frame_table(file)
                if (bundle, frame) != at:
                    start, packed, whole = table[frame]
                    plain, at = zstd.decompress(file.read_at(packed, start), max_output_size=whole), (bundle, frame)
                row = parsed(plain[offset:offset + length])
                out.append(row if with_payload else row[:-1])
                size += length if with_payload else 0
                if size > 16 << 20:
                    yield rows(out)
                    out, size = [], 0
            if out:
                yield rows(out)

    schema = RECORD_SCHEMA if with_payload else RECORD_SCHEMA.rpartition(",")[0]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in schema.split(", ")]

    def rows(out):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
    n = shuffle_partitions(index.sparkSession)
    return index.repartition(n, "bundle", "frame").sortWithinPartitions("bundle", "frame", "offset").mapInArrow(run, schema)


def fetch(root: str, entry) -> tuple:
    """One record by its index row, without Spark: reads one frame."""
    system, inside = filesystem(f"{root}/bundles")
    file = system.open_input_file(f"{inside}/{entry['bundle']}")
    packed = file.read_at(entry["frame_bytes"], entry["frame_at"])
    plain = zstandard.ZstdDecompressor().decompress(packed)
    return parsed(plain[entry["offset"]:entry["offset"] + entry["length"]])


def round_trip(spark, sf_dir: str) -> DataFrame:
    """Archive the table ``pages`` in the shared folder and read it back."""
    root = shared_path(spark, "warc")
    index = write(read(spark, sf_dir, "pages"), root)
    return records(index, root, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
