"""Web archives as seekable Zstandard bundles.

Records are WARC 1.1, grouped into independent Zstandard frames; a bundle ends in a seek table (a skippable frame that
lists every frame's sizes), so that a reader finds any frame from the file's end. The index maps a record's identifier to
its bundle, its frame and its offset inside the frame. Payloads that repeat are stored once: the others are `revisit`
records that refer to it.

Tasks write bundles of a name of their own and return index rows; the index is stored by Spark, so it lists only what
finished attempts wrote. A bundle of a lost or repeated attempt is in no index and is never read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.sizing import cut_lineage, scanned_bytes, shared_folder

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 128 << 20
#: Payloads shorter than this are stored each time they occur.
REVISIT_BYTES = 1000
#: A group of at least this share of all large payloads is hot; there are at most as many hot groups.
HOT_SHARE = 1024
CAPTURE_DATE = "1970-01-01T00:00:00Z"

# Fixed values of the seekable format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = ("record_id string, page_id long, refers_to long, refers_to_record string, payload_digest string, bundle string, "
         "frame int, frame_start long, frame_bytes long, offset long, length long")
RECORDS = ("record_id string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
           "refers_to long, payload binary")


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame: compressed and plain size of each frame, their number, and the format's magic."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(source, size: int) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of every frame, from the end of an open file of `size` bytes."""
    source.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE or flags:
        raise ValueError("the file does not end in a seek table without checksums")
    source.seek(size - 9 - 8 * count)
    frames, start = [], 0
    for packed, plain in struct.iter_unpack("<II", source.read(8 * count)):
        frames.append((start, packed, plain))
        start += packed
    return frames


def record_id(page_id: int | None, digest: str) -> str:
    """The same page and payload have the same identifier, so a revisit can name a record of another bundle."""
    return f"urn:uuid:{uuid.UUID(bytes=hashlib.sha1(f'{page_id}/{digest}'.encode()).digest()[:16], version=5)}"


def _header_value(text: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit holds the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_id(page_id, digest)}>",
        f"WARC-Date: {CAPTURE_DATE}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{record_id(refers_to, digest)}>", f"X-Refers-To-Page: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict, int]:
    """The record at an offset of a plain frame as a row of RECORDS, and the offset behind it. Digests are verified."""
    end = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:end].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no record at this offset")
    head = {name.lower(): value for name, value in (line.split(": ", 1) for line in lines)}
    start, length = end + 4, int(head["content-length"])
    body = data.index(b"\r\n\r\n", start) + 4
    http = dict(line.split(": ", 1) for line in data[start:body - 4].decode().split("\r\n")[1:])
    digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
    revisit = head["warc-type"] == "revisit"
    payload = None if revisit else data[body:start + length]
    if payload is not None and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(http["Content-Length"])):
        raise ValueError(f"{head['warc-record-id']}: payload and digest differ")
    page, target = head.get("x-page-id"), head.get("x-refers-to-page")
    return {
        "record_id": head["warc-record-id"].strip("<>"), "page_id": None if page is None else int(page),
        "url": head.get("warc-target-uri"), "record_type": head["warc-type"], "payload_bytes": int(http["Content-Length"]),
        "payload_digest": digest, "refers_to": None if target is None else int(target), "payload": payload,
    }, start + length + 4


class _Bundles:
    """Writes records into frames and frames into bundles; returns index rows of what was written."""

    def __init__(self, folder: str):
        self.folder, self.pack = folder, zstandard.ZstdCompressor(level=3)
        self.out = self.name = None
        self.rows: list[dict] = []
        self._empty_frame()

    def _empty_frame(self) -> None:
        self.parts, self.held, self.waiting = [], 0, []

    def add(self, record: bytes, row: dict) -> None:
        self.waiting.append({**row, "offset": self.held, "length": len(record)})
        self.parts.append(record)
        self.held += len(record)
        if self.held >= FRAME_BYTES:
            self.end_frame()

    def end_frame(self) -> None:
        if not self.parts:
            return
        if self.out is None:
            self.name = f"{self.folder}/{uuid.uuid4().hex}.warc.zst"
            store, path = _store(self.name)
            store.create_dir(path.rsplit("/", 1)[0], recursive=True)
            self.out, self.start, self.frames, self.plain = store.open_output_stream(path, compression=None), 0, [], 0
        packed = self.pack.compress(b"".join(self.parts))
        self.out.write(packed)
        place = {"bundle": self.name, "frame": len(self.frames), "frame_start": self.start, "frame_bytes": len(packed)}
        self.rows += [row | place for row in self.waiting]
        self.frames.append((len(packed), self.held))
        self.start, self.plain = self.start + len(packed), self.plain + self.held
        self._empty_frame()
        if self.plain >= BUNDLE_BYTES:
            self.end_bundle()

    def end_bundle(self) -> None:
        self.end_frame()
        if self.out is not None:
            self.out.write(seek_table(self.frames))
            self.out.close()
            self.out = None

    def taken(self) -> list[dict]:
        rows, self.rows = self.rows, []
        return rows


def with_first_copies(pages: DataFrame, min_bytes: int = REVISIT_BYTES, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Payload, its digest, and for payloads that repeat the largest page_id that holds them (`_first`).

    Only digests are grouped, pre-aggregated. The groups with more than one row are stored; if they are small they are
    broadcast and no payload moves. Otherwise hot groups, of which there are HOT_SHARE at most, are broadcast and the rest
    is joined by digest; rows that belong to no such group get a key of their own, so no key of that join is hot.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"payload_digest": F.sha1("payload"), "_large": F.octet_length("payload") >= min_bytes})
    groups = cut_lineage(keyed.where("_large").groupBy("payload_digest").agg(
        F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    if scanned_bytes(groups) <= broadcast_bytes and groups.count() <= 1_000_000:
        joined = keyed.join(F.broadcast(groups.drop("_n")), "payload_digest", "left")
        return joined.withColumn("_first", F.when(F.col("_large"), F.col("_first")))
    total = groups.agg(F.sum("_n")).scalar()
    is_hot = F.col("_n") * HOT_SHARE >= total
    hot = groups.where(is_hot).select("payload_digest", F.col("_first").alias("_hot"))
    rest = groups.where(~is_hot).select(F.col("payload_digest").alias("_key"), "_first")
    marked = keyed.join(F.broadcast(hot), "payload_digest", "left")
    alone = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))
    marked = marked.withColumn("_key", F.when(F.col("_large") & F.col("_hot").isNull(), F.col("payload_digest")).otherwise(alone))
    joined = marked.join(rest, "_key", "left").withColumn("_first", F.coalesce("_first", F.when(F.col("_large"), F.col("_hot"))))
    return joined.drop("_key", "_hot")


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write one record per row of `pages` (page_id, url, html) below `folder` and return the stored index.

    Of rows with equal payloads of at least `min_bytes` bytes the one with the largest page_id is the response and the
    others are revisits of it. Shorter payloads are responses. A null html is an empty payload; a null url leaves its header
    out; control characters and blanks in a url are written in percent form. Rows without page_id refer to a row that has
    one; if none has, all are responses. Rows that repeat both the largest page_id and its payload are all responses, of
    the same record identifier. Other columns are ignored. An empty table writes no bundle and gives an empty index.
    """
    folder = folder or f"{shared_folder(pages.sparkSession)}/archive-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundles, schema = _Bundles(folder), None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(bundles.taken(), schema)

        schema = pa.schema([(n, pa.int64() if t == "long" else pa.int32() if t == "int" else pa.string())
                            for n, t in (c.split() for c in INDEX.split(", "))])
        for batch in batches:
            for i in range(batch.num_rows):
                page, url, payload, digest, first = (batch.column(c)[i].as_py() for c in
                                                     ("page_id", "url", "payload", "payload_digest", "_first"))
                revisit = first is not None and first != page
                target = first if revisit else None
                bundles.add(build_record(page, url, payload, digest, target, revisit), {
                    "record_id": record_id(page, digest), "page_id": page, "refers_to": target, "payload_digest": digest,
                    "refers_to_record": record_id(target, digest) if revisit else None})
            yield out()
        bundles.end_bundle()
        yield out()

    rows = with_first_copies(pages, min_bytes).select(
        F.col("page_id").cast("long"), "url", "payload", "payload_digest", F.col("_first").cast("long"))
    return cut_lineage(rows.mapInArrow(write, INDEX))


def _record_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (c.split() for c in RECORDS.split(", "))])


def read_archives(index: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the bundles an index names, parsed from the files; every payload's digest is verified.

    One task reads a bundle frame by frame along its seek table. `payloads=False` leaves the payload column null.
    """
    bundles = index.select("bundle").distinct()
    schema = _record_schema()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, path = _store(name)
                with store.open_input_file(path) as source:
                    for start, packed, plain in read_seek_table(source, source.size()):
                        source.seek(start)
                        data, at, rows = unpack.decompress(source.read(packed), max_output_size=plain), 0, []
                        while at < len(data):
                            row, at = parse_record(data, at)
                            rows.append(row if payloads else row | {"payload": None})
                        yield pa.RecordBatch.from_pylist(rows, schema)

    # Dealt out one by one: their rows are tiny, but each stands for a whole file.
    return bundles.repartition(max(1, min(bundles.count(), 100_000))).mapInArrow(read, RECORDS)


def fetch_records(index: DataFrame, ids: DataFrame) -> DataFrame:
    """Payloads of chosen records: (record_id, payload). Revisits give the payload of the record they refer to.

    Rows are gathered by frame, and a task unpacks each frame that it needs once and nothing else of its bundle. An
    identifier that no record has gives no row; one that several records share gives one row each time it is asked for.
    """
    one = index.dropDuplicates(["record_id"])
    wanted = ids.select("record_id").join(one.select("record_id", "refers_to_record"), "record_id")
    target = wanted.select("record_id", F.coalesce("refers_to_record", "record_id").alias("_at"))
    places = target.join(one.select(
        F.col("record_id").alias("_at"), "bundle", "frame", "frame_start", "frame_bytes", "offset"), "_at")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, held, data = zstandard.ZstdDecompressor(), None, b""
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if (row["bundle"], row["frame"]) != held:
                    store, path = _store(row["bundle"])
                    with store.open_input_file(path) as source:
                        source.seek(row["frame_start"])
                        data = unpack.decompress(source.read(row["frame_bytes"]))
                    held = row["bundle"], row["frame"]
                out.append({"record_id": row["record_id"], "payload": parse_record(data, row["offset"])[0]["payload"]})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("record_id", pa.string()), ("payload", pa.binary())]))

    return places.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "offset").mapInArrow(
        read, "record_id string, payload binary")
