"""WARC records in seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each with whole WARC records, and ends with a
skippable frame that lists the compressed and plain size of every frame (the public seekable format).
A catalogue maps each record identifier to its bundle, frame and the offset within the plain frame, so
one record costs one ranged read and one decompression of its frame.

Bundles are written by tasks. Each attempt writes a file of its own, and only files named in the stored
catalogue count, so a lost executor or a repeated task leaves at most an unused file.

Edge cases: a NULL payload is empty. A NULL id is written as ``urn:row:null`` and read back as NULL; it is
never the original of a revisit, and a group of equal payloads without any id is all responses. Rows that
repeat the smallest id of their group are all responses. A NULL address has no target line; line breaks
in an address are percent-encoded. Additional columns are ignored. An empty table gives an empty catalogue.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import filesystem_of, small_batches, stored
from tierflow.session import scratch_path

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_TABLE_MAGIC = 0x8F92EAB1

#: Plain bytes after which a frame is closed, and bundle bytes after which a new bundle begins.
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 1 << 30

CATALOGUE = "record_id string, bundle string, frame int, frame_offset long, frame_bytes int, record_offset int, record_bytes int"
RECORDS = (
    "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, "
    "payload_bytes long, payload binary"
)
_TYPES = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _batch(ddl: str, rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(part.split() for part in ddl.split(", ")))
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[k]) for c, k in zip(columns, kinds)], list(names))


def planned_records(pages: DataFrame, id_col: str, uri_col: str, payload_col: str, min_revisit_bytes: int = 0) -> DataFrame:
    """One row per page: its record type, and for a revisit the id of the first page with that payload.

    Equal payloads are found by digest and length. The table of repeated digests is reduced inside map
    tasks; a payload that a third of all rows share is one row of it, and the join's other side can be split.
    """
    body = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("string").alias("record_id"),
        F.col(id_col).alias("id"),
        F.col(uri_col).cast("string").alias("target_uri"),
        body.alias("payload"),
        F.sha1(body).alias("digest"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
    )
    repeated = (
        rows.where(F.col("payload_bytes") >= min_revisit_bytes)
        .groupBy("digest", "payload_bytes")
        .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    return rows.join(repeated, ["digest", "payload_bytes"], "left").select(
        "record_id",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.when(revisit, F.col("first_id").cast("string")).alias("refers_to"),
        "digest",
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def _urn(record_id: str | None) -> str:
    return "urn:row:null" if record_id is None else f"urn:page:{record_id}"


def _from_urn(urn: str | None) -> str | None:
    return None if urn is None or urn == "urn:row:null" else urn.removeprefix("urn:page:")


def record_bytes(row: dict, date: str) -> bytes:
    """One WARC record; a response holds a plain HTTP answer with the payload as its body."""
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    block = b""
    if row["record_type"] == "response":
        payload = row["payload"] or b""
        block = (
            b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload
        )
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{_urn(row['record_id'])}>", f"WARC-Date: {date}"]
    if row["target_uri"] is not None:
        lines.append("WARC-Target-URI: " + row["target_uri"].replace("\r", "%0D").replace("\n", "%0A"))
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Refers-To: <{_urn(row['refers_to'])}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += [
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Bytes: {row['payload_bytes']}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed_records(plain: bytes) -> Iterator[tuple[int, int, dict, bytes]]:
    """(offset, length, header, payload) of each record in a plain frame."""
    at = 0
    while at < len(plain):
        end = plain.index(b"\r\n\r\n", at)
        lines = plain[at:end].decode().split("\r\n")
        header = dict(line.split(": ", 1) for line in lines[1:])
        start, size = end + 4, int(header["Content-Length"])
        block = plain[start : start + size]
        body = block[block.index(b"\r\n\r\n") + 4 :] if block else b""
        yield at, start + size + 4 - at, header, body
        at = start + size + 4


class _Bundle:
    """One bundle being written by a task."""

    def __init__(self, folder: str):
        import zstandard

        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        filesystem, inner = filesystem_of(self.path)
        filesystem.create_dir(inner.rpartition("/")[0], recursive=True)
        self.stream, self.pack = filesystem.open_output_stream(inner, compression=None), zstandard.ZstdCompressor(level=3)
        self.sizes: list[tuple[int, int]] = []
        self.plain, self.waiting, self.offset = bytearray(), [], 0

    def add(self, record_id: str | None, data: bytes) -> None:
        self.waiting.append((record_id, len(self.plain), len(data)))
        self.plain += data

    def close_frame(self) -> list[tuple]:
        if not self.waiting:
            return []
        packed = self.pack.compress(bytes(self.plain))
        self.stream.write(packed)
        rows = [(r, self.path, len(self.sizes), self.offset, len(packed), at, n) for r, at, n in self.waiting]
        self.sizes.append((len(packed), len(self.plain)))
        self.offset += len(packed)
        self.plain, self.waiting = bytearray(), []
        return rows

    def close(self) -> list[tuple]:
        rows = self.close_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        table += struct.pack("<IBI", len(self.sizes), 0, SEEK_TABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.stream.close()
        return rows


def write_bundles(
    records: DataFrame,
    folder: str | None = None,
    date: str = "1970-01-01T00:00:00Z",
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write the planned records as bundles below ``folder``; returns the stored catalogue. Runs a job."""
    spark = records.sparkSession
    small_batches(spark)
    folder = folder or scratch_path(spark, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in batches:
            done: list[tuple] = []
            for row in batch.to_pylist():
                bundle = bundle or _Bundle(folder)
                bundle.add(row["record_id"], record_bytes(row, date))
                if len(bundle.plain) >= frame_bytes:
                    done += bundle.close_frame()
                if bundle.offset >= bundle_bytes:
                    done += bundle.close()
                    bundle = None
            if done:
                yield _batch(CATALOGUE, done)
        if bundle:
            yield _batch(CATALOGUE, bundle.close())

    return stored(records.mapInArrow(write, CATALOGUE), "warc-catalogue")


def seek_table(path: str) -> list[tuple[int, int, int]]:
    """(offset, compressed bytes, plain bytes) of each frame, read from the bundle's end."""
    filesystem, inner = filesystem_of(path)
    with filesystem.open_input_file(inner) as f:
        size = f.size()
        frames, _, magic = struct.unpack("<IBI", f.read_at(9, size - 9))
        if magic != SEEK_TABLE_MAGIC:
            raise ValueError(f"{path} has no seek table")
        entries = f.read_at(8 * frames, size - 9 - 8 * frames)
    out, at = [], 0
    for packed, plain in struct.iter_unpack("<II", entries):
        out.append((at, packed, plain))
        at += packed
    return out


def plain_frame(path: str, offset: int, packed: int) -> bytes:
    import zstandard

    filesystem, inner = filesystem_of(path)
    with filesystem.open_input_file(inner) as f:
        return zstandard.ZstdDecompressor().decompress(f.read_at(packed, offset))


def read_record(entry: dict) -> tuple[dict, bytes]:
    """Header and payload of the record that one catalogue row names: one ranged read."""
    frame = plain_frame(entry["bundle"], entry["frame_offset"], entry["frame_bytes"])
    data = frame[entry["record_offset"] : entry["record_offset"] + entry["record_bytes"]]
    return next((header, payload) for _, _, header, payload in parsed_records(data))


def read_bundles(spark: SparkSession, catalogue: DataFrame) -> DataFrame:
    """All records of the bundles in a catalogue: footers give the frames, which are dealt to tasks."""
    small_batches(spark)

    def frames(batches):
        for batch in batches:
            rows = [(p, *x) for p in batch.column(0).to_pylist() for x in seek_table(p)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["bundle", "at", "packed", "plain"]) if rows else (
                pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.int64())], ["bundle", "at", "packed", "plain"])
            )

    def records(batches):
        for batch in batches:
            for bundle, at, packed in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows = []
                for _, _, h, payload in parsed_records(plain_frame(bundle, at, packed)):
                    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    if h["WARC-Type"] == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"{h['WARC-Record-ID']} in {bundle} does not have its digest")
                    refers = h.get("WARC-Refers-To")
                    rows.append((
                        _from_urn(h["WARC-Record-ID"][1:-1]), h["WARC-Type"], h.get("WARC-Target-URI"),
                        _from_urn(refers[1:-1]) if refers else None, digest, int(h["WARC-Payload-Bytes"]),
                        payload if h["WARC-Type"] == "response" else None,
                    ))
                yield _batch(RECORDS, rows)

    bundles = catalogue.select("bundle").distinct()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        bundles.mapInArrow(frames, "bundle string, at long, packed long, plain long")
        .repartition(parts)
        .mapInArrow(records, RECORDS)
    )
