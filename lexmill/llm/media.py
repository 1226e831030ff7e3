"""Media columns: content-addressed payloads in tar shards.

A text becomes an 8-bit greyscale PNG, 64 samples wide: its UTF-8 bytes, zeros up to a positive
multiple of 64, one byte a sample, losslessly compressed. Each task writes its own tar shards in the
shared folder; a payload's member is named by its digest and stored once a shard. A manifest row
carries digest, shard, offset and length. The manifest's commit is what makes a shard count: a task
that is run again writes a shard under a new name, and the older file is referred to by nobody.

Reading: metadata columns come from a range read of the first 33 bytes of a member; the payload
from a range read of the member alone.

Defined results: null and empty text give 64 zero bytes; equal texts give equal values; a repeated
doc_id gives a row each; an empty table no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import struct
import tarfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import open_store, shared_dir

WIDTH = 64
HEADER_BYTES = 33
SHARD_BYTES = 256 << 20
MANIFEST = "doc_id long, n_bytes long, digest string, shard string, offset long, length long"
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def payload_of(text: str | None) -> tuple[bytes, int]:
    """Padded payload and unpadded length of a text."""
    raw = (text or "").encode()
    return raw.ljust(max(WIDTH, -(-len(raw) // WIDTH) * WIDTH), b"\0"), len(raw)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(payload: bytes) -> bytes:
    """8-bit greyscale PNG of a payload whose length is a multiple of 64."""
    height = len(payload) // WIDTH
    lines = np.zeros((height, WIDTH + 1), dtype=np.uint8)
    lines[:, 1:] = np.frombuffer(payload, dtype=np.uint8).reshape(height, WIDTH)
    head = struct.pack(">IIBBBBB", WIDTH, height, 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + _chunk(b"IEND", b"")


def read_header(head: bytes) -> tuple[int, int, int, int]:
    """(width, height, bit depth, colour type) from a member's first 33 bytes."""
    if head[:8] != SIGNATURE or head[12:16] != b"IHDR":
        raise ValueError("not a PNG member")
    return struct.unpack(">IIBB", head[16:26])


def decode_png(media: bytes) -> bytes:
    """The payload of a PNG that encode_png made."""
    width, height, _, _ = read_header(media[:HEADER_BYTES])
    at, parts = 8, []
    while at < len(media):
        n, kind = struct.unpack(">I4s", media[at : at + 8])
        if kind == b"IDAT":
            parts.append(media[at + 8 : at + 8 + n])
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(b"".join(parts)), dtype=np.uint8).reshape(height, width + 1)
    return lines[:, 1:].tobytes()


def features(payload: bytes, header: tuple[int, int, int, int]) -> str:
    """Shape from the header and sample statistics from the payload."""
    counts = np.bincount(np.frombuffer(payload, dtype=np.uint8), minlength=256)
    n, levels = counts.sum(), np.arange(256)
    mean = float((counts * levels).sum() / n)
    deviation = math.sqrt(max(0.0, float((counts * (levels - mean) ** 2).sum() / n)))
    p = counts[counts > 0] / n
    return f"png {header[0]}x{header[1]}x{header[2]} mean={mean:.4f} sd={deviation:.4f} entropy={float(-(p * np.log2(p)).sum()) + 0.0:.4f}"


class _Shard:
    """A tar file that grows member by member; knows where each digest lies."""

    def __init__(self, root: str):
        self.name = f"shard-{uuid.uuid4().hex}.tar"
        fs, path = open_store(root)
        fs.create_dir(path, recursive=True)
        self.out, self.at, self.places = fs.open_output_stream(f"{path}/{self.name}"), 0, {}

    def put(self, digest: str, media: bytes) -> tuple[int, int]:
        if digest not in self.places:
            info = tarfile.TarInfo(f"{digest}.png")
            info.size = len(media)
            head = info.tobuf(tarfile.GNU_FORMAT)
            self.out.write(head + media + b"\0" * (-len(media) % 512))
            self.places[digest] = (self.at + len(head), len(media))
            self.at += len(head) + len(media) + -len(media) % 512
        return self.places[digest]

    def close(self) -> None:
        self.out.write(b"\0" * 1024)
        self.out.close()


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in schema.split(", "))])


def write_media(docs: DataFrame, root: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes tar shards below ``root``; returns the committed manifest (one row per document)."""
    schema = _arrow(MANIFEST)

    def task(batches):
        shard = None
        try:
            for batch in batches:
                rows: list[list] = [[] for _ in schema]
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    payload, n = payload_of(text.as_py())
                    media = encode_png(payload)
                    digest = hashlib.sha256(media).hexdigest()
                    shard = shard or _Shard(root)
                    for column, value in zip(rows, (doc_id, n, digest, shard.name, *shard.put(digest, media))):
                        column.append(value)
                    if shard.at >= shard_bytes:
                        shard.close()
                        shard = None
                if rows[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)
        finally:
            if shard:
                shard.close()

    docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, MANIFEST).write.parquet(f"{root}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{root}/manifest")


READ = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, width int, height int, bit_depth int"


def read_media(manifest: DataFrame, root: str) -> DataFrame:
    """Range-reads members: header for metadata columns, then the payload for digests and features."""
    schema = _arrow(READ)
    total = manifest.agg(F.sum("length")).first()[0] or 0
    tasks = max(manifest.sparkSession.sparkContext.defaultParallelism, math.ceil(total / (16 << 20)))

    def task(batches):
        fs, path = open_store(root)
        name, source = None, None
        last: tuple = ()
        for batch in batches:
            rows: list[list] = [[] for _ in schema]
            for r in batch.to_pylist():
                if r["shard"] != name:
                    if source:
                        source.close()
                    name, last = r["shard"], ()
                    source = fs.open_input_file(f"{path}/{name}")
                if not last or last[0] != r["offset"]:
                    head = read_header(source.read_at(HEADER_BYTES, r["offset"]))
                    media = source.read_at(r["length"], r["offset"])
                    payload = decode_png(media)
                    last = (r["offset"], (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), features(payload, head), *head[:3]))
                for column, value in zip(rows, (r["doc_id"], r["n_bytes"], *last[1])):
                    column.append(value)
            if rows[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    near = manifest.repartitionByRange(tasks, "shard", "offset", "doc_id").sortWithinPartitions("shard", "offset")
    return near.mapInArrow(task, READ)


def media_columns(docs: DataFrame) -> DataFrame:
    """Stores every text as media and returns the columns read back."""
    root = shared_dir(docs.sparkSession, "media")
    return read_media(write_media(docs, root), root)
