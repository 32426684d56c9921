"""Media columns over content-addressed payloads in tar shards.

Rows are named by the digest of their payload first; of each digest one identifier's
row is stored, as an 8-bit grey PNG image in a tar shard in the shared folder, and all
rows carry digest, shard, offset and length of the stored one: copies in other tasks
store nothing. Only digests that occur twice or more move to find that out. The
metadata columns are filled by range reads of headers only (one
tar header and one image header); features come from the whole stored bytes,
read back by range. A shard's name holds a random part, so a task that runs again
writes its own and the manifest, which is written once, names complete shards.

A null counts as empty. Equal texts have equal values and one entry; only rows that
repeat an identifier too may be stored once a task, and then the first shard by name
is the one that rows carry. A very long text is one entry, read whole by its task; tasks
hold one shard's rows at a time. Extra columns are ignored, whatever their names; an
empty table gives an empty result and no shard.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import new_folder, settled
from kinfold.llm.textbytes import buffers

WIDTH = 576
PAD = 255
BLOCK = 512
PNG_MAGIC = b"\x89PNG\r\n\x1a\n"
HEADER_BYTES = len(PNG_MAGIC) + 25  # magic and the IHDR chunk
SHARD_BYTES, SHARD_ROWS = 64 << 20, 100_000
#: Up to this many digests of copies are sent to all executors; beyond, the joins shuffle.
BROADCAST_ROWS = 200_000


def payload_of(data: bytes) -> bytes:
    """data and bytes 255 up to a positive multiple of WIDTH."""
    return data + bytes([PAD]) * ((-len(data)) % WIDTH if data else WIDTH)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_png(payload: bytes) -> bytes:
    """Lossless 8-bit grey image, WIDTH samples a row, unfiltered."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return PNG_MAGIC + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + _chunk(b"IEND", b"")


def png_size(header: bytes) -> tuple[int, int]:
    if header[: len(PNG_MAGIC)] != PNG_MAGIC or header[12:16] != b"IHDR":
        raise ValueError("not a PNG header")
    return struct.unpack(">II", header[16:24])


def from_png(data: bytes) -> bytes:
    width, height = png_size(data)
    at, packed = len(PNG_MAGIC), []
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        if kind == b"IDAT":
            packed.append(data[at + 8 : at + 8 + n])
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("unexpected row filter")
    return lines[:, 1:].tobytes()


def feature_of(payload: bytes) -> str:
    """Size, mean, deviation and an 8-bin histogram of the samples."""
    x = np.frombuffer(payload, np.uint8)
    bins = np.bincount(x >> 5, minlength=8)
    return f"{WIDTH}x{len(x) // WIDTH}|{x.mean():.4f}|{x.std():.4f}|" + "-".join(map(str, bins.tolist()))


def _tar_header(name: str, size: int) -> bytes:
    info = tarfile.TarInfo(name)
    info.size = size
    return info.tobuf(tarfile.USTAR_FORMAT)


class Shard:
    """One tar file in the shared store, written once, then read by ranges."""

    def __init__(self, folder: str):
        from pyarrow import fs

        self.name = f"shard-{uuid.uuid4().hex}.tar"
        self.files, place = fs.FileSystem.from_uri(folder)
        self.files.create_dir(place, recursive=True)
        self.path = f"{place}/{self.name}"
        self.out = self.files.open_output_stream(self.path)
        self.size, self.at = 0, {}

    def put(self, digest: str, make) -> tuple[int, int]:
        """(offset, length) of the entry of this digest, stored at first sight."""
        if digest not in self.at:
            body = make()
            self.out.write(_tar_header(f"{digest}.png", len(body)) + body + bytes(-len(body) % BLOCK))
            self.at[digest] = (self.size + BLOCK, len(body))
            self.size += BLOCK + len(body) + (-len(body) % BLOCK)
        return self.at[digest]

    def close(self) -> None:
        self.out.write(bytes(2 * BLOCK))
        self.out.close()

    def reader(self):
        return self.files.open_input_file(self.path)


def media_columns(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """The manifest: doc_id, n_bytes, digest, shard, offset, length, width, height,
    payload_bytes, payload_sha256, tail_crc32, media_sha256, feature."""
    folder = folder or new_folder(docs.sparkSession, "media")
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "n_bytes", "digest", "shard", "offset", "length", "width", "height", "payload_bytes", "payload_sha256", "tail_crc32", "media_sha256", "feature"]

    def read_back(shard: Shard, ids: list, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        shard.close()
        seen: dict[int, tuple] = {}
        with shard.reader() as f:
            out = []
            for n_bytes, digest, offset, length in rows:
                if offset not in seen:
                    entry = tarfile.TarInfo.frombuf(f.read_at(BLOCK, offset - BLOCK), "utf-8", "strict")
                    width, height = png_size(f.read_at(HEADER_BYTES, offset))
                    if entry.size != length or entry.name != f"{digest}.png":
                        raise ValueError(f"{shard.name} at {offset} holds {entry.name}")
                    media = f.read_at(length, offset)
                    payload = from_png(media)
                    if hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{shard.name} at {offset} isn't what was stored")
                    seen[offset] = (width, height, len(payload), digest, zlib.crc32(payload[-32:]), hashlib.sha256(media).hexdigest(), feature_of(payload))
                out.append((n_bytes, digest, shard.name, offset, length, *seen[offset]))
        cols = list(zip(*out, strict=True))
        kinds = [pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 5, pa.string(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.concat_arrays(ids), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, rows = None, [], []
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                shard = shard or Shard(folder)
                raw, offsets = buffers(part.column(1))
                ids.append(part.column(0))
                for a, b, digest in zip(offsets[:-1].tolist(), offsets[1:].tolist(), part.column(2).to_pylist(), strict=True):
                    rows.append((b - a, digest, *shard.put(digest, lambda a=a, b=b, raw=raw: to_png(payload_of(raw[a:b].tobytes())))))
                if shard.size > SHARD_BYTES or len(rows) > SHARD_ROWS:
                    yield from read_back(shard, ids, rows)
                    shard, ids, rows = None, [], []
        if shard:
            yield from read_back(shard, ids, rows)

    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    pad = F.when(F.col("n_bytes") == 0, WIDTH).otherwise(F.pmod(-F.col("n_bytes"), F.lit(WIDTH))).cast("int")
    payload = F.concat(F.encode("text", "utf-8"), F.unhex(F.repeat(F.lit(f"{PAD:02X}"), pad)))
    rows = bare.withColumn("digest", F.sha2(payload, 256))
    named = settled(rows.select("doc_id", "n_bytes", "digest"), "digests")
    copied = named.groupBy("digest").agg(F.count(F.lit(1)).alias("times"), F.min("doc_id").alias("low")).where("times > 1")
    copied = settled(copied.select("digest", "low"), "copied")
    if copied.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        copied = F.broadcast(copied)
    stored = rows.join(copied.withColumn("twice", F.lit(True)), "digest", "left").where(F.col("twice").isNull() | F.col("doc_id").eqNullSafe(F.col("low")))
    schema = f"doc_id {kind}, n_bytes long, digest string, shard string, offset long, length long, width long, height long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_sha256 string, feature string"
    written = settled(stored.select("doc_id", "text", "digest").mapInArrow(run, schema), "manifest")
    single = written.join(copied, "digest", "left_anti").select(*names)
    values = [c for c in names if c not in ("doc_id", "n_bytes", "digest")]
    places = written.join(copied, "digest", "left_semi").groupBy("digest").agg(F.min(F.struct(*values)).alias("place"))
    if copied.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        places = F.broadcast(places)
    others = named.join(places, "digest").select("doc_id", "n_bytes", "digest", "place.*")
    return single.unionByName(others.select(*names))
