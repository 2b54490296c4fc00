"""Media columns: content-addressed payloads in tar shards.

A text's payload is kept as 8-bit grey samples of a PNG, WIDTH to a row, which is lossless. Shards
are plain tar files in the shared folder, one per task, with each distinct payload once; rows
carry digest, shard, offset and length. Metadata columns come from range reads of the header
alone; features from reading the stored bytes back.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.scratch import fresh_path, release, written
from tallyloom.llm.textblock import freeing
from tallyloom.shipping import ship

WIDTH, LEVEL = 192, 6
#: A payload of more than one in HOT rows is common.
HOT = 4096
#: Bytes of a stored payload up to the end of its size fields.
HEADER = 24
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_MAX_CHUNK = 1 << 24


def payload(raw: bytes) -> bytes:
    """raw with bytes 32 appended up to a positive multiple of WIDTH."""
    return raw.ljust(max(1, -(-len(raw) // WIDTH)) * WIDTH, b" ")


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode(data: bytes) -> bytes:
    """A grey 8-bit PNG with the bytes as samples."""
    rows = np.zeros((len(data) // WIDTH, WIDTH + 1), np.uint8)  # each row starts with its filter, 0
    rows[:, 1:] = np.frombuffer(data, np.uint8).reshape(-1, WIDTH)
    packed = zlib.compress(rows.tobytes(), LEVEL)
    out = [_SIGNATURE, _chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0))]
    out += [_chunk(b"IDAT", packed[i : i + _MAX_CHUNK]) for i in range(0, len(packed), _MAX_CHUNK)]
    return b"".join([*out, _chunk(b"IEND", b"")])


def size(header: bytes) -> tuple[int, int]:
    """Width and height from the first HEADER bytes of a stored payload."""
    if header[:8] != _SIGNATURE or header[12:16] != b"IHDR":
        raise ValueError("not a stored payload")
    return struct.unpack(">II", header[16:24])


def decode(stored: bytes) -> bytes:
    """The payload of a stored form; chunk sums are checked."""
    width, height = size(stored[:HEADER])
    at, parts = 8, []
    while at < len(stored):
        (n,) = struct.unpack(">I", stored[at : at + 4])
        kind, data = stored[at + 4 : at + 8], stored[at + 8 : at + 8 + n]
        if struct.unpack(">I", stored[at + 8 + n : at + 12 + n])[0] != zlib.crc32(kind + data):
            raise ValueError("a stored payload is damaged")
        if kind == b"IDAT":
            parts.append(data)
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(height, width + 1)
    return rows[:, 1:].tobytes()


def feature(data: bytes) -> str:
    """Mean, deviation and an eight-bin histogram of the samples."""
    x = np.frombuffer(data, np.uint8)
    count = np.bincount(x, minlength=256)
    level = np.arange(256)
    mean = float((count * level).sum()) / len(x)
    spread = max(0.0, float((count * level**2).sum()) / len(x) - mean * mean) ** 0.5
    return f"{mean:.4f};{spread:.4f};" + ",".join(str(int(v)) for v in count.reshape(8, 32).sum(1))


class Shard:
    """A tar file being written; remembers where each digest's payload went."""

    def __init__(self, folder: str, name: str):
        self.files, path = pafs.FileSystem.from_uri(folder)
        self.name, self.folder = name, path
        self.out, self.at, self.seen = None, 0, {}

    def add(self, data: bytes) -> tuple[str, int, int]:
        """Digest of the stored form, offset and length of its bytes."""
        key = hashlib.sha256(data).digest()
        if key not in self.seen:
            if self.out is None:
                self.files.create_dir(self.folder, recursive=True)
                self.out = self.files.open_output_stream(f"{self.folder}/{self.name}")
            stored = encode(data)
            digest = hashlib.sha256(stored).hexdigest()
            entry = tarfile.TarInfo(f"{digest}.png")
            entry.size = len(stored)
            head = entry.tobuf(tarfile.USTAR_FORMAT if len(stored) < 8 << 30 else tarfile.GNU_FORMAT)
            self.out.write(head + stored + bytes(-len(stored) % tarfile.BLOCKSIZE))
            self.seen[key] = digest, self.at + len(head), len(stored)
            self.at += len(head) + len(stored) + -len(stored) % tarfile.BLOCKSIZE
        return self.seen[key]

    def close(self) -> None:
        if self.out is not None:
            self.out.write(bytes(2 * tarfile.BLOCKSIZE))
            self.out.close()


#: Digests are bytes in all tables between the steps, and text in what is returned.
INDEX = "n_bytes bigint, digest binary, shard string, offset bigint, length bigint"


def _text(digest: str):
    return F.lower(F.hex(digest))


@freeing
def _store(batches: Iterable[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    shard = Shard(folder, f"shard-{task.partitionId():06d}-{task.taskAttemptId()}.tar")
    for b in batches:
        raws = [x.encode() if x is not None else b"" for x in b.column(1).to_pylist()]
        at = [shard.add(payload(raw)) for raw in raws]
        cols = [pa.array(list(map(len, raws)), pa.int64()), pa.array([bytes.fromhex(d) for d, _, _ in at], pa.binary()), pa.array([shard.name] * len(at), pa.string()), pa.array([o for _, o, _ in at], pa.int64()), pa.array([n for _, _, n in at], pa.int64())]
        yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["key", "n_bytes", "digest", "shard", "offset", "length"])
    shard.close()


def store(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write payloads to tar shards in `folder`; one index row per input row.

    A task writes each distinct payload once. Tasks name shards by attempt, so a repeated task
    never writes to a file that rows already point to. Of a payload in several shards, every row
    points to one (the first by shard name). Null counts as empty text; an empty table writes none.
    """
    rows = _stored(docs, folder, key, text)
    return _with(rows, _places(rows)).select(F.col("key").alias(key), "n_bytes", _text("digest").alias("digest"), "shard", "offset", "length")


def _stored(docs: DataFrame, folder: str, key: str, text: str) -> DataFrame:
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(partial(_store, folder=folder), f"key {kind}, {INDEX}")
    return written(rows, "index")


def _places(rows: DataFrame) -> DataFrame:
    """digest, shard, offset, length and rows of each payload, at the first shard that has it."""
    one = rows.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("at"), F.count("*").alias("rows"))
    return written(one.select("digest", "at.*", "rows"), "places")


def _with(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """key, n_bytes and the facts by digest of every row.

    Payloads of more than one in HOT rows, HOT at most, are joined by broadcast: no task gets all
    rows of a common payload.
    """
    total = rows.count()
    hot = F.col("rows") * HOT > total
    own = rows.select("key", "n_bytes", F.col("digest").alias("_d"))
    often = F.broadcast(facts.filter(hot))
    names = F.broadcast(facts.filter(hot).select("digest"))
    few = own.join(names, own["_d"] == names["digest"], "left_anti").join(facts.filter(~hot).hint("merge"), F.col("_d") == F.col("digest"))
    return own.join(often, F.col("_d") == F.col("digest")).unionByName(few).drop("_d", "rows")


@freeing
def _ranges(batches: Iterable[pa.RecordBatch], folder: str, whole: bool) -> Iterator[pa.RecordBatch]:
    files, path = pafs.FileSystem.from_uri(folder)
    name, f = None, None
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            part, rows = b.slice(lo, 256), []
            for shard, offset, length in zip(*(part.column(k).to_pylist() for k in ("shard", "offset", "length")), strict=True):
                if shard != name:
                    if f is not None:
                        f.close()
                    name, f = shard, files.open_input_file(f"{path}/{shard}")
                row = size(f.read_at(min(HEADER, length), offset))  # the header alone
                if whole:
                    stored = f.read_at(length, offset)
                    data = decode(stored)
                    row += len(data), hashlib.sha256(data).digest(), zlib.crc32(data[-16:]), hashlib.sha256(stored).digest(), feature(data)
                rows.append(row)
            names = (*META, *WHOLE) if whole else META
            kinds = [{"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64()}[x.split()[1]] for x in names]
            cols = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([part.column("digest"), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=["digest", *(x.split()[0] for x in names)])


WHOLE = ("payload_bytes bigint", "payload_sha256 binary", "tail_crc32 bigint", "read_sha256 binary", "feature string")
META = ("width bigint", "height bigint")


def read(index: DataFrame, folder: str, whole: bool = False) -> DataFrame:
    """Per distinct digest: width and height from its header alone; with whole=True also what its bytes give.

    Each stored payload is read once, shard by shard in offset order.
    """
    ship(index.sparkSession)
    kind = index.schema["digest"].dataType.simpleString()
    one = index.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("at")).select("digest", "at.*")
    one = one.repartition("shard").sortWithinPartitions("shard", "offset")
    return one.mapInArrow(partial(_ranges, folder=folder, whole=whole), f"digest {kind}, {', '.join((*META, *WHOLE) if whole else META)}")


def media_columns(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes, digest, shard, offset, length; width and height (header reads); WHOLE (read back).

    Null and empty texts are one row of spaces; repeated rows share their payload; an empty table
    gives no rows. Very long texts are one payload each, whole. No other column of docs is kept, so
    none clashes. Fails if stored bytes do not have the digest that addresses them.
    """
    folder = fresh_path(docs.sparkSession, "media")
    rows = _stored(docs, folder, key, text)
    places = _places(rows)
    got = read(places, folder, whole=True)
    got = got.withColumn("ok", F.when(F.col("read_sha256") == F.col("digest"), True).otherwise(F.raise_error(F.lit("stored bytes do not match their digest"))))
    facts = written(places.join(got.drop("read_sha256"), "digest"), "facts")
    release(places)
    out = _with(rows, facts).filter("ok").drop("ok").withColumns({"digest": _text("digest"), "payload_sha256": _text("payload_sha256")})
    return out.withColumn("read_sha256", F.col("digest")).withColumnRenamed("key", key)
