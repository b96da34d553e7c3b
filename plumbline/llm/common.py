"""What the operators of this subpackage share: tables, cut lineage, packed texts, tokens, hashes.

Texts travel between passes as *chunks*: a few megabytes of whole documents in one compressed row. A pass that has to ask
the corpus about keys (counts of n-grams, of anchors) sends one row per chunk and key range instead of one row per key.
"""

from __future__ import annotations

import ctypes
import gc
import json
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import checkpoint_dir

CHUNK_BYTES = 8 << 20      # text per chunk; a longer document is a chunk of its own
TEXT_LEVEL = 3             # compression of a chunk's texts, which are written and shuffled
SLICE_BYTES = 4 << 20      # text that a task turns into arrays at once

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SEPARATOR = 0x0A           # stands between the documents of a buffer; white space, so no word crosses it

BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def row_digest(docs: DataFrame) -> Column:
    """Hex digest of all columns of a row: equal for rows that are equal in every column, nulls included, and only for them."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])), 256)


def settled(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage: written to the shared checkpoint folder, which survives lost executors.

    Without a configured folder (a bare local session) the rows are persisted, and lost blocks are recomputed.
    """
    if checkpoint_dir(df.sparkSession) is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return df.checkpoint(eager=True)


def power_of_two(n: float, least: int = 1) -> int:
    """The smallest power of two at or above n, and at least ``least``."""
    p = least
    while p < n:
        p *= 2
    return p


# ---- Arrow batches ------------------------------------------------------------------------------------------------

def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds at most ``most`` bytes of text, or a single row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def release_memory() -> None:
    """Give what a task no longer holds back to the system; Python workers outlive their tasks and serve the next stage."""
    _POWERS.update(up=np.ones(1, np.uint64), down=np.ones(1, np.uint64))
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # of glibc
    if trim:
        trim(0)


def groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows sorted by ``key``, as one table per value of it; only one group is held at a time."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = batch.column(key).to_pylist()
        start = 0
        for i, value in enumerate(values):
            if (held or i > start) and value != current:
                held.append(batch.slice(start, i - start))
                yield pa.Table.from_batches([b for b in held if b.num_rows])
                held, start = [], i
            current = value
        held.append(batch.slice(start))
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches([b for b in held if b.num_rows])


def whole_groups(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of a key together in one task and in order, for :func:`groups`."""
    return df.repartition(keys[0]).sortWithinPartitions(*keys)


# ---- buffers, words and hashes --------------------------------------------------------------------------------------

@dataclass
class Buffer:
    """Documents laid end to end, one separator after each."""

    data: np.ndarray           # uint8
    starts: np.ndarray         # int64, where each document begins
    lengths: np.ndarray        # int64, its bytes

    @classmethod
    def of(cls, texts: list[bytes]) -> Buffer:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.zeros(len(texts), np.int64)
        np.cumsum(lengths[:-1] + 1, out=starts[1:])
        return cls(np.frombuffer(bytes([SEPARATOR]).join(texts) + bytes([SEPARATOR]), np.uint8), starts, lengths)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all others."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = power_of_two(n, 1 << 16)
        for name, factor in (("up", BASE), ("down", np.uint64(pow(int(BASE), -1, 2**64)))):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash; :func:`span_hashes` takes the hash of any span from it."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _powers(len(data))[0], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span, the same wherever they stand."""
    down = _powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of a buffer, lower-cased over A-Z: where they stand, their hashes, and the document of each."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray          # per document, the index of its first word; one more entry at the end


def words_of(buffer: Buffer, lower: bool = True) -> Words:
    data = LOWER[buffer.data] if lower else buffer.data
    white = WHITE[data]
    edge = np.flatnonzero(white[1:] != white[:-1]) + 1
    if not white[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]          # the buffer ends with white space
    hashes = span_hashes(prefix_sums(data), starts, ends)
    return Words(starts, ends, hashes, np.append(np.searchsorted(starts, buffer.starts), len(starts)))


def sequence_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive values; entry i covers i to i + n - 1."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = hashes[:m].copy()
    for k in range(1, n):
        h *= BASE
        h += hashes[k:m + k]
        h ^= h >> np.uint64(29)
    return mix(h)


# ---- packed rows ----------------------------------------------------------------------------------------------------

def pack(effort: int = 1, /, **arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; bytes of equal weight stand together, so small numbers take little room."""
    head, body = [], []
    for name, a in arrays.items():
        a = np.ascontiguousarray(a)
        head.append([name, a.dtype.str, len(a)])
        body.append(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
    head = json.dumps(head).encode()
    return zstandard.ZstdCompressor(level=effort).compress(struct.pack("<I", len(head)) + head + b"".join(body))


def unpack(value: bytes) -> dict[str, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(value)
    (size,) = struct.unpack_from("<I", raw)
    at, out = 4 + size, {}
    for name, kind, n in json.loads(raw[4:at]):
        kind = np.dtype(kind)
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out[name] = np.ascontiguousarray(planes.T).reshape(-1).view(kind)
        at += n * kind.itemsize
    return out


def gaps(keys: np.ndarray) -> np.ndarray:
    """Ascending keys as differences; ``np.cumsum`` undoes it."""
    return np.diff(keys, prepend=np.uint64(0)) if len(keys) else keys


def undo_gaps(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint64)


CHUNK_SCHEMA = "chunk long, role int, bytes long, blob binary"


def pack_documents(docs: DataFrame, id_column: str, text: str, role: str | None = None,
                   chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Documents as chunks (see the module's docstring), settled so that a chunk stays what it is.

    ``role`` names an integer column; documents of different roles go to different chunks. A null id is kept as such.
    """
    schema = docs.select(id_column, text, *([role] if role else []))

    def run(batches):
        task = TaskContext.get().partitionId()
        made = 0
        open_: dict[int, list] = {}

        def close(key):
            nonlocal made
            ids, texts = open_.pop(key)
            data = bytes([SEPARATOR]).join(texts) + bytes([SEPARATOR])
            blob = pack(TEXT_LEVEL, ids=np.array([0 if i is None else i for i in ids], np.int64),
                        known=np.array([i is not None for i in ids], np.uint8),
                        lengths=np.fromiter(map(len, texts), np.int64, len(texts)), data=np.frombuffer(data, np.uint8))
            made += 1
            return pa.RecordBatch.from_pylist(
                [{"chunk": (task << 32) + made, "role": key, "bytes": len(data) + 64 * len(ids), "blob": blob}],
                pa.schema([("chunk", pa.int64()), ("role", pa.int32()), ("bytes", pa.int64()), ("blob", pa.binary())]))

        size: dict[int, int] = {}
        for batch in batches:
            roles = batch.column(2).to_pylist() if role else [0] * batch.num_rows
            for i, t, r in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), roles, strict=True):
                if r in open_ and size[r] + len(t) > chunk_bytes:
                    yield close(r)
                if r not in open_:
                    open_[r], size[r] = ([], []), 0
                open_[r][0].append(i)
                open_[r][1].append(t)
                size[r] += len(t) + 64
        for r in list(open_):
            yield close(r)

    return settled(schema.mapInArrow(run, CHUNK_SCHEMA))


def unpack_documents(blob: bytes) -> tuple[list[int | None], Buffer]:
    """Ids and texts of a chunk."""
    got = unpack(blob)
    ids = [int(i) if k else None for i, k in zip(got["ids"], got["known"], strict=True)]
    starts = np.zeros(len(ids), np.int64)
    np.cumsum(got["lengths"][:-1] + 1, out=starts[1:])
    return ids, Buffer(got["data"], starts, got["lengths"])


def total_bytes(chunks: DataFrame) -> int:
    return chunks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).head()[0]


def clip_range(ascending: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Ascending 64-bit keys by their leading bits: (range, slice)."""
    if bits == 0:
        if len(ascending):
            yield 0, slice(0, len(ascending))
        return
    ranges = (ascending >> np.uint64(64 - bits)).astype(np.int64)
    cut = np.flatnonzero(np.diff(ranges)) + 1
    for a, b in zip(np.concatenate(([0], cut)), np.concatenate((cut, [len(ranges)])), strict=True):
        if b > a:
            yield int(ranges[a]), slice(int(a), int(b))
