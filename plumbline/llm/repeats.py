"""Removal of repeated 200-byte strings: a collection's suffixes sorted column by column.

A string of ``WINDOW`` bytes that occurs twice has the same *anchor* both times: the least hash among its ``GRAM``-byte
pieces, the leftmost of equals, at the same offset. So texts are cut into runs of string starts with one anchor; a run and
the bytes of its strings are one short document (at most 360 bytes), and only documents of one anchor can share a string,
aligned at the anchor.

* Anchors that occur once in the corpus are dropped: chunks ask ranges of anchor hashes for their counts.
* The documents of a range of anchors form a collection. Multi-document construction inserts one symbol per document each
  round, from the last column to the first: the symbols, permuted by the order of the suffixes behind them, are the column
  of the Burrows-Wheeler transform; sorting them stably orders the suffixes one symbol longer, and the common prefix of
  neighbours is one more than the least common prefix between them a round before. As documents are aligned, suffixes of
  other columns never compare and leave the collection. Columns lie in an external file that is read once, in order.
* A start whose suffix shares ``WINDOW`` bytes with a neighbour in that order is repeated.

An anchor that occurs very often is split by the offset of the string in steps of ``HOT_STEP``, which equal strings share.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import (Buffer, clip_range, gaps, groups, mix, pack, pack_documents, power_of_two, prefix_sums,
                                  settled, span_hashes, total_bytes, undo_gaps, unpack, unpack_documents, whole_groups)

WINDOW = 200
GRAM = 40
SPAN = WINDOW - GRAM + 1        # pieces in a string
HOT, HOT_STEP = 512, 8          # occurrences beyond which an anchor is split, and the offsets of a part
CHUNK = 2 << 20                 # text of a chunk; hashes of all its places are held at once
SEGMENT = 1 << 20               # starts looked at at once
RANGE_BYTES = 12 << 20          # text that a range of anchors stands for
LEAST_RANGES = 64
KEY_BITS = ~np.uint64(0xFF)
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
PLACE = np.uint64(0xFFFFFF)     # low bits that hold a place within a segment


def runs(buffer: Buffer) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of string starts with one anchor: (first start, starts, anchor's place, anchor's hash)."""
    out = []
    ends = buffer.starts + buffer.lengths
    document, total = 0, len(buffer.starts)
    while document < total:
        last = document + 1
        while last < total and ends[last] - buffer.starts[document] <= SEGMENT:
            last += 1
        low, high = int(buffer.starts[document]), int(ends[last - 1])
        for begin in range(low, max(high, low + 1), SEGMENT):
            stop = min(high, begin + SEGMENT + WINDOW - 1)
            if stop - begin >= WINDOW:
                out.append(_segment(buffer, begin, stop, document, last))
        document = last
    if not out:
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _segment(buffer: Buffer, begin: int, stop: int, first: int, last: int):
    data = buffer.data[begin:stop]
    n = len(data) - GRAM + 1
    place = np.arange(n)
    h = span_hashes(prefix_sums(data), place, place + GRAM)
    ends = buffer.starts[first:last] + buffer.lengths[first:last] - begin      # ascending
    left = ends[np.minimum(np.searchsorted(ends, place, "right"), last - first - 1)] - place
    left[ends[ends < n]] = 0                                                   # separators
    v = np.where(left >= GRAM, (h & ~PLACE) | place.astype(np.uint64), NONE)
    width = 1
    while 2 * width <= SPAN:
        v = np.minimum(v[:-width], v[width:])
        width *= 2
    v = np.minimum(v[:len(v) - (SPAN - width)], v[SPAN - width:]) if SPAN > width else v
    starts = np.flatnonzero(left[:len(v)] >= WINDOW)
    anchor = (v[starts] & PLACE).astype(np.int64)
    cut = np.flatnonzero((np.diff(starts) != 1) | (np.diff(anchor) != 0)) + 1
    head = np.concatenate(([0], cut)) if len(starts) else np.zeros(0, np.int64)
    count = np.diff(np.append(head, len(starts)))
    at = anchor[head]
    # anchors are least hashes: mixed again they spread over all ranges
    return starts[head] + begin, count, at + begin, mix(h[at]) & KEY_BITS


def _questions(chunks: DataFrame, bits: int) -> DataFrame:
    schema = pa.schema([("range", pa.int64()), ("chunk", pa.int64()), ("blob", pa.binary())])

    def run(batches):
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                _, _, at, keys = runs(unpack_documents(blob)[1])
                keys = keys[np.unique(at, return_index=True)[1]]
                unique, count = np.unique(keys, return_counts=True)
                for r, part in clip_range(unique, bits):
                    yield pa.RecordBatch.from_pylist([{"range": r, "chunk": chunk, "blob": pack(
                        keys=gaps(unique[part]), count=count[part].astype(np.uint32))}], schema)

    return chunks.mapInArrow(run, "range long, chunk long, blob binary")


def _answers(questions: DataFrame) -> DataFrame:
    """Per question and anchor: 0 if it occurs once in the corpus, 1 if more often, 2 beyond ``HOT``."""
    schema = pa.schema([("chunk", pa.int64()), ("range", pa.int64()), ("blob", pa.binary())])

    def run(batches):
        for group in groups(batches, "range"):
            asked = [unpack(b) for b in group.column("blob").to_pylist()]
            held = [undo_gaps(a["keys"]) for a in asked]
            unique, at = np.unique(np.concatenate(held), return_inverse=True)
            total = np.bincount(at, np.concatenate([a["count"] for a in asked]), len(unique))
            level = (total > 1).astype(np.uint8) + (total > HOT)
            cut = np.cumsum([0] + [len(h) for h in held])
            for i, (chunk, r) in enumerate(zip(group.column("chunk").to_pylist(), group.column("range").to_pylist(), strict=True)):
                yield pa.RecordBatch.from_pylist([{"chunk": chunk, "range": r,
                                                   "blob": pack(level=level[at[cut[i]:cut[i + 1]]])}], schema)

    return whole_groups(questions, "range", "chunk").mapInArrow(run, "chunk long, range long, blob binary")


def _with_chunks(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    return whole_groups(chunks.select("chunk", F.lit(-1).cast("long").alias("range"), "blob").unionByName(answers),
                        "chunk", "range")


def _documents(joined: DataFrame, bits: int) -> DataFrame:
    """The short documents of repeated anchors, by range; equal ones of a chunk once, with all their places."""
    schema = pa.schema([("range", pa.int64()), ("chunk", pa.int64()), ("blob", pa.binary())])

    def run(batches):
        for group in groups(batches, "chunk"):
            blobs = group.column("blob").to_pylist()
            buffer = unpack_documents(blobs[0])[1]
            start, count, at, keys = runs(buffer)
            known = np.unique(keys)
            levels = [unpack(b)["level"] for b in blobs[1:]]
            level = np.concatenate(levels)[np.searchsorted(known, keys)] if levels else np.zeros(0, np.uint8)
            start, count, at, keys, level = (x[level > 0] for x in (start, count, at, keys, level))
            start, count, at, keys = _split_hot(start, count, at, keys, level > 1)
            if not len(start):
                continue
            length = count + WINDOW - 1
            left = start - at                       # column of the first symbol; the anchor's is 0
            content = mix(span_hashes(prefix_sums(buffer.data), start, start + length)
                          + keys + (left + WINDOW).astype(np.uint64))
            _, one, same = np.unique(content, return_index=True, return_inverse=True)
            order = np.argsort(keys[one], kind="stable")
            one, rank = one[order], np.argsort(order)
            same = rank[same]
            for r, part in clip_range(keys[one], bits):
                mine = one[part]
                where = np.repeat(start[mine] - np.concatenate(([0], np.cumsum(length[mine])[:-1])), length[mine])
                data = buffer.data[where + np.arange(int(length[mine].sum()))]
                uses = np.flatnonzero((same >= part.start) & (same < part.stop))
                yield pa.RecordBatch.from_pylist([{"range": r, "chunk": int(group.column("chunk")[0].as_py()), "blob": pack(
                    keys=keys[mine], left=left[mine].astype(np.int16), length=length[mine].astype(np.uint16), data=data,
                    use=(same[uses] - part.start).astype(np.uint32), place=start[uses].astype(np.uint32))}], schema)

    return joined.mapInArrow(run, "range long, chunk long, blob binary")


def _split_hot(start, count, at, keys, hot):
    """Runs of frequent anchors cut where the string's offset to the anchor passes a multiple of ``HOT_STEP``."""
    if not hot.any():
        return start, count, at, keys
    s, n, a, k = start[hot], count[hot], at[hot], keys[hot]
    low, high = (a - s - n + 1) // HOT_STEP, (a - s) // HOT_STEP     # offsets fall as starts rise
    parts = high - low + 1
    own = np.repeat(np.arange(len(s)), parts)
    step = low[own] + np.arange(len(own)) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.maximum(a[own] - (step + 1) * HOT_STEP + 1, s[own])
    last = np.minimum(a[own] - step * HOT_STEP, s[own] + n[own] - 1)
    key = mix(k[own] + step.astype(np.uint64) + np.uint64(1)) & KEY_BITS
    return tuple(np.concatenate((x[~hot], y)) for x, y in ((start, first), (count, last - first + 1), (at, a[own]), (keys, key)))


def repeated_starts(keys: np.ndarray, left: np.ndarray, length: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, column) of every string start that another document of its key repeats at the same column."""
    m = len(keys)
    right = left + length                                   # column behind the last symbol
    first, columns = int(left.min()), int(right.max() - left.min())
    begin = np.cumsum(length) - length
    found: list[tuple[np.ndarray, np.ndarray]] = []
    with tempfile.TemporaryFile() as file:
        # the external file: a symbol of every document per column, the last column first
        for column in range(columns - 1, -1, -1):
            q = column + first
            held = (left <= q) & (q < right)
            symbols = np.zeros(m, np.uint8)
            symbols[held] = data[begin[held] + q - left[held]]
            file.write(symbols.tobytes())
        file.seek(0)
        group = np.unique(keys, return_inverse=True)[1].astype(np.int64)
        order, common = np.zeros(0, np.int64), np.zeros(0, np.int64)
        entering = np.argsort(-right, kind="stable")
        entry = np.append(np.searchsorted(-right[entering], -np.arange(first + columns, first - 1, -1), "left"), m)
        for turn, q in enumerate(range(first + columns - 1, first - 1, -1)):
            symbols = np.frombuffer(file.read(m), np.uint8)
            stay = left[order] <= q
            if not stay.all():
                kept = np.flatnonzero(stay)
                if len(kept):
                    common = np.minimum.reduceat(common[:kept[-1] + 1], np.concatenate(([0], kept[:-1] + 1)))
                else:
                    common = common[:0]
                order = order[kept]
            new = entering[entry[turn]:entry[turn + 1]]
            if len(new):            # with nothing behind them they come first in their group
                order, common = np.concatenate((new, order)), np.concatenate((np.zeros(len(new), np.int64), common))
                place = np.argsort(group[order], kind="stable")
                order, common = order[place], common[place]
            if not len(order):
                continue
            value = group[order] * 256 + symbols[order]
            place = np.argsort(value, kind="stable")
            value = value[place]
            alike = value[1:] == value[:-1]
            between = np.empty(2 * (len(place) - 1), np.int64)
            between[0::2], between[1::2] = place[:-1] + 1, place[1:] + 1
            least = np.minimum.reduceat(np.append(common, 0), between)[0::2] if len(place) > 1 else np.zeros(0, np.int64)
            order = order[place]
            common = np.concatenate(([0], np.where(alike, np.minimum(least + 1, WINDOW), 0)))
            again = common >= WINDOW
            again[:-1] |= again[1:]
            again &= q + WINDOW <= right[order]
            hit = order[again]
            if len(hit):
                found.append((hit, np.full(len(hit), q)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _repeats(documents: DataFrame) -> DataFrame:
    """Per chunk and range the runs of repeated string starts: packed (start, starts)."""
    schema = pa.schema([("chunk", pa.int64()), ("range", pa.int64()), ("blob", pa.binary())])

    def run(batches):
        for group in groups(batches, "range"):
            parts = [unpack(b) for b in group.column("blob").to_pylist()]
            keys, left, length, data = (np.concatenate([p[c] for p in parts]) for c in ("keys", "left", "length", "data"))
            left, length = left.astype(np.int64), length.astype(np.int64)
            document, column = repeated_starts(keys, left, length, data)
            cut = np.cumsum([0] + [len(p["keys"]) for p in parts])
            flags = np.zeros(int((length - WINDOW + 1).sum()) + 1, bool)
            base = np.cumsum(length - WINDOW + 1) - (length - WINDOW + 1)
            flags[base[document] + column - left[document]] = True
            for i, (chunk, r) in enumerate(zip(group.column("chunk").to_pylist(), group.column("range").to_pylist(), strict=True)):
                use, place = parts[i]["use"].astype(np.int64) + cut[i], parts[i]["place"].astype(np.int64)
                often = np.bincount(use, minlength=len(keys)) > 1           # the same document twice in a chunk
                n = (length - WINDOW + 1)[use]
                own = np.repeat(np.arange(len(use)), n)
                step = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
                on = flags[base[use[own]] + step] | often[use[own]]
                starts = np.unique((place[own] + step)[on])
                if len(starts):
                    head = np.flatnonzero(np.diff(starts, prepend=-9) != 1)
                    yield pa.RecordBatch.from_pylist([{"chunk": chunk, "range": r, "blob": pack(
                        start=starts[head].astype(np.uint32),
                        count=np.diff(np.append(head, len(starts))).astype(np.uint32))}], schema)

    return whole_groups(documents, "range", "chunk").mapInArrow(run, "chunk long, range long, blob binary")


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row, and with ``keep_text`` the remaining bytes as ``kept``.

    Removed is every byte covered by a 200-byte string that also starts anywhere else in the table, overlapping ones of the
    same row included. A null text is empty; repeated rows repeat each other; null ids are kept. An empty table gives no
    rows; other columns are ignored. A cut may fall inside a character, so what is kept is bytes.
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    chunks = pack_documents(source, "doc_id", "text", chunk_bytes=CHUNK)
    bits = power_of_two(total_bytes(chunks) / RANGE_BYTES, LEAST_RANGES).bit_length() - 1
    repeated = _repeats(_documents(_with_chunks(chunks, _answers(_questions(chunks, bits))), bits))
    extra = [("kept", pa.binary())] if keep_text else []
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept_sha256", pa.string()), *extra])

    def run(batches):
        for group in groups(batches, "chunk"):
            blobs = group.column("blob").to_pylist()
            ids, buffer = unpack_documents(blobs[0])
            change = np.zeros(len(buffer.data) + 1, np.int32)
            for blob in blobs[1:]:
                got = unpack(blob)
                start, end = got["start"].astype(np.int64), got["start"].astype(np.int64) + got["count"] + (WINDOW - 1)
                np.add.at(change, start, 1)
                np.add.at(change, end, -1)
            covered = np.cumsum(change[:-1]) > 0
            rows = []
            for id_, a, n in zip(ids, buffer.starts.tolist(), buffer.lengths.tolist(), strict=True):
                gone = covered[a:a + n]
                kept = buffer.data[a:a + n][~gone].tobytes()
                row = {"doc_id": id_, "n_bytes": n, "n_removed": n - len(kept),
                       "n_spans": int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)),
                       "kept_sha256": hashlib.sha256(kept).hexdigest()}
                rows.append(row | {"kept": kept} if keep_text else row)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    return _with_chunks(chunks, repeated).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text)
