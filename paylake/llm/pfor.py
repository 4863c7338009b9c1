"""Token files: patched frame-of-reference blocks with an index.

Ids are cut into blocks of 1,024. A block stores its minimum, and the
differences to it packed at a width that holds a percentile of them; where a
difference is wider, its position and high bits are in the block's exception
list. Of a few percentiles the one with the smallest block is taken.

File layout, all little-endian::

    magic, the packed blocks, then the index:
    start of every block (u64), minimum (u32), width (u8), exceptions (u16),
    then per document its id (i64), whether the id is NULL (u8), and its first
    position in the file (u64, one more for the end); last the counts of
    blocks, documents and ids, the index's start (u64 each) and the magic

A block's bytes are 32 groups of 32 differences, ``width`` u32 words each,
then the exceptions' positions (u16) and high bits (u32). The last block is
filled up with its own minimum.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"PFORTOK1"
BLOCK = 1024
PERCENTILES = (85, 90, 95, 98, 100)
_TAIL = struct.Struct("<4Q8s")
# Blocks packed or unpacked at once.
_BATCH = 512


def ranges_of(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... counts[i] numbers for every i, as one array."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)


def _widths(bits: np.ndarray) -> np.ndarray:
    """The percentile width with the smallest size, for each row of bit lengths."""
    ordered = np.sort(bits, axis=1)
    best = size = None
    for p in PERCENTILES:
        w = ordered[:, -(-BLOCK * p // 100) - 1].astype(np.int64)
        s = BLOCK // 8 * w + 6 * (bits > w[:, None]).sum(axis=1)
        if best is None:
            best, size = w, s
        else:
            best, size = np.where(s < size, w, best), np.minimum(s, size)
    return best


def pack(ids: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whole blocks of ids: their bytes, and start, minimum, width, exceptions of each."""
    blocks = ids.reshape(-1, BLOCK)
    low = blocks.min(axis=1)
    diff = blocks - low[:, None]
    bits = np.frexp(diff.astype(np.float64))[1].astype(np.uint8)
    width = _widths(bits)
    over = bits > width[:, None]
    n_over = over.sum(axis=1)
    size = BLOCK // 8 * width + 6 * n_over
    start = np.concatenate([[0], np.cumsum(size)])[:-1]
    out = np.zeros(int(size.sum()), np.uint8)
    for w in np.unique(width).tolist():
        mine = np.flatnonzero(width == w)
        if w:
            mask = np.uint32((1 << w) - 1)
            v = (diff[mine] & mask).reshape(-1, 32, 32)
            words = np.zeros((len(mine), 32, w), np.uint32)
            for i in range(32):
                at, shift = divmod(i * w, 32)
                words[:, :, at] |= v[:, :, i] << np.uint32(shift)
                if shift + w > 32:
                    words[:, :, at + 1] |= v[:, :, i] >> np.uint32(32 - shift)
            out[start[mine, None] + np.arange(BLOCK // 8 * w)] = words.reshape(len(mine), -1).view(np.uint8)
    row, col = np.nonzero(over)
    if len(row):
        tail = start + BLOCK // 8 * width
        at = ranges_of(np.zeros_like(n_over), n_over)
        pos = np.ascontiguousarray(col.astype("<u2")).view(np.uint8).reshape(-1, 2)
        high = (diff[row, col].astype(np.uint64) >> width[row].astype(np.uint64)).astype("<u4")
        out[(tail[row] + 2 * at)[:, None] + np.arange(2)] = pos
        out[(tail[row] + 2 * n_over[row] + 4 * at)[:, None] + np.arange(4)] = high.view(np.uint8).reshape(-1, 4)
    return out.tobytes(), start, low, width, n_over


def unpack(raw: np.ndarray, start: np.ndarray, low: np.ndarray, width: np.ndarray, n_over: np.ndarray) -> np.ndarray:
    """The ids of the blocks that ``start`` .. describe, ``raw`` holding their bytes."""
    out = np.zeros((len(start), BLOCK), np.uint32)
    for w in np.unique(width).tolist():
        mine = np.flatnonzero(width == w)
        if w:
            words = np.ascontiguousarray(raw[start[mine, None] + np.arange(BLOCK // 8 * w)]) \
                .view("<u4").reshape(len(mine), 32, w)
            mask = np.uint32((1 << w) - 1)
            v = np.empty((len(mine), 32, 32), np.uint32)
            for i in range(32):
                at, shift = divmod(i * w, 32)
                x = words[:, :, at] >> np.uint32(shift)
                if shift + w > 32:
                    x = x | (words[:, :, at + 1] << np.uint32(32 - shift))
                v[:, :, i] = x & mask
            out[mine] = v.reshape(len(mine), BLOCK)
    if n_over.sum():
        row = np.repeat(np.arange(len(start)), n_over)
        tail = start + BLOCK // 8 * width
        at = ranges_of(np.zeros_like(n_over), n_over)
        pos = np.ascontiguousarray(raw[(tail[row] + 2 * at)[:, None] + np.arange(2)]).view("<u2").ravel()
        high = np.ascontiguousarray(raw[(tail[row] + 2 * n_over[row] + 4 * at)[:, None] + np.arange(4)]) \
            .view("<u4").ravel()
        out[row, pos] |= (high.astype(np.uint64) << width[row].astype(np.uint64)).astype(np.uint32)
    return out + low[:, None]


class TokenFileWriter:
    """Writes one file to a binary stream; documents are added in order."""

    def __init__(self, stream):
        self.stream, self.at = stream, len(MAGIC)
        stream.write(MAGIC)
        self.pending: list[bytes] = []
        self.waiting = 0
        self.index: list[tuple] = []
        self.doc_ids: list[int | None] = []
        self.doc_starts = [0]

    @property
    def n_ids(self) -> int:
        return self.doc_starts[-1]

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.doc_starts.append(self.n_ids + len(ids) // 4)
        self.pending.append(ids)
        self.waiting += len(ids) // 4
        if self.waiting >= _BATCH * BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.pending), "<u4")
        whole = len(ids) // BLOCK * BLOCK
        rest = ids[whole:]
        if last and len(rest):
            ids = np.concatenate([ids, np.full(BLOCK - len(rest), rest.min(), np.uint32)])
            whole, rest = len(ids), rest[:0]
        for i in range(0, whole, _BATCH * BLOCK):
            data, start, low, width, n_over = pack(ids[i:min(whole, i + _BATCH * BLOCK)])
            self.stream.write(data)
            self.index.append((start + self.at, low, width, n_over))
            self.at += len(data)
        self.pending, self.waiting = [rest.tobytes()], len(rest)

    def close(self) -> None:
        self._flush(True)
        start, low, width, n_over = (np.concatenate(x) for x in zip(*self.index)) if self.index else [np.empty(0)] * 4
        ids = [0 if x is None else x for x in self.doc_ids]
        index = b"".join([
            start.astype("<u8").tobytes(), low.astype("<u4").tobytes(), width.astype("u1").tobytes(),
            n_over.astype("<u2").tobytes(), np.array(ids, "<i8").tobytes(),
            np.array([x is None for x in self.doc_ids], "u1").tobytes(), np.array(self.doc_starts, "<u8").tobytes()])
        self.stream.write(index)
        self.stream.write(_TAIL.pack(len(start), len(ids), self.n_ids, self.at, MAGIC))


class TokenFile:
    """Reads one file: the index on opening, then any range of ids or documents."""

    def __init__(self, file, size: int):
        self.file = file
        file.seek(size - _TAIL.size)
        n_blocks, n_docs, self.n_ids, at, magic = _TAIL.unpack(file.read(_TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        file.seek(at)
        raw = file.read(size - _TAIL.size - at)
        out, pos = [], 0
        for kind, n in (("<u8", n_blocks), ("<u4", n_blocks), ("u1", n_blocks), ("<u2", n_blocks),
                        ("<i8", n_docs), ("u1", n_docs), ("<u8", n_docs + 1)):
            out.append(np.frombuffer(raw, kind, n, pos))
            pos += n * np.dtype(kind).itemsize
        self.start, self.low, self.width, self.n_over, ids, nulls, starts = out
        self.doc_ids = [None if null else i for i, null in zip(ids.tolist(), nulls.tolist())]
        self.doc_starts = starts.astype(np.int64)
        self.end = np.append(self.start[1:], at).astype(np.int64)

    def read(self, begin: int, end: int) -> np.ndarray:
        """Ids begin .. end; only the blocks that hold them are read."""
        if begin >= end:
            return np.empty(0, np.uint32)
        i, j = begin // BLOCK, -(-end // BLOCK)
        base = int(self.start[i])
        self.file.seek(base)
        raw = np.frombuffer(self.file.read(int(self.end[j - 1]) - base), np.uint8)
        ids = unpack(raw, self.start[i:j].astype(np.int64) - base, self.low[i:j], self.width[i:j].astype(np.int64),
                     self.n_over[i:j].astype(np.int64))
        return ids.ravel()[begin - i * BLOCK:end - i * BLOCK]

    def documents(self):
        """(doc_id, first position, ids) of every document, some blocks at a time."""
        step = _BATCH * BLOCK
        begin, buffer = 0, np.empty(0, np.uint32)
        for doc_id, s, e in zip(self.doc_ids, self.doc_starts[:-1].tolist(), self.doc_starts[1:].tolist()):
            if e > begin + len(buffer):
                upto = min(self.n_ids, max(e, s + step))
                buffer = np.concatenate([buffer[s - begin:], self.read(begin + len(buffer), upto)])
                begin = s
            yield doc_id, s, buffer[s - begin:e - begin]
