"""Flat numpy views of Arrow text columns: words, range hashes and byte gathers without a Python loop over characters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_M64 = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be divided out again
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_ZSTD = pa.Codec("zstd", compression_level=6)
NO_ID = np.iinfo(np.int64).max


def one_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    return column


def flat_text(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is an empty text."""
    a = pc.fill_null(one_array(column).cast(pa.large_string()), "")
    a = one_array(a)
    if not len(a):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(a.buffers()[1], np.int64, len(a) + 1, a.offset * 8)
    data = a.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def id_array(column) -> np.ndarray:
    """int64 ids; a missing id sorts after all others."""
    return pc.fill_null(one_array(column).cast(pa.int64()), NO_ID).to_numpy(zero_copy_only=False)


def byte_class(spans: list[tuple[int, int]], inside: bool = True) -> np.ndarray:
    """Lookup table: which of the 256 byte values lie in one of the closed spans (or in none)."""
    table = np.full(256, not inside)
    for low, high in spans:
        table[low:high + 1] = inside
    return table


class Words:
    """Byte ranges of the words of flat text; ``first[d]:first[d + 1]`` are the words of document d."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        m = is_word[data]
        inner = offsets[1:-1][offsets[1:-1] < len(data)]
        before = np.empty_like(m)
        before[:1], before[1:] = False, m[:-1]
        before[inner] = False
        after = np.empty_like(m)
        after[-1:], after[:-1] = False, m[1:]
        after[inner[inner > 0] - 1] = False
        self.start = np.flatnonzero(m & ~before)
        self.end = np.flatnonzero(m & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)

    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)


_cached: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n of the base and of its inverse; the longest tables made so far are kept."""
    if len(_cached[0]) <= n:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            out = np.full((n | 0xFFFF) + 1, base, np.uint64)
            out[0] = 1
            _cached[i] = np.cumprod(out, out=out)
    return _cached[0], _cached[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


class RangeHash:
    """64-bit hashes of any byte ranges of ``data`` from one running sum."""

    def __init__(self, data: np.ndarray, values: np.ndarray = _BYTE):
        power, self.inverse = powers(len(data))
        self.total = np.zeros(len(data) + 1, np.uint64)
        inner = self.total[1:]
        np.take(values, data, out=inner)
        inner *= power[:len(data)]
        np.cumsum(inner, out=inner)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.total[end] - self.total[start]) * self.inverse[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def spans_index(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of all elements of the ranges [start, start + size), one range after the other."""
    size = size.astype(np.int64)
    shift = start.astype(np.int64) - (np.cumsum(size) - size)
    return np.repeat(shift, size) + np.arange(int(size.sum()))


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    return data[spans_index(start, size)]


def equal_ranges(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray, step: int = 1 << 21) -> np.ndarray:
    """Whether data[a:a + size] equals data[b:b + size], element by element, in pieces of about ``step`` bytes."""
    out = np.ones(len(a), bool)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(size) // step)) + 1, [len(a)]])
    for i, j in zip(cuts[:-1], cuts[1:]):
        if j <= i:
            continue
        n = size[i:j].astype(np.int64)
        differs = gather(data, a[i:j], n) != gather(data, b[i:j], n)
        some = n > 0
        if differs.any():
            begin = (np.cumsum(n) - n)[some]
            out[i:j][some] = ~np.logical_or.reduceat(differs, begin)
    return out


def covered(begin: np.ndarray, width: int, total: int) -> np.ndarray:
    """Which of ``total`` positions lie in one of the ranges [begin, begin + width); the starts are distinct."""
    change = np.zeros(total + width + 1, np.int32)
    change[begin] += 1
    change[begin + width] -= 1
    return np.cumsum(change[:total]) > 0


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum over ``width`` consecutive values, for each start that has as many."""
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def pieces(batch: pa.RecordBatch | pa.Table, column: str, limit: int = 4 << 20) -> Iterator[pa.Table]:
    """Slices of a batch with about ``limit`` bytes of text each; a longer text is a slice of its own."""
    table = pa.Table.from_batches([batch]) if isinstance(batch, pa.RecordBatch) else batch
    size = pc.fill_null(pc.binary_length(one_array(table[column])), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    total = np.cumsum(size + 64)
    while at < len(size):
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + limit, "right")))
        yield table.slice(at, to - at)
        at = to


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one row each as one compressed string."""
    head = np.array([len(arrays), *[a.nbytes for a in arrays]], np.int64).tobytes()
    body = head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return len(body).to_bytes(8, "little") + _ZSTD.compress(body, asbytes=True)


def unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    body = _ZSTD.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), asbytes=True)
    n = int.from_bytes(body[:8], "little")
    sizes = np.frombuffer(body, np.int64, n, 8)
    out, at = [], 8 * (n + 1)
    for size, kind in zip(sizes, kinds):
        out.append(np.frombuffer(body, kind, int(size) // np.dtype(kind).itemsize, at))
        at += int(size)
    return out
