"""Word and shingle hashes of whole Arrow batches, in numpy.

A word's hash comes from prefix sums of byte * base**position modulo 2**64, so a batch costs a fixed number of array
operations, whatever its number of texts. Buffers are worked through in pieces cut at blanks, so a very long text needs
little more memory than its word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 512 << 10
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        up, down = np.full(size, _BASE), np.full(size, _INVERSE)
        up[0] = down[0] = 1
        _powers[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[size]


def slices(batch: pa.RecordBatch, column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose column holds at most so many bytes (or single rows)."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for k, n in enumerate(sizes):
        if total and total + n > most:
            yield batch.slice(start, k - start)
            start, total = k, 0
        total += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null counts as empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    raw = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[raw[0] : raw[-1]]
    return data, raw - raw[0]


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the words' row offsets: the words of row i are those from offsets[i] to offsets[i + 1]."""
    found, starts_at = [], []
    at = 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        if end < len(data):  # cut after a blank or between rows
            blank = _blank(data[at:end])
            cut = int(np.flatnonzero(blank)[-1]) + at + 1 if blank.any() else at
            row = int(offsets[np.searchsorted(offsets, end, "right") - 1])
            cut = max(cut, row)
            while cut <= at:  # one word longer than a piece: take it whole
                end = min(len(data), end + PIECE)
                blank = _blank(data[end - PIECE : end])
                after = np.flatnonzero(blank)
                row = int(offsets[min(np.searchsorted(offsets, at, "right"), len(offsets) - 1)])
                cut = min([x for x in (int(after[0]) + max(end - PIECE, 0) + 1 if len(after) else len(data) + 1, row if row > at else len(data) + 1, len(data) if end == len(data) else len(data) + 1) if x > at], default=0)
                cut = 0 if cut > end else cut
            end = cut
        first, last = np.searchsorted(offsets, [at, end], "left")
        h, s = _words(data[at:end], offsets[first:last] - at, lower)
        found.append(h)
        starts_at.append(s + at)
        at = end
    if not found:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(found), np.searchsorted(np.concatenate(starts_at), offsets, "left")


def _blank(b: np.ndarray) -> np.ndarray:
    return (b == 32) | ((b >= 9) & (b <= 13))


def _words(b: np.ndarray, breaks: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    inside = ~_blank(b)
    edge = np.empty(len(b) + 1, bool)
    edge[0], edge[-1] = inside[0], inside[-1]
    edge[1:-1] = inside[1:] != inside[:-1]
    starts_mask = edge[:-1] & inside
    ends_mask = edge[1:] & inside
    cuts = breaks[(breaks > 0) & (breaks < len(b))]
    cuts = cuts[inside[cuts] & inside[cuts - 1]]
    starts_mask[cuts] = True
    ends_mask[cuts - 1] = True
    starts, ends = np.flatnonzero(starts_mask), np.flatnonzero(ends_mask) + 1
    if lower:
        b = b + (((b >= 65) & (b <= 90)) * np.uint8(32))
    up, down = powers(len(b))
    sums = np.empty(len(b) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), starts


def shingles(hashes: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each row's shingles; of fewer words than width, the whole sequence is the one shingle."""
    factors = [np.uint64(pow(0xC2B2AE3D27D4EB4F, k + 1, 1 << 64)) for k in range(width)]
    n = len(hashes) - width + 1
    if n > 0:
        rolled = hashes[:n] * factors[0]
        for k in range(1, width):
            rolled += hashes[k : n + k] * factors[k]
        rolled = mix(rolled)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= width:
            yield np.unique(rolled[a : b - width + 1])
        elif b > a:
            short = np.uint64(0)
            with np.errstate(over="ignore"):
                for k in range(b - a):
                    short += hashes[a + k] * factors[k]
                yield mix(np.array([short + np.uint64(b - a)], np.uint64))
        else:
            yield np.empty(0, np.uint64)


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    data, offsets = buffer_of(texts)
    return list(shingles(*words(data, offsets), width))
