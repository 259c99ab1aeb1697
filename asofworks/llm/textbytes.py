"""Array helpers for whole texts: words, hashes and shingles of an Arrow batch at once.

A batch of texts is one run of bytes with offsets.  Words are found and hashed
with array operations over that run, so no Python code runs per word.  Work is
cut into blocks of whole texts of about ``BLOCK`` bytes; memory is some 60
bytes for each byte of a block, or of the longest text where that is longer.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once (a longer text makes its own block).
BLOCK = 1 << 20

#: Bytes between words: space, and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_P = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_ROWS = np.random.default_rng(20240607).integers(0, 1 << 64, 256, np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64; grown when needed."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            run = np.full(max(n, BLOCK + 1), base, np.uint64)
            run[0] = 1
            have = _POWERS[int(base)] = np.cumprod(run, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser, element by element."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column and where each begins; null is empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of whole texts of about limit bytes."""
    if not len(column):
        return
    data, offsets = text_bytes(column)
    at = 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def give_back() -> None:
    """Let the system have the memory that Arrow and numpy have freed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(each: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """each, for mapInArrow, with freed memory given back after each batch and at the end.

    A Python worker waits for its next task for a minute and is used again, so
    what it holds then comes on top of the memory of the JVM's next stages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                give_back()

        yield from each(given())
        give_back()

    return run


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of True that end where a text ends: starts, ends, and the text of each."""
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, none
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    first = offsets[:-1]
    before[first[first < len(inside)]] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes; equal bytes give equal hashes anywhere."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_ROWS[data] * _powers(_P, len(data)), out=sums[1:])
        found = (sums[ends] - sums[starts]) * _powers(_P_INV, len(data) + 1)[starts]
        return mix(found + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased (A-Z) words of each text, and where each text's words begin."""
    starts, ends, text = spans(~SPACE[data], offsets)
    hashes = span_hashes(LOWER[data], starts, ends)
    return hashes, np.searchsorted(text, np.arange(len(offsets)), "left")


def shingles(hashes: np.ndarray, begin: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of width words within each text (all words where they are fewer), and where each text's begin.

    A text without words has none.
    """
    count = np.diff(begin)
    with np.errstate(over="ignore"):
        step = np.uint64(0xD6E8FEB86659FD93)
        n = len(hashes)
        whole = np.zeros(max(n - width + 1, 0), np.uint64)
        for k in range(width):
            whole = whole * step + hashes[k : n - width + 1 + k] if len(whole) else whole
        made = np.maximum(count - width + 1, np.minimum(count, 1))
        to = np.concatenate([[0], np.cumsum(made)])
        source = np.arange(to[-1]) - np.repeat(to[:-1] - begin[:-1], made)
        out = np.zeros(to[-1], np.uint64)
        full = np.repeat(count >= width, made)
        out[full] = whole[source[full]]
        for row in np.flatnonzero((count > 0) & (count < width)):
            value = np.uint64(0)
            for h in hashes[begin[row] : begin[row + 1]]:
                value = value * step + h
            out[to[row]] = value + np.uint64(count[row])
        return mix(out), to
