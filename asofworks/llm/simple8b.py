"""Simple-8b: integers in 64-bit words, as many to a word as fit, for arrays at once.

The upper four bits of a word choose how many values of how many bits its
lower 60 bits hold.  Values are cut into blocks of ``BLOCK``; a block starts
with a new word, and the index of its first word is kept, so blocks can be
coded and read independently.  A value over 60 bits is an escape: selector
``ESCAPE``, with its place in a separate list of whole values.
"""

from __future__ import annotations

import numpy as np

#: Values in a block.
BLOCK = 256
#: How many values a word of each selector holds, and of how many bits; selector 14 is the escape.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1], np.int64)
BITS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60], np.int64)
ESCAPE = 14


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits each value takes (0 for 0)."""
    return np.searchsorted(np.uint64(1) << np.arange(64, dtype=np.uint64), values, "right").astype(np.uint8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, index of each block's first word, escaped values) of unsigned integers."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    rows = -(-n // BLOCK)
    bits = np.zeros((rows, BLOCK + 60), np.uint8)
    flat = np.zeros(rows * BLOCK, np.uint8)
    flat[:n] = _bit_lengths(values)
    bits[:, :BLOCK] = flat.reshape(rows, BLOCK)
    # The most values, from each place on, that fit one word; what lies behind a block's end takes no bits.
    most = bits[:, :BLOCK].copy()
    chosen = np.full((rows, BLOCK), ESCAPE, np.uint8)
    sizes = {int(c): k for k, c in enumerate(COUNTS[:ESCAPE])}
    for count in range(1, 61):
        if count > 1:
            np.maximum(most, bits[:, count - 1 : count - 1 + BLOCK], out=most)
        if count in sizes:
            k = sizes[count]
            chosen[most <= BITS[k]] = k
    length = np.full(rows, BLOCK)
    length[-1] = n - (rows - 1) * BLOCK
    first = np.zeros((rows, BLOCK), bool)
    row, at = np.arange(rows), np.zeros(rows, np.int64)
    while len(row):
        first[row, at] = True
        at = at + COUNTS[chosen[row, at]]
        on = at < length[row]
        row, at = row[on], at[on]
    flags = first.ravel()[:n]
    starts = np.flatnonzero(flags)
    selector = chosen.ravel()[starts].astype(np.int64)
    held = np.diff(np.append(starts, n))
    shift = (np.arange(n) - np.repeat(starts, held)) * np.repeat(BITS[selector], held)
    escaped = selector == ESCAPE
    escapes = values[starts[escaped]]
    payload = values
    if escaped.any():
        payload = values.copy()
        payload[starts[escaped]] = np.arange(len(escapes), dtype=np.uint64)
    words = np.bitwise_or.reduceat(payload << shift.astype(np.uint64), starts)
    words |= selector.astype(np.uint64) << np.uint64(60)
    return words, np.searchsorted(starts, np.arange(rows) * BLOCK).astype(np.uint32), escapes


def decode(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The n values that encode() made these of."""
    if not n:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    held = COUNTS[selector].copy()
    length = np.full(len(offsets), BLOCK)
    length[-1] = n - (len(offsets) - 1) * BLOCK
    last = np.append(offsets[1:], len(words)).astype(np.int64) - 1
    held[last] -= np.add.reduceat(held, offsets.astype(np.int64)) - length
    starts = np.concatenate([[0], np.cumsum(held)[:-1]])
    bits = BITS[selector]
    shift = (np.arange(n) - np.repeat(starts, held)) * np.repeat(bits, held)
    mask = (np.uint64(1) << bits.astype(np.uint64)) - np.uint64(1)
    out = (np.repeat(words, held) >> shift.astype(np.uint64)) & np.repeat(mask, held)
    escaped = selector == ESCAPE
    if escaped.any():
        out[starts[escaped]] = escapes[words[escaped] & mask[escaped]]
    return out
