"""Whole Arrow batches of text as numpy arrays: tokens, hashes, counts.

The helpers work on slices of a batch that hold a bounded number of bytes (or
one document, when it alone is longer), so memory follows the slice and not
the table. Null texts count as empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

#: 0 white space, 1 word bytes (letters, digits, underscore, all non-ASCII), 2 other
WORD_OR_PUNCTUATION = np.full(256, 2, np.uint8)
WORD_OR_PUNCTUATION[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = 1
WORD_OR_PUNCTUATION[SPACE] = 0

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def chunks(texts: pa.Array, max_bytes: int = 1 << 20, max_rows: int = 4096
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices (first row, end row, bytes, offsets of rows in these bytes)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return
    wide = pa.types.is_large_string(texts.type)
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), lo + max_rows, len(texts))
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the flags of each row."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def tokens(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray = ~SPACE
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of one non-zero byte class within a row: (starts, ends, token offsets of rows)."""
    kind = classes[data].astype(np.int8)
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    full = kind[starts] != 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[full], ends[full]
    return starts, ends, np.searchsorted(starts, offsets)


_HEAD = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
LONG_SPAN = 512


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, 8 bytes at a time; a cryptographic one of long spans."""
    size = ends - starts
    h = mix(size.astype(np.uint64) + np.uint64(_BASE))
    if not len(h):
        return h
    eight = np.lib.stride_tricks.as_strided(np.concatenate([data, np.zeros(8, np.uint8)]).view(np.uint8),
                                            (len(data) + 1, 8), (1, 1)).copy().view(np.uint64).ravel()
    rest = np.flatnonzero((size > 0) & (size <= LONG_SPAN))
    done = 0
    while len(rest):
        left = size[rest] - done
        part = eight[starts[rest] + done] & _HEAD[np.minimum(left, 8)]
        h[rest] = mix(h[rest] * np.uint64(_BASE) + part)
        rest, done = rest[left > 8], done + 8
    for i in np.flatnonzero(size > LONG_SPAN):
        digest = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest()
        h[i] = np.uint64(int.from_bytes(digest, "little"))
    return h


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, a position of each, and each position's number among them."""
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(first) - 1
    return ordered[first], order[first], number


def windows(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive tokens of a row, and their row offsets.

    A row of fewer tokens, but at least one, gives its whole sequence.
    """
    count = np.diff(offsets)
    made = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    out = np.zeros(len(made) + 1, np.int64)
    np.cumsum(made, out=out[1:])
    if not len(hashes):
        return np.zeros(0, np.uint64), out
    row = np.repeat(np.arange(len(made)), made)
    at = np.arange(int(out[-1])) - out[:-1][row] + offsets[:-1][row]
    end = offsets[1:][row]
    h = np.zeros(len(at), np.uint64)
    for k in range(n):
        here = at + k
        inside = here < end
        part = hashes[np.minimum(here, len(hashes) - 1)]
        h = np.where(inside, mix(h * np.uint64(_BASE) + part + np.uint64(k + 1)), h)
    return h, out
