"""Quality rules: repetition within a document from its suffix array.

Each slice of documents gets one suffix array over word numbers, made by
prefix doubling: the document number is the first sort key, so suffixes of two
documents never tie, and a suffix leaves the sort as soon as no other shares
its prefix. The longest common prefixes of neighbours come from the ranks kept
for each doubling. LCP intervals that are not preceded by one common word are
the maximal repeated substrings. The union of their spans and the longest of
them are limited.

Edge cases: a null or empty text has no words and fails the base rule; a text
of any length is taken whole; equal rows give equal rows; an empty table gives
an empty result; only ``id_col`` and ``text_col`` are read, so other columns
can have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from slipway.llm.arrays import SPACE, chunks, distinct, hash_spans, per_row, tokens

BASE_WINDOW = 8
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

FIELDS = (("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"),
          ("n_dup_lines", "long"), ("n_repeat_words", "long"), ("base_failed", "boolean"),
          ("kept", "boolean"), ("n_repeats", "long"), ("covered_chars", "long"),
          ("longest_repeat", "long"))


def suffix_array(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order (rows first), and the rank of each word's prefix of 2**k words for each k."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64), []
    count = np.diff(offsets)
    end = np.repeat(offsets[1:], count)
    key = np.repeat(np.arange(len(count)), count) * (int(codes.max()) + 1) + codes
    slots, sa, rank = np.arange(n), np.arange(n), np.zeros(n, np.int64)
    levels, step = [], 0
    while len(slots):
        s = sa[slots]
        if step:
            after = s + step
            key = np.where(after < end[s], rank[np.minimum(after, n - 1)], -1) + 1 + rank[s] * (n + 1)
        order = np.argsort(key, kind="stable")
        key, s = key[order], s[order]
        sa[slots] = s
        first = np.ones(len(s) + 1, bool)
        first[1:-1] = key[1:] != key[:-1]
        rank = rank.copy()
        rank[s] = slots[np.maximum.accumulate(np.where(first[:-1], np.arange(len(s)), 0))]
        levels.append(rank.astype(np.int32))
        slots = slots[~(first[:-1] & first[1:])]
        step = max(1, 2 * step)
    return sa, levels


def common_prefixes(sa: np.ndarray, levels: list[np.ndarray], least: int) -> np.ndarray:
    """lcp[i] of suffixes i-1 and i in order, as far as it is ``least`` words or more, else 0."""
    n = len(sa)
    lcp = np.zeros(n + 1, np.int64)
    floor = max(0, least.bit_length() - 1)
    if len(levels) <= floor:
        return lcp
    at = np.flatnonzero(levels[floor][sa[1:]] == levels[floor][sa[:-1]]) + 1
    a, b = sa[at - 1], sa[at]
    size = np.zeros(len(at), np.int64)
    for k in reversed(range(len(levels))):
        x, y = a + size, b + size
        inside = np.maximum(x, y) < n
        same = inside & (levels[k][np.where(inside, x, 0)] == levels[k][np.where(inside, y, 0)])
        size += same.astype(np.int64) << k
    lcp[at] = np.where(size >= least, size, 0)
    return lcp


def lcp_intervals(lcp: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Maximal slot ranges (first, last, common words) whose neighbours share that many words."""
    hot = np.flatnonzero(lcp)
    for run in np.split(hot, np.flatnonzero(np.diff(hot) > 1) + 1) if len(hot) else ():
        stack: list[tuple[int, int]] = []
        for i, size in zip(run.tolist(), lcp[run].tolist()):
            left = i - 1
            while stack and stack[-1][1] > size:
                left, longer = stack.pop()
                yield left, i - 1, longer
            if not stack or stack[-1][1] < size:
                stack.append((left, size))
        for left, size in reversed(stack):
            yield left, int(run[-1]), size


def maximal_repeats(codes: np.ndarray, offsets: np.ndarray, sa: np.ndarray, lcp: np.ndarray
                    ) -> Iterator[tuple[np.ndarray, int]]:
    """(word positions, length in words) of every repeat that can't be extended to either side."""
    before = np.where(np.isin(sa, offsets), -1, codes[np.maximum(sa - 1, 0)])
    change = np.zeros(len(sa), np.int64)
    np.cumsum(before[1:] != before[:-1], out=change[1:])
    for first, last, size in lcp_intervals(lcp):
        if change[last] > change[first]:
            yield sa[first:last + 1], size


def union(starts: np.ndarray, size: np.ndarray | int, n: int) -> np.ndarray:
    """Flags of the words within any of the spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return np.cumsum(edge[:-1]) > 0


def duplicate_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    raw, out = data.tobytes(), np.zeros(len(offsets) - 1, np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        lines = raw[a:b].split(b"\n")
        if len(distinct := set(lines)) < len(lines):
            blank = [x for x in distinct if not x.split()]
            worded = len(lines) - sum(map(lines.count, blank))
            out[i] = worded - (len(distinct) - len(blank))
    return out


def measure(data: np.ndarray, offsets: np.ndarray, min_words: int, max_covered: float,
            max_longest: int, min_base_words: int = 20) -> dict[str, np.ndarray]:
    starts, ends, rows = tokens(data, offsets)
    codes = distinct(hash_spans(data, starts, ends))[2]
    n, count = len(codes), np.diff(rows)
    sa, levels = suffix_array(codes, rows)
    lcp = common_prefixes(sa, levels, min(BASE_WINDOW, min_words))
    near = np.maximum(lcp[:-1], lcp[1:])
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~SPACE[data] & ((data & 0xC0) != 0x80), out=points[1:])
    chars = points[ends] - points[starts]
    # a word is in some maximal repeat exactly if it is in the longest repeat from some position
    covered = union(sa[near >= min_words], near[near >= min_words], n)
    out = {"n_words": count, "word_chars": per_row(chars, rows),
           "n_symbols": per_row(SYMBOL[data], offsets),
           "n_dup_lines": duplicate_lines(data, offsets),
           "n_repeat_words": per_row(union(sa[near >= BASE_WINDOW], BASE_WINDOW, n), rows),
           "covered_chars": per_row(np.where(covered, chars, 0), rows)}
    owner = np.repeat(np.arange(len(count)), count)
    longest, repeats = np.zeros(len(count), np.int64), np.zeros(len(count), np.int64)
    for at, size in maximal_repeats(codes, rows, sa, np.where(lcp >= min_words, lcp, 0)):
        row = owner[at[0]]
        repeats[row] += 1
        longest[row] = max(longest[row], size)
    out |= {"longest_repeat": longest, "n_repeats": repeats}
    out["base_failed"] = (count < min_base_words) | (100 * out["n_repeat_words"] > 30 * count)
    out["kept"] = ~(out["base_failed"] | (longest > max_longest)
                    | (out["covered_chars"] > max_covered * out["word_chars"]))
    return out


def repetition_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     min_words: int = 8, max_covered: float = 0.3, max_longest: int = 100,
                     slice_bytes: int = 1 << 20) -> DataFrame:
    """One row per row of ``docs`` with the measures of ``FIELDS``.

    A repeat counts from ``min_words`` words. ``kept`` is false if the base
    rule fails, if repeats cover more than ``max_covered`` of the characters
    in words, or if one repeat is longer than ``max_longest`` words.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def rules(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, offsets in chunks(batch.column(1), slice_bytes):
                found = measure(data, offsets, min_words, max_covered, max_longest)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), *(pa.array(found[f]) for f, _ in FIELDS)],
                    [id_col, *(f for f, _ in FIELDS)])

    return docs.select(id_col, text_col).mapInArrow(
        rules, f"{id_col} {kind}, " + ", ".join(f"{f} {t}" for f, t in FIELDS))


def keep(docs: DataFrame, text_col: str = "text", min_words: int = 8, max_covered: float = 0.3,
         max_longest: int = 100, slice_bytes: int = 1 << 20) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep."""
    def rules(batches):
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(text_col), slice_bytes):
                found = measure(data, offsets, min_words, max_covered, max_longest)
                yield batch.slice(lo, hi - lo).filter(pa.array(found["kept"]))

    return docs.mapInArrow(rules, docs.schema)
