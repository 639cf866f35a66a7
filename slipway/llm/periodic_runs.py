"""Runs: maximal stretches of a text that repeat one block of words at least twice.

The words of a slice of documents are one sequence of hashes with a different
separator after each document. A run of period q is a maximal stretch in which
words q apart are equal, q words of them at least.

* Periods below ``3 * FIRST`` come from a direct scan: one comparison of the
  sequence with itself, moved by the period.
* Longer periods, [3t, 6t) for t = FIRST, 2 FIRST, 4 FIRST ..., come from
  minimizers of that scale. A word is a minimizer if, of the hashes of the t
  words from it and from each of the t next words, the smallest is the first or
  the last. Sequences of t words with a period of t/3 or less take no part;
  then equal minimizers (2t words from them are equal) are more than t/3 apart,
  so each has a bounded number of partners at distances in [3t, 6t). Whether a
  word is a minimizer depends on 2t words only, so minimizers repeat at period
  distance inside a run; every pair seeds one, which is extended both ways.
* A run without a minimizer in its first copy is, in both copies, part of a run
  of a period of t/3 or less, which is known by then. Two such neighbours of
  one period give the seeds: the distances that bring them into phase.

A stretch found with several periods has the smallest one: two periods of a
stretch that is as long as their sum make their common divisor one.

Edge cases: a null or empty text has no words and no run; the hash of no words
is that of the empty text; a text of any length is taken whole, a longer one
than a slice alone; equal rows give equal rows; a null id stays null; an empty
table gives an empty result; only id and text are read, other columns can have
any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipway.llm.arrays import chunks, hash_spans, mix, tokens

LEAST = 12
FIRST = 16
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64((1 << 64) - 1)
FIELDS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def separated(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with a separator after each row, and where rows start."""
    starts = rows + np.arange(len(rows))
    out = mix(np.arange(1, len(words) + len(rows)).astype(np.uint64) * _BASE ^ _LAST)
    out[np.arange(len(words)) + np.repeat(np.arange(len(rows) - 1), np.diff(rows))] = words
    return out, starts


def stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First and one beyond the last place of each run of true values that is long enough."""
    edge = np.flatnonzero(np.diff(equal.view(np.int8), prepend=0, append=0))
    a, b = edge[::2], edge[1::2]
    good = b - a >= least
    return a[good], b[good]


def scanned(seq: np.ndarray, period: int) -> np.ndarray:
    """Runs (start, end, period) by one comparison."""
    if len(seq) <= period:
        return np.zeros((0, 3), np.int64)
    a, b = stretches(seq[period:] == seq[:-period], max(period, LEAST - period))
    return np.stack([a, b + period, np.full(len(a), period)], 1)


class Grams:
    """Hashes of 2**k words from each place, the last level alone kept."""

    def __init__(self, seq: np.ndarray):
        self.size, self.hash = 1, seq

    def double(self) -> np.ndarray:
        """Hashes of twice as many words."""
        h, n = self.hash, self.size
        self.hash, self.size = mix(h[:-n] * _BASE + mix(h[n:] ^ _LAST)), 2 * n
        return self.hash


def minimizers(hashes: np.ndarray, size: int, runs: np.ndarray) -> np.ndarray:
    """Places whose hash, or that ``size`` further, is the least of the hashes in between.

    Places within a run of a period of ``size``/3 or less are left out.
    """
    edge = np.zeros(len(hashes) + 1, np.int64)
    some = runs[(3 * runs[:, 2] <= size) & (runs[:, 1] - runs[:, 0] >= size)]
    np.add.at(edge, np.minimum(some[:, 0], len(hashes)), 1)
    np.add.at(edge, np.minimum(some[:, 1] - size + 1, len(hashes)), -1)
    h = np.where(np.cumsum(edge[:-1]) > 0, _LAST, hashes)
    if len(h) <= size:
        return np.zeros(0, np.int64)
    least, wide = h, 1
    while wide < size:  # sizes are powers of two
        least, wide = np.minimum(least[:-wide], least[wide:]), 2 * wide
    least = np.minimum(least[:len(h) - size], h[size:])
    return np.flatnonzero((least != _LAST) & ((least == h[:-size]) | (least == h[size:])))


def minimizer_seeds(grams: Grams, runs: np.ndarray) -> np.ndarray:
    """(first, end, distance): words first .. end-1 equal those at this distance; distances in [3t, 6t)."""
    t, hashes = grams.size, grams.hash
    at = minimizers(hashes, t, runs)
    keys = grams.double()
    at = at[at < len(keys)]
    at = at[np.argsort(keys[at], kind="stable")]
    key, found, step = keys[at], [], 1
    while step < len(at):
        far = at[step:] - at[:-step]
        near = (key[step:] == key[:-step]) & (far < 6 * t)
        if not near.any():
            break
        good = np.flatnonzero(near & (far >= 3 * t))
        found.append(np.stack([at[good], at[good] + 2 * t, far[good]], 1))
        step += 1
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def neighbour_seeds(seq: np.ndarray, runs: np.ndarray, t: int) -> np.ndarray:
    """Seeds from neighbouring runs of one period of t/3 or less."""
    some = runs[(3 * runs[:, 2] <= t) & (runs[:, 1] - runs[:, 0] >= 3 * t)]
    some = some[np.lexsort((some[:, 0], some[:, 2]))]
    out = []
    p = some[:, 2]
    close = (p[1:] == p[:-1]) & (some[1:, 0] <= some[:-1, 1]) & (some[1:, 0] > some[:-1, 1] - p[1:]) if len(p) else []
    for i in np.flatnonzero(close).tolist():
        (a, end, p_), (b, stop, _) = some[i].tolist(), some[i + 1].tolist()
        block = seq[b:b + p_].tobytes()
        base = end - 2 * p_ + 1
        tail, at = seq[base:end].tobytes(), -1
        while (at := tail.find(block, at + 1)) >= 0 and at % 8:
            pass
        if at < 0:
            continue
        q = b - (base + at // 8)
        q += -(-max(0, 3 * t - q) // p_) * p_
        while q < 6 * t:
            first, last = max(a, b - q), min(end, stop - q)
            if last - first < p_:
                break
            out.append((first, last, q))
            q += p_
    return np.array(out, np.int64).reshape(-1, 3)


def _same(seq: np.ndarray, i: int, q: int, step: int) -> int:
    """How many words from i on, in the direction of ``step``, equal those q further."""
    n, size = 0, 64
    while True:
        if step > 0:
            m = min(size, len(seq) - q - i - n)
            differ = seq[i + n:i + n + m] != seq[i + n + q:i + n + q + m]
        else:
            m = min(size, i - n + 1)
            differ = (seq[i - n - m + 1:i - n + 1] != seq[i - n - m + 1 + q:i - n + 1 + q])[::-1]
        if m <= 0:
            return n
        k = int(differ.argmax())
        if differ[k]:
            return n + k
        n, size = n + m, min(2 * size, 1 << 20)


def extended(seq: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The runs that the seeds are part of; seeds within a stretch already found are passed over."""
    out = []
    seeds = seeds[np.lexsort((seeds[:, 0], seeds[:, 2]))]
    cut = np.flatnonzero(np.diff(seeds[:, 2])) + 1
    for group in np.split(seeds, cut) if len(seeds) else ():
        q, firsts, k = int(group[0, 2]), group[:, 0], 0
        while k < len(group):
            first, end = int(firsts[k]), int(group[k, 1])
            first -= _same(seq, first - 1, q, -1)
            end += _same(seq, end, q, 1)
            if end - first >= q and end - first + q >= LEAST:
                out.append((first, end + q, q))
            k = max(k + 1, int(np.searchsorted(firsts, end)))
    return np.array(out, np.int64).reshape(-1, 3)


def smallest_periods(runs: np.ndarray) -> np.ndarray:
    """Each stretch once, by start, with its smallest period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    return runs[new]


def all_runs(words: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Runs (start, end, period) of all rows, as word numbers in ``words``, by start and period."""
    seq, starts = separated(words, rows)
    longest = int(np.diff(rows).max(initial=0))
    found = [scanned(seq, q) for q in range(1, min(3 * FIRST, longest // 2 + 1))]
    runs = smallest_periods(np.concatenate(found)) if found else np.zeros((0, 3), np.int64)
    if longest >= 6 * FIRST:
        grams = Grams(seq)
        while grams.size < FIRST:
            grams.double()
        while 6 * grams.size <= longest:
            t = grams.size
            seeds = np.concatenate([neighbour_seeds(seq, runs, t), minimizer_seeds(grams, runs)])
            runs = smallest_periods(np.concatenate([runs, extended(seq, seeds)]))
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    row = np.searchsorted(starts, runs[:, 0], "right") - 1
    runs[:, :2] -= row[:, None]
    return runs


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = 1 << 20,
                  spans: bool = False) -> DataFrame:
    """One row per row of ``docs``: id and ``FIELDS``; with ``spans`` also every run as (start, length, period).

    ``start`` to ``exponent_milli`` are those of the longest run, ``runs_sha256`` is of all runs, ``collapsed_sha256``
    of the text without the words that a run has after its first period.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, *(f.split()[0] for f in FIELDS.split(", "))]

    def find(batches):
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(1), slice_bytes):
                starts, ends, rows = tokens(data, offsets)
                runs = all_runs(hash_spans(data, starts, ends), rows)
                first = np.searchsorted(runs[:, 0], rows)
                edge = np.zeros(len(starts) + 1, np.int64)
                np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
                np.add.at(edge, runs[:, 1], -1)
                kept = np.cumsum(edge)[:len(starts)] == 0
                raw, out = data.tobytes(), []
                empty, every = _sha(b""), []
                for k, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist())):
                    mine = [(s - a, e - s, q) for s, e, q in runs[first[k]:first[k + 1]].tolist()]
                    every.append([{"start": s, "length": n, "period": q} for s, n, q in mine])
                    some = np.flatnonzero(kept[a:b]) + a
                    text = b" ".join([raw[x:y] for x, y in zip(starts[some].tolist(), ends[some].tolist())])
                    lines = "".join(f"{s},{n},{q}\n" for s, n, q in mine).encode()
                    best = min(mine, key=lambda r: (-r[1], r[0], r[2])) if mine else None
                    out.append((len(mine), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                                _sha(lines) if lines else empty, _sha(text)))
                columns = [pa.array(list(c), pa.string() if i > 4 else pa.int64()) for i, c in enumerate(zip(*out))]
                columns = [batch.column(0).slice(lo, hi - lo), *columns]
                if spans:
                    columns.append(pa.array(every, pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "length", "period")]))))
                yield pa.RecordBatch.from_arrays(columns, [*names, "runs"][:len(columns)])

    more = ", runs array<struct<start: bigint, length: bigint, period: bigint>>" if spans else ""
    return docs.select(id_col, text_col).mapInArrow(find, f"{id_col} {kind}, {FIELDS}{more}")


def with_planted_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and text, where a tenth of the documents, by a hash of the id, repeats a block from some word to its end.

    With h the crc32 of the decimal id and g = h / 10: if h is a multiple of 10, the words from a = g % n on repeat
    the first 1 + (n - a) / (3 + g % 8) of them. Other texts, and those of null ids, stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.filter(F.split(text_col, "[ \\t-\\r]+"), lambda w: w != "")
    at = F.expr("(h div 10) % size(words)")
    period = F.expr("1 + (size(words) - (h div 10) % size(words)) div (3 + (h div 10) % 8)")

    def word(i: Column) -> Column:
        return F.get("words", F.when(i < F.col("at"), i).otherwise(F.col("at") + (i - F.col("at")) % F.col("period")))

    planted = docs.select(id_col, F.col(text_col).alias("text"), h.alias("h")) \
        .withColumn("words", F.when(F.col("h") % 10 == 0, words))
    some = F.size("words") > 0
    planted = planted.withColumn("at", F.when(some, at).cast("int")).withColumn("period", F.when(some, period).cast("int"))
    again = F.array_join(F.transform(F.sequence(F.lit(0), F.size("words") - 1), word), " ")
    return planted.select(id_col, F.when(some, again).otherwise(F.col("text")).alias(text_col))
