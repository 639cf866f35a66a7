"""Substring deduplication: anchors at difference-cover positions, extended to whole windows.

A passage counts from ``WINDOW`` words. Word numbers whose remainder modulo
``PERIOD`` is in ``COVER`` are cover positions; every difference modulo
``PERIOD`` occurs between two members, so wherever two copies of a window
stand, some offset below ``PERIOD`` is a cover position in both. An anchor is
the hash of ``WINDOW - PERIOD + 1`` words at a cover position: two equal
windows share an anchor at one offset, and only three of seven positions are
hashed and shuffled.

1. Anchors that occur twice or more are found per bucket of hashes (32 bits and
   the bucket's number; an accidental match only adds work).
2. Each is extended to the windows around it. Windows get a digest of 96 bits
   and the bucket's, which decides; the smallest document of each digest is
   found per bucket.
3. Words of windows that a smaller document also has are removed.

Hashes travel packed, one row per bucket and pack of documents (``texts``), each
distinct one of a pack once: of a window its smallest document there, as the
pack's other documents with it are larger and lose it anyway. Buckets are dealt
by hash and hold about ``PER_BUCKET``; a passage shared by all documents adds
one entry per pack, and no pairs are formed. The packs are shuffled once, both
joins use the same exchange.

Edge cases: a null or empty text has no words; a null id takes no part: nothing
is removed from it or because of it; rows with one id are one document, none
smaller than the other; a text of any length is taken whole; an empty table
gives an empty result; only id and text are read, other columns can have any
name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipway.llm.arrays import hash_spans, mix, tokens
from slipway.llm.texts import numbers, packed, unpacked

WINDOW = 13
#: fixed values: a difference cover
PERIOD, COVER = 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
PER_BUCKET = 1 << 20
_BASES = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
#: bytes in another order, for a second hash that is independent of the first
_OTHER = (np.arange(256) * 167 + 13).astype(np.uint8)
SENT = "bucket int, pack long, keys binary, tails binary, at binary, starts binary, ids binary"
FOUND = "pack long, found binary, local binary"
RESULT = "n_words long, n_removed long, kept_sha256 string"


def rolling(words: np.ndarray, n: int, base: int) -> np.ndarray:
    """A hash of every n consecutive words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    inverse = pow(base, -1, 1 << 64)
    power = np.cumprod(np.full(len(words), base, np.uint64))
    back = np.cumprod(np.full(len(words) - n + 1, inverse, np.uint64))
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power, out=total[1:])
    return mix((total[n:] - total[:-n]) * back)


def cover_positions(rows: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Word numbers where anchors stand: in documents that are ``used`` and long enough for a window."""
    at = np.arange(int(rows[-1]))
    size = np.diff(rows)
    room = np.repeat(np.where(used & (size >= WINDOW), rows[1:] - ANCHOR, -1), size)
    return at[np.isin(at % PERIOD, COVER) & (at <= room)]


def window_positions(hit: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Starts of the windows that hold one of the anchors at ``hit``."""
    n = int(rows[-1])
    edge = np.zeros(n + 2, np.int64)
    np.add.at(edge, np.maximum(hit - (WINDOW - ANCHOR), 0), 1)
    np.add.at(edge, hit + 1, -1)
    size = np.diff(rows)
    first, last = np.repeat(rows[:-1], size), np.repeat(rows[1:] - WINDOW, size)
    at = np.arange(n)
    return at[(np.cumsum(edge)[:n] > 0) & (at >= first) & (at <= last)]


class Pack:
    """The words of a pack."""

    def __init__(self, ids: pa.Array, data: np.ndarray, offsets: np.ndarray):
        self.ids, null = numbers(ids)
        self.data, self.used = data, ~null
        self.starts, self.ends, self.rows = tokens(data, offsets)
        self.words = hash_spans(data, self.starts, self.ends)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        at = cover_positions(self.rows, self.used)
        return at, rolling(self.words, ANCHOR, _BASES[0])[at] if len(at) else np.zeros(0, np.uint64)

    def owner(self, at: np.ndarray) -> np.ndarray:
        """Ids of the documents that hold these words."""
        return np.repeat(self.ids, np.diff(self.rows))[at]

    def keys(self) -> np.ndarray:
        """A hash of the window at each word that has one; some reach into the next document."""
        return rolling(self.words, WINDOW, _BASES[0])

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of the windows at these words."""
        other = hash_spans(_OTHER[self.data], self.starts, self.ends)
        return self.keys()[at], rolling(other, WINDOW, _BASES[1])[at]


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys >> np.uint64(32)) % np.uint64(buckets)


def _dealt(pack: int, keys, buckets: int, *others) -> pa.RecordBatch:
    """Rows (bucket, pack, keys, ...) of one pack; ``others`` are arrays of the keys, or bytes sent with each row."""
    bucket = _bucket(keys, buckets).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    full, first = np.unique(bucket[order], return_index=True)
    cut = np.append(first, len(order))
    columns = [pa.array(full.astype(np.int32)), pa.array(np.full(len(full), pack, np.int64))]
    for x in others:
        if isinstance(x, bytes):
            columns.append(pa.array([x] * len(full), pa.binary()))
        else:
            x = x[order]
            columns.append(pa.array([x[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()))
    while len(columns) < 7:
        columns.append(pa.nulls(len(full), pa.binary()))
    return pa.RecordBatch.from_arrays(columns, ["bucket", "pack", "keys", "tails", "at", "starts", "ids"])


def _buckets(batches):
    """Rows of sorted batches by bucket: lists of dicts."""
    rows = []
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            for row in batch.slice(lo, 64).to_pylist():
                if rows and row["bucket"] != rows[0]["bucket"]:
                    yield rows
                    rows = []
                rows.append(row)
    if rows:
        yield rows


def _cat(rows, name, kind):
    return np.frombuffer(b"".join(r[name] for r in rows), kind)


def _found(pack: int, found: bytes | None, local: bytes | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([pack], pa.int64()), pa.array([found], pa.binary()),
                                       pa.array([local], pa.binary())], ["pack", "found", "local"])


def _back(rows, hits: np.ndarray, values: np.ndarray, sizes: np.ndarray):
    """Per row, the values that are hit."""
    end = np.cumsum(sizes)
    for row, a, b in zip(rows, (end - sizes).tolist(), end.tolist()):
        if (found := values[a:b][hits[a:b]]).size:
            yield _found(row["pack"], found.tobytes())


def _repeated(batches):
    """Anchors that occur twice or more in a bucket, to their packs."""
    for rows in _buckets(batches):
        keys = _cat(rows, "keys", "<u4")
        sizes = np.array([len(r["keys"]) // 4 for r in rows])
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        same = np.zeros(len(keys) + 1, bool)
        same[1:-1] = ordered[1:] == ordered[:-1]
        hits = np.zeros(len(keys), bool)
        hits[order] = same[1:] | same[:-1]
        yield from _back(rows, hits, keys, sizes)


def _smallest(batches):
    """Windows that a smaller document also has, to their packs; rows without keys go there as they are."""
    for every in _buckets(batches):
        for row in every:
            if row["keys"] is None:
                yield _found(row["pack"], None, row["at"])
        if not (rows := [r for r in every if r["keys"] is not None]):
            continue
        keys, tails, at = _cat(rows, "keys", "<u8"), _cat(rows, "tails", "<u4"), _cat(rows, "at", "<u4")
        sizes = np.array([len(r["at"]) // 4 for r in rows])
        end = np.cumsum(sizes)
        owner = np.empty(len(at), np.int64)
        for row, a, b in zip(rows, (end - sizes).tolist(), end.tolist()):
            starts = np.frombuffer(row["starts"], "<u4")
            owner[a:b] = np.frombuffer(row["ids"], "<i8")[np.searchsorted(starts, at[a:b], "right") - 1]
        order = np.lexsort((owner, tails, keys))
        keys, tails = keys[order], tails[order]
        new = np.ones(len(order), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (tails[1:] != tails[:-1])
        first = np.flatnonzero(new)
        least = np.repeat(owner[order][first], np.diff(np.append(first, len(order))))
        hits = np.zeros(len(order), bool)
        hits[order] = least < owner[order]
        yield from _back(rows, hits, at, sizes)


def _told(batch: pa.RecordBatch, column: str, row: int) -> np.ndarray:
    """The numbers in a row's lists."""
    lists = batch.column(column)[row]
    parts = [np.frombuffer(x.as_buffer(), "<u4") for x in lists.values] if lists.is_valid else []
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    packs = packed(docs, id_col, text_col)
    words = packs.select(F.sum(F.octet_length("texts")).alias("n")).first()["n"] or 0
    buckets = max(1, -(-words // PER_BUCKET))  # about a word for every two compressed bytes, three anchors for seven words
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def send_anchors(batches):
        for batch in batches:
            for _, pack, ids, data, offsets in unpacked(batch):
                keys = np.unique(Pack(ids, data, offsets).anchors()[1])
                yield _dealt(pack, keys, buckets, keys.astype("<u4"))

    def send_windows(batches):
        for batch in batches:
            for row, pack, ids, data, offsets in unpacked(batch):
                p = Pack(ids, data, offsets)
                at, keys = p.anchors()
                every, number, count = np.unique(keys, return_inverse=True, return_counts=True)
                again = (count > 1) | np.isin(every.astype("<u4"), _told(batch, "found", row))
                at = window_positions(at[again[number]], p.rows)
                if not len(at):
                    continue
                keys, tails = p.windows(at)
                owner = p.owner(at)
                order = np.lexsort((owner, keys))
                at, keys, tails, owner = at[order], keys[order], tails[order], owner[order]
                new = np.append(True, keys[1:] != keys[:-1])
                first = np.flatnonzero(new)
                larger = owner > np.repeat(owner[first], np.diff(np.append(first, len(at))))
                if larger.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([pack % buckets], pa.int32()), pa.array([pack], pa.int64()), pa.nulls(1, pa.binary()),
                         pa.nulls(1, pa.binary()), pa.array([at[larger].astype("<u4").tobytes()], pa.binary()),
                         pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary())],
                        ["bucket", "pack", "keys", "tails", "at", "starts", "ids"])
                # a document without words starts where the next one does, which then is the last of equal starts
                yield _dealt(pack, keys[first], buckets, keys[first].astype("<u8"), tails[first].astype("<u4"),
                             at[first].astype("<u4"), p.rows[:-1].astype("<u4").tobytes(), p.ids.astype("<i8").tobytes())

    def remove(batches):
        for batch in batches:
            for row, _, ids, data, offsets in unpacked(batch):
                starts, ends, rows = tokens(data, offsets)
                hit, at = _told(batch, "found", row), _told(batch, "local", row)
                if len(hit):  # a smaller document elsewhere has them: all these windows of the pack go
                    p = Pack(ids, data, offsets)
                    keys = p.keys()
                    size = np.diff(rows)
                    room = np.repeat(np.where(p.used, rows[1:] - WINDOW, -1), size)[:len(keys)]
                    at = np.append(at, np.flatnonzero(np.isin(keys, keys[hit]) & (np.arange(len(keys)) <= room)))
                edge = np.zeros(len(starts) + WINDOW + 1, np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + WINDOW, -1)
                gone = np.cumsum(edge)[:len(starts)] > 0
                raw, kept = data.tobytes(), ~gone
                digests, removed = [], np.zeros(len(rows) - 1, np.int64)
                for k, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist())):
                    some = np.flatnonzero(kept[a:b]) + a
                    removed[k] = b - a - len(some)
                    joined = b" ".join([raw[x:y] for x, y in zip(starts[some].tolist(), ends[some].tolist())])
                    digests.append(hashlib.sha256(joined).hexdigest())
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(rows)), pa.array(removed), pa.array(digests)],
                                                 [id_col, "n_words", "n_removed", "kept_sha256"])

    def grouped(sent: DataFrame, reduce) -> DataFrame:
        dealt = sent.repartition(parts, "bucket").sortWithinPartitions("bucket")
        return dealt.mapInArrow(reduce, FOUND).groupBy("pack").agg(
            F.collect_list("found").alias("found"), F.collect_list("local").alias("local"))

    dealt = packs.repartition(parts, "pack")
    repeated = grouped(packs.mapInArrow(send_anchors, SENT), _repeated)
    shared = grouped(dealt.join(repeated, "pack", "left").mapInArrow(send_windows, SENT), _smallest)
    return dealt.join(shared, "pack", "left").mapInArrow(remove, f"{id_col} long, {RESULT}") \
        .withColumn(id_col, F.col(id_col).cast(kind))
