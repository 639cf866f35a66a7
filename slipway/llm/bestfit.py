"""Best-fit packing with a fixed number of open bins.

Documents become token ids in the tasks that read them. Only those longer
than a sequence are cut, into whole sequences and a rest. The pieces (a few
numbers each) are dealt to tasks by a hash, and each task packs its own in
hash order, so retries and reruns agree. The open bins of a task are kept by
free space: bit ``f`` of an integer is set while some open bin has ``f`` ids
free, so the best fit for a piece of ``n`` ids is the lowest set bit from
``n`` on. When a bin must be opened and ``open_bins`` are open, the fullest
closes. A task leaves at most ``open_bins`` bins with much free space, so
tasks are few: one for each ``pieces_per_task`` pieces.

Edge cases: a null or empty text is one id (the end id); a document of any
length is cut whole; equal rows are packed as separate documents; an empty
table gives an empty result; only ``id_col`` and ``text_col`` are read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipway.llm.arrays import chunks
from slipway.llm.encode import WORDS, Cut, encoder
from slipway.llm.stored import stored


class Packer:
    """Online best-fit: ``add`` returns (bin number, offset)."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.free, self.bins = 0, defaultdict(list)
        self.open = self.made = 0

    def add(self, size: int) -> tuple[int, int]:
        above = self.free >> size
        if above:
            space = size + (above & -above).bit_length() - 1
            number = self._take(space)
        else:
            if self.open == self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes
            space, number = self.capacity, self.made
            self.made += 1
        if space > size:
            self.bins[space - size].append(number)
            self.free |= 1 << (space - size)
            self.open += 1
        return number, self.capacity - space

    def _take(self, space: int) -> int:
        at = self.bins[space]
        number = at.pop()
        if not at:
            self.free &= ~(1 << space)
        self.open -= 1
        return number


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text",
           cut: Cut = WORDS, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Rows (id, piece, start, length, ids_crc32, and ids if asked for) of every document."""
    kind = docs.schema[id_col].dataType.simpleString()
    fields = [id_col, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def encode(batches):
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(1), 1 << 20):
                ids, rows = encoder(tokenizer, cut).encode(data, offsets)
                ids, rows = np.insert(ids, rows[1:], end_id), rows + np.arange(len(rows))
                size = np.diff(rows)
                count = -(-size // capacity)
                owner = np.repeat(np.arange(hi - lo), count)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                first = rows[owner] + number * capacity
                length = np.minimum(capacity, rows[owner + 1] - first)
                wide = ids.astype("<u4").tobytes()
                spans = list(zip((4 * first).tolist(), (4 * (first + length)).tolist()))
                out = [batch.column(0).slice(lo, hi - lo).take(pa.array(owner)), pa.array(number.astype(np.int32)),
                       pa.array(number * capacity), pa.array(length),
                       pa.array([zlib.crc32(wide[a:b]) for a, b in spans], pa.int64())]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(
                        pa.array(np.append(first, rows[-1]).astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(out, fields)

    return docs.select(id_col, text_col).mapInArrow(
        encode, f"{id_col} {kind}, piece int, start long, length long, ids_crc32 long"
        + ", ids array<int>" * with_ids)


def pack(found: DataFrame, capacity: int = 2048, open_bins: int = 1024, pieces_per_task: int = 200_000,
         id_col: str = "doc_id") -> DataFrame:
    """Adds sequence_id and offset to a stored table of pieces (id, piece, length, ...)."""
    tasks = max(1, -(-found.count() // pieces_per_task))

    def place(batches):
        packer, task = Packer(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            sizes = batch.column("length").to_pylist()
            if sizes and max(sizes) > capacity:
                raise ValueError("a piece is longer than a sequence")
            got = np.array([packer.add(n) for n in sizes], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got[:, 0] + task), pa.array(got[:, 1])],
                                             [*batch.schema.names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    # rows of one id (null, repeated) are dealt by what they hold
    key = F.xxhash64(id_col, "piece", *(c for c in ("length", "ids_crc32") if c in found.columns))
    return found.repartition(tasks, key).sortWithinPartitions(key, id_col, "piece", *sorted(set(found.columns))) \
        .mapInArrow(place, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, open_bins: int = 1024,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Where each piece of each document goes: sequence_id and offset."""
    found = pieces(docs, tokenizer, capacity, id_col, text_col)
    return pack(stored(found, "pieces"), capacity, open_bins, id_col=id_col)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences: ids of each sequence_id, from placed pieces that carry ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
