"""Documents packed into numbered rows, the unit that keys of whole tables are joined back to.

A row holds documents of about ``PACK`` bytes, compressed (a longer document is
a row of its own), so a key that a third of all documents share is sent once or
twice per pack, and null or repeated ids give no large group. The packs are
written to the shared folder, so their numbers stay when executors are lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipway.llm.arrays import chunks
from slipway.llm.stored import stored

PACKS = "pack long, ids array<bigint>, offsets binary, texts binary"
PACK = 1 << 20
ROWS = 1 << 14


def listed(values: pa.Array) -> pa.Array:
    """One list of all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def packed(docs: DataFrame, id_col: str, text_col: str, size: int = PACK) -> DataFrame:
    """PACKS rows: every row of ``docs`` once; a null text is empty. Batches share packs."""
    def pack(batches):
        number = TaskContext.get().partitionId() << 32
        ids, texts, counts, held, rows = [], [], [], 0, 0

        def out():
            nonlocal ids, texts, counts, held, rows, number
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype("<i8")
            row = pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), listed(pa.concat_arrays(ids)), pa.array([offsets.tobytes()]),
                 pa.array([pa.compress(b"".join(texts), "zstd", asbytes=True)], pa.binary())],
                ["pack", "ids", "offsets", "texts"])
            ids, texts, counts, held, rows, number = [], [], [], 0, 0, number + 1
            return row

        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(1), size, ROWS):
                if rows and (held + len(data) > size or rows + hi - lo > ROWS):
                    yield out()
                ids.append(batch.column(0).slice(lo, hi - lo))
                texts.append(data.tobytes())
                counts.append(np.diff(offsets))
                held, rows = held + len(data), rows + hi - lo
        if rows:
            yield out()

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(pack, PACKS)
    return stored(rows, "packs")


def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.Array, np.ndarray, np.ndarray]]:
    """(row of the batch, pack, ids, bytes, offsets of documents in these bytes)."""
    for row, pack in enumerate(batch.column("pack").to_pylist()):
        offsets = np.frombuffer(batch.column("offsets")[row].as_buffer(), "<i8")
        raw = batch.column("texts")[row].as_buffer()
        data = pa.decompress(raw, int(offsets[-1]), "zstd", asbytes=True) if offsets[-1] else b""
        yield row, pack, batch.column("ids").slice(row, 1).flatten(), np.frombuffer(data, np.uint8), offsets


def numbers(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids (0 for null) and which are null."""
    null = ids.is_null().to_numpy(zero_copy_only=False)
    return ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), null
