"""Fixed-size count vectors over whole tables.

Each task counts into one vector per name (8 bytes a cell) and sends its
slices; two rounds of grouping add them up, so no group holds one row per
task of a large job. Only the sums, whose size is a parameter, reach the
driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

ROWS = "name string, slice int, part int, counts binary"
SLICE = 1 << 13


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(len(rows["counts"].iloc[0]) // 8, np.int64)
    for x in rows["counts"]:
        total += np.frombuffer(x, np.int64)
    return rows.iloc[:1].assign(counts=[total.tobytes()])


def count_vectors(df: DataFrame, size: int,
                  count: Callable[[pa.RecordBatch], Iterator[tuple[str, np.ndarray]]],
                  fan_in: int = 64) -> dict[str, np.ndarray]:
    """``count`` gives (name, cells to add one to) of a batch; the result maps each name to its vector."""
    def task(batches):
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, cells in count(batch):
                vector = found.setdefault(name, np.zeros(size, np.int64))
                vector += np.bincount(cells, minlength=size)
        part = TaskContext.get().partitionId()
        for name, vector in found.items():
            n = -(-size // SLICE)
            yield pa.RecordBatch.from_pydict({
                "name": pa.array([name] * n), "slice": pa.array(np.arange(n, dtype=np.int32)),
                "part": pa.array(np.full(n, part, np.int32)),
                "counts": pa.array([vector[k * SLICE:(k + 1) * SLICE].tobytes() for k in range(n)])})

    parts = df.mapInArrow(task, ROWS)
    once = parts.groupBy("name", "slice", (parts["part"] % fan_in).alias("group")).applyInPandas(_added, ROWS)
    sums = once.groupBy("name", "slice").applyInPandas(_added, ROWS).toPandas().sort_values(["name", "slice"])
    return {name: np.frombuffer(b"".join(rows["counts"]), np.int64) for name, rows in sums.groupby("name")}
