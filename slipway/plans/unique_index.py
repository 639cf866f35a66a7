"""Uniqueness of a live table checked from the keys that changed (A4, Q3, Q5, Q7).

Beside a table stands one of its keys with their number of rows, laid out by a
hash bucket of the key. A check reads the rows that came or went since the
version the index is of (``Store.changes``), and of the index only the buckets
that their keys fall into: partition folders, pruned at the scan. The exact
keys decide, the bucket only says where they are. Changes are appended to the
index as rows with a number to add, and ``FOLDERS`` of them are folded into
one folder, so a check reads a bounded number of files per bucket.

The number of keys that occur more than once, with and without NULL keys, is
kept with the index's commit and moved by the keys that changed. A key that
makes up a third of the table is one row of the index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipway.operators import checks as C
from slipway.operators.diff import COPIES
from slipway.sources.seeds import literal_frame
from slipway.store import Store, Version

PER_BUCKET = 1 << 20
LEAST, MOST = 8, 4096
FOLDERS = 16
_BUCKET = "_bucket"


def index_name(table: str, check: C.Check) -> str:
    return f"{table}__keys_{'_'.join(check.columns)}"


def bucket_count(rows: int | None) -> int:
    """About ``PER_BUCKET`` rows of the table to a bucket, within bounds."""
    return min(MOST, max(LEAST, (rows or 0) // PER_BUCKET))


def _counted(rows: DataFrame, cols, copies: Column, buckets: int) -> DataFrame:
    bucket = F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int").alias(_BUCKET)
    return rows.groupBy(*cols).agg(F.sum(copies).cast("long").alias("n")).where("n <> 0").select(*cols, "n", bucket)


def _twice(cols, n: str) -> list[Column]:
    """Keys with more than one row: all, and those without a NULL."""
    full = F.lit(True)
    for c in cols:
        full = full & F.col(c).isNotNull()
    return [F.count_if(F.col(n) > 1), F.count_if((F.col(n) > 1) & full)]


def _parsed(index: Version | None) -> tuple[int, int, int, int] | None:
    """Commit of the table that the index is of, its buckets and its two numbers, from the index's run key."""
    if index is None or not (index.run_key or "").startswith("keys "):
        return None
    return tuple(int(x) for x in index.run_key.split()[1:])


def _key(seq: int, buckets: int, numbers) -> str:
    return f"keys {seq} {buckets} {numbers[0]} {numbers[1]}"


def _rebuild(store: Store, env: str, table: str, cols, name: str, now: Version):
    buckets = bucket_count(now.row_count)
    keys = _counted(store.read_version(now).select(*cols), cols, F.lit(1), buckets)
    written = store.write_version(name, keys, partition_by=[_BUCKET])
    numbers = store.read_paths(written.paths, written.schema_json).agg(*_twice(cols, "n")).first()
    store.commit([{"env": env, "table_name": name, "action": "build", "paths": written.paths, "row_count": written.row_count,
                   "run_key": _key(now.seq, buckets, numbers), "schema_json": written.schema_json}])
    return numbers


def _folded(store: Store, env: str, name: str, index: Version, cols, now: Version, numbers) -> None:
    """The index as one folder again, with as many buckets as the table now asks for, unless another writer has moved on."""
    buckets = bucket_count(now.row_count)
    written = store.write_version(name, _counted(store.read_version(index), cols, F.col("n"), buckets), partition_by=[_BUCKET])
    store.replace(env, name, written, _key(now.seq, buckets, numbers), expect=index.seq)


def touched_buckets(delta: DataFrame) -> list[int]:
    """Buckets of changed keys: ``MOST`` at most."""
    return sorted(r[0] for r in delta.select(_BUCKET).distinct().collect())


def unique_numbers(store: Store, env: str, table: str, check: C.Check) -> tuple[tuple[int, int], str]:
    """Keys that occur more than once (all, those without NULL) in the live table, and how that was found:
    ``full``, ``changes`` or ``none``. Brings the index up to date."""
    cols, name = list(check.columns), index_name(table, check)
    now = store.version(env, table)
    if now is None:
        raise KeyError(f"{env}.{table} does not exist")
    index = store.version(env, name)
    had = _parsed(index)
    was = store.version_at(env, table, had[0]) if had else None
    if was is None or was.schema_json != now.schema_json or not store.readable(was):
        return tuple(_rebuild(store, env, table, cols, name, now)), "full"
    if was.paths == now.paths:
        return had[2:], "none"
    delta = store.persisted(_counted(store.changes(was, now), cols, F.col(COPIES), had[1]))
    old = store.read_version(index).where(F.col(_BUCKET).isin(touched_buckets(delta))).groupBy(*cols).agg(F.sum("n").alias("before"))
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"d.{c}").eqNullSafe(F.col(f"o.{c}"))
    moved = delta.alias("d").join(old.alias("o"), same, "left").select(
        *(F.col(f"d.{c}").alias(c) for c in cols), F.coalesce("o.before", F.lit(0)).alias("before"),
        (F.coalesce("o.before", F.lit(0)) + F.col("d.n")).alias("after"))
    r = moved.agg(*_twice(cols, "before"), *_twice(cols, "after")).first()
    numbers = had[2] + r[2] - r[0], had[3] + r[3] - r[1]
    key = _key(now.seq, had[1], numbers)
    store.append(env, name, delta, run_key=key, expect=index.seq)
    index = store.version(env, name)
    if len(index.paths) > FOLDERS and index.run_key == key:
        _folded(store, env, name, index, cols, now, numbers)
    return numbers, "changes"


def unique_check(store: Store, env: str, table: str, check: C.Check) -> DataFrame:
    """The result row of a ``unique`` check of the live table, as ``run_checks`` gives it."""
    if check.kind != C.UNIQUE:
        raise ValueError("only unique checks have an index")
    numbers, _ = unique_numbers(store, env, table, check)
    value = numbers[1] if check.ignore_nulls else numbers[0]
    return literal_frame(store.spark, [(check.name, check.metric, value, check.passes_value(value), check.severity,
                                        check.blocking)], C.RESULT_SCHEMA)
