"""Token ids in shard files, found by document key through a minimal perfect hash.

Format, below one folder, all written by Spark's committed Parquet writer:

* ``blocks``: shard, block, start (ids of the shard before it), lengths (int32
  little-endian, one per document), ids (uint16 little-endian, raw). A shard
  holds a range of keys in ascending order; ``DOCS_PER_BLOCK`` documents make
  a block, so a document's ordinal in its shard gives its block at once.
* ``shards``: shard, documents, tokens, start (ids of all shards before it).
* ``index``: one row per part (a hash of the key): the bit levels of a minimal
  perfect hash, and by slot a 32-bit fingerprint, shard, ordinal and number of
  rows with the key. A key is hashed at each level until its bit is set; the
  rank of that bit is its slot. Keys themselves are not stored.

Edge cases: a null text is empty and holds only the end id; null keys come
first and are found as one key; repeated keys keep all their rows, next to
each other, and one index entry; an empty table gives an empty store; only the
key and the text are read. A text of any length is one document.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slipway.llm.arrays import chunks, mix
from slipway.llm.encode import SPACES, Cut, encoder

DOCS_PER_BLOCK = 64
GAMMA = 2.0
_NULL = np.uint64(0xD6E8FEB86659FD93)
_PART, _PRINT = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
INDEX = "part int, keys int, sizes binary, bits binary, prints binary, shards binary, ordinals binary, counts binary"


def key_hash(keys: np.ndarray, null: np.ndarray) -> np.ndarray:
    return np.where(null, _NULL, mix(keys.astype(np.int64).view(np.uint64)))


def _level(h: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(h + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)


def build_hash(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Level sizes and all levels' bits of a minimal perfect hash over distinct hashes."""
    sizes, bits = [], []
    while len(h):
        if len(sizes) == 200:
            raise ValueError("equal key hashes")
        size = max(8, int(GAMMA * len(h)))
        at = _level(h, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        h = h[~alone[at]]
    return np.array(sizes, np.int64), np.concatenate(bits) if bits else np.zeros(0, bool)


def slots(h: np.ndarray, sizes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The slot of each hash; -1 for those that surely are no keys."""
    rank = np.cumsum(bits) - 1
    out, left, base = np.full(len(h), -1, np.int64), np.arange(len(h)), 0
    for level, size in enumerate(sizes.tolist()):
        at = base + _level(h[left], level, size)
        hit = bits[at]
        out[left[hit]] = rank[at[hit]]
        left, base = left[~hit], base + size
    return out


def _prints(h: np.ndarray) -> np.ndarray:
    return (mix(h ^ _PRINT) >> np.uint64(32)).astype("<u4")


def _bounds(docs: DataFrame, key: str, rows_per_shard: int) -> list[float]:
    shards = max(1, -(-docs.count() // rows_per_shard))
    if shards == 1:
        return []
    cuts = [k / shards for k in range(1, shards)]
    return sorted({int(x) for x in docs.approxQuantile(key, cuts, 0.25 / shards)})


def _shard_of(keys: pa.Array, bounds: list[int]) -> np.ndarray:
    null = keys.is_null().to_numpy(zero_copy_only=False)
    keys = keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.where(null, 0, np.searchsorted(np.array(bounds, np.int64), keys, "right")).astype(np.int32)


def _encoded(docs: DataFrame, key: str, text: str, tokenizer: str, cut: Cut, end_id: int, bounds) -> DataFrame:
    def encode(batches):
        for batch in batches:
            shard = _shard_of(batch.column(0), bounds)
            for lo, hi, data, offsets in chunks(batch.column(1), 1 << 20):
                ids, rows = encoder(tokenizer, cut).encode(data, offsets)
                ids, rows = np.insert(ids, rows[1:], end_id).astype("<u2"), rows + np.arange(len(rows))
                made = pa.Array.from_buffers(pa.large_binary(), hi - lo,
                                             [None, pa.py_buffer((2 * rows).astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard[lo:hi]), batch.column(0).slice(lo, hi - lo), made.cast(pa.binary())],
                    ["shard", "key", "ids"])

    return docs.select(F.col(key).cast("long"), text).mapInArrow(encode, "shard int, key long, ids binary")


def _blocks(rows: DataFrame) -> DataFrame:
    """Sorted rows of whole shards to blocks."""
    def collect(batches):
        shard, block, start, held = None, 0, 0, []

        def out():
            lengths = np.array([len(x) // 2 for x in held], "<i4")
            return pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "block": pa.array([block], pa.int32()),
                 "documents": pa.array([len(held)], pa.int32()), "start": pa.array([start], pa.int64()),
                 "tokens": pa.array([int(lengths.sum())], pa.int64()),
                 "lengths": pa.array([lengths.tobytes()]), "ids": pa.array([b"".join(held)])})

        for batch in batches:
            for s, ids in zip(batch.column("shard").to_pylist(), batch.column("ids").to_pylist()):
                if held and (s != shard or len(held) == DOCS_PER_BLOCK):
                    yield out()
                    start, block, held = start + sum(map(len, held)) // 2, block + 1, []
                if s != shard:
                    shard, block, start = s, 0, 0
                held.append(ids)
        if held:
            yield out()

    return rows.mapInArrow(collect, "shard int, block int, documents int, start long, tokens long, "
                                    "lengths binary, ids binary")


def _keys(docs: DataFrame, key: str, bounds) -> DataFrame:
    """(shard, key, ordinal of its first row in the shard, number of rows)."""
    def shard(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_shard_of(batch.column(0), bounds)), batch.column(0)],
                                             ["shard", "key"])

    found = docs.select(F.col(key).cast("long")).mapInArrow(shard, "shard int, key long") \
        .groupBy("shard", "key").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy(F.asc_nulls_first("key")).rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("ordinal", F.coalesce(F.sum("n").over(before), F.lit(0)))


def _with_part(keys: DataFrame, parts: int) -> DataFrame:
    def part(batches):
        for batch in batches:
            k = batch.column("key")
            h = key_hash(k.fill_null(0).to_numpy(zero_copy_only=False), k.is_null().to_numpy(zero_copy_only=False))
            got = (mix(h ^ _PART) % np.uint64(parts)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got)], [*batch.schema.names, "part"])

    return keys.mapInArrow(part, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keys.schema) + ", part int")


def _hashes(keys: pd.Series) -> np.ndarray:
    null = keys.isna().to_numpy()
    return key_hash(keys.fillna(0).to_numpy().astype(np.int64), null)


def _index_part(rows: pd.DataFrame) -> pd.DataFrame:
    h = _hashes(rows["key"])
    sizes, bits = build_hash(h)
    at = slots(h, sizes, bits)
    put = lambda x, kind: x[np.argsort(at)].astype(kind).tobytes()
    return pd.DataFrame({"part": [rows["part"].iloc[0]], "keys": [len(h)], "sizes": [sizes.astype("<i8").tobytes()],
                         "bits": [np.packbits(bits).tobytes()], "prints": [put(_prints(h), "<u4")],
                         "shards": [put(rows["shard"].to_numpy(), "<i4")],
                         "ordinals": [put(rows["ordinal"].to_numpy(), "<i8")],
                         "counts": [put(rows["n"].to_numpy(), "<i4")]})


def _find(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    out = keys.assign(shard=-1, ordinal=-1, n=0)
    if len(index) and len(keys):
        row, h = index.iloc[0], _hashes(keys["key"])
        sizes = np.frombuffer(row["sizes"], "<i8")
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[:int(sizes.sum())].astype(bool)
        at = slots(h, sizes, bits)
        found = (at >= 0) & (np.frombuffer(row["prints"], "<u4")[at] == _prints(h))
        for name, column, kind in (("shard", "shards", "<i4"), ("ordinal", "ordinals", "<i8"), ("n", "counts", "<i4")):
            out[name] = np.where(found, np.frombuffer(row[column], kind)[at], out[name])
    return out[out["n"] > 0][["key", "shard", "ordinal", "n"]]


def write_store(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text",
                cut: Cut = SPACES, end_id: int = 0, rows_per_shard: int = 16384, keys_per_part: int = 65536) -> None:
    bounds = _bounds(docs, key, rows_per_shard)
    rows = _encoded(docs, key, text, tokenizer, cut, end_id, bounds)
    blocks = _blocks(rows.repartition(len(bounds) + 1, "shard")
                     .sortWithinPartitions("shard", F.asc_nulls_first("key"), "ids"))
    blocks.write.option("compression", "zstd").parquet(f"{path}/blocks")
    spark = docs.sparkSession
    totals = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(
        F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0))).write.parquet(f"{path}/shards")
    parts = max(1, -(-docs.count() // keys_per_part))
    _with_part(_keys(docs, key, bounds), parts).groupBy("part").applyInPandas(_index_part, INDEX) \
        .write.parquet(f"{path}/index")


class TokenStore:
    def __init__(self, spark: SparkSession, path: str):
        self.blocks, self.shards, self.index = (spark.read.parquet(f"{path}/{x}")
                                                for x in ("blocks", "shards", "index"))
        self.parts = (self.index.agg(F.max("part")).first()[0] or 0) + 1

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Distinct keys (one column) found in the index: key, shard, ordinal, n."""
        keys = keys.select(F.col(keys.columns[0]).cast("long").alias("key")).distinct()
        return _with_part(keys, self.parts).groupBy("part").cogroup(self.index.groupBy("part")) \
            .applyInPandas(_find, "key long, shard int, ordinal long, n int")

    def places(self, keys: DataFrame) -> DataFrame:
        """One row per document of the keys: key, shard, ordinal."""
        return self.lookup(keys).select(
            "key", "shard", F.explode(F.sequence("ordinal", F.col("ordinal") + F.col("n") - 1)).alias("ordinal"))

    def documents(self) -> DataFrame:
        """Every document read back from the blocks: shard, ordinal, start, n_tokens, ids_crc32."""
        def read(batches):
            for batch in batches:
                for shard, block, start, lengths, ids in zip(*(batch.column(c).to_pylist() for c in (
                        "shard", "block", "start", "lengths", "ids"))):
                    size = np.frombuffer(lengths, "<i4").astype(np.int64)
                    end = np.cumsum(size)
                    wide = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                    n = len(size)
                    yield pa.RecordBatch.from_pydict(
                        {"shard": pa.array(np.full(n, shard, np.int32)),
                         "ordinal": pa.array(block * DOCS_PER_BLOCK + np.arange(n)),
                         "within": pa.array(start + end - size), "n_tokens": pa.array(size),
                         "ids_crc32": pa.array([zlib.crc32(wide[4 * (e - s):4 * e])
                                                for s, e in zip(size.tolist(), end.tolist())], pa.int64())})

        found = self.blocks.select("shard", "block", "start", "lengths", "ids").mapInArrow(
            read, "shard int, ordinal long, within long, n_tokens long, ids_crc32 long")
        return found.join(self.shards.select("shard", F.col("start").alias("base")), "shard") \
            .select("shard", "ordinal", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")

    def ids(self, keys: DataFrame) -> DataFrame:
        """The ids of the keys' documents: key, ordinal, ids."""
        places = self.places(keys).withColumn("block", (F.col("ordinal") / DOCS_PER_BLOCK).cast("int"))

        def cut(batches):
            for batch in batches:
                out = []
                for ordinal, lengths, ids in zip(*(batch.column(c).to_pylist() for c in ("ordinal", "lengths", "ids"))):
                    size = np.frombuffer(lengths, "<i4").astype(np.int64)
                    k = ordinal % DOCS_PER_BLOCK
                    a = int(size[:k].sum())
                    out.append(np.frombuffer(ids, "<u2")[a:a + size[k]].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), batch.column("ordinal"), pa.array(out, pa.list_(pa.int32()))],
                    ["key", "ordinal", "ids"])

        return places.join(self.blocks.select("shard", "block", "lengths", "ids"), ["shard", "block"]) \
            .select("key", "ordinal", "lengths", "ids").mapInArrow(cut, "key long, ordinal long, ids array<int>")


def stored_documents(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the store, then reads every document of ``docs`` back through index and blocks."""
    write_store(docs, path, tokenizer, key, text)
    store = TokenStore(docs.sparkSession, path)
    return store.places(docs.select(key)).join(store.documents(), ["shard", "ordinal"]) \
        .select(F.col("key").alias(key), "start", "n_tokens", "ids_crc32")
