"""Quality classifier: importance resampling with hashed n-gram models.

Two bag-of-n-gram models (tokens and pairs of tokens, hashed into a fixed
number of buckets) are counted: the target from a bounded sample of documents
labelled good, the raw one from every document. A document's log weight is the
sum of log ratios of its n-grams. Gumbel top-k keeps the k documents with the
largest log weight plus Gumbel noise, which samples k documents without
replacement in proportion to their weights. k is the number of documents whose
log weight passes a bar, and the bar leaves ``lost`` of the sampled good
documents below it. The cut-off key comes from repeated histograms of the
keys, so no task or driver holds them all.

Edge cases: a null or empty text has weight 0 and its noise decides; without
labels or documents every weight is 0; rows with a null id take part with
their own noise; equal rows get equal keys, and all rows at the cut-off key
are kept; only the id and the text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipway.llm.arrays import LOWER, WORD_OR_PUNCTUATION, chunks, hash_spans, mix, per_row, tokens
from slipway.llm.counts import count_vectors
from slipway.llm.stored import stored

BUCKETS = 1 << 17
SMOOTHING = 1.0


def buckets(data: np.ndarray, offsets: np.ndarray, size: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each token, then of each pair of neighbours; the row of each."""
    data = LOWER[data]
    starts, ends, rows = tokens(data, offsets, WORD_OR_PUNCTUATION)
    h = hash_spans(data, starts, ends)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(rows))
    same = row[1:] == row[:-1]
    pair = mix(h[:-1] * np.uint64(31) + h[1:])[same]
    return (np.concatenate([h, pair]) % np.uint64(size)).astype(np.int64), np.concatenate([row, row[1:][same]])


def gumbel(ids: pa.Array, seed: int) -> np.ndarray:
    """Gumbel noise that depends on the id and the seed alone."""
    key = ids.cast(pa.int64()).fill_null(-(1 << 62)).to_numpy(zero_copy_only=False).view(np.uint64)
    u = (mix(mix(key) + np.uint64(seed)) >> np.uint64(11)).astype(float) + 0.5
    return -np.log(-np.log(u / (1 << 53)))


class Resampler:
    """Fitted log ratios and, after ``score``, the cut-off key."""

    def __init__(self, spark, ratio: np.ndarray, seed: int, noise: float, id_col: str, text_col: str):
        self.ratio, self.seed, self.noise = spark.sparkContext.broadcast(ratio.astype(np.float32)), seed, noise
        self.id_col, self.text_col = id_col, text_col
        self.cut = -np.inf

    def weights(self, ids: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log weights and keys of the rows of a batch."""
        ratio, out = self.ratio.value, [np.zeros(0)]
        for lo, hi, data, offsets in chunks(texts):
            cells, row = buckets(data, offsets, len(ratio))
            out.append(np.bincount(row, ratio[cells].astype(float), minlength=hi - lo))
        weight = np.concatenate(out)
        return weight, weight + self.noise * gumbel(ids, self.seed)

    def scored(self, docs: DataFrame) -> DataFrame:
        """id, log_weight, key of every row."""
        def score(batches):
            for batch in batches:
                weight, key = self.weights(batch.column(0), batch.column(1))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weight), pa.array(key)],
                                                 [self.id_col, "log_weight", "key"])

        kind = docs.schema[self.id_col].dataType.simpleString()
        return docs.select(self.id_col, self.text_col).mapInArrow(
            score, f"{self.id_col} {kind}, log_weight double, key double")

    def sample(self, docs: DataFrame) -> DataFrame:
        """The rows of ``docs``, all columns, whose key reaches the cut-off."""
        cut, id_col, text_col = float(self.cut), self.id_col, self.text_col

        def keep(batches):
            for batch in batches:
                key = self.weights(batch.column(id_col), batch.column(text_col))[1]
                yield batch.filter(pa.array(key >= cut))

        return docs.mapInArrow(keep, docs.schema)


def fit(docs: DataFrame, labels: DataFrame, good, id_col: str = "doc_id", text_col: str = "text",
        max_labelled: int = 20_000, size: int = BUCKETS, seed: int = 17, noise: float = 1.0) -> tuple[Resampler, DataFrame]:
    """Counts both models; also returns the ids of the labelled sample (column ``id``, at most ``max_labelled``)."""
    sample = labels.where(good).where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct() \
        .orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(max_labelled)
    sample = stored(sample, "labelled")
    marked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(sample.withColumn("target", F.lit(True))), "id", "left").select("text", "target")

    def count(batch):
        target = batch.column(1).fill_null(False).to_numpy(zero_copy_only=False)
        for lo, _, data, offsets in chunks(batch.column(0)):
            cells, row = buckets(data, offsets, size)
            yield "raw", cells
            yield "target", cells[target[lo:][row]]

    found = count_vectors(marked, size, count)
    raw, target = (found.get(k, np.zeros(size, np.int64)) for k in ("raw", "target"))
    ratio = np.zeros(size)
    if target.sum():
        share = lambda x: np.log((x + SMOOTHING) / (x.sum() + SMOOTHING * size))
        ratio = share(target) - share(raw)
    return Resampler(docs.sparkSession, ratio, seed, noise, id_col, text_col), sample


def kth_largest(scored: DataFrame, column: str, k: int, bins: int = 4096) -> float:
    """The k-th largest value, by histograms that narrow the range around it."""
    low, high = scored.agg(F.min(column), F.max(column)).first()
    if low is None or k <= 0:
        return float("inf")
    while low < high:
        width = (high - low) / bins
        if width == 0 or low + width == low:
            break
        cell = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).alias("cell")
        rows = scored.where(F.col(column).between(low, high)).groupBy(cell).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for r in sorted(rows, key=lambda r: -r["cell"]):
            if k <= r["n"]:
                low, high = r["low"], r["high"]
                break
            k -= r["n"]
        else:
            return low
    return low


def resample(docs: DataFrame, labels: DataFrame, good, id_col: str = "doc_id", text_col: str = "text",
             lost: float = 0.001, **fitting) -> tuple[DataFrame, Resampler]:
    """(id, log_weight, key, kept) of every row, and the resampler to draw whole rows with."""
    model, sample = fit(docs, labels, good, id_col, text_col, **fitting)
    scored = stored(model.scored(docs), "scored")
    ofgood = scored.join(F.broadcast(sample), scored[id_col] == sample["id"], "left_semi")
    bar = ofgood.agg(F.percentile_approx("log_weight", lost, 10_000)).first()[0]
    k = scored.where(F.col("log_weight") >= (float("-inf") if bar is None else bar)).count()
    model.cut = kth_largest(scored, "key", k) if k else float("inf")
    return scored.withColumn("kept", F.col("key") >= F.lit(model.cut)), model
