"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the expected number of copies of each of
its documents. The whole part is certain; the fractional parts are rounded
together. Two fractional documents trade words at random, one giving what the
other takes, until the copies of one are integral; expectations stay as they
are and so does the source's number of words. Documents meet in bounded
groups by a hash of their id and text, each group leaves one fractional document at
most, a small one as the largest come first, and these meet again in groups of groups up to one per source, which is
rounded on its own. So a source misses its target by less than one document,
and a source with a third of all rows is spread like any other.

Edge cases: a null or empty text has size 0 and is not taken; a null source is
a source, the last; sources of size 0 have target 0; equal rows are rounded as
separate documents; an empty table gives an empty result; only the id, text
and source are read. Randomness comes from hashes of the ids: reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slipway.llm.arrays import mix
from slipway.llm.stored import stored

WORD = r"[^\x20\x09-\x0D]+"
UNITS = "doc_id long, source string, size long, whole double, part double, bucket long"


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target, from (source, source_size) rows.

    The share of all sizes is dealt by weight, none above ``most`` times its
    size. Sources reach that limit in the order of limit over weight, so the
    level at which the rest share by weight comes from running sums.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    level = Window.orderBy("ratio", F.asc_nulls_last("source"))
    before, on = level.rowsBetween(Window.unboundedPreceding, -1), level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    out = sizes.withColumn("weight", w).withColumn("limit", most * F.col("source_size")) \
        .withColumn("ratio", F.col("limit") / F.col("weight")) \
        .withColumn("at", (share * F.sum("source_size").over(everything)
                           - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(on)) \
        .withColumn("at", F.max(F.when(F.col("at") <= F.col("ratio"), F.col("at"))).over(everything))
    return out.select("source", "source_size",
                      F.least("limit", F.coalesce(F.col("at") * F.col("weight"), F.col("limit"))).alias("target"))


def _uniform(ids: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    h = mix(mix(ids.astype(np.int64).view(np.uint64)) ^ mix(sizes.astype(np.int64).view(np.uint64) + np.uint64(seed)))
    return (h >> np.uint64(11)).astype(float) / (1 << 53)


def settle(size: np.ndarray, part: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Rounds fractional copies pairwise; at most one stays fractional, and the sum of size * part is kept."""
    part, held = part.tolist(), -1
    size, chance = size.tolist(), chance.tolist()
    for j in range(len(part)):
        if held < 0:
            held = j
            continue
        i = held
        give = min(part[i] * size[i], (1 - part[j]) * size[j])  # words i could hand to j
        take = min(part[j] * size[j], (1 - part[i]) * size[i])
        if chance[j] * (give + take) < take:
            if part[i] * size[i] <= (1 - part[j]) * size[j]:
                part[i], part[j], held = 0.0, part[j] + give / size[j], j
            else:
                part[i], part[j], held = part[i] - give / size[i], 1.0, i
        elif part[j] * size[j] <= (1 - part[i]) * size[i]:
            part[i], part[j], held = part[i] + take / size[i], 0.0, i
        else:
            part[i], part[j], held = 1.0, part[j] - take / size[j], j
        if not 1e-12 < part[held] < 1 - 1e-12:
            part[held], held = float(round(part[held])), -1
    return np.array(part)


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 5,
                group: int = 4096, fan_in: int = 1024) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every row."""
    units = stored(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(id_col, text_col, F.lit(seed)).alias("mark")), "units")
    totals = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    goal = stored(targets(totals.select("source", "source_size"), weights, share, most)
                  .join(totals.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s")))
                  .drop("s"), "targets")
    rate = F.coalesce(F.least(F.try_divide(F.col("target"), F.col("source_size")), F.lit(float(most))), F.lit(0.0))
    split = units.withColumnRenamed("source", "of").join(
        goal.withColumn("rate", rate), F.col("of").eqNullSafe(F.col("source"))) \
        .select("doc_id", "source", "size", F.floor("rate").cast("double").alias("whole"),
                (F.col("rate") - F.floor("rate")).alias("part"),
                F.pmod("mark", F.ceil(F.col("n") / group)).alias("bucket"))
    open_ = (F.col("size") > 0) & (F.col("part") > 1e-12) & (F.col("part") < 1 - 1e-12)
    done = [split.where(~open_)]
    rest = split.where(open_)

    def step(level):
        def settled(rows: pd.DataFrame) -> pd.DataFrame:
            ids = rows["doc_id"].fillna(-1).to_numpy().astype(np.int64)
            size = rows["size"].to_numpy()
            # largest first: what is left open in the end is a small document
            order = np.lexsort((ids, _uniform(ids, size, seed + 2 * level), -size))
            rows = rows.iloc[order]
            chance = _uniform(ids, size, seed + 2 * level + 1)[order]
            return rows.assign(part=settle(rows["size"].to_numpy(float), rows["part"].to_numpy(), chance),
                               bucket=rows["bucket"] // fan_in)
        return settled

    groups, level = goal.agg(F.max(F.ceil(F.col("n") / group))).first()[0] or 0, 0
    while groups:
        now = stored(rest.groupBy("source", "bucket").applyInPandas(step(level), UNITS), "settled")
        done.append(now.where(~open_))
        rest, level = now.where(open_), level + 1
        groups = 0 if groups == 1 else -(-groups // fan_in)
    # one document of a source may be left
    h = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit(seed + 1000)), F.lit(1 << 30)) / float(1 << 30)
    done.append(rest.withColumn("part", F.when(h < F.col("part"), 1.0).otherwise(0.0)))
    every = done[0]
    for x in done[1:]:
        every = every.unionByName(x)
    copies = (F.col("whole") + F.round("part")).cast("long")
    return every.withColumnRenamed("source", "of") \
        .join(goal.select("source", "source_size", "target"), F.col("of").eqNullSafe(F.col("source"))) \
        .select("doc_id", "source", "size", "source_size", "target",
                F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).alias("copies")) \
        .withColumn("taken", F.col("copies") * F.col("size"))
