"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipway.llm.stored import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30)))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (u, v): the smallest id it reaches.

    Large-star and small-star rounds alternate until the edges stay the same:
    each id ends up linked to the smallest alone. The number of rounds grows
    with the logarithm of the longest path; each round is written to the shared
    folder. A hub is a partial aggregate and a join, which AQE can split.
    """
    u, v = F.col("u"), F.col("v")
    edges = stored(links.where(u != v).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where(v > u).join(least, "u").select(v.alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(v == F.col("m"), u).otherwise(v).alias("u"),
                                              F.col("m").alias("v")).where(u != v).distinct()
        edges, before = stored(small, "edges"), state
        state = _state(edges)
        if state == before:
            break
    return edges.select(u.alias("id"), v.alias("component")) \
        .unionByName(edges.select(v.alias("id"), v.alias("component"))).distinct()
