"""Tables between the jobs of one operator, in the shared folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

from slipway.session import scratch_path


def stored(df: DataFrame, kind: str = "llm") -> DataFrame:
    """Writes ``df`` as Parquet below ``spark.checkpoint.dir`` and reads it back.

    This cuts the lineage: what was computed is read, not computed again, when
    executors are lost, and several later jobs can use it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def workers_import(spark) -> None:
    """Lets Python workers on this machine import the library from where the driver has it.

    On a cluster the library is installed or given as ``--py-files``; then
    this changes nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in (had := env.get("PYTHONPATH", "")).split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, had]))
