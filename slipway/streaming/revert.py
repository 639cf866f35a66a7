"""Revert on failure as a Structured Streaming job.

The store's check evaluations are an append-only Parquet folder, so they
are a file stream. Evaluations of the watched tables flow into
``foreachBatch``; per batch and table, when the latest evaluation of any check
failed it triggers one revert carrying ``revert-<id>``. A failure recorded
before the table's latest publish is superseded by it and reverts nothing, so
the outcome does not depend on how the stream is cut into batches. A revert
that is not possible fails the stream.

* The stream checkpoint (in the store, on the shared file system) replaces
  the polling cursor: a restarted job resumes after the last batch.
* A batch replayed after a crash finds its run key already in the log and
  does nothing, so each evaluation reverts at most once (G7).
* Only one row per table and batch reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slipway import schemas
from slipway.functions import run_key
from slipway.store import NothingToRevert, Store


def failed_evaluations(store: Store, env: str = "green",
                       tables: Sequence[str] | None = None,
                       check_name: str | None = None,
                       failed_only: bool = True) -> DataFrame:
    """The stream of (failed) evaluations on ``env`` tables."""
    src = (store.spark.readStream.schema(schemas.CHECK_RESULTS)
           .option("maxFilesPerTrigger", 1000)
           .parquet(store.checks_path))
    cond = F.col("asset").startswith(f"{env}.")
    if failed_only:
        cond = cond & ~F.col("passed")
    if tables is not None:
        cond = cond & F.col("asset").isin([f"{env}.{t}" for t in tables])
    if check_name is not None:
        cond = cond & (F.col("check_name") == check_name)
    return src.where(cond).select("id", "asset", "check_name", "passed",
                                  F.col("metadata")["log_seq"].cast("bigint").alias("log_seq"))


def revert_batch(store: Store, env: str = "green", to: str = "previous"):
    """``foreachBatch`` handler: at most one revert per table per batch,
    when a check's latest evaluation in the batch failed."""

    def handle(batch: DataFrame, epoch_id: int) -> None:
        passed = F.col("passed") if "passed" in batch.columns else F.lit(False)
        latest = (batch.groupBy("asset", "check_name")
                  .agg(F.max_by(F.struct(passed.alias("passed"), F.col("log_seq")), "id")
                       .alias("last"), F.max("id").alias("id"))
                  .where(~F.col("last.passed"))
                  .groupBy("asset").agg(F.max_by(F.struct("id", F.col("last.log_seq").alias("log_seq")), "id").alias("r"))
                  .select("asset", "r.id", "r.log_seq", run_key("r.id").alias("run_key")))
        impossible = []
        for r in latest.collect():                       # one row per table
            table, at = r["asset"].split(".", 1)[1], int(r["log_seq"] or 0)
            if store.superseded(table, env, at):
                continue
            try:
                store.revert(table, env, run_key=r["run_key"], to=to, after_seq=at)
            except NothingToRevert as exc:
                impossible.append(str(exc))
        if impossible:
            raise NothingToRevert("; ".join(impossible))

    return handle


def revert_on_failure(store: Store, env: str = "green", tables: Sequence[str] | None = None,
                      check_name: str | None = None, checkpoint: str | None = None,
                      available_now: bool = True,
                      processing_time: str = "30 seconds",
                      to: str = "previous") -> StreamingQuery:
    """Start the stream. ``available_now`` processes what is there and stops
    (run it on a schedule); otherwise it polls every ``processing_time``."""
    writer = (failed_evaluations(store, env, tables, check_name, failed_only=False).writeStream
              .foreachBatch(revert_batch(store, env, to))
              .option("checkpointLocation", checkpoint or f"{store.root}/streams/revert-{env}"))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time))
    return writer.start()
