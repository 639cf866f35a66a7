"""Gates and triggers over run results and check results.

Every gate is a DataFrame operator, so it runs the same on ten results or
ten billion:

* run gates group by ``run_id`` with partial aggregates;
* check gates take the latest evaluation per check with ``max_by``;
* the batch trigger takes the next N evaluations per asset with a ranked
  window whose limit Spark applies before the shuffle (window group limit),
  so a hot asset sends at most N rows per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slipway.functions import in_folder, joined_sorted, node_label, run_key, status_ok
from slipway.operators.versions import latest_by


# --- build runs ------------------------------------------------------------

def run_summary(results: DataFrame, by: str = "run_id") -> DataFrame:
    """Per run: node count, failures, and whether it is clean (G1).

    A run is clean when it has nodes and all of them are success/pass; any
    other status (error, fail, warn, skipped) blocks it.
    """
    bad = ~F.coalesce(status_ok("status"), F.lit(False))
    return (results.groupBy(by)
            .agg(F.count(F.lit(1)).alias("nodes"), F.count_if(bad).alias("failures"))
            .select(by, "nodes", "failures",
                    ((F.col("nodes") > 0) & (F.col("failures") == 0)).alias("clean")))


def clean_run(results: DataFrame, run_id, by: str = "run_id") -> bool:
    """Gate for one run; an unknown or empty run is not clean."""
    row = (results.where(F.col(by) == F.lit(run_id))
           .agg(F.count(F.lit(1)).alias("n"),
                F.count_if(~F.coalesce(status_ok("status"), F.lit(False))).alias("bad"))
           .first())
    return bool(row and row["n"] and row["bad"] == 0)


def failed_nodes(results: DataFrame, by: str = "run_id") -> DataFrame:
    """Per run with failures: how many and which (A5).

    The list is built per run, and a run has at most as many nodes as its
    project, so the group is bounded by the project, not by the data.
    """
    bad = results.where(~F.coalesce(status_ok("status"), F.lit(False)))
    return (bad.groupBy(by)
            .agg(F.count(F.lit(1)).alias("failed_count"),
                 joined_sorted(node_label()).alias("failed_nodes")))


def marts_to_promote(results: DataFrame, by: str = "run_id",
                     folder: str = "marts") -> DataFrame:
    """Models under ``folder`` of clean runs.

    The gate is a partial aggregate per run joined back by a left-semi join;
    AQE splits a hot run on the probe side.
    """
    clean = run_summary(results, by).where("clean").select(by)
    marts = results.where((F.col("resource_type") == "model") & in_folder(folder))
    return marts.join(clean, on=by, how="left_semi").select(by, "name")


def run_report(results: DataFrame, by: str = "run_id", folder: str = "marts") -> DataFrame:
    """G1, A5, G2 and A6 for each run in one grouped pass: node and failure
    counts, whether it is clean, the sorted failure list, and the sorted
    marts to promote (empty unless clean)."""
    bad = ~F.coalesce(status_ok("status"), F.lit(False))
    is_mart = (F.col("resource_type") == "model") & in_folder(folder)
    agg = results.groupBy(by).agg(
        F.count(F.lit(1)).alias("nodes"),
        F.count_if(bad).alias("failures"),
        F.array_sort(F.collect_list(F.when(bad, node_label()))).alias("failed"),
        F.array_sort(F.collect_list(F.when(is_mart, F.col("name")))).alias("marts"))
    clean = (F.col("nodes") > 0) & (F.col("failures") == 0)
    return agg.select(by, "nodes", "failures", clean.alias("clean"), "failed",
                      F.when(clean, F.col("marts")).otherwise(F.array().cast("array<string>"))
                      .alias("to_promote"))


def promotion_summary(results: DataFrame, by: str = "run_id", folder: str = "marts") -> DataFrame:
    """Per clean run: number and sorted list of marts promoted."""
    return (marts_to_promote(results, by, folder).groupBy(by)
            .agg(F.count(F.lit(1)).alias("promoted_count"),
                 joined_sorted("name").alias("promoted")))


# --- check evaluations -------------------------------------------------------

def latest_checks(checks: DataFrame, keys=("asset", "check_name"),
                  order: str = "id") -> DataFrame:
    """Latest evaluation of every check."""
    cols = [c for c in checks.columns if c not in keys]
    return latest_by(checks, list(keys), order, cols)


def checks_gate(checks: DataFrame, by: str = "asset",
                blocking_only: bool = False) -> DataFrame:
    """Per asset: do the latest evaluations of all its checks pass?

    With no evaluations an asset has no row, and ``gate_for`` treats that as
    closed; ``bool_and`` over no rows is NULL, hence the coalesce.
    """
    latest = latest_checks(checks, (by, "check_name"))
    if blocking_only and "blocking" in latest.columns:
        latest = latest.where(F.coalesce(F.col("blocking"), F.lit(True)))
    return (latest.groupBy(by)
            .agg(F.count(F.lit(1)).alias("checks"),
                 F.count_if("passed").alias("passing"),
                 F.coalesce(F.bool_and("passed"), F.lit(False)).alias("gate")))


def gate_for(checks: DataFrame, asset: str, by: str = "asset",
             names: list[str] | None = None) -> bool:
    """Gate for one asset. With ``names`` (the checks defined now) every one
    of them needs a passing latest evaluation; one never evaluated keeps the
    gate closed, and evaluations of checks no longer defined are ignored."""
    src = checks.where(F.col(by) == asset)
    if names is not None:
        src = src.where(F.col("check_name").isin(list(names)))
    row = checks_gate(src, by).first()
    if names is not None and (row is None or row["checks"] != len(set(names))):
        return False
    return bool(row and row["gate"])


def failures_latest(checks: DataFrame, cursor: int = 0, check_name: str | None = None,
                    keys=("asset", "check_name"), carry=()) -> DataFrame:
    """Remediation requests when only the latest evaluation counts.

    For each check, its latest evaluation is a request when it is newer
    than the cursor and failed. The next cursor is the highest id seen.
    ``carry`` names more columns of the latest evaluation to return.
    """
    src = checks if check_name is None else checks.where(F.col("check_name") == check_name)
    src = src.where(F.col("id") > F.lit(cursor))  # older ones can't be the latest that counts
    latest = latest_checks(src.select(*keys, "id", "passed", *carry), keys)
    return (latest.where(~F.col("passed"))
            .select(*keys, "id", run_key("id").alias("run_key"), *carry))


def next_cursor(checks: DataFrame, cursor: int = 0) -> int:
    row = checks.agg(F.max("id").alias("m")).first()
    return max(cursor, int(row["m"])) if row and row["m"] is not None else cursor


def next_batch(checks: DataFrame, cursor: int = 0, limit: int = 20) -> DataFrame:
    """The next ``limit`` evaluations after the cursor, ascending.

    ``orderBy + limit`` plans as a top-N: each task keeps ``limit`` rows, so
    only ``limit`` rows per task cross the network.
    """
    return checks.where(F.col("id") > F.lit(cursor)).orderBy("id").limit(limit)


def failures_since(checks: DataFrame, cursor: int = 0, limit: int = 20,
                   check_name: str | None = None, by: str = "asset") -> DataFrame:
    """Remediation requests when every failure counts, in batches.

    Per asset, the next ``limit`` evaluations after the cursor in id order
    are scanned; those of ``check_name`` that failed become requests, and
    the asset's next cursor is the last id scanned, passed or not.
    """
    w = Window.partitionBy(by).orderBy("id")
    batch = (checks.where(F.col("id") > F.lit(cursor))
             .select(by, "id", "check_name", "passed")
             .withColumn("_rn", F.row_number().over(w))
             .where(F.col("_rn") <= limit))
    batch = batch.withColumn("cursor", F.max("id").over(Window.partitionBy(by)))
    hit = ~F.col("passed")
    if check_name is not None:
        hit = hit & (F.col("check_name") == check_name)
    return batch.where(hit).select(by, "id", "check_name",
                                   run_key("id").alias("run_key"), "cursor")
