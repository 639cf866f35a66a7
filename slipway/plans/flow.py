"""End-to-end flows (E1-E3) composed from the store, checks and gates.

E1 ``publish_run``: clone green into blue, build every model into blue,
check the builds, and promote all marts in one commit only if every node of
the run is clean (G1, G2). Nothing partial ever reaches green.

E2 ``land`` + ``promote_if_passing``: a table landed outside the model
build; its checks are recorded and the latest evaluation of each must pass,
and blue must be newer than green, before green moves (G3, G4).

E3 ``check_live`` + ``remediate``: check the live green table; failures
become revert requests, at most one revert per evaluation (G5-G7).

Only run-level metadata (one row per model or check) reaches the driver.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipway import schemas
from slipway.operators import checks as C
from slipway.operators import gates as G
from slipway.operators import graph
from slipway.sources.seeds import classified, conform, literal_frame
from slipway.store import ConcurrentChange, NothingToRevert, Store

PROJECT = "slipway"


@dataclass
class RunReport:
    run_id: int
    clean: bool
    failures: list[str] = field(default_factory=list)
    promoted: list[str] = field(default_factory=list)
    seq: int | None = None
    skipped_reason: str | None = None
    errors: dict = field(default_factory=dict)


def asset_name(env: str, table: str) -> str:
    return f"{env}.{table}"


def layer_name(name: str) -> str:
    """The layer rule of ``functions.layer_of`` for names the driver holds."""
    from slipway.functions.scalar import STAGING_PREFIX
    return "staging" if name.startswith(STAGING_PREFIX) else "marts"


def select_models(models: Mapping[str, object], layer: str | None = None) -> dict:
    """The models a scheduled run builds: all of them, or one layer (a
    frequent marts-only run next to a full hourly one)."""
    return {n: m for n, m in models.items() if layer is None or layer_name(n) == layer}


def evaluate(store: Store, env: str, table: str, checks: Sequence[C.Check],
             written=None) -> DataFrame:
    """Evaluate checks on a stored version and record them."""
    return store.record_checks(asset_name(env, table),
                               check_results_for(store, env, table, checks, written),
                               {"checked_table": asset_name(env, table), "engine": "spark"})


def check_results_for(store: Store, env: str, table: str, checks: Sequence[C.Check],
                      written=None) -> DataFrame:
    """Check rows for a stored version (not recorded).

    Grouping-free checks come from the values observed during the write
    (when ``written`` is given); ``unique`` checks read just the key columns
    of the stored version.
    """
    checks = list(checks)
    uniq = [c for c in checks if c.kind == C.UNIQUE]
    if written is not None:
        extra = []
        if uniq:
            cols = sorted({k for c in uniq for k in c.columns})
            extra.append(C.run_checks(store.read_version(written).select(*cols), uniq))
        results = C.results_from_metrics(store.spark, checks, written.metrics, extra)
    else:
        results = C.run_checks(store.read(env, table), checks)
    return results


def publish_run(store: Store, models: Mapping[str, Callable[[], DataFrame] | DataFrame],
                checks: Mapping[str, Sequence[C.Check]] | None = None,
                marts: Sequence[str] | None = None, *, strategy: str = "promote",
                force_skip: bool = False, run_id: int | None = None,
                drop_extra: bool = True, threads: int = 4,
                layouts: Mapping[str, Sequence[str]] | None = None,
                depends: Mapping[str, Sequence[str]] | None = None) -> RunReport:
    """E1. ``models``: name -> DataFrame (or a function building it).

    ``marts`` are the models promoted (default: names starting ``mart_``);
    ``layouts`` maps a model to the columns its files are partitioned by;
    ``strategy`` is ``promote`` (blue keeps the build) or ``swap`` (blue
    gets the old green). ``force_skip`` withholds promotion of a clean run.

    ``depends`` maps a model to the models it is built from. Models are then
    built in waves, each tested before the next; a model below one that
    failed, or whose blocking check failed, is not built: it and its tests are
    nodes with status ``skipped`` (Q8). Each wave is one commit to blue, so a
    model given as a function can read its upstream models there. Promotion
    is refused when another writer has replaced a build of this run.
    """
    checks = checks or {}
    unknown = sorted(set(checks) - set(models))
    if unknown:
        raise ValueError(f"checks of tables that are not built: {unknown}")
    spark = store.spark
    run_id = run_id if run_id is not None else store.top_seq() + 1
    store.clone("green", "blue", drop_extra=drop_extra)

    nodes: list[tuple] = []
    written = {}
    errors: dict[str, str] = {}
    lock = threading.Lock()

    def folder_of(name):
        return "marts" if (marts is None and name.startswith("mart_")) or \
            (marts is not None and name in marts) else "staging"

    def build_one(name, model):
        fqn = [PROJECT, folder_of(name), name]
        try:
            df = model() if callable(model) else model
            w = store.write_version(name, df, checks.get(name, ()), (layouts or {}).get(name))
            status = "success"
        except Exception as exc:  # a failed model fails the run, not the process
            w, status = None, "error"
            errors[name] = f"{type(exc).__name__}: {str(exc)[:300]}"
        with lock:
            nodes.append((run_id, f"model.{PROJECT}.{name}", "model", name, fqn, status))
            if w is not None:
                written[name] = w

    def test_one(name):
        try:
            rows = check_results_for(store, "blue", name, checks[name], written[name]).collect()
        except Exception as exc:  # a test that cannot run fails the run, not the process
            with lock:
                errors[f"test {name}"] = f"{type(exc).__name__}: {str(exc)[:300]}"
                nodes.extend((run_id, f"test.{PROJECT}.{c.name}.{name}", "test", c.name, [PROJECT, "tests", name],
                              "error") for c in checks[name])
            rows = []
        meta = {"checked_table": asset_name("blue", name), "engine": "spark"}
        return (asset_name("blue", name), rows, meta)

    def skip(name):
        nodes.append((run_id, f"model.{PROJECT}.{name}", "model", name, [PROJECT, folder_of(name), name], "skipped"))
        nodes.extend((run_id, f"test.{PROJECT}.{c.name}.{name}", "test", c.name, [PROJECT, "tests", name], "skipped")
                     for c in checks.get(name, ()))

    depends = depends or {}
    evaluated, stopped, built_at = [], set(), {}
    for wave in graph.waves(depends, models):
        below = [n for n in wave if stopped & set(depends.get(n, ()))]
        for name in below:
            skip(name)
        stopped |= set(below)
        now = [n for n in wave if n not in stopped]
        # Independent models are separate Spark jobs; a few driver threads let
        # them share the executors instead of queueing (the reference runs 4).
        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            list(pool.map(lambda n: build_one(n, models[n]), now))
        done = [written[n] for n in now if n in written]
        seq = store.commit([{"env": "blue", "table_name": w.table_name, "action": "build",
                             "paths": w.paths, "row_count": w.row_count,
                             "run_key": f"run-{run_id}", "schema_json": w.schema_json} for w in done])
        built_at |= {w.table_name: seq for w in done}
        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            tested = list(pool.map(test_one, sorted(n for n in now if n in written and checks.get(n))))
        evaluated += tested
        stopped |= {n for n in now if n not in written or f"test {n}" in errors}
        stopped |= {asset.split(".", 1)[1] for asset, rows, _ in tested
                    if any(r["blocking"] and not r["passed"] for r in rows)}
    store.record_many(evaluated)                   # one file for the whole run
    for asset, rows, _ in evaluated:
        name = asset.split(".", 1)[1]
        nodes.extend((run_id, f"test.{PROJECT}.{r['check_name']}.{name}", "test",
                      r["check_name"], [PROJECT, "tests", name],
                      "pass" if r["passed"] else ("fail" if r["blocking"] else "warn"))
                     for r in rows)

    results = literal_frame(spark, nodes, schemas.RUN_RESULTS)
    summary = G.run_report(results).first()          # one row: this run
    clean = bool(summary and summary["clean"])
    report = RunReport(run_id, clean,
                       failures=list(summary["failed"]) if summary else [],
                       errors=errors)
    if not clean:
        report.skipped_reason = "run not clean"
        return report
    if force_skip:
        report.skipped_reason = "promotion withheld"
        return report
    to_promote = sorted(summary["to_promote"])
    if to_promote:
        move = store.swap if strategy == "swap" else store.promote
        try:
            report.seq = move(to_promote, "blue", "green", run_key=f"run-{run_id}",
                              expect={t: built_at[t] for t in to_promote})
        except ConcurrentChange as exc:
            report.skipped_reason = str(exc)
            return report
        report.promoted = to_promote
    return report


def land(store: Store, table: str, df: DataFrame, checks: Sequence[C.Check],
         env: str = "blue", schema=None) -> DataFrame:
    """E2 first half: write a table into ``env`` (conformed to ``schema``
    when given) and record its checks."""
    if schema is not None:
        df = conform(df, schema)
    written = store.build({table: df}, env=env, checks={table: checks})[table]
    return evaluate(store, env, table, checks, written)


def land_seed(store: Store, table: str, texts: DataFrame, schema, env: str = "blue", max_share: float = 0.0) -> DataFrame:
    """Land text rows: those that fit ``schema`` as ``table``, the others with their reasons as
    ``<table>__rejects``, both in one commit. Records the blocking check ``rejected_rows``, which passes
    if at most ``max_share`` of all rows were rejected (no rows at all: passes), and returns it."""
    good, bad = store.write_split(table, f"{table}__rejects", classified(texts, schema), schema)
    store.commit([{"env": env, "table_name": w.table_name, "action": "build", "paths": w.paths,
                   "row_count": w.row_count, "schema_json": w.schema_json} for w in (good, bad)])
    passed = bad.row_count <= max_share * (good.row_count + bad.row_count)
    result = literal_frame(store.spark, [("rejected_rows", "rejected", bad.row_count, passed, "ERROR", True)],
                           C.RESULT_SCHEMA)
    return store.record_checks(asset_name(env, table), result)


def promote_if_passing(store: Store, table: str, src: str = "blue", dst: str = "green",
                       bootstrap: bool = False,
                       checks: Sequence[C.Check] | None = None) -> int | None:
    """E2 second half: promote when every check's latest evaluation on the
    source passes (G3) and the source is newer than the destination (G4).
    ``checks``, when given, is the suite defined now: each must have a
    passing latest evaluation. ``bootstrap`` allows the first publish, when
    there is no destination."""
    names = [c.name for c in checks] if checks is not None else None
    build = store.version(src, table)
    if build is None:
        return None
    # only evaluations of this build count, not those of an earlier one
    of_build = store.check_results().where(F.col("metadata")["log_seq"].cast("bigint") >= build.seq)
    if not G.gate_for(of_build, asset_name(src, table), names=names):
        return None
    fresh, first = store.freshness(table, src, dst)
    if not (fresh or (bootstrap and first)):
        return None
    return store.promote([table], src, dst, expect={table: build.seq})


def check_live(store: Store, table: str, key: str = "order_id", env: str = "green",
               check_name: str | None = None) -> DataFrame:
    """The duplicate-key check on the live table (Q5).

    A missing table passes with 0 duplicates and ``missing=true``.
    """
    chk = C.unique(key, name=check_name or f"no_duplicate_{key}s")
    if store.version(env, table) is None:
        results = literal_frame(store.spark,
                                [(chk.name, chk.metric, 0, True, chk.severity, chk.blocking)],
                                C.RESULT_SCHEMA)
        meta = {"missing": "true"}
    else:
        results = C.run_checks(store.read(env, table).select(key), [chk])
        meta = {}
    return store.record_checks(asset_name(env, table), results,
                               {"checked_table": asset_name(env, table), "engine": "spark",
                                **meta})


def remediate(store: Store, cursor: int = 0, check_name: str | None = None,
              env: str = "green", mode: str = "latest", limit: int = 20,
              to: str = "previous"):
    """Turn failed evaluations after ``cursor`` into reverts.

    ``mode='latest'`` acts on each check's latest evaluation only (G5), with
    one revert per table (for its newest failing evaluation);
    ``mode='all'`` scans the next ``limit`` evaluations after the cursor in
    id order and acts on every failure among them; the next cursor is the
    last id scanned (G6). Each revert carries ``revert-<id>`` so a repeated
    call does nothing (G7).
    The cursor may be the stored text form; none counts as 0 (F12, P13).
    Returns (reverted tables, next cursor).
    """
    cursor = int(cursor) if cursor not in (None, "") else 0
    results = store.check_results().where(F.col("asset").startswith(f"{env}."))
    if mode == "latest":
        with_pos = results.withColumn("log_seq", F.col("metadata")["log_seq"])
        failing = G.failures_latest(with_pos, cursor, check_name, carry=("log_seq",))
        # several failing checks on one table: one revert, for the newest
        reqs = (failing.groupBy("asset")
                .agg(F.max_by(F.struct("id", "run_key", "log_seq"), "id").alias("r"))
                .select("asset", "r.*").collect())
        new_cursor = G.next_cursor(results, cursor)
    else:
        batch = G.next_batch(results, cursor, limit).collect()
        new_cursor = batch[-1]["id"] if batch else cursor
        reqs = [{"asset": r["asset"], "id": r["id"], "run_key": f"revert-{r['id']}",
                 "log_seq": (r["metadata"] or {}).get("log_seq")}
                for r in batch if not r["passed"]
                and (check_name is None or r["check_name"] == check_name)]
    done, impossible = [], []
    for r in sorted(reqs, key=lambda r: r["id"]):
        table, at = r["asset"].split(".", 1)[1], int(r["log_seq"] or 0)
        if store.superseded(table, env, at):
            continue
        try:
            if store.revert(table, env, run_key=r["run_key"], to=to, after_seq=at) is not None:
                done.append(table)
        except NothingToRevert as exc:
            impossible.append(str(exc))
    if impossible:  # the others are done; a repeat does not revert them again
        raise NothingToRevert("; ".join(impossible))
    return done, new_cursor
