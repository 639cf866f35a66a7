"""

Every query reads whole generated tables (or data Spark derives from them)
and has a DuckDB oracle over the same Parquet files. The mapping from the
generated tables to the library's inputs is in ``slipway/sources/testdata.py``.
The round-trip queries write into a fresh store under the session's
``spark.checkpoint.dir`` and return what the live environment serves after
the flow; their oracle is the table that should be live.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from slipway.operators import checks as C  # noqa: E402
from slipway.operators import gates as G  # noqa: E402
from slipway.operators import diff, graph  # noqa: E402
from slipway.operators import versions as V  # noqa: E402
from slipway.plans import models as M  # noqa: E402
from slipway.plans import flow, incremental, unique_index  # noqa: E402
from slipway.functions import cursor_value, is_truthy, schema_name  # noqa: E402
from slipway.plans import sql_models  # noqa: E402
from slipway.schemas import NATIVE_ORDERS, RAW_CUSTOMERS, RAW_ORDERS  # noqa: E402
from slipway.session import scratch_path  # noqa: E402
from slipway.sources import classified, literal_frame, read_seed, read_texts  # noqa: E402
from slipway.sources import testdata as TD  # noqa: E402
from slipway.store import ConcurrentChange, Store  # noqa: E402
from slipway.streaming import revert_on_failure  # noqa: E402

try:  # the corpus operators and their pipeline can be left out as a whole
    import corpus_pipeline  # noqa: F401, E402
    from slipway.llm import queries as LLM  # noqa: E402
except ImportError:
    LLM = None

SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF = "1998-01-01 00:00:00"
WATCHED_CHECK = "error"
BATCH = 20


# --- models -------------------------------------------------------------------

def _stg(spark, sf_dir):
    return (M.stg_orders(TD.raw_orders(spark, sf_dir)),
            M.stg_customers(TD.raw_customers(spark, sf_dir)))


def q_stg_orders(spark, sf_dir):
    return M.stg_orders(TD.raw_orders(spark, sf_dir))


def q_stg_customers(spark, sf_dir):
    return M.stg_customers(TD.raw_customers(spark, sf_dir))


def q_mart_orders(spark, sf_dir):
    o, c = _stg(spark, sf_dir)
    return M.mart_orders(o, c)


def _rounded(customers):
    """A double sum depends on the order of its rows in the last digits, so what is compared is rounded."""
    return customers.withColumn("lifetime_revenue", F.round("lifetime_revenue", 2))


def q_mart_customers(spark, sf_dir):
    o, c = _stg(spark, sf_dir)
    return _rounded(M.mart_customers(c, o))


def _sql_marts(spark, sf_dir):
    return sql_models.build_marts_sql(spark, TD.raw_orders(spark, sf_dir),
                                      TD.raw_customers(spark, sf_dir))


def q_mart_orders_sql(spark, sf_dir):
    return _sql_marts(spark, sf_dir)["mart_orders"]


def q_mart_customers_sql(spark, sf_dir):
    return _rounded(_sql_marts(spark, sf_dir)["mart_customers"])


# --- checks -------------------------------------------------------------------

def native_orders(spark, sf_dir):
    """Orders landed natively: typed, with the native column names."""
    return TD.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total"), F.col("o_orderdate").alias("ordered_at"))


NATIVE_SQL = ("SELECT o_orderkey AS order_id, o_custkey AS customer_id, "
              "o_totalprice AS total, o_orderdate AS ordered_at FROM orders")

LINEITEM_CHECKS = [C.row_count_positive(), C.unique("l_orderkey"),
                   C.unique("l_orderkey", "l_linenumber"), C.not_null("l_partkey"),
                   C.positive("l_quantity")]


def q_check_row_count(spark, sf_dir):
    return C.run_checks(native_orders(spark, sf_dir), [C.row_count_positive()])


def q_check_not_null(spark, sf_dir):
    return C.run_checks(native_orders(spark, sf_dir), [C.not_null("order_id")])


def q_check_duplicates(spark, sf_dir):
    return C.run_checks(TD.table(spark, sf_dir, "lineitem"), [C.unique("l_orderkey")])


def q_check_positive(spark, sf_dir):
    return C.run_checks(native_orders(spark, sf_dir), [C.positive("total")])


def q_check_suite_fused(spark, sf_dir):
    return C.run_checks(native_orders(spark, sf_dir), C.native_suite())


def q_check_suite_lineitem(spark, sf_dir):
    return C.run_checks(TD.table(spark, sf_dir, "lineitem"), LINEITEM_CHECKS)


def _tag(df, model):
    return df.select(F.lit(model).alias("model"), "*")


def _built(spark, sf_dir):
    """Both marts as written, so that a test reads their keys and rebuilds nothing."""
    store = Store.scratch(spark)
    store.build(_marts(spark, sf_dir))
    return store.snapshot("blue")


def q_generic_not_null(spark, sf_dir):
    o, c = _stg(spark, sf_dir)
    marts = _built(spark, sf_dir)
    parts = [("stg_orders", o, "order_id"), ("stg_customers", c, "customer_id"),
             ("mart_orders", marts.read("mart_orders"), "order_id"),
             ("mart_customers", marts.read("mart_customers"), "customer_id")]
    out = None
    for model, df, col in parts:
        r = _tag(C.run_checks(df, [C.not_null(col)]), model)
        out = r if out is None else out.unionByName(r)
    return out


def q_generic_unique(spark, sf_dir):
    marts = _built(spark, sf_dir)
    a = _tag(C.run_checks(marts.read("mart_orders"), [C.unique("order_id", ignore_nulls=True)]),
             "mart_orders")
    b = _tag(C.run_checks(marts.read("mart_customers"),
                          [C.unique("customer_id", ignore_nulls=True)]), "mart_customers")
    return a.unionByName(b)


# --- gates ---------------------------------------------------------------------

def q_clean_run_gate(spark, sf_dir):
    return G.run_summary(TD.run_results(spark, sf_dir))


def q_failed_nodes(spark, sf_dir):
    return G.failed_nodes(TD.run_results(spark, sf_dir))


def q_marts_to_promote(spark, sf_dir):
    return G.marts_to_promote(TD.run_results(spark, sf_dir))


def q_promotion_summary(spark, sf_dir):
    return G.promotion_summary(TD.run_results(spark, sf_dir))


def q_latest_checks(spark, sf_dir):
    return G.latest_checks(TD.check_log(spark, sf_dir))


def q_checks_gate(spark, sf_dir):
    return G.checks_gate(TD.check_log(spark, sf_dir))


def q_failures_latest(spark, sf_dir):
    return G.failures_latest(TD.check_log(spark, sf_dir), cursor=0)


def q_failures_since(spark, sf_dir):
    return G.failures_since(TD.check_log(spark, sf_dir), cursor=0, limit=BATCH,
                            check_name=WATCHED_CHECK)


def q_model_layer(spark, sf_dir):
    return M.model_layers(TD.run_results(spark, sf_dir))


# --- publish log ---------------------------------------------------------------

def _state_out(state):
    return state.select("env", "table_name", "seq", "ts", "action",
                        V.as_path().alias("path"), "row_count", "run_key")


def q_resolve_now(spark, sf_dir):
    return _state_out(V.resolve(TD.publish_log(spark, sf_dir)))


def q_resolve_as_of(spark, sf_dir):
    return _state_out(V.resolve(TD.publish_log(spark, sf_dir), as_of=AS_OF))


def q_is_fresh(spark, sf_dir):
    return V.freshness(TD.publish_log(spark, sf_dir))


def q_list_clonable(spark, sf_dir):
    return V.clonable(V.resolve(TD.publish_log(spark, sf_dir)), env="green")


def q_append_sample(spark, sf_dir):
    mart = q_mart_orders(spark, sf_dir)
    return mart.unionByName(mart.orderBy("order_id").limit(1))


# --- publish, swap, revert round trips (each in a fresh store) ------------------
#
# Each builds the marts from the whole generated tables into a new store
# under the session's shared checkpoint folder, runs a flow, and returns
# what green (or blue) serves afterwards. The oracle is the expected table.

MART_CHECKS = {
    "mart_orders": [C.not_null("order_id"), C.unique("order_id", ignore_nulls=True)],
    "mart_customers": [C.not_null("customer_id"), C.unique("customer_id", ignore_nulls=True)],
}


def _marts(spark, sf_dir):
    return M.build_marts(TD.raw_orders(spark, sf_dir), TD.raw_customers(spark, sf_dir))


def _with_duplicate(df, key):
    return df.unionByName(df.orderBy(key).limit(1))


def q_publish_roundtrip(spark, sf_dir):
    store = Store.scratch(spark)
    report = flow.publish_run(store, _marts(spark, sf_dir), MART_CHECKS)
    assert report.clean, report
    return store.read("green", "mart_orders")


def q_publish_partitioned(spark, sf_dir):
    """The same publish with ``mart_orders`` laid out by day, so readers
    filtering on ``ordered_date`` skip whole folders."""
    store = Store.scratch(spark)
    report = flow.publish_run(store, _marts(spark, sf_dir), MART_CHECKS,
                              layouts={"mart_orders": ["ordered_date"]})
    assert report.clean, report
    return store.read("green", "mart_orders")


def q_snapshot_customers(spark, sf_dir):
    """Publish, then serve green as SQL views from one snapshot."""
    store = Store.scratch(spark)
    flow.publish_run(store, _marts(spark, sf_dir), MART_CHECKS)
    prefix = f"green_{store.root.rsplit('/', 1)[-1][:8]}_"
    store.snapshot("green").register(prefix)
    return _rounded(spark.sql(f"SELECT * FROM {prefix}mart_customers"))


def q_swap_roundtrip(spark, sf_dir):
    store = Store.scratch(spark)
    marts = _marts(spark, sf_dir)
    flow.publish_run(store, marts, MART_CHECKS, strategy="swap")
    store.build({"mart_orders": _with_duplicate(marts["mart_orders"], "order_id")}, env="blue")
    store.swap(["mart_orders"])
    snap_g, snap_b = store.snapshot("green"), store.snapshot("blue")
    return (snap_g.read("mart_orders").select(F.lit("green").alias("env"), "*")
            .unionByName(snap_b.read("mart_orders").select(F.lit("blue").alias("env"), "*")))


def _corrupted_live(spark, sf_dir):
    """Two clean publishes that differ in every order, then one live row appended to green twice over."""
    store = Store.scratch(spark)
    marts = _marts(spark, sf_dir)
    first = marts["mart_orders"].withColumn("order_total", F.col("order_total") + 1)
    flow.publish_run(store, dict(marts, mart_orders=first), MART_CHECKS)
    flow.publish_run(store, marts, MART_CHECKS)
    live = store.read("green", "mart_orders")
    store.append("green", "mart_orders", live.orderBy("order_id").limit(1))
    flow.check_live(store, "mart_orders", key="order_id")
    return store


def q_revert_roundtrip(spark, sf_dir):
    """A revert after days without a publish: what it restores has not expired."""
    import datetime as dt
    store = _corrupted_live(spark, sf_dir)
    store.expire(now=store.version("green", "mart_orders").ts + dt.timedelta(days=3))
    done, _ = flow.remediate(store, cursor=0, check_name="no_duplicate_order_ids")
    assert done == ["mart_orders"], done
    return store.read("green", "mart_orders")


def q_revert_by_time(spark, sf_dir):
    """A clean publish, then two bad ones forced through; revert by time to
    the clean one (one level back would still be bad)."""
    store = Store.scratch(spark)
    marts = _marts(spark, sf_dir)
    flow.publish_run(store, marts, MART_CHECKS)
    good = store.version("green", "mart_orders")
    bad = _with_duplicate(marts["mart_orders"], "order_id")
    for _ in range(2):
        store.build({"mart_orders": bad}, env="blue")
        store.promote(["mart_orders"])
    store.revert("mart_orders", as_of=good.ts)
    return store.read("green", "mart_orders")


def q_remediate_batch(spark, sf_dir):
    """Live corruption found by the check twice; in batch mode every failed
    evaluation in the next 20 fires its own revert, and repeating a revert
    restores the same state. A second pass over the same batch does nothing."""
    store = _corrupted_live(spark, sf_dir)
    flow.check_live(store, "mart_orders", key="order_id")   # a second failing evaluation
    done, cursor = flow.remediate(store, cursor=0, mode="all", limit=20)
    assert done == ["mart_orders", "mart_orders"], done
    again, _ = flow.remediate(store, cursor=0, mode="all", limit=20)
    assert again == [], again
    return store.read("green", "mart_orders")


def q_store_append(spark, sf_dir):
    """Append one row of the live table to itself through the store: only
    the new row is written, and green's file list grows by one folder."""
    store = Store.scratch(spark)
    flow.publish_run(store, _marts(spark, sf_dir), MART_CHECKS)
    live = store.read("green", "mart_orders")
    store.append("green", "mart_orders", live.orderBy("order_id").limit(1))
    v = store.version("green", "mart_orders")
    assert len(v.paths) == 2 and v.row_count == live.count() + 1, v
    return store.read("green", "mart_orders")


def q_expire_roundtrip(spark, sf_dir):
    """Three publishes, then expire everything outside a zero-second window as
    seen from a day later: the first versions go, what is live and what a
    revert restores stays."""
    import datetime as dt
    store = Store.scratch(spark)
    for _ in range(3):
        flow.publish_run(store, _marts(spark, sf_dir), MART_CHECKS)
    later = store.version("green", "mart_orders").ts + dt.timedelta(days=1)
    gone = store.expire(retain_seconds=0, now=later)
    assert len(gone) == 2, gone                      # the first build of each mart
    return store.read("green", "mart_orders")


def q_audit_trail(spark, sf_dir):
    """The publish log as the audit trail of two runs, a live corruption and
    its remediation: every pointer move with its row count and run key."""
    store = Store.scratch(spark)
    for _ in range(2):
        flow.publish_run(store, _marts(spark, sf_dir), MART_CHECKS)
    live = store.read("green", "mart_orders")
    store.append("green", "mart_orders", live.orderBy("order_id").limit(1))
    flow.check_live(store, "mart_orders", key="order_id")
    flow.remediate(store, cursor=0)
    return store.history().select("seq", "env", "table_name", "action", "row_count", "run_key")


def q_stream_revert(spark, sf_dir):
    store = _corrupted_live(spark, sf_dir)
    q = revert_on_failure(store, tables=["mart_orders"], check_name="no_duplicate_order_ids")
    q.awaitTermination(600)
    return store.read("green", "mart_orders")


def q_blocked_promotion(spark, sf_dir):
    store = Store.scratch(spark)
    marts = _marts(spark, sf_dir)
    flow.publish_run(store, marts, MART_CHECKS)
    bad = dict(marts, mart_customers=_with_duplicate(marts["mart_customers"], "customer_id"))
    report = flow.publish_run(store, bad, MART_CHECKS)
    assert not report.clean and not report.promoted, report
    return _rounded(store.read("green", "mart_customers"))


def q_clone_env(spark, sf_dir):
    store = Store.scratch(spark)
    marts = _marts(spark, sf_dir)
    flow.publish_run(store, marts, MART_CHECKS)
    store.build({"blue_only": marts["mart_orders"]}, env="blue")
    store.clone("green", "blue", drop_extra=True)
    return store.state(env="blue").select("table_name", "action", "row_count")


def q_native_land_promote(spark, sf_dir):
    store = Store.scratch(spark)
    good = native_orders(spark, sf_dir)
    suite = C.native_suite()
    flow.land(store, "orders", good, suite, schema=NATIVE_ORDERS)
    assert flow.promote_if_passing(store, "orders", bootstrap=True, checks=suite) is not None
    flow.land(store, "orders", _with_duplicate(good, "order_id"), suite, schema=NATIVE_ORDERS)
    assert flow.promote_if_passing(store, "orders", checks=suite) is None
    return store.read("green", "orders")


def q_native_check_results(spark, sf_dir):
    store = Store.scratch(spark)
    flow.land(store, "orders", native_orders(spark, sf_dir), C.native_suite())
    return store.check_results().select("check_name", "metric", "value", "passed",
                                        "severity", "blocking")


def q_concurrent_appends(spark, sf_dir):
    """Two writers, each with a store of its own and no common lock, append a share of the orders in turn.

    Half of their commits meet a number that the other has taken; none is lost, and a promotion of a
    build that the other writer has replaced is refused.
    """
    first = Store.scratch(spark)
    second = Store(spark, first.root)
    mart = first.persisted(q_mart_orders(spark, sf_dir))  # joined once, not for each append
    first.build({"mart_orders": mart.where(F.col("order_id") % 7 == 0)}, env="green")

    def append(store, parts):
        for k in parts:
            store.append("green", "mart_orders", mart.where(F.col("order_id") % 7 == k))

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(append, (first, second), ((1, 2, 3), (4, 5, 6))))
    checked = first.commit_of(first.build({"mart_orders": mart.limit(0)}), "blue")
    second.build({"mart_orders": mart.where("order_id % 7 = 0")})
    try:
        first.promote(["mart_orders"], expect=checked)
        raise AssertionError("a replaced build was promoted")
    except ConcurrentChange:
        return Store(spark, first.root).read("green", "mart_orders")


def _changing_orders(spark, sf_dir, store, after=lambda: None):
    """Orders in blue that reach their true state by a build, an append, a merge and a deletion, with ``after`` each."""
    o, _ = _stg(spark, sf_dir)
    k, twist = F.col("order_id") % 10, F.col("ordered_at") + F.expr("INTERVAL 400 DAYS")
    early = o.where(k != 0).withColumn("order_total", F.when(k == 1, F.col("order_total") + 7.25).otherwise(F.col("order_total"))) \
        .withColumn("ordered_at", F.when(k == 1, twist).otherwise(F.col("ordered_at")))
    wrong = o.where(k == 3).withColumn("order_id", -F.col("order_id") - 1).withColumn("ordered_at", twist)
    for step in (lambda: store.build({"stg_orders": early}),
                 lambda: store.append("blue", "stg_orders", o.where(k == 0).unionByName(wrong)),
                 lambda: store.merge("blue", "stg_orders", o.where(k == 1), ["order_id"]),
                 lambda: store.merge("blue", "stg_orders", None, ["order_id"], delete=wrong)):
        step()
        after()


def q_incremental_customers(spark, sf_dir):
    """The mart refreshed from changed orders alone, after an append, updates and deletions."""
    store = Store.scratch(spark)
    _, c = _stg(spark, sf_dir)
    how = []
    _changing_orders(spark, sf_dir, store, lambda: how.append(incremental.refresh_customers(store, c)))
    assert how == ["full", "changes", "changes", "changes"], how
    return _rounded(store.read("blue", "mart_customers"))


def q_version_changes(spark, sf_dir):
    """What lies between the first build of the orders and their last state: rows and by how many copies."""
    store = Store.scratch(spark)
    _changing_orders(spark, sf_dir, store)
    return store.changes(store.version_at("blue", "stg_orders", 1), store.version("blue", "stg_orders"))


def q_changed_keys(spark, sf_dir):
    """The orders that a revert to the first build would touch, as added, removed or changed."""
    return diff.changed_keys(q_version_changes(spark, sf_dir), ["order_id"])


def q_unique_from_changes(spark, sf_dir):
    """Duplicate keys after each change of the orders, found from the rows that changed: order 3's twins come and go."""
    store = Store.scratch(spark)
    o, _ = _stg(spark, sf_dir)
    keys = [C.unique("order_id"), C.unique("customer_id", "ordered_at")]
    k, out = F.col("order_id") % 10, []

    def check(step):
        for c in keys:
            out.append(unique_index.unique_check(store, "blue", "stg_orders", c).select(F.lit(step).alias("step"), "*"))

    store.build({"stg_orders": o.where(k != 0)})
    check(1)
    store.append("blue", "stg_orders", o.where(k.isin(0, 3)))
    check(2)
    store.merge("blue", "stg_orders", o.where(k == 3), ["order_id"])
    check(3)
    return reduce(lambda a, b: a.unionByName(b), out)


def q_blocked_models(spark, sf_dir):
    """Every node of every run with what it comes to: skipped below a failed one."""
    return graph.effective_status(TD.graph_nodes(spark, sf_dir), TD.graph_edges(spark, sf_dir))


def q_blocking_check_run(spark, sf_dir):
    """The marts are built from the staging models; a duplicate customer fails that model's blocking check, so both
    marts are skipped. Returns the nodes of the run that are in blue: the staging models, as built."""
    store = Store.scratch(spark)
    o, c = _stg(spark, sf_dir)
    models = {"stg_orders": o, "stg_customers": _with_duplicate(c, "customer_id"), **_marts(spark, sf_dir)}
    report = flow.publish_run(store, models, {"stg_customers": [C.unique("customer_id")], **MART_CHECKS},
                              depends={"mart_orders": ["stg_orders", "stg_customers"],
                                       "mart_customers": ["stg_orders", "stg_customers"]})
    assert not report.promoted and not store.versions("green"), report
    return store.state(env="blue").select("table_name", "action", "row_count")


# --- seeds, existence, clones and flags ------------------------------------------

def _csv(spark, df):
    """The rows as CSV with a header, where every executor can read them."""
    path = f"{scratch_path(spark)}/seed"
    df.write.option("header", True).csv(path)
    return path


def q_seed_load(spark, sf_dir):
    """Orders and customers as CSV seeds, read with their schemas and built into the mart."""
    o = read_seed(spark, _csv(spark, TD.raw_orders(spark, sf_dir)), RAW_ORDERS)
    c = read_seed(spark, _csv(spark, TD.raw_customers(spark, sf_dir)), RAW_CUSTOMERS)
    return M.mart_orders(M.stg_orders(o), M.stg_customers(c))


SEED_ORDERS = T.StructType([T.StructField(f.name, f.dataType, f.name != "order_id") for f in RAW_ORDERS.fields])


def _dirty_orders(spark, sf_dir):
    """Orders as the lines of a CSV; those whose number leaves 3, 5, 7 or 9 modulo 101 are spoilt."""
    k, o = F.col("order_id") % 101, TD.raw_orders(spark, sf_dir)
    text = [F.col(c).cast("string") for c in o.columns]
    text[1] = F.when(k == 3, F.lit("c-1")).otherwise(text[1])
    text[2] = F.when(k.isin(3, 5), F.lit("12,5")).otherwise(text[2])
    text[0] = F.when(k == 7, F.lit("")).otherwise(text[0])
    quoted = [F.concat(F.lit('"'), t, F.lit('"')) for t in text]
    line = F.concat_ws(",", F.when(k == 7, F.lit("")).otherwise(quoted[0]), *quoted[1:], F.when(k == 9, F.lit("more")))
    path = f"{scratch_path(spark)}/dirty"
    o.select(line.alias("line")).write.option("header", False).text(path)
    return read_texts(spark, path, SEED_ORDERS, header=False)


def q_rejected_rows(spark, sf_dir):
    """Why rows of a spoilt seed are rejected, and how many are good: one row per customer and reasons."""
    rows = classified(_dirty_orders(spark, sf_dir), SEED_ORDERS)
    return rows.groupBy(F.array_join("reasons", "; ").alias("reasons"), "customer_id").agg(F.count(F.lit(1)).alias("n"))


def q_quarantined_seed(spark, sf_dir):
    """A spoilt seed is landed: its good rows are promoted, as fewer than a tenth are rejected, but not with a limit of none."""
    store, texts = Store.scratch(spark), _dirty_orders(spark, sf_dir)
    flow.land_seed(store, "orders", texts, SEED_ORDERS)
    assert flow.promote_if_passing(store, "orders", bootstrap=True) is None
    flow.land_seed(store, "orders", texts, SEED_ORDERS, max_share=0.1)
    assert flow.promote_if_passing(store, "orders", bootstrap=True) is not None
    served = store.read("green", "orders")
    rejects = store.read("blue", "orders__rejects")
    return served.select("order_id", "customer_id", F.lit(None).cast("string").alias("reasons")).unionByName(
        rejects.select(F.col("given.order_id").cast("bigint").alias("order_id"), F.lit(None).cast("bigint").alias("customer_id"),
                       F.array_join("reasons", "; ").alias("reasons")))


def q_literal_rows(spark, sf_dir):
    """Inline rows that give each kind of node its strategy, joined with all nodes of the runs."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("resource_type", "strategy")])
    kinds = literal_frame(spark, [("model", "blue_green"), ("seed", "none"), ("test", None)], schema)
    return TD.run_results(spark, sf_dir).join(kinds, "resource_type", "left") \
        .groupBy("resource_type", "strategy").agg(F.count(F.lit(1)).alias("nodes"))


def q_live_checks(spark, sf_dir):
    """The duplicate check on the live orders, doubled in part, and on a table that was never published."""
    store, o = Store.scratch(spark), native_orders(spark, sf_dir)
    store.build({"orders": o.unionByName(o.where("order_id % 3 = 0"))}, env="green")
    flow.check_live(store, "orders")
    flow.check_live(store, "no_orders")
    return store.check_results().select("asset", "check_name", "value", "passed",
                                        F.coalesce(F.col("metadata")["missing"], F.lit("false")).alias("missing"))


def q_existence(spark, sf_dir):
    return V.existence(TD.publish_log(spark, sf_dir))


def q_clone_keeps_extra(spark, sf_dir):
    """An empty green gives nothing to clone; a clone that keeps what only blue has; an environment made by its first table."""
    store = Store.scratch(spark)
    marts = _marts(spark, sf_dir)
    store.build({"blue_only": marts["mart_customers"]})
    assert store.clone("green", "blue", drop_extra=False) is None and store.top_seq() == 1
    assert not store.exists("green")
    store.build(marts, env="green")
    assert store.exists("green")
    store.clone("green", "blue", drop_extra=False)
    return store.state().select("env", "table_name", "action", "row_count")


def q_flags(spark, sf_dir):
    """Flags in several spellings and configured schema names, one of each per event."""
    k, kind = F.col("event_id") % 7, F.col("event_type")
    flag = F.when(k == 0, F.lit(" TRUE ")).when(k == 1, F.lit("Yes")).when(k == 2, F.lit("1")).when(k == 3, F.lit("no")) \
        .when(k == 4, F.lit("")).when(k == 5, F.concat(F.lit(" "), F.upper(kind)))
    name = F.when(k > 1, F.concat(F.lit("  "), kind, F.lit(" ")))
    return TD.table(spark, sf_dir, "events").select("event_id", is_truthy(flag).alias("on"),
                                                    schema_name(name, "analytics").alias("schema_name"))


def q_cursors(spark, sf_dir):
    """Cursors stored as text, and none, as numbers; the evaluations after each asset's."""
    e = TD.table(spark, sf_dir, "events")
    stored = e.groupBy("user_id").agg(F.expr("cast((min(event_id) + max(event_id)) div 2 as string)").alias("text"))
    stored = stored.select("user_id", cursor_value(F.when(F.col("user_id") % 3 > 0, F.col("text"))).alias("cursor"))
    return e.join(stored, "user_id").groupBy("user_id", "cursor") \
        .agg(F.count_if(F.col("event_id") > F.col("cursor")).alias("after"))


def q_compacted_appends(spark, sf_dir):
    """A table of a build and 23 appends, packed into fewer folders; the state of 12 appends is still there."""
    store, k = Store.scratch(spark), F.col("order_id") % 24
    mart = store.persisted(q_mart_orders(spark, sf_dir))  # joined once: 24 joins would each broadcast the customers
    store.build({"mart_orders": mart.where(k == 0)}, env="green")
    for i in range(1, 24):
        store.append("green", "mart_orders", mart.where(k == i))
    bytes_ = sum(store.fs.size(p) for p in store.version("green", "mart_orders").paths)
    store.compact("green", "mart_orders", target_bytes=bytes_ // 3)
    reader = Store(spark, store.root)
    now = reader.version("green", "mart_orders")
    assert len(now.paths) <= 5 and now.action == "compact", now
    then = reader.version_at("green", "mart_orders", 13)
    return reader.read_version(now).select(F.lit("now").alias("at"), "*").unionByName(
        reader.read_version(then).select(F.lit("then").alias("at"), "*"))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: build both marts, check them, gate the run, promote, and
    read what green serves."""
    return q_publish_roundtrip(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return own_queries() | (LLM.queries() if LLM else {})


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "stg_orders": q_stg_orders,
        "stg_customers": q_stg_customers,
        "mart_orders": q_mart_orders,
        "mart_customers": q_mart_customers,
        "mart_orders_sql": q_mart_orders_sql,
        "mart_customers_sql": q_mart_customers_sql,
        "check_row_count": q_check_row_count,
        "check_not_null": q_check_not_null,
        "check_duplicates": q_check_duplicates,
        "check_positive": q_check_positive,
        "check_suite_fused": q_check_suite_fused,
        "check_suite_lineitem": q_check_suite_lineitem,
        "generic_not_null": q_generic_not_null,
        "generic_unique": q_generic_unique,
        "clean_run_gate": q_clean_run_gate,
        "failed_nodes": q_failed_nodes,
        "marts_to_promote": q_marts_to_promote,
        "promotion_summary": q_promotion_summary,
        "latest_checks": q_latest_checks,
        "checks_gate": q_checks_gate,
        "failures_latest": q_failures_latest,
        "failures_since": q_failures_since,
        "resolve_now": q_resolve_now,
        "resolve_as_of": q_resolve_as_of,
        "is_fresh": q_is_fresh,
        "list_clonable": q_list_clonable,
        "model_layer": q_model_layer,
        "append_sample": q_append_sample,
        "publish_roundtrip": q_publish_roundtrip,
        "publish_partitioned": q_publish_partitioned,
        "snapshot_customers": q_snapshot_customers,
        "swap_roundtrip": q_swap_roundtrip,
        "revert_roundtrip": q_revert_roundtrip,
        "stream_revert": q_stream_revert,
        "revert_by_time": q_revert_by_time,
        "store_append": q_store_append,
        "audit_trail": q_audit_trail,
        "expire_roundtrip": q_expire_roundtrip,
        "remediate_batch": q_remediate_batch,
        "blocked_promotion": q_blocked_promotion,
        "clone_env": q_clone_env,
        "native_land_promote": q_native_land_promote,
        "native_check_results": q_native_check_results,
        "concurrent_appends": q_concurrent_appends,
        "incremental_customers": q_incremental_customers,
        "version_changes": q_version_changes,
        "changed_keys": q_changed_keys,
        "unique_from_changes": q_unique_from_changes,
        "blocked_models": q_blocked_models,
        "blocking_check_run": q_blocking_check_run,
        "seed_load": q_seed_load,
        "rejected_rows": q_rejected_rows,
        "quarantined_seed": q_quarantined_seed,
        "literal_rows": q_literal_rows,
        "live_checks": q_live_checks,
        "existence": q_existence,
        "clone_keeps_extra": q_clone_keeps_extra,
        "flags": q_flags,
        "cursors": q_cursors,
        "compacted_appends": q_compacted_appends,
    }


# --- oracle SQL (DuckDB) -------------------------------------------------------

def _view(name):
    return TD.oracle_with(name) + f"SELECT * FROM {name}"


def _check_sql(source_sql: str, checks) -> str:
    """Each check as its own plain SQL query over ``src``, unioned."""
    parts = []
    for c in checks:
        if c.kind == C.ROW_COUNT:
            v = "(SELECT count(*) FROM src)"
        elif c.kind == C.NOT_NULL:
            cond = " OR ".join(f"{x} IS NULL" for x in c.columns)
            v = f"(SELECT count(*) FROM src WHERE {cond})"
        elif c.kind == C.POSITIVE:
            v = f"(SELECT count(*) FROM src WHERE {c.columns[0]} <= 0)"
        else:
            keys = ", ".join(c.columns)
            where = ("WHERE " + " AND ".join(f"{x} IS NOT NULL" for x in c.columns)
                     if c.ignore_nulls else "")
            v = (f"(SELECT count(*) FROM (SELECT {keys} FROM src {where} "
                 f"GROUP BY {keys} HAVING count(*) > 1))")
        passed = f"{v} > 0" if c.kind == C.ROW_COUNT else f"{v} = 0"
        parts.append(f"SELECT '{c.name}' AS check_name, '{c.metric}' AS metric, "
                     f"CAST({v} AS BIGINT) AS value, {passed} AS passed, "
                     f"'{c.severity}' AS severity, {str(c.blocking).upper()} AS blocking")
    return f"WITH src AS ({source_sql})\n" + "\nUNION ALL\n".join(parts)


def _generic_sql(kind: str) -> str:
    models = ([("stg_orders", "order_id"), ("stg_customers", "customer_id"),
               ("mart_orders", "order_id"), ("mart_customers", "customer_id")]
              if kind == "not_null" else
              [("mart_orders", "order_id"), ("mart_customers", "customer_id")])
    parts = []
    for model, col in models:
        if kind == "not_null":
            c = C.not_null(col)
            v = f"(SELECT count(*) FROM {model} WHERE {col} IS NULL)"
        else:
            c = C.unique(col, ignore_nulls=True)
            v = (f"(SELECT count(*) FROM (SELECT {col} FROM {model} WHERE {col} IS NOT NULL "
                 f"GROUP BY {col} HAVING count(*) > 1))")
        parts.append(f"SELECT '{model}' AS model, '{c.name}' AS check_name, "
                     f"'{c.metric}' AS metric, CAST({v} AS BIGINT) AS value, {v} = 0 AS passed, "
                     f"'ERROR' AS severity, TRUE AS blocking")
    return TD.oracle_with("mart_orders", "mart_customers") + "\nUNION ALL\n".join(parts)


_OK = "('success', 'pass')"

_LATEST_SQL = ("SELECT asset, check_name, max(id) AS id, arg_max(passed, id) AS passed "
               "FROM check_log GROUP BY asset, check_name")

_RESOLVED_SQL = """
    SELECT env, table_name, seq, ts, action, array_to_string(paths, ',') AS path,
           row_count, run_key
    FROM (SELECT *, row_number() OVER (PARTITION BY env, table_name ORDER BY seq DESC) AS rn
          FROM publish_log {where})
    WHERE rn = 1 AND paths IS NOT NULL"""


_CUSTOMERS_SQL = TD.oracle_with("mart_customers") + """
    SELECT * REPLACE (round(lifetime_revenue, 2) AS lifetime_revenue) FROM mart_customers"""


# what the first of the two publishes of _corrupted_live served
_FIRST_ORDERS_SQL = TD.oracle_with("mart_orders") + """
    SELECT * REPLACE (order_total + 1 AS order_total) FROM mart_orders"""


def _unique_steps_sql() -> str:
    steps = {1: "SELECT * FROM stg_orders WHERE order_id % 10 <> 0",
             2: "SELECT * FROM stg_orders UNION ALL SELECT * FROM stg_orders WHERE order_id % 10 = 3",
             3: "SELECT * FROM stg_orders"}
    parts = []
    for step, rows in steps.items():
        for c in (C.unique("order_id"), C.unique("customer_id", "ordered_at")):
            keys = ", ".join(c.columns)
            v = f"(SELECT count(*) FROM (SELECT {keys} FROM ({rows}) GROUP BY {keys} HAVING count(*) > 1))"
            parts.append(f"SELECT {step} AS step, '{c.name}' AS check_name, '{c.metric}' AS metric, {v} AS value, "
                         f"{v} = 0 AS passed, '{c.severity}' AS severity, TRUE AS blocking")
    return TD.oracle_with("stg_orders") + " UNION ALL ".join(parts)


_CHANGES_SQL = TD.oracle_with("stg_orders") + """,
    first AS (
        SELECT order_id, customer_id, order_total + CASE WHEN order_id % 10 = 1 THEN 7.25 ELSE 0 END AS order_total,
               ordered_at + CASE WHEN order_id % 10 = 1 THEN INTERVAL 400 DAYS ELSE INTERVAL 0 DAYS END AS ordered_at
        FROM stg_orders WHERE order_id % 10 <> 0),
    changes AS (
        SELECT *, CAST(1 AS BIGINT) AS copies FROM (SELECT * FROM stg_orders EXCEPT ALL SELECT * FROM first)
        UNION ALL
        SELECT *, CAST(-1 AS BIGINT) FROM (SELECT * FROM first EXCEPT ALL SELECT * FROM stg_orders))
    """


_REASONS_SQL = """CASE order_id % 101
    WHEN 3 THEN 'customer_id: not bigint; order_total: not double' WHEN 5 THEN 'order_total: not double'
    WHEN 7 THEN 'order_id: missing' WHEN 9 THEN 'fields' ELSE '' END"""


def oracle_sql() -> dict[str, str]:
    return own_oracle_sql() | (LLM.oracle_sql() if LLM else {})


def own_oracle_sql() -> dict[str, str]:
    w = TD.oracle_with
    return {
        "stg_orders": _view("stg_orders"),
        "stg_customers": _view("stg_customers"),
        "concurrent_appends": _view("mart_orders"),
        "incremental_customers": _CUSTOMERS_SQL,
        "unique_from_changes": _unique_steps_sql(),
        "version_changes": _CHANGES_SQL + "SELECT * FROM changes",
        "changed_keys": _CHANGES_SQL + """
            SELECT order_id, CAST(sum(greatest(copies, 0)) AS BIGINT) AS added,
                   CAST(sum(greatest(-copies, 0)) AS BIGINT) AS removed,
                   CASE WHEN sum(greatest(-copies, 0)) = 0 THEN 'added' WHEN sum(greatest(copies, 0)) = 0 THEN 'removed'
                        ELSE 'changed' END AS change
            FROM changes GROUP BY order_id""",
        "blocked_models": """
            WITH RECURSIVE nodes AS (
                SELECT event_id // 64 AS run_id, event_id AS node, event_id % 64 AS k,
                       CASE WHEN event_type <> 'error' THEN 'success' WHEN value < 5.0 THEN 'warn' ELSE 'error' END AS status
                FROM events),
            edges AS (
                SELECT run_id, node, node - 3 AS upstream FROM nodes WHERE k >= 3
                UNION SELECT run_id, node, node - 7 FROM nodes WHERE k >= 7
                UNION SELECT run_id, node, run_id * 64 + k // 2 FROM nodes WHERE k > 0 AND k % 2 = 0),
            below AS (
                SELECT e.run_id, e.node FROM edges e JOIN nodes f ON f.node = e.upstream AND f.status = 'error'
                UNION
                SELECT e.run_id, e.node FROM edges e JOIN below b ON b.node = e.upstream)
            SELECT n.run_id, n.node, n.status,
                   CASE WHEN b.node IS NOT NULL THEN 'skipped' ELSE n.status END AS effective
            FROM nodes n LEFT JOIN below b USING (run_id, node)""",
        "blocking_check_run": """
            SELECT 'stg_orders' AS table_name, 'build' AS action, count(*) AS row_count FROM orders
            UNION ALL SELECT 'stg_customers', 'build', count(*) + 1 FROM customer""",
        "seed_load": _view("mart_orders"),
        "rejected_rows": w("raw_orders") + f"""
            SELECT {_REASONS_SQL} AS reasons,
                   CASE WHEN order_id % 101 = 3 THEN NULL ELSE customer_id END AS customer_id, count(*) AS n
            FROM raw_orders GROUP BY ALL""",
        "quarantined_seed": w("raw_orders") + f"""
            SELECT CASE WHEN order_id % 101 = 7 THEN NULL ELSE order_id END AS order_id,
                   CASE WHEN order_id % 101 IN (3, 5, 7, 9) THEN NULL ELSE customer_id END AS customer_id,
                   nullif({_REASONS_SQL}, '') AS reasons
            FROM raw_orders""",
        "literal_rows": w("run_results") + """
            SELECT resource_type, CASE WHEN resource_type = 'model' THEN 'blue_green' END AS strategy, count(*) AS nodes
            FROM run_results GROUP BY ALL""",
        "live_checks": f"""
            WITH src AS ({NATIVE_SQL}),
            dup AS (SELECT count(*) AS n FROM (
                SELECT order_id FROM (SELECT order_id FROM src UNION ALL SELECT order_id FROM src WHERE order_id % 3 = 0)
                GROUP BY order_id HAVING count(*) > 1))
            SELECT 'green.orders' AS asset, 'no_duplicate_order_ids' AS check_name, n AS value, n = 0 AS passed,
                   'false' AS missing FROM dup
            UNION ALL SELECT 'green.no_orders', 'no_duplicate_order_ids', 0, TRUE, 'true'""",
        "existence": w("publish_log") + """
            SELECT env, table_name, table_exists, bool_or(table_exists) OVER (PARTITION BY env) AS env_exists
            FROM (SELECT env, table_name, paths IS NOT NULL AS table_exists,
                         row_number() OVER (PARTITION BY env, table_name ORDER BY seq DESC) AS rn FROM publish_log)
            WHERE rn = 1""",
        "clone_keeps_extra": """
            SELECT env, table_name, action,
                   CASE WHEN table_name = 'mart_orders' THEN (SELECT count(*) FROM orders)
                        ELSE (SELECT count(*) FROM customer) END AS row_count
            FROM (VALUES ('blue', 'blue_only', 'build'), ('green', 'mart_orders', 'build'), ('green', 'mart_customers', 'build'),
                         ('blue', 'mart_orders', 'clone'), ('blue', 'mart_customers', 'clone')) t(env, table_name, action)""",
        "flags": """
            SELECT event_id, coalesce(lower(trim(flag)) IN ('true', '1', 'yes'), FALSE) AS "on",
                   coalesce(trim(name), 'analytics') AS schema_name
            FROM (SELECT event_id,
                         CASE event_id % 7 WHEN 0 THEN ' TRUE ' WHEN 1 THEN 'Yes' WHEN 2 THEN '1' WHEN 3 THEN 'no'
                              WHEN 4 THEN '' WHEN 5 THEN ' ' || upper(event_type) END AS flag,
                         CASE WHEN event_id % 7 > 1 THEN '  ' || event_type || ' ' END AS name
                  FROM events)""",
        "cursors": """
            SELECT user_id, cursor, count(*) FILTER (WHERE event_id > cursor) AS after
            FROM (SELECT e.user_id, event_id, CASE WHEN e.user_id % 3 > 0 THEN mid ELSE 0 END AS cursor
                  FROM events e JOIN (SELECT user_id, (min(event_id) + max(event_id)) // 2 AS mid FROM events GROUP BY user_id) m
                  ON e.user_id = m.user_id)
            GROUP BY user_id, cursor""",
        "compacted_appends": w("mart_orders") + """
            SELECT 'now' AS "at", * FROM mart_orders
            UNION ALL SELECT 'then', * FROM mart_orders WHERE order_id % 24 <= 12""",
        "mart_orders": _view("mart_orders"),
        "mart_customers": _CUSTOMERS_SQL,
        "mart_orders_sql": _view("mart_orders"),
        "mart_customers_sql": _CUSTOMERS_SQL,
        "check_row_count": _check_sql(NATIVE_SQL, [C.row_count_positive()]),
        "check_not_null": _check_sql(NATIVE_SQL, [C.not_null("order_id")]),
        "check_duplicates": _check_sql("SELECT * FROM lineitem", [C.unique("l_orderkey")]),
        "check_positive": _check_sql(NATIVE_SQL, [C.positive("total")]),
        "check_suite_fused": _check_sql(NATIVE_SQL, C.native_suite()),
        "check_suite_lineitem": _check_sql("SELECT * FROM lineitem", LINEITEM_CHECKS),
        "generic_not_null": _generic_sql("not_null"),
        "generic_unique": _generic_sql("unique"),
        "clean_run_gate": w("run_results") + f"""
            SELECT run_id, count(*) AS nodes,
                   count(*) FILTER (WHERE status NOT IN {_OK}) AS failures,
                   count(*) > 0 AND count(*) FILTER (WHERE status NOT IN {_OK}) = 0 AS clean
            FROM run_results GROUP BY run_id""",
        "failed_nodes": w("run_results") + f"""
            SELECT run_id, count(*) AS failed_count,
                   string_agg(unique_id || ' (' || status || ')', ', '
                              ORDER BY unique_id || ' (' || status || ')') AS failed_nodes
            FROM run_results WHERE status NOT IN {_OK} GROUP BY run_id""",
        "marts_to_promote": w("run_results") + f"""
            SELECT run_id, name FROM run_results
            WHERE resource_type = 'model' AND list_contains(fqn, 'marts')
              AND run_id IN (SELECT run_id FROM run_results GROUP BY run_id
                             HAVING count(*) FILTER (WHERE status NOT IN {_OK}) = 0)""",
        "promotion_summary": w("run_results") + f"""
            SELECT run_id, count(*) AS promoted_count,
                   string_agg(name, ', ' ORDER BY name) AS promoted
            FROM run_results
            WHERE resource_type = 'model' AND list_contains(fqn, 'marts')
              AND run_id IN (SELECT run_id FROM run_results GROUP BY run_id
                             HAVING count(*) FILTER (WHERE status NOT IN {_OK}) = 0)
            GROUP BY run_id""",
        "latest_checks": w("check_log") + _LATEST_SQL,
        "checks_gate": w("check_log") + f"""
            SELECT asset, count(*) AS checks, count(*) FILTER (WHERE passed) AS passing,
                   coalesce(bool_and(passed), false) AS gate
            FROM ({_LATEST_SQL}) GROUP BY asset""",
        "failures_latest": w("check_log") + f"""
            SELECT asset, check_name, id, 'revert-' || CAST(id AS VARCHAR) AS run_key
            FROM ({_LATEST_SQL}) WHERE id > 0 AND NOT passed""",
        "failures_since": w("check_log") + f"""
            SELECT asset, id, check_name, 'revert-' || CAST(id AS VARCHAR) AS run_key, cursor
            FROM (SELECT *, max(id) OVER (PARTITION BY asset) AS cursor
                  FROM (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY id) AS rn
                        FROM check_log WHERE id > 0)
                  WHERE rn <= {BATCH})
            WHERE NOT passed AND check_name = '{WATCHED_CHECK}'""",
        "resolve_now": w("publish_log") + _RESOLVED_SQL.format(where=""),
        "resolve_as_of": w("publish_log") + _RESOLVED_SQL.format(
            where=f"WHERE ts <= TIMESTAMP '{AS_OF}'"),
        "is_fresh": w("publish_log") + """
            SELECT table_name, upstream_seq, downstream_seq,
                   coalesce(upstream_seq > downstream_seq, false) AS fresh,
                   downstream_seq IS NULL AND upstream_seq IS NOT NULL AS bootstrap
            FROM (SELECT table_name,
                         max(seq) FILTER (WHERE env = 'blue') AS upstream_seq,
                         max(seq) FILTER (WHERE env = 'green') AS downstream_seq
                  FROM publish_log WHERE env IN ('blue', 'green') GROUP BY table_name)""",
        "list_clonable": w("publish_log") + f"""
            SELECT table_name FROM ({_RESOLVED_SQL.format(where="")})
            WHERE upper(env) = upper('green')
              AND action IN ('publish', 'swap', 'clone', 'build', 'revert', 'append')
              AND table_name NOT LIKE '%__snapshot'""",
        "model_layer": w("run_results") + """
            SELECT name,
                   CASE WHEN starts_with(name, 'stg_') THEN 'staging' ELSE 'marts' END AS layer,
                   CASE WHEN starts_with(name, 'mart_') THEN 'blue_green' END
                     AS deployment_strategy
            FROM run_results""",
        "append_sample": w("mart_orders") + """
            SELECT * FROM mart_orders
            UNION ALL (SELECT * FROM mart_orders ORDER BY order_id LIMIT 1)""",
        "publish_roundtrip": _view("mart_orders"),
        "publish_partitioned": _view("mart_orders"),
        "snapshot_customers": _CUSTOMERS_SQL,
        "swap_roundtrip": w("mart_orders") + """
            SELECT 'green' AS env, * FROM (
                SELECT * FROM mart_orders
                UNION ALL (SELECT * FROM mart_orders ORDER BY order_id LIMIT 1))
            UNION ALL
            SELECT 'blue' AS env, * FROM mart_orders""",
        "revert_roundtrip": _FIRST_ORDERS_SQL,
        "stream_revert": _FIRST_ORDERS_SQL,
        "revert_by_time": _view("mart_orders"),
        "store_append": w("mart_orders") + """
            SELECT * FROM mart_orders
            UNION ALL (SELECT * FROM mart_orders ORDER BY order_id LIMIT 1)""",
        "expire_roundtrip": _view("mart_orders"),
        # Run 1 builds (seq 1) and publishes (2); run 3 clones green into
        # blue (3), builds (4) and publishes (5); then one row is appended
        # to live green (6), the live check is evaluation 9 (runs 1 and 3
        # recorded 4 each), and its revert restores run 1's build (7).
        "audit_trail": w("mart_orders", "mart_customers") + """,
            n AS (SELECT (SELECT count(*) FROM mart_orders) AS o,
                         (SELECT count(*) FROM mart_customers) AS c)
            SELECT CAST(seq AS BIGINT) AS seq, env, table_name, action,
                   CAST(row_count AS BIGINT) AS row_count, run_key
            FROM (
                SELECT 1 AS seq, 'blue' AS env, 'mart_customers' AS table_name, 'build' AS action,
                       c AS row_count, 'run-1' AS run_key FROM n
                UNION ALL SELECT 1, 'blue', 'mart_orders', 'build', o, 'run-1' FROM n
                UNION ALL SELECT 2, 'green', 'mart_customers', 'publish', c, 'run-1' FROM n
                UNION ALL SELECT 2, 'green', 'mart_orders', 'publish', o, 'run-1' FROM n
                UNION ALL SELECT 3, 'blue', 'mart_customers', 'clone', c, NULL FROM n
                UNION ALL SELECT 3, 'blue', 'mart_orders', 'clone', o, NULL FROM n
                UNION ALL SELECT 4, 'blue', 'mart_customers', 'build', c, 'run-3' FROM n
                UNION ALL SELECT 4, 'blue', 'mart_orders', 'build', o, 'run-3' FROM n
                UNION ALL SELECT 5, 'green', 'mart_customers', 'publish', c, 'run-3' FROM n
                UNION ALL SELECT 5, 'green', 'mart_orders', 'publish', o, 'run-3' FROM n
                UNION ALL SELECT 6, 'green', 'mart_orders', 'append', o + 1, NULL FROM n
                UNION ALL SELECT 7, 'green', 'mart_orders', 'revert', o, 'revert-9' FROM n)""",
        "remediate_batch": _FIRST_ORDERS_SQL,
        "blocked_promotion": _CUSTOMERS_SQL,
        "clone_env": w("mart_orders", "mart_customers") + """
            SELECT 'mart_customers' AS table_name, 'clone' AS action,
                   count(*) AS row_count FROM mart_customers
            UNION ALL
            SELECT 'mart_orders', 'clone', count(*) FROM mart_orders""",
        "native_land_promote": NATIVE_SQL,
        "native_check_results": _check_sql(NATIVE_SQL, C.native_suite()),
    }
