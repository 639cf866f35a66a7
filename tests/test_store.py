import datetime as dt
import os
import time

import pytest

from slipway.operators import checks as C
from slipway.plans import flow
from slipway.plans import models as M
from slipway.store import NothingToRevert, Store


def df_of(spark, ids):
    return spark.createDataFrame([(i, 1, 1.0) for i in ids], "order_id bigint, customer_id bigint, total double")


def ids(df):
    return sorted(r["order_id"] for r in df.collect())


def marts_of(seeds):
    ro, rc = seeds
    return M.build_marts(ro, rc)


def test_build_is_invisible_to_green_until_promoted(spark, store):
    store.build({"t": df_of(spark, [1, 2])}, env="blue")
    assert store.version("green", "t") is None
    assert not store.exists("green")
    seq = store.promote(["t"])
    assert store.exists("green", "t")
    assert ids(store.read("green", "t")) == [1, 2]
    assert store.version("green", "t").seq == seq
    # promote: blue keeps the same build
    assert store.version("blue", "t").paths == store.version("green", "t").paths


def test_first_and_second_publish_via_flow(spark, store, seeds):
    checks = {"mart_orders": [C.not_null("order_id"), C.unique("order_id", ignore_nulls=True)],
              "mart_customers": [C.not_null("customer_id"), C.unique("customer_id", ignore_nulls=True)]}
    r1 = flow.publish_run(store, marts_of(seeds), checks)
    assert r1.clean and r1.promoted == ["mart_customers", "mart_orders"]
    assert store.read("green", "mart_orders").count() == 10
    g1 = store.versions("green")
    r2 = flow.publish_run(store, marts_of(seeds), checks)
    assert r2.clean and r2.seq > r1.seq
    g2 = store.versions("green")
    assert g2["mart_orders"].paths != g1["mart_orders"].paths
    # both marts moved in the same commit
    assert g2["mart_orders"].seq == g2["mart_customers"].seq == r2.seq
    # row count recorded at write time
    assert g2["mart_orders"].row_count == 10


def test_failed_check_leaves_green_unchanged(spark, store, seeds):
    marts = marts_of(seeds)
    checks = {"mart_orders": [C.unique("order_id")]}
    assert flow.publish_run(store, marts, checks).clean
    before = store.versions("green")
    bad = dict(marts)
    bad["mart_orders"] = marts["mart_orders"].unionByName(marts["mart_orders"].orderBy("order_id").limit(1))
    r = flow.publish_run(store, bad, checks)
    assert not r.clean and r.promoted == []
    assert any("no_duplicate_order_id" in f and "(fail)" in f for f in r.failures)
    assert store.versions("green") == before
    # blue holds the un-promoted data
    assert store.read("blue", "mart_orders").count() == 11


def test_model_error_blocks_everything(spark, store, seeds):
    marts = marts_of(seeds)
    assert flow.publish_run(store, marts).clean
    before = store.versions("green")

    def broken():
        raise ValueError("boom")
    r = flow.publish_run(store, {"mart_orders": marts["mart_orders"], "mart_customers": broken})
    assert not r.clean and "mart_customers" in r.errors
    assert store.versions("green") == before   # all-or-nothing: mart_orders not promoted either


def test_forced_skip_and_warn(spark, store, seeds):
    r = flow.publish_run(store, marts_of(seeds), force_skip=True)
    assert r.clean and not r.promoted and not store.exists("green")
    warn = {"mart_orders": [C.unique("customer_id", blocking=False)]}  # customer repeats: warn
    r = flow.publish_run(store, marts_of(seeds), warn)
    assert not r.clean and any("(warn)" in f for f in r.failures)
    assert not store.exists("green")


def test_swap_exchanges_pointers(spark, store):
    store.build({"t": df_of(spark, [1])}, env="blue")
    store.swap(["t"])                                  # first publish: copy
    assert ids(store.read("green", "t")) == [1] and ids(store.read("blue", "t")) == [1]
    store.build({"t": df_of(spark, [2])}, env="blue")
    store.swap(["t"])
    assert ids(store.read("green", "t")) == [2]
    assert ids(store.read("blue", "t")) == [1]       # blue now holds old green


def test_revert_to_before_last_publish_and_repeat(spark, store):
    store.build({"t": df_of(spark, [1])}); store.promote(["t"])
    with pytest.raises(NothingToRevert):
        store.revert("t")                              # first publish: no snapshot
    store.build({"t": df_of(spark, [2])}); store.promote(["t"])
    store.revert("t")
    assert ids(store.read("green", "t")) == [1]
    store.revert("t")                                  # repeat: same base, not further back
    assert ids(store.read("green", "t")) == [1]


def test_revert_after_live_append_undoes_only_the_append(spark, store):
    store.build({"t": df_of(spark, [1, 2])}); store.promote(["t"])
    store.build({"t": df_of(spark, [3, 4])}); store.promote(["t"])
    live = store.read("green", "t")
    store.append("green", "t", live.orderBy("order_id").limit(1))
    assert ids(store.read("green", "t")) == [3, 3, 4]
    assert store.version("green", "t").row_count == 3
    tgt = store.revert_target("t", as_of=store.version("green", "t").ts - dt.timedelta(microseconds=1))
    assert tgt.paths == store.version("blue", "t").paths
    store.revert("t", as_of=tgt.ts)
    assert ids(store.read("green", "t")) == [3, 4]


def test_two_bad_publishes_then_time_revert(spark, store):
    store.build({"t": df_of(spark, [1])}); store.promote(["t"])
    good_ts = store.version("green", "t").ts
    time.sleep(0.01)
    for bad in ([9], [8]):
        store.build({"t": df_of(spark, bad)}); store.promote(["t"])
    store.revert("t")                                  # one level back: still bad
    assert ids(store.read("green", "t")) == [9]
    store.revert("t", as_of=good_ts)
    assert ids(store.read("green", "t")) == [1]


def test_revert_seconds_ago(spark, store):
    store.build({"t": df_of(spark, [1])}); store.promote(["t"])
    with pytest.raises(NothingToRevert):
        store.revert("t", seconds_ago=3600)            # table did not exist an hour ago
    time.sleep(1.2)
    store.build({"t": df_of(spark, [2])}); store.promote(["t"])
    store.revert("t", seconds_ago=1)
    assert ids(store.read("green", "t")) == [1]


def test_run_key_makes_revert_idempotent(spark, store):
    store.build({"t": df_of(spark, [1])}); store.promote(["t"])
    store.build({"t": df_of(spark, [2])}); store.promote(["t"])
    assert store.revert("t", run_key="revert-7") is not None
    store.build({"t": df_of(spark, [3])}); store.promote(["t"])
    assert store.revert("t", run_key="revert-7") is None
    assert ids(store.read("green", "t")) == [3]


def test_as_of_before_history_and_snapshot_consistency(spark, store):
    assert store.versions("green", as_of="2000-01-01") == {}
    store.build({"a": df_of(spark, [1]), "b": df_of(spark, [2])}); store.promote()
    snap = store.snapshot("green")
    store.build({"a": df_of(spark, [10]), "b": df_of(spark, [20])}); store.promote()
    assert ids(snap.read("a")) == [1] and ids(snap.read("b")) == [2]   # one resolved state
    assert ids(store.read("green", "a")) == [10]


def test_crashed_commit_is_ignored(spark, store):
    store.build({"t": df_of(spark, [1])})
    seqs = store._seqs()
    os.makedirs(store.log_path.replace("file:", "") + f"/seq={seqs[-1] + 1}/_temporary/0")
    assert ids(store.read("blue", "t")) == [1]
    seq = store.promote(["t"])
    assert seq == seqs[-1] + 2                       # the crashed number is not reused
    assert ids(store.read("green", "t")) == [1]


def test_clone_with_and_without_drop_extra(spark, store):
    assert store.clone() is None                     # empty green: first publish, nothing to do
    store.build({"a": df_of(spark, [1])}); store.promote(["a"])
    store.build({"extra": df_of(spark, [5])})
    store.clone(drop_extra=False)
    assert set(store.versions("blue")) == {"a", "extra"}
    store.clone(drop_extra=True)
    assert set(store.versions("blue")) == {"a"}
    assert store.version("blue", "a").paths == store.version("green", "a").paths


def test_snapshot_named_tables_not_listed(spark, store):
    for name in ("orders", "orders__snapshot", "dailysnapshot"):
        store.build({name: df_of(spark, [1])}, env="green")
    assert store.tables("green") == ["orders"]
    assert store.tables("green", skip_snapshots=False) == ["dailysnapshot", "orders", "orders__snapshot"]


def test_drop_hides_table(spark, store):
    store.build({"t": df_of(spark, [1])}, env="green")
    store.drop("green", "t")
    assert store.version("green", "t") is None
    with pytest.raises(KeyError):
        store.read("green", "t")


def test_expire_keeps_live_and_recent(spark, store):
    store.build({"t": df_of(spark, [1])}); store.promote(["t"])
    store.build({"t": df_of(spark, [2])}); store.promote(["t"])
    store.build({"t": df_of(spark, [3])}); store.promote(["t"])
    assert store.expire(retain_seconds=3600) == []
    future = store.version("green", "t").ts + dt.timedelta(hours=2)
    gone = store.expire(retain_seconds=3600, now=future)
    assert len(gone) == 1                       # the state that a revert restores stays
    assert ids(store.read("green", "t")) == [3]
    store.revert("t")
    assert ids(store.read("green", "t")) == [2]


def test_revert_never_points_at_deleted_files(spark, store):
    for x in (1, 2):
        store.build({"t": df_of(spark, [x])}); store.promote(["t"])
    target = store.revert_target("t")
    store.fs.delete(target.paths[0])
    with pytest.raises(NothingToRevert, match="deleted"):
        store.revert("t")
    assert ids(store.read("green", "t")) == [2]


def test_append_refuses_columns_the_table_lacks(spark, store):
    store.build({"t": df_of(spark, [1])}); store.promote(["t"])
    with pytest.raises(ValueError, match="more"):
        store.append("green", "t", df_of(spark, [2]).selectExpr("*", "1 AS more"))


def test_unchecked_build_is_not_promoted(spark, store):
    c = [C.unique("order_id")]
    flow.land(store, "t", df_of(spark, [1, 2]), c)
    store.build({"t": df_of(spark, [7, 7])})
    assert flow.promote_if_passing(store, "t", bootstrap=True) is None


def test_checks_of_unknown_tables_raise_and_failing_tests_are_nodes(spark, store):
    with pytest.raises(ValueError, match="mart_typo"):
        flow.publish_run(store, {"mart_t": df_of(spark, [1])}, {"mart_typo": [C.unique("order_id")]})
    r = flow.publish_run(store, {"mart_t": df_of(spark, [1])}, {"mart_t": [C.unique("no_such_column")]})
    assert not r.clean and r.seq is None and any("no_such_column" in e for e in r.errors.values())


def test_empty_table_roundtrip(spark, store):
    store.build({"t": df_of(spark, [])}); store.promote(["t"])
    assert store.version("green", "t").row_count == 0
    assert store.read("green", "t").count() == 0


def test_native_land_and_gate(spark, store):
    good = df_of(spark, range(1001, 1011)).withColumnRenamed("total", "total")
    flow.land(store, "orders", good, C.native_suite())
    assert flow.promote_if_passing(store, "orders") is None          # no bootstrap: green missing
    assert flow.promote_if_passing(store, "orders", bootstrap=True) is not None
    bad = good.unionByName(good.where("order_id = 1001"))
    flow.land(store, "orders", bad, C.native_suite())
    assert flow.promote_if_passing(store, "orders") is None          # duplicate check failed
    assert store.read("green", "orders").count() == 10
    flow.land(store, "orders", good, C.native_suite())
    assert flow.promote_if_passing(store, "orders") is not None      # checks pass again


def test_live_check_and_remediate(spark, store):
    rec = flow.check_live(store, "t")                                   # missing table passes
    r = rec.collect()[0]
    assert r["passed"] and r["value"] == 0 and r["metadata"]["missing"] == "true"
    store.build({"t": df_of(spark, [1, 2])}); store.promote(["t"])
    store.build({"t": df_of(spark, [3, 4])}); store.promote(["t"])
    store.append("green", "t", store.read("green", "t").orderBy("order_id").limit(1))
    rec = flow.check_live(store, "t").collect()[0]
    assert not rec["passed"] and rec["value"] == 1
    done, cur = flow.remediate(store, cursor=0)
    assert done == ["t"] and cur == rec["id"]
    assert ids(store.read("green", "t")) == [1, 2]    # before the last publish, as specified
    done2, _ = flow.remediate(store, cursor=0)        # replay: same run key, no second revert
    assert done2 == []


def test_revert_to_last_publish_undoes_only_append(spark, store):
    store.build({"t": df_of(spark, [1])}); store.promote(["t"])
    store.build({"t": df_of(spark, [2])}); store.promote(["t"])
    store.append("green", "t", df_of(spark, [2]))
    store.revert("t", to="last_publish")
    assert ids(store.read("green", "t")) == [2]
    store.revert("t")
    assert ids(store.read("green", "t")) == [1]


def test_log_checkpoint_gives_same_state(spark):
    s = Store.scratch(spark)
    s.checkpoint_every = 3
    for i in range(7):
        s.build({f"t{i % 2}": df_of(spark, [i])}, env="green")
    s.drop("green", "t0")
    assert s._checkpoints() == [3, 6]
    fresh = Store(spark, s.root)                       # a reader without the cache
    assert fresh.versions("green") == s.versions("green")
    assert set(fresh.versions("green")) == {"t1"}
    assert ids(fresh.read("green", "t1")) == [5]
    full = {(r["env"], r["table_name"], r["seq"]) for r in
            __import__("slipway.operators.versions", fromlist=["resolve"]).resolve(fresh.log()).collect()}
    assert full == {(r["env"], r["table_name"], r["seq"]) for r in fresh.state().collect()}
    first = fresh.history("green", "t0").agg({"ts": "min"}).first()[0]
    assert ids(fresh.read("green", "t0", as_of=first)) == [0]   # history is still there


def test_partitioned_version_prunes_and_keeps_types(spark, store, seeds):
    from pyspark.sql import functions as F
    marts = marts_of(seeds)
    r = flow.publish_run(store, marts, layouts={"mart_orders": ["ordered_date"]})
    assert r.clean
    live = store.read("green", "mart_orders")
    assert live.schema == marts["mart_orders"].schema           # same columns, order, types
    assert sorted(live.collect()) == sorted(marts["mart_orders"].collect())
    day = live.where(F.col("ordered_date") == F.lit("2025-03-12 00:00:00").cast("timestamp_ntz"))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ordered_date" in plan
    assert day.count() == 2
    # appends keep the live table's column order even if given another
    store.append("green", "mart_orders", live.limit(1).select(*reversed(live.columns)))
    assert store.read("green", "mart_orders").count() == 11


def test_empty_run_promotes_nothing(spark, store, seeds):
    assert flow.publish_run(store, marts_of(seeds)).clean
    before = store.versions("green")
    r = flow.publish_run(store, {})                 # no node results at all
    assert not r.clean and r.promoted == []
    assert store.versions("green") == before


def test_text_cursor_and_nothing_new(spark, store):
    store.build({"t": df_of(spark, [1])}); store.promote(["t"])
    store.build({"t": df_of(spark, [2, 2])}); store.promote(["t"])
    rec = flow.check_live(store, "t").collect()[0]
    done, cur = flow.remediate(store, cursor=str(rec["id"]))   # stored text cursor
    assert done == [] and cur == rec["id"]
    done, cur = flow.remediate(store, cursor="")               # no cursor = 0
    assert done == ["t"]


def test_expire_spares_uncommitted_recent_writes(spark, store):
    store.build({"t": df_of(spark, [1])}); store.promote(["t"])
    pending = store.write_version("t", df_of(spark, [2]))       # written, not committed
    assert store.expire(retain_seconds=3600) == []
    later = store.version("green", "t").ts + dt.timedelta(hours=2)
    gone = store.expire(retain_seconds=3600, now=later)
    assert gone == [pending.paths[0]]                           # old enough and unreferenced
    assert ids(store.read("green", "t")) == [1]


def test_revert_pointers_carried_on_rows(spark, store):
    store.build({"t": df_of(spark, [1])})                           # seq 1 (blue)
    p1 = store.promote(["t"])                                      # seq 2
    store.build({"t": df_of(spark, [2])})                           # seq 3
    p2 = store.promote(["t"])                                      # seq 4
    store.append("green", "t", df_of(spark, [9]))                   # seq 5
    v = store.version("green", "t")
    assert (v.published_seq, v.prev_seq) == (p2, p1)               # carried through the append
    fresh = Store(spark, store.root).version("green", "t")         # same from the files
    assert (fresh.published_seq, fresh.prev_seq) == (p2, p1)
    assert ids(store.read_version(store.revert_target("t", to="last_publish"))) == [2]
    assert ids(store.read_version(store.revert_target("t"))) == [1]


def test_revert_falls_back_for_rows_without_pointers(spark, store):
    from slipway import schemas
    from slipway.sources.seeds import literal_frame
    w1 = store.write_version("t", df_of(spark, [1]))
    w2 = store.write_version("t", df_of(spark, [2]))
    for seq, w in ((1, w1), (2, w2)):                               # an older log: no pointer columns
        row = [(dt.datetime(2026, 1, 1, 0, seq), "green", "t", "publish", list(w.paths), 1, None,
                None, None, None)]
        literal_frame(spark, row, schemas.LOG_FILE).write.parquet(f"{store.log_path}/seq={seq}")
    reader = Store(spark, store.root)
    assert reader.version("green", "t").published_seq is None
    reader.revert("t")
    assert ids(reader.read("green", "t")) == [1]


def test_store_freshness_matches_log_operator(spark, store):
    from slipway.operators.versions import freshness
    store.build({"a": df_of(spark, [1]), "b": df_of(spark, [1])})
    store.promote(["a"])
    store.build({"a": df_of(spark, [2])})
    store.build({"c": df_of(spark, [1])}, env="green")
    store.drop("green", "c")
    want = {r["table_name"]: (r["fresh"], r["bootstrap"]) for r in freshness(store.log()).collect()}
    got = {t: store.freshness(t) for t in ("a", "b", "c")}
    assert got == want == {"a": (True, False), "b": (False, True), "c": (False, False)}


def test_marts_only_run_keeps_other_tables(spark, store, seeds):
    marts = marts_of(seeds)
    models = {"stg_orders": marts["mart_orders"].select("order_id"), **marts}
    assert set(flow.select_models(models, "marts")) == {"mart_orders", "mart_customers"}
    assert set(flow.select_models(models, "staging")) == {"stg_orders"}
    assert flow.publish_run(store, models).promoted == ["mart_customers", "mart_orders"]
    r = flow.publish_run(store, flow.select_models(models, "marts"), drop_extra=False)
    assert r.clean and r.promoted == ["mart_customers", "mart_orders"]
    assert store.version("blue", "stg_orders") is not None     # kept by the per-table clone


def test_run_records_checks_in_one_file(spark, store, seeds):
    checks = {"mart_orders": [C.unique("order_id")], "mart_customers": [C.unique("customer_id")]}
    flow.publish_run(store, marts_of(seeds), checks)
    files = [f for f in os.listdir(store.checks_path.replace("file:", "")) if f.endswith(".parquet")]
    assert len(files) == 1
    res = store.check_results().collect()
    assert sorted(r["asset"] for r in res) == ["blue.mart_customers", "blue.mart_orders"]
    assert sorted(r["id"] for r in res) == [1, 2]


def test_log_since_names_folders(spark, store):
    for i in range(4):
        store.build({"t": df_of(spark, [i])}, env="green", run_key=f"k{i}")
    assert sorted(r["run_key"] for r in store.log_since(2).collect()) == ["k2", "k3"]
    assert store.log_since(4).count() == 0
    assert store.log_since(0).count() == 4
    assert store.has_run_key("k3", after_seq=2) and not store.has_run_key("k1", after_seq=2)


def test_two_failing_checks_one_revert(spark, store):
    store.build({"t": df_of(spark, [1])}); store.promote(["t"])
    store.build({"t": df_of(spark, [2, 2])}); store.promote(["t"])
    flow.check_live(store, "t")                                          # no_duplicate_order_ids
    flow.check_live(store, "t", key="customer_id", check_name="cust")    # also fails
    done, _ = flow.remediate(store, cursor=0)
    assert done == ["t"]
    assert store.history("green", "t").where("action = 'revert'").count() == 1
    assert flow.remediate(store, cursor=0)[0] == []                      # replay: nothing


def test_publish_during_append_stays(spark, store):
    store.build({"t": df_of(spark, [3, 4])}, env="blue")
    store.promote(["t"])
    write = store.write_version

    def publish_meanwhile(*args, **kwargs):
        written = write(*args, **kwargs)
        store.write_version = write
        store.build({"t": df_of(spark, [50, 60])}, env="blue")
        store.promote(["t"])
        return written

    store.write_version = publish_meanwhile
    store.append("green", "t", df_of(spark, [9]))
    assert ids(store.read("green", "t")) == [9, 50, 60]
    assert store.version("green", "t").row_count == 3


def test_appends_are_read_by_one_scan_and_keep_the_layout(spark, store):
    store.build({"plain": df_of(spark, [1])}, env="green")
    store.build({"laid": df_of(spark, [1, 2])}, env="green", layouts={"laid": ["customer_id"]})
    for i in (5, 6, 7):
        store.append("green", "plain", df_of(spark, [i]))
        store.append("green", "laid", df_of(spark, [i]))
    assert ids(store.read("green", "plain")) == [1, 5, 6, 7]
    assert ids(store.read("green", "laid")) == [1, 2, 5, 6, 7]
    plan = store.read("green", "plain")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    for folder in store.version("green", "laid").paths:
        assert store.fs.list_dirs(folder) == ["customer_id=1"]
    # rows of a laid-out table written elsewhere without a layout are read without one
    store.build({"copy": store.read("green", "laid")}, env="blue")
    assert ids(store.read("blue", "copy")) == [1, 2, 5, 6, 7]
