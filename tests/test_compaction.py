"""Log rows that name added folders alone, packing of small folders, and rows that are rejected at landing."""
import datetime as dt
import os

import pytest
from pyspark.sql import types as T

from slipway.operators import versions as V
from slipway.plans import flow
from slipway.sources import classified, read_texts
from slipway.store import ConcurrentChange, Store
from slipway.store.store import DELTAS, packed


def df_of(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id bigint")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def _appended(store, n, table="t"):
    """n appends whose folders are names alone: what is tested is the log."""
    for i in range(n):
        cur = store.version("green", table)
        store.commit([{"env": "green", "table_name": table, "action": "append", "paths": (*cur.paths, f"a{i}"),
                       "added": (f"a{i}",), "row_count": i, "schema_json": None}])


def test_log_grows_with_the_appends(spark, store):
    store.commit([{"env": "green", "table_name": "t", "action": "build", "paths": ["p"], "row_count": 1}])
    _appended(store, 40)
    want = ("p", *(f"a{i}" for i in range(40)))
    assert store.version("green", "t").paths == want
    fresh = Store(spark, store.root)
    assert fresh.version("green", "t") == store.version("green", "t")        # replayed by a job
    rows = store.log().select("seq", "paths", "added", "depth").orderBy("seq").collect()
    assert sum(len(r["paths"] or r["added"]) for r in rows) <= 3 * 40          # whole lists at 1, 18 and 37: not 40 * 40 / 2
    assert [r["seq"] for r in rows if r["paths"]] == [1, 2 + DELTAS, 2 + DELTAS + 1 + DELTAS + 2]
    for seq in (5, 18, 40):                                   # any past state, deltas or not
        assert store.version_at("green", "t", seq).paths == want[:seq]


def test_deltas_through_checkpoints_and_other_writers(spark):
    a = Store.scratch(spark)
    a.checkpoint_every = 4
    a.commit([{"env": "green", "table_name": "t", "action": "build", "paths": ["p"], "row_count": 1}])
    b = Store(spark, a.root, checkpoint_every=4)
    assert b.version("green", "t").paths == ("p",)
    _appended(a, 7)
    assert a._checkpoints() == [4, 8]
    want = ("p", *(f"a{i}" for i in range(7)))
    assert b.version("green", "t").paths == want                             # from claims
    assert Store(spark, a.root).version("green", "t").paths == want            # from a checkpoint
    _appended(b, 2)
    assert Store(spark, a.root).version("green", "t").paths == (*want, "a0", "a1")
    assert a.version("green", "t").depth == b.version("green", "t").depth == 9
    a.drop("green", "t")
    assert Store(spark, a.root).version("green", "t") is None
    mid = a.history("green", "t").where("seq = 6").first()["ts"]
    assert len(Store(spark, a.root).version("green", "t", as_of=mid).paths) >= 6


def test_revert_to_a_state_of_appends(spark, store):
    store.build({"t": df_of(spark, [1])})
    store.promote(["t"])
    store.append("green", "t", df_of(spark, [2]))
    store.append("green", "t", df_of(spark, [3]))
    store.build({"t": df_of(spark, [9])})
    store.promote(["t"])
    assert ids(store.read("green", "t")) == [9]
    later = store.version("green", "t").ts + dt.timedelta(days=3)
    assert store.expire(now=later) == []                                     # all folders of the chain are still wanted
    store.revert("t")
    assert ids(Store(spark, store.root).read("green", "t")) == [1, 2, 3]


def test_expire_spares_chains_in_the_window(spark, store):
    store.build({"t": df_of(spark, [1])}, env="green")
    for i in (2, 3):
        store.append("green", "t", df_of(spark, [i]))
    at = store.version("green", "t")
    store.build({"t": df_of(spark, [7])}, env="green")
    assert store.expire(retain_seconds=3600, now=at.ts + dt.timedelta(minutes=5)) == []
    assert ids(store.read_version(at)) == [1, 2, 3]
    gone = store.expire(retain_seconds=0, now=at.ts + dt.timedelta(days=1))
    assert len(gone) == 3 and ids(store.read("green", "t")) == [7]


def test_packed():
    assert packed({}, 10) == [] and packed({"a": 1}, 10) == [] and packed({"a": 6, "b": 7}, 10) == []
    bins = packed({"a": 4, "b": 4, "c": 3, "d": 2, "e": 9, "f": 1}, 10)
    assert bins == [["a", "b", "d"], ["c", "f"]]                             # e is large enough alone


@pytest.mark.parametrize("layout", [None, ["day"]])
def test_compaction_keeps_rows_layout_and_past(spark, store, layout):
    def rows(lo, hi):
        return spark.range(lo, hi).selectExpr("id", "id % 2 AS _bin", "date'2024-01-01' + cast(id % 3 as int) AS day",
                                              "if(id % 5 = 0, null, id) AS n")
    store.build({"t": rows(0, 10)}, env="green", layouts={"t": layout} if layout else None)
    for i in range(1, 8):
        store.append("green", "t", rows(10 * i, 10 * i + 10))
    before = store.version("green", "t")
    seq = store.compact("green", "t")
    now = Store(spark, store.root).version("green", "t")
    assert now.seq == seq and len(now.paths) == 1 and now.row_count == 80
    got, had = store.read_version(now), store.read_version(before)
    assert got.schema == had.schema and got.exceptAll(had).count() == 0 == had.exceptAll(got).count()
    assert store.changes(before, now).count() == 0
    if layout:
        assert any(d.startswith("day=") for d in store.fs.list_dirs(now.paths[0]))
    assert store.compact("green", "t") is None                               # nothing left to pack
    store.append("green", "t", rows(80, 90))
    assert store.read("green", "t").count() == 90 and "t" in [r[0] for r in V.clonable(store.state()).collect()]


def test_compaction_and_other_writers(spark, store, monkeypatch):
    store.build({"t": df_of(spark, [0])}, env="green")
    for i in (1, 2):
        store.append("green", "t", df_of(spark, [i]))
    other, transact = Store(spark, store.root), store._transact

    def first(action):
        def run(*args):
            monkeypatch.setattr(store, "_transact", transact)
            action()
            return transact(*args)
        monkeypatch.setattr(store, "_transact", run)

    first(lambda: other.append("green", "t", df_of(spark, [3])))
    store.compact("green", "t")
    assert ids(other.read("green", "t")) == [0, 1, 2, 3] and len(other.version("green", "t").paths) == 2
    first(lambda: other.build({"t": df_of(spark, [5])}, env="green"))
    with pytest.raises(ConcurrentChange):
        store.compact("green", "t")
    assert ids(store.read("green", "t")) == [5]
    with pytest.raises(KeyError):
        store.compact("green", "none")


SEED = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("x", T.DoubleType()),
                     T.StructField("at", T.TimestampNTZType())])


def _seed(spark, store, *lines):
    path = f"{store.root}/seed"
    spark.createDataFrame([("\n".join(("id,x,at", *lines)),)], "value string").coalesce(1).write.text(path)
    return read_texts(spark, path, SEED)


def test_rows_are_rejected_with_reasons(spark, store):
    texts = _seed(spark, store, "1,2.5,2024-01-01 00:00:00", "2,,", "x,abc,never", ",1,", "5,1", "6,1,,,", "7,1e3,2024-02-30")
    rows = classified(texts, SEED)
    got = {(r["id"], tuple(r["reasons"])) for r in rows.collect()}
    assert got == {(1, ()), (2, ()), (None, ("id: not bigint", "x: not double", "at: not timestamp_ntz")),
                   (None, ("id: missing",)), (5, ("fields",)), (6, ("fields",)), (7, ("at: not timestamp_ntz",))}
    assert rows.where("size(reasons) = 0").select("id").count() == 2              # the same when columns are pruned
    lines = {r["line"] for r in rows.where("line is not null").select("line").collect()}
    assert lines == {"5,1", "6,1,,,"}
    with pytest.raises(ValueError):
        classified(texts, T.StructType([T.StructField("line", T.StringType())]))


def test_landing_splits_and_gates(spark, store):
    texts = _seed(spark, store, "1,2.5,", "2,,", "x,abc,never")
    assert not flow.land_seed(store, "s", texts, SEED).first()["passed"]
    assert flow.promote_if_passing(store, "s", bootstrap=True) is None
    assert flow.land_seed(store, "s", texts, SEED, max_share=0.34).first()["value"] == 1
    assert flow.promote_if_passing(store, "s", bootstrap=True) is not None
    assert ids(store.read("green", "s")) == [1, 2] and store.read("green", "s").columns == ["id", "x", "at"]
    assert [r["given"]["x"] for r in store.read("blue", "s__rejects").collect()] == ["abc"]
    assert store.version("blue", "s").seq == store.version("blue", "s__rejects").seq   # one commit


@pytest.mark.parametrize("lines, good, bad", [((), 0, 0), (("a,b,c",), 0, 1), (("1,1,",), 1, 0)])
def test_landing_one_sided_and_empty(spark, store, lines, good, bad):
    passed = flow.land_seed(store, "s", _seed(spark, store, *lines), SEED).first()["passed"]
    assert passed == (bad == 0)
    assert store.read("blue", "s").count() == good and store.read("blue", "s__rejects").count() == bad
    assert os.path.basename(store.version("blue", "s").paths[0]).startswith("v=")


@pytest.mark.parametrize("name,appends", [("compacted_appends", 23), ("concurrent_appends", 6)])
def test_appends_join_the_mart_once(spark, monkeypatch, name, appends):
    """What is appended is a slice of the stored mart: a join in each would broadcast the customers as often."""
    import __spark_entry__ as E
    plans, kept = [], Store.append

    def planned(self, env, table, df, *args, **more):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return kept(self, env, table, df, *args, **more)

    monkeypatch.setattr(Store, "append", planned)
    E.queries()[name](spark, E.SMOKE_DIR)
    assert len(plans) == appends and not any("Join" in plan for plan in plans)
