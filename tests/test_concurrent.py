"""Several writers on one store, and blocking along the model graph."""
import random
import threading

import pytest
from pyspark.sql import functions as F

from slipway.operators import checks as C
from slipway.operators import graph
from slipway.plans import flow
from slipway.store import ConcurrentChange, NothingToRevert, Store


def df_of(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def two(store):
    return store, Store(store.spark, store.root, checkpoint_every=store.checkpoint_every)


def at_once(*jobs):
    errors = []

    def run(job):
        try:
            job()
        except Exception as exc:
            errors.append(exc)

    threads = [threading.Thread(target=run, args=(j,)) for j in jobs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return errors


def test_no_commit_of_two_writers_is_lost(spark):
    a, b = two(Store.scratch(spark))
    w = a.write_version("t", df_of(spark, [1]))

    def commits(store, name):
        for k in range(50):
            store.commit([{"env": "blue", "table_name": f"{name}{k % 5}", "action": "build", "paths": w.paths,
                           "row_count": 1, "run_key": f"{name}-{k}"}])

    assert not at_once(lambda: commits(a, "a"), lambda: commits(b, "b"))
    reader = Store(spark, a.root)
    log = reader.log().collect()
    assert sorted(r["seq"] for r in log) == list(range(1, 101))
    assert {r["run_key"] for r in log} == {f"{n}-{k}" for n in "ab" for k in range(50)}
    assert [r["ts"] for r in sorted(log, key=lambda r: r["seq"])] == sorted(r["ts"] for r in log)
    want = reader.versions("blue")
    assert a.versions("blue") == b.versions("blue") == want and len(want) == 10
    assert {v.run_key for v in want.values()} == {f"{n}-{k}" for n in "ab" for k in range(45, 50)}


def test_appends_of_two_writers_add_up(spark):
    a, b = two(Store.scratch(spark))
    a.build({"t": df_of(spark, [0])}, env="green")
    assert not at_once(*(lambda s=s, p=p: [s.append("green", "t", df_of(spark, [p + k])) for k in range(6)]
                         for s, p in ((a, 100), (b, 200))))
    assert ids(Store(spark, a.root).read("green", "t")) == sorted([0, *range(100, 106), *range(200, 206)])
    assert a.version("green", "t").row_count == 13


def test_a_replaced_build_is_not_promoted(spark):
    a, b = two(Store.scratch(spark))
    checked = a.commit_of(a.build({"t": df_of(spark, [1]), "u": df_of(spark, [1])}))
    b.build({"other": df_of(spark, [5])})               # no part of the decision: no conflict
    assert a.promote(["u"], expect=checked) is not None
    b.build({"t": df_of(spark, [2])})
    with pytest.raises(ConcurrentChange):
        a.promote(["t", "u"], expect=checked)
    assert "t" not in a.versions("green")               # nor a part of it
    assert a.promote(["t"], expect=a.commit_of({})) is not None and ids(a.read("green", "t")) == [2]


def interposed(monkeypatch, store, other):
    """Lets ``other`` run once, right before ``store`` claims its number."""
    real, done = store._try_commit, []

    def late(rows, cur, top):
        if not done:
            done.append(1)
            other()
        return real(rows, cur, top)

    monkeypatch.setattr(store, "_try_commit", late)


def test_decisions_made_on_changed_tables_are_refused(spark, monkeypatch):
    a, b = two(Store.scratch(spark))
    a.build({"t": df_of(spark, [1])})
    a.promote()
    a.build({"t": df_of(spark, [2])})
    a.promote()
    with monkeypatch.context() as m:
        interposed(m, a, lambda: b.build({"t": df_of(spark, [3])}))
        with pytest.raises(ConcurrentChange):
            a.promote(["t"])
    with monkeypatch.context() as m:
        interposed(m, a, lambda: b.build({"t": df_of(spark, [4])}))
        with pytest.raises(ConcurrentChange):
            a.swap(["t"])
    with monkeypatch.context() as m:
        interposed(m, a, lambda: b.append("green", "t", df_of(spark, [9])))
        with pytest.raises(ConcurrentChange):
            a.revert("t")
    assert ids(a.read("green", "t")) == [2, 9]


def test_commits_on_other_tables_are_rebased(spark, monkeypatch):
    a, b = two(Store.scratch(spark))
    a.build({"t": df_of(spark, [1])})
    for name, job in (("x", lambda: a.promote(["t"])), ("y", lambda: a.append("green", "t", df_of(spark, [2]))),
                      ("z", lambda: a.clone(drop_extra=False))):
        with monkeypatch.context() as m:
            interposed(m, a, lambda: b.build({name: df_of(spark, [7])}, env="green"))
            assert job() == a.top_seq()
    assert ids(a.read("blue", "t")) == [1, 2] and ids(a.read("blue", "z")) == [7]


def test_one_revert_of_a_key_by_two_writers(spark, monkeypatch):
    a, b = two(Store.scratch(spark))
    for k in (1, 2):
        a.build({"t": df_of(spark, [k])})
        a.promote()
    with monkeypatch.context() as m:
        interposed(m, a, lambda: b.revert("t", run_key="revert-7"))
        try:
            assert a.revert("t", run_key="revert-7") is None
        except ConcurrentChange:
            pass
    assert ids(a.read("green", "t")) == [1]
    assert a.log().where(F.col("run_key") == "revert-7").count() == 1


def test_a_writer_lost_after_its_claim_is_rolled_forward(spark, monkeypatch):
    a, b = two(Store.scratch(spark))
    a.build({"t": df_of(spark, [1])})
    with monkeypatch.context() as m:
        m.setattr(a.fs, "move", lambda src, dst: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            a.promote(["t"])
    assert ids(b.read("green", "t")) == [1]             # the claim was the commit
    assert ids(Store(spark, a.root).read("green", "t")) == [1]
    assert a.promote(["t"]) == b.top_seq() == 3


def test_evaluation_ids_of_two_writers_differ(spark):
    a, b = two(Store.scratch(spark))
    a.build({"t": df_of(spark, [1])}, env="green")
    assert not at_once(*(lambda s=s: [flow.check_live(s, "t", key="id") for _ in range(4)] for s in (a, b)))
    assert sorted(r["id"] for r in a.check_results().collect()) == list(range(1, 9))


def test_publish_run_refuses_a_build_replaced_meanwhile(spark, monkeypatch):
    a, b = two(Store.scratch(spark))
    real = a.record_many
    monkeypatch.setattr(a, "record_many", lambda items: (b.build({"mart_t": df_of(spark, [2])}), real(items))[1])
    report = flow.publish_run(a, {"mart_t": df_of(spark, [1])}, {"mart_t": [C.unique("id")]})
    assert report.clean and not report.promoted and "mart_t" in report.skipped_reason
    assert not a.versions("green")
    with pytest.raises(NothingToRevert):
        a.revert("mart_t")


# --- the model graph

def test_waves_follow_the_edges():
    depends = {"c": ["a", "b"], "d": ["c"], "b": ["a"], "a": ["elsewhere"]}
    assert graph.waves(depends, "abcde") == [["a", "e"], ["b"], ["c"], ["d"]]
    assert graph.waves({}, "ab") == [["a", "b"]]
    with pytest.raises(ValueError):
        graph.waves({"x": ["a"]}, "a")
    with pytest.raises(ValueError):
        graph.waves({"a": ["b"], "b": ["a"]}, "ab")


def test_dependants_of_failures_are_skipped(spark, store):
    good, twice = df_of(spark, [1]), df_of(spark, [1, 1])
    unique = [C.unique("id")]
    built = []

    def model(name, df):
        def build():
            built.append(name)
            return df
        return build

    def broken():
        raise RuntimeError("no source")

    models = {"stg_a": model("stg_a", twice), "stg_b": broken, "stg_c": model("stg_c", good),
              "mid": model("mid", good), "mart_a": model("mart_a", good), "mart_b": model("mart_b", good),
              "mart_c": lambda: store.read("blue", "stg_c")}
    depends = {"mid": ["stg_a"], "mart_a": ["mid"], "mart_b": ["stg_b", "stg_c"], "mart_c": ["stg_c"]}
    report = flow.publish_run(store, models, {"stg_a": unique, "mid": unique}, depends=depends)
    assert sorted(built) == ["stg_a", "stg_c"] and not report.clean and not report.promoted
    assert sorted(store.versions("blue")) == ["mart_c", "stg_a", "stg_c"]
    assert {f.split(":")[0] for f in report.failures} >= set() and len(report.failures) == 6
    warned = flow.publish_run(store, models | {"stg_b": good}, {"stg_a": [C.unique("id", blocking=False)]}, depends=depends)
    assert "mart_a" in store.versions("blue") and not warned.clean   # a warning stops nothing but the promotion


def closure(edges, failed):
    out, grew = set(), True
    while grew:
        new = {n for n, u in edges if u in failed | out}
        grew, out = new - out, out | new
    return out


def test_downstream_against_a_plain_closure(spark):
    rng = random.Random(5)
    rows = [(r, n, rng.randrange(40)) for r in range(3) for n in range(40) for _ in range(rng.randrange(3))]
    rows += [(0, 5, None), (1, 9, 9)] + [(2, n, 0) for n in range(40)]      # no upstream, itself, a hub
    failed = [(r, n) for r in range(3) for n in rng.sample(range(40), 2)] + [(7, 1)]
    got = graph.downstream(spark.createDataFrame(rows, "run_id int, node int, upstream int"),
                           spark.createDataFrame(failed * 2, "run_id int, node int")).collect()
    want = {(r, n) for r in range(3) for n in closure([(n, u) for x, n, u in rows if x == r and u is not None],
                                                      {n for x, n in failed if x == r})}
    assert sorted(map(tuple, got)) == sorted(want)
    none = graph.downstream(spark.createDataFrame(rows, "run_id int, node int, upstream int"),
                            spark.createDataFrame([], "run_id int, node int"))
    assert none.count() == 0
