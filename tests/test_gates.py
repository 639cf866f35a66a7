import random
from collections import defaultdict

from slipway import schemas
from slipway.operators import gates as G


def results(spark, rows):
    return spark.createDataFrame(rows, schemas.RUN_RESULTS)


def node(run, name, status, rtype="model", folder="marts"):
    return (run, f"{rtype}.p.{name}", rtype, name, ["p", folder, name], status)


def test_clean_run_gate(spark):
    df = results(spark, [
        node(1, "mart_a", "success"), node(1, "t1", "pass", "test", "tests"),
        node(2, "mart_a", "success"), node(2, "t1", "warn", "test", "tests"),
        node(3, "mart_a", "error"), node(3, "stg_a", "skipped", folder="staging"),
    ])
    got = {r["run_id"]: (r["nodes"], r["failures"], r["clean"]) for r in G.run_summary(df).collect()}
    assert got == {1: (2, 0, True), 2: (2, 1, False), 3: (2, 2, False)}
    assert G.clean_run(df, 1) and not G.clean_run(df, 2)
    assert not G.clean_run(df, 99)                           # absent run
    assert not G.clean_run(results(spark, []), 1)            # empty results
    fails = {r["run_id"]: (r["failed_count"], r["failed_nodes"]) for r in G.failed_nodes(df).collect()}
    assert fails == {2: (1, "test.p.t1 (warn)"),
                     3: (2, "model.p.mart_a (error), model.p.stg_a (skipped)")}


def test_marts_to_promote(spark):
    df = results(spark, [
        node(1, "mart_b", "success"), node(1, "mart_a", "success"),
        node(1, "stg_a", "success", folder="staging"), node(1, "t", "pass", "test", "marts"),
        node(2, "mart_a", "success"), node(2, "t", "fail", "test", "tests"),
    ])
    assert sorted((r["run_id"], r["name"]) for r in G.marts_to_promote(df).collect()) == \
        [(1, "mart_a"), (1, "mart_b")]
    s = G.promotion_summary(df).collect()
    assert [(r["run_id"], r["promoted_count"], r["promoted"]) for r in s] == [(1, 2, "mart_a, mart_b")]


def checks(spark, rows):
    return spark.createDataFrame(rows, "id bigint, asset string, check_name string, passed boolean")


def test_latest_and_gate(spark):
    df = checks(spark, [(1, "a", "x", False), (2, "a", "x", True), (3, "a", "y", True),
                        (4, "b", "x", True), (5, "b", "x", False)])
    gate = {r["asset"]: (r["checks"], r["passing"], r["gate"]) for r in G.checks_gate(df).collect()}
    assert gate == {"a": (2, 2, True), "b": (1, 0, False)}
    assert G.gate_for(df, "a") and not G.gate_for(df, "b")
    assert not G.gate_for(df, "nobody")                     # no evaluations: closed
    assert not G.gate_for(checks(spark, []), "a")


def _brute_latest(rows, cursor, name):
    latest = {}
    for r in sorted(rows):
        if name is None or r[2] == name:
            latest[(r[1], r[2])] = r
    return sorted((a, c, i) for (a, c), (i, _, _, p) in latest.items() if i > cursor and not p)


def _brute_since(rows, cursor, limit, name):
    per = defaultdict(list)
    for r in sorted(rows):
        if r[0] > cursor:
            per[r[1]].append(r)
    out = []
    for a, rs in per.items():
        batch = rs[:limit]
        cur = batch[-1][0]
        out += [(a, i, c, cur) for i, _, c, p in batch if not p and (name is None or c == name)]
    return sorted(out)


def test_failure_triggers_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["a", "b", "hot", "hot", "hot"]), rnd.choice(["x", "y"]), rnd.random() < 0.6)
            for i in range(1, 400)]
    df = checks(spark, rows)
    for cursor in (0, 57, 398, 1000):
        for name in (None, "x"):
            got = sorted((r["asset"], r["check_name"], r["id"])
                         for r in G.failures_latest(df, cursor, name).collect())
            assert got == _brute_latest(rows, cursor, name)
            for limit in (1, 20):
                got = sorted((r["asset"], r["id"], r["check_name"], r["cursor"])
                             for r in G.failures_since(df, cursor, limit, name).collect())
                assert got == _brute_since(rows, cursor, limit, name)
    nb = [r["id"] for r in G.next_batch(df, 57, 20).collect()]
    assert nb == list(range(58, 78))
    assert G.next_cursor(df, 0) == 399 and G.next_cursor(checks(spark, []), 5) == 5
    one = checks(spark, [(7, "a", "x", False)])
    assert [r["run_key"] for r in G.failures_latest(one, 0).collect()] == ["revert-7"]


def test_window_group_limit_applies_before_shuffle(spark):
    df = checks(spark, [(i, "a", "x", False) for i in range(50)])
    plan = G.failures_since(df, 0, 20)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_gate_for_defined_suite(spark):
    df = checks(spark, [(1, "a", "old", False), (2, "a", "x", True), (3, "a", "y", True)])
    assert not G.gate_for(df, "a")                            # every recorded check counts
    assert G.gate_for(df, "a", names=["x", "y"])              # a check no longer defined is ignored
    assert not G.gate_for(df, "a", names=["x", "y", "z"])     # z never evaluated: closed


def test_run_report_agrees_with_separate_gates(spark):
    rnd = random.Random(11)
    statuses = ["success", "success", "pass", "warn", "error", "skipped"]
    rows = [node(rnd.randint(1, 6), f"{rnd.choice(['mart_', 'stg_'])}{i}", rnd.choice(statuses),
                 rnd.choice(["model", "model", "test"]), rnd.choice(["marts", "staging"]))
            for i in range(80)]
    df = results(spark, rows)
    rep = {r["run_id"]: r for r in G.run_report(df).collect()}
    summ = {r["run_id"]: (r["nodes"], r["failures"], r["clean"]) for r in G.run_summary(df).collect()}
    assert {k: (r["nodes"], r["failures"], r["clean"]) for k, r in rep.items()} == summ
    fails = {r["run_id"]: r["failed_nodes"] for r in G.failed_nodes(df).collect()}
    assert {k: ", ".join(r["failed"]) for k, r in rep.items() if r["failed"]} == fails
    marts = defaultdict(list)
    for r in G.marts_to_promote(df).collect():
        marts[r["run_id"]].append(r["name"])
    assert {k: list(r["to_promote"]) for k, r in rep.items() if r["to_promote"]} == \
        {k: sorted(v) for k, v in marts.items()}
