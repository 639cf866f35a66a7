import datetime as dt

from pyspark.sql import functions as F

from slipway import schemas
from slipway.operators import versions as V


def test_like_matches_spark(spark):
    names = ["orders", "orders__snapshot", "dailysnapshot", "snapshot", "xsnapshot",
             "a_snapshot", "ab.snapshot", "t%snapshot", "__snapshotx", "x\nysnapshot"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    spark_says = {r["n"]: r["m"] for r in df.select("n", F.col("n").like(V.SNAPSHOT_PATTERN).alias("m")).collect()}
    assert spark_says == {n: V.like(n, V.SNAPSHOT_PATTERN) for n in names}


def _log(spark, rows):
    return spark.createDataFrame(
        [(dt.datetime(2026, 1, 1) + dt.timedelta(hours=seq), env, t, a, p, n, None, None, None, None, seq)
         for seq, env, t, a, p, n in rows], schemas.LOG)


def test_resolve_latest_tombstone_and_as_of(spark):
    log = _log(spark, [
        (1, "green", "a", "publish", ["v1"], 1),
        (2, "green", "a", "publish", ["v2"], 2),
        (3, "green", "b", "publish", ["v3"], 3),
        (4, "green", "b", "drop", None, None),
        (5, "blue", "a", "build", ["v5"], 5),
    ])
    now = {(r["env"], r["table_name"]): r["paths"] for r in V.resolve(log).collect()}
    assert now == {("green", "a"): ["v2"], ("blue", "a"): ["v5"]}
    then = {(r["env"], r["table_name"]): r["paths"]
            for r in V.resolve(log, as_of="2026-01-01 03:30:00").collect()}
    assert then == {("green", "a"): ["v2"], ("green", "b"): ["v3"]}
    assert V.resolve(log, as_of="2025-01-01").count() == 0


def test_freshness(spark):
    log = _log(spark, [
        (1, "blue", "a", "build", ["x"], 1), (2, "green", "a", "publish", ["x"], 1),
        (3, "blue", "a", "build", ["y"], 1),
        (4, "blue", "b", "build", ["z"], 1),
        (5, "blue", "c", "build", ["z"], 1), (6, "green", "c", "publish", ["z"], 1),
    ])
    got = {r["table_name"]: (r["fresh"], r["bootstrap"]) for r in V.freshness(log).collect()}
    assert got == {"a": (True, False), "b": (False, True), "c": (False, False)}


def test_latest_by_keeps_null_keys_and_hashes_fixed_width_columns(spark):
    rows = [(None, 1, "a", True), (None, 3, "b", False), ("x", 2, "c", True), ("x", 1, "d", False)]
    df = spark.createDataFrame(rows, "k string, id bigint, word string, ok boolean")
    for cols, want in ((["id", "ok"], {(None, 3, False), ("x", 2, True)}),
                       (["id", "word"], {(None, 3, "b"), ("x", 2, "c")})):
        out = V.latest_by(df, "k", "id", cols)
        assert set(map(tuple, out.collect())) == want
        sorts = "SortAggregate" in out._jdf.queryExecution().executedPlan().toString()
        assert sorts == ("word" in cols)
