"""Version differences, merges and the incremental mart against full rebuilds."""
import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from slipway import schemas
from slipway.operators import diff
from slipway.plans import incremental
from slipway.plans import models as M
from slipway.store import ConcurrentChange, Store

ORDERS = "order_id long, customer_id long, order_total double, ordered_at timestamp_ntz"
CUSTOMERS = "customer_id long, email string, signed_up_at timestamp_ntz"
DAY = dt.datetime(2026, 1, 1)


def order(rng, key):
    return (key, rng.choice([None, 1, 2, 3, 4, 4, 4]), rng.choice([None, 10.25, 7.5, 0.01, -3.0]),
            rng.choice([None, *(DAY + dt.timedelta(days=d) for d in range(6))]))


def customers(spark):
    return spark.createDataFrame([(k, f"c{k}@x", DAY) for k in (1, 2, 3, 4, 9)], CUSTOMERS)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def full(spark, store):
    mart = M.mart_customers(customers(spark), store.read("blue", "stg_orders"))
    return rows_of(mart.withColumn("lifetime_revenue", F.round(F.coalesce("lifetime_revenue", F.lit(0.0)), 4)))


def refreshed(store):
    return rows_of(store.read("blue", "mart_customers").withColumn("lifetime_revenue", F.round("lifetime_revenue", 4)))


@pytest.mark.parametrize("seed", [1, 2])
def test_refresh_equals_a_full_rebuild(spark, seed):
    rng, store, c = random.Random(seed), Store.scratch(spark), customers(spark)
    held = {k: order(rng, k) for k in range(30)}

    def frame(keys):
        return spark.createDataFrame([held[k] for k in keys], ORDERS)

    store.build({"stg_orders": frame(held)})
    assert incremental.refresh_customers(store, c) == "full"
    for _ in range(5):
        kind = rng.choice(["append", "update", "delete", "nothing"])
        if kind == "append":
            new = range(max(held) + 1, max(held) + 1 + rng.randrange(1, 5))
            held |= {k: order(rng, k) for k in new}
            store.append("blue", "stg_orders", frame(new))
        elif kind == "update":
            some = rng.sample(sorted(held), 4)
            held |= {k: order(rng, k) for k in some}
            store.merge("blue", "stg_orders", frame(some), ["order_id"])
        elif kind == "delete":
            some = rng.sample(sorted(held), 4)
            store.merge("blue", "stg_orders", None, ["order_id"], delete=frame(some))
            for k in some:
                del held[k]
        how = incremental.refresh_customers(store, c)
        assert how == ("none" if kind == "nothing" else "changes")
        assert rows_of(store.read("blue", "stg_orders")) == sorted(held.values(), key=str)
        assert store.version("blue", "stg_orders").row_count == len(held)
        assert refreshed(store) == full(spark, store)


def test_refresh_after_its_base_expired_is_a_full_one(spark, store):
    rng = random.Random(0)
    for k in (0, 10):
        store.build({"stg_orders": spark.createDataFrame([order(rng, i) for i in range(k, k + 10)], ORDERS)})
        if not k:
            incremental.refresh_customers(store, customers(spark))
    for p in store.version_at("blue", "stg_orders", 1).paths:
        store.fs.delete(p)
    assert incremental.refresh_customers(store, customers(spark)) == "full"
    assert refreshed(store) == full(spark, store)


def test_only_folders_that_differ_are_read_and_written(spark, store):
    rng = random.Random(0)

    def part(k):
        return spark.createDataFrame([order(rng, i) for i in range(k, k + 10)], ORDERS)

    store.build({"t": part(0)})
    for k in (10, 20, 30):
        store.append("blue", "t", part(k))
    before = store.version("blue", "t")
    store.append("blue", "t", part(40))
    appended = store.version("blue", "t")
    read = {f.rsplit("/", 2)[1] for f in store.changes(before, appended).inputFiles()}
    assert read == {appended.paths[-1].rsplit("/", 1)[-1]}
    store.merge("blue", "t", part(20).where("order_id = 25"), ["order_id"])
    merged = store.version("blue", "t")
    assert merged.paths[:-1] == tuple(p for p in appended.paths if p != appended.paths[2])
    read = {f.rsplit("/", 2)[1] for f in store.changes(appended, merged).inputFiles()}
    assert read == {appended.paths[2].rsplit("/", 1)[-1], merged.paths[-1].rsplit("/", 1)[-1]}
    assert store.merge("blue", "t", None, ["order_id"], delete=part(90)) is None      # none of them is there
    assert store.version("blue", "t").row_count == 50


def test_merge_edges(spark, store):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id long, v string")
    store.build({"t": df})
    store.merge("blue", "t", spark.createDataFrame([("d", None), ("e", 1), ("f", 1)], "v string, id long"), ["id"])
    assert rows_of(store.read("blue", "t")) == [(1, "e"), (1, "f"), (None, "c"), (None, "d")]
    assert store.merge("blue", "t", None, ["id"], delete=df.limit(0)) is None
    other = Store(spark, store.root)
    real = store.write_version
    store.write_version = lambda *a, **k: (other.append("blue", "t", df), real(*a, **k))[1]
    with pytest.raises(ConcurrentChange):
        store.merge("blue", "t", df.limit(1), ["id"])
    with pytest.raises(KeyError):
        store.merge("blue", "unknown", df, ["id"])


def test_bag_difference_against_counters(spark):
    rng = random.Random(2)

    def bag(n):
        return [(rng.choice([None, 1, 2]), rng.choice([None, "x", "y"]), rng.choice([None, 0.5, float("nan")])) for _ in range(n)]

    for a, b in ((bag(60), bag(50)), ([], bag(9)), (bag(9), []), ([(1, "x", 0.5)] * 500, [(1, "x", 0.5)] * 2)):
        schema = "k int, s string, d double"
        got = diff.bag_difference(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema).select("s", "d", "k"))
        want = collections.Counter(map(str, b))
        want.subtract(map(str, a))
        assert {str(tuple(r)[:3]): r["copies"] for r in got.collect()} == {k: n for k, n in want.items() if n}
        keys = {r["k"]: r for r in diff.changed_keys(got, ["k"]).collect()}
        for r in keys.values():
            assert r["change"] == ("added" if not r["removed"] else "removed" if not r["added"] else "changed")
    with pytest.raises(ValueError):
        diff.bag_difference(spark.range(1), spark.range(1).withColumnRenamed("id", "k"))


def test_changes_need_one_schema(spark, store):
    store.build({"t": spark.range(3)})
    store.build({"t": spark.range(3).withColumn("x", F.lit(1))})
    with pytest.raises(ValueError):
        store.changes(store.version_at("blue", "t", 1), store.version("blue", "t"))
    assert store.version_at("blue", "t", 0) is None and schemas.LOG is not None
