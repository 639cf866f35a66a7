"""Uniqueness from changed keys against the check that reads every key."""
import random

import pytest

from slipway.operators import checks as C
from slipway.plans import unique_index as U
from slipway.store import Store

SCHEMA = "id long, k long, s string"


def rows(rng, n, first):
    return [(first + i, rng.choice([None, 1, 2, 3, *range(20, 60)]), rng.choice([None, "x", "y", "z"])) for i in range(n)]


def both_ways(store, check):
    full = C.run_checks(store.read("green", "t"), [check]).collect()
    assert U.unique_check(store, "green", "t", check).collect() == full
    return full[0]["value"]


CHECKS = [C.unique("k"), C.unique("k", "s", ignore_nulls=True), C.unique("id"), C.unique("k", "s")]


@pytest.mark.parametrize("seed", [1, 2])
def test_index_equals_the_full_check(spark, seed, monkeypatch):
    monkeypatch.setattr(U, "FOLDERS", 2)
    rng, store = random.Random(seed), Store.scratch(spark)
    store.build({"t": spark.createDataFrame(rows(rng, 20, 0), SCHEMA)}, env="green")
    for step in range(5):
        check = CHECKS[step % 2]
        both_ways(store, check)
        if step == 3:
            store.merge("green", "t", None, ["k"], delete=spark.createDataFrame(rows(rng, 5, 0), SCHEMA))
        else:
            store.append("green", "t", spark.createDataFrame(rows(rng, rng.randrange(1, 9), 100 * step), SCHEMA))
    for check in CHECKS:
        both_ways(store, check)
        assert U.unique_numbers(store, "green", "t", check)[1] == "none"
    assert len(store.version("green", U.index_name("t", CHECKS[0])).paths) <= 3


def test_only_buckets_of_changed_keys_are_read(spark, store, monkeypatch):
    monkeypatch.setattr(U, "PER_BUCKET", 100)
    check = C.unique("id")
    store.build({"t": spark.range(3000).selectExpr("id", "id AS k", "'x' AS s")}, env="green")
    assert U.unique_numbers(store, "green", "t", check) == ((0, 0), "full")
    store.append("green", "t", spark.createDataFrame([(7, 1, "x"), (9000, 1, "x")], SCHEMA))
    index = store.version("green", U.index_name("t", check))
    assert U._parsed(index)[1] == 30
    new = U._counted(spark.createDataFrame([(7,), (9000,)], "id long"), ["id"], U.F.lit(1), 30)
    buckets = U.touched_buckets(new)
    assert 1 <= len(buckets) <= 2
    pruned = store.read_version(index).where(U.F.col(U._BUCKET).isin(buckets))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [{U._BUCKET}" in plan or f"isnotnull({U._BUCKET}" in plan
    assert pruned.select(U._BUCKET).distinct().count() == len(buckets)
    assert U.unique_numbers(store, "green", "t", check) == ((1, 1), "changes")


def test_more_rows_get_more_buckets():
    assert (U.bucket_count(None), U.bucket_count(50 << 20), U.bucket_count(1 << 50)) == (8, 50, 4096)


def test_index_edges(spark, store):
    check = C.unique("k")
    with pytest.raises(KeyError):
        U.unique_numbers(store, "green", "t", check)
    with pytest.raises(ValueError):
        U.unique_check(store, "green", "t", C.not_null("k"))
    store.build({"t": spark.createDataFrame([], SCHEMA)}, env="green")
    assert both_ways(store, check) == 0
    store.append("green", "t", spark.createDataFrame([(1, None, None)] * 3, SCHEMA))
    assert both_ways(store, check) == 1 and both_ways(store, C.unique("k", "s", ignore_nulls=True)) == 0
    store.build({"t": spark.createDataFrame([(1, 4, "a"), (2, 4, "a")], SCHEMA)}, env="green")
    assert both_ways(store, check) == 1                 # a rebuilt table: all its folders changed
