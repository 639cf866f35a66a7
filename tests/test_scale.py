"""Plan properties that matter at scale, checked on small data."""
import contextlib

from slipway import schemas
from slipway.operators import checks as C
from slipway.operators import versions as V
from slipway.plans import models as M


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def skewed_orders(spark, n=30000):
    # a third of all orders on customer 7, a sixth with no customer
    from pyspark.sql import functions as F
    ids = spark.range(n)
    cust = (F.when(F.col("id") % 3 == 0, F.lit(7))
            .when(F.col("id") % 6 == 1, F.lit(None).cast("bigint"))
            .otherwise(F.col("id") % 500))
    return ids.select(F.col("id").alias("order_id"), cust.alias("customer_id"),
                      (F.col("id") % 100 + 0.5).alias("order_total"),
                      F.lit("2026-05-01 10:00:00").alias("ordered_at"))


def customers(spark):
    from pyspark.sql import functions as F
    return spark.range(500).select(F.col("id").alias("customer_id"),
                                   F.concat(F.lit("c"), F.col("id").cast("string"), F.lit("@x")).alias("email"),
                                   F.lit("2026-01-01 00:00:00").alias("signed_up_at"))


def test_hot_key_join_is_split_and_whole(spark):
    # the customer side stands in for a dimension too large to broadcast
    with conf(spark, **{
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }):
        o, c = M.stg_orders(skewed_orders(spark)), M.stg_customers(customers(spark))
        mart = M.mart_orders(o, c)
        rows = mart.collect()
        plan = mart._jdf.queryExecution().executedPlan().toString()
    def cust(i):
        return 7 if i % 3 == 0 else None if i % 6 == 1 else i % 500
    hot = sum(1 for i in range(30000) if cust(i) == 7)
    assert len(rows) == 30000                                  # nothing dropped
    assert hot > 10000
    assert sum(1 for r in rows if r["customer_id"] == 7 and r["customer_email"] == "c7@x") == hot
    assert sum(1 for r in rows if r["customer_id"] is None and r["customer_email"] is None) == 5000
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan, plan


def test_small_side_broadcast_only_on_measured_size(spark):
    # no static broadcast: AQE sees the measured (tiny) customer side at run time
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m"}):
        mart = M.mart_orders(M.stg_orders(skewed_orders(spark, 3000)), M.stg_customers(customers(spark)))
        initial = mart._jdf.queryExecution().executedPlan().toString()
        assert mart.count() == 3000
        mart.collect()
        final = mart._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in initial
    assert "BroadcastHashJoin" in final


def test_hot_key_aggregate_is_partial(spark):
    o = M.stg_orders(skewed_orders(spark))
    agg = M.customer_totals(o)
    plan = agg._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_sum" in plan
    assert {r["customer_id"]: r["lifetime_orders"] for r in agg.collect()}[7] == \
        sum(1 for i in range(30000) if i % 3 == 0 or (i % 6 != 1 and i % 500 == 7))


def test_fused_unique_check_is_partial_and_single_scan(spark):
    df = skewed_orders(spark)
    res = C.run_checks(df, C.native_suite(amount="order_total") + [C.unique("customer_id")])
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range") == 1           # one scan of the input
    assert "partial_count" in plan
    got = {r["check_name"]: r["value"] for r in res.collect()}
    assert got["no_duplicate_customer_id"] == 501  # 500 ids incl. hot one, plus NULL


def test_scans_prune_columns(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    plan = E.q_mart_orders(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderpriority" not in plan and "o_orderstatus" not in plan
    plan = E.q_check_suite_fused(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderdate" not in plan and "o_custkey" not in plan


def test_resolve_is_partial_aggregate(spark):
    log = spark.createDataFrame([], schemas.LOG)
    plan = V.resolve(log)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
