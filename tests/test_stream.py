from slipway.plans import flow
from slipway.streaming import revert_on_failure


def df_of(spark, ids):
    return spark.createDataFrame([(i, 1, 1.0) for i in ids], "order_id bigint, customer_id bigint, total double")


def ids(df):
    return sorted(r["order_id"] for r in df.collect())


def test_stream_reverts_once_and_resumes(spark, store):
    store.build({"t": df_of(spark, [1, 2])}); store.promote(["t"])
    store.build({"t": df_of(spark, [3, 4])}); store.promote(["t"])
    flow.check_live(store, "t")                                  # passes
    store.append("green", "t", df_of(spark, [3]))
    flow.check_live(store, "t")                                  # fails
    ckpt = f"{store.root}/streams/test"
    q = revert_on_failure(store, tables=["t"], checkpoint=ckpt)
    q.awaitTermination(120)
    assert ids(store.read("green", "t")) == [1, 2]
    n_reverts = store.history("green", "t").where("action = 'revert'").count()
    assert n_reverts == 1
    # restart on the same checkpoint: nothing new, nothing happens
    q = revert_on_failure(store, tables=["t"], checkpoint=ckpt)
    q.awaitTermination(120)
    assert store.history("green", "t").where("action = 'revert'").count() == 1
    # a new failure after a new publish is picked up by the restarted stream
    store.build({"t": df_of(spark, [5, 5])}); store.promote(["t"])
    flow.check_live(store, "t")
    q = revert_on_failure(store, tables=["t"], checkpoint=ckpt)
    q.awaitTermination(120)
    assert store.history("green", "t").where("action = 'revert'").count() == 2
    assert ids(store.read("green", "t")) == [1, 2]


def test_replayed_batch_does_not_revert_twice(spark, store):
    from slipway.streaming import revert_batch
    store.build({"t": df_of(spark, [1])}); store.promote(["t"])
    store.build({"t": df_of(spark, [2, 2])}); store.promote(["t"])
    from pyspark.sql import functions as F
    rec = flow.check_live(store, "t").select(
        "id", "asset", "check_name", F.col("metadata")["log_seq"].cast("bigint").alias("log_seq"))
    handle = revert_batch(store)
    handle(rec, 0)
    handle(rec, 0)                                              # replay of the same epoch
    assert store.history("green", "t").where("action = 'revert'").count() == 1


def test_failure_then_pass_in_one_batch_reverts_nothing(spark, store):
    store.build({"t": df_of(spark, [1])}); store.promote(["t"])
    store.build({"t": df_of(spark, [2, 2])}); store.promote(["t"])
    flow.check_live(store, "t")                                  # fails
    store.build({"t": df_of(spark, [3])}); store.promote(["t"])  # fixed by a new publish
    flow.check_live(store, "t")                                  # passes: latest is clean
    q = revert_on_failure(store, tables=["t"], checkpoint=f"{store.root}/streams/x")
    q.awaitTermination(120)
    assert store.history("green", "t").where("action = 'revert'").count() == 0
    assert ids(store.read("green", "t")) == [3]


def test_pass_of_another_check_hides_no_failure(spark, store):
    from slipway.operators import checks as C
    from slipway.plans import flow
    rows = lambda *x: spark.createDataFrame([(i,) for i in x], "order_id bigint")
    store.build({"t": rows(1)}); store.promote(["t"])
    store.build({"t": rows(1, 2)}); store.promote(["t"])
    store.append("green", "t", rows(2))
    flow.evaluate(store, "green", "t", [C.unique("order_id"), C.not_null("order_id")])
    revert_on_failure(store).awaitTermination()
    assert sorted(r[0] for r in store.read("green", "t").collect()) == [1]


def test_failure_before_the_latest_publish_reverts_nothing(spark, store):
    from slipway.operators import checks as C
    from slipway.plans import flow
    rows = lambda *x: spark.createDataFrame([(i,) for i in x], "order_id bigint")
    store.build({"t": rows(1)}); store.promote(["t"])
    store.append("green", "t", rows(1))
    flow.evaluate(store, "green", "t", [C.unique("order_id")])
    store.build({"t": rows(5, 6)}); store.promote(["t"])
    revert_on_failure(store).awaitTermination()
    assert sorted(r[0] for r in store.read("green", "t").collect()) == [5, 6]
