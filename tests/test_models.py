import datetime as dt

import pytest
from pyspark.sql import functions as F

from slipway import schemas
from slipway.plans import models as M
from slipway.sources import from_rows


def ts(s):
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S")


def test_staging_types(seeds):
    ro, rc = seeds
    o = M.stg_orders(ro)
    assert dict(o.dtypes) == {"order_id": "bigint", "customer_id": "bigint",
                              "order_total": "double", "ordered_at": "timestamp_ntz"}
    assert dict(M.stg_customers(rc).dtypes)["signed_up_at"] == "timestamp_ntz"
    assert o.count() == 10


def test_mart_orders_on_seeds(seeds):
    ro, rc = seeds
    m = M.mart_orders(M.stg_orders(ro), M.stg_customers(rc))
    assert m.columns == ["order_id", "customer_id", "customer_email", "order_total",
                         "ordered_at", "ordered_date"]
    rows = m.collect()
    assert len(rows) == 10
    assert all(r["customer_email"] for r in rows)
    per_day = {}
    for r in rows:
        assert r["ordered_date"] == dt.datetime.combine(r["ordered_at"].date(), dt.time())
        per_day[r["ordered_date"]] = per_day.get(r["ordered_date"], 0) + 1
    assert sorted(per_day.values()) == [2] * 5


def test_mart_customers_on_seeds(seeds):
    ro, rc = seeds
    m = M.mart_customers(M.stg_customers(rc), M.stg_orders(ro))
    got = {r["customer_id"]: (r["lifetime_orders"], r["lifetime_revenue"], r["last_order_at"])
           for r in m.collect()}
    # Worked out by hand from the seeds.
    assert got == {
        11: (3, pytest.approx(42.125), ts("2025-03-14 10:00:00")),
        12: (2, pytest.approx(82.90), ts("2025-03-13 17:45:00")),
        13: (2, pytest.approx(5.504), ts("2025-03-12 12:00:01")),
        14: (1, 300.00, ts("2025-03-12 12:00:00")),
        15: (2, pytest.approx(104.10), ts("2025-03-14 10:30:00")),
        16: (0, 0.0, None),
    }


def test_revenue_is_not_rounded_by_row(spark):
    orders = from_rows(spark, [(i, 1, 0.004, "2025-05-01 00:00:00") for i in range(1000)], schemas.RAW_ORDERS)
    customers = from_rows(spark, [(1, "a@b", "2025-01-01 00:00:00")], schemas.RAW_CUSTOMERS)
    row = M.mart_customers(M.stg_customers(customers), M.stg_orders(orders)).first()
    assert row["lifetime_revenue"] == pytest.approx(4.0)


def test_edge_cases(spark):
    orders = from_rows(spark, [
        (1, 1, 10.0, "2026-05-01 00:00:00"),
        (2, None, None, "2026-05-01 23:59:59"),   # NULL customer and total
        (3, 99, 0.0, "2026-05-02 00:00:00"),      # unknown customer
        (4, 2, -5.0, "2026-05-02 12:00:00"),
    ], schemas.RAW_ORDERS)
    customers = from_rows(spark, [
        (1, "a@x", "2026-01-01 00:00:00"),
        (2, "b@x", "2026-01-01 00:00:00"),
        (3, "c@x", "2026-01-01 00:00:00"),        # no orders
    ], schemas.RAW_CUSTOMERS)
    o, c = M.stg_orders(orders), M.stg_customers(customers)
    mo = {r["order_id"]: r for r in M.mart_orders(o, c).collect()}
    assert len(mo) == 4
    assert mo[2]["customer_email"] is None and mo[3]["customer_email"] is None
    mc = {r["customer_id"]: r for r in M.mart_customers(c, o).collect()}
    assert (mc[3]["lifetime_orders"], mc[3]["lifetime_revenue"], mc[3]["last_order_at"]) == (0, 0.0, None)
    assert mc[2]["lifetime_revenue"] == -5.0


def test_duplicate_customer_fans_out(spark):
    orders = from_rows(spark, [(1, 1, 1.0, "2026-05-01 00:00:00")], schemas.RAW_ORDERS)
    customers = from_rows(spark, [(1, "a@x", "2026-01-01 00:00:00"),
                                  (1, "a2@x", "2026-01-01 00:00:00")], schemas.RAW_CUSTOMERS)
    m = M.mart_orders(M.stg_orders(orders), M.stg_customers(customers))
    assert m.count() == 2  # the join blow-up the live duplicate check exists for


def test_empty_inputs(spark):
    o = M.stg_orders(spark.createDataFrame([], schemas.RAW_ORDERS))
    c = M.stg_customers(spark.createDataFrame([], schemas.RAW_CUSTOMERS))
    assert M.mart_orders(o, c).count() == 0
    assert M.mart_customers(c, o).count() == 0


def test_model_layers(spark):
    nodes = spark.createDataFrame([("stg_orders",), ("mart_orders",), ("raw_orders",)], "name string")
    got = {r["name"]: (r["layer"], r["deployment_strategy"])
           for r in M.model_layers(nodes).collect()}
    assert got == {"stg_orders": ("staging", None), "mart_orders": ("marts", "blue_green"),
                   "raw_orders": ("marts", None)}


def test_truthy_flags(spark):
    from slipway.functions import is_truthy
    df = spark.createDataFrame([("TRUE",), (" yes ",), ("1",), ("false",), (None,), ("no",)], "f string")
    assert [r[0] for r in df.select(is_truthy("f")).collect()] == [True, True, True, False, False, False]


def test_sql_models_equal_dataframe_models(spark, seeds):
    from slipway.plans.sql_models import build_marts_sql
    ro, rc = seeds
    a = M.build_marts(ro, rc)
    b = build_marts_sql(spark, ro, rc)
    for name in ("mart_orders", "mart_customers"):
        assert a[name].schema == b[name].schema, name
        assert sorted(a[name].collect()) == sorted(b[name].collect()), name


def test_conform_types_and_rejects(spark):
    from slipway.sources import conform
    df = spark.createDataFrame([("1001", "1", "49.5", "2026-05-01 09:14:00", "x")],
                               "order_id string, customer_id string, total string, ordered_at string, extra string")
    with pytest.raises(ValueError, match="extra"):
        conform(df, schemas.NATIVE_ORDERS)
    out = conform(df.drop("extra"), schemas.NATIVE_ORDERS)
    assert out.dtypes == [("order_id", "bigint"), ("customer_id", "bigint"), ("total", "double"),
                          ("ordered_at", "timestamp_ntz")]
    bad = spark.createDataFrame([("x", "1", "1", "2026-05-01 00:00:00")],
                                "order_id string, customer_id string, total string, ordered_at string")
    with pytest.raises(Exception):
        conform(bad, schemas.NATIVE_ORDERS).collect()


def test_schema_name_and_cursor_value(spark):
    from slipway.functions import cursor_value, schema_name
    df = spark.createDataFrame([(" blue ", "12"), (None, None), ("green", "")], "s string, c string")
    rows = df.select(schema_name("s", "analytics").alias("n"),
                     cursor_value(F.when(F.col("c") != "", F.col("c"))).alias("k")).collect()
    assert [(r["n"], r["k"]) for r in rows] == [("blue", 12), ("analytics", 0), ("green", 0)]


def test_day_truncation_ignores_session_zone(spark):
    from slipway.functions import trunc_ntz
    df = spark.createDataFrame([("2018-11-04 10:00:00", "2018-11-20 07:30:00")], "a string, b string") \
        .select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")   # midnight skipped on 2018-11-04
    try:
        r = df.select(trunc_ntz("day", "a").alias("d"), trunc_ntz("month", "b").alias("m"),
                      trunc_ntz("hour", "b").alias("h")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["d"] == dt.datetime(2018, 11, 4)
    assert r["m"] == dt.datetime(2018, 11, 1)
    assert r["h"] == dt.datetime(2018, 11, 20, 7)


def test_literal_frame_small_and_large(spark):
    from pyspark.sql import types as T

    from slipway.sources.seeds import literal_frame
    schema = T.StructType.fromDDL("i bigint, s string, a array<double>, m map<string,string>")
    rows = [(i, f"s{i}", [float(i)], {"k": str(i)}) for i in range(200 + 5)]
    for n in (1, 200 + 5):
        df = literal_frame(spark, rows[:n], schema)
        assert df.schema.simpleString() == schema.simpleString()
        assert sorted(tuple(r) for r in df.collect())[:1] == [(0, "s0", [0.0], {"k": "0"})]
        assert df.count() == n
