"""``mart_customers`` kept up to date from the orders that changed (A1, K2).

Next to the mart a table of totals per customer is kept: number of orders,
revenue as an exact decimal, latest order. A refresh reads the orders that were
added or removed since the version the totals are of (``Store.changes``, which
skips folders that both versions have), subtracts and adds them, and looks at
all orders only of customers whose latest order was removed: a maximum can't be
subtracted from. Revenue is added up in ``MONEY``, so totals that went through
any number of changes equal those made at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipway.operators.diff import COPIES
from slipway.store import Store

TOTALS = "customer_totals"
MONEY = "decimal(18,4)"
_OF = "of-orders-"


def totals(orders: DataFrame) -> DataFrame:
    """customer_id, n, revenue, last_order_at of every customer with an order; orders without one count for nobody."""
    return orders.where("customer_id IS NOT NULL").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("order_total").cast(MONEY)).cast("decimal(38,4)").alias("revenue"),
        F.max("ordered_at").alias("last_order_at"))


def mart_from_totals(customers: DataFrame, sums: DataFrame) -> DataFrame:
    """``mart_customers`` as the full build gives it."""
    return customers.join(sums, "customer_id", "left").select(
        "customer_id", "email", "signed_up_at", F.coalesce("n", F.lit(0)).cast("long").alias("lifetime_orders"),
        F.coalesce(F.col("revenue").cast("double"), F.lit(0.0)).alias("lifetime_revenue"), "last_order_at")


def changed_totals(before: DataFrame, changes: DataFrame, orders: DataFrame) -> DataFrame:
    """The totals after ``changes`` (rows of orders with ``copies``); ``orders`` are those after them."""
    added, gone = F.col(COPIES) > 0, F.col(COPIES) < 0
    delta = changes.where("customer_id IS NOT NULL").groupBy("customer_id").agg(
        F.sum(COPIES).alias("dn"), F.sum(F.col("order_total").cast(MONEY) * F.col(COPIES)).cast("decimal(38,4)").alias("dr"),
        F.max(F.when(added, F.col("ordered_at"))).alias("newest"), F.max(F.when(gone, F.col("ordered_at"))).alias("lost"))
    both = before.join(delta, "customer_id", "full")
    money = F.lit(0).cast("decimal(38,4)")
    merged = both.select(
        "customer_id", (F.coalesce("n", F.lit(0)) + F.coalesce("dn", F.lit(0))).alias("n"),
        (F.coalesce("revenue", money) + F.coalesce("dr", money)).cast("decimal(38,4)").alias("revenue"),
        F.greatest("last_order_at", "newest").alias("last_order_at"),
        F.coalesce(F.col("lost") >= F.col("last_order_at"), F.lit(False)).alias("again")).where("n > 0")
    if changes.where(gone).isEmpty():
        return merged.drop("again")
    some = merged.where("again").select("customer_id")
    latest = orders.join(some, "customer_id", "left_semi").groupBy("customer_id").agg(F.max("ordered_at").alias("latest"))
    return merged.join(latest, "customer_id", "left").select(
        "customer_id", "n", "revenue", F.when(F.col("again"), F.col("latest")).otherwise(F.col("last_order_at"))
        .alias("last_order_at"))


def refresh_customers(store: Store, customers: DataFrame, orders_table: str = "stg_orders", env: str = "blue",
                      mart: str = "mart_customers") -> str:
    """Bring the totals and the mart in ``env`` to the present orders; returns how: ``full``, ``changes`` or ``none``.

    The first refresh, or one whose base version has expired, is a full one. Totals and mart move in one commit.
    """
    now = store.version(env, orders_table)
    if now is None:
        raise KeyError(f"{env}.{orders_table} does not exist")
    have = store.version(env, TOTALS)
    base = int(have.run_key[len(_OF):]) if have is not None and (have.run_key or "").startswith(_OF) else None
    was = store.version_at(env, orders_table, base) if base is not None else None
    if was is not None and was.schema_json == now.schema_json and store.readable(was):
        if was.paths == now.paths:
            return "none"
        sums = changed_totals(store.read_version(have), store.changes(was, now), store.read_version(now))
        how = "changes"
    else:
        sums, how = totals(store.read_version(now)), "full"
    key = f"{_OF}{now.seq}"
    written = store.write_version(TOTALS, sums)
    built = store.write_version(mart, mart_from_totals(customers, store.read_paths(written.paths, written.schema_json)))
    store.commit([{"env": env, "table_name": w.table_name, "action": "build", "paths": w.paths, "row_count": w.row_count,
                   "run_key": key, "schema_json": w.schema_json} for w in (written, built)])
    return how
