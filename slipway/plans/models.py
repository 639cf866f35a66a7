"""The staging views and marts.

Each model is a plain ``DataFrame -> DataFrame`` function, so upstream
relations are arguments rather than names, and Catalyst sees one plan from
the raw scan to the mart (the staging "views" are inlined, as a SQL view
would be).

Plan notes (checked with ``explain('formatted')``):

* ``mart_orders`` reads 4 order columns and 2 customer columns. The left
  join is sort-merge on ``customer_id`` when both sides are large; AQE turns
  it into a broadcast join only when the customer side measures under the
  session threshold, and splits a hot ``customer_id`` (or the NULL key,
  which hashes to one partition) with its skew-join rule.
* ``mart_customers`` aggregates orders before the join, with a partial
  (map-side) aggregate, so a customer holding a third of all orders is
  reduced to one row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipway.functions import to_ntz, trunc_ntz


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    return raw_orders.select(
        "order_id", "customer_id", "order_total",
        to_ntz("ordered_at").alias("ordered_at"),
    )


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    return raw_customers.select(
        "customer_id", "email",
        to_ntz("signed_up_at").alias("signed_up_at"),
    )


def mart_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order with the customer's e-mail; unmatched orders kept."""
    emails = customers.select("customer_id", F.col("email").alias("customer_email"))
    return (orders.join(emails, on="customer_id", how="left")
            .select("order_id", "customer_id", "customer_email", "order_total",
                    "ordered_at", trunc_ntz("day", "ordered_at").alias("ordered_date")))


def customer_totals(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("lifetime_orders"),
        F.sum("order_total").alias("lifetime_revenue"),
        F.max("ordered_at").alias("last_order_at"),
    )


def mart_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per customer; customers without orders get 0 and NULL."""
    totals = customer_totals(orders)
    return (customers.join(totals, on="customer_id", how="left")
            .select("customer_id", "email", "signed_up_at",
                    F.coalesce("lifetime_orders", F.lit(0).cast("bigint")).alias("lifetime_orders"),
                    F.coalesce("lifetime_revenue", F.lit(0.0)).alias("lifetime_revenue"),
                    "last_order_at"))


def build_marts(raw_orders: DataFrame, raw_customers: DataFrame) -> dict[str, DataFrame]:
    """Both marts from the raw relations, in the order a build runs them."""
    o, c = stg_orders(raw_orders), stg_customers(raw_customers)
    return {"mart_orders": mart_orders(o, c), "mart_customers": mart_customers(c, o)}


def model_layers(nodes: DataFrame, name_col: str = "name") -> DataFrame:
    """Layer and deployment strategy of each node, from its name."""
    from slipway.functions import layer_of, strategy_of
    return nodes.select(
        F.col(name_col).alias("name"),
        layer_of(name_col).alias("layer"),
        strategy_of(name_col).alias("deployment_strategy"),
    )
