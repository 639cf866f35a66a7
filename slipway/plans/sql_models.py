"""The same models as Spark SQL over temporary views.

A SQL user keeps model files as SQL: each staging model is registered as a
temporary view (a view materialization), and a mart reads the views by
name. View names carry a namespace so two builds in one session do not
replace each other's views. Catalyst produces the same plan as the
DataFrame models.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

STG_ORDERS = """
SELECT order_id, customer_id, order_total, ordered_at::TIMESTAMP_NTZ AS ordered_at
FROM {raw_orders}"""

STG_CUSTOMERS = """
SELECT customer_id, email, signed_up_at::TIMESTAMP_NTZ AS signed_up_at
FROM {raw_customers}"""

MART_ORDERS = """
SELECT order_id, facts.customer_id, who.email AS customer_email, order_total, ordered_at,
       ordered_at::DATE::TIMESTAMP_NTZ AS ordered_date
FROM {stg_orders} AS facts
LEFT JOIN {stg_customers} AS who ON who.customer_id = facts.customer_id"""

MART_CUSTOMERS = """
WITH spending AS (
    SELECT customer_id, count(*) AS n, sum(order_total) AS spent, max(ordered_at) AS latest
    FROM {stg_orders} GROUP BY customer_id)
SELECT who.customer_id, email, signed_up_at, ifnull(n, 0) AS lifetime_orders,
       ifnull(spent, 0) AS lifetime_revenue, latest AS last_order_at
FROM {stg_customers} AS who
LEFT JOIN spending ON spending.customer_id = who.customer_id"""


def build_marts_sql(spark: SparkSession, raw_orders: DataFrame, raw_customers: DataFrame,
                    namespace: str | None = None) -> dict[str, DataFrame]:
    ns = namespace or uuid.uuid4().hex[:12]
    names = {k: f"{k}_{ns}" for k in ("raw_orders", "raw_customers", "stg_orders", "stg_customers")}
    raw_orders.createOrReplaceTempView(names["raw_orders"])
    raw_customers.createOrReplaceTempView(names["raw_customers"])
    spark.sql(STG_ORDERS.format(**names)).createOrReplaceTempView(names["stg_orders"])
    spark.sql(STG_CUSTOMERS.format(**names)).createOrReplaceTempView(names["stg_customers"])
    return {"mart_orders": spark.sql(MART_ORDERS.format(**names)),
            "mart_customers": spark.sql(MART_CUSTOMERS.format(**names))}
