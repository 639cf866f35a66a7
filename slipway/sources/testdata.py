"""Views of the generated test tables in the shapes the library consumes.

The generated tables have no e-mails, sign-up times, run results, check
evaluations or publish history, so each is derived from a whole table:

* ``raw_orders``    <- orders     (timestamps rendered as text, as in a seed)
* ``raw_customers`` <- customer
* ``check_log``     <- events     (one check evaluation per event)
* ``run_results``   <- events     (one build node per event, 4 per run)
* ``publish_log``   <- orders     (one commit per order)

``ORACLE_VIEWS`` / ``oracle_with`` give the same derivations in DuckDB SQL
so that every registered query has an independent oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _as_text(ts_ntz: Column) -> Column:
    """A zone-less timestamp as ``yyyy-MM-dd HH:mm:ss`` text, without the
    session time zone (the values here are whole seconds)."""
    return ts_ntz.cast("string")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("order_total"),
        _as_text(F.col("o_orderdate")).alias("ordered_at"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    signed_up = F.timestamp_add("HOUR", F.col("c_custkey"),
                                F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
                 F.lit("@example.com")).alias("email"),
        _as_text(signed_up).alias("signed_up_at"),
    )


def check_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One evaluation per event: asset ``t<user>``, check = event type,
    passing when the value is at least 5."""
    e = table(spark, sf_dir, "events")
    return e.select(
        (F.col("event_id") + 1).alias("id"),
        F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("asset"),
        F.col("event_type").alias("check_name"),
        (F.col("value") >= 5.0).alias("passed"),
    )


def run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four consecutive events form one run; event type gives the status."""
    e = table(spark, sf_dir, "events")
    resource_type = F.when(F.col("event_id") % 5 == 0, F.lit("test")).otherwise(F.lit("model"))
    prefix = (F.when(F.col("event_type") == "view", F.lit("stg_"))
              .when(F.col("event_type") == "purchase", F.lit("mart_"))
              .otherwise(F.lit("")))
    name = F.concat(prefix, F.lit("n"), F.col("event_id").cast("string"))
    folder = F.when(F.col("event_id") % 2 == 0, F.lit("marts")).otherwise(F.lit("staging"))
    status = (F.when(F.col("event_type") == "error", F.lit("error"))
              .when(F.col("value") < 2.0, F.lit("warn"))
              .when(F.col("event_type") == "signup", F.lit("pass"))
              .otherwise(F.lit("success")))
    return e.select(
        F.expr("event_id div 4").alias("run_id"),
        F.col("event_id"),
        F.concat(resource_type, F.lit("."), name).alias("unique_id"),
        resource_type.alias("resource_type"),
        name.alias("name"),
        F.array(F.lit("p"), folder, name).alias("fqn"),
        status.alias("status"),
    )


GRAPH = 64


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of 64 consecutive events; an event type gives the status."""
    return table(spark, sf_dir, "events").select(
        F.expr(f"event_id div {GRAPH}").alias("run_id"), F.col("event_id").alias("node"),
        F.when(F.col("event_type") == "error", F.when(F.col("value") < 5.0, F.lit("warn")).otherwise(F.lit("error")))
        .otherwise(F.lit("success")).alias("status"))


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node k of a run is built from nodes k - 3 and k - 7 and, if even, from node k / 2."""
    k = F.col("event_id") % GRAPH
    up = F.array(F.when(k >= 3, k - 3), F.when(k >= 7, k - 7), F.when((k > 0) & (k % 2 == 0), F.expr(f"event_id % {GRAPH} div 2")))
    return table(spark, sf_dir, "events").select(
        F.expr(f"event_id div {GRAPH}").alias("run_id"), F.col("event_id").alias("node"), F.explode(up).alias("up")) \
        .where("up is not null").select("run_id", "node", (F.col("run_id") * GRAPH + F.col("up")).alias("upstream"))


def publish_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A publish history: order = commit, customer = table, status = env.

    Urgent orders land in a ``__snapshot`` table and high-priority ones in a
    ``dailysnapshot`` table, so the snapshot-name filter has both cases.
    Orders in status P are drops (NULL paths).
    """
    o = table(spark, sf_dir, "orders")
    suffix = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("__snapshot"))
              .when(F.col("o_orderpriority") == "2-HIGH", F.lit("dailysnapshot"))
              .otherwise(F.lit("")))
    dropped = F.col("o_orderstatus") == "P"
    return o.select(
        (F.col("o_orderkey") + 1).alias("seq"),
        F.col("o_orderdate").alias("ts"),
        F.when(F.col("o_orderstatus") == "O", F.lit("blue")).otherwise(F.lit("green")).alias("env"),
        F.concat(F.lit("t"), F.col("o_custkey").cast("string"), suffix).alias("table_name"),
        F.when(dropped, F.lit("drop")).otherwise(F.lit("publish")).alias("action"),
        F.when(dropped, F.lit(None)).otherwise(
            F.array(F.concat(F.lit("v"), F.col("o_orderkey").cast("string")))).alias("paths"),
        F.floor("o_totalprice").cast("bigint").alias("row_count"),
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("run_key"),
    )


# DuckDB forms of the same views, used as CTEs by the oracle SQL.
ORACLE_VIEWS = {
    "raw_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               o_totalprice AS order_total,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ordered_at
        FROM orders""",
    "raw_customers": """
        SELECT c_custkey AS customer_id,
               lower(replace(c_name, '#', '.')) || '@example.com' AS email,
               strftime(TIMESTAMP '2024-01-01 00:00:00' + to_hours(c_custkey),
                        '%Y-%m-%d %H:%M:%S') AS signed_up_at
        FROM customer""",
    "check_log": """
        SELECT event_id + 1 AS id, 't' || CAST(user_id AS VARCHAR) AS asset,
               event_type AS check_name, value >= 5.0 AS passed
        FROM events""",
    "run_results": """
        SELECT run_id, event_id, resource_type || '.' || name AS unique_id,
               resource_type, name, ['p', folder, name] AS fqn, status
        FROM (
            SELECT event_id // 4 AS run_id, event_id,
                   CASE WHEN event_id % 5 = 0 THEN 'test' ELSE 'model' END AS resource_type,
                   CASE event_type WHEN 'view' THEN 'stg_' WHEN 'purchase' THEN 'mart_' ELSE '' END
                     || 'n' || CAST(event_id AS VARCHAR) AS name,
                   CASE WHEN event_id % 2 = 0 THEN 'marts' ELSE 'staging' END AS folder,
                   CASE WHEN event_type = 'error' THEN 'error'
                        WHEN value < 2.0 THEN 'warn'
                        WHEN event_type = 'signup' THEN 'pass'
                        ELSE 'success' END AS status
            FROM events)""",
    "publish_log": """
        SELECT o_orderkey + 1 AS seq, o_orderdate AS ts,
               CASE WHEN o_orderstatus = 'O' THEN 'blue' ELSE 'green' END AS env,
               't' || CAST(o_custkey AS VARCHAR)
                 || CASE o_orderpriority WHEN '1-URGENT' THEN '__snapshot'
                                         WHEN '2-HIGH' THEN 'dailysnapshot'
                                         ELSE '' END AS table_name,
               CASE WHEN o_orderstatus = 'P' THEN 'drop' ELSE 'publish' END AS action,
               CASE WHEN o_orderstatus = 'P' THEN NULL
                    ELSE ['v' || CAST(o_orderkey AS VARCHAR)] END AS paths,
               CAST(floor(o_totalprice) AS BIGINT) AS row_count,
               'run-' || CAST(o_orderkey AS VARCHAR) AS run_key
        FROM orders""",
    "stg_orders": """
        SELECT order_id, customer_id, order_total,
               CAST(ordered_at AS TIMESTAMP) AS ordered_at
        FROM raw_orders""",
    "stg_customers": """
        SELECT customer_id, email, CAST(signed_up_at AS TIMESTAMP) AS signed_up_at
        FROM raw_customers""",
    "mart_orders": """
        SELECT o.order_id, o.customer_id, c.email AS customer_email, o.order_total,
               o.ordered_at, date_trunc('day', o.ordered_at) AS ordered_date
        FROM stg_orders o LEFT JOIN stg_customers c USING (customer_id)""",
    "mart_customers": """
        SELECT c.customer_id, c.email, c.signed_up_at,
               coalesce(o.lifetime_orders, 0) AS lifetime_orders,
               coalesce(o.lifetime_revenue, 0) AS lifetime_revenue,
               o.last_order_at
        FROM stg_customers c LEFT JOIN (
            SELECT customer_id, count(*) AS lifetime_orders,
                   sum(order_total) AS lifetime_revenue,
                   max(ordered_at) AS last_order_at
            FROM stg_orders GROUP BY 1) o USING (customer_id)""",
}

# Which views each view reads, so a query pulls in only what it needs.
_DEPS = {
    "stg_orders": ["raw_orders"],
    "stg_customers": ["raw_customers"],
    "mart_orders": ["stg_orders", "stg_customers"],
    "mart_customers": ["stg_orders", "stg_customers"],
}


def oracle_with(*names: str) -> str:
    """A ``WITH`` clause defining the named views and what they depend on."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({ORACLE_VIEWS[n]})" for n in order) + "\n"
