"""Explicit schemas. Nothing in the library relies on schema inference."""

from pyspark.sql import types as T

RAW_ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("order_total", T.DoubleType()),
    T.StructField("ordered_at", T.StringType()),
])

RAW_CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("email", T.StringType()),
    T.StructField("signed_up_at", T.StringType()),
])

# Natively landed orders: typed at the source, other column names.
NATIVE_ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("total", T.DoubleType()),
    T.StructField("ordered_at", T.TimestampNTZType()),
])

# One row per node of a build run (model, test, seed...).
RUN_RESULTS = T.StructType([
    T.StructField("run_id", T.LongType()),
    T.StructField("unique_id", T.StringType()),
    T.StructField("resource_type", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("fqn", T.ArrayType(T.StringType())),
    T.StructField("status", T.StringType()),
])

# One row per check evaluation; ``id`` grows with every evaluation.
CHECK_RESULTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("asset", T.StringType()),
    T.StructField("check_name", T.StringType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("severity", T.StringType()),
    T.StructField("blocking", T.BooleanType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.LongType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])

# Publish log. ``seq`` is the commit directory (log/seq=<n>), so it is the
# partition column; ``paths`` NULL marks a dropped table.
LOG_FIELDS = [
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("env", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("paths", T.ArrayType(T.StringType())),
    T.StructField("row_count", T.LongType()),
    T.StructField("run_key", T.StringType()),
    # JSON of the table's schema, so reads need no inference and partition
    # columns come back with their own types (NULL in older logs).
    T.StructField("schema_json", T.StringType()),
    # Carried on every row of an (env, table): the commit of its latest
    # publish, and the commit whose state that publish replaced. A revert
    # reads those single commit folders instead of the table's history.
    T.StructField("published_seq", T.LongType()),
    T.StructField("prev_seq", T.LongType()),
]
# A delta row has NULL ``paths`` and the folders it ``added`` to the rows before
# it, back to the whole list at commit ``base_seq``; ``depth`` counts the deltas
# on that base. A state checkpoint keeps both beside the whole list.
DELTA_FIELDS = [
    T.StructField("added", T.ArrayType(T.StringType())),
    T.StructField("base_seq", T.LongType()),
    T.StructField("depth", T.LongType()),
]
SEQ = T.StructField("seq", T.LongType())
LOG_FILE = T.StructType(LOG_FIELDS + DELTA_FIELDS)
LOG = T.StructType(LOG_FIELDS + [SEQ])
STORED_LOG = T.StructType(LOG_FIELDS + DELTA_FIELDS + [SEQ])
