"""Reading a publish log.

A log has one row per (commit ``seq``, env, table). The state of an
environment is, per table, the row with the highest ``seq`` — optionally
among rows no later than a time — and a table whose latest row has NULL
``paths`` is dropped.

``max_by`` is a partial aggregate: each map task keeps one row per
(env, table) before the shuffle, so a table with a third of all commits
costs no more than any other.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types that an aggregate's hash map updates in place.
FIXED_WIDTH = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
               T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType)

STATE_COLS = ("seq", "ts", "action", "paths", "row_count", "run_key", "schema_json",
              "published_seq", "prev_seq", "base_seq", "depth")

# Fixed value: the name pattern of snapshot tables left out of a clone.
SNAPSHOT_PATTERN = "%__snapshot"


def like(value: str, pattern: str) -> bool:
    """SQL ``LIKE`` (``%`` any run, ``_`` any one character) for names the
    driver already holds; same answer as ``Column.like``."""
    rx = "".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch) for ch in pattern)
    return re.fullmatch(rx, value, flags=re.S) is not None


def latest_by(df: DataFrame, keys, order: str, cols) -> DataFrame:
    """Latest row per key by ``order`` (ties impossible when ``order`` is
    unique per key), as a partial aggregate rather than a window.

    When all columns are of fixed width each is taken along on its own, which
    plans as a hash aggregate; one struct of them would be sorted first.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = [c for c in cols if c not in keys]
    if all(isinstance(df.schema[c].dataType, FIXED_WIDTH) for c in cols):
        return df.groupBy(*keys).agg(*[F.max(c).alias(c) if c == order else F.max_by(c, order).alias(c)
                                       for c in cols])
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*cols), F.col(order)).alias("_v"))
            .select(*keys, "_v.*"))


def _as_time(t) -> Column:
    if isinstance(t, Column):
        return t
    if isinstance(t, dt.datetime):
        t = t.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(t)).cast("timestamp_ntz")


def resolve(log: DataFrame, as_of=None, env: str | None = None,
            keep_dropped: bool = False) -> DataFrame:
    """Current (or as-of) version of every table: one row per env/table."""
    if env is not None:
        log = log.where(F.col("env") == env)
    if as_of is not None:
        log = log.where(F.col("ts") <= _as_time(as_of))
    cols = [c for c in STATE_COLS if c in log.columns]
    state = latest_by(log, ["env", "table_name"], "seq", cols)
    if "added" in log.columns:
        state = _replayed(log, state)
    return state if keep_dropped else state.where(F.col("paths").isNotNull())


def chain() -> Column:
    """The commit that holds the whole file list a log row starts from: its own, or its ``base_seq``."""
    return F.coalesce("base_seq", "seq")


def _replayed(log: DataFrame, state: DataFrame) -> DataFrame:
    """``state`` with the file lists of tables whose latest row is a delta: the list of its base and
    what the deltas since then added, in order. Only rows on that base are gathered."""
    keys = ["env", "table_name", "_chain"]
    tip = state.where(F.col("base_seq").isNotNull()) \
        .select("env", "table_name", F.col("base_seq").alias("_chain"), F.col("seq").alias("_tip"))
    step = F.struct("seq", F.coalesce("added", "paths").alias("files"))
    lists = log.withColumn("_chain", chain()).join(tip, keys).where(F.col("seq") <= F.col("_tip")) \
        .groupBy("env", "table_name") \
        .agg(F.flatten(F.transform(F.array_sort(F.collect_list(step)), lambda s: s["files"])).alias("_files"))
    return state.join(lists, ["env", "table_name"], "left") \
        .withColumn("paths", F.coalesce("_files", "paths")).drop("_files")


def existence(log: DataFrame, as_of=None) -> DataFrame:
    """For every table that the log ever named: is it there, and is its environment (any table of it)?"""
    state = resolve(log, as_of=as_of, keep_dropped=True) \
        .select("env", "table_name", F.col("paths").isNotNull().alias("table_exists"))
    envs = state.groupBy("env").agg(F.bool_or("table_exists").alias("env_exists"))
    return state.join(envs, "env").select("env", "table_name", "table_exists", "env_exists")


def as_path(paths_col="paths") -> Column:
    """The file set of a version as one text value."""
    return F.array_join(F.col(paths_col), ",")


def clonable(state: DataFrame, env: str = "green",
             snapshot_pattern: str = SNAPSHOT_PATTERN) -> DataFrame:
    """Tables of ``env`` to copy, without snapshot tables.

    The pattern is a SQL ``LIKE``: ``_`` is a wildcard, so a name such as
    ``dailysnapshot`` is left out as well, exactly as the reference's
    listing does.
    """
    return (state.where((F.upper(F.col("env")) == F.upper(F.lit(env)))
                        & F.col("action").isin("publish", "swap", "clone", "build", "revert", "append", "merge", "compact")
                        & ~F.col("table_name").like(snapshot_pattern))
            .select("table_name"))


def freshness(log: DataFrame, upstream: str = "blue", downstream: str = "green") -> DataFrame:
    """Per table: is the upstream env updated after the downstream one?

    ``fresh`` is never true before the first downstream publish;
    ``bootstrap`` marks that case so a first publish can be allowed
    explicitly. One grouped pass, partial aggregation.
    """
    up = F.max(F.when(F.col("env") == upstream, F.col("seq")))
    down = F.max(F.when(F.col("env") == downstream, F.col("seq")))
    return (log.where(F.col("env").isin(upstream, downstream))
            .groupBy("table_name")
            .agg(up.alias("upstream_seq"), down.alias("downstream_seq"))
            .select("table_name", "upstream_seq", "downstream_seq",
                    F.coalesce(F.col("upstream_seq") > F.col("downstream_seq"),
                               F.lit(False)).alias("fresh"),
                    (F.col("downstream_seq").isNull()
                     & F.col("upstream_seq").isNotNull()).alias("bootstrap")))
