"""Data-quality checks (Q1-Q9, A2-A4).

A check is declared, not run: ``row_count_positive()``, ``not_null(c)``,
``unique(c)``, ``positive(c)``. ``run_checks(df, checks)`` evaluates any set
of them in **one scan**:

* checks that need no grouping (row count, NULLs, non-positive values) are
  plain aggregates;
* ``unique`` needs counts per key. With one key set the per-key aggregate is
  partial (map-side), so a key holding a third of all rows is one row per
  map task before the shuffle; the other checks ride along as per-key
  partial counts and are summed afterwards. Several key sets share one scan
  and one shuffle through grouping sets.

The result has one row per check: ``check_name, metric, value, passed,
severity, blocking`` — the evaluation record of the reference's check
results, with the metric it reports.

``observed_checks`` returns the grouping-free checks as expressions for
``DataFrame.observe``, so a build computes them while it writes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slipway.functions import all_not_null, any_null

RESULT_SCHEMA = T.StructType([
    T.StructField("check_name", T.StringType()), T.StructField("metric", T.StringType()),
    T.StructField("value", T.LongType()), T.StructField("passed", T.BooleanType()),
    T.StructField("severity", T.StringType()), T.StructField("blocking", T.BooleanType()),
])

ROW_COUNT = "row_count"
NOT_NULL = "not_null"
UNIQUE = "unique"
POSITIVE = "positive"


@dataclass(frozen=True)
class Check:
    name: str
    kind: str
    columns: tuple[str, ...] = ()
    metric: str = ""
    ignore_nulls: bool = False
    severity: str = "ERROR"
    blocking: bool = True

    def passes(self, value: Column) -> Column:
        return value > 0 if self.kind == ROW_COUNT else value == 0

    def passes_value(self, value: int) -> bool:
        return value > 0 if self.kind == ROW_COUNT else value == 0


# The reference's check and metric names follow these rules
# (row_count_positive/row_count, no_null_<c>/null_<c>s,
#  no_duplicate_<c>/duplicate_<c>s, all_<c>s_positive/non_positive_<c>_rows).

def row_count_positive(name: str = "row_count_positive", **kw) -> Check:
    return Check(name, ROW_COUNT, (), kw.pop("metric", "row_count"), **kw)


def not_null(*cols: str, name: str | None = None, metric: str | None = None, **kw) -> Check:
    tag = "_".join(cols)
    return Check(name or f"no_null_{tag}", NOT_NULL, tuple(cols),
                 metric or f"null_{tag}s", **kw)


def unique(*cols: str, name: str | None = None, metric: str | None = None,
           ignore_nulls: bool = False, **kw) -> Check:
    """Distinct keys that occur more than once.

    NULL is a key like any other unless ``ignore_nulls`` (the generic
    ``unique`` test skips NULL keys; the native checks do not).
    """
    tag = "_".join(cols)
    return Check(name or f"no_duplicate_{tag}", UNIQUE, tuple(cols),
                 metric or f"duplicate_{tag}s", ignore_nulls, **kw)


def positive(col: str, name: str | None = None, metric: str | None = None, **kw) -> Check:
    """No value <= 0; NULL passes, as ``count(*) where c <= 0`` has it."""
    return Check(name or f"all_{col}s_positive", POSITIVE, (col,),
                 metric or f"non_positive_{col}_rows", **kw)


def native_suite(key: str = "order_id", amount: str = "total") -> list[Check]:
    """The four blocking checks of a natively landed table."""
    return [row_count_positive(), not_null(key), unique(key), positive(amount)]


def _row_expr(check: Check) -> Column:
    """Aggregate over rows for a grouping-free check."""
    if check.kind == ROW_COUNT:
        return F.count(F.lit(1))
    if check.kind == NOT_NULL:
        return F.count_if(any_null(check.columns))
    if check.kind == POSITIVE:
        return F.count_if(F.col(check.columns[0]) <= 0)
    raise ValueError(f"{check.kind} needs grouping")


def observed_checks(checks: Sequence[Check]) -> list[Column]:
    """``observe`` expressions for the grouping-free checks (named m<i>)."""
    return [_row_expr(c).alias(f"m{i}") for i, c in enumerate(checks) if c.kind != UNIQUE]


def _stack(summary: DataFrame, checks: Sequence[Check], values: list[Column]) -> DataFrame:
    rows = [F.struct(F.lit(c.name).alias("check_name"),
                     F.lit(c.metric).alias("metric"),
                     v.cast("bigint").alias("value"),
                     c.passes(v).alias("passed"),
                     F.lit(c.severity).alias("severity"),
                     F.lit(c.blocking).alias("blocking"))
            for c, v in zip(checks, values)]
    return summary.select(F.inline(F.array(*rows)))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate ``checks`` on ``df`` in one scan (see module docstring)."""
    checks = list(checks)
    if not checks:
        raise ValueError("no checks given")
    zero = F.lit(0).cast("bigint")
    key_sets: list[tuple[str, ...]] = []
    for c in checks:
        if c.kind == UNIQUE and c.columns not in key_sets:
            key_sets.append(c.columns)

    if not key_sets:
        summary = df.agg(*[_row_expr(c).alias(f"m{i}") for i, c in enumerate(checks)])
        return _stack(summary, checks, [F.coalesce(F.col(f"m{i}"), zero)
                                        for i in range(len(checks))])

    partial = [F.count(F.lit(1)).alias("_n")] + [
        _row_expr(c).alias(f"p{i}") for i, c in enumerate(checks)
        if c.kind not in (UNIQUE, ROW_COUNT)]

    if len(key_sets) == 1:
        keys = key_sets[0]
        per_key = df.groupBy(*keys).agg(*partial)
        in_set = {keys: F.lit(True)}
        first = F.lit(True)
    else:
        # One scan, one shuffle for every key set: grouping sets expand each
        # row once per set and grouping_id tells the sets apart.
        cols: list[str] = []
        for ks in key_sets:
            cols.extend(c for c in ks if c not in cols)
        per_key = df.groupingSets([list(ks) for ks in key_sets], *cols).agg(
            *partial, F.grouping_id().alias("_g"))
        width = len(cols)

        def gid(ks):
            return sum(1 << (width - 1 - j) for j, c in enumerate(cols) if c not in ks)
        in_set = {ks: F.col("_g") == gid(ks) for ks in key_sets}
        first = in_set[key_sets[0]]

    aggs = []
    for i, c in enumerate(checks):
        if c.kind == ROW_COUNT:
            aggs.append(F.sum(F.when(first, F.col("_n"))).alias(f"m{i}"))
        elif c.kind == UNIQUE:
            cond = in_set[c.columns] & (F.col("_n") > 1)
            if c.ignore_nulls:
                cond = cond & all_not_null(c.columns)
            aggs.append(F.count_if(cond).alias(f"m{i}"))
        else:
            aggs.append(F.sum(F.when(first, F.col(f"p{i}"))).alias(f"m{i}"))
    summary = per_key.agg(*aggs)
    return _stack(summary, checks, [F.coalesce(F.col(f"m{i}"), zero)
                                    for i in range(len(checks))])


def run_each(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The unfused form: one job per check. Same rows as ``run_checks``;
    kept to measure what fusing saves."""
    out = None
    for c in checks:
        r = run_checks(df, [c])
        out = r if out is None else out.unionByName(r)
    return out


def duplicate_keys(df: DataFrame, *keys: str, ignore_nulls: bool = False) -> DataFrame:
    """Keys occurring more than once, with their counts (A4 before counting)."""
    src = df.where(all_not_null(keys)) if ignore_nulls else df
    return (src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def results_from_metrics(spark, checks: Sequence[Check], metrics: dict,
                         extra: Sequence[DataFrame] = ()) -> DataFrame:
    """Check rows from values observed during a write (plus ``extra`` rows
    computed by ``run_checks``), in the ``run_checks`` schema."""
    rows = []
    for i, c in enumerate(checks):
        if c.kind == UNIQUE:
            continue
        v = int(metrics.get(f"m{i}") or 0)
        rows.append((c.name, c.metric, v, c.passes_value(v), c.severity, c.blocking))
    from slipway.sources.seeds import literal_frame
    out = literal_frame(spark, rows, RESULT_SCHEMA)
    for e in extra:
        out = out.unionByName(e)
    return out
