"""Column expressions used by models, checks and gates.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none needs a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Node statuses that count as clean, and the text values a
# flag may take to mean "on".
OK_STATUSES = ("success", "pass")
TRUE_FLAGS = ("true", "1", "yes")

# Name prefixes that give a node its layer and strategy.
STAGING_PREFIX = "stg_"
MART_PREFIX = "mart_"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_ntz(col) -> Column:
    """``cast(x as timestamp)`` with no time zone (F1)."""
    return _c(col).cast("timestamp_ntz")


# Units whose boundary is a calendar date.
_DATE_UNITS = ("year", "yyyy", "yy", "quarter", "month", "mon", "mm", "week")


def trunc_ntz(unit: str, col) -> Column:
    """``date_trunc(unit, ts)`` keeping a zone-less timestamp (F2).

    Day and coarser units go through ``date``, which involves no time zone:
    ``date_trunc`` would pass through the session zone, and on a day whose
    midnight does not exist there (a daylight-saving jump at 00:00) it would
    return 01:00. Finer units use ``date_trunc`` and cast back.
    """
    u = unit.lower()
    if u in ("day", "dd"):
        return _c(col).cast("date").cast("timestamp_ntz")
    if u in _DATE_UNITS:
        return F.trunc(_c(col).cast("date"), u).cast("timestamp_ntz")
    return F.date_trunc(unit, _c(col)).cast("timestamp_ntz")


def status_ok(col="status") -> Column:
    return _c(col).isin(*OK_STATUSES)


def is_truthy(col) -> Column:
    """``lower(trim(flag)) in ('true','1','yes')``; NULL is false."""
    return F.coalesce(F.lower(F.trim(_c(col))).isin(*TRUE_FLAGS), F.lit(False))


def node_label(id_col="unique_id", status_col="status") -> Column:
    """``<unique_id> (<status>)`` as the failure list shows it."""
    return F.concat(_c(id_col), F.lit(" ("), _c(status_col), F.lit(")"))


def joined_sorted(col, sep: str = ", ") -> Column:
    """Aggregate: the values of a group, sorted, joined by ``sep`` (F8)."""
    return F.array_join(F.array_sort(F.collect_list(_c(col))), sep)


def in_folder(folder: str, fqn_col="fqn") -> Column:
    """``folder in node.fqn``."""
    return F.coalesce(F.array_contains(_c(fqn_col), folder), F.lit(False))


def layer_of(name_col="name") -> Column:
    """Layer tag from the name: ``stg_`` is staging, anything else marts."""
    return (F.when(_c(name_col).startswith(STAGING_PREFIX), F.lit("staging"))
            .otherwise(F.lit("marts")))


def strategy_of(name_col="name") -> Column:
    """Only ``mart_`` names are deployed blue/green."""
    return F.when(_c(name_col).startswith(MART_PREFIX), F.lit("blue_green"))


def schema_name(custom_col, default: str) -> Column:
    """A configured schema is used literally (trimmed), else the default."""
    return F.coalesce(F.trim(_c(custom_col)), F.lit(default))


def run_key(id_col="id", prefix: str = "revert-") -> Column:
    """Run key ``revert-<id>`` that makes a remediation idempotent."""
    return F.concat(F.lit(prefix), _c(id_col).cast("string"))


def cursor_value(col) -> Column:
    """Stored text cursor to a number; none means 0."""
    return F.coalesce(_c(col).cast("bigint"), F.lit(0).cast("bigint"))


def any_null(cols: Iterable[str]) -> Column:
    cols = list(cols)
    expr = F.col(cols[0]).isNull()
    for c in cols[1:]:
        expr = expr | F.col(c).isNull()
    return expr


def all_not_null(cols: Iterable[str]) -> Column:
    return ~any_null(cols)
