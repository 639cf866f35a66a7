"""What changed between two versions of a table.

Both versions are one bag of rows with a sign, added up per distinct row in
one shuffle: rows that stayed cancel out, and repeated rows count. NULL equals
NULL, as in a set operation. Equal rows meet in the partial aggregate first, so
a row that makes up a third of a version is one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPIES = "copies"


def bag_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """The distinct rows whose number changed, with ``copies``: how many more (or, negative, fewer) there are now."""
    cols = old.columns
    if sorted(cols) != sorted(new.columns):
        raise ValueError(f"other columns: {sorted(set(cols) ^ set(new.columns))}")
    signed = old.withColumn(COPIES, F.lit(-1)).unionByName(new.withColumn(COPIES, F.lit(1)))
    return signed.groupBy(*cols).agg(F.sum(COPIES).alias(COPIES)).where(F.col(COPIES) != 0)


def changed_keys(difference: DataFrame, key: Sequence[str]) -> DataFrame:
    """Per key of the changed rows: rows added and removed, and ``change``: added, removed or changed (both)."""
    more, fewer = F.greatest(F.col(COPIES), F.lit(0)), F.greatest(-F.col(COPIES), F.lit(0))
    change = F.when(F.col("removed") == 0, "added").when(F.col("added") == 0, "removed").otherwise("changed")
    return difference.groupBy(*key).agg(F.sum(more).alias("added"), F.sum(fewer).alias("removed")) \
        .withColumn("change", change)
