"""Raw inputs: CSV seeds, Parquet tables and literal fixture rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV with a header row, typed by ``schema`` (never inferred)."""
    return (spark.read.schema(schema)
            .option("header", True)
            .option("mode", "FAILFAST")
            .csv(path))


# Columns that ``classified`` adds.
REJECT_COLS = ("given", "line", "reasons")


def read_texts(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """A CSV, with a header row or without, its columns as text, and ``line``: the whole line where it has
    another number of fields, else NULL. Nothing fails on a bad row; see ``classified``."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]
                         + [T.StructField("line", T.StringType())])
    # whatever columns a query needs, the number of fields is that of the whole line
    return (spark.read.schema(texts).option("header", header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "line").option("columnPruning", False).csv(path))


def classified(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns in ``schema``'s types, with ``reasons`` (text array, sorted by column; empty for a good row).

    A reason is ``<column>: not <type>`` for a text that does not cast, ``<column>: missing`` for a
    NULL in a column that the schema says has none, or ``fields`` for a line with another number of
    fields, which has no other. ``given`` holds the texts of a rejected row, ``line`` the line.
    """
    clash = [f.name for f in schema.fields if f.name in REJECT_COLS]
    if clash:
        raise ValueError(f"columns with names that the rejects need: {clash}")
    line = F.col("line") if "line" in texts.columns else F.lit(None).cast("string")
    reasons = [F.when(line.isNotNull(), F.lit("fields"))]
    for f in schema.fields:
        bad = F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        reason = F.when(bad, F.lit(f"{f.name}: not {f.dataType.simpleString()}"))
        if not f.nullable:
            reason = reason.when(F.col(f.name).isNull(), F.lit(f"{f.name}: missing"))
        reasons.append(F.when(line.isNull(), reason))
    why = F.array_compact(F.array(*reasons))
    given = F.struct(*[F.col(f.name) for f in schema.fields])
    return texts.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields],
                        F.when(F.size(why) > 0, given).alias("given"), F.when(F.size(why) > 0, line).alias("line"),
                        why.alias("reasons"))


def read_table(spark: SparkSession, path: str,
               schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns by name and cast them to its types.

    A missing column raises at analysis; a value that does not fit raises at
    run time (ANSI casts) and a column that the schema lacks raises here, so a
    land step never writes a silently changed table.
    """
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    if extra:
        raise ValueError(f"columns that the table does not have: {extra}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def from_rows(spark: SparkSession, rows: Sequence[tuple],
              schema: T.StructType) -> DataFrame:
    """Literal rows, for fixtures only; real inputs are files."""
    return spark.createDataFrame(list(rows), schema)


def _literal(value, dtype: T.DataType) -> Column:
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.ArrayType):
        return F.array(*[_literal(v, dtype.elementType) for v in value]).cast(dtype)
    if isinstance(dtype, T.MapType):
        kv = [c for k, v in value.items()
              for c in (_literal(k, dtype.keyType), _literal(v, dtype.valueType))]
        return F.create_map(*kv).cast(dtype)
    if isinstance(value, dt.datetime):
        # through text, so no time zone is applied on the way
        return F.lit(value.isoformat(sep=" ")).cast(dtype)
    return F.lit(value).cast(dtype)


def literal_frame(spark: SparkSession, rows: Sequence[Sequence],
                  schema: T.StructType) -> DataFrame:
    """A small DataFrame of driver-held rows (log entries, check results,
    run results) built from literals, so no Python worker is involved.
    For metadata only: every value becomes part of the plan."""
    rows = list(rows)
    if not rows:
        return spark.createDataFrame(rows, schema)
    structs = [F.struct(*[_literal(v, f.dataType).alias(f.name)
                          for v, f in zip(r, schema.fields)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
