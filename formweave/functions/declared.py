"""Declared table schemas: 12 type names, 3 modes, descriptions and nested fields."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared type names and the Spark types that hold them.
SCALAR_TYPES: dict[str, T.DataType] = {
    "BOOL": T.BooleanType(),
    "BYTES": T.BinaryType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "FLOAT64": T.DoubleType(),
    "GEOGRAPHY": T.StringType(),
    "INT64": T.LongType(),
    "NUMERIC": T.DecimalType(38, 9),
    "STRING": T.StringType(),
    "TIME": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
}
# Spark's TIME type is off by default (`spark.sql.timeType.enabled`); times stay text unless it is asked for.
NATIVE_TIME = T.TimeType()
MODES = ("NULLABLE", "REQUIRED", "REPEATED")


@dataclass(frozen=True)
class FieldDeclaration:
    name: str
    type: str
    mode: str | None = None
    description: str | None = None
    fields: tuple["FieldDeclaration", ...] = ()


def to_field(declared: FieldDeclaration, native_time: bool = False) -> T.StructField:
    mode = declared.mode or "NULLABLE"
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r} of field {declared.name!r}")
    if declared.type == "STRUCT":
        kind: T.DataType = to_schema(declared.fields, native_time)
    elif declared.type == "TIME" and native_time:
        kind = NATIVE_TIME
    elif declared.type in SCALAR_TYPES:
        kind = SCALAR_TYPES[declared.type]
    else:
        raise ValueError(f"unknown type {declared.type!r} of field {declared.name!r}")
    if mode == "REPEATED":
        kind = T.ArrayType(kind)
    metadata = {"comment": declared.description} if declared.description is not None else None
    return T.StructField(declared.name, kind, mode != "REQUIRED", metadata)


def to_schema(declared: tuple[FieldDeclaration, ...] | list[FieldDeclaration],
              native_time: bool = False) -> T.StructType:
    return T.StructType([to_field(d, native_time) for d in declared])


def typed(column: Column, kind: T.DataType) -> Column:
    """Text to the declared type; text that does not fit reads as NULL."""
    if isinstance(kind, T.StringType):
        return column
    if isinstance(kind, T.BinaryType):
        return F.try_to_binary(column, F.lit("base64"))
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.from_json(column, kind)
    return column.try_cast(kind)


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """View an all-text form table through a declared schema; columns the table lacks read as NULL.

    A required column is reported, not enforced row by row: see `missing_required`.
    """
    have = {c.lower(): c for c in df.columns}
    picked = []
    for f in schema.fields:
        source = df[have[f.name.lower()]] if f.name.lower() in have else F.lit(None).cast("string")
        picked.append(typed(source, f.dataType).alias(f.name, metadata=f.metadata or {}))
    return df.select(*picked)


def missing_required(schema: T.StructType) -> Column:
    """Names of required columns that are NULL in a row of `apply_schema`."""
    tests = [F.when(F.col(f"`{f.name}`").isNull(), F.lit(f.name)) for f in schema.fields if not f.nullable]
    return F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")
