"""Declared schemas: derived from dataclasses, applied to tables, checked against tables."""

from __future__ import annotations

import dataclasses
import datetime
import decimal
import enum
import types
import typing
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.errors import QueryError
from quern.functions import geo
from quern.functions.fields import ANALYZER

# Keys used in dataclass field metadata and in StructField.metadata.
STORED = "stored"
EXIST = "exist"
KEY = "key"


@dataclasses.dataclass(frozen=True)
class Text:
    """``Annotated[str, Text()]`` marks a full-text field."""

    analyzer: str = "standard"


# Integers of a given width, for annotations.
Long = typing.Annotated[int, T.LongType()]
Integer = typing.Annotated[int, T.IntegerType()]
Short = typing.Annotated[int, T.ShortType()]
Byte = typing.Annotated[int, T.ByteType()]
Float = typing.Annotated[float, T.FloatType()]

# Python type -> stored type. Decimals are stored as doubles.
STORED_TYPES: dict[type, T.DataType] = {
    str: T.StringType(),
    uuid.UUID: T.StringType(),
    bool: T.BooleanType(),
    int: T.LongType(),
    float: T.DoubleType(),
    decimal.Decimal: T.DoubleType(),
    datetime.date: T.DateType(),
    datetime.datetime: T.TimestampType(),
    datetime.time: T.TimeType(),
}
POINT = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])


def derive(entity: type) -> T.StructType:
    """The schema of a dataclass: one column per field declared on it, named by property.

    ``field(metadata={"stored": name})`` renames a column in storage, ``{"exist": False}`` leaves a
    field out, ``{"key": True}`` marks the key (else a field called ``id``), which is mandatory.
    """
    schema = _derive(entity, ())
    key_of(schema)
    return schema


def _derive(entity: type, above: tuple[type, ...]) -> T.StructType:
    if not dataclasses.is_dataclass(entity):
        raise QueryError(f"{entity!r} is not a dataclass")
    if entity in above:
        raise QueryError(f"nested types form a cycle at {entity.__name__}")
    hints = typing.get_type_hints(entity, include_extras=True)
    own = entity.__dict__.get("__annotations__", {})
    columns = []
    for spec in dataclasses.fields(entity):
        if spec.name not in own or spec.metadata.get(EXIST) is False:
            continue
        dtype, metadata = _stored_type(spec.name, hints[spec.name], above + (entity,))
        metadata |= {k: spec.metadata[k] for k in (STORED, KEY) if k in spec.metadata}
        columns.append(T.StructField(spec.name, dtype, True, metadata))
    return T.StructType(columns)


def _stored_type(name: str, hint: typing.Any, above: tuple[type, ...]) -> tuple[T.DataType, dict]:
    metadata: dict = {}
    if typing.get_origin(hint) in (typing.Union, types.UnionType):
        inner = [a for a in typing.get_args(hint) if a is not type(None)]
        if len(inner) == 1:
            return _stored_type(name, inner[0], above)
    if typing.get_origin(hint) is typing.Annotated:
        base, *marks = typing.get_args(hint)
        for mark in marks:
            if isinstance(mark, Text):
                return T.StringType(), {ANALYZER: mark.analyzer}
            if isinstance(mark, T.DataType):
                return mark, metadata
        hint = base
    if typing.get_origin(hint) is list:
        (child,) = typing.get_args(hint)
        if isinstance(child, type) and dataclasses.is_dataclass(child):
            return T.ArrayType(_derive(child, above)), metadata
    elif hint is geo.Point:
        return POINT, metadata
    elif hint in STORED_TYPES:
        return STORED_TYPES[hint], metadata
    elif isinstance(hint, type) and issubclass(hint, enum.Enum):
        return T.StringType(), metadata
    elif isinstance(hint, type) and dataclasses.is_dataclass(hint):
        return T.ArrayType(_derive(hint, above)), metadata  # a single child is a list of one
    raise QueryError(f"field {name} has a type that cannot be stored: {hint!r}")


def key_of(schema: T.StructType) -> str:
    marked = [f.name for f in schema.fields if (f.metadata or {}).get(KEY)]
    if not marked and "id" in schema.fieldNames():
        marked = ["id"]
    if len(marked) != 1:
        raise QueryError(f"one key field is needed, found {marked}")
    return marked[0]


def stored_name(field: T.StructField) -> str:
    return (field.metadata or {}).get(STORED, field.name)


def stored_schema(schema: T.StructType) -> T.StructType:
    """The schema as it is stored, under stored names."""
    out = []
    for f in schema.fields:
        dtype = f.dataType
        if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
            dtype = T.ArrayType(stored_schema(dtype.elementType))
        metadata = {k: v for k, v in (f.metadata or {}).items() if k != STORED}
        out.append(T.StructField(stored_name(f), dtype, True, metadata))
    return T.StructType(out)


# ---- mapping between property names and stored names ----


def to_stored(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Property names -> stored names, children included. Columns not declared are left out."""
    out = []
    for f in schema.fields:
        out.append(_renamed(F.col(f.name), f, write=True).alias(stored_name(f), metadata=f.metadata or {}))
    return df.select(*out)


def from_stored(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Stored names -> property names, children included. A declared column that is absent is null."""
    out = []
    for f in schema.fields:
        name = stored_name(f)
        col = _renamed(F.col(name), f, write=False) if name in df.columns else F.lit(None).cast(f.dataType)
        out.append(col.alias(f.name, metadata=f.metadata or {}))
    return df.select(*out)


def _renamed(col: Column, field: T.StructField, write: bool) -> Column:
    dtype = field.dataType
    if not (isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)):
        return col

    def child(c: Column) -> Column:
        parts = []
        for f in dtype.elementType.fields:
            source, target = (f.name, stored_name(f)) if write else (stored_name(f), f.name)
            parts.append(_renamed(c.getField(source), f, write).alias(target))
        return F.struct(*parts)

    return F.transform(col, child)


# ---- checking and applying ----


def mismatches(actual: T.StructType, declared: T.StructType) -> list[Mapping[str, str]]:
    """Per declared column: missing, or of another type. Further columns in the table are fine."""
    out = []
    for f in declared.fields:
        want = f.dataType.simpleString()
        if f.name not in actual.fieldNames():
            out.append({"column": f.name, "problem": "missing", "declared": want, "actual": None})
            continue
        have = actual[f.name].dataType
        # The fields of children are not compared, but an array of structs is no other array.
        nested = _children(f.dataType) and _children(have)
        if have.simpleString() != want and not nested:
            out.append({"column": f.name, "problem": "type differs", "declared": want, "actual": have.simpleString()})
    return out


def _children(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)


def check(df: DataFrame, declared: T.StructType, policy: str = "warn") -> DataFrame:
    """The mismatches as rows; with ``policy="fail"`` any of them raises."""
    found = mismatches(df.schema, declared)
    if found and policy == "fail":
        raise QueryError("table does not conform: " + "; ".join(f"{m['column']} {m['problem']}" for m in found))
    if policy not in ("warn", "fail"):
        raise QueryError(f"policy is 'warn' or 'fail', not {policy!r}")
    rows = [(m["column"], m["problem"], m["declared"], m["actual"]) for m in found]
    return df.sparkSession.createDataFrame(rows, "column string, problem string, declared string, actual string")


def conform(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Cast to the declared schema by name, children included; absent columns become null."""
    out = []
    for f in declared.fields:
        if f.name in df.columns:
            col = _cast(F.col(f.name), df.schema[f.name].dataType, f.dataType)
        else:
            col = F.lit(None).cast(f.dataType)
        out.append(col.alias(f.name, metadata=f.metadata or {}))
    return df.select(*out)


def _cast(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """A cast that goes by name inside nested arrays, where Spark's own goes by position."""
    if (
        isinstance(want, T.ArrayType)
        and isinstance(want.elementType, T.StructType)
        and isinstance(have, T.ArrayType)
        and isinstance(have.elementType, T.StructType)
    ):
        inside = have.elementType

        def child(c: Column) -> Column:
            parts = []
            for f in want.elementType.fields:
                if f.name in inside.fieldNames():
                    parts.append(_cast(c.getField(f.name), inside[f.name].dataType, f.dataType).alias(f.name))
                else:
                    parts.append(F.lit(None).cast(f.dataType).alias(f.name))
            return F.struct(*parts)

        return F.transform(col, child)
    return col.cast(want)


def create_if_absent(spark: SparkSession, table: str, declared: T.StructType, policy: str = "warn") -> DataFrame | None:
    """Create an empty table with the declared schema, or check the one there is (returns mismatches)."""
    if spark.catalog.tableExists(table):
        return check(spark.table(table), declared, policy)
    spark.createDataFrame([], declared).write.format("parquet").saveAsTable(table)
    return None
