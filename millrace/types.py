"""Types in flight and at rest.

Columns are stored flat: nested values are JSON text. JSON and times of day are strings in Spark, told apart from plain
strings by the field's metadata (``logical``), as they don't mix with strings when a table evolves.
"""

from __future__ import annotations

from pyspark.sql import types as T

JSON = {"logical": "json"}
TIME = {"logical": "time"}
SYSTEM_COLUMN = "_inserted_at"

_KINDS = {T.ByteType: "int8", T.ShortType: "int16", T.IntegerType: "int32", T.LongType: "int64", T.FloatType: "float32", T.DoubleType: "float64", T.BooleanType: "boolean", T.StringType: "string", T.BinaryType: "bytes", T.TimestampNTZType: "timestamp", T.TimestampType: "timestamp", T.DateType: "date", T.StructType: "struct", T.ArrayType: "array", T.MapType: "map"}
_SPARK = {"int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(), "int64": T.LongType(), "float32": T.FloatType(), "float64": T.DoubleType(), "boolean": T.BooleanType(), "string": T.StringType(), "bytes": T.BinaryType(), "timestamp": T.TimestampNTZType(), "date": T.DateType(), "time": T.StringType(), "json": T.StringType()}
#: Names of the stored types (fixed values).
STORED = {"int8": "TINYINT", "int16": "SMALLINT", "int32": "INTEGER", "int64": "BIGINT", "float32": "FLOAT", "float64": "DOUBLE", "boolean": "BOOLEAN", "string": "VARCHAR", "bytes": "BLOB", "timestamp": "TIMESTAMP", "date": "DATE", "time": "TIME", "json": "JSON"}
INTEGERS = ("int8", "int16", "int32", "int64")


def kind(field: T.StructField) -> str:
    """Name of a field's type. Decimals, intervals and others that can't be stored raise."""
    logical = (field.metadata or {}).get("logical")
    if logical in ("json", "time") and isinstance(field.dataType, T.StringType):
        return logical
    for cls, name in _KINDS.items():
        if type(field.dataType) is cls:
            return name
    raise ValueError(f"unsupported type {field.dataType.simpleString()} of field {field.name}")


def field(name: str, kind_: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, _SPARK[kind_], nullable, {"logical": kind_} if kind_ in ("json", "time") else None)


def stored_name(f: T.StructField) -> str:
    k = kind(f)
    return STORED["json" if k in ("struct", "array", "map") else k]


def at_rest(schema: T.StructType) -> T.StructType:
    """The stored form: nested fields become JSON, everything is nullable, zoned timestamps lose their zone."""
    out = []
    for f in schema.fields:
        k = kind(f)
        out.append(field(f.name, "json" if k in ("struct", "array", "map") else k))
    return T.StructType(out)


def connect_field(schema: dict, name: str | None = None) -> T.StructField:
    """A field from a Connect schema given as JSON (type, optional, name of the logical type, fields, items, keys, values)."""
    name = name if name is not None else schema.get("field", "value")
    nullable = bool(schema.get("optional", False))
    logical = str(schema.get("name") or "").rpartition(".")[2]
    t = schema.get("type")
    if logical in ("Timestamp", "Date", "Time") and t in ("int32", "int64"):
        return field(name, logical.lower(), nullable)
    if t == "struct":
        return T.StructField(name, T.StructType([connect_field(f) for f in schema.get("fields", [])]), nullable)
    if t == "array":
        e = connect_field(schema["items"], "element")
        return T.StructField(name, T.ArrayType(e.dataType, e.nullable), nullable)
    if t == "map":
        k, v = connect_field(schema["keys"], "key"), connect_field(schema["values"], "value")
        return T.StructField(name, T.MapType(k.dataType, v.dataType, v.nullable), nullable)
    if t not in _SPARK or t in ("json", "time", "timestamp", "date"):
        raise ValueError(f"unknown type {t} of field {name}")
    return field(name, t, nullable)


def connect_schema(schema: dict) -> T.StructType:
    """A record's schema; empty structs at the top level are left out, those below are kept."""
    if schema.get("type") != "struct":
        raise ValueError("a record's schema must be a struct")
    return prune_empty(T.StructType([connect_field(f) for f in schema.get("fields", [])]))


def prune_empty(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema.fields if not (isinstance(f.dataType, T.StructType) and not f.dataType.fields)])
