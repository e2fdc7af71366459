"""Unification of schemas within a batch, by an explicit lattice; nothing is left to implicit coercion.

Two or more schemas become the union of their fields, sorted by name at every level. Numbers and booleans widen, nested
types merge, times join with dates; text joins with nothing else, and what can't be joined raises with sample values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import types as mt
from millrace.functions import idents
from millrace.functions import timestamps as ts
from millrace.functions.jsonx import describe

_NUMBERS = {"int8", "int16", "int32", "int64", "float32", "float64", "boolean"}


class SchemaConflict(ValueError):
    """Fields whose types can't be joined."""


def _number(kinds: set[str]) -> str:
    for top in ("float64", "float32", "int64"):
        if top in kinds:
            return top
    return "int32"


def unify_fields(name: str, fields: list[T.StructField], samples: dict[str, object] | None = None) -> T.StructField:
    """The join of one field's types. The result doesn't depend on the order of ``fields``."""
    nullable = any(f.nullable for f in fields)
    fields = [f for f in fields if not isinstance(f.dataType, T.NullType)] or fields  # without a type: that of the others
    kinds = {mt.kind(f) for f in fields}
    if len(kinds) == 1:
        k = next(iter(kinds))
        if k == "struct":
            return T.StructField(name, unify_schemas([f.dataType for f in fields], force=True), nullable)
        if k == "array":
            elements = [T.StructField("element", f.dataType.elementType, f.dataType.containsNull) for f in fields]
            e = unify_fields(name, elements, samples)
            return T.StructField(name, T.ArrayType(e.dataType, e.nullable), nullable)
        if k == "map":
            key = unify_fields(name, [T.StructField("key", f.dataType.keyType, False) for f in fields], samples)
            value = unify_fields(name, [T.StructField("value", f.dataType.valueType, f.dataType.valueContainsNull) for f in fields], samples)
            return T.StructField(name, T.MapType(key.dataType, value.dataType, value.nullable), nullable)
        return mt.field(name, k, nullable)
    if kinds <= _NUMBERS:
        return mt.field(name, _number(kinds), nullable)
    if kinds <= {"timestamp", "date", "time"}:
        return mt.field(name, "timestamp" if "timestamp" in kinds else "time", nullable)
    found = ", ".join(sorted(kinds))
    shown = ", ".join(f"{k}={describe(v)}" for k, v in sorted((samples or {}).items()))
    raise SchemaConflict(f"Cannot unify incompatible types for field '{name}': Found conflicting types [{found}]" + (f" Sample values: [{shown}]" if shown else ""))


def unify_schemas(schemas: list[T.StructType], samples: dict[str, dict[str, object]] | None = None, force: bool = False) -> T.StructType:
    """One schema stays as it is (columns in its order); of several, the union by name, sorted."""
    if not schemas:
        raise ValueError("No valid schemas found in records")
    if len(schemas) == 1 and not force:
        return schemas[0]
    by: dict[str, list[T.StructField]] = {}
    for s in schemas:
        for f in s.fields:
            by.setdefault(f.name, []).append(f)
    out = []
    for name in sorted(by):
        f = unify_fields(name, by[name], (samples or {}).get(name))
        out.append(T.StructField(name, f.dataType, f.nullable or len(by[name]) < len(schemas), f.metadata))
    return T.StructType(out)


def same(a: T.StructType, b: T.StructType, ordered: bool = True) -> bool:
    """Equality of names, types, nullability and children; metadata other than the logical type is ignored, and with
    ``ordered=False`` the order of children too."""

    def norm(t: T.DataType) -> object:
        if isinstance(t, T.StructType):
            fs = [(f.name, (f.metadata or {}).get("logical"), f.nullable, norm(f.dataType)) for f in t.fields]
            return ("struct", tuple(fs if ordered else sorted(fs, key=repr)))
        if isinstance(t, T.ArrayType):
            return ("array", t.containsNull, norm(t.elementType))
        if isinstance(t, T.MapType):
            return ("map", t.valueContainsNull, norm(t.keyType), norm(t.valueType))
        return t.simpleString()

    return norm(a) == norm(b)


def add_field(schema: T.StructType, f: T.StructField) -> T.StructType:
    """With one more field, sorted by name; one of that name must not be there."""
    if f.name in schema.fieldNames():
        raise ValueError(f"field {f.name} is there already")
    return T.StructType(sorted([*schema.fields, f], key=lambda x: x.name))


def remove_field(schema: T.StructType, name: str) -> T.StructType:
    if name not in schema.fieldNames():
        raise ValueError(f"no field {name}")
    return T.StructType([f for f in schema.fields if f.name != name])


def _cast(c: Column, have: T.StructField, want: T.StructField) -> Column:
    a, b = have.dataType, want.dataType
    ka, kb = mt.kind(have), mt.kind(want)
    if isinstance(b, T.StructType) and isinstance(a, T.StructType):
        known = {f.name: f for f in a.fields}
        parts = [(_cast(c.getField(f.name), known[f.name], f) if f.name in known else F.lit(None).cast(f.dataType)).alias(f.name) for f in b.fields]
        return F.when(c.isNotNull(), F.struct(*parts)) if parts else c
    if isinstance(b, T.ArrayType) and isinstance(a, T.ArrayType):
        return F.transform(c, lambda x: _cast(x, T.StructField("e", a.elementType), T.StructField("e", b.elementType)))
    if isinstance(b, T.MapType) and isinstance(a, T.MapType):
        out = F.transform_values(c, lambda _, v: _cast(v, T.StructField("v", a.valueType), T.StructField("v", b.valueType)))
        return out if a.keyType == b.keyType else F.transform_keys(out, lambda k, _: k.cast(b.keyType))
    if ka == "time" and kb == "timestamp":
        return F.concat(F.lit("1970-01-01 "), c).try_cast("timestamp_ntz")
    if isinstance(a, T.TimestampType) and kb == "timestamp":
        return ts.utc(c)
    if ka == "date" and kb == "time":
        return F.when(c.isNotNull(), F.lit("00:00:00.000"))
    return c if a == b else c.cast(b)


def project(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``: cast explicitly, absent ones null, others dropped."""
    known = {f.name: f for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        c = _cast(F.col(idents.column(f.name)), known[f.name], f) if f.name in known else F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name, metadata=f.metadata or {}))
    return df.select(*cols)


def union(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL of frames of differing schemas: columns by name under the unified schema."""
    schema = unify_schemas([f.schema for f in frames])
    return reduce(DataFrame.unionByName, [project(f, schema) for f in frames])
