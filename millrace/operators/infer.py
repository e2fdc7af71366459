"""Schema inference for schemaless records.

Every task folds the types of its records into one tree, a few tasks fold these, and the driver the last few. The fold
follows the unification lattice, is associative and commutative, and keeps one sample value per field and type, so that a
conflict can be shown. Whole numbers are int32 where they fit, else int64; fractions float64; text that is an ISO time is a
timestamp unless its field's name is like an identifier's; null-valued fields and empty arrays have no type.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import types as mt
from millrace.functions import clock, idents
from millrace.functions import timestamps as ts
from millrace.functions.jsonx import describe
from millrace.operators.unify import SchemaConflict
from millrace.session import ship

_ID_LIKE = re.compile(ts.ID_LIKE)
#: Trees that are folded on the driver; those of the tasks are folded into so many before.
LAST_TREES = 8
_NUMBER_RANK = ("boolean", "int32", "int64", "float64")


def observe(value: object, name: str | None = None) -> dict | None:
    """Type tree of a value: {"s": {name: tree}}, {"a": tree} or {"k": {kind: sample}}; None where there is no type."""
    if value is None:
        return None
    if isinstance(value, dict):
        fields = {k: t for k, v in value.items() if (t := observe(v, k)) is not None}
        return {"s": fields}
    if isinstance(value, list):
        out = None
        for v in value:
            out = fold(out, observe(v))
        return None if out is None else {"a": out}
    if isinstance(value, bool):
        k = "boolean"
    elif isinstance(value, int):
        k = "int32" if -(1 << 31) <= value < 1 << 31 else "int64" if -(1 << 63) <= value < 1 << 63 else "float64"
    elif isinstance(value, float):
        k = "float64"
    else:
        named_id = name is not None and _ID_LIKE.search(name.lower())
        k = "timestamp" if not named_id and clock.iso_micros(value) is not None else "string"
    return {"k": {k: describe(value)}}


def fold(a: dict | None, b: dict | None) -> dict | None:
    """The join of two trees; what doesn't join keeps all its kinds, to be reported."""
    if a is None or b is None:
        return b if a is None else a
    if "s" in a and "s" in b and len(a) == len(b) == 1:
        return {"s": {n: fold(a["s"].get(n), b["s"].get(n)) for n in {**a["s"], **b["s"]}}}
    if "a" in a and "a" in b and len(a) == len(b) == 1:
        return {"a": fold(a["a"], b["a"])}
    out = {}
    for part in ("s", "a"):
        if part in a or part in b:
            joined = fold({part: a[part]} if part in a else None, {part: b[part]} if part in b else None)
            out[part] = joined[part]
    if "k" in a or "k" in b:
        x, y = a.get("k", {}), b.get("k", {})
        out["k"] = {k: min(v for v in (x.get(k), y.get(k)) if v is not None) for k in {**x, **y}}
    return out


def resolve(tree: dict, name: str = "value", strict: bool = True) -> T.DataType | None:
    """The type of a folded tree; a conflict raises, or with ``strict=False`` becomes text."""
    kinds = dict(tree.get("k", {}))
    parts = [p for p in ("s", "a") if p in tree]
    if not parts and len(kinds) > 1 and set(kinds) <= set(_NUMBER_RANK):
        return mt.field(name, max(kinds, key=_NUMBER_RANK.index)).dataType
    if not parts and len(kinds) == 1:
        return mt.field(name, next(iter(kinds))).dataType
    if len(parts) == 1 and not kinds:
        if parts[0] == "a":
            e = resolve(tree["a"], name, strict)
            return None if e is None else T.ArrayType(e)
        fields = [(n, resolve(t, n, strict)) for n, t in tree["s"].items()]
        return T.StructType([T.StructField(n, t) for n, t in fields if t is not None])
    if not strict:
        return T.StringType()
    for p in parts:
        kinds["struct" if p == "s" else "array"] = "{...}" if p == "s" else "[...]"
    shown = ", ".join(f"{k}={v}" for k, v in sorted(kinds.items()))
    raise SchemaConflict(f"Cannot unify incompatible types for field '{name}': Found conflicting types [{', '.join(sorted(kinds))}] Sample values: [{shown}]")


def _ordered(tree: dict | None) -> dict | None:
    if tree is None:
        return None
    out = {}
    if "s" in tree:
        out["s"] = {n: _ordered(tree["s"][n]) for n in sorted(tree["s"])}
    if "a" in tree:
        out["a"] = _ordered(tree["a"])
    if "k" in tree:
        out["k"] = dict(sorted(tree["k"].items()))
    return out


def schema_tree(df: DataFrame, value: str) -> dict | None:
    """Folded tree of all JSON objects of a text column; nulls, other JSON and malformed text have none."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = None
        for pdf in it:
            for text in pdf["v"]:
                if text is None:
                    continue
                try:
                    record = json.loads(text)
                except (ValueError, RecursionError):
                    continue
                if isinstance(record, dict):
                    out = fold(out, observe(record))
        if out is not None:
            yield pd.DataFrame({"tree": [json.dumps(_ordered(out))]})

    def again(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = None
        for pdf in it:
            for tree in pdf["tree"]:
                out = fold(out, json.loads(tree))
        if out is not None:
            yield pd.DataFrame({"tree": [json.dumps(_ordered(out))]})

    ship(df.sparkSession)
    trees = df.select(F.col(idents.column(value)).alias("v")).mapInPandas(run, "tree string")
    out = None
    for r in trees.repartition(LAST_TREES).mapInPandas(again, "tree string").collect():  # so many rows at most
        out = fold(out, json.loads(r.tree))
    return _ordered(out)


def _shape(tree: dict | None) -> object:
    """A type tree without its samples."""
    if tree is None:
        return None
    return {p: {n: _shape(t) for n, t in sorted(tree["s"].items())} if p == "s" else _shape(tree["a"]) if p == "a" else sorted(tree["k"]) for p in sorted(tree)}


def signatures(df: DataFrame, value: str, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` and ``schema``: each record's own schema as text, equal for equal schemas; null for nulls, malformed
    text and values that aren't objects."""
    keep = keep or []
    ship(df.sparkSession)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for text in pdf["__v"]:
                try:
                    record = json.loads(text) if text is not None else None
                except (ValueError, RecursionError):
                    record = None
                out.append(json.dumps(_shape(observe(record))) if isinstance(record, dict) else None)
            yield pdf[keep].assign(schema=pd.Series(out, dtype="object", index=pdf.index))

    src = df.select(*[F.col(idents.column(c)) for c in keep], F.col(idents.column(value)).alias("__v"))
    return src.mapInPandas(run, T.StructType([*src.schema.fields[:-1], T.StructField("schema", T.StringType())]))


def samples(tree: dict | None, path: str = "") -> list[tuple[str, str, str]]:
    """(field path, type, sample value) of every leaf of a folded tree: what an error about a conflict shows."""
    if tree is None:
        return []
    out = [(path, k, v) for k, v in tree.get("k", {}).items()]
    for n, t in tree.get("s", {}).items():
        out += samples(t, f"{path}.{n}" if path else n)
    return out + samples(tree.get("a"), f"{path}[]")


def infer(df: DataFrame, value: str, strict: bool = True) -> T.StructType:
    """Schema of a column of JSON objects, fields sorted by name, structs without fields left out at the top.

    Raises where no record is usable, and for fields whose values don't join (``strict``)."""
    tree = schema_tree(df, value)
    if tree is None:
        raise ValueError("No valid schemas found in records")
    return mt.prune_empty(resolve(tree, value, strict))


def _raw(t: T.DataType) -> T.DataType:
    """The type to read JSON with: times as text, they are converted after."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _raw(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_raw(t.elementType))
    if isinstance(t, T.MapType):
        return T.MapType(T.StringType(), _raw(t.valueType))
    return T.StringType() if isinstance(t, (T.TimestampNTZType, T.TimestampType, T.DateType, T.BinaryType)) else t


def _finish(c: Column, t: T.DataType, logical: str | None = None) -> Column:
    if logical == "time":  # milliseconds of the day, or text
        ms = c.try_cast("bigint")
        parts = [F.lpad(F.floor(ms / n).cast("bigint").cast("string") if m is None else (F.floor(ms / n) % m).cast("bigint").cast("string"), w, "0") for n, m, w in ((3_600_000, None, 2), (60_000, 60, 2), (1000, 60, 2), (1, 1000, 3))]
        return F.coalesce(F.concat(parts[0], F.lit(":"), parts[1], F.lit(":"), parts[2], F.lit("."), parts[3]), c)
    if isinstance(t, T.DateType):
        return F.coalesce(F.date_from_unix_date(c.try_cast("int")), c.try_cast("date"))
    if isinstance(t, T.BinaryType):
        return F.unbase64(c)
    if isinstance(t, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_finish(c.getField(f.name), f.dataType, (f.metadata or {}).get("logical")).alias(f.name) for f in t.fields])) if t.fields else c
    if isinstance(t, T.ArrayType):
        return F.transform(c, lambda x: _finish(x, t.elementType))
    if isinstance(t, T.MapType):
        return F.transform_values(c, lambda _, v: _finish(v, t.valueType))
    if isinstance(t, (T.TimestampNTZType, T.TimestampType)):
        millis = F.coalesce(ts.epoch_millis(c), c.try_cast("bigint"))
        return ts.from_micros(F.try_multiply(millis, F.lit(1000)))
    return c


def parse(df: DataFrame, value: str, schema: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """JSON objects as typed columns; a null, malformed or other value gives a row of nulls (no row is lost)."""
    keep = keep or []
    parsed = df.select(*[F.col(idents.column(c)) for c in keep], F.from_json(F.col(idents.column(value)), _raw(schema), {"mode": "PERMISSIVE"}).alias("__r"))
    return parsed.select(*[F.col(idents.column(c)) for c in keep], *[_finish(F.col("__r").getField(f.name), f.dataType, (f.metadata or {}).get("logical")).alias(f.name, metadata=f.metadata or {}) for f in schema.fields])
