"""Avro records: binary values under a writer's schema, decoded in Arrow batches, so that no external jar is needed.

Types map to those in flight: records are structs, enums text, fixed values bytes, unions of null and one other type that type;
``date``, ``time-millis`` and the timestamps are read as such, times without zone in UTC. Decimals, other unions and recursive
records are refused when the schema is read, as tables can't hold them.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace import types as mt
from millrace.functions import idents
from millrace.session import ship

#: Bytes before a framed record: a zero and the number of its schema (fixed format).
FRAME = 5
_PLAIN = {"boolean": "boolean", "int": "int32", "long": "int64", "float": "float32", "double": "float64", "bytes": "bytes", "string": "string"}
_TIMES = {("int", "date"): "date", ("int", "time-millis"): "time", ("long", "timestamp-millis"): "timestamp", ("long", "timestamp-micros"): "timestamp", ("long", "local-timestamp-millis"): "timestamp", ("long", "local-timestamp-micros"): "timestamp"}


class DataError(ValueError):
    """A value that isn't a record of its schema."""


def _resolved(schema: object, named: dict) -> dict:
    """A schema with names replaced by what they name; unions become the type with ``null`` (the place of null in the union)."""
    if isinstance(schema, list):
        some = [s for s in schema if s != "null"]
        if len(some) != 1 or len(schema) > 2:
            raise ValueError(f"unsupported union {schema}")
        return {**_resolved(some[0], named), "null": schema.index("null") if "null" in schema else None, "union": True}
    if isinstance(schema, str):
        if schema in named:
            if named[schema] is None:
                raise ValueError(f"recursive record {schema}")
            return named[schema]
        schema = {"type": schema}
    kind = schema["type"]
    if isinstance(kind, (dict, list)) or kind in named:
        return _resolved(kind, named)
    if schema.get("logicalType") == "decimal":
        raise ValueError("unsupported type decimal")
    out = {"type": kind, "logical": schema.get("logicalType")}
    name = schema.get("name")
    if kind == "record":
        named[name] = None
        out["fields"] = [(f["name"], _resolved(f["type"], named)) for f in schema["fields"]]
    elif kind == "array":
        out["items"] = _resolved(schema["items"], named)
    elif kind == "map":
        out["values"] = _resolved(schema["values"], named)
    elif kind == "enum":
        out["symbols"] = schema["symbols"]
    elif kind == "fixed":
        out["size"] = schema["size"]
    elif kind not in _PLAIN:
        raise ValueError(f"unsupported type {kind}")
    if name:
        named[name] = out
    return out


def _field(name: str, s: dict) -> T.StructField:
    kind = s["type"]
    if kind == "record":
        return T.StructField(name, T.StructType([_field(n, x) for n, x in s["fields"]]))
    if kind == "array":
        return T.StructField(name, T.ArrayType(_field("element", s["items"]).dataType))
    if kind == "map":
        return T.StructField(name, T.MapType(T.StringType(), _field("value", s["values"]).dataType))
    if kind in ("enum", "fixed"):
        return mt.field(name, "string" if kind == "enum" else "bytes")
    return mt.field(name, _TIMES.get((kind, s["logical"]), _PLAIN[kind]))


def spark_schema(schema: str) -> T.StructType:
    """The in-flight schema of a writer's schema (JSON text of a record)."""
    s = _resolved(json.loads(schema), {})
    if s["type"] != "record":
        raise ValueError("a record's schema must be a record")
    return mt.prune_empty(_field("value", s).dataType)


class _Reader:
    def __init__(self, data: bytes, at: int):
        self.data, self.at = data, at

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self.data):
            raise DataError("record ends early")
        self.at += n
        return self.data[self.at - n : self.at]

    def long(self) -> int:
        out = shift = 0
        while True:
            b = self.take(1)[0]
            out |= (b & 0x7F) << shift
            if b < 0x80:
                return (out >> 1) ^ -(out & 1)
            shift += 7
            if shift > 63:
                raise DataError("number of too many bytes")


def _blocks(r: _Reader) -> Iterator[None]:
    """One step per item of an array or map, which come in counted blocks."""
    while n := r.long():
        if n < 0:
            n = -n
            r.long()  # the block's size in bytes
        for _ in range(n):
            yield


def _clock(ms: int) -> str:
    return f"{ms // 3_600_000:02d}:{ms // 60_000 % 60:02d}:{ms // 1000 % 60:02d}.{ms % 1000:03d}"


def _decoder(s: dict) -> Callable[[_Reader], object]:
    if s.get("union"):
        inner, null = _decoder({**s, "union": False}), s["null"]

        def union(r: _Reader) -> object:
            place = r.long()
            if place not in (0, 1):
                raise DataError(f"no member {place} in a union")
            return None if place == null else inner(r)

        return union
    kind, logical = s["type"], s["logical"]
    if kind == "record":
        fields = [(n, _decoder(x)) for n, x in s["fields"]]
        return lambda r: {n: d(r) for n, d in fields}
    if kind == "array":
        item = _decoder(s["items"])
        return lambda r: [item(r) for _ in _blocks(r)]
    if kind == "map":
        value = _decoder(s["values"])
        return lambda r: [(r.take(r.long()).decode(), value(r)) for _ in _blocks(r)]
    if kind == "enum":
        return lambda r: s["symbols"][r.long()]
    if kind == "fixed":
        return lambda r: r.take(s["size"])
    if kind in ("int", "long"):
        if logical == "time-millis":
            return lambda r: _clock(r.long())
        scale = 1000 if logical in ("timestamp-millis", "local-timestamp-millis") else 1
        return lambda r: r.long() * scale
    if kind == "string":
        return lambda r: r.take(r.long()).decode()
    if kind == "bytes":
        return lambda r: r.take(r.long())
    if kind == "boolean":
        return lambda r: r.take(1) != b"\0"
    n, f = (4, "<f") if kind == "float" else (8, "<d")
    return lambda r: struct.unpack(f, r.take(n))[0]


def decode(df: DataFrame, value: str, schema: str, keep: list[str] | None = None, framed: bool = False) -> DataFrame:
    """Typed columns of binary records, after the columns ``keep``. A null value is a row of nulls; bytes that aren't a record of the
    schema, too few or too many, raise. ``framed``: five bytes precede each record."""
    keep = keep or []
    root = _resolved(json.loads(schema), {})
    out = spark_schema(schema)
    ship(df.sparkSession)
    src = df.select(*[F.col(idents.column(c)) for c in keep], F.col(idents.column(value)).cast("binary").alias("__v"))
    arrow = to_arrow_schema(out)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _decoder(root)
        for batch in it:
            rows = []
            for data in batch.column(len(keep)).to_pylist():
                if data is None:
                    rows.append({})
                    continue
                r = _Reader(data, FRAME if framed else 0)
                rows.append(read(r))
                if r.at != len(data):
                    raise DataError(f"{len(data) - r.at} bytes after a record")
            cols = []
            for f in arrow:
                values = [row.get(f.name) for row in rows]
                plain = pa.int64() if pa.types.is_timestamp(f.type) else pa.int32() if pa.types.is_date(f.type) else f.type
                cols.append(pa.array(values, plain).cast(f.type) if plain != f.type else pa.array(values, f.type))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *cols], names=[*keep, *arrow.names])

    typed = src.mapInArrow(run, T.StructType([*src.schema.fields[: len(keep)], *out.fields]))
    return typed.select(*[F.col(idents.column(f.name)).alias(f.name, metadata=f.metadata or {}) for f in [*src.schema.fields[: len(keep)], *out.fields]])


def _long(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def encode(value: object, schema: str | dict) -> bytes:
    """A record (or a part of one) as bytes; times as their numbers. For tests and sources of the same process."""
    s = _resolved(json.loads(schema), {}) if isinstance(schema, str) else schema
    if s.get("union"):
        if value is None:
            return _long(s["null"])
        return _long(1 - s["null"] if s["null"] is not None else 0) + encode(value, {**s, "union": False})
    kind = s["type"]
    if kind == "record":
        return b"".join(encode(value.get(n), x) for n, x in s["fields"])
    if kind in ("array", "map"):
        items = [encode(v, s["items"]) for v in value] if kind == "array" else [_long(len(k.encode())) + k.encode() + encode(v, s["values"]) for k, v in value.items()]
        return (_long(len(items)) + b"".join(items) if items else b"") + _long(0)
    if kind == "enum":
        return _long(s["symbols"].index(value))
    if kind in ("int", "long"):
        return _long(value)
    if kind in ("string", "bytes"):
        data = value.encode() if kind == "string" else value
        return _long(len(data)) + data
    if kind == "boolean":
        return b"\1" if value else b"\0"
    return value if kind == "fixed" else struct.pack("<f" if kind == "float" else "<d", value)
