"""Arrow IPC payloads: one record value is a whole batch of rows."""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from millrace import types as mt
from millrace.functions import idents
from millrace.operators.unify import unify_fields
from millrace.session import registry_rows, ship


class DataError(ValueError):
    """A value that isn't a batch of rows."""


def encode(table: pa.Table | pa.RecordBatch) -> bytes:
    """Stream bytes of a table or batch; anything else raises."""
    if not isinstance(table, (pa.Table, pa.RecordBatch)):
        raise DataError(f"not a batch of rows: {type(table).__name__}")
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema) as w:
        w.write(table) if isinstance(table, pa.RecordBatch) else w.write_table(table)
    return out.getvalue()


def decode(payload: bytes | None) -> pa.Table | None:
    """All batches of the stream as one table; None for null and empty payloads."""
    if not payload:
        return None
    with pa.ipc.open_stream(payload) as r:
        return r.read_all()


def _flat(t: pa.DataType) -> pa.DataType:
    """Types as Spark reads them: times of day as text, unsigned as signed of the same width, large text as text."""
    if pa.types.is_time(t) or pa.types.is_large_string(t):
        return pa.string()
    if pa.types.is_large_binary(t):
        return pa.binary()
    if pa.types.is_unsigned_integer(t):
        return {8: pa.int8(), 16: pa.int16(), 32: pa.int32(), 64: pa.int64()}[t.bit_width]
    if pa.types.is_timestamp(t):
        return pa.timestamp("us")
    if pa.types.is_date(t):
        return pa.date32()
    return t


def spark_schema(schema: pa.Schema) -> T.StructType:
    """The in-flight schema of a payload; times of day are tagged, timestamps have no zone."""
    flat = pa.schema([pa.field(f.name, _flat(f.type), f.nullable) for f in schema])
    out = from_arrow_schema(flat, prefer_timestamp_ntz=True)
    return T.StructType([mt.field(f.name, "time", f.nullable) if pa.types.is_time(a.type) else f for f, a in zip(out.fields, schema, strict=True)])


def joined(schemas: list[T.StructType]) -> T.StructType:
    """One schema for payloads of several, by the lattice of batches: the union of their columns, sorted. Names that differ in
    case only are one column; a column without a type takes that of the others. One schema stays as it is."""
    if len(schemas) == 1:
        return schemas[0]
    by: dict[str, list[T.StructField]] = {}
    for s in schemas:
        if len({f.name.lower() for f in s.fields}) < len(s.fields):
            raise DataError(f"columns of one payload differ in case only: {s.fieldNames()}")
        for f in s.fields:
            by.setdefault(f.name.lower(), []).append(f)
    out = []
    for fields in by.values():
        name = min(f.name for f in fields)
        fields = [f for f in fields if f.dataType != T.NullType()] or fields
        kinds = {(f.dataType, (f.metadata or {}).get("logical")) for f in fields}
        f = fields[0] if len(kinds) == 1 else unify_fields(name, fields)
        out.append(T.StructField(name, f.dataType, True, f.metadata))
    return T.StructType(sorted(out, key=lambda f: f.name))


def schemas_of(df: DataFrame, payload: str) -> list[T.StructType]:
    """The distinct schemas of all payloads, from their headers; every task sends each once."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in it:
            for value in batch.column(0).to_pylist():
                if value:
                    with pa.ipc.open_stream(value) as r:
                        seen.add(spark_schema(r.schema).json())
        yield pa.RecordBatch.from_arrays([pa.array(sorted(seen), pa.string())], names=["s"])

    ship(df.sparkSession)
    rows = registry_rows(df.select(F.col(idents.column(payload)).cast("binary").alias("p")).mapInArrow(run, "s string").distinct())
    return [T.StructType.fromJson(json.loads(x)) for x in sorted(r.s for r in rows)]


def _as(c: pa.Array, want: pa.DataType, logical: str | None = None) -> pa.Array:
    """An array under a type its own was joined to; children by name, absent ones null."""
    have = c.type
    if have == want:
        return c
    if pa.types.is_null(have):
        return pa.nulls(len(c), want)
    if pa.types.is_time(have):
        micros = c.cast(pa.time64("us")).cast(pa.int64())
        if pa.types.is_timestamp(want):
            return micros.cast(want)
        clock = [None if u is None else f"{u // 3_600_000_000:02d}:{u // 60_000_000 % 60:02d}:{u // 1_000_000 % 60:02d}.{u // 1000 % 1000:03d}" for u in micros.to_pylist()]
        return pa.array(clock, pa.string())
    if pa.types.is_date(have) and logical == "time":
        return pc.if_else(c.is_valid(), pa.scalar("00:00:00.000"), pa.scalar(None, pa.string()))
    if pa.types.is_struct(have) and pa.types.is_struct(want):
        known = {f.name for f in have}
        parts = [_as(pc.struct_field(c, f.name), f.type) if f.name in known else pa.nulls(len(c), f.type) for f in want]
        return pa.StructArray.from_arrays(parts, fields=list(want), mask=c.is_null())
    if (pa.types.is_list(have) or pa.types.is_large_list(have)) and pa.types.is_list(want) or pa.types.is_map(have) and pa.types.is_map(want):
        # lengths of the lists give offsets that start at 0, whatever part of a larger array this is
        parts = pc.list_flatten(c) if not pa.types.is_map(have) else None
        sizes = [0 if x is None else len(x) for x in c.to_pylist()] if parts is None else pc.fill_null(pc.list_value_length(c), 0).to_pylist()
        offsets = pa.array(accumulate(sizes, initial=0), pa.int32())
        if parts is not None:
            return pa.ListArray.from_arrays(offsets, _as(parts, want.value_type), type=want, mask=c.is_null())
        entries = [e for x in c.to_pylist() if x is not None for e in x]
        keys, items = _as(pa.array([k for k, _ in entries], have.key_type), want.key_type), _as(pa.array([v for _, v in entries], have.item_type), want.item_type)
        return pa.MapArray.from_arrays(offsets, keys, items, type=want, mask=c.is_null())
    exact = not pa.types.is_unsigned_integer(have) and not (pa.types.is_integer(have) and pa.types.is_floating(want))
    return c.cast(want, safe=exact)


def _column(table: pa.Table, name: str, want: pa.DataType, logical: str | None = None) -> pa.Array:
    i = table.schema.get_field_index(name)
    if i < 0:
        i = next((j for j, n in enumerate(table.schema.names) if n.lower() == name.lower()), -1)
    if i < 0:
        return pa.nulls(table.num_rows, want)
    return _as(pa.concat_arrays(table.column(i).chunks), want, logical)


def read(df: DataFrame, payload: str, schema: T.StructType | None = None, keep: dict[str, str] | None = None, row: str | None = None) -> DataFrame:
    """Rows of all payloads, columns by name under ``schema`` (absent ones null); without one, under the join of the schemas
    of all payloads. Null and empty payloads have no rows; malformed ones raise.

    ``keep`` (column of ``df`` -> its name in the result) repeats a payload's own columns on its rows; ``row`` names a column of
    their places in the payload. Both come last."""
    if schema is None:
        found = schemas_of(df, payload)
        if not found:
            raise ValueError("No valid schemas found in records")
        schema = joined(found)
    ship(df.sparkSession)
    names = [(f.name, a.type, (f.metadata or {}).get("logical")) for f, a in zip(schema.fields, to_arrow_schema(schema), strict=True)]
    kept = [F.col(idents.column(c)).alias(n) for c, n in (keep or {}).items()]
    source = df.select(F.col(idents.column(payload)).cast("binary").alias("p"), *kept)
    more = [T.StructField(f.name, f.dataType) for f in source.schema.fields[1:]] + ([T.StructField(row, T.LongType())] if row else [])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for i, value in enumerate(batch.column(0).to_pylist()):
                table = decode(value)
                if table is not None and table.num_rows:
                    cols = [_column(table, n, t, logical) for n, t, logical in names]
                    cols += [pa.repeat(c[i], table.num_rows) for c in batch.columns[1:]]
                    cols += [pa.array(range(table.num_rows), pa.int64())] if row else []
                    yield pa.RecordBatch.from_arrays(cols, names=[n for n, _, _ in names] + [f.name for f in more])

    out = source.mapInArrow(run, T.StructType([*schema.fields, *more]))
    return out.select(*[F.col(idents.column(f.name)).alias(f.name, metadata=f.metadata or {}) for f in [*schema.fields, *more]])


def pack(df: DataFrame, rows: int = 1000, batch_rows: int | None = None) -> DataFrame:
    """The rows as IPC payloads of at most ``rows`` rows each, in record batches of at most ``batch_rows`` (one batch if None): one
    binary column ``payload``."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            parts = []
            for i in range(0, batch.num_rows, rows):
                part = batch.slice(i, rows)
                parts.append(encode(part if batch_rows is None else pa.Table.from_batches([part.slice(j, batch_rows) for j in range(0, part.num_rows, batch_rows)])))
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], names=["payload"])

    ship(df.sparkSession)
    return df.mapInArrow(run, "payload binary")


def is_payload(c: str) -> F.Column:
    """Whether a binary value is an Arrow stream: it begins with the continuation marker and a length, or an old-style
    length. JSON and text values never do."""
    return F.coalesce(F.hex(F.substring(F.col(idents.column(c)).cast("binary"), 1, 4)) == "FFFFFFFF", F.lit(False))


def split_formats(df: DataFrame, value: str) -> tuple[DataFrame, DataFrame]:
    """(records whose value is a batch, the others); both kinds of a mixed group are processed, none is dropped."""
    hit = is_payload(value)
    return df.where(hit), df.where(~hit)
