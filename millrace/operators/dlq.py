"""Records that can't be reconciled with a table's schema go to a dead-letter table, with the reason; the rest goes on.

One pass: every field of a record is read from its JSON and cast, without raising, to the wanted type: the stored type if
the table has the column, else the type of the first record by offset that has the field.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import types as mt
from millrace.functions import clock
from millrace.functions.jsonx import describe
from millrace.operators import infer
from millrace.operators.evolve import IncompatibleType, decide
from millrace.operators.unify import SchemaConflict
from millrace.session import registry_rows, ship


def is_conflict(error: BaseException) -> bool:
    """Whether an error, or one it was raised from, is about schemas that don't agree."""
    seen = set()
    e: BaseException | None = error
    while e is not None and id(e) not in seen:
        if isinstance(e, (SchemaConflict, IncompatibleType)):
            return True
        seen.add(id(e))
        e = e.__cause__ or e.__context__
    return False


def fits(value: object, t: T.DataType, logical: str | None = None) -> bool:
    """Whether a JSON value can be stored as a type without loss of meaning; nulls fit everything."""
    if value is None:
        return True
    if logical == "json":
        return isinstance(value, (dict, list))
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        bits = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}[t.simpleString()]
        return isinstance(value, (int, bool)) and -(1 << bits - 1) <= value < 1 << bits - 1
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return isinstance(value, (int, float))
    if isinstance(t, T.BooleanType):
        return isinstance(value, bool)
    if isinstance(t, (T.TimestampNTZType, T.TimestampType)):
        return isinstance(value, str) and clock.iso_micros(value) is not None or isinstance(value, int) and not isinstance(value, bool)
    if isinstance(t, T.DateType):
        return isinstance(value, str) and (m := clock.DATE.fullmatch(value)) is not None and clock.days(int(m[1]), int(m[2]), int(m[3])) is not None
    if isinstance(t, T.StructType):
        return isinstance(value, dict) and all(fits(value.get(f.name), f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return isinstance(value, list) and all(fits(v, t.elementType) for v in value)
    if isinstance(t, T.MapType):
        return isinstance(value, dict) and all(fits(v, t.valueType) for v in value.values())
    return isinstance(value, str)


def first_types(df: DataFrame, value: str, order: list[str], conflicts: set[str]) -> dict[str, T.DataType]:
    """Type of each conflicting field as the first record by ``order`` that has it shows it. Records equal in all of ``order`` are
    one place; of several there any counts."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first: dict[str, tuple[tuple, str]] = {}
        for pdf in it:
            for text, *at in zip(pdf["v"], *[pdf[f"o{i}"] for i in range(len(order))], strict=True):
                try:
                    record = json.loads(text) if text is not None else None
                except (ValueError, RecursionError):
                    continue
                if isinstance(record, dict):
                    for k in conflicts:
                        tree = infer.observe(record.get(k), k)
                        if tree is not None and (k not in first or tuple(at) < first[k][0]):
                            first[k] = (tuple(at), json.dumps(tree))
        yield pd.DataFrame([(k, [int(x) for x in a], t) for k, (a, t) in first.items()], columns=["k", "o", "tree"])

    ship(df.sparkSession)
    kinds = dict(df.dtypes)
    at = [(F.unix_micros(F.col(c)) if kinds[c] == "timestamp" else F.col(c).cast("long")) for c in order]
    rows = df.select(F.col(value).alias("v"), *[F.coalesce(c, F.lit(-1)).alias(f"o{i}") for i, c in enumerate(at)]).mapInPandas(run, "k string, o array<long>, tree string")
    best = rows.groupBy("k").agg(F.min_by("tree", "o").alias("tree"))
    return {r.k: infer.resolve(json.loads(r.tree), r.k, strict=False) for r in registry_rows(best)}


def wanted(df: DataFrame, value: str, order: str | list[str], stored: T.StructType | None) -> T.StructType:
    """The schema a batch is to have: fields that agree by the lattice, conflicting ones by the table or the first record."""
    tree = infer.schema_tree(df, value)
    if tree is None:
        raise ValueError("No valid schemas found in records")
    by = {f.name.lower(): f for f in stored.fields} if stored is not None else {}
    agreed, conflicts = {}, set()
    for name, t in tree["s"].items():
        try:
            agreed[name] = infer.resolve(t, name)
        except SchemaConflict:
            conflicts.add(name)
    firsts = first_types(df, value, [order] if isinstance(order, str) else order, conflicts) if conflicts else {}
    fields = []
    for name in sorted([*agreed, *conflicts]):
        t = agreed.get(name) or firsts.get(name, T.StringType())
        have = by.get(name.lower())
        if have is not None and have.name.lower() != mt.SYSTEM_COLUMN:
            nested = isinstance(t, (T.StructType, T.ArrayType, T.MapType))
            kind = "json" if nested else mt.kind(T.StructField(name, t))
            if name in conflicts or decide(mt.kind(have), kind) == "reject":
                fields.append(have)
                continue
        if t is not None:
            fields.append(T.StructField(name, t))
    return mt.prune_empty(T.StructType(fields))


def split(df: DataFrame, value: str, schema: T.StructType, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): records whose fields all fit the schema, with the columns ``keep`` and the value; and the others with
    ``error``. Both come from :func:`checked`; to use both, persist that and take its parts."""
    all_ = checked(df, value, schema, keep)
    return all_.where("error is null").drop("error"), all_.where("error is not null")


def checked(df: DataFrame, value: str, schema: T.StructType, keep: list[str]) -> DataFrame:
    """The columns ``keep``, the value, and ``error``, which names field, type and value of what doesn't fit, else is null. Null
    values fit (rows of nulls), malformed JSON and values that aren't objects don't."""
    fields = [(f.name, f.dataType, (f.metadata or {}).get("logical")) for f in schema.fields]

    def verdict(text: str | None) -> str | None:
        if text is None:
            return None
        try:
            record = json.loads(text)
        except (ValueError, RecursionError) as e:
            return f"malformed JSON: {describe(str(e))}"
        if not isinstance(record, dict):
            return f"not an object: {describe(text)}"
        for name, t, logical in fields:
            if not fits(record.get(name), t, logical):
                return f"field {name}: {describe(record.get(name))} is not {logical or t.simpleString()}"
        return None

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pdf.assign(error=pd.Series([verdict(v) for v in pdf[value]], dtype="object", index=pdf.index))

    ship(df.sparkSession)
    src = df.select(*[c for c in keep if c != value], value)
    return src.mapInPandas(run, T.StructType([*src.schema.fields, T.StructField("error", T.StringType())]))


def counts(marked: DataFrame, value: str) -> tuple[int, int, int]:
    """(records, bad records, bytes) of what :func:`checked` gave, in one pass."""
    r = marked.agg(F.count(F.lit(1)).alias("n"), F.count("error").alias("bad"), F.coalesce(F.sum(F.octet_length(value)), F.lit(0)).alias("size")).first()
    return r.n, r.bad, r.size


def offsets_sample(bad: DataFrame, most: int = 10) -> str:
    """The first offsets of bad records, as topic:partition@offset, for an error message."""
    rows = bad.orderBy("topic", "partition", "offset").select("topic", "partition", "offset").limit(most + 1).collect()
    text = ", ".join(f"{r[0]}:{r[1]}@{r[2]}" for r in rows[:most])
    return f"[{text}]" + (" (truncated)" if len(rows) > most else "")
