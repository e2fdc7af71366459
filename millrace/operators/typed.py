"""Records that came with a schema of their own: decoded under the join of all their schemas, nothing is inferred."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import types as mt
from millrace.functions import idents
from millrace.operators import infer
from millrace.operators.unify import unify_schemas
from millrace.session import registry_rows


def schemas_of(df: DataFrame, schema: str) -> list[T.StructType]:
    """The distinct schemas of a column of Connect schemas (JSON text); layout, key order and text that is no schema of a struct
    don't count. As many rows as there are distinct schemas reach the driver, refused beyond the registry limit."""
    texts = df.select(F.to_json(F.try_parse_json(F.col(idents.column(schema)))).alias("s")).where("s is not null").distinct()
    out = []
    for r in registry_rows(texts):
        d = json.loads(r.s)
        if isinstance(d, dict) and d.get("type") == "struct":
            s = mt.connect_schema(d)
            if s not in out:
                out.append(s)
    return sorted(out, key=lambda s: s.json())


def decode(df: DataFrame, schema: str, value: str, keep: list[str] | None = None) -> DataFrame:
    """Typed columns of the records that have a schema, by name; fields a record lacks are null, as are null records. Times
    and dates are read from numbers (milliseconds, days) or ISO text, bytes from base64. Schemas that don't join raise. Records
    without a schema have no row here: they are for :mod:`millrace.operators.infer`."""
    found = schemas_of(df, schema)
    if not found:
        raise ValueError("No valid schemas found in records")
    return infer.parse(df.where(F.col(idents.column(schema)).isNotNull()), value, unify_schemas(found), keep)
