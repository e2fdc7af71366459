"""Rows that fail to parse: readable rows with typed values, the others with the reason and its offset.

Delimited records run through a quote-aware finite-state tokenizer (see :mod:`millrace.functions.fsm`): chunks get their
transition functions, these are composed, and the fields are cut where the known state says so. JSON records run through a
string-aware machine first and are then read by an RFC 8259 parser.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import clock, fsm, idents
from millrace.functions import timestamps as ts
from millrace.session import registry_rows, ship

_BITS = {"int8": 8, "int16": 16, "int32": 32, "int64": 64}
_INT = re.compile(r"[+-]?[0-9]+")
_FLOAT = re.compile(r"[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?")
_CSV_ERRORS = {4: "quote inside a field", 5: "text after a closing quote", 6: "line break outside quotes"}


def _real_date(text: str) -> bool:
    m = clock.DATE.fullmatch(text)
    return m is not None and clock.days(int(m[1]), int(m[2]), int(m[3])) is not None


def _in_range(value: int, kind: str) -> bool:
    top = 1 << (_BITS[kind] - 1)
    return -top <= value < top


def csv_value_ok(text: str, kind: str) -> bool:
    """Whether a non-empty field is of its type; blanks around don't count unless it is a string."""
    if kind in ("string", "bytes"):
        return True
    t = text.strip(" \t")
    if kind in _BITS:
        return _INT.fullmatch(t) is not None and len(t) < 400 and _in_range(int(t), kind)
    if kind in ("float32", "float64"):
        return _FLOAT.fullmatch(t) is not None and math.isfinite(float(t))
    if kind == "boolean":
        return t.lower() in ("true", "false")
    if kind == "date":
        return _real_date(t)
    if kind == "timestamp":
        return clock.iso_micros(t) is not None
    return True


def json_value_ok(value: object, kind: str) -> bool:
    if kind in _BITS:
        return isinstance(value, int) and not isinstance(value, bool) and _in_range(value, kind)
    if kind in ("float32", "float64"):
        return isinstance(value, (int, float)) and not isinstance(value, bool) and (isinstance(value, int) or math.isfinite(value))
    if kind == "boolean":
        return isinstance(value, bool)
    if kind == "date":
        return isinstance(value, str) and _real_date(value)
    if kind == "timestamp":
        return isinstance(value, str) and clock.iso_micros(value) is not None
    if kind == "array":
        return isinstance(value, list)
    if kind in ("struct", "map"):
        return isinstance(value, dict)
    return isinstance(value, str)


def _no_constant(name: str) -> None:
    raise ValueError(name)


def _whole_number(digits: str) -> int | float:
    return int(digits) if len(digits) < 400 else math.inf


def _json_text(value: object) -> str | None:
    return None if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


#: field: (name, type, optional), in order of position
Field = tuple[str, str, bool]


def check_csv(texts: list[str], delimiter: str, fields: list[Field]) -> list[tuple[str | None, int | None, str | None, dict | None]]:
    """(reason, offset, detail, values) per text; reason is None for readable rows. Offsets are bytes of the UTF-8 text."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    tokens = fsm.tokenize(fsm.csv_machine(delimiter), data)
    out = []
    for i, raw in enumerate(data):
        state, at = int(tokens.end_state[i]), int(tokens.error_at[i])
        if state in _CSV_ERRORS:
            out.append(("quoting", at, _CSV_ERRORS[state], None))
            continue
        if state == 2:
            out.append(("quoting", len(raw), "quote not closed", None))
            continue
        ends = [*map(int, tokens.cuts[tokens.first_cut[i] : tokens.first_cut[i + 1]]), len(raw)]
        if not raw or len(ends) != len(fields):
            out.append(("columns", len(raw), f"{len(ends) if raw else 0} fields, {len(fields)} registered", None))
            continue
        begin, values, bad = 0, {}, None
        for (name, kind, optional), end in zip(fields, ends, strict=True):
            text = raw[begin:end].decode("utf-8", "surrogatepass")
            if text[:1] == '"':
                text = text[1:-1].replace('""', '"')
            blank = text == "" or (kind != "string" and text.strip(" \t") == "")
            if blank and not optional:
                bad = (begin, f"{name}: required value is empty")
            elif not blank and not csv_value_ok(text, kind):
                bad = (begin, f"{name}: not of type {kind}")
            if bad:
                break
            values[name] = None if blank else text if kind == "string" else text.strip(" \t")
            begin = end + 1
        out.append(("value", *bad, None) if bad else (None, None, None, values))
    return out


def check_json(texts: list[str], fields: list[Field]) -> list[tuple[str | None, int | None, str | None, dict | None]]:
    """As :func:`check_csv`, for texts that should be one JSON object. Of repeated keys the last counts."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    tokens = fsm.tokenize(fsm.json_machine(), data)
    known = {name for name, _, _ in fields}
    out = []
    for i, text in enumerate(texts):
        state = int(tokens.end_state[i])
        if state:
            out.append(("quoting", int(tokens.error_at[i]) if state == 3 else len(data[i]), "control character in a string" if state == 3 else "string not closed", None))
            continue
        try:
            value = json.loads(text, parse_constant=_no_constant, parse_int=_whole_number)
        except json.JSONDecodeError as e:
            out.append(("quoting", len(text[: e.pos].encode("utf-8", "surrogatepass")), e.msg, None))
            continue
        except (ValueError, RecursionError) as e:
            out.append(("quoting", 0, str(e)[:100], None))
            continue
        if not isinstance(value, dict):
            out.append(("quoting", 0, "not an object", None))
            continue
        extra = [k for k in value if k not in known]
        missing = [n for n, _, optional in fields if not optional and n not in value]
        if extra or missing:
            out.append(("columns", 0, f"not registered: {extra[0]}" if extra else f"missing: {missing[0]}", None))
            continue
        bad = None
        for name, kind, optional in fields:
            v = value.get(name)
            if v is None or v == "":
                if not optional:
                    bad = f"{name}: required value is empty or null"
                elif v == "" and kind != "string":
                    bad = f"{name}: not of type {kind}"
            elif not json_value_ok(v, kind):
                bad = f"{name}: not of type {kind}"
            if bad:
                break
        out.append(("value", 0, bad, None) if bad else (None, None, None, {n: _json_text(value.get(n)) for n, _, _ in fields}))
    return out


def registry(topics: DataFrame, fields: DataFrame) -> dict[str, tuple[str, str, list[Field]]]:
    """topic -> (format, delimiter, fields), of the topics that have a text format."""
    by: dict[str, list] = {}
    for r in registry_rows(fields.select("topic", "field_pos", "field_path", "field_type", "is_optional")):
        if r.topic is not None and r.field_path is not None:
            by.setdefault(r.topic, []).append((r.field_pos or 0, r.field_path, r.field_type or "string", r.is_optional is not False))
    out = {}
    for r in registry_rows(topics.select("topic", "value_format", "delimiter")):
        if r.value_format in ("csv", "json") and r.topic is not None:
            delimiter = r.delimiter or ","
            if r.value_format == "csv" and (len(delimiter) != 1 or delimiter in '"\r\n' or ord(delimiter) > 0x7F):
                raise ValueError(f"delimiter of topic {r.topic} must be one ASCII character that is no quote or line break, not {delimiter!r}")
            out[r.topic] = (r.value_format, delimiter, [f[1:] for f in sorted(by.get(r.topic, []))])
    return out


_OUT = "line_id long, topic string, reason string, error_offset long, detail string, fields map<string,string>"


def split(records: DataFrame, topics: DataFrame, fields: DataFrame, key: str = "line_id", topic: str = "topic", value: str = "record_value") -> DataFrame:
    """One row per record of a csv or json topic: line_id, topic, reason (null: readable), error_offset, detail, fields.

    ``fields`` holds the typed-checked values as text (null for empty ones); :func:`typed` casts them. A null text has no
    fields: ``columns`` for csv, ``quoting`` for json. Records of topics without a registered text format are ``columns``.
    Very long texts, repeated rows and other columns of any name are fine; an empty input gives an empty result."""
    ship(records.sparkSession)
    known = registry(topics, fields)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            result: list = [None] * len(pdf)
            ids, names, values = pdf["k"].tolist(), pdf["t"].tolist(), pdf["v"].tolist()
            by: dict = {}
            for i, (t, v) in enumerate(zip(names, values, strict=True)):
                if t not in known:
                    result[i] = ("columns", 0, "topic is not registered", None)
                elif v is None:
                    result[i] = ("columns" if known[t][0] == "csv" else "quoting", 0, "null", None)
                else:
                    by.setdefault(t, []).append(i)
            for t, at in by.items():
                kind, delimiter, fs = known[t]
                texts = [values[i] for i in at]
                for i, r in zip(at, check_csv(texts, delimiter, fs) if kind == "csv" else check_json(texts, fs), strict=True):
                    result[i] = r
            yield pd.DataFrame({"line_id": pd.array(ids, dtype="Int64"), "topic": names, "reason": [r[0] for r in result], "error_offset": pd.array([r[1] for r in result], dtype="Int64"), "detail": [r[2] for r in result], "fields": [r[3] for r in result]})

    src = records.selectExpr(f"cast(`{key}` as bigint) as k", f"`{topic}` as t", f"`{value}` as v")
    return src.mapInPandas(run, _OUT)


_CAST = {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "float32": "float", "float64": "double", "boolean": "boolean", "date": "date", "bytes": "binary"}


def typed(rows: DataFrame, topic: str, fields: list[Field]) -> DataFrame:
    """Readable rows of one topic with one typed column per field; timestamps without zone, in UTC."""
    good = rows.where((F.col("topic") == topic) & F.col("reason").isNull())
    text = lambda n: F.element_at("fields", F.lit(n))
    cells = [(ts.from_micros(ts.epoch_micros(text(n))) if k == "timestamp" else text(n).try_cast(_CAST.get(k, "string"))).alias(n) for n, k, _ in fields]
    return good.select("line_id", *cells)


def profile(rows: DataFrame, known: dict[str, tuple[str, str, list[Field]]]) -> DataFrame:
    """Of the typed tables of all topics: topic, field_path, n_values, and the least and greatest value as text (timestamps as
    microseconds, none of floats). ``rows`` is read once per topic: cut it first."""
    out = None
    for topic, (_, _, fields) in sorted(known.items()):
        table = typed(rows, topic, fields)
        cells = []
        for n, k, _ in fields:
            c = F.col(idents.column(n))
            c = ts.micros(c) if k == "timestamp" else F.lit(None) if k.startswith("float") else c
            cells.append(F.struct(F.lit(topic).alias("topic"), F.lit(n).alias("field_path"), F.count(idents.column(n)).alias("n_values"), F.min(c).cast("string").alias("low"), F.max(c).cast("string").alias("high")))
        one = table.agg(F.array(*cells).alias("c")).select(F.explode("c").alias("c")).select("c.*")
        out = one if out is None else out.unionByName(one)
    return out


def found(records: DataFrame, topics: DataFrame, fields: DataFrame) -> DataFrame:
    """Records that fail: line_id, reason."""
    return split(records, topics, fields).where("reason is not null").select("line_id", "reason")
