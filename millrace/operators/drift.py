"""Schemas that drift between files.

Every record becomes a map of path to raw type: from its schema where it came with one, else from what its JSON shows.
Path-type counts are aggregated per batch (map-side first), compared with the registered fields, and every difference is
reported. Values with a schema and without one look different (times as numbers, as text) and are compared apart. A
registered field that is gone and a new one beside it (same parent, same type) are one renamed field if the
values and the names agree and the new name isn't one that also turns up in batches from which nothing is gone.
:func:`project` then reads all batches into one typed table per topic, renames undone, failed casts counted.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import clock
from millrace.functions import timestamps as ts
from millrace.session import cut, registry_rows, ship

_ID_LIKE = re.compile(r"(id|key)$")
_LOGICAL = {"Timestamp": "timestamp", "Date": "date", "Time": "time"}
#: Raw types as JSON shows them.
_JSON_CLASS = {"int8": "int", "int16": "int", "int32": "int", "int64": "int", "float32": "float", "float64": "float", "struct": "object", "map": "object", "date": "string", "time": "string", "bytes": "string"}
FACTS = "batch_id long, topic string, origin string, parent string, name string, kind string, feature string, n long"


def fields_of(fields: DataFrame) -> dict[str, dict[str, tuple[str, str]]]:
    """topic -> lower-case path -> (path as registered, type)."""
    out: dict[str, dict[str, tuple[str, str]]] = {}
    for r in registry_rows(fields.select("topic", "field_path", "field_type")):
        if r.topic is not None and r.field_path:
            out.setdefault(r.topic, {})[r.field_path.lower()] = (r.field_path, (r.field_type or "string").lower())
    return out


def json_kind(value: object, name: str) -> str:
    """Raw type of a JSON value; ISO date-times are timestamps unless the field's name is like an id's."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, str):
        return "timestamp" if "T" in value and not _ID_LIKE.search(name) and clock.iso_micros(value) is not None else "string"
    return "array" if isinstance(value, list) else "object"


_WORD, _DIGITS, _RUN, _MIXED = re.compile(r"[^\W\d_]+"), re.compile(r"\d"), re.compile(r"9+"), re.compile(r"(?:a9|9a)[a9]*")
#: Shapes are counted in so many places of a sketch; each is hashed whole, so that none is left out.
PLACES = 1024
#: Signs of a shape that are hashed together.
BLOCK = 8


@lru_cache(maxsize=1 << 16)
def _place(shape: str) -> str:
    return str(zlib.crc32(shape.encode("utf-8", "surrogatepass")) % PLACES)


@lru_cache(maxsize=1 << 16)
def _shape_places(shape: str, bits: int) -> tuple[str, ...]:
    blocks = {f"s{shape[:BLOCK]}:{bits}"} | {f"+{shape[i : i + BLOCK]}" for i in range(BLOCK, len(shape), BLOCK)}
    return tuple(sorted({_place(b) for b in blocks}))


def _text_places(text: str) -> tuple[str, ...]:
    shape = _RUN.sub("9", _WORD.sub("a", _DIGITS.sub("9", text)))
    return _shape_places(_MIXED.sub("x", shape), len(text).bit_length())


_short_text_places = lru_cache(maxsize=1 << 16)(_text_places)


def features(value: object) -> tuple[str, ...]:
    """The shape of a whole value, as places of the sketch: a text's runs of letters, digits and other signs in blocks, the first
    with its length; a number's magnitude; every element of a list; an object's keys, and its kinds of values, as the keys of a map
    say little. Fields of one meaning share their distribution of shapes."""
    if isinstance(value, str):
        return _short_text_places(value) if len(value) <= 64 else _text_places(value)
    if isinstance(value, bool):
        return (_place(f"b{value}"),)
    if isinstance(value, (int, float)):
        mag = 0 if value == 0 or value != value else math.floor(math.log2(abs(value))) if abs(value) < math.inf else 2000
        return (_place(f"n{mag // 2}"),)
    if isinstance(value, list):
        return tuple({_place("l")} | {_place("l" + f) for v in value for f in features(v)})
    if isinstance(value, dict):
        kinds = sorted({type(v).__name__ for v in value.values()})
        return (_place("o" + "\0".join(sorted(value))), _place("v" + ",".join(kinds)))
    return (_place("0"),)


def _schema_paths(schema: dict, registered: dict, prefix: str, out: list) -> None:
    for f in schema.get("fields") or []:
        if not isinstance(f, dict) or "field" not in f:
            continue
        name = str(f["field"])
        kind = str(f.get("type", "")).lower()
        logical = str(f.get("name") or "").rpartition(".")[2]
        out.append((prefix, name, _LOGICAL.get(logical, kind)))
        path = f"{prefix}{name}".lower()
        if kind == "struct" and registered.get(path, ("", ""))[1] == "struct":
            _schema_paths(f, registered, f"{path}.", out)


def _observe(registry: dict):
    """Facts of records, counted per Arrow batch: records by the text of their schema, fields of others by kind, values by shape."""

    def paths_of(topic: str, schema: str) -> list | None:
        found: list = []
        try:
            _schema_paths(json.loads(schema), registry[topic], "", found)
        except (ValueError, RecursionError, AttributeError):
            return None
        return found

    def named(topic: str, parent: str, name: str) -> tuple[str, str, bool, str | None]:
        """(name as counted, in lower case, whether it is registered, what precedes the paths below it if it is a struct)."""
        low = name.lower()
        known = registry[topic].get(parent + low)
        return (low, low, True, f"{parent}{low}." if known[1] == "struct" else None) if known else (name, low, False, None)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_paths: dict[tuple, list | None] = {}
        names: dict[tuple, dict[str, tuple]] = {}
        for batch in it:
            facts: Counter = Counter()
            schemas: Counter = Counter()
            kinds: dict[tuple, Counter] = {}
            shapes: dict[tuple, dict[str, dict]] = {}
            for number, topic, schema, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                registered = registry.get(topic)
                if registered is None or value is None:
                    continue
                try:
                    record = json.loads(value)
                except (ValueError, RecursionError):
                    record = None
                if not isinstance(record, dict):
                    facts[number, topic, "unreadable", "", "", "", ""] += 1
                    continue
                origin = "json"
                if schema is not None:
                    if (topic, schema) not in known_paths:
                        if len(known_paths) > 50_000:
                            known_paths.clear()
                        known_paths[topic, schema] = paths_of(topic, schema)
                    if known_paths[topic, schema] is not None:
                        origin = "schema"
                        schemas[number, topic, schema] += 1
                todo = [("", record)]
                for parent, obj in todo:
                    if origin == "json":
                        seen = kinds.get((number, topic, parent))
                        if seen is None:
                            seen = kinds[number, topic, parent] = Counter()
                    told = names.get((topic, parent))
                    if told is None or len(told) > 50_000:
                        told = names[topic, parent] = {}
                    of_known = shapes.setdefault((None, topic, parent, origin), {})
                    of_new = None
                    for name, v in obj.items():
                        place = told.get(name)
                        if place is None:
                            place = told[name] = named(topic, parent, name)
                        spelled, low, known, below = place
                        if origin == "json":
                            seen[spelled, json_kind(v, low)] += 1
                        if v is None:
                            continue
                        if known:
                            group = of_known
                        else:
                            if of_new is None:
                                of_new = shapes.setdefault((number, topic, parent, origin), {})
                            group = of_new
                        shape = group.get(spelled)
                        if shape is None:
                            shape = group[spelled] = {}
                        for f in features(v):
                            shape[f] = shape.get(f, 0) + 1
                        if below is not None and isinstance(v, dict):
                            todo.append((below, v))
            for (number, topic, schema), n in schemas.items():
                registered = registry[topic]
                for parent, name, kind in known_paths.get((topic, schema)) or paths_of(topic, schema) or ():
                    spelled = name.lower() if parent + name.lower() in registered else name
                    facts[number, topic, "schema", parent, spelled, kind, ""] += n
            for (number, topic, parent), seen in kinds.items():
                for (spelled, kind), n in seen.items():
                    facts[number, topic, "json", parent, spelled, kind, ""] += n
            for (number, topic, parent, origin), group in shapes.items():
                for spelled, shape in group.items():
                    for f, n in shape.items():
                        facts[number, topic, "value", parent, spelled, origin, f] += n
            rows = list(zip(*facts, strict=True)) or [()] * 7
            cols = [pa.array(rows[0], pa.int64()), *[pa.array(r, pa.string()) for r in rows[1:]], pa.array(list(facts.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in FACTS.split(", ")])

    return run


def observe(records: DataFrame, fields: DataFrame) -> DataFrame:
    """Path-type and path-shape counts, one row each, aggregated: of schemas and JSON objects per batch, of registered
    fields' values per topic. Rows with null record_value don't count, nor do topics without registered fields."""
    ship(records.sparkSession)
    src = records.select(F.col("batch_id").cast("long"), "topic", "value_schema", "record_value")
    raw = src.mapInArrow(_observe(fields_of(fields)), FACTS)
    keys = ["batch_id", "topic", "origin", "parent", "name", "kind", "feature"]
    return raw.groupBy(*keys).agg(F.sum("n").alias("n"))


def _bare(name: str) -> str:
    return re.sub(r"[^a-z0-9]", "", name.lower())


def name_similarity(a: str, b: str) -> float:
    """1 for names that differ in case and punctuation only; abbreviations and shared words score high."""
    x, y = _bare(a), _bare(b)
    if x == y:
        return 1.0
    if not x or not y:
        return 0.0
    short, long = sorted((x, y), key=len)
    it = iter(long)
    abbreviation = 0.85 if len(short) > 1 and short[0] == long[0] and all(c in it for c in short) else 0.0
    words = [set(re.findall(r"[a-z0-9]+", re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", n).lower())) for n in (a, b)]
    shared = 0.8 if words[0] & words[1] - {"at", "of", "no", "id"} else 0.0
    return max(abbreviation, shared, SequenceMatcher(None, x, y).ratio())


def cosine(a: dict, b: dict) -> float:
    dot = sum(v * b.get(k, 0) for k, v in a.items())
    return dot / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values())) if dot else 0.0


_DIFF = "batch_id long, topic string, parent string, name string, kind string, change string, profile map<string,long>"


def _groups(it: Iterator[pd.DataFrame], n_keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of sorted frames by their first columns, across frames; only one group is held at a time."""
    key, rows = None, []
    for pdf in it:
        for row in zip(*[pdf[c].tolist() for c in pdf.columns], strict=True):
            if row[:n_keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:n_keys], []
            rows.append(row[n_keys:])
    if rows:
        yield key, rows


def _diff(registry: dict):
    """Differences of each batch against its topic's registered fields, renames still as removed and added."""

    def one(batch: int, topic: str, facts: list[tuple]) -> Iterator[tuple]:
        registered = registry.get(topic, {})
        kinds: dict[tuple[str, str], dict[str, Counter]] = {}
        spellings: dict[tuple[str, str], Counter] = {}
        profiles: dict[tuple[str, str], dict[str, int]] = {}
        for origin, parent, name, kind, feat, n in facts:
            at = (parent, name.lower())
            if origin == "value":
                shape = profiles.setdefault(at, {})
                shape[feat] = shape.get(feat, 0) + int(n)
            elif origin in ("schema", "json"):
                kinds.setdefault(at, {}).setdefault(origin, Counter())[kind] += n
                spellings.setdefault(at, Counter())[name] += n
        listed: set[str] = set()
        if not kinds:
            return

        def below(path: str) -> bool:
            return any(path.startswith(p + ".") for p in listed)

        for path in sorted(registered, key=lambda p: (p.count("."), p)):
            if below(path):
                continue
            parent, _, name = path.rpartition(".")
            parent = f"{parent}." if parent else ""
            want = registered[path][1]
            got = kinds.get((parent, name))
            if got is None:
                listed.add(path)
                yield batch, topic, parent, name, want, "removed", None
            elif _retyped(got, want, name):
                listed.add(path)
                yield batch, topic, parent, name, want, "retyped", None
        for (parent, name), got in kinds.items():
            path = parent + name
            if path not in registered and not below(path):
                all_kinds = Counter({k: n for c in got.values() for k, n in c.items() if k != "null"})
                kind = ("=" if "schema" in got else "~") + (all_kinds.most_common(1)[0][0] if all_kinds else "null")
                spelled = min(spellings[parent, name].items(), key=lambda x: (-x[1], x[0]))[0]
                yield batch, topic, parent, spelled, kind, "added", profiles.get((parent, name), {})

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _DIFF.split(", ")]
        out: list[tuple] = []
        for (batch, topic), facts in _groups(it, 2):
            out += one(batch, topic, facts)
            if len(out) > 5000:
                yield pd.DataFrame(out, columns=names)
                out = []
        yield pd.DataFrame(out, columns=names)

    return run


def _retyped(got: dict[str, Counter], want: str, name: str) -> bool:
    """Whether the types a batch shows for a registered field aren't its own."""
    if "schema" in got and set(got["schema"]) != {want}:
        return True
    if "json" not in got:
        return False
    seen = {k for k in got["json"] if k != "null"}
    expected = _JSON_CLASS.get(want, want)
    if expected == "float" and "float" in seen:
        seen.discard("int")
    if expected == "string" and (("string" in seen and seen <= {"string", "timestamp"}) or (_ID_LIKE.search(name) and seen == {"timestamp"})):
        seen = {"string"}
    return bool(seen) and seen != {expected}


def compatible(kind: str, registered: str) -> bool:
    """Whether an added field's type (``=`` from a schema, ``~`` as JSON shows) can be the registered one."""
    sign, k = kind[:1], kind[1:]
    if sign == "=":
        return k == registered
    if k == "null":
        return True
    want = _JSON_CLASS.get(registered, registered)
    return k == want or (want == "float" and k == "int") or (want == "string" and k == "timestamp")


#: What a pair's score loses if its new name always comes with nothing gone beside it, in its topic and parent; of a part of its
#: batches, that part. Names as alike as NAMES_ALIKE lose nothing.
FREE_COST, NAMES_ALIKE = 0.4, 0.8
LEAST_SCORE = 0.45


def _pair(baseline: dict, registry: dict, least: float):
    """Pairs gone and new fields of each batch, best score first; every field takes part in one pair at most."""

    def one(topic: str, rows: list[tuple]) -> Iterator[tuple]:
        removed = [r for r in rows if r[3] == "removed"]
        scored = []
        for parent, name, kind, change, profile, free in rows:
            if change != "added":
                continue
            profile = dict(profile) if profile is not None else {}
            for r_parent, r_name, r_kind, *_ in removed:
                if r_parent != parent or not compatible(kind, r_kind):
                    continue
                names = name_similarity(name, r_name)
                paths = [(topic, r_parent + r_name, o) for o in (("schema", "json") if kind[:1] == "=" else ("json", "schema"))]
                base = baseline.get(paths[0]) or baseline.get(paths[1], {})
                shapes = cosine(profile, base) if profile and base else 0.5
                score = 0.45 * names + 0.55 * shapes - (FREE_COST * free if names < NAMES_ALIKE and free == free else 0.0)
                if score >= least:
                    scored.append((score, name, r_name, parent))
        renamed, taken = {}, set()
        for _, new, old, parent in sorted(scored, key=lambda x: (-x[0], x[1:])):
            if (parent, new) not in taken and (parent, old) not in renamed:
                renamed[parent, old] = new
                taken.add((parent, new))
        registered = registry.get(topic, {})
        for parent, name, _, change, *_ in rows:
            known = registered.get(parent + name)
            if change == "added" and (parent, name) in taken:
                continue
            if change == "removed" and (parent, name) in renamed:
                yield known[0], "renamed", parent + renamed[parent, name]
            else:
                yield known[0] if known else _as_registered(parent + name, registered), change, None

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for (batch, topic), rows in _groups(it, 2):
            out += ((batch, topic, *r) for r in one(topic, rows))
            if len(out) > 5000:
                yield pd.DataFrame(out, columns=["batch_id", "topic", "field_path", "change", "new_path"])
                out = []
        yield pd.DataFrame(out, columns=["batch_id", "topic", "field_path", "change", "new_path"])

    return run


def _as_registered(path: str, registered: dict) -> str:
    """The parent of a new path as it is registered; its own name as it came."""
    parent, _, name = path.rpartition(".")
    return f"{registered[parent][0]}.{name}" if parent in registered else path


def report(records: DataFrame, fields: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """Every change per batch: batch_id, topic, field_path, change (added, removed, renamed, retyped), new_path (renamed).

    Names are compared without case; a new name comes out as most often spelled, below the registered parent's spelling. Unreadable
    record values don't count, a batch of null values only has no changes, an empty input gives an empty report. Columns
    other than batch_id, topic, value_schema and record_value are not read."""
    registry = fields_of(fields)
    facts = observe(records, fields)
    facts = cut(facts)  # the Python pass over all records is not repeated
    baseline: dict = {}
    shapes = facts.where((F.col("origin") == "value") & F.col("batch_id").isNull())
    sketch = shapes.groupBy("topic", "parent", "name", "kind").agg(F.collect_list(F.struct("n", "feature")).alias("places"))
    for r in registry_rows(sketch):  # bounded by the registered fields, each of PLACES entries at most
        baseline[r.topic, r.parent + r.name, r.kind] = {x.feature: int(x.n) for x in r.places}
    batches = facts.where(F.col("batch_id").isNotNull()).select("batch_id", "topic", "origin", "parent", "name", "kind", "feature", "n")
    diffs = cut(batches.repartition("batch_id", "topic").sortWithinPartitions("batch_id", "topic").mapInPandas(_diff(registry), _DIFF))
    gone = diffs.where("change = 'removed'").select("batch_id", "topic", "parent").distinct().withColumn("gone", F.lit(True))
    added = diffs.where("change = 'added'").join(gone, ["batch_id", "topic", "parent"], "left")
    free = added.groupBy("topic", "parent", F.lower("name").alias("low")).agg(F.avg(F.when(F.col("gone").isNull(), 1.0).otherwise(0.0)).alias("free_share"))
    both = diffs.where("change = 'added'").join(gone.drop("gone"), ["batch_id", "topic", "parent"], "left_semi").select("batch_id", "topic").distinct()
    open_ = diffs.join(both, ["batch_id", "topic"], "left_semi").withColumn("low", F.lower("name")).join(free, ["topic", "parent", "low"], "left").drop("low")
    settled = diffs.join(both, ["batch_id", "topic"], "left_anti")
    out = "batch_id long, topic string, field_path string, change string, new_path string"
    open_ = open_.select("batch_id", "topic", "parent", "name", "kind", "change", "profile", "free_share")
    paired = open_.repartition("batch_id", "topic").sortWithinPartitions("batch_id", "topic").mapInPandas(_pair(baseline, registry, least), out)

    def plain(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            paths = []
            for topic, parent, name in zip(pdf["topic"], pdf["parent"], pdf["name"], strict=True):
                known = registry.get(topic, {}).get(parent + name)
                paths.append(known[0] if known else _as_registered(parent + name, registry.get(topic, {})))
            yield pd.DataFrame({"batch_id": pdf["batch_id"], "topic": pdf["topic"], "field_path": paths, "change": pdf["change"], "new_path": None})

    return paired.unionByName(settled.mapInPandas(plain, out))


def found(records: DataFrame, fields: DataFrame) -> DataFrame:
    return report(records, fields).select("batch_id", "field_path", "change")


_SQL_TYPE = {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "float32": "float", "float64": "double", "boolean": "boolean", "timestamp": "timestamp", "date": "date"}


def _steps(path: str) -> str:
    return "$" + "".join("['" + p.replace("'", "\\'") + "']" for p in path.split("."))


def _renames(changes: DataFrame) -> DataFrame:
    """(batch_id, topic, renames): lower-case registered path -> new path, of each batch that has any."""
    pairs = changes.where(F.col("change") == "renamed").select("batch_id", "topic", F.struct(F.lower("field_path").alias("old"), F.col("new_path").alias("new")).alias("r"))
    return pairs.groupBy("batch_id", "topic").agg(F.map_from_entries(F.collect_set("r")).alias("renames"))


def _new_names(changes: DataFrame) -> dict[str, dict[str, set[str]]]:
    """topic -> registered path -> new paths it was found under; distinct names, not batches."""
    out: dict[str, dict[str, set[str]]] = {}
    for r in registry_rows(changes.where(F.col("change") == "renamed").select("topic", F.lower("field_path").alias("old"), F.col("new_path").alias("new")).distinct()):
        out.setdefault(r.topic, {}).setdefault(r.old, set()).add(r.new)
    return out


def _cells(registered: dict, new_names: dict[str, set[str]]) -> Iterator[tuple[str, F.Column, F.Column]]:
    """(path, raw value as text, typed value) of every leaf field of a topic, over columns ``v`` (variant) and ``renames``."""
    parents = {p.rpartition(".")[0] for p in registered}
    for low, (path, kind) in registered.items():
        if low in parents:
            continue
        value = F.expr(f"try_variant_get(v, \"{_steps(path)}\", 'variant')")
        for prefix in sorted({low, *(p for p in new_names if low.startswith(p + "."))}, key=len, reverse=True):
            for new in sorted(new_names.get(prefix, ())):
                other = new + path[len(prefix) :]
                value = F.when(F.element_at("renames", F.lit(prefix)) == new, F.expr(f"try_variant_get(v, \"{_steps(other)}\", 'variant')")).otherwise(value)
        text = F.to_json(value) if kind in ("array", "map", "struct") else value.try_cast("string")
        if kind == "timestamp":
            cell = F.coalesce(ts.from_micros(F.try_multiply(text.try_cast("bigint"), F.lit(1000))), ts.from_micros(ts.epoch_micros(text)))
        elif kind in _SQL_TYPE:
            cell = text.try_cast(_SQL_TYPE[kind])
        else:
            cell = text
        yield path, text, cell


def project(records: DataFrame, fields: DataFrame, topic: str, changes: DataFrame) -> DataFrame:
    """All batches of one topic as one typed table: batch_id, delivery_id, a column per registered leaf field, and
    ``failed_casts``, the fields whose value was there but couldn't be read as the registered type (they are null).

    Values are looked up under the registered path or, where the batch has it renamed, under the new one. Struct fields
    come as their leaves (dots become underscores), arrays and maps as JSON text. A timestamp is read from ISO text or
    from milliseconds. Null values give a row of nulls."""
    mine = changes.where(F.col("topic") == topic)
    rows = records.where(F.col("topic") == topic).select("batch_id", "delivery_id", F.expr("try_parse_json(record_value)").alias("v")).join(_renames(mine).drop("topic"), "batch_id", "left")
    cells = list(_cells(fields_of(fields).get(topic, {}), _new_names(mine).get(topic, {})))
    failed = [F.when(text.isNotNull() & cell.isNull(), F.lit(path)) for path, text, cell in cells]
    return rows.select("batch_id", "delivery_id", *[cell.alias(path.replace(".", "_")) for path, _, cell in cells], F.array_compact(F.array(*failed)).alias("failed_casts"))


#: Renames of so many batches are broadcast, of more joined by shuffle.
BROADCAST_BATCHES = 200_000


def _with_renames(records: DataFrame, changes: DataFrame) -> DataFrame:
    """batch_id, delivery_id, topic, v (variant) and renames of every record."""
    renames = cut(_renames(changes))
    if renames.count() <= BROADCAST_BATCHES:
        renames = F.broadcast(renames)
    return records.select("batch_id", "delivery_id", "topic", F.expr("try_parse_json(record_value)").alias("v")).join(renames, ["batch_id", "topic"], "left")


def _by_topic(fields: DataFrame, changes: DataFrame, shown) -> F.Column | None:
    """One expression for all topics: of each row only its own topic's branch is evaluated. ``shown`` maps a topic's cells."""
    names, out = _new_names(changes), None
    for topic, registered in sorted(fields_of(fields).items()):
        here, branch = F.col("topic") == topic, shown(list(_cells(registered, names.get(topic, {}))))
        out = F.when(here, branch) if out is None else out.when(here, branch)
    return out


def table_rows(records: DataFrame, fields: DataFrame) -> DataFrame:
    """The consistent tables of all registered topics in one: batch_id, delivery_id, topic, row (the typed columns of
    :func:`project` as JSON text, nulls left out, times of UTC), failed_casts. One row per record, also of null values."""
    changes = cut(report(records, fields))

    def shown(cells: list) -> F.Column:
        row = F.to_json(F.struct(*[c.alias(path.replace(".", "_")) for path, _, c in cells]), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
        failed = F.array_compact(F.array(*[F.when(text.isNotNull() & c.isNull(), F.lit(path)) for path, text, c in cells]))
        return F.struct(row.alias("row"), failed.alias("failed_casts"))

    both = _by_topic(fields, changes, shown)
    if both is None:
        return records.sparkSession.createDataFrame([], "batch_id long, delivery_id long, topic string, row string, failed_casts array<string>")
    rows = _with_renames(records, changes).select(F.col("batch_id").cast("long").alias("batch_id"), "delivery_id", "topic", both.alias("t"))
    return rows.where("t is not null").select("batch_id", "delivery_id", "topic", "t.row", "t.failed_casts")


def cast_report(records: DataFrame, fields: DataFrame) -> DataFrame:
    """Per topic and field: rows, values and failed casts of the consistent tables of all registered topics, in one scan; counts
    are combined before their shuffle."""
    changes = cut(report(records, fields))
    entries = _by_topic(fields, changes, lambda cells: F.array(*[F.struct(F.lit(path).alias("field_path"), text.isNotNull().alias("there"), c.isNotNull().alias("read")) for path, text, c in cells]))
    if entries is None:
        return records.sparkSession.createDataFrame([], "topic string, field_path string, n_rows long, n_values long, n_failed long")
    cells = _with_renames(records, changes).select("topic", F.explode(entries).alias("c"))
    return cells.groupBy("topic", "c.field_path").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("c.read").alias("n_values"), F.count_if(F.col("c.there") & ~F.col("c.read")).alias("n_failed"))
