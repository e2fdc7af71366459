"""Tables of immutable Parquet files under a log of versions.

``_log/<version>.json`` holds what a commit did: schema, partition expressions, files added and removed, and the stream
batch it came from. Every ``CHECKPOINT`` versions the whole state is written as one file, so that a reader never folds more
than that many. A commit writes its data first and then creates the next version, which only one writer can; the loser
reads what happened, evaluates its schema again and retries. Added columns and wider types touch the log only: readers ask
old files for the current schema. Orphans of failed commits are cleaned by :meth:`Table.vacuum`.
"""

from __future__ import annotations

import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import types as mt
from millrace.functions import idents, jsonx, partitions
from millrace.functions import timestamps as ts
from millrace.metrics import Metrics
from millrace.operators import upsert as up
from millrace.operators.evolve import evolve
from millrace.operators.unify import project
from millrace.sources.store import Store, check_location

CHECKPOINT = 20
#: A batch of at most so many rows is broadcast for an upsert.
BROADCAST_ROWS = 100_000
#: Rewritten files have about so many bytes; a batch's row counts as so many.
FILE_BYTES = 128 << 20
#: Footers read at a time.
READERS = 16
#: An upsert that rewrites at most so many bytes is written by one task, as one file.
ONE_FILE_BYTES = 16 << 20
ROW_BYTES = 100
#: Directory of null and empty partition values (fixed name).
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class TableMissing(RuntimeError):
    """The table doesn't exist and may not be created."""


class CommitConflict(RuntimeError):
    """Too many commits of others came first."""


@dataclass(frozen=True)
class State:
    version: int
    schema: T.StructType
    parts: tuple[str, ...] = ()
    #: path -> {"rows", "bytes", "parts", "low", "high"}
    files: dict = field(default_factory=dict)
    #: stream -> last batch
    batches: dict = field(default_factory=dict)


class Table:
    def __init__(self, spark: SparkSession, location: str, metrics: Metrics | None = None, log: str | None = None):
        """``log``: where the log lies, if not with the data."""
        self.spark, self.store, self.metrics = spark, Store(spark, check_location(location)), metrics or Metrics()
        self.log = Store(spark, check_location(log)) if log else self.store
        self._known: dict[str, State] = {}

    # ------------------------------------------------------------------ log

    def state(self) -> State | None:
        """The current state, or None if the table doesn't exist."""
        names = [n for n in self.log.names("_log") if n.endswith(".json")]
        if not names:
            return None
        newest = max(n[:20] for n in names)
        if newest not in self._known:
            # what was read before is kept and only what came since is folded in
            self._known = {newest: self._fold(names, max(self._known.values(), key=lambda s: s.version, default=None))}
        return self._known[newest]

    def _fold(self, names: list[str], known: State | None) -> State:
        whole = [n for n in names if n.endswith(".all.json")]
        files, batches, start, schema, parts = {}, {}, -1, None, ()
        if known and (not whole or int(whole[-1][:20]) <= known.version):
            files, batches, start = dict(known.files), dict(known.batches), known.version
            schema, parts = known.schema.jsonValue(), known.parts
        elif whole:
            last = whole[-1]
            d = json.loads(self.log.read(f"_log/{last}"))
            files, batches, start = d["files"], d["batches"], d["version"]
            schema, parts = d["schema"], tuple(d["parts"])
        version = start
        for n in names:
            if n.endswith(".all.json") or int(n[:20]) <= start:
                continue
            d = json.loads(self.log.read(f"_log/{n}"))
            version, schema, parts = d["version"], d["schema"], tuple(d["parts"])
            for p in d["remove"]:
                files.pop(p, None)
            files.update(d["add"])
            if d.get("stream"):
                batches[d["stream"]] = d["batch"]
        return State(version, T.StructType.fromJson(schema), parts, files, batches)

    def exists(self) -> bool:
        return any(n.endswith(".json") for n in self.log.names("_log"))

    def columns(self) -> dict[str, str]:
        """Stored type by lower-case column name."""
        s = self.state()
        return {f.name.lower(): mt.stored_name(f) for f in s.schema.fields} if s else {}

    def _commit(self, at: State | None, schema: T.StructType, parts: tuple[str, ...], add: dict, remove: list[str], stream: str | None, batch: int | None) -> bool:
        version = at.version + 1 if at else 0
        entry = {"version": version, "time": time.time(), "schema": schema.jsonValue(), "parts": list(parts), "add": add, "remove": remove, "stream": stream, "batch": batch}
        if not self.log.create(f"_log/{version:020d}.json", json.dumps(entry).encode()):
            return False
        if version and version % CHECKPOINT == 0:
            s = self.state()
            if s.version == version:
                whole = {"version": version, "schema": s.schema.jsonValue(), "parts": list(s.parts), "files": s.files, "batches": s.batches}
                self.log.create(f"_log/{version:020d}.all.json", json.dumps(whole).encode())
        return True

    # ------------------------------------------------------------------ data definition

    def ensure(self, incoming: T.StructType, auto_create: bool = False, partition_by: str | list[str] | None = None, retries: int = 10) -> bool:
        """Creates or evolves the table for a batch's schema, in one commit; True if it existed before."""
        for _ in range(retries + 1):
            s = self.state()
            if s is None:
                if not auto_create:
                    raise TableMissing(f"table {self.store.root} doesn't exist and auto-create is off")
                with self.metrics.timer("createTable"):
                    schema, _ = evolve(T.StructType([]), T.StructType([f for f in incoming.fields if f.name.lower() != mt.SYSTEM_COLUMN]))
                    parsed = partitions.parse(partition_by)
                    partitions.check(parsed, schema)
                    spec = tuple(f"{p.transform}({p.column})" if p.transform else p.column for p in parsed)
                    if self._commit(None, schema, spec, {}, [], None, None):
                        return False
                continue
            schema, changes = evolve(s.schema, incoming)
            if not changes:
                return True
            with self.metrics.timer("evolveSchema"):
                if self._commit(s, schema, s.parts, {}, [], None, None):
                    return True
        raise CommitConflict(self.store.root)

    # ------------------------------------------------------------------ reading

    def read(self, where: dict[str, object] | None = None, ranges: dict[str, tuple] | None = None, files: list[str] | None = None) -> DataFrame:
        """The table's rows. ``where`` gives partition values by expression (``{"year(ts)": 2024, "status": "open"}``),
        ``ranges`` a low and high value by column, which also bounds year, month and day partitions of it; both choose files
        by the log alone and then filter the rows."""
        s = self.state()
        if s is None:
            raise TableMissing(f"table {self.store.root} doesn't exist")
        chosen = s.files if files is None else {f: s.files[f] for f in files}
        parts = {f"{p.transform}({p.column})" if p.transform else p.column: p for p in partitions.parse(list(s.parts))}
        conditions = []
        for expr, value in (where or {}).items():
            p = partitions.parse(expr)[0]
            key = f"{p.transform}({p.column})" if p.transform else p.column
            if key in parts:
                chosen = {f: m for f, m in chosen.items() if m["parts"].get(parts[key].hidden) == (_NULL_PARTITION if value is None or value == "" else str(value))}
            conditions.append(p.expression().eqNullSafe(F.lit(value)))
        for column, (low, high) in (ranges or {}).items():
            for p in parts.values():
                if p.column.lower() == column.lower() and p.transform == "year" and hasattr(low or high, "year"):
                    inside = lambda m, p=p, low=low, high=high: (v := m["parts"].get(p.hidden, "")).isdigit() and (low is None or int(v) >= low.year) and (high is None or int(v) <= high.year)
                    chosen = {f: m for f, m in chosen.items() if inside(m)}
            c = F.col(idents.column(column))
            conditions += ([c >= F.lit(low)] if low is not None else []) + ([c <= F.lit(high)] if high is not None else [])
        if chosen:
            df = self.spark.read.schema(s.schema).parquet(*[self.store.at(f) for f in sorted(chosen)])
        else:
            df = self.spark.createDataFrame([], s.schema)
        df = df.select(*[F.col(idents.column(f.name)).alias(f.name, metadata=f.metadata or {}) for f in s.schema.fields])
        return df.where(reduce(lambda a, b: a & b, conditions)) if conditions else df

    # ------------------------------------------------------------------ writing

    def _rows(self, df: DataFrame) -> DataFrame:
        """A batch in its stored form: no system column of its own, nested values as JSON text."""
        cols = []
        for f in df.schema.fields:
            if f.name.lower() == mt.SYSTEM_COLUMN:
                continue
            c = F.col(idents.column(f.name))
            k = mt.kind(f)
            stored = mt.field(f.name, "json" if k in ("struct", "array", "map") else k)
            c = jsonx.to_json(c) if k in ("struct", "array", "map") else ts.utc(c) if isinstance(f.dataType, T.TimestampType) else c.cast(stored.dataType) if f.dataType != stored.dataType else c
            cols.append(c.alias(f.name, metadata=stored.metadata or {}))
        return df.select(*cols)

    def _write(self, df: DataFrame, parts: tuple[str, ...], keys: list[str], max_records: int = 0) -> dict:
        """Writes rows under a folder of their own; returns the files' entries, with their rows and the first key's bounds."""
        folder = f"data/{uuid.uuid4().hex}"
        parsed = partitions.parse(list(parts))
        out = df.select("*", *[p.expression().alias(p.hidden) for p in parsed])
        if parsed:  # one task per partition value and no tiny files, but a hot value may spread over several tasks
            out = out.hint("rebalance", *[p.hidden for p in parsed])
        w = out.write.mode("append")
        if max_records:
            w = w.option("maxRecordsPerFile", max_records)
        (w.partitionBy(*[p.hidden for p in parsed]) if parsed else w).parquet(self.store.at(folder))
        entries = {}
        for path, size, _ in self.store.tree(folder):
            entries[path] = {"bytes": size, "parts": {k: unquote(v) for k, _, v in (x.partition("=") for x in path.split("/")) if k.startswith("__p_")}}
        known = self._bounds(entries, folder, df, keys)
        return {path: {**e, **known[path]} for path, e in entries.items() if known.get(path, {}).get("rows")}

    def _bounds(self, entries: dict, folder: str, df: DataFrame, keys: list[str]) -> dict[str, dict]:
        """Rows of new files and the first key's bounds: from the footers of local files, a few at a time, elsewhere by a job that reads
        that column alone."""
        if self.store.local is not None:
            import pyarrow.parquet as pq

            def one(path: str) -> tuple[str, dict]:
                meta = pq.ParquetFile(f"{self.store.local}/{path}").metadata
                low, high = _bounds(meta, keys[0]) if keys and meta.num_rows else (None, None)
                return path, {"rows": meta.num_rows, "low": low, "high": high}

            with ThreadPoolExecutor(READERS) as pool:
                return dict(pool.map(one, entries))
        rows = self.spark.read.schema(df.schema).parquet(self.store.at(folder))
        first = F.col(idents.column(keys[0])) if keys else F.lit(None)
        found = rows.select(F.col("_metadata.file_path").alias("f"), first.alias("k")).groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("low"), F.max("k").alias("high"))
        plain = lambda v: v if isinstance(v, (int, str)) and not isinstance(v, bool) else None
        # a row per file just written, as the listing above
        return {unquote(r.f[r.f.rfind("/data/") + 1 :]): {"rows": r.n, "low": plain(r.low), "high": plain(r.high)} for r in found.collect()}

    def write(self, df: DataFrame, keys: list[str] | None = None, auto_create: bool = False, partition_by: str | list[str] | None = None, stream: str | None = None, batch: int | None = None, mode: str = "last_wins", order: list[str] | None = None, retries: int = 10, max_records: int = 0, small: int = 0) -> str:
        """Appends or upserts a batch: upsert only with key columns and into a table that was there before. Returns what was
        done: ``empty``, ``replayed`` (this stream's batch is in already), ``simpleInsert`` or ``upsertWithMergeInto``.

        An appended batch of at most ``small`` rows is written as one file (per partition value), however many tasks made it."""
        s = self.state()
        if s and stream is not None and batch is not None and s.batches.get(stream, -1) >= batch:
            return "replayed"
        if keys and s:
            # one pass over the batch gives its size and the key's bounds; it is kept for the steps that follow
            df = df.persist()
            try:
                first = F.col(idents.column(next((c for c in df.columns if c.lower() == keys[0].lower()), keys[0])))
                n, low, high = df.agg(F.count(F.lit(1)), F.min(first), F.max(first)).first()
                if not n:
                    return "empty"
                self.ensure(df.schema, auto_create, partition_by, retries)
                self.upsert(self._rows(df), keys, mode, order, stream, batch, retries, max_records, (n, low, high))
            finally:
                df.unpersist()
            return "upsertWithMergeInto"
        if df.isEmpty():
            return "empty"
        self.ensure(df.schema, auto_create, partition_by, retries)
        rows = self._rows(df)
        if small and rows.limit(small + 1).count() <= small:
            rows = rows.coalesce(1)
        self.append(rows, stream, batch, retries, max_records, keys or [])
        return "simpleInsert"

    def append(self, rows: DataFrame, stream: str | None = None, batch: int | None = None, retries: int = 10, max_records: int = 0, keys: list[str] | None = None) -> None:
        """Adds rows by name; columns the batch lacks are null."""
        with self.metrics.timer("simpleInsert"):
            s = self.state()
            now = ts.now()
            full = project(_as_stored(rows, s.schema), s.schema).withColumn(mt.SYSTEM_COLUMN, now)
            files = self._write(full, s.parts, keys or [], max_records)
            for _ in range(retries + 1):
                if s.batches.get(stream, -1) >= (batch if batch is not None else 0) and stream is not None:
                    return
                if self._commit(s, s.schema, s.parts, files, [], stream, batch):
                    self.metrics.records(sum(f.get("rows", 0) for f in files.values()))
                    return
                s = self.state()
        raise CommitConflict(self.store.root)

    def upsert(self, rows: DataFrame, keys: list[str], mode: str = "last_wins", order: list[str] | None = None, stream: str | None = None, batch: int | None = None, retries: int = 10, max_records: int = 0, known: tuple | None = None) -> None:
        """Copy-on-write: only files that hold a key of the batch are rewritten. ``known``: the batch's size and the least
        and greatest first key, where they were counted already.

        Several rows of one key: ``last_wins`` keeps the last by ``order`` (of equal ones any), ``strict`` raises."""
        if mode == "strict":
            up.require_unique(rows, keys)
        with self.metrics.timer("upsertWithMergeInto"):
            kept = None if known else rows.persist()  # what was counted is kept already
            rows = kept or rows
            try:
                n, low, high = known or rows.agg(F.count(F.lit(1)), F.min(idents.column(keys[0])), F.max(idents.column(keys[0]))).first()
                small = n <= BROADCAST_ROWS
                if small:  # so few rows need no exchange to find the last of each key
                    rows = rows.coalesce(1)
                rows = up.last_wins(rows, keys, order or keys) if mode != "strict" else rows
                for _ in range(retries + 1):
                    s = self.state()
                    if stream is not None and batch is not None and s.batches.get(stream, -1) >= batch:
                        return
                    stored = _as_stored(rows, s.schema)
                    only_keys = {c.lower() for c in stored.columns} <= {k.lower() for k in keys}
                    maybe = self._maybe(s, low, high)
                    touched, matched = self._touched(s, maybe, stored, keys, small)
                    try:
                        base = self.read(files=touched)
                        if only_keys:
                            # nothing to update, so no file is rewritten; unknown keys are appended
                            merged = project(up.unknown(base, stored, keys), s.schema).withColumn(mt.SYSTEM_COLUMN, ts.now())
                            touched = []
                        else:
                            merged = project(up.merge(base, stored, keys, small=small, matched=matched), s.schema)
                        # a small result is one file, so that small upserts don't litter the table; a larger one is as many as its tasks
                        size = sum(s.files[f]["bytes"] for f in touched) + n * ROW_BYTES
                        if not s.parts and size <= ONE_FILE_BYTES:
                            merged = merged.coalesce(1)
                        files = self._write(merged, s.parts, keys, max_records)
                    finally:
                        if matched is not None:
                            matched.unpersist()
                    if self._commit(s, s.schema, s.parts, files, touched, stream, batch):
                        self.metrics.records(n)
                        return
            finally:
                if kept is not None:
                    kept.unpersist()
        raise CommitConflict(self.store.root)

    def _maybe(self, s: State, low: object, high: object) -> list[str]:
        """Files whose first key's bounds meet the batch's; none if its keys are null."""
        if low is None:
            return []
        return [f for f, m in s.files.items() if m.get("low") is None or not isinstance(low, type(m["low"])) or (m["high"] >= low and m["low"] <= high)]

    def _touched(self, s: State, maybe: list[str], rows: DataFrame, keys: list[str], small: bool) -> tuple[list[str], DataFrame | None]:
        """(files that really hold a key of the batch, the batch's keys that are known). The keys come for small batches only, from the
        same look at the table's key columns, and are to be unpersisted."""
        if not maybe:
            return [], None
        known = self.spark.read.schema(s.schema).parquet(*[self.store.at(f) for f in maybe])
        names = [f"__k{i}" for i in range(len(keys))]
        mine = known.select(*[F.col(idents.column(k)).alias(c) for c, k in zip(names, keys, strict=True)], F.col("_metadata.file_path").alias("__file"))
        theirs = rows.select(*[F.col(idents.column(k)).alias(c) for c, k in zip(names, keys, strict=True)])
        hit = mine.join(F.broadcast(theirs) if small else theirs, names, "left_semi")
        if small:
            hit = hit.persist()
        # at most one row per file of the log; paths come as URIs, the log has them as on disk
        found = {unquote(r[0][r[0].rfind("/data/") + 1 :]) for r in hit.select("__file").distinct().collect()}
        return [f for f in maybe if f in found], hit if small else None

    # ------------------------------------------------------------------ upkeep

    def compact(self, target: int = FILE_BYTES, retries: int = 10) -> int:
        """Merges the table's files of less than half the target into files of about the target, in one commit that changes
        no row; returns how many were merged. Partition values stay apart. A file another writer replaced meanwhile makes
        the attempt start anew."""
        for _ in range(retries + 1):
            s = self.state()
            if s is None:
                raise TableMissing(f"table {self.store.root} doesn't exist")
            by: dict[tuple, list[str]] = {}
            for f, m in s.files.items():
                if m["bytes"] * 2 < target:
                    by.setdefault(tuple(sorted(m["parts"].items())), []).append(f)
            small = sorted(f for group in by.values() if len(group) > 1 for f in group)
            if not small:
                return 0
            rows = self.read(files=small)
            if not s.parts:
                rows = rows.coalesce(max(1, -(-sum(s.files[f]["bytes"] for f in small) // target)))
            files = self._write(rows, s.parts, [])
            if self._commit(s, s.schema, s.parts, files, small, None, None):
                return len(small)
        raise CommitConflict(self.store.root)

    def vacuum(self, older_than: float = 3600.0) -> list[str]:
        """Deletes data files no commit lists that are older than some seconds; returns them."""
        s = self.state()
        listed = set(s.files) if s else set()
        gone = [p for p, _, at in self.store.tree("data") if p not in listed and time.time() - at >= older_than]
        for p in gone:
            self.store.delete(p)
        return gone


def _bounds(meta, key: str) -> tuple[object, object]:
    low = high = None
    for g in range(meta.num_row_groups):
        for c in range(meta.num_columns):
            col = meta.row_group(g).column(c)
            if col.path_in_schema == key:
                if col.statistics is None or not col.statistics.has_min_max or not isinstance(col.statistics.min, (int, str)):
                    return None, None
                low = col.statistics.min if low is None else min(low, col.statistics.min)
                high = col.statistics.max if high is None else max(high, col.statistics.max)
    return low, high


def _as_stored(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Batch columns under the table's spelling and type."""
    by = {f.name.lower(): f for f in schema.fields}
    have = {f.name: f for f in rows.schema.fields}
    cols = []
    for name, f in have.items():
        if name.lower() == mt.SYSTEM_COLUMN:
            continue
        want = by.get(name.lower(), f)
        cols.append(F.col(idents.column(name)).cast(want.dataType).alias(want.name, metadata=want.metadata or {}))
    return rows.select(*cols)


class Catalog:
    """Tables by name: data under one folder, logs beside the data or under a folder of their own (``logs``), so that a catalog is
    attached by naming both."""

    def __init__(self, spark: SparkSession, location: str, metrics: Metrics | None = None, logs: str | None = None):
        self.spark, self.location, self.metrics = spark, check_location(location).rstrip("/"), metrics or Metrics()
        self.logs = check_location(logs).rstrip("/") if logs else None

    def table(self, name: str) -> Table:
        return Table(self.spark, f"{self.location}/{name}", self.metrics, f"{self.logs}/{name}" if self.logs else None)

    def exists(self, name: str) -> bool:
        return self.table(name).exists()

    def names(self) -> list[str]:
        """Tables that have a log."""
        return [n for n in Store(self.spark, self.logs or self.location).names("") if self.exists(n)]
