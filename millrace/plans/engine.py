"""Queries over the rest of the engine: records with schemas, the table layer, the sink, options and metrics, and the same in SQL."""

from __future__ import annotations

import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from millrace import config, routing
from millrace import types as mt
from millrace.functions import idents
from millrace.functions import timestamps as ts
from millrace.metrics import Metrics
from millrace.operators import dlq, infer, typed, unify
from millrace.operators.evolve import IncompatibleType
from millrace.session import read_table, scratch, ship
from millrace.sources import arrow_ipc, avro
from millrace.sources.store import check_location
from millrace.sources.table import Catalog, Table, TableMissing
from millrace.streaming.stream import Sink, admission, records

QUERIES: dict = {}
ORACLES: dict = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, what: str, metrics: Metrics | None = None) -> Table:
    return Table(spark, scratch(spark, what), metrics)


# ---------------------------------------------------------------------------------------------- records


@_query("SELECT o_orderkey, o_custkey, o_orderdate, CAST(o_orderdate AS DATE) AS o_day, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS o_orderstatus FROM orders")
def typed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records with Connect schemas, two of them: integers of two widths join, a field only one has is null in the others, times
    come as milliseconds and dates as days."""

    def schema(wide: bool) -> str:
        fields = [("o_orderkey", "int64", None), ("o_custkey", "int64" if wide else "int32", None), ("o_orderdate", "int64", "Timestamp"), ("o_day", "int32", "Date"), ("o_totalprice", "float64", None)]
        fields += [("o_orderstatus", "string", None)] if wide else []
        return json.dumps({"type": "struct", "fields": [{"field": f, "type": t, "optional": True, **({"name": f"data.{n}"} if n else {})} for f, t, n in fields]})

    o = read_table(spark, sf, "orders")
    even = F.col("o_orderkey") % 2 == 0
    day = F.unix_date(F.to_date("o_orderdate"))
    millis = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("o_orderdate"))
    value = F.to_json(F.struct("o_orderkey", "o_custkey", millis.alias("o_orderdate"), day.alias("o_day"), "o_totalprice", F.when(even, F.col("o_orderstatus")).alias("o_orderstatus")))
    rows = o.select(F.when(even, F.lit(schema(True))).otherwise(F.lit(schema(False))).alias("s"), value.alias("v"))
    return typed.decode(rows, "s", "v")


_EVENT = json.dumps({"type": "record", "name": "Event", "fields": [
    {"name": "event_id", "type": "long"}, {"name": "user_id", "type": ["null", "long"]}, {"name": "ts", "type": {"type": "long", "logicalType": "timestamp-micros"}},
    {"name": "event_type", "type": {"type": "enum", "name": "Kind", "symbols": ["click", "view", "purchase", "signup", "error"]}}, {"name": "value", "type": ["double", "null"]}]})


@_query("SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id, ts, event_type, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events")
def avro_records(spark: SparkSession, sf: str) -> DataFrame:
    """Rows to Avro records and back, framed, with nulls in unions."""
    e = read_table(spark, sf, "events")
    rows = e.select("event_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("user_id"), ts.micros("ts").alias("ts"), "event_type", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"))

    def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = avro._resolved(json.loads(_EVENT), {})
        for batch in it:
            yield pa.RecordBatch.from_arrays([pa.array([b"\0\0\0\0\1" + avro.encode(r, schema) for r in batch.to_pylist()], pa.binary())], names=["v"])

    ship(spark)
    return avro.decode(rows.mapInArrow(pack, "v binary"), "v", _EVENT, framed=True)


@_query("SELECT * FROM (VALUES ('event_id', 'bigint'), ('ts', 'timestamp_ntz'), ('user_id', 'bigint'), ('event_type', 'string'), ('value', 'double'), ('props', 'string')) t(name, type)")
def ipc_derived_schema(spark: SparkSession, sf: str) -> DataFrame:
    """The schema of payloads from their own headers."""
    found = arrow_ipc.joined(arrow_ipc.schemas_of(arrow_ipc.pack(read_table(spark, sf, "events"), 500), "payload"))
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in found.fields], "name string, type string")


@_query("SELECT event_id, event_type, value, NULL::BIGINT AS user_id FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_id, event_type, NULL, user_id FROM events WHERE event_id % 2 = 1")
def ipc_many_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads of several record batches, and of two schemas: all batches of a payload are read, columns go by name."""
    e = read_table(spark, sf, "events")
    some = arrow_ipc.pack(e.where("event_id % 2 = 0").select("event_id", "event_type", "value"), 700, 50)
    other = arrow_ipc.pack(e.where("event_id % 2 = 1").select("user_id", "event_type", "event_id"), 700, 50)
    return arrow_ipc.read(some.union(other), "payload")


@_query("SELECT 'No valid schemas found in records' AS message, count(*) AS n FROM nation")
def no_usable_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records none of which is an object have no schema: inference raises."""
    n = read_table(spark, sf, "nation").select(F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).alias("v"))
    try:
        infer.infer(n, "v")
        message = ""
    except ValueError as e:
        message = str(e)
    return n.agg(F.count(F.lit(1)).alias("n")).select(F.lit(message).alias("message"), "n")


@_query("SELECT * FROM (VALUES ('a', 'int'), ('e', 'struct<g:string>')) t(name, type)")
def pruned_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Fields that are null everywhere, arrays without elements and structs without fields have no type and no column."""
    text = F.concat(F.lit('{"a":'), (F.col("event_id") % 1000).cast("string"), F.lit(',"b":null,"c":[],"d":{},"e":{"f":null,"g":"x"}}'))
    found = infer.infer(read_table(spark, sf, "events").select(text.alias("v")), "v")
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in found.fields], "name string, type string")


@_query("""
SELECT 'value' AS field, 'int32' AS type, min(CAST(event_id % 1000 AS VARCHAR)) AS sample FROM events WHERE event_id % 7 <> 0
UNION ALL SELECT 'value', 'string', min(event_type) FROM events WHERE event_id % 7 = 0
UNION ALL SELECT 'in.x', 'boolean', 'True' UNION ALL SELECT 'in.x', 'string', 'no'""")
def conflict_samples(spark: SparkSession, sf: str) -> DataFrame:
    """One sample value per field and type, at any depth, as an error about conflicting types shows them."""
    odd = F.col("event_id") % 7 == 0
    text = F.when(odd, F.concat(F.lit('{"value":"'), "event_type", F.lit('","in":{"x":"no"}}'))).otherwise(F.concat(F.lit('{"value":'), (F.col("event_id") % 1000).cast("string"), F.lit(',"in":{"x":true}}')))
    tree = infer.schema_tree(read_table(spark, sf, "events").select(text.alias("v")), "v")
    return spark.createDataFrame(infer.samples(tree), "field string, type string, sample string")


@_query("""
SELECT * FROM (VALUES ('same', true, true), ('order', false, true), ('type', false, false), ('nullability', false, false), ('child order', false, true), ('metadata', true, true), ('added and removed', true, true)) t(pair, equal, equal_unordered)""")
def schema_equality(spark: SparkSession, sf: str) -> DataFrame:
    """Equality of schemas, with and without the order of fields; adding and then removing a field gives the schema back."""
    a = T.StructType([mt.field("a", "int32"), mt.field("b", "string")])
    s = lambda x, y: T.StructType([T.StructField("s", T.StructType([mt.field(x, "int32"), mt.field(y, "int32")]))])
    pairs = {
        "same": (a, T.StructType(list(a.fields))),
        "order": (a, T.StructType(a.fields[::-1])),
        "type": (a, T.StructType([mt.field("a", "int64"), mt.field("b", "string")])),
        "nullability": (a, T.StructType([mt.field("a", "int32", False), mt.field("b", "string")])),
        "child order": (s("x", "y"), s("y", "x")),
        "metadata": (a, T.StructType([T.StructField("a", T.IntegerType(), True, {"comment": "x"}), mt.field("b", "string")])),
        "added and removed": (a, unify.remove_field(unify.add_field(a, mt.field("aa", "date")), "aa")),
    }
    return spark.createDataFrame([(n, unify.same(x, y), unify.same(x, y, ordered=False)) for n, (x, y) in pairs.items()], "pair string, equal boolean, equal_unordered boolean")


# ---------------------------------------------------------------------------------------------- dead letters


_BAD = """
WITH e AS (SELECT event_id, user_id, event_type, event_id % 10 = 3 AS wrong, event_id % 10 = 7 AS broken FROM events)
"""


def _doubtful(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON texts, every tenth with text for a number, every tenth cut off."""
    e = read_table(spark, sf, "events")
    good = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"n":'), F.col("user_id").cast("string"), F.lit("}"))
    wrong = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"n":"'), "event_type", F.lit('"}'))
    text = F.when(F.col("event_id") % 10 == 3, wrong).when(F.col("event_id") % 10 == 7, F.lit("{")).otherwise(good)
    return e.select(F.lit("doubtful").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"), text.alias("value"))


_WANTED = T.StructType([mt.field("event_id", "int64"), mt.field("n", "int32")])


@_query(_BAD + "SELECT event_id AS o, 'field n: ' || event_type || ' is not int' AS error FROM e WHERE wrong UNION ALL SELECT event_id, 'malformed JSON' FROM e WHERE broken")
def dlq_errors(spark: SparkSession, sf: str) -> DataFrame:
    """What is wrong with a record: the field, its value, and the type it should have."""
    _, bad = dlq.split(_doubtful(spark, sf), "value", _WANTED, ["offset"])
    return bad.select(F.col("offset").alias("o"), F.regexp_replace("error", "^(malformed JSON): .*", "$1").alias("error"))


@_query(_BAD + "SELECT count(*) AS n, count(*) FILTER (wrong OR broken) AS bad, CAST(sum(CASE WHEN broken THEN 1 WHEN wrong THEN 20 + strlen(event_id::VARCHAR) + strlen(event_type) ELSE 18 + strlen(event_id::VARCHAR) + strlen(user_id::VARCHAR) END) AS BIGINT) AS n_bytes FROM e")
def dlq_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Good and bad records and bytes of a batch, in one pass over the checked records."""
    n, bad, size = dlq.counts(dlq.checked(_doubtful(spark, sf), "value", _WANTED, ["offset"]), "value")
    return spark.createDataFrame([(n, bad, size)], "n long, bad long, n_bytes long")


@_query(_BAD + "SELECT event_id, user_id AS n, 'stored' AS place FROM e WHERE NOT wrong AND NOT broken UNION ALL SELECT event_id, NULL, 'dead' FROM e WHERE wrong OR broken")
def sink_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    """A batch through the sink: the table gets what fits its schema, the dead-letter table the rest, nothing is lost."""
    base = scratch(spark, "letters")
    sink = Sink(spark, config.parse({"data_path": base, "table.doubtful.auto-create": "true"}), "letters")
    sink.catalog.table("doubtful").ensure(_WANTED, auto_create=True)
    sink(_doubtful(spark, sf).withColumn("value", F.col("value").cast("binary")), 0)
    stored = sink.catalog.table("doubtful").read().select("event_id", F.col("n").cast("bigint").alias("n"), F.lit("stored").alias("place"))
    dead = sink.catalog.table("doubtful__dlq").read().select(F.col("offset").alias("event_id"), F.lit(None).cast("bigint").alias("n"), F.lit("dead").alias("place"))
    return stored.union(dead)


@_query("SELECT * FROM (VALUES ('SchemaConflict', true), ('IncompatibleType', true), ('wrapped', true), ('other', false)) t(error, conflict)")
def conflict_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Which errors are about schemas that don't agree, also where they were wrapped on the way."""
    wrapped = RuntimeError("batch failed")
    wrapped.__cause__ = IncompatibleType("Incompatible type for column c")
    errors = {"SchemaConflict": unify.SchemaConflict("x"), "IncompatibleType": IncompatibleType("x"), "wrapped": wrapped, "other": ValueError("Cannot unify")}
    return spark.createDataFrame([(n, dlq.is_conflict(e)) for n, e in errors.items()], "error string, conflict boolean")


# ---------------------------------------------------------------------------------------------- tables


@_query("SELECT n_nationkey, n_name, n_regionkey, CAST(1 AS BIGINT) AS n_files FROM nation")
def small_writes(spark: SparkSession, sf: str) -> DataFrame:
    """A batch below the row limit is one file, however many tasks made it."""
    table = _table(spark, "small")
    table.write(read_table(spark, sf, "nation").repartition(6), auto_create=True, small=10_000)
    return table.read().drop("_inserted_at").withColumn("n_files", F.lit(len(table.state().files)).cast("bigint"))


@_query("SELECT o_orderkey, CAST(o_orderkey % 6 AS BIGINT) AS writer, CAST(7 AS BIGINT) AS n_commits FROM orders")
def concurrent_writers(spark: SparkSession, sf: str) -> DataFrame:
    """Six writers at once: whoever loses a commit reads on and retries, so that all rows are there and each commit once."""
    table = _table(spark, "race")
    o = read_table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 6).alias("writer"))
    table.ensure(o.schema, auto_create=True)

    @inheritable_thread_target(spark)
    def one(i: int) -> None:
        Table(spark, table.store.root).write(o.where(F.col("writer") == i))

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(one, range(6)))
    return table.read().drop("_inserted_at").withColumn("n_commits", F.lit(table.state().version + 1).cast("bigint"))


@_query("SELECT 'nations' AS tables, r_regionkey, r_name FROM region")
def attached_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog with its logs apart from the data: attached a second time, it has the same tables and rows."""
    c = config.parse({"data_path": scratch(spark, "data"), "catalog_uri": scratch(spark, "logs")})
    attach = lambda: Catalog(spark, str(c["data_path"]), logs=str(c["catalog_uri"]))
    attach().table("nations").write(read_table(spark, sf, "region"), auto_create=True)
    again = attach()
    return again.table("nations").read().drop("_inserted_at").select(F.lit(",".join(again.names())).alias("tables"), "*")


@_query("""
SELECT * FROM (VALUES ('s3://bucket/a', true), ('s3a://b', true), ('gs://bucket', true), ('hdfs://host:9000/x', true), ('file:///tmp/x', true), ('/tmp/x', true),
  ('ftp://x/y', false), ('s3://', false), ('file://x', false), ('relative/x', false), ('', false), ('postgres:host', false)) t(location, accepted)""")
def locations(spark: SparkSession, sf: str) -> DataFrame:
    """Where tables may lie."""
    rows = []
    for x in ("s3://bucket/a", "s3a://b", "gs://bucket", "hdfs://host:9000/x", "file:///tmp/x", "/tmp/x", "ftp://x/y", "s3://", "file://x", "relative/x", "", "postgres:host"):
        try:
            check_location(x)
            rows.append((x, True))
        except ValueError:
            rows.append((x, False))
    return spark.createDataFrame(rows, "location string, accepted boolean")


@_query("SELECT * FROM (VALUES ('s3a', 'fs.s3a.endpoint', 'host:9000'), ('s3a', 'fs.s3a.access.key', 'k'), ('s3a', 'fs.s3a.connection.ssl.enabled', 'false'), ('s3a', 'fs.s3a.path.style.access', 'true')) t(scheme, name, value)")
def store_options(spark: SparkSession, sf: str) -> DataFrame:
    """Settings of the object store reach the file system for S3 locations only."""
    o = {"s3.endpoint": "host:9000", "s3.access_key_id": "k", "s3.use_ssl": "false", "s3.url_style": "path"}
    rows = [(s, k, v) for s, path in (("s3a", "s3a://b/x"), ("file", "file:///tmp/x"), ("gs", "gs://b")) for k, v in config.parse({"data_path": path, **o}).hadoop().items()]
    return spark.createDataFrame(rows, "scheme string, name string, value string")


@_query("SELECT 'empty' AS created, 'simpleInsert' AS first, 'empty' AS second, count(*) AS n FROM region")
def empty_batches(spark: SparkSession, sf: str) -> DataFrame:
    """A batch without rows does nothing: no table is created, no file is written."""
    table, r = _table(spark, "none"), read_table(spark, sf, "region")
    did = [table.write(r.where("r_regionkey < 0"), auto_create=True), table.write(r, auto_create=True, keys=["r_regionkey"]), table.write(r.where("r_regionkey < 0"), keys=["r_regionkey"])]
    return table.read().agg(F.count(F.lit(1)).alias("n")).select(*[F.lit(d).alias(n) for d, n in zip(did, ("created", "first", "second"), strict=True)], "n")


@_query("""SELECT DISTINCT n, CASE WHEN regexp_full_match(n, '[A-Za-z_][A-Za-z0-9_]*') THEN n ELSE '`' || replace(n, '`', '``') || '`' END AS quoted
FROM (SELECT p_name AS n FROM part UNION ALL SELECT replace(p_brand, '#', '_') FROM part UNION ALL SELECT p_type || '`' FROM part)""")
def quoted_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names as identifiers in SQL text."""
    p = read_table(spark, sf, "part")
    names = p.select(F.col("p_name").alias("n")).union(p.select(F.replace("p_brand", F.lit("#"), F.lit("_")))).union(p.select(F.concat("p_type", F.lit("`")))).distinct()
    return names.select("n", idents.quote_column("n").alias("quoted"))


@_query("""
SELECT * FROM (VALUES (false, '', 'TableMissing'), (true, 'n_nationkey INTEGER', ''), (true, 'n_name VARCHAR', ''), (true, 'n_regionkey INTEGER', ''), (true, '_inserted_at TIMESTAMP', '')) t(there, stored, error)""")
def table_columns(spark: SparkSession, sf: str) -> DataFrame:
    """A table that may not be created is refused and stays away; once created, its columns are known by lower-case name."""
    table, n = _table(spark, "columns"), read_table(spark, sf, "nation").withColumnRenamed("n_name", "N_Name")
    try:
        table.write(n)
        error = ""
    except TableMissing as e:
        error = type(e).__name__
    rows = [(table.exists(), "", error)]
    table.write(n, auto_create=True)
    rows += [(table.exists(), f"{name} {kind}", "") for name, kind in table.columns().items()]
    return spark.createDataFrame(rows, "there boolean, stored string, error string")


@_query("SELECT r_regionkey, r_name, false AS has_time FROM region UNION ALL SELECT n_regionkey, n_name, true FROM nation")
def legacy_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table from before the system column gets it with the next batch; its old rows have no time."""
    table, r = _table(spark, "legacy"), read_table(spark, sf, "region")
    table._commit(None, r.schema, (), table._write(r, (), []), [], None, None)
    n = read_table(spark, sf, "nation")
    table.write(n.select(F.col("n_regionkey").alias("r_regionkey"), F.col("n_name").alias("r_name")))
    return table.read().select("r_regionkey", "r_name", F.col("_inserted_at").isNotNull().alias("has_time"))


@_query("SELECT n_nationkey, true AS orphans_gone, true AS listed_stay FROM nation")
def orphan_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a failed commit are found and deleted, those a commit lists stay."""
    table, n = _table(spark, "orphans"), read_table(spark, sf, "nation").select("n_nationkey")
    table.write(n, auto_create=True)
    lost = set(table._write(n, (), []))  # written, never committed
    gone = set(table.vacuum(0.0))
    kept = {p for p, _, _ in table.store.tree("data")}
    return table.read().select("n_nationkey", F.lit(lost <= gone).alias("orphans_gone"), F.lit(kept == set(table.state().files)).alias("listed_stay"))


# ---------------------------------------------------------------------------------------------- streams


@_query("SELECT 'events_' || event_type AS table_name, event_id, user_id FROM events WHERE event_type <> 'view' UNION ALL SELECT 'page_views', event_id, user_id FROM events WHERE event_type = 'view'")
def stream_tables(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of several topics into a table each, side by side, in files of at most ``flush.size`` rows; the query is stopped in
    the middle and goes on from its checkpoint, so that every record is there once."""
    base = scratch(spark, "tables")
    e = read_table(spark, sf, "events")
    topic = F.concat(F.lit("events_"), "event_type")
    rec = e.select(topic.alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"), F.to_json(F.struct("event_id", "user_id")).cast("binary").alias("value"))
    kinds = sorted(r[0] for r in e.select("event_type").distinct().collect())  # the topics of the registry
    names = ["page_views" if k == "view" else f"events_{k}" for k in kinds]
    options = {"data_path": f"{base}/tables", "topic2table.map": "events_view:page_views", "flush.size": "1500", "file.size.bytes": "600000", "threads": "4"}
    c = config.parse({**options, **{f"table.{n}.auto-create": "true" for n in names}})
    sink = Sink(spark, c, "tables")
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):  # the second half arrives after the stop
        rec.where(part.replace("event_id", "offset")).repartition(3).write.mode("append").parquet(f"{base}/in")
        query = sink.start(records(spark, "parquet", f"{base}/in", config=c), f"{base}/checkpoint", once=True)
        query.awaitTermination()
        if query.exception():
            raise query.exception()
    for n in names:
        if any(f["rows"] > 1500 for f in sink.catalog.table(n).state().files.values()):
            raise RuntimeError(f"a file of {n} has too many rows")
    tables = [sink.catalog.table(n).read().select(F.lit(n).alias("table_name"), F.col("event_id").cast("bigint").alias("event_id"), F.col("user_id").cast("bigint").alias("user_id")) for n in names]
    out = tables[0]
    for t in tables[1:]:
        out = out.union(t)
    return out


@_query("SELECT * FROM (VALUES ('record_count', 3000), ('file_size', 2000), ('time', 10)) t(reason, n)")
def sink_flush_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """Why a table's part of a micro-batch was due, as the sink counts it in its metrics."""
    sink = Sink(spark, config.parse({"data_path": scratch(spark, "why"), "flush.size": "2500", "file.size.bytes": "30000", "table.t.auto-create": "true"}), "why")
    one = spark.range(3000).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.concat(F.lit('{"id":'), (F.col("id") + 10_000).cast("string"), F.lit(',"p":"xxxxx"}')).cast("binary").alias("value"))
    for i, n in enumerate((3000, 2000, 10)):
        sink(one.where(F.col("offset") < n), i)
    return spark.createDataFrame([(k.removeprefix("flush."), int(v["total"])) for k, v in sink.metrics.snapshot().items() if k.startswith("flush.")], "reason string, n int")


# ---------------------------------------------------------------------------------------------- options and metrics


@_query("""
SELECT * FROM (VALUES ('data.inlining.row.limit', '10000'), ('topic2table.map', ''), ('consumer.override.max.poll.records', '1024'), ('flush.size', '1000000'), ('flush.interval.ms', '60000'),
  ('file.size.bytes', '268435456'), ('threads', '0'), ('parallel.partition.flush', 'True'), ('max_retry_count', '10'), ('spill.enabled', 'False'), ('spill.directory', '')) t(name, value)""")
def option_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """The options that have defaults, and these."""
    c = config.parse({"data_path": "/x"})
    skip = ("data_path", "catalog_uri")
    return spark.createDataFrame([(n, str(v)) for n, v in c.values.items() if n not in skip and not n.startswith("s3.")], "name string, value string")


@_query("""
SELECT topic, table_name, list_aggregate(list_filter(list_transform(string_split(coalesce(table_id_columns, ''), ','), lambda x: trim(x)), lambda x: x <> ''), 'string_agg', ',') AS id_columns, table_name IS NOT NULL AS auto_create
FROM sink_topics WHERE topic IS NOT NULL""")
def table_options(spark: SparkSession, sf: str) -> DataFrame:
    """Options per table from the registry of topics: key columns, creation, and the route of each topic (one row per topic)."""
    rows = read_table(spark, sf, "sink_topics").where("topic IS NOT NULL").collect()
    out = []
    for r in rows:
        options = {"data_path": "/x", "sink.topic2table.map": f"{r.topic}:{r.table_name}", f"table.{r.table_name}.id-columns": r.table_id_columns or " , ", f"table.{r.table_name}.auto-create": "true", f"table.{r.table_name}.other": "ignored"}
        c = config.parse(options)
        t = c.table(routing.table_of(r.topic, routing.parse(c["topic2table.map"])))
        out.append((r.topic, routing.table_of(r.topic, routing.parse(c["topic2table.map"])), ",".join(t.id_columns) or None, t.auto_create))
    return spark.createDataFrame(out, "topic string, table_name string, id_columns string, auto_create boolean")


@_query("""
SELECT * FROM (VALUES ('unknown option nope', 'nope', '1'), ('flush.size', 'flush.size', '0'), ('file.size.bytes', 'file.size.bytes', 'many'), ('data.inlining.row.limit', 'data.inlining.row.limit', '-1'),
  ('parallel.partition.flush', 'parallel.partition.flush', 'maybe'), ('spill.directory', 'spill.directory', '/tmp/spill'), ('catalog_uri', 'catalog_uri', 'postgres:host=x'), ('data_path', 'data_path', 'ftp://x')) t(refused_for, name, value)""")
def refused_options(spark: SparkSession, sf: str) -> DataFrame:
    """Options that are refused, each with its own name in the error."""
    rows = []
    for name, value in (("nope", "1"), ("flush.size", "0"), ("file.size.bytes", "many"), ("data.inlining.row.limit", "-1"), ("parallel.partition.flush", "maybe"), ("spill.directory", "/tmp/spill"), ("catalog_uri", "postgres:host=x"), ("data_path", "ftp://x")):
        try:
            config.parse({"data_path": "/x", name: value})
            rows.append(("", name, value))
        except ValueError as e:
            rows.append((str(e).split(":")[0].removeprefix("option "), name, value))
    return spark.createDataFrame(rows, "refused_for string, name string, value string")


@_query("""
SELECT * FROM (VALUES ('kafka', 'maxOffsetsPerTrigger', '500'), ('kafka', 'kafka.max.poll.records', '1024'), ('file', 'maxBytesPerTrigger', '268435456'), ('trigger', 'processingTime', '250 milliseconds'),
  ('task 0', 'task.id', '0'), ('task 1', 'task.id', '1')) t(part, name, value)""")
def admission_options(spark: SparkSession, sf: str) -> DataFrame:
    """Flush sizes and the interval as limits and trigger of the source, and one set of options per writer."""
    given = {"data_path": "/x", "flush.size": "500", "flush.interval.ms": "250"}
    c = config.parse(given)
    rows = [(part, k, v) for part, source in (("kafka", "kafka"), ("file", "parquet")) for k, v in admission(c, source).items()]
    rows += [("trigger", k, v) for k, v in c.trigger().items()]
    rows += [(f"task {i}", "task.id", o["task.id"]) for i, o in enumerate(c.task_configs(2, given)) if config.parse(o).values == c.values]
    return spark.createDataFrame(rows, "part string, name string, value string")


@_query("""
SELECT * FROM (VALUES ('query', 6), ('query.simpleInsert', 1), ('query.upsertWithMergeInto', 2), ('query.createTable', 1), ('query.evolveSchema', 2), ('schema', 3), ('batch-size', 3)) t(name, n)""")
def write_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """How many operations of each kind were timed, schema operations among them: three batches, the last two with new columns."""
    m = Metrics()
    table, o = _table(spark, "timed", m), read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    table.write(o, keys=["o_orderkey"], auto_create=True)
    table.write(o.withColumn("a", F.lit(1)), keys=["o_orderkey"])
    table.write(o.withColumn("b", F.lit(1)), keys=["o_orderkey"])
    seen = m.snapshot()
    if any(not (0 < v["avg"] <= v["max"] <= v["total"]) for v in seen.values()):
        raise RuntimeError(f"a timing is missing: {seen}")
    return spark.createDataFrame([(k, v["count"]) for k, v in seen.items()], "name string, n int")


@_query("SELECT CAST(3 * count(*) AS DOUBLE) AS total, CAST(count(*) AS DOUBLE) AS avg_size, CAST(count(*) AS DOUBLE) AS max_size, true AS closed FROM customer")
def batch_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Records in all and per batch; closing forgets them."""
    m = Metrics()
    table = _table(spark, "sizes", m)
    for _ in range(3):
        table.write(read_table(spark, sf, "customer"), auto_create=True)
    v = m.snapshot()["batch-size"]
    m.close()
    return spark.createDataFrame([(float(v["total"]), float(v["avg"]), float(v["max"]), m.snapshot() == {})], "total double, avg_size double, max_size double, closed boolean")
