"""Queries over the ingestion operators, and the same in SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import config, metrics, routing
from millrace import types as mt
from millrace.functions import jsonx, partitions
from millrace.functions import timestamps as ts
from millrace.operators import consolidate, dlq, infer, unify, upsert
from millrace.operators.evolve import evolve
from millrace.session import read_table, scratch
from millrace.sources import arrow_ipc
from millrace.sources.table import Table
from millrace.streaming.stream import Sink, records

QUERIES: dict = {}
ORACLES: dict = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _folder(spark: SparkSession, what: str) -> str:
    return scratch(spark, what)


def _table(spark: SparkSession, what: str) -> Table:
    return Table(spark, _folder(spark, what))


# ---------------------------------------------------------------------------------------------- writes


@_query("SELECT *, true AS has_inserted_at FROM events")
def append_insert(spark: SparkSession, sf: str) -> DataFrame:
    """Append into a table that is created on the way, read back."""
    table = _table(spark, "append")
    table.write(read_table(spark, sf, "events"), auto_create=True)
    return table.read().withColumn("has_inserted_at", F.col("_inserted_at").isNotNull()).drop("_inserted_at")


def _orders(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    o = read_table(spark, sf, "orders")
    return o.where("o_orderkey % 10 < 7"), o.where("o_orderkey % 10 >= 5").withColumn("o_orderstatus", F.lit("U"))


@_query("""
WITH b AS (SELECT * FROM orders WHERE o_orderkey % 10 < 7),
     n AS (SELECT * REPLACE ('U' AS o_orderstatus) FROM orders WHERE o_orderkey % 10 >= 5)
SELECT * FROM n UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.o_orderkey = b.o_orderkey)""")
def upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Create, then upsert by key, through the table layer."""
    base, batch = _orders(spark, sf)
    table = _table(spark, "merge")
    table.write(base, keys=["o_orderkey"], auto_create=True)
    table.write(batch, keys=["o_orderkey"])
    return table.read().drop("_inserted_at")


@_query("""
WITH b AS (SELECT * FROM orders WHERE o_orderkey % 10 < 7),
     n AS (SELECT o_orderkey, o_orderpriority || '!' AS o_orderpriority FROM orders WHERE o_orderkey % 10 >= 5)
SELECT coalesce(b.o_orderkey, n.o_orderkey) AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       coalesce(n.o_orderpriority, b.o_orderpriority) AS o_orderpriority
FROM b FULL JOIN n ON b.o_orderkey = n.o_orderkey""")
def upsert_partial_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Stored columns the batch lacks keep their values."""
    o = read_table(spark, sf, "orders")
    batch = o.where("o_orderkey % 10 >= 5").select("o_orderkey", F.concat("o_orderpriority", F.lit("!")).alias("o_orderpriority"))
    return upsert.merge(o.where("o_orderkey % 10 < 7"), batch, ["o_orderkey"])


@_query("""
WITH b AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 < 7), n AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 >= 5)
SELECT * FROM b UNION ALL SELECT * FROM n WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)""")
def upsert_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    """Every column is a key: nothing to update, unknown keys are appended to the table."""
    base, batch = _orders(spark, sf)
    table = _table(spark, "keys")
    table.write(base.select("o_orderkey"), keys=["o_orderkey"], auto_create=True)
    table.write(batch.select("o_orderkey"), keys=["o_orderkey"])
    return table.read().drop("_inserted_at")


@_query("""
WITH d AS (SELECT l_orderkey, l_linenumber, max(l_quantity) AS q FROM lineitem GROUP BY ALL),
     b AS (SELECT * FROM d WHERE l_orderkey % 3 < 2),
     n AS (SELECT l_orderkey, l_linenumber, q + 100 AS q FROM d WHERE l_linenumber % 2 = 0)
SELECT * FROM n UNION ALL SELECT * FROM b WHERE NOT EXISTS
  (SELECT 1 FROM n WHERE n.l_orderkey = b.l_orderkey AND n.l_linenumber = b.l_linenumber)""")
def upsert_composite_key(spark: SparkSession, sf: str) -> DataFrame:
    """Two key columns; lines are grouped first, as they repeat their key."""
    d = read_table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"))
    batch = d.where("l_linenumber % 2 = 0").withColumn("q", F.col("q") + 100)
    return upsert.merge(d.where("l_orderkey % 3 < 2"), batch, ["l_orderkey", "l_linenumber"])


@_query("""
WITH c AS (SELECT *, CASE WHEN c_custkey % 10 <> 0 THEN c_custkey END AS k FROM customer),
     b AS (SELECT k, c_name FROM c WHERE c_mktsegment <> 'BUILDING'),
     n AS (SELECT k, c_name || '!' AS c_name FROM c WHERE c_acctbal > 0)
SELECT * FROM n UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.k = b.k)""")
def upsert_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Null keys never match: their rows are inserted each time, beside rows that are updated and new ones."""
    c = read_table(spark, sf, "customer").withColumn("k", F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey")))
    batch = c.where("c_acctbal > 0").select("k", F.concat("c_name", F.lit("!")).alias("c_name"))
    return upsert.merge(c.where("c_mktsegment <> 'BUILDING'").select("k", "c_name"), batch, ["k"])


@_query("SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1")
def upsert_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    """Of several rows of a key the last by order."""
    return upsert.last_wins(read_table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], ["o_orderkey"])


@_query("""
SELECT o_orderkey, o_orderkey % 10 < 7 AS kept, true AS has_inserted_at FROM orders""")
def inserted_at_preserved(spark: SparkSession, sf: str) -> DataFrame:
    """An update keeps the time a row was first inserted."""
    base, batch = _orders(spark, sf)
    old = F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")
    merged = upsert.merge(base.withColumn("_inserted_at", old), batch, ["o_orderkey"])
    return merged.select("o_orderkey", (F.col("_inserted_at") == old).alias("kept"), F.col("_inserted_at").isNotNull().alias("has_inserted_at"))


# ---------------------------------------------------------------------------------------------- schemas


@_query("""
SELECT r_regionkey, r_name, NULL::INTEGER AS n_nationkey FROM region UNION ALL
SELECT n_regionkey, n_name, n_nationkey FROM nation""")
def evolve_add_column(spark: SparkSession, sf: str) -> DataFrame:
    """A column that only later batches have reads as null in earlier rows."""
    table = _table(spark, "evolve")
    table.write(read_table(spark, sf, "region"), auto_create=True)
    n = read_table(spark, sf, "nation")
    table.write(n.select(F.col("n_regionkey").alias("r_regionkey"), F.col("n_name").alias("r_name"), "n_nationkey"))
    return table.read().drop("_inserted_at")


@_query("""
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey % 100 AS BIGINT) AS v FROM orders""")
def evolve_widen_int(spark: SparkSession, sf: str) -> DataFrame:
    """Integers widen in place: files written narrow are read wide."""
    o = read_table(spark, sf, "orders")
    table = _table(spark, "widen")
    table.write(o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").cast("int"), (F.col("o_custkey") % 100).cast("tinyint").alias("v")), auto_create=True)
    table.write(o.where("o_orderkey % 2 = 1").select("o_orderkey", (F.col("o_custkey") % 100).cast("bigint").alias("v")))
    return table.read().drop("_inserted_at")


@_query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) ELSE o_totalprice END AS price FROM orders")
def evolve_widen_float(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    table = _table(spark, "widenf")
    table.write(o.where("o_orderkey % 2 = 0").select("o_orderkey", F.col("o_totalprice").cast("float").alias("price")), auto_create=True)
    table.write(o.where("o_orderkey % 2 = 1").select("o_orderkey", F.col("o_totalprice").alias("price")))
    return table.read().drop("_inserted_at")


@_query("""
SELECT * FROM (VALUES ('TINYINT', 'BIGINT', 'widen'), ('BIGINT', 'SMALLINT', 'keep'), ('FLOAT', 'DOUBLE', 'widen'), ('DOUBLE', 'FLOAT', 'keep'),
  ('INTEGER', 'DOUBLE', 'reject'), ('VARCHAR', 'INTEGER', 'reject'), ('JSON', 'VARCHAR', 'reject'), ('DATE', 'TIMESTAMP', 'reject'), ('VARCHAR', 'VARCHAR', 'keep')) t(stored, incoming, decision)""")
def evolve_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """What becomes of a column whose stored and incoming types differ."""
    pairs = [("int8", "int64"), ("int64", "int16"), ("float32", "float64"), ("float64", "float32"), ("int32", "float64"), ("string", "int32"), ("json", "string"), ("date", "timestamp"), ("string", "string")]
    rows = []
    for a, b in pairs:
        try:
            _, changes = evolve(T.StructType([mt.field("c", a), mt.field(mt.SYSTEM_COLUMN, "timestamp")]), T.StructType([mt.field("c", b)]))
            rows.append((mt.STORED[a], mt.STORED[b], "widen" if changes else "keep"))
        except ValueError:
            rows.append((mt.STORED[a], mt.STORED[b], "reject"))
    return spark.createDataFrame(rows, "stored string, incoming string, decision string")


@_query("""
SELECT NULL::INTEGER AS n_nationkey, NULL::VARCHAR AS n_name, NULL::INTEGER AS n_regionkey, r_name, r_regionkey FROM region UNION ALL
SELECT n_nationkey, n_name, n_regionkey, NULL, NULL FROM nation""")
def unify_by_name(spark: SparkSession, sf: str) -> DataFrame:
    return unify.union([read_table(spark, sf, "region"), read_table(spark, sf, "nation")])


@_query("""
SELECT CAST(o_orderkey AS FLOAT) AS a, CAST(o_custkey AS BIGINT) AS b, CAST(o_totalprice AS DOUBLE) AS c FROM orders UNION ALL
SELECT CAST(n_nationkey AS FLOAT), CAST(n_regionkey AS BIGINT), CAST(n_nationkey AS DOUBLE) FROM nation UNION ALL
SELECT CAST(r_regionkey AS FLOAT), CAST(r_regionkey > 2 AS BIGINT), CAST(r_regionkey AS DOUBLE) FROM region""")
def unify_promote_numeric(spark: SparkSession, sf: str) -> DataFrame:
    """INT64 with FLOAT is FLOAT, BOOLEAN and INT32 with INT64 is INT64, anything with DOUBLE is DOUBLE."""
    o = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("a"), F.col("o_custkey").alias("b"), F.col("o_totalprice").alias("c"))
    n = read_table(spark, sf, "nation").select(F.col("n_nationkey").cast("float").alias("a"), F.col("n_regionkey").alias("b"), F.col("n_nationkey").alias("c"))
    r = read_table(spark, sf, "region").select(F.col("r_regionkey").cast("smallint").alias("a"), (F.col("r_regionkey") > 2).alias("b"), F.col("r_regionkey").cast("float").alias("c"))
    return unify.union([o, n, r])


@_query("SELECT event_type AS a, count(DISTINCT event_id % 5) AS n FROM events GROUP BY ALL")
def distinct_schemas(spark: SparkSession, sf: str) -> DataFrame:
    """Schemas per topic of a batch of JSON records: key order and values don't count, types at any depth do."""
    i = F.col("event_id").cast("string")
    shapes = [F.concat(F.lit('{"a":'), i, F.lit(',"b":"x"}')), F.concat(F.lit('{"a":"'), i, F.lit('"}')), F.concat(F.lit('{"a":{"c":'), i, F.lit("}}")), F.concat(F.lit('{"a":{"c":['), i, F.lit(".5]}}")), F.lit('{"a":true}')]
    text = shapes[0]
    for k in range(1, 5):
        text = F.when(F.col("event_id") % 5 == k, shapes[k]).otherwise(text)
    e = read_table(spark, sf, "events").select("event_type", text.alias("v"))
    return infer.signatures(e, "v", ["event_type"]).distinct().groupBy(F.col("event_type").alias("a")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------------------------- records


@_query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def infer_json_props(spark: SparkSession, sf: str) -> DataFrame:
    """JSON text to typed columns by an inferred schema."""
    e = read_table(spark, sf, "events")
    return infer.parse(e, "props", infer.infer(e, "props"), ["event_id"])


def _iso_cases(spark: SparkSession, sf: str) -> DataFrame:
    text = (
        F.when(F.col("event_id") % 5 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("event_id") % 5 == 1, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+03:00")))
        .when(F.col("event_id") % 5 == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("event_id") % 5 == 3, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .otherwise(F.col("event_type"))
    )
    return read_table(spark, sf, "events").select("event_id", text.alias("s"), "ts")


@_query("SELECT event_id, event_id % 5 IN (0, 1, 3) AS is_ts FROM events")
def detect_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return _iso_cases(spark, sf).select("event_id", ts.is_timestamp("s").alias("is_ts"))


@_query("""
SELECT event_id, CASE event_id % 5 WHEN 0 THEN epoch_us(date_trunc('second', ts)) // 1000
  WHEN 1 THEN epoch_us(date_trunc('second', ts)) // 1000 - 10800000 WHEN 3 THEN epoch_us(ts) // 1000 END AS epoch_ms FROM events""")
def parse_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return _iso_cases(spark, sf).select("event_id", ts.epoch_millis("s").alias("epoch_ms"))


@_query("""
SELECT event_id, CASE event_id % 3 WHEN 0 THEN make_timestamp(epoch_us(ts) // 1000 * 1000) WHEN 1 THEN make_timestamp(epoch_us(ts) // 1000 * 1000) END AS cell FROM events""")
def coerce_timestamp_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Raw values into a timestamp column: milliseconds, ISO text, and text that isn't one."""
    e = read_table(spark, sf, "events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    text = F.when(F.col("event_id") % 3 == 1, iso).otherwise(F.col("event_type"))
    cell = F.when(F.col("event_id") % 3 == 0, ts.to_timestamp(F.floor(ts.micros("ts") / 1000), "bigint")).otherwise(ts.to_timestamp(text, "string"))
    return e.select("event_id", cell.alias("cell"))


@_query(r"""
WITH names AS (SELECT c_name || '_id' AS n FROM customer UNION ALL SELECT p_name FROM part UNION ALL SELECT c_mktsegment || 'KEY' FROM customer UNION ALL SELECT s_name || 'Uuid' FROM supplier)
SELECT n, regexp_matches(lower(n), '(id|key)$') AS id_like FROM names""")
def id_like_names(spark: SparkSession, sf: str) -> DataFrame:
    c, p, s = (read_table(spark, sf, t) for t in ("customer", "part", "supplier"))
    n = c.select(F.concat("c_name", F.lit("_id")).alias("n")).union(p.select("p_name")).union(c.select(F.concat("c_mktsegment", F.lit("KEY")))).union(s.select(F.concat("s_name", F.lit("Uuid"))))
    return n.select("n", ts.is_id_like("n").alias("id_like"))


@_query("SELECT n_nationkey, CAST(to_json({'key': n_nationkey, 'name': nullif(n_name, 'CHINA'), 'in': {'region': n_regionkey}}) AS VARCHAR) AS payload FROM nation")
def struct_to_json(spark: SparkSession, sf: str) -> DataFrame:
    s = F.struct(F.col("n_nationkey").alias("key"), F.nullif("n_name", F.lit("CHINA")).alias("name"), F.struct(F.col("n_regionkey").alias("region")).alias("in"))
    return read_table(spark, sf, "nation").select("n_nationkey", jsonx.to_json(s).alias("payload"))


@_query("SELECT o_orderkey, CAST(to_json([o_orderkey, o_custkey, NULL]) AS VARCHAR) AS payload FROM orders")
def list_to_json(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "orders").select("o_orderkey", jsonx.to_json(F.array("o_orderkey", "o_custkey", F.lit(None).cast("bigint"))).alias("payload"))


@_query("SELECT s_suppkey, CAST(to_json(MAP {'a': s_name, 'b': CAST(s_nationkey AS VARCHAR)}) AS VARCHAR) AS payload FROM supplier")
def map_to_json(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "supplier").select("s_suppkey", jsonx.to_json(F.create_map(F.lit("a"), F.col("s_name"), F.lit("b"), F.col("s_nationkey").cast("string"))).alias("payload"))


@_query("""
SELECT CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, CAST(day(ts) AS INTEGER) AS d, event_type, count(*) AS n FROM events GROUP BY ALL""")
def partition_transforms(spark: SparkSession, sf: str) -> DataFrame:
    parts = partitions.parse("year(ts), month(ts), day(ts), event_type")
    names = ["y", "m", "d", "event_type"]
    return read_table(spark, sf, "events").groupBy(*[p.expression().cast("string" if n == "event_type" else "int").alias(n) for p, n in zip(parts, names, strict=True)]).agg(F.count(F.lit(1)).alias("n"))


@_query("SELECT event_id, ts, event_type FROM events WHERE year(ts) = 2024 AND month(ts) = 1 AND event_type = 'click'")
def partition_pruned_read(spark: SparkSession, sf: str) -> DataFrame:
    """A table partitioned by hidden columns, read by partition values: only these files are opened."""
    table = _table(spark, "parts")
    table.write(read_table(spark, sf, "events"), auto_create=True, partition_by="year(ts), month(ts), event_type")
    return table.read(where={"year(ts)": 2024, "month(ts)": 1, "event_type": "click"}).select("event_id", "ts", "event_type")


@_query("SELECT event_type, CAST(user_id % 4 AS INTEGER) AS p, count(*) AS n, CAST(sum(strlen(props)) AS BIGINT) AS n_bytes FROM events GROUP BY ALL")
def group_by_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and bytes by topic and partition."""
    return consolidate.buffers(read_table(spark, sf, "events"), "event_type", (F.col("user_id") % 4).cast("int"), "props").withColumnRenamed("topic", "event_type")


@_query("""
SELECT p, b, count(*) AS n FROM (
  SELECT user_id % 4 AS p, CAST((row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1) // 500 AS BIGINT) AS b FROM events) GROUP BY p, b""")
def flush_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by flush of 500 records in order of their offsets."""
    e = read_table(spark, sf, "events").select("event_id", "user_id")
    return consolidate.flush_batches(e, F.col("user_id") % 4, "event_id", 500).groupBy("p", "b").agg(F.count(F.lit(1)).alias("n"))


@_query("""
SELECT topic, CASE WHEN n >= 1000 THEN 'record_count' WHEN b >= 80000 THEN 'file_size' WHEN age >= 20000000000 THEN 'time' WHEN b > 50000 THEN 'memory_pressure' END AS reason
FROM (SELECT topic, count(*) AS n, sum(octet_length(encode(record_value))) AS b, epoch_ms(max(delivered_at)) - epoch_ms(min(delivered_at)) AS age FROM sink_records WHERE topic IS NOT NULL GROUP BY topic)""")
def flush_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """Why each topic's buffer would be flushed: by its records, bytes and age, memory pressure last."""
    at = ts.micros("delivered_at")
    s = read_table(spark, sf, "sink_records").where("topic IS NOT NULL").groupBy("topic").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("record_value")).alias("b"), (F.floor(F.max(at) / 1000) - F.floor(F.min(at) / 1000)).alias("age"))
    return s.select("topic", consolidate.flush_reason(F.col("n"), F.col("b"), F.col("age"), 1000, 80_000, 20_000_000_000, F.col("b") > 50_000).alias("reason"))


@_query("""
WITH x AS (SELECT user_id, event_id, event_type AS sig, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events),
     y AS (SELECT *, sum(CASE WHEN p IS NULL OR p <> sig THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS run_id FROM x)
SELECT user_id, CAST(run_id AS BIGINT) AS run_id, min(sig) AS sig, count(*) AS n_rows, min(event_id) AS first_id FROM y GROUP BY user_id, run_id""")
def consolidate_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Contiguous rows of one schema, per partition of the log."""
    return consolidate.consolidated(read_table(spark, sf, "events").select("user_id", "event_id", "event_type"), "event_id", "event_type", ["user_id"])


@_query("""
SELECT event_id, CASE event_type WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'page_views' ELSE event_type END AS table_name FROM events""")
def route_topics(spark: SparkSession, sf: str) -> DataFrame:
    routes = routing.parse("click:clicks, view:page_views")
    return read_table(spark, sf, "events").select("event_id", routing.route("event_type", routes).alias("table_name"))


@_query("""
SELECT CAST(o AS BIGINT) AS o, CASE WHEN o % 10 = 3 THEN NULL ELSE CAST(v AS DOUBLE) END AS value, o % 10 = 3 AS is_bad FROM (SELECT event_id AS o, value AS v FROM events)""")
def dlq_split(spark: SparkSession, sf: str) -> DataFrame:
    """Records whose value isn't of the wanted type are separated; the others are typed."""
    e = read_table(spark, sf, "events")
    text = F.when(F.col("event_id") % 10 == 3, F.concat(F.lit('{"value":"bad '), "event_id", F.lit('"}'))).otherwise(F.to_json(F.struct("value")))
    schema = T.StructType([T.StructField("value", T.DoubleType())])
    good, bad = dlq.split(e.select(F.col("event_id").alias("o"), text.alias("v")), "v", schema, ["o"])
    typed = infer.parse(good, "v", schema, ["o"]).select("o", "value", F.lit(False).alias("is_bad"))
    return typed.unionByName(bad.select("o", F.lit(None).cast("double").alias("value"), F.lit(True).alias("is_bad")))


@_query("""
SELECT delivery_id, CASE WHEN json_valid(record_value) AND json_type(record_value) = 'OBJECT' AND json_type(record_value, '$.id') <> 'NULL' THEN json_extract_string(record_value, '$.id') END AS id FROM sink_records""")
def null_records(spark: SparkSession, sf: str) -> DataFrame:
    """A null value is a row of nulls, not a delete; no row is lost."""
    s = read_table(spark, sf, "sink_records").select("delivery_id", "record_value")
    return infer.parse(s, "record_value", T.StructType([mt.field("id", "string")]), ["delivery_id"])


# ---------------------------------------------------------------------------------------------- streams and formats


@_query("SELECT * FROM events")
def arrow_ipc_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Rows to IPC payloads of 1000 rows and back."""
    e = read_table(spark, sf, "events")
    return arrow_ipc.read(arrow_ipc.pack(e, 1000), "payload", e.schema)


@_query("SELECT event_id, user_id, event_type, value FROM events")
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of JSON records in files, in micro-batches, into one table; then the table."""
    base = _folder(spark, "stream")
    e = read_table(spark, sf, "events")
    payload = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    rec = e.select(F.lit("events_in").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"), payload.cast("binary").alias("value"))
    rec.repartition(8).write.parquet(f"{base}/in")
    c = config.parse({"data_path": f"{base}/tables", "topic2table.map": "events_in:events", "table.events.auto-create": "true"})
    sink = Sink(spark, c, "ingest")
    query = sink.start(records(spark, "parquet", f"{base}/in", {"maxFilesPerTrigger": "4"}), f"{base}/checkpoint", once=True)
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return sink.catalog.table("events").read().select(F.col("event_id").cast("bigint"), F.col("user_id").cast("bigint"), "event_type", F.col("value").cast("double"))


@_query("""
SELECT op, count(*) AS n, CAST(sum(v) AS BIGINT) AS total, CAST(sum(v) AS DOUBLE) / count(*) AS avg_value, max(v) AS max_value
FROM (SELECT event_type AS op, event_id % 1000 AS v FROM events) GROUP BY op""")
def metrics_rollup(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events").select("event_type", (F.col("event_id") % 1000).alias("v"))
    return metrics.rollup(e, "event_type", "v")


@_query("SELECT event_id, event_type || ' ' || event_id AS shown FROM events")
def describe_values(spark: SparkSession, sf: str) -> DataFrame:
    """Values on one line, for messages."""
    return read_table(spark, sf, "events").select("event_id", jsonx.describe_column(F.concat_ws("\n", "event_type", F.col("event_id").cast("string"))).alias("shown"))


# ---------------------------------------------------------------------------------------------- smaller parts


@_query("SELECT n_nationkey, n_name, CAST(NULL AS DOUBLE) AS score, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation")
def null_fill_and_cast(spark: SparkSession, sf: str) -> DataFrame:
    """A batch under a wider schema: absent columns null, narrower numbers cast, the table's own column dropped."""
    schema = T.StructType([mt.field("n_nationkey", "int32"), mt.field("n_name", "string"), mt.field("score", "float64"), mt.field("n_regionkey", "int64")])
    return unify.project(read_table(spark, sf, "nation").withColumn("_inserted_at", F.current_timestamp()), schema)


@_query("SELECT event_id, CAST(event_id AS VARCHAR) AS a, CAST(user_id AS SMALLINT) AS b, CAST(value AS FLOAT) AS c, CAST(user_id AS DOUBLE) AS d FROM events")
def numeric_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers into columns of other widths, and into text."""
    e = read_table(spark, sf, "events").select("event_id", F.col("event_id").alias("a"), F.col("user_id").alias("b"), F.col("value").alias("c"), F.col("user_id").alias("d"))
    return unify.project(e, T.StructType([mt.field("event_id", "int64"), mt.field("a", "string"), mt.field("b", "int16"), mt.field("c", "float32"), mt.field("d", "float64")]))


@_query("SELECT o_orderkey, o_orderpriority AS first_code, CAST(2 AS INTEGER) AS n_errors FROM orders")
def array_of_objects(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays of JSON objects with differing keys, as one element type."""
    text = F.concat(F.lit('{"errors":[{"code":"'), "o_orderpriority", F.lit('"},{"field":"x","n":1}]}'))
    o = read_table(spark, sf, "orders").select("o_orderkey", text.alias("v"))
    rows = infer.parse(o, "v", infer.infer(o, "v"), ["o_orderkey"])
    return rows.select("o_orderkey", F.col("errors")[0]["code"].alias("first_code"), F.size("errors").alias("n_errors"))


@_query("""
SELECT * FROM (VALUES ('int8', 'TINYINT'), ('int16', 'SMALLINT'), ('int32', 'INTEGER'), ('int64', 'BIGINT'), ('float32', 'FLOAT'), ('float64', 'DOUBLE'), ('boolean', 'BOOLEAN'),
  ('string', 'VARCHAR'), ('bytes', 'BLOB'), ('Timestamp', 'TIMESTAMP'), ('Date', 'DATE'), ('Time', 'TIME'), ('struct', 'JSON'), ('array', 'JSON'), ('map', 'JSON')) t(incoming, stored)""")
def type_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """The stored type of every type a record's schema may have."""
    item = {"type": "string"}
    more = {"struct": {"fields": [{"field": "x", **item}]}, "array": {"items": item}, "map": {"keys": item, "values": item}}
    rows = []
    for t in ("int8", "int16", "int32", "int64", "float32", "float64", "boolean", "string", "bytes", "struct", "array", "map"):
        rows.append((t, mt.stored_name(mt.connect_field({"type": t, **more.get(t, {})}, "c"))))
    for t, base in (("Timestamp", "int64"), ("Date", "int32"), ("Time", "int32")):
        rows.append((t, mt.stored_name(mt.connect_field({"type": base, "name": f"data.{t}"}, "c"))))
    return spark.createDataFrame(rows, "incoming string, stored string")


@_query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def replayed_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A micro-batch delivered again is a no-op."""
    table = _table(spark, "replay")
    c = read_table(spark, sf, "customer")
    for _ in range(2):
        table.write(c, auto_create=True, stream="s", batch=7)
    return table.read().drop("_inserted_at")


@_query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1995-03-01' AND TIMESTAMP '1995-09-30'")
def range_pruned_read(spark: SparkSession, sf: str) -> DataFrame:
    """A range of a column bounds its year partitions too."""
    table = _table(spark, "range")
    table.write(read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), auto_create=True, partition_by="year(o_orderdate)")
    return table.read(ranges={"o_orderdate": (datetime(1995, 3, 1), datetime(1995, 9, 30))}).drop("_inserted_at")


@_query("SELECT event_id, user_id, event_type FROM events")
def mixed_formats(spark: SparkSession, sf: str) -> DataFrame:
    """Records of both formats in one group: batches of rows and JSON texts are each decoded, none is dropped."""
    e = read_table(spark, sf, "events").select("event_id", "user_id", "event_type")
    texts = e.where("event_id % 3 <> 0").select(F.to_json(F.struct("*")).cast("binary").alias("v"))
    both = texts.union(arrow_ipc.pack(e.where("event_id % 3 = 0"), 100))
    payloads, rest = arrow_ipc.split_formats(both, "v")
    rest = rest.select(F.col("v").cast("string").alias("v"))
    return unify.union([arrow_ipc.read(payloads, "v"), infer.parse(rest, "v", infer.infer(rest, "v"))])


@_query("""
SELECT CAST(list_aggregate(list(event_type || ':' || p || '@' || event_id ORDER BY event_type, p, event_id), 'string_agg', ', ') AS VARCHAR) AS sample
FROM (SELECT event_type, user_id % 4 AS p, event_id FROM events ORDER BY 1, 2, 3 LIMIT 10)""")
def first_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """The first ten places of bad records, for an error text (the limit is the feature)."""
    e = read_table(spark, sf, "events").select(F.col("event_type").alias("topic"), (F.col("user_id") % 4).alias("partition"), F.col("event_id").alias("offset"))
    text = dlq.offsets_sample(e)
    return spark.createDataFrame([(text.removesuffix(" (truncated)")[1:-1],)], "sample string")
