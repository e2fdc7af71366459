"""The ingestion operators on their rules, with nulls, ties, repeats, empty input and odd names."""

import json
from datetime import date, datetime, timezone
from datetime import time as clock_time

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import config, metrics, routing
from millrace import types as mt
from millrace.functions import idents, jsonx, partitions
from millrace.functions import timestamps as ts
from millrace.operators import consolidate, dlq, evolve, infer, unify, upsert
from millrace.sources import arrow_ipc
from millrace.sources.store import check_location
from millrace.sources.table import Catalog, Table, TableMissing
from millrace.streaming.stream import Sink, records


def struct(**kinds):
    return T.StructType([mt.field(n, k) for n, k in kinds.items()])


# ------------------------------------------------------------------------------------------ names, options, routes


@pytest.mark.parametrize(("name", "want"), [("a", "a"), ("_x1", "_x1"), ("1a", "`1a`"), ("a b", "`a b`"), ("a`b", "`a``b`"), ("", "``"), ("é", "`é`")])
def test_quote(name, want):
    assert idents.quote(name) == want


def test_quote_refuses_null():
    with pytest.raises(ValueError):
        idents.quote(None)


def test_config_defaults_and_tables():
    c = config.parse({"sink.data_path": "s3://bucket/x", "sink.s3.endpoint": "e", "sink.s3.url_style": "path", "sink.table.t.id-columns": " a , ,b", "table.t.partition-by": "year(at), status", "table.a.b.auto-create": "true", "task.id": "3"})
    assert c["flush.size"] == 1_000_000 and c["file.size.bytes"] == 268_435_456 and c["flush.interval.ms"] == 60_000 and c["max_retry_count"] == 10 and c["data.inlining.row.limit"] == 10_000
    assert c.table("t") == config.TableOptions(("a", "b"), ("year(at)", "status"), False)
    assert c.table("a.b").auto_create and not c.table("none").auto_create
    assert c.hadoop() == {"fs.s3a.endpoint": "e", "fs.s3a.path.style.access": "true"}
    assert [x["task.id"] for x in c.task_configs(2, {})] == ["0", "1"]
    assert config.parse({"data_path": "/x", "data.inlining.row.limit": "off"})["data.inlining.row.limit"] is None
    assert config.parse({"data_path": "/x", "s3.endpoint": "e"}).hadoop() == {}


@pytest.mark.parametrize("options", [{}, {"data_path": "/x", "nope": "1"}, {"data_path": "/x", "flush.size": "0"}, {"data_path": "/x", "flush.size": "many"}, {"data_path": "/x", "data.inlining.row.limit": "-1"}, {"data_path": "ftp://x"}, {"data_path": "/x", "spill.enabled": "maybe"}])
def test_config_refuses(options):
    with pytest.raises(ValueError):
        config.parse(options)


@pytest.mark.parametrize("path", ["s3://bucket", "s3a://bucket/a", "gs://b/x", "file:///tmp/x", "/tmp/x", "hdfs://n:9000/x"])
def test_locations(path):
    assert check_location(path) == path


@pytest.mark.parametrize("path", ["", None, "s3://", "http://x", "file://x", "relative/x", "s3:///x"])
def test_bad_locations(path):
    with pytest.raises(ValueError):
        check_location(path)


def test_routes(spark):
    routes = routing.parse(" topic1:table1, topic2:table-2 ")
    assert routes == {"topic1": "table1", "topic2": "table-2"} and routing.parse(" ") == {} and routing.parse(None) == {}
    assert routing.table_of("other", routes) == "other"
    got = spark.createDataFrame([("topic1",), ("x",), (None,)], "t string").select(routing.route("t", routes)).collect()
    assert [r[0] for r in got] == ["table1", "x", None]


@pytest.mark.parametrize("text", ["a", "a:b:c", "a:1x", "a:b,a:c", "a:b,c:b", "a:b,,", ":b", "a:"])
def test_bad_routes(text):
    with pytest.raises(ValueError):
        routing.parse(text)


# ------------------------------------------------------------------------------------------ functions


def test_timestamp_columns(spark):
    cases = {"2025-09-25T18:05:12Z": 1758823512000, "2025-09-25T18:05:12+0300": 1758812712000, " 2025-09-25T18:05:12.123456789Z ": 1758823512123, "2025-09-25T18:05:12": 1758823512000, "2025-09-25 18:05:12": None, "2025-13-25T18:05:12Z": None, "2025-02-30T00:00:00Z": None, "2025-01-01T24:00:00Z": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "s string").select("s", ts.is_timestamp("s").alias("is"), ts.epoch_millis("s").alias("ms"), ts.to_timestamp("s", "string").alias("cell"))
    for r in df.collect():
        assert r.ms == cases[r.s] and r["is"] == (cases[r.s] is not None), r
    with pytest.raises(Exception, match="not a timestamp"):
        spark.createDataFrame([("x",)], "s string").select(ts.require_epoch_millis("s")).collect()


def test_python_and_columns_agree_on_iso(spark):
    from millrace.functions import clock

    texts = [f"20{y:02d}-{m:02d}-{d:02d}T{h:02d}:{mi}:{s}{z}" for y in (1, 24) for m in (2, 12, 13) for d in (0, 29, 31) for h in (0, 23, 24) for mi in (59, 60) for s in ("07", "60", "07.5") for z in ("", "Z", "+05:30", "-0330", "+18:00", "+18:01", "+05:60")]
    df = spark.createDataFrame([(t,) for t in texts], "s string").select("s", ts.epoch_millis("s").alias("ms"))
    for r in df.collect():
        us = clock.iso_micros(r.s)
        assert r.ms == (None if us is None else us // 1000), r.s


def test_id_like(spark):
    names = {"distinct_id": True, "user_id": True, "event_uuid": True, "api_key": True, "SessionID": True, "paid": True, "monkey": True, "actual_timestamp": False, "": False, None: False}
    for r in spark.createDataFrame([(k,) for k in names], "n string").select("n", ts.is_id_like("n").alias("i")).collect():
        assert r.i == names[r.n]


def test_json_text_and_descriptions(spark):
    df = spark.sql("select named_struct('a', cast(null as int), 'b', timestamp_ntz'2024-01-02 03:04:05.006') as s, cast(null as array<int>) as l")
    r = df.select(jsonx.to_json("s").alias("s"), jsonx.to_json("l").alias("l")).first()
    assert r.s == '{"a":null,"b":"2024-01-02 03:04:05.006"}' and r.l is None
    assert jsonx.describe(b"abc") == "byte[3]" and jsonx.describe("a\r\nb") == "a b" and len(jsonx.describe("x" * 9999)) == 512
    got = spark.createDataFrame([("a\nb",), ("x" * 9999,), (None,)], "v string").select(jsonx.describe_column("v")).collect()
    assert got[0][0] == "a b" and len(got[1][0]) == 512 and got[2][0] is None


def test_partition_expressions():
    p = partitions.parse("year(created_at), MONTH( created_at ),status")
    assert [(x.transform, x.column) for x in p] == [("year", "created_at"), ("month", "created_at"), (None, "status")]
    assert partitions.split_list("a, f(b, c), `x,y`, ") == ["a", "f(b, c)", "`x,y`"] and partitions.parse(None) == []
    with pytest.raises(ValueError):
        partitions.parse("bucket(4, id)")


# ------------------------------------------------------------------------------------------ types, unification, evolution


def test_connect_schemas():
    s = mt.connect_schema({"type": "struct", "fields": [{"field": "id", "type": "int64", "optional": False}, {"field": "at", "type": "int64", "name": "a.b.Timestamp"}, {"field": "d", "type": "int32", "name": "a.b.Date"}, {"field": "t", "type": "int32", "name": "a.b.Time"}, {"field": "e", "type": "struct", "fields": []}, {"field": "l", "type": "array", "items": {"type": "struct", "fields": []}}, {"field": "m", "type": "map", "keys": {"type": "string"}, "values": {"type": "int32"}}]})
    assert [f.name for f in s.fields] == ["id", "at", "d", "t", "l", "m"] and not s["id"].nullable
    assert [mt.stored_name(f) for f in s.fields] == ["BIGINT", "TIMESTAMP", "DATE", "TIME", "JSON", "JSON"]
    assert [mt.kind(f) for f in mt.at_rest(s).fields] == ["int64", "timestamp", "date", "time", "json", "json"]
    with pytest.raises(ValueError):
        mt.kind(T.StructField("x", T.DecimalType(10, 2)))
    with pytest.raises(ValueError):
        mt.connect_schema({"type": "struct", "fields": [{"field": "x", "type": "decimal"}]})


RULES = [
    (["int8", "int16"], "int32"), (["boolean", "int8"], "int32"), (["int32", "int64"], "int64"), (["int64", "float32"], "float32"), (["int64", "float64"], "float64"), (["float32", "float64"], "float64"),
    (["timestamp", "date"], "timestamp"), (["timestamp", "time"], "timestamp"), (["time", "date"], "time"), (["string"], "string"),
    (["string", "timestamp"], None), (["string", "date"], None), (["string", "time"], None), (["string", "int32"], None), (["boolean", "string"], None), (["bytes", "string"], None), (["json", "string"], None),
]


@pytest.mark.parametrize(("kinds", "want"), RULES)
def test_unify_rules(kinds, want):
    fields = [mt.field("f", k) for k in kinds]
    if want is None:
        with pytest.raises(unify.SchemaConflict, match="Cannot unify incompatible types for field 'f'"):
            unify.unify_fields("f", fields, {"string": "x"})
    else:
        assert mt.kind(unify.unify_fields("f", fields)) == want


_KINDS = st.sampled_from(sorted(mt.STORED))


@given(st.lists(_KINDS, min_size=1, max_size=5))
def test_unify_does_not_depend_on_order(kinds):
    def join(ks):
        try:
            return mt.kind(unify.unify_fields("f", [mt.field("f", k) for k in ks]))
        except unify.SchemaConflict:
            return None

    assert join(kinds) == join(kinds[::-1]) == join([*kinds, *kinds])


def test_unify_nested_and_order():
    a = T.StructType([T.StructField("z", T.IntegerType(), False), T.StructField("address", T.StructType([T.StructField("street", T.StringType()), T.StructField("city", T.StringType())]))])
    b = T.StructType([T.StructField("address", T.StructType([T.StructField("street", T.StringType()), T.StructField("zipcode", T.LongType())]))])
    assert unify.unify_schemas([a]) is a
    u = unify.unify_schemas([a, b])
    assert u.fieldNames() == ["address", "z"] and u["address"].dataType.fieldNames() == ["city", "street", "zipcode"] and u["z"].nullable
    with pytest.raises(unify.SchemaConflict):
        unify.unify_schemas([a, struct(address="string")])
    with pytest.raises(ValueError, match="No valid schemas"):
        unify.unify_schemas([])
    assert unify.same(a, a) and not unify.same(a, T.StructType(a.fields[::-1])) and unify.same(a, T.StructType(a.fields[::-1]), ordered=False)
    assert unify.add_field(struct(b="int32"), mt.field("a", "int8")).fieldNames() == ["a", "b"] and unify.remove_field(struct(a="int8", b="int8"), "a").fieldNames() == ["b"]


def test_union_casts_explicitly(spark):
    a = spark.createDataFrame([(1, (None, 2), [1])], "a int, s struct<x:string,y:int>, l array<int>")
    b = spark.createDataFrame([(True, (5, "z"), [None])], "a boolean, s struct<y:bigint,w:string>, l array<bigint>")
    rows = unify.union([a, b]).orderBy("a", F.size("l")).collect()
    assert {(r.a, r.s.y, r.s.w, tuple(r.l)) for r in rows} == {(1, 2, None, (1,)), (1, 5, "z", (None,))}
    assert unify.union([a.limit(0), b.limit(0)]).count() == 0


@pytest.mark.parametrize(("old", "new", "want"), [("int8", "int64", "widen"), ("int64", "int8", "keep"), ("float32", "float64", "widen"), ("float64", "float32", "keep"), ("int32", "float64", "reject"), ("string", "int32", "reject"), ("json", "string", "reject"), ("string", "json", "reject"), ("date", "timestamp", "reject"), ("json", "json", "keep")])
def test_evolution(old, new, want):
    assert evolve.decide(old, new) == want


def test_evolve_schema():
    s, changes = evolve.evolve(struct(Id="int32", gone="string"), T.StructType([mt.field("ID", "int64"), mt.field("_INSERTED_AT", "string"), T.StructField("n", T.ArrayType(T.IntegerType()))]))
    assert [(f.name, mt.kind(f)) for f in s.fields] == [("Id", "int64"), ("gone", "string"), ("n", "json"), ("_inserted_at", "timestamp")]
    assert [c.action for c in changes] == ["widen", "add", "add"]
    with pytest.raises(evolve.IncompatibleType, match="Incompatible type for column c"):
        evolve.evolve(struct(c="string"), struct(c="int32"))


# ------------------------------------------------------------------------------------------ inference


def test_inference(spark):
    rows = ['{"id": 99, "name": "eve", "at": "2025-01-01T00:00:00Z", "event_id": "2025-01-01T00:00:00Z", "big": 3000000000, "f": 1.5, "nothing": null, "none": [], "l": [{"a": 1}, {"b": "x"}], "e": {}, "s": {"deep": {"x": true}}}', '{"id": 1, "f": 2, "big": 1, "tags": [null, "2025-01-01T00:00:00Z"]}', None, "17", "{broken", "[1]"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "k int, v string")
    s = infer.infer(df, "v")
    assert {f.name: f.dataType.simpleString() for f in s.fields} == {"at": "timestamp_ntz", "big": "bigint", "event_id": "string", "f": "double", "id": "int", "l": "array<struct<a:int,b:string>>", "name": "string", "s": "struct<deep:struct<x:boolean>>", "tags": "array<timestamp_ntz>"}
    got = {r.k: r for r in infer.parse(df, "v", s, ["k"]).collect()}
    assert len(got) == 6 and got[0].at == datetime(2025, 1, 1) and got[0].l[1].b == "x" and got[1].tags == [None, datetime(2025, 1, 1)]
    assert got[2].id is None and got[4].id is None and got[3].name is None
    with pytest.raises(ValueError, match="No valid schemas"):
        infer.infer(df.where("k > 1"), "v")


@pytest.mark.parametrize("pair", [('{"value": 42}', '{"value": "x"}'), ('{"a": {"b": {"c": 1}}}', '{"a": {"b": "x"}}'), ('{"f": true}', '{"f": "x"}'), ('{"t": "2025-01-01T00:00:00Z"}', '{"t": "x"}')])
def test_inference_conflicts(spark, pair):
    df = spark.createDataFrame([(p,) for p in pair], "v string")
    with pytest.raises(unify.SchemaConflict, match="Sample values"):
        infer.infer(df, "v")


_JSON = st.recursive(st.none() | st.booleans() | st.integers(-(2**40), 2**40) | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=5), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.sampled_from("abc"), c, max_size=3), max_leaves=8)


@given(_JSON, _JSON, _JSON)
def test_fold_is_associative_and_commutative(a, b, c):
    x, y, z = map(infer.observe, (a, b, c))
    assert infer._ordered(infer.fold(infer.fold(x, y), z)) == infer._ordered(infer.fold(x, infer.fold(y, z)))
    assert infer._ordered(infer.fold(x, y)) == infer._ordered(infer.fold(y, x))
    assert infer._ordered(infer.fold(x, x)) == infer._ordered(x)


# ------------------------------------------------------------------------------------------ upserts and tables


_ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.integers(0, 9))), max_size=8)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(_ROWS, _ROWS, st.booleans())
def test_upsert_equals_a_dictionary(spark, base, batch, small):
    base = list({k: (k, v) for k, v in base if k is not None}.values()) + [r for r in base if r[0] is None]
    b = spark.createDataFrame([(k, v, "old") for k, v in base], "k int, v int, only_base string")
    n = spark.createDataFrame([(v, k, i) for i, (k, v) in enumerate(batch)], "v int, K int, at int")
    n = upsert.last_wins(n, ["K"], ["at"]).drop("at")
    want = {k: (v, "old") for k, v in base if k is not None}
    for k, v in batch:
        if k is not None:
            want[k] = (v, want[k][1] if k in want else None)
    nulls = [(v, "old") for k, v in base if k is None] + [(v, None) for k, v in batch if k is None]
    got = upsert.merge(b, n, ["k"], small=small).collect()
    assert {r.k: (r.v, r.only_base) for r in got if r.k is not None} == want
    assert sorted(((r.v, r.only_base) for r in got if r.k is None), key=repr) == sorted(nulls, key=repr)
    assert len(got) == len(want) + len(nulls)


def test_strict_upsert_refuses_repeats(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "k int, v string")
    with pytest.raises(upsert.DuplicateKeys):
        upsert.require_unique(df, ["k"])
    upsert.require_unique(df.where("k is null"), ["k"])
    with pytest.raises(ValueError):
        upsert.merge(df, df, [])


def test_table_life(spark, tmp_path):
    t = Table(spark, str(tmp_path / "people"))
    first = spark.createDataFrame([(1, "alice", datetime(2024, 1, 1), (5,)), (2, "bob", datetime(2025, 1, 1), None)], "id int, name string, created_at timestamp_ntz, address struct<zip:int>")
    with pytest.raises(TableMissing):
        t.write(first)
    assert not t.exists()
    assert t.write(first.limit(0), auto_create=True) == "empty" and not t.exists()
    assert t.write(first, keys=["id"], auto_create=True, partition_by="year(created_at)") == "simpleInsert"
    at = {r.id: r._inserted_at for r in t.read().collect()}
    batch = spark.createDataFrame([("x", 1, "carol"), ("y", 3, "dave")], "extra string, id bigint, name string")
    assert t.write(batch, keys=["id"]) == "upsertWithMergeInto"
    got = {r.id: r for r in t.read().collect()}
    assert got[1].name == "carol" and got[1].created_at == datetime(2024, 1, 1) and json.loads(got[1].address) == {"zip": 5} and got[1]._inserted_at == at[1]
    assert got[2].extra is None and got[3].created_at is None and got[3]._inserted_at is not None
    assert t.columns() == {"id": "BIGINT", "name": "VARCHAR", "created_at": "TIMESTAMP", "address": "JSON", "_inserted_at": "TIMESTAMP", "extra": "VARCHAR"}
    assert t.read(where={"year(created_at)": 2025}).count() == 1
    assert t.read(ranges={"created_at": (datetime(2024, 1, 1), datetime(2024, 12, 31))}).count() == 1
    assert t.read(ranges={"created_at": (datetime(2024, 1, 1), datetime(2024, 12, 31))}).inputFiles() and len(t.read(where={"year(created_at)": 2025}).inputFiles()) == 1
    with pytest.raises(evolve.IncompatibleType):
        t.write(spark.createDataFrame([("one",)], "id string"))
    with pytest.raises(evolve.IncompatibleType):
        t.write(spark.createDataFrame([("flat",)], "address string"))
    assert t.vacuum(0.0) and t.read().count() == 3 and t.vacuum(0.0) == []


def test_table_replays_and_checkpoints(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    for i in range(25):
        t.write(spark.createDataFrame([(i,)], "v int"), auto_create=True, stream="s", batch=i)
    assert t.write(spark.createDataFrame([(99,)], "v int"), stream="s", batch=24) == "replayed"
    assert sorted(r.v for r in t.read().collect()) == list(range(25))
    assert any(n.endswith(".all.json") for n in t.store.names("_log"))
    assert t.write(spark.createDataFrame([(99,)], "v int"), stream="other", batch=0) == "simpleInsert"


def test_concurrent_commits_retry(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    t = Table(spark, str(tmp_path / "t"))
    t.write(spark.createDataFrame([(0,)], "v int"), auto_create=True)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: Table(spark, str(tmp_path / "t")).write(spark.createDataFrame([(i,)], "v int"), retries=50), range(1, 9)))
    assert sorted(r.v for r in t.read().collect()) == list(range(9))


def test_upsert_rewrites_only_touched_files(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    for i in range(3):
        t.write(spark.range(i * 10, i * 10 + 10).selectExpr("id", "'a' as v").coalesce(1), keys=["id"] if not i else None, auto_create=True)
    before = set(t.state().files)
    t.write(spark.createDataFrame([(15, "b"), (100, "c")], "id bigint, v string"), keys=["id"])
    assert len(before & set(t.state().files)) == 2
    assert {r.id for r in t.read().where("v <> 'a'").collect()} == {15, 100} and t.read().count() == 31


@pytest.mark.parametrize("parts", [None, "v"])
def test_compaction_of_a_table(spark, tmp_path, parts):
    t = Table(spark, str(tmp_path / "t"))
    for i in range(4):
        t.write(spark.createDataFrame([(i, "a"), (i + 10, None)], "k int, v string").coalesce(1), auto_create=True, partition_by=parts)
    rows = sorted(map(tuple, t.read().collect()), key=repr)
    n = len(t.state().files)
    assert t.compact() == n and t.compact() == 0
    assert len(t.state().files) == (2 if parts else 1)
    assert sorted(map(tuple, t.read().collect()), key=repr) == rows


def test_insert_only_upsert_rewrites_nothing(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    t.write(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), keys=["k"], auto_create=True)
    before = set(t.state().files)
    t.write(spark.createDataFrame([(2,), (3,), (None,)], "k int"), keys=["k"])
    assert before <= set(t.state().files)
    assert sorted(((r.k, r.v) for r in t.read().collect()), key=repr) == [(1, "a"), (2, "b"), (3, None), (None, None)]


def test_odd_partition_values(spark, tmp_path):
    t = Table(spark, str(tmp_path / "a data" / "t"))
    values = ["x/y", "a b", "é=1", "%2F", "", None, "/data/"]
    t.write(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string"), keys=["id"], auto_create=True, partition_by="v")
    for i, v in enumerate(values):
        assert [r.id for r in t.read(where={"v": v}).collect()] == [i], v
    t.write(spark.createDataFrame([(i, "n") for i in range(len(values))], "id int, extra string"), keys=["id"])
    assert {(r.id, r.v, r.extra) for r in t.read().collect()} == {(i, v, "n") for i, v in enumerate(values)}


def test_odd_column_names(spark, tmp_path):
    t = Table(spark, str(tmp_path / "odd"))
    df = spark.createDataFrame([(1, "x", 2)], T.StructType([T.StructField("a`b", T.IntegerType()), T.StructField("select", T.StringType()), T.StructField("k-1", T.IntegerType())]))
    t.write(df, keys=["k-1"], auto_create=True)
    t.write(df.withColumn("select", F.lit("y")), keys=["k-1"])
    assert [tuple(r)[:3] for r in t.read().collect()] == [(1, "y", 2)]


# ------------------------------------------------------------------------------------------ runs, flushes, IPC


def test_runs(spark):
    sig = ["a", "a", "b", "a", "a", None, None]
    df = spark.createDataFrame(list(enumerate(sig)), "o int, sig string")
    got = consolidate.consolidated(df, "o", "sig").orderBy("run_id").collect()
    assert [(r.sig, r.n_rows, r.first_id) for r in got] == [("a", 2, 0), ("b", 1, 2), ("a", 2, 3), (None, 2, 5)]
    assert consolidate.consolidated(df.limit(0), "o", "sig").count() == 0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([1, 2, None]), st.sampled_from(["a", "b", None])), min_size=1, max_size=30), st.integers(1, 7))
def test_runs_in_stretches_equal_brute_force(spark, rows, stretch):
    df = spark.createDataFrame([(i * i, p, s) for i, (p, s) in enumerate(rows)], "o long, p int, sig string")
    want, last, n = {}, {}, {}
    for i, (p, s) in enumerate(rows):
        if p not in last or last[p] != s:
            n[p] = n.get(p, 0) + 1
        last[p] = s
        want[i * i] = n[p]
    assert {r.o: r.run_id for r in consolidate.runs(df, "o", "sig", ["p"], stretch).collect()} == want
    seen: dict = {}
    got = {r.o: r.b for r in consolidate.flush_batches(df, F.col("p"), "o", 3, stretch).collect()}
    for i, (p, _) in enumerate(rows):
        assert got[i * i] == seen.get(p, 0) // 3
        seen[p] = seen.get(p, 0) + 1


def test_flush_numbers(spark):
    df = spark.range(1000).selectExpr("id as o", "case when id % 10 < 9 then 0 else 1 end as q").repartition(7)
    got = {(r.p, r.o): r.b for r in consolidate.flush_batches(df, F.col("q"), "o", 100).collect()}
    for q in (0, 1):
        order = sorted(o for p, o in got if p == q)
        assert all(got[q, o] == i // 100 for i, o in enumerate(order))
    r = spark.range(1).select(consolidate.flush_reason(F.lit(1), F.lit(1), F.lit(9), 5, 5, 5), consolidate.flush_reason(F.lit(1), F.lit(1), F.lit(1), 5, 5, 5, F.lit(True)), consolidate.flush_reason(F.lit(9), F.lit(9), F.lit(9), 5, 5, 5, F.lit(True))).first()
    assert tuple(r) == ("time", "memory_pressure", "record_count")


def test_ipc(spark):
    table = pa.table({"id": pa.array([1, 2], pa.uint32()), "t": pa.array([clock_time(1, 2, 3, 4000), None], pa.time32("ms")), "d": pa.array([date(2024, 1, 2), None]), "ts": pa.array([datetime(2024, 1, 2), None], pa.timestamp("ms"))})
    assert arrow_ipc.decode(None) is None and arrow_ipc.decode(b"") is None
    assert arrow_ipc.decode(arrow_ipc.encode(table)) == table
    with pytest.raises(arrow_ipc.DataError):
        arrow_ipc.encode({"id": 1})
    other = pa.table({"id": pa.array([7], pa.uint32())})
    df = spark.createDataFrame([(bytearray(arrow_ipc.encode(table)),), (bytearray(arrow_ipc.encode(other)),), (None,), (bytearray(b""),)], "p binary")
    out = arrow_ipc.read(df, "p")
    rows = sorted(out.collect(), key=lambda r: r.id)
    assert [r.id for r in rows] == [1, 2, 7] and rows[0].t == "01:02:03.004" and rows[2].d is None
    assert mt.kind(out.schema["t"]) == "time"
    with pytest.raises(ValueError, match="No valid schemas"):
        arrow_ipc.read(df.where("p is null"), "p")
    yes, no = arrow_ipc.split_formats(spark.createDataFrame([(bytearray(arrow_ipc.encode(table)),), (bytearray(b"{}"),), (None,)], "p binary"), "p")
    assert (yes.count(), no.count()) == (1, 2)


def test_ipc_payloads_of_differing_schemas(spark):
    tables = [
        pa.table({"id": pa.array([1], pa.int32()), "n": pa.array([5], pa.int64()), "in": pa.array([{"b": 1}]), "none": pa.nulls(1), "w": pa.array([date(2024, 1, 2)]), "xs": pa.array([[1, None]], pa.list_(pa.int32()))}),
        pa.table({"ID": pa.array([2**40, 2**41], pa.int64()), "n": pa.array([0.5, None]), "in": pa.array([{"a": "x", "b": None}, None]), "none": ["s", None], "w": pa.array([datetime(2024, 1, 2, 3), None], pa.timestamp("ms")), "xs": pa.array([[2**40], None], pa.list_(pa.int64())), "only": [True, None]}),
        pa.table({"m": pa.array([[("k", 1)], None], pa.map_(pa.string(), pa.int32())), "n": pa.array([2**60 + 1, 1], pa.int64())}),
        pa.table({"m": pa.array([None, [("l", 2**40), ("o", None)]], pa.map_(pa.string(), pa.int64())), "t": pa.array([clock_time(1, 2), None], pa.time32("ms"))}),
        pa.table({"t": pa.array([date(2024, 1, 2), None])}),
    ]
    for order in (tables, tables[::-1]):
        df = spark.createDataFrame([(bytearray(arrow_ipc.encode(t)), i) for i, t in enumerate(order)], "p binary, o int").coalesce(1)
        out = arrow_ipc.read(df, "p", keep={"o": "o"}, row="r")
        kinds = {f.name: mt.kind(f) for f in out.schema.fields}
        assert kinds == {"ID": "int64", "in": "struct", "m": "map", "n": "float64", "none": "string", "only": "boolean", "t": "time", "w": "timestamp", "xs": "array", "o": "int32", "r": "int64"}
        rows = {(tables.index(order[r.o]), r.r): r.asDict(recursive=True) for r in out.collect()}
        assert len(rows) == 9
        show = lambda k: {c: v for c, v in rows[k].items() if v is not None and c not in "or"}
        assert show((0, 0)) == {"ID": 1, "n": 5.0, "in": {"a": None, "b": 1}, "w": datetime(2024, 1, 2), "xs": [1, None]}
        assert show((1, 0)) == {"ID": 2**40, "n": 0.5, "in": {"a": "x", "b": None}, "none": "s", "w": datetime(2024, 1, 2, 3), "xs": [2**40], "only": True}
        assert show((1, 1)) == {"ID": 2**41}
        assert show((2, 0)) == {"m": {"k": 1}, "n": float(2**60)} and show((2, 1)) == {"n": 1.0}
        assert show((3, 0)) == {"t": "01:02:00.000"} and show((3, 1)) == {"m": {"l": 2**40, "o": None}}
        assert show((4, 0)) == {"t": "00:00:00.000"} and show((4, 1)) == {}
    bad = spark.createDataFrame([(bytearray(arrow_ipc.encode(pa.table({"x": v}))),) for v in ([1], ["a"])], "p binary")
    with pytest.raises(unify.SchemaConflict, match="'x'"):
        arrow_ipc.read(bad, "p")


def test_stream_of_payloads_keeps_all_columns_and_the_last_of_a_key(spark, tmp_path):
    payload = lambda **cols: bytearray(arrow_ipc.encode(pa.table(cols)))
    rows = [
        ("b", 0, 3, payload(id=[1, 2], v=["new", "new"], extra=[7, 8])),
        ("b", 0, 1, payload(id=pa.array([1, 3], pa.int32()), v=["old", "old"])),
        ("b", 0, 2, payload(id=[3, 3], v=["mid", "last"], more=[True, False])),
    ]
    c = config.parse({"data_path": str(tmp_path / "wh"), "topic2table.map": "", "table.b.auto-create": "true", "table.b.id-columns": "id"})
    sink = Sink(spark, c, "payloads")
    kind = "topic string, partition int, offset bigint, value binary"
    want = {1: ("new", 7, None), 2: ("new", 8, None), 3: ("last", None, False)}
    for n in (0, 1):  # into a new table, then as an upsert
        sink(spark.createDataFrame(rows if n else rows[::-1], kind).repartition(3), n)
        got = sink.catalog.table("b").read().collect()
        assert len(got) == 3 and {r.id: (r.v, r.extra, r.more) for r in got} == want


# ------------------------------------------------------------------------------------------ dead letters, streams, metrics


def test_conflict_classifier():
    try:
        try:
            raise unify.SchemaConflict("x")
        except ValueError as e:
            raise RuntimeError("y") from e
    except RuntimeError as e:
        assert dlq.is_conflict(e)
    assert not dlq.is_conflict(RuntimeError("incompatible"))


def test_dead_letters_by_first_type_and_by_table(spark):
    rows = [(0, '{"v":"hello"}'), (1, '{"v":42}'), (2, "{bad"), (3, None), (4, "[1]"), (5, '{"v":"again","w":1}')]
    df = spark.createDataFrame(rows, "o int, v string")
    schema = dlq.wanted(df, "v", "o", None)
    good, bad = dlq.split(df, "v", schema, ["o"])
    assert {r.o for r in good.collect()} == {0, 3, 5} and {r.o for r in bad.collect()} == {1, 2, 4}
    schema = dlq.wanted(df, "v", "o", struct(v="int64"))
    good, bad = dlq.split(df, "v", schema, ["o"])
    assert {r.o for r in good.collect()} == {1, 3}
    assert "field v" in bad.where("o = 0").first().error


def test_offsets_sample(spark):
    df = spark.range(12).selectExpr("'t' as topic", "0 as partition", "id as offset")
    text = dlq.offsets_sample(df)
    assert text.startswith("[t:0@0, t:0@1") and text.endswith("(truncated)") and "@9]" in text


def test_stream_is_effectively_once(spark, tmp_path):
    rows = [("orders", 0, i, bytearray(json.dumps({"id": i % 5, "n": i}).encode())) for i in range(20)]
    rows += [("orders", 1, 99, bytearray(b"{broken")), ("orders", 1, 100, None)]
    rows += [("batches", 0, 0, bytearray(arrow_ipc.encode(pa.table({"id": [1001], "name": ["TestUser"]}))))]
    spark.createDataFrame(rows, "topic string, partition int, offset bigint, value binary").coalesce(1).write.parquet(str(tmp_path / "in"))
    c = config.parse({"data_path": str(tmp_path / "wh"), "topic2table.map": "orders:orders_t", "table.orders_t.auto-create": "true", "table.orders_t.id-columns": "id", "table.batches.auto-create": "true"})
    sink = Sink(spark, c, "once", transform=lambda name, df: df.withColumn("via", F.lit(name)))
    q = sink.start(records(spark, "parquet", str(tmp_path / "in")), str(tmp_path / "cp"), once=True)
    q.awaitTermination()
    assert q.exception() is None
    t = sink.catalog.table("orders_t")
    got = {r.id: r.n for r in t.read().collect()}
    assert got == {**{i: 15 + i for i in range(5)}, None: None}
    assert sink.catalog.table("orders_t__dlq").read().count() == 1
    assert sink.catalog.table("batches").read().first().via == "batches"
    batch = spark.read.parquet(str(tmp_path / "in"))
    sink(batch, 0)  # the same batch again
    assert t.read().count() == 6 and sink.catalog.table("orders_t__dlq").read().count() == 1
    strict = Sink(spark, c, "strict", dead_letters=False)
    with pytest.raises(unify.SchemaConflict, match="@99"):
        strict(batch, 0)
    assert Catalog(spark, str(tmp_path / "wh")).exists("batches") and sink.metrics.snapshot()["dead-letters"]["total"] == 1


def test_typed_stream_and_small_commits(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.range(40).selectExpr("id", "named_struct('a', id) as s").repartition(4).write.parquet(src)
    c = config.parse({"data_path": str(tmp_path / "wh"), "table.things.auto-create": "true", "topic2table.map": "t:things"})
    sink = Sink(spark, c, "typed")
    stream = spark.readStream.schema("id long, s struct<a:long>").parquet(src)
    q = stream.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).foreachBatch(sink.typed("t")).start()
    q.awaitTermination()
    assert q.exception() is None
    t = sink.catalog.table("things")
    assert t.read().count() == 40 and len(t.state().files) == 1 and t.columns()["s"] == "JSON"


def test_admission():
    c = config.parse({"data_path": "/x", "flush.size": "10", "file.size.bytes": "99"})
    from millrace.streaming.stream import admission

    assert admission(c, "kafka", 3)["maxOffsetsPerTrigger"] == "30" and admission(c, "parquet") == {"maxBytesPerTrigger": "99"}
    assert c.trigger() == {"processingTime": "60000 milliseconds"}


def test_metrics():
    now = [0.0]
    m = metrics.Metrics(lambda: now[0])
    for ms in (10, 30):
        with m.timer("simpleInsert"):
            now[0] += ms / 1000
    with pytest.raises(RuntimeError), m.timer("createTable"):
        raise RuntimeError
    m.records(5)
    s = m.snapshot()
    assert s["query.simpleInsert"]["count"] == 2 and s["query.simpleInsert"]["avg"] == pytest.approx(20) and s["query.simpleInsert"]["max"] == pytest.approx(30)
    assert s["query"]["count"] == 3 and s["schema"]["count"] == 1 and s["batch-size"]["total"] == 5
    m.close()
    assert m.snapshot() == {}


# ------------------------------------------------------------------------------------------ zones, stores, schemas


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_times_are_utc_in_every_session_zone(spark, tmp_path, zone):
    texts = ["2024-01-01T00:00:00Z", "2024-01-01T00:00:00", "2024-11-03T01:30:00.123456", "2024-11-03T01:30:00+0300", "2024-03-10T02:30:00", "nothing"]
    df = spark.createDataFrame([(i, json.dumps({"at": t})) for i, t in enumerate(texts[:5])], "i int, v string")

    def all_of():
        cells = spark.createDataFrame([(t,) for t in texts], "s string")
        millis = [r[0] for r in cells.select(ts.epoch_millis("s")).collect()]
        parsed = sorted((r.i, str(r.at)) for r in infer.parse(df, "v", infer.infer(df, "v"), ["i"]).collect())
        zoned = spark.range(1).select(F.timestamp_micros(F.lit(1_730_611_800_123_456)).alias("at"))
        table = Table(spark, str(tmp_path / f"t{len(list(tmp_path.iterdir()))}"))
        table.write(zoned, auto_create=True)
        row = table.read().collect()[0]
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        assert abs((row["_inserted_at"] - now).total_seconds()) < 300
        return millis, parsed, str(row["at"]), [str(r[0]) for r in unify.project(zoned, struct(at="timestamp")).collect()]

    want = all_of()
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert all_of() == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert want[2] == "2024-11-03 05:30:00.123456" and want[0][2] == 1730597400123 and want[0][5] is None


def test_conditional_create_refuses_what_is_there():
    """The commit of an object store: one request with a condition, whose failure shows on closing."""
    from py4j.protocol import Py4JJavaError

    from millrace.sources.store import CONDITIONAL, Store

    class Named:
        def __init__(self, name, cause=None):
            self.name, self.cause = name, cause

        def getClass(self):  # noqa: N802
            return self

        def getSimpleName(self):  # noqa: N802
            return self.name

        def getCause(self):  # noqa: N802
            return self.cause

    class Failure(Py4JJavaError):
        def __init__(self, *names):
            cause = None
            for n in reversed(names):
                cause = Named(n, cause)
            self.java_exception = cause

    class Fs:
        def __init__(self, error=None):
            self.error, self.asked, self.written = error, [], b""

        def createFile(self, _):  # noqa: N802
            return self

        def overwrite(self, yes):
            self.asked.append(yes)
            return self

        def must(self, key, value):
            self.asked.append((key, value))
            return self

        def build(self):
            return self

        def write(self, content):
            self.written += bytes(content)

        def close(self):
            if self.error:
                raise self.error

    fs = Fs()
    assert Store._create_if_absent(fs, "p", b"x", True) and fs.asked == [False, (CONDITIONAL, True)] and fs.written == b"x"
    assert not Store._create_if_absent(Fs(Failure("IOException", "FileAlreadyExistsException")), "p", b"x", True)
    assert not Store._create_if_absent(Fs(Failure("RemoteFileChangedException")), "p", b"x", True)
    with pytest.raises(ValueError, match="condition"):
        Store._create_if_absent(Fs(Failure("IllegalArgumentException")), "p", b"x", True)
    with pytest.raises(Failure):
        Store._create_if_absent(Fs(Failure("SocketTimeoutException")), "p", b"x", True)


def test_typed_records_in_odd_cases(spark):
    from millrace.operators import typed

    field = lambda n, t, name=None: {"field": n, "type": t, "optional": True, **({"name": name} if name else {})}
    one = {"type": "struct", "fields": [field("a", "int32"), field("t", "int32", "x.Time"), field("b", "bytes")]}
    rows = [(1, json.dumps(one), '{"a":1,"t":3723004,"b":"aGk="}'), (2, json.dumps(one, indent=2), None), (3, json.dumps({**one, "fields": one["fields"][:1]}), '{"a":5,"extra":1}'), (4, None, '{"a":9}'), (5, '{"type":"string"}', "7"), (1, json.dumps(one), '{"a":1,"t":3723004,"b":"aGk="}')]
    df = spark.createDataFrame(rows, "k int, s string, v string")
    assert len(typed.schemas_of(df, "s")) == 2
    got = sorted((r.k, r.a, r.t, bytes(r.b) if r.b is not None else None) for r in typed.decode(df, "s", "v", ["k"]).collect())
    assert got[:2] == [(1, 1, "01:02:03.004", b"hi")] * 2 and got[2:4] == [(2, None, None, None), (3, 5, None, None)] and len(got) == 5
    with pytest.raises(ValueError, match="No valid schemas"):
        typed.decode(df.limit(0), "s", "v")
    clash = spark.createDataFrame([(json.dumps({"type": "struct", "fields": [field("a", "string")]}), "{}"), (json.dumps(one), "{}")], "s string, v string")
    with pytest.raises(unify.SchemaConflict):
        typed.decode(clash, "s", "v")


def test_last_of_a_key_across_partitions(spark, tmp_path):
    """Without timestamps the later partition counts, with them the later record, whatever the offsets."""
    for with_time, want in ((False, "p1"), (True, "p0")):
        sink = Sink(spark, config.parse({"data_path": str(tmp_path / str(with_time)), "table.t.auto-create": "true", "table.t.id-columns": "id"}), "order")
        rows = [("t", 0, 900, datetime(2024, 1, 2), '{"id":1,"v":"p0"}'), ("t", 1, 3, datetime(2024, 1, 1), '{"id":1,"v":"p1"}')]
        df = spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp timestamp, value string").withColumn("value", F.col("value").cast("binary"))
        df = df if with_time else df.drop("timestamp")
        sink(df.limit(0), 0)
        sink(df, 1)
        got = sink.catalog.table("t").read().collect()
        assert [r.v for r in got] == [want]


def test_quoting_in_columns_equals_quoting(spark):
    names = ["a", "a b", "a`b", "", "9x", "_z9", "é"]
    got = spark.createDataFrame([(n,) for n in [*names, None]], "n string").select("n", idents.quote_column("n").alias("q")).collect()
    assert {r.n: r.q for r in got} == {**{n: idents.quote(n) for n in names}, None: None}


def test_avro_round_trip_and_refusals(spark):
    from millrace.sources import avro

    point = {"type": "record", "name": "P", "fields": [{"name": "x", "type": "int"}, {"name": "tags", "type": {"type": "array", "items": ["null", "string"]}}]}
    schema = json.dumps({"type": "record", "name": "R", "fields": [
        {"name": "p", "type": point}, {"name": "q", "type": ["null", "P"]}, {"name": "m", "type": {"type": "map", "values": "float"}}, {"name": "b", "type": "bytes"}, {"name": "f", "type": {"type": "fixed", "name": "F", "size": 2}},
        {"name": "d", "type": {"type": "int", "logicalType": "date"}}, {"name": "t", "type": {"type": "int", "logicalType": "time-millis"}}, {"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}}, {"name": "ok", "type": "boolean"}, {"name": "s", "type": "string"}, {"name": "n", "type": "long"}]})
    row = {"p": {"x": -3, "tags": ["a", None]}, "q": None, "m": {"k": 1.5}, "b": b"hi", "f": b"zz", "d": 19723, "t": 3723004, "at": -1, "ok": True, "s": "é" * 5000, "n": -(1 << 62)}
    data = avro.encode(row, schema)
    empty = avro.encode({**row, "p": {"x": 0, "tags": []}, "m": {}, "s": "", "q": {"x": 9, "tags": ["c"]}}, schema)
    df = spark.createDataFrame([(1, data), (2, None), (3, empty), (1, data)], "k int, v binary")
    got = sorted(avro.decode(df, "v", schema, ["k"]).collect(), key=lambda r: r.k)
    r = got[0]
    assert len(got) == 4 and r.p.x == -3 and r.p.tags == ["a", None] and r.q is None and r.m == {"k": 1.5} and bytes(r.b) == b"hi" and bytes(r.f) == b"zz"
    assert r.d == date(2024, 1, 1) and r.t == "01:02:03.004" and r["at"] == datetime(1969, 12, 31, 23, 59, 59, 999000) and r.ok and r.s == "é" * 5000 and r.n == -(1 << 62)
    assert all(v is None for v in got[2][1:]) and got[3].q.x == 9 and got[3].p.tags == [] and got[3].m == {}
    for bad in (data[:-1], data + b"x", b""):
        with pytest.raises(Exception, match="record ends early|after a record"):
            avro.decode(spark.createDataFrame([(bytearray(bad),)], "v binary"), "v", schema).collect()
    for wrong in ('"int"', '{"type":"record","name":"R","fields":[{"name":"a","type":["int","string"]}]}', '{"type":"record","name":"R","fields":[{"name":"a","type":["null","R"]}]}', '{"type":"record","name":"R","fields":[{"name":"a","type":{"type":"bytes","logicalType":"decimal","precision":4}}]}'):
        with pytest.raises(ValueError):
            avro.spark_schema(wrong)
    assert avro.decode(df.limit(0), "v", schema).count() == 0
