"""Problems 1 to 5: against brute force, and on nulls, empty tables, ties, long texts and clashing columns."""

import csv
import io
import json
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.functions import clock, fsm
from millrace.operators import compaction, dedupe, drift, rejects, timenorm
from millrace.session import read_table

TOPICS = "topic string, table_name string, table_id_columns string, value_format string, delimiter string, zone_name string, day_order string"
FIELDS = "topic string, field_pos int, field_path string, field_type string, is_optional boolean"
SINK = "delivery_id bigint, batch_id bigint, topic string, kafka_partition int, kafka_offset bigint, value_schema string, record_value string, delivered_at timestamp_ntz, k string, v string, name string, identifier string"


@pytest.fixture(scope="module")
def topics(spark):
    rows = [("t", "t", "id", None, None, None, None), ("c", "c", None, "csv", ",", "Europe/Berlin", "dmy"), ("j", "j", None, "json", None, None, None), ("u", "u", "a, b", None, None, "America/New_York", "mdy"), ("free", "free", None, None, None, None, None)]
    return spark.createDataFrame(rows, TOPICS)


@pytest.fixture(scope="module")
def fields(spark):
    rows = [("t", 0, "id", "int64", False), ("t", 1, "amount", "float64", True), ("t", 2, "person", "struct", True), ("t", 3, "person.firstName", "string", True), ("t", 4, "created_at", "timestamp", True), ("t", 5, "tags", "array", True), ("t", 6, "m", "map", True)]
    rows += [("c", 0, "id", "int32", False), ("c", 1, "name", "string", False), ("c", 2, "on", "date", True), ("c", 3, "ok", "boolean", True)]
    rows += [("j", 0, "id", "int32", False), ("j", 1, "note", "string", True), ("j", 2, "score", "float64", True)]
    return spark.createDataFrame(rows, FIELDS)


# -------------------------------------------------------------------------------------------------- 1


def sink(spark, rows):
    full = [(i, b, t, 0, i, s, v, None, "x", "x", "x", "x") for i, (b, t, s, v) in enumerate(rows)]
    return spark.createDataFrame(full, SINK)


GOOD = {"id": 1, "amount": 1.5, "person": {"firstName": "A"}, "created_at": "2025-01-01T00:00:00Z", "tags": ["x"], "m": {"p": 1}}


def changes(spark, fields, rows):
    return {(r.batch_id, r.field_path, r.change) for r in drift.found(sink(spark, rows), fields).collect()}


def test_drift_cases(spark, fields):
    def but(**kw):
        d = {**GOOD, **kw}
        return json.dumps({k: v for k, v in d.items() if v is not ...})

    rows = [(0, "t", None, json.dumps(GOOD)), (0, "t", None, None)]
    rows += [(1, "t", None, but(ID=1, id=...)), (1, "t", None, but(extra=1))]  # case aside; one more field
    rows += [(2, "t", None, but(amount=..., tags=...))]
    rows += [(3, "t", None, but(amount="x", created_at=5, person="flat"))]
    rows += [(4, "t", None, but(person={"firstName": "A", "more": {"deep": 1}}))]
    rows += [(5, "t", None, but(createdAt="2025-01-01T00:00:00Z", created_at=...)), (5, "t", None, but(createdAt="2025-02-01T00:00:00Z", created_at=...))]
    rows += [(6, "t", None, but(amount=None, person=None))]
    rows += [(7, "t", None, None), (8, "free", None, "{}"), (9, "t", None, "{broken"), (10, None, None, "{}")]
    rows += [(11, "t", None, but(person=..., human={"firstName": "A"})), (12, "t", None, but(m=..., attrs={"p": 1}))]
    got = changes(spark, fields, rows)
    by = defaultdict(set)
    for b, p, c in got:
        by[b].add((p, c))
    assert by[0] == set()
    assert by[1] == {("extra", "added")}
    assert by[2] == {("amount", "removed"), ("tags", "removed")}
    assert by[3] == {("amount", "retyped"), ("created_at", "retyped"), ("person", "retyped")}
    assert by[4] == {("person.more", "added")}
    assert by[5] == {("created_at", "renamed")}
    assert by[6] == {("person.firstName", "removed")}  # a struct that is always null shows no fields
    assert not any(by[b] for b in (7, 8, 9, 10))
    assert by[11] == {("person", "renamed")}
    assert by[12] == {("m", "renamed")}


def test_drift_of_a_name_that_is_new_elsewhere(spark, fields):
    j = lambda b, name, i, **kw: (b, "j", None, json.dumps({"id": i, "score": 0.5, name: f"{i} of ten", **kw}))
    rows = [(b, "t", None, json.dumps(GOOD | {"remark": f"{b} of ten"})) for b in range(20)]  # an addition in one topic
    rows += [j(100 + b, "note", b) for b in range(4)] + [j(110 + b, "remark", b) for b in range(4)]  # a new name in another
    rows += [j(120 + b, "note", b, extra=f"{b} of ten") for b in range(4)] + [j(130, "extra", 1)]  # an addition with a like value
    got = changes(spark, fields, rows)
    assert {x for x in got if x[0] < 100} == {(b, "remark", "added") for b in range(20)}
    assert {x for x in got if 100 <= x[0] < 120} == {(110 + b, "note", "renamed") for b in range(4)}
    assert {x for x in got if x[0] >= 120} == {(120 + b, "extra", "added") for b in range(4)} | {(130, "note", "removed"), (130, "extra", "added")}


def test_drift_with_schemas(spark, fields):
    def schema(*more, drop=(), **types):
        base = {"id": "int64", "amount": "float64", "created_at": "int64", "tags": "array", "m": "map"} | types
        out = [{"field": k, "type": t, **({"name": "org.x.Timestamp"} if k == "created_at" else {})} for k, t in base.items() if k not in drop]
        if "person" not in drop:
            out.append({"field": "person", "type": "struct", "fields": [{"field": "firstName", "type": "string"}]})
        return json.dumps({"type": "struct", "fields": [*out, *more]})

    v = json.dumps(GOOD)
    rows = [(0, "t", schema(), v), (1, "t", schema(id="int32"), v), (2, "t", schema({"field": "n", "type": "int32"}), v), (3, "t", schema(drop=("tags",)), v), (4, "t", "not json", v), (5, "t", schema(m="struct"), v)]
    got = changes(spark, fields, rows)
    assert got == {(1, "id", "retyped"), (2, "n", "added"), (3, "tags", "removed"), (5, "m", "retyped")}


def test_drift_on_nothing(spark, fields):
    empty = spark.createDataFrame([], SINK)
    assert drift.found(empty, fields).collect() == []
    assert drift.report(empty, fields.limit(0)).collect() == []
    assert drift.found(sink(spark, [(0, "t", None, json.dumps({"id": 1}))]), fields.limit(0)).collect() == []


def test_drift_projection(spark, fields):
    rows = [(0, "t", None, json.dumps(GOOD)), (1, "t", None, json.dumps({**{k: v for k, v in GOOD.items() if k != "amount"}, "amt": 2.5})), (2, "t", None, json.dumps({**GOOD, "amount": "none"})), (3, "t", None, None)]
    records = sink(spark, rows)
    table = drift.project(records, fields, "t", drift.report(records, fields))
    got = {r.batch_id: r for r in table.collect()}
    assert [got[i].amount for i in range(4)] == [1.5, 2.5, None, None]
    assert got[2].failed_casts == ["amount"] and got[3].failed_casts == []
    assert got[0].person_firstName == "A" and json.loads(got[0].tags) == ["x"]


def test_features_read_whole_values():
    """Values that differ late only, in a long text, in the last element, the last key, have other shapes; all in few places."""
    f = drift.features
    assert f("ab " * 400 + "7") != f("ab " * 400 + "x") and f([1, 1, 1]) != f([1, 1, 900]) and f({k: 1 for k in "abcdefgh"}) != f({k: 1 for k in "abcdefgi"})
    assert f("2024-01-02T03:04:05Z") == f("1999-12-31T23:59:59Z") and f("x") != f(1) != f(True) and f([]) != f({}) != f("")
    values = ["y" * 70_000, 1e308, float("inf"), 10**30, -5, 0, None, [[[[["deep"]]]]], {"a": {"b": None}}, "\ud800"]
    assert all(0 <= int(p) < drift.PLACES for v in values for p in f(v))


def test_table_rows_undo_renames(spark):
    fields = spark.createDataFrame([("t", 0, "id", "int64", False), ("t", 1, "status", "string", True), ("t", 2, "at", "timestamp", True)], "topic string, field_pos int, field_path string, field_type string, is_optional boolean")
    rows = [(i, b, "t", None, json.dumps({"id": i, "status" if b == 1 else "state": ["open", "closed"][i % 2], "at": "2024-01-01T00:00:00"})) for i, b in [(i, 1 + i % 2) for i in range(60)]]
    rows += [(100, 1, "t", None, '{"id":"x","status":null,"at":"2024-01-01T00:00:00"}'), (101, 1, "t", None, None), (102, 1, "t", None, "{"), (103, 1, "other", None, "{}")]
    df = spark.createDataFrame(rows, "delivery_id long, batch_id long, topic string, value_schema string, record_value string")
    got = {r.delivery_id: r for r in drift.table_rows(df, fields).collect()}
    assert len(got) == 63 and json.loads(got[1].row) == {"id": 1, "status": "closed", "at": "2024-01-01T00:00:00.000000"}
    assert got[100].failed_casts == ["id"] and json.loads(got[101].row) == {} and json.loads(got[102].row) == {}
    report = {r.field_path: r for r in drift.cast_report(df, fields).collect()}
    assert (report["id"].n_rows, report["id"].n_values, report["id"].n_failed) == (63, 60, 1) and report["status"].n_values == 60
    assert drift.table_rows(df.limit(0), fields).count() == 0 and drift.table_rows(df, fields.limit(0)).count() == 0


# -------------------------------------------------------------------------------------------------- 2


def brute_csv(text, d):
    """Number of fields, or None for broken quoting, one character at a time."""
    fields, i, n = 0, 0, len(text)
    while True:
        fields += 1
        if i < n and text[i] == '"':
            i += 1
            while True:
                j = text.find('"', i)
                if j < 0:
                    return None
                if text[j : j + 2] == '""':
                    i = j + 2
                    continue
                i = j + 1
                break
            if i < n and text[i] != d:
                return None
        else:
            while i < n and text[i] != d:
                if text[i] in '"\r\n':
                    return None
                i += 1
        if i >= n:
            return fields
        i += 1


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet='a,"\n\ré1 ', max_size=40), min_size=1, max_size=20), st.integers(1, 9))
def test_tokenizer_equals_brute_force(texts, width):
    data = [t.encode() for t in texts]
    tokens = fsm.tokenize(fsm.csv_machine(","), data, width)
    for i, t in enumerate(texts):
        want = brute_csv(t, ",")
        state = tokens.end_state[i]
        if want is None:
            assert state in (2, 4, 5, 6)
        else:
            assert state in (0, 1, 3)
            assert tokens.first_cut[i + 1] - tokens.first_cut[i] + 1 == want


def test_tokenizer_round_trips_written_rows():
    rnd = random.Random(3)
    rows = [["".join(rnd.choice('ab,"\n é') for _ in range(rnd.randint(0, 90))) for _ in range(4)] for _ in range(200)]
    out = []
    for r in rows:
        f = io.StringIO()
        csv.writer(f, lineterminator="").writerow(r)
        out.append(f.getvalue())
    fs = [(f"f{i}", "string", True) for i in range(4)]
    for r, got in zip(rows, rejects.check_csv(out, ",", fs), strict=True):
        assert got[0] is None and [got[3][f"f{i}"] for i in range(4)] == [x or None for x in r]


def reasons(spark, topics, fields, rows):
    df = spark.createDataFrame([(i, t, v, "x", "x") for i, (t, v) in enumerate(rows)], "line_id bigint, topic string, record_value string, t string, fields string")
    return {r.line_id: r for r in rejects.split(df, topics, fields).collect()}


def test_rejects(spark, topics, fields):
    long = "x" * 300_000
    cases = [
        ("c", "1,a,2025-01-02,true", None), ("c", ' +7 ,"a ""b"", c\n",,TRUE ', None), ("c", f'1,"{long}",,', None),
        ("c", '1,"a,2025-01-02,true', "quoting"), ("c", '1,a"b,,', "quoting"), ("c", '1,"a" ,,', "quoting"), ("c", "1,a,,\n", "quoting"),
        ("c", "", "columns"), ("c", "1,a,", "columns"), ("c", "1,a,,,", "columns"), ("c", None, "columns"),
        ("c", ",a,,", "value"), ("c", "1,,,", "value"), ("c", '1,"",,', "value"), ("c", "2147483648,a,,", "value"), ("c", "1,a,2025-02-30,", "value"), ("c", "1,a,,yes", "value"), ("c", "1.0,a,,", "value"), ("c", "١,a,,", "value"),
        ("j", '{"id":1,"note":"x","score":1e3}', None), ("j", ' {"score": null, "id": 2}\n', None), ("j", json.dumps({"id": 1, "note": long}), None),
        ("j", "", "quoting"), ("j", "[]", "quoting"), ("j", '{"id":1}{', "quoting"), ("j", '{"id":NaN}', "quoting"), ("j", '{"id":1,"note":"a\nb"}', "quoting"), ("j", '{"id":1,"note":"a}', "quoting"), ("j", None, "quoting"), ("j", "null", "quoting"),
        ("j", "{}", "columns"), ("j", '{"id":1,"Id":2}', "columns"),
        ("j", '{"id":null}', "value"), ("j", '{"id":1.0}', "value"), ("j", '{"id":true}', "value"), ("j", '{"id":1,"note":2}', "value"), ("j", '{"id":1,"score":"2"}', "value"), ("j", '{"id":1,"score":1e999}', "value"), ("j", '{"id":' + "9" * 5000 + "}", "value"),
        ("free", "x", "columns"), (None, "x", "columns"),
    ]
    got = reasons(spark, topics, fields, [(t, v) for t, v, _ in cases] + [("c", "1,a,,")] * 2)
    for i, (t, v, want) in enumerate(cases):
        assert got[i].reason == want, (t, v, got[i])
    assert got[1].fields == {"id": "+7", "name": 'a "b", c\n', "on": None, "ok": "TRUE"}
    assert got[4].error_offset == 3
    assert len(got) == len(cases) + 2


def test_rejects_typed_and_empty(spark, topics, fields):
    df = spark.createDataFrame([(1, "c", "5,a,2025-01-02,true")], "line_id bigint, topic string, record_value string")
    rows = rejects.split(df, topics, fields)
    t = rejects.typed(rows, "c", rejects.registry(topics, fields)["c"][2])
    assert dict(t.dtypes) == {"line_id": "bigint", "id": "int", "name": "string", "on": "date", "ok": "boolean"} and t.first().id == 5
    assert rejects.found(df.limit(0), topics, fields).collect() == []


@pytest.mark.parametrize("delimiter", ["||", "§", '"', "\n"])
def test_delimiters_that_are_no_ascii_character_are_refused(spark, delimiter):
    topics_ = spark.createDataFrame([("c", "c", None, "csv", delimiter, None, None)], TOPICS)
    fields = spark.createDataFrame([("c", 0, "a", "string", True)], "topic string, field_pos int, field_path string, field_type string, is_optional boolean")
    with pytest.raises(ValueError, match="delimiter of topic c"):
        rejects.registry(topics_, fields)


def test_typed_rows_are_in_utc(spark):
    """Whatever the session's zone; the profile has a row per field, also of topics without readable rows."""
    rows = [(1, "c", '7,2024-01-01T00:00:00,"x ""y"""'), (2, "c", "8,2024-01-01T00:00:00+0100,"), (3, "c", "x,,"), (3, "c", "x,,")]
    df = spark.createDataFrame(rows, "line_id bigint, topic string, record_value string")
    topics_ = spark.createDataFrame([("c", "c", None, "csv", ",", None, None), ("e", "e", None, "json", None, None, None)], TOPICS)
    spec = [("c", 0, "a", "int32", False), ("c", 1, "at", "timestamp", True), ("c", 2, "s", "string", True), ("e", 0, "f", "float64", True)]
    fields = spark.createDataFrame(spec, "topic string, field_pos int, field_path string, field_type string, is_optional boolean")
    known = rejects.registry(topics_, fields)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        split = rejects.split(df, topics_, fields)
        got = sorted((r.line_id, r.a, str(r["at"]), r.s) for r in rejects.typed(split, "c", known["c"][2]).collect())
        profile = {(r.topic, r.field_path): (r.n_values, r.low, r.high) for r in rejects.profile(split, known).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [(1, 7, "2024-01-01 00:00:00", 'x "y"'), (2, 8, "2023-12-31 23:00:00", None)]
    assert profile == {("c", "a"): (2, "7", "8"), ("c", "at"): (2, "1704063600000000", "1704067200000000"), ("c", "s"): (1, 'x "y"', 'x "y"'), ("e", "f"): (0, None, None)}


# -------------------------------------------------------------------------------------------------- 3

FILES = "file_id bigint, topic string, kafka_partition int, first_offset bigint, last_offset bigint, n_records int, n_bytes bigint, begin_snapshot bigint, end_snapshot bigint, flushed_at timestamp_ntz, file_content string, digest string, shards int"
SETTINGS = "setting_id bigint, topic string, setting_name string, setting_value string, valid_from timestamp_ntz"


def test_longest_first_is_balanced():
    rnd = random.Random(1)
    sizes = [rnd.random() for _ in range(500)]
    groups = compaction.longest_first(sizes, 7)
    loads = [sum(s for s, g in zip(sizes, groups, strict=True) if g == k) for k in range(7)]
    assert max(loads) <= 4 / 3 * max(sum(sizes) / 7, max(sizes))
    assert compaction.longest_first([], 3) == [] and compaction.longest_first([1.0, 1.0], 2) == [0, 1]


@pytest.fixture(scope="module")
def lake(spark):
    from datetime import datetime

    at = datetime(2025, 6, 1)
    settings_ = [(1, "a", "flush.size", " 3 ", datetime(2025, 1, 1)), (2, "a", "flush.size", "", datetime(2025, 7, 1)), (3, "a", "file.size.bytes", None, datetime(2025, 1, 1)), (4, "b", "file.size.bytes", "20", datetime(2025, 1, 1)), (5, "b", "file.size.bytes", "x", datetime(2025, 5, 1)), (6, "a", "flush.size", "9", datetime(2025, 8, 1))]
    line = '{"x":1}\n'

    def f(i, topic, content, end=None, when=at, first=0, last=0, part=0):
        return (i, topic, part, first, last, None, 99, 1, end, when, content, "d", 1)

    files = [
        f(1, "a", line * 2), f(2, "a", line * 3), f(3, "a", line * 2 + "\n \r\n", first=3, last=4), f(4, "a", line, end=9), f(5, "a", '\r\n{"x":1}\r\n{"x":1}'),  # 5 repeats 1
        f(6, "a", line * 5, when=datetime(2025, 7, 2)), f(7, "a", "", first=5, last=4), f(8, "a", None, first=6), f(9, "b", line * 9), f(10, None, line), f(11, "a", line, when=None, part=None), f(12, "a", '{"x":1}\r{"x":2}\r\n{"x":3}', first=7), f(13, "a", line * 3),  # 13 repeats 2, neither is small
    ]
    return spark.createDataFrame(files, FILES), spark.createDataFrame(settings_, SETTINGS)


def test_small_files(spark, lake):
    files, settings_ = lake
    assert {r.file_id for r in compaction.found(files, settings_).collect()} == {1, 3, 5, 6, 7, 8, 9, 10, 11}
    assert compaction.found(files.limit(0), settings_.limit(0)).collect() == []
    dup = {r.file_id: r.duplicate_of for r in compaction.plan(files, settings_).collect()}
    assert dup[5] == 1 and all(v is None for k, v in dup.items() if k != 5)


def test_compaction_keeps_every_record_once(spark, lake, tmp_path):
    import pyarrow.parquet as pq

    files, settings_ = lake
    done = compaction.compact(files, settings_, str(tmp_path / "out")).collect()
    entries = [json.loads(x) for x in next((tmp_path / "out").glob("manifest-*.json")).read_text().splitlines()]
    manifest = [m for m in entries if "path" in m]
    assert {(m["retired"], m["duplicate_of"]) for m in entries if "retired" in m} == {(i, None) for i in (1, 3, 6, 7, 8, 9, 10, 11)} | {(5, 1), (13, 2)}
    assert {r.path for r in done} == {m["path"] for m in manifest}
    seen = defaultdict(int)
    for m in manifest:
        for r in pq.read_table(m["path"]).to_pylist():
            seen[r["file_id"]] += 1
    assert seen == {1: 2, 3: 2, 6: 5, 9: 9, 10: 1, 11: 1}
    assert sum(r.n_records for r in done) == 20


def test_compaction_of_a_flush_merged_under_another_id(spark, lake, tmp_path):
    import pyarrow.parquet as pq

    settings_ = lake[1]
    line = lambda *xs: "".join(f'{{"x":{x}}}\n' for x in xs)

    def f(i, first, last, content, begin=1, end=None, part=0):
        return (i, "z", part, first, last, None, None, begin, end, None, content, "d", 1)

    rows = [
        f(1, 0, 1, line(1, 2), end=5), f(2, 2, 2, line(3), end=5), f(3, 0, 2, line(1, 2, 3), begin=5, end=8),  # 1 and 2 became 3, then 6
        f(4, 0, 1, "\r\n" + line(1, 2)), f(5, 0, 1, line(1, 2)), f(6, 0, 4, line(1, 2, 3, 4, 4), begin=8),  # 4 and 5 repeat 1
        f(7, 9, 10, line(4, 4), end=9), f(8, 9, 10, line(4, 4)), f(9, 8, 12, line(4, 5, 6), begin=9),  # 9 lacks one of 8's
        f(10, 20, 20, line(7), end=9), f(11, 20, 20, line(7)), f(12, 19, 21, line(7), begin=9, part=1),  # another partition
        f(13, 30, 31, line(8, 9), end=9), f(14, 30, 31, line(8, 9)), f(15, 30, 31, line(9, 8), begin=9),  # merged alone
        f(16, 40, None, line(10), end=9), f(17, 40, None, line(10)),  # no offsets
        f(18, 50, 50, line(11)), f(19, 49, 51, line(11, 12)),  # no copy was merged
        f(20, 60, 61, line(1, 2), begin=7), f(21, 60, 61, line(2, 1), begin=7), f(22, 60, 61, line(1, 2), end=7), f(23, 60, 61, line(2, 1), end=7),  # a ring but for the order
    ]
    files = spark.createDataFrame(rows, FILES)
    dup = {r.file_id: r.duplicate_of for r in compaction.plan(files, settings_).collect()}
    assert {k: v for k, v in dup.items() if v} == {4: 6, 5: 6, 14: 15, 21: 20} and len(dup) == 14
    assert {r.file_id for r in compaction.found(files, settings_).collect()} == set(dup)
    done = compaction.compact(files.where("file_id <= 6"), settings_, str(tmp_path / "out")).collect()
    assert sorted(x for r in done for x in pq.read_table(r.path)["record"].to_pylist()) == sorted(line(1, 2, 3, 4, 4).split())
    retired = {m["retired"]: m["duplicate_of"] for m in map(json.loads, next((tmp_path / "out").glob("manifest-*.json")).read_text().splitlines()) if "retired" in m}
    assert retired == {4: 6, 5: 6, 6: None}


def test_jobs_on_one_target_and_a_fault(spark, lake, tmp_path):
    """Two jobs leave two manifests, a published job isn't repeated, and a pair lost for another pair written twice is seen."""
    import pyarrow.parquet as pq

    files, settings_ = lake
    target = str(tmp_path / "out")
    for job in ("one", "two"):
        compaction.compact(files, settings_, target, job)
    assert sorted(p.name for p in (tmp_path / "out").glob("manifest-*")) == ["manifest-one.json", "manifest-two.json"]
    with pytest.raises(FileExistsError):
        compaction.compact(files, settings_, target, "one")
    two = spark.createDataFrame([(1, "z", 0, 0, 3, None, None, 1, None, None, "a\na\nb\nb\n", "d", 1)], FILES)
    marked = compaction.live(two, settings_, check=True)
    todo = compaction.plan(two, settings_, marked)
    compaction.compact(two, settings_, str(tmp_path / "z"), "z")
    path = next((tmp_path / "z/data/z").glob("*.parquet"))
    written = spark.createDataFrame([("z", 0, 0, 0, str(path), 1, 4, 8)], compaction._WRITTEN)
    assert compaction._mismatches(todo, marked, written, str(tmp_path / "z/data/z")) == 0
    t = pq.read_table(path)
    pq.write_table(t.set_column(2, "record", [["a", "a", "a", "a"]]), path)
    assert compaction._mismatches(todo, marked, written, str(tmp_path / "z/data/z")) == 1


# -------------------------------------------------------------------------------------------------- 4


def test_em_learns_the_order():
    def day_first(day, month, both, registered=None):
        w = timenorm.mixture({"numeric/:a": day, "numeric-:b": month, "numeric/:ab": both, "ymd:a": 20, "none:": 3}, registered)
        return w["dmy"] / (w["dmy"] + w["mdy"])

    assert day_first(50, 0, 50) > 0.97 and day_first(0, 50, 50) < 0.03
    assert day_first(0, 0, 10) == pytest.approx(0.5)
    assert day_first(0, 5, 50, "dmy") > 0.98


def test_em_prefers_a_registered_order_but_not_against_all_data():
    choose = lambda counts, fits, order: timenorm.choose(fits, timenorm.mixture(counts, order), 0.95)
    some = {"numeric/:a": 500, "numeric/:b": 400, "numeric/:ab": 100}
    assert choose(some, "numeric/:ab", "mdy")[0] == "b" and choose(some, "numeric/:a", "mdy")[3] == "unreadable"
    assert choose(some, "numeric/:ab", None)[3] == "ambiguous" and choose(some, "numeric/:a", None)[::3] == ("a", "normalised")
    against = {"numeric/:a": 100_000, "numeric/:ab": 10}
    assert choose(against, "numeric/:a", "mdy")[::3] == ("a", "normalised")
    assert choose(some, "none:", None)[3] == "unreadable" and choose({"ymd:a": 1}, "ymd:a", None)[::3] == ("a", "normalised")


def test_notations_exclude_each_other():
    texts = ["2024-01-02 03:04", "02/01/2024 03:04", "02.01.2024 03:04:05", "2 Jan 2024 03:04", "Jan 2, 2024 03:04", "20240102T0304", "202401020304", "Tue, 02 Jan 2024 03:04:05 GMT", "2024.1.2 3:04", "1704164645", "1704164645123"]
    for t in texts:
        assert sum(p.fullmatch(t) is not None for _, p in clock._NOTATIONS) + (clock._COUNT.fullmatch(t) is not None) == 1, t


def test_sources_without_an_order(spark, topics):
    """Conflicting dates stay ambiguous, and say so; consistent ones settle the doubtful."""
    rows = [(i, "free", f"{13 + i % 15}/04/2024 10:00" if i % 2 else f"04/{13 + i % 15}/2024 10:00", None) for i in range(40)]
    rows += [(100, "free", "04/05/2024 10:00", None), (101, "free", "05-05-2024 10:00", None)]
    rows += [(200 + i, "none", f"{13 + i % 15}/04/2024 10:00", None) for i in range(60)] + [(300, "none", "04/05/2024 10:00", None)]
    df = spark.createDataFrame(rows, "row_id bigint, topic string, created_at string, record_timestamp string")
    got = {r.row_key: r for r in timenorm.normalise(df, topics, key="row_id").collect()}
    assert got[100].status == "ambiguous" and got[100].other_us not in (None, got[100].utc_us)
    assert got[101].status == "normalised" and got[101].other_us is None
    assert got[300].status == "normalised" and got[300].utc_us == 1714816800_000000 and got[300].posterior > 0.95  # 4 May
    assert {got[i].status for i in range(40)} == {"normalised"}
    assert timenorm.found(df, topics).count() == len(rows)


def test_times(spark, topics):
    rows = [(1, "c", "04/12/2024 10:00", None), (2, "u", "04/12/2024 10:00", "2024-01-01T00:00:00.000000Z"), (3, "free", "04/12/2024 10:00", " "), (4, "c", "04/25/2024 10:00", None), (5, None, "2024-01-01 10:00", None), (6, "free", "25/04/2024 10:00", "x" * 50_000), (1, "c", "04/12/2024 10:00", None)]
    df = spark.createDataFrame([(*r, "p") for r in rows], "row_id bigint, topic string, created_at string, record_timestamp string, text string")
    got = {(r.row_key, r.field_name): r for r in timenorm.normalise(df, topics).collect()}
    assert timenorm.normalise(df, topics).count() == 10
    at = lambda k: got[k, "created_at"]
    assert at(1).utc_us == 1733302800_000000 and at(1).status == "normalised"  # 4 December 9:00 UTC
    assert at(2).utc_us == 1712930400_000000  # 12 April 14:00 UTC
    assert at(3).status == "ambiguous" and at(3).other_us is not None
    assert at(4).status == "unreadable" and at(6).status == "normalised"
    assert at(5).utc_us == 1704103200_000000
    assert got[2, "record_timestamp"].status == "canonical" and got[6, "record_timestamp"].status == "unreadable"
    found = timenorm.found(df, topics).collect()
    assert len(found) == 6 and {r.row_id for r in found} == {1, 2, 3, 5, 6}
    assert timenorm.found(df.limit(0), topics.limit(0)).collect() == []


# -------------------------------------------------------------------------------------------------- 5


def brute_copies(rows, ids):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    key = {}
    for d, t, p, o, v in rows:
        find(d)
        ks = [("p", t, p, o)] if None not in (t, p, o) else []
        record = json.loads(v) if v is not None else None
        if ids.get(t) and record is not None and all(record.get(c) is not None for c in ids[t]):
            ks.append(("c", t, json.dumps(record, sort_keys=True)))
        for k in ks:
            if k in key:
                a, b = find(d), find(key[k])
                parent[max(a, b)] = min(a, b)
            else:
                key[k] = d
    return {(find(d), d) for d, *_ in rows if find(d) != d}


@pytest.mark.parametrize("seed", range(3))
def test_copies_equal_brute_force(spark, topics, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(400):
        t = rnd.choice(["t", "u", "free", None])
        value = rnd.choice([None, {"id": rnd.randint(0, 40)}, {"a": 1, "b": rnd.choice([None, rnd.randint(0, 9)])}, {"x": 1}])
        text = None if value is None else json.dumps(dict(sorted(value.items(), reverse=rnd.random() < 0.5)), separators=rnd.choice([(",", ":"), (", ", " : ")]))
        rows.append((i, t, rnd.choice([0, 1, None]), rnd.randint(0, 150), text))
    rnd.shuffle(rows)
    from datetime import datetime, timedelta

    df = spark.createDataFrame([(d, 0, t, p, o, None, v, None if d % 50 == 0 else datetime(2025, 1, 1) + timedelta(hours=d), "x", "x", "x", "x") for d, t, p, o, v in rows], SINK)
    want = brute_copies(rows, {"t": ["id"], "u": ["a", "b"]})
    assert {tuple(r) for r in dedupe.copies(df, topics).collect()} == want
    kept = {r.delivery_id for r in dedupe.keep_first(df, topics).select("delivery_id").collect()}
    assert kept == {d for d, *_ in rows} - {c for _, c in want}


def test_long_chains_and_hot_keys(spark, topics):
    # copies of copies: place i, content i; then place i + 1 with content i
    rows = [(2 * i + k, 0, "t", 0, i + k, None, json.dumps({"id": i}), None, "x", "x", "x", "x") for i in range(60) for k in (0, 1)]
    rows += [(1000 + i, 0, "free", 1, 7, None, None, None, "x", "x", "x", "x") for i in range(3000)]
    rows += [(None, 0, "free", 1, 7, None, None, None, "x", "x", "x", "x"), (1000, 0, "free", 1, 7, None, None, None, "x", "x", "x", "x")]
    got = {tuple(r) for r in dedupe.copies(spark.createDataFrame(rows, SINK), topics).collect()}
    assert got == {(0, i) for i in range(1, 120)} | {(1000, 1000 + i) for i in range(1, 3000)}


def test_copies_of_nothing(spark, topics):
    assert dedupe.copies(spark.createDataFrame([], SINK), topics.limit(0)).collect() == []


def test_blooms_never_miss():
    import numpy as np

    rnd = np.random.default_rng(1)
    f = dedupe.Blooms(10_000)
    h = rnd.integers(0, 1 << 63, 20_000).astype(np.uint64)
    f.add(h[:10_000], 3)
    f.add(h[10_000:], 63)
    held = f.held_by(h)
    assert (held[:10_000] >> np.uint64(3) & np.uint64(1)).all() and (held[10_000:] >> np.uint64(63) & np.uint64(1)).all()
    assert (f.held_by(rnd.integers(0, 1 << 63, 50_000).astype(np.uint64)) != 0).mean() < 0.04


def test_copies_with_a_stray_date_and_a_hot_identifier(spark, topics):
    """A third of the rows under one place, one date far off, times that are equal, and null times."""
    from datetime import datetime, timedelta

    rows = []
    for i in range(900):
        at = datetime(1970, 1, 1) if i == 7 else None if i % 50 == 0 else datetime(2024, 1, 1) + timedelta(minutes=i // 3)
        rows.append((i, 1, "t", 0, 5 if i % 3 == 0 else i, None, '{"id": %d}' % i, at, "", "", "", ""))
    got = {tuple(r) for r in dedupe.copies(spark.createDataFrame(rows, SINK), topics).collect()}
    assert {(0, i) for i in range(3, 900, 3)} <= got


def test_components_of_a_long_chain(spark):
    import random

    names = list(range(300))
    random.Random(3).shuffle(names)
    links = spark.createDataFrame([(a, b) for a, b in zip(names, names[1:])] + [(1000, 1001)], "a long, b long")
    got = {(r.node, r.root) for r in dedupe.components(links).collect()}
    assert got == {(n, 0) for n in names} | {(1000, 1000), (1001, 1000)}


def test_planted_tables_are_found(spark, sf01):
    """Counts of the small tables stay what an independent reading of them gives."""
    records = read_table(spark, sf01, "sink_records")
    topics_ = read_table(spark, sf01, "sink_topics")
    ids = {r.topic: [c.strip() for c in r.table_id_columns.split(",")] for r in topics_.collect() if r.table_id_columns}
    rows = [(r.delivery_id, r.topic, r.kafka_partition, r.kafka_offset, r.record_value) for r in records.collect()]
    assert {tuple(r) for r in dedupe.copies(records, topics_).collect()} == brute_copies(rows, ids)
