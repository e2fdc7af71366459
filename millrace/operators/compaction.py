"""Far too many small files: find them, assign them to fewer well-sized groups, write the groups, publish a manifest.

Files smaller than both sizes in force at their flush are candidates. Candidates written twice (same offsets, same
records) count once, also where one of the two is merged already. The rest is assigned, longest first, to a fixed number of groups per topic and partition with a
least-loaded heap. Only file ids and sizes take part in that; a topic partition of very many files is planned in hashed
shards, so that no task holds an unbounded list. Groups are streamed into Parquet by pyarrow, every attempt under its own
name in a folder of the job's, read back and compared with their sources group by group. One manifest per job lists what was
verified and appears whole or not at all; jobs on one target don't overwrite each other's.
"""

from __future__ import annotations

import heapq
import json
import math
import os
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut, ship

DEFAULT_FLUSH_SIZE = 1_000_000
DEFAULT_FILE_BYTES = 268_435_456
#: Files of one planning shard at most, about.
SHARD_FILES = 20_000
#: A plan of at most so many files is broadcast (some 40 bytes each).
BROADCAST_FILES = 500_000
#: Offset ranges are cut into so many buckets more than files at most.
MOST_BUCKETS = 1_000_000


def _setting(settings: DataFrame, name: str, default: int, at: str) -> tuple[DataFrame, F.Column]:
    """Histories of one setting by topic, and the expression of the value in force at column ``at``."""
    col = "h_" + name.replace(".", "_")
    rows = settings.where((F.col("setting_name") == name) & F.col("valid_from").isNotNull() & F.col("topic").isNotNull())
    history = rows.groupBy("topic").agg(F.sort_array(F.collect_list(F.struct("valid_from", "setting_id", "setting_value"))).alias(col))
    last = F.expr(f"try_element_at(filter({col}, x -> x.valid_from <= {at}), -1).setting_value")
    value = F.trim(F.regexp_replace(last, r"^\s+|\s+$", "")).try_cast("bigint")
    return history, F.coalesce(value, F.lit(default))


def measured(files: DataFrame, settings: DataFrame) -> DataFrame:
    """Live files with their true sizes and the limits in force at flushed_at.

    Records are the non-blank lines of file_content, bytes its UTF-8 length; the recorded n_records and n_bytes are not
    trusted. Null content is an empty file; without flushed_at the defaults are in force."""
    h1, flush = _setting(settings, "flush.size", DEFAULT_FLUSH_SIZE, "flushed_at")
    h2, size = _setting(settings, "file.size.bytes", DEFAULT_FILE_BYTES, "flushed_at")
    live = files.where(F.col("end_snapshot").isNull()).select("file_id", "topic", "kafka_partition", "first_offset", "last_offset", "flushed_at", "file_content")
    sized = live.select(
        "*",
        F.coalesce(F.regexp_count("file_content", F.lit(r"\S[^\r\n]*")), F.lit(0)).cast("long").alias("true_records"),
        F.coalesce(F.octet_length("file_content"), F.lit(0)).cast("long").alias("true_bytes"),
    )
    out = sized.join(h1, "topic", "left").join(h2, "topic", "left")
    return out.withColumn("limit_records", flush).withColumn("limit_bytes", size).drop("h_flush_size", "h_file_size_bytes")


def longest_first(sizes: list[float], groups: int) -> list[int]:
    """Group of each file: files by falling size, each to the group of least load (ties: fewest files, lowest number)."""
    heap = [(0.0, 0, g) for g in range(max(1, groups))]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load, n, g = heapq.heappop(heap)
        out[i] = g
        heapq.heappush(heap, (load + sizes[i], n + 1, g))
    return out


PLAN = "file_id long, topic string, kafka_partition int, shard int, group_no int, duplicate_of long, true_records long, true_bytes long"


_FLUSH = ["topic", "kafka_partition", "first_offset", "last_offset", "digest"]


def _records(content: str = "file_content") -> F.Column:
    """The non-blank lines: the records alone, as the same flush may come with other line ends and blank lines."""
    return F.filter(F.split(F.coalesce(content, F.lit("")), r"\r\n|\n|\r"), lambda x: x.rlike(r"\S"))


def _low(record: F.Column) -> F.Column:
    return F.xxhash64(record).bitwiseAND(F.lit(0xFFFFFFFF))


def _high(record: F.Column) -> F.Column:
    return F.shiftrightunsigned(F.xxhash64(record), 32)


def live(files: DataFrame, settings: DataFrame, check: bool = False, merged: bool = True) -> DataFrame:
    """One row per live file: its sizes, limits, ``small`` (below both limits) and ``duplicate_of``: the smallest file_id of
    the same flush (same topic, partition, offsets and records; null for the first), or with ``merged`` the live file that holds
    its records since the flush's other copy was merged. The contents are read once, here, and for ``merged`` those of replaced
    files. ``check`` adds the sum of the records' hashes, in two halves: it doesn't depend on their order, and equal records don't
    cancel out."""
    ship(files.sparkSession)
    sized = measured(files, settings)
    digest = F.md5(F.array_join(_records(), "\n"))
    is_small = (F.col("true_records") < F.col("limit_records")) & (F.col("true_bytes") < F.col("limit_bytes"))
    sized = sized.withColumn("digest", digest).withColumn("small", is_small)
    if check:
        none = F.struct(F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high"))
        sized = sized.withColumn("check", F.aggregate(_records(), none, lambda acc, x: F.struct((acc["low"] + _low(x)).alias("low"), (acc["high"] + _high(x)).alias("high"))))
    sized = cut(sized.drop("file_content"))
    first = sized.groupBy(*[F.col(c).alias(f"f_{c}") for c in _FLUSH]).agg(F.min("file_id").alias("first_file"))
    same = [F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in _FLUSH]
    marked = sized.join(first, same, "left").withColumn("duplicate_of", F.when(F.col("file_id") != F.col("first_file"), F.col("first_file"))).drop("first_file", *[f"f_{c}" for c in _FLUSH])
    held = _held(files, sized, digest) if merged else None
    return marked if held is None else marked.join(held, "file_id", "left").withColumn("duplicate_of", F.coalesce("held_by", "duplicate_of")).drop("held_by")


def _held(files: DataFrame, sized: DataFrame, digest: F.Column) -> DataFrame | None:
    """Live files whose flush was merged under another file_id: file_id, held_by (smallest); None if there are none.

    held_by is a live file of the same topic and partition, no older than that merge, that covers the offsets and holds every
    record at least as often. So that files can't retire each other in a ring, it isn't such a copy itself or comes first by
    range, records, file_id. A copy whose records no such file holds stays."""
    gone = files.where(F.col("end_snapshot").isNotNull()).withColumn("digest", digest)
    gone = gone.groupBy(*[F.col(c).alias(f"f_{c}") for c in _FLUSH]).agg(F.min("end_snapshot").alias("merged_at"))
    own = ["topic", "kafka_partition", "first_offset", "last_offset", "true_records"]
    twins = sized.where("true_records > 0").join(gone, [F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in _FLUSH]).select("file_id", *[F.col(c).alias(f"f_{c}") for c in own], "merged_at")
    twins = cut(twins.where("f_first_offset is not null and f_last_offset is not null"))
    if twins.isEmpty():
        return None
    # ranges are found by buckets of about the mean range, so that files and buckets together grow as the files do
    ranges = sized.where("first_offset <= last_offset").join(files.select("file_id", "begin_snapshot"), "file_id").select("file_id", *own, "begin_snapshot")
    total = ranges.agg(F.sum(F.col("last_offset").cast("double") - F.col("first_offset").cast("double")).alias("span"), F.count(F.lit(1)).alias("n")).first()
    width = F.lit(max(1, int((total.span or 0) / max(1, min(total.n, MOST_BUCKETS)))))
    bucket = lambda c: F.floor(F.col(c) / width).cast("long")
    held = ranges.withColumn("bucket", F.explode(F.sequence(bucket("first_offset"), bucket("last_offset")))).withColumnRenamed("file_id", "held_by")
    held = held.join(twins.select(F.col("file_id").alias("held_by"), F.lit(True).alias("is_twin")), "held_by", "left")
    wider = (F.col("first_offset") < F.col("f_first_offset")) | (F.col("last_offset") > F.col("f_last_offset")) | (F.col("true_records") > F.col("f_true_records"))
    ahead = wider | F.col("is_twin").isNull() | (F.col("held_by") < F.col("file_id"))
    covers = (F.col("first_offset") <= F.col("f_first_offset")) & (F.col("last_offset") >= F.col("f_last_offset")) & (F.col("begin_snapshot").isNull() | (F.col("begin_snapshot") >= F.col("merged_at")))
    place = F.col("topic").eqNullSafe(F.col("f_topic")) & F.col("kafka_partition").eqNullSafe(F.col("f_kafka_partition")) & (F.col("bucket") == F.col("f_bucket"))
    pairs = cut(twins.withColumn("f_bucket", bucket("f_first_offset")).join(held, place & covers & ahead & (F.col("file_id") != F.col("held_by"))).select("file_id", "held_by").distinct())
    ids = pairs.select(F.explode(F.array("file_id", "held_by")).alias("file_id")).distinct()
    texts = files.select("file_id", "file_content").join(F.broadcast(ids) if pairs.count() * 2 <= BROADCAST_FILES else ids, "file_id")
    records = cut(texts.select("file_id", F.explode(_records()).alias("record")).groupBy("file_id", F.md5("record").alias("h")).agg(F.count(F.lit(1)).alias("n")))
    theirs = records.select(F.col("file_id").alias("held_by"), "h", F.col("n").alias("n_held"))
    compared = pairs.join(records, "file_id").join(theirs, ["held_by", "h"], "left").groupBy("file_id", "held_by").agg(F.min(F.coalesce("n_held", F.lit(0)) >= F.col("n")).alias("whole"))
    return compared.where("whole").groupBy("file_id").agg(F.min("held_by").alias("held_by"))


def plan(files: DataFrame, settings: DataFrame, marked: DataFrame | None = None) -> DataFrame:
    """One row per small live file: file_id, topic, kafka_partition, shard, group_no, duplicate_of, true sizes.

    Files to be merged have a group; a repeated flush has none but ``duplicate_of``. ``marked``: what :func:`live` gave."""
    marked = (live(files, settings) if marked is None else marked).where("small")
    counts = marked.groupBy(F.col("topic").alias("c_topic"), F.col("kafka_partition").alias("c_partition")).agg(F.ceil(F.count(F.lit(1)) / SHARD_FILES).cast("int").alias("shards"))
    sharded = marked.join(counts, F.col("topic").eqNullSafe(F.col("c_topic")) & F.col("kafka_partition").eqNullSafe(F.col("c_partition"))).withColumn("shard", F.pmod(F.xxhash64("file_id"), F.greatest("shards", F.lit(1))).cast("int"))
    sharded = sharded.select("file_id", "topic", "kafka_partition", "shard", "duplicate_of", "true_records", "true_bytes", "limit_records", "limit_bytes")

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("file_id").reset_index(drop=True)
        keep = pdf["duplicate_of"].isna()
        share = [max(r / max(1, lr), b / max(1, lb)) for r, lr, b, lb in zip(pdf["true_records"][keep], pdf["limit_records"][keep], pdf["true_bytes"][keep], pdf["limit_bytes"][keep], strict=True)]
        pdf["group_no"] = pd.array([None] * len(pdf), dtype="Int32")
        pdf.loc[keep, "group_no"] = pd.array(longest_first(share, math.ceil(sum(share) - 1e-9)), dtype="Int32")
        return pdf[[c.split()[0] for c in PLAN.split(", ")]]

    return sharded.groupBy("topic", "kafka_partition", "shard").applyInPandas(assign, PLAN)


def found(files: DataFrame, settings: DataFrame) -> DataFrame:
    """Every live file below both sizes in force: file_id."""
    return plan(files, settings, live(files, settings, merged=False)).select("file_id")


_WRITTEN = "topic string, kafka_partition int, shard int, group_no int, path string, n_files long, n_records long, n_bytes long"
#: A row group of a merged file holds about so many bytes of records.
ROW_GROUP_BYTES = 32 << 20
_WRITTEN_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
_FILE = pa.schema([("file_id", pa.int64()), ("line_no", pa.int32()), ("record", pa.string())])


def _lines(content: str | None) -> list[str]:
    """The records of a file: its lines that aren't blank, whatever ends them."""
    return [x for x in (content or "").replace("\r\n", "\n").replace("\r", "\n").split("\n") if x.strip(" \t\x0b\x0c")]


def _write(target: str):
    """Streams sorted rows (group keys, file_id, file_content) into one Parquet file per group; a row per file written."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(target)
        current, writer, state = None, None, {}
        ids, numbers, texts, held = [], [], [], 0

        def flush() -> None:
            nonlocal held
            writer.write_table(pa.table([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(texts, pa.string())], schema=_FILE))
            ids.clear(), numbers.clear(), texts.clear()
            held = 0

        def close() -> pa.RecordBatch:
            flush()
            writer.close()
            with fs.open_input_file(state["path"]) as f:
                back = pq.ParquetFile(f).metadata.num_rows
            if back != state["n_records"]:
                raise OSError(f"{state['path']}: {back} records read back, {state['n_records']} written")
            values = [*current, state["path"], state["n_files"], state["n_records"], state["n_bytes"]]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _WRITTEN_TYPES, strict=True)], names=[c.split()[0] for c in _WRITTEN.split(", ")])

        for batch in it:
            for row in batch.to_pylist():
                key = (row["topic"], row["kafka_partition"], row["shard"], row["group_no"])
                if key != current:
                    if writer is not None:
                        yield close()
                    current, state = key, {"path": f"{base}/{uuid.uuid4().hex}.parquet", "n_files": 0, "n_records": 0, "n_bytes": 0}
                    writer = pq.ParquetWriter(state["path"], _FILE, filesystem=fs, compression="zstd")
                lines = _lines(row["file_content"])
                size = sum(len(x.encode()) + 1 for x in lines)
                ids += [row["file_id"]] * len(lines)
                numbers += range(len(lines))
                texts += lines
                held += size
                state["n_files"] += 1
                state["n_records"] += len(lines)
                state["n_bytes"] += size
                if held >= ROW_GROUP_BYTES:
                    flush()
        if writer is not None:
            yield close()

    return run


def _mismatches(todo: DataFrame, marked: DataFrame, written: DataFrame, folder: str) -> int:
    """Groups whose merged file, as read back from storage, isn't what their sources hold: files, records, sum of hashes."""
    keys = ["topic", "kafka_partition", "shard", "group_no"]
    of_files = marked.select(F.col("file_id").alias("c_file"), "check")
    want = todo.join(of_files, F.col("file_id") == F.col("c_file")).groupBy(*keys).agg(F.count(F.lit(1)).alias("f"), F.sum("true_records").alias("r"), F.sum("check.low").alias("low"), F.sum("check.high").alias("high"))
    name = lambda c: F.element_at(F.split(c, "/"), -1).alias("name")
    back = todo.sparkSession.read.schema("record string").parquet(folder).select(name("_metadata.file_path"), "record")
    back = back.groupBy("name").agg(F.count(F.lit(1)).alias("b_r"), F.sum(_low(F.col("record"))).alias("b_low"), F.sum(_high(F.col("record"))).alias("b_high"))
    have = written.select(*[F.col(k).alias(f"w_{k}") for k in keys], name("path"), "n_files").join(back, "name", "left")
    both = want.join(have, [F.col(k).eqNullSafe(F.col(f"w_{k}")) for k in keys], "full_outer")
    same = (F.col("f") == F.col("n_files")) & (F.col("r") == F.coalesce("b_r", F.lit(0))) & (F.col("low") == F.coalesce("b_low", F.lit(0))) & (F.col("high") == F.coalesce("b_high", F.lit(0)))
    return both.where(~F.coalesce(same, F.lit(False))).count()


def compact(files: DataFrame, settings: DataFrame, target: str, job: str | None = None) -> DataFrame:
    """Merges all small files into ``target`` (a URI or path all executors share) and returns the manifest's rows.

    The manifest, ``manifest-<job>.json``, lists the merged files and every file they replace; repeated flushes are retired
    whatever their size, so that merged and remaining files hold each record once. ``job`` is a name of its own for every job, made
    up if not given; one that is published already is refused.

    Every group is written by one task, a file's records at a time, below ``data/<job>``. Before the manifest appears, every merged
    file is read back and compared with its sources; without it nothing counts as written. Files of failed attempts are deleted."""
    job = job or uuid.uuid4().hex
    uri = target if "://" in target or target.startswith("file:") else f"file://{os.path.abspath(target)}"
    uri = uri.replace("file:///", "file:/", 1).replace("file:/", "file:///", 1)
    fs, base = pafs.FileSystem.from_uri(uri)
    published = f"{base}/manifest-{job}.json"
    if fs.get_file_info(published).type != pafs.FileType.NotFound:
        raise FileExistsError(f"job {job} is published already")
    fs.create_dir(f"{base}/data/{job}", recursive=True)
    marked = cut(live(files, settings, check=True))
    todo = cut(plan(files, settings, marked).where("duplicate_of is null"))
    keys = ["topic", "kafka_partition", "shard", "group_no"]
    ids = todo.select(*keys, "file_id")
    # with a plan of checked size the contents are shuffled once, to their groups; beyond it they are joined by shuffle first
    rows = files.select("file_id", "file_content").join(F.broadcast(ids) if todo.count() <= BROADCAST_FILES else ids, "file_id")
    written = cut(rows.select(*keys, "file_id", "file_content").repartition(*keys).sortWithinPartitions(*keys, "file_id").mapInArrow(_write(f"{uri}/data/{job}"), _WRITTEN))
    if not todo.isEmpty() and (n := _mismatches(todo, marked, written, f"{uri}/data/{job}")):
        raise OSError(f"{n} merged files aren't what their sources hold; nothing was published")
    # an object appears when it is closed; elsewhere a file is written aside and renamed
    part = published if fs.type_name in ("s3", "gcs", "abfs") else f"{base}/.manifest-{uuid.uuid4().hex}"
    names = set()
    with fs.open_output_stream(part) as out:
        for r in written.orderBy(*keys).toLocalIterator():  # a row per output file, streamed
            names.add(r.path.rpartition("/")[2])
            out.write((json.dumps(r.asDict()) + "\n").encode())
        for r in marked.where("small or duplicate_of is not null").select("file_id", "duplicate_of").orderBy("file_id").toLocalIterator():
            out.write((json.dumps({"retired": r.file_id, "duplicate_of": r.duplicate_of}) + "\n").encode())
    if part != published:
        fs.move(part, published)
    for left in fs.get_file_info(pafs.FileSelector(f"{base}/data/{job}")):
        if left.base_name not in names and left.is_file:
            fs.delete_file(left.path)
    return written
