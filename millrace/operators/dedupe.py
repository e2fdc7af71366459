"""Messages delivered more than once: keep exactly one copy of each.

A message is known by identifiers: its place in the log (topic, partition, offset), and, where the topic has id columns,
its whole content beside them. Deliveries that share an identifier are copies, and so are copies of copies.

One pass over the records writes the identifiers to bucketed storage: time buckets of about equal size, sorted by bucket in
each file. Only fingerprints of them, five bytes each, are shuffled, to hash ranges. There a Bloom filter per time bucket screens them
in order of arrival: a fingerprint no filter holds is definitely new and its identifier is never looked at again. A possible
repeat names the buckets that may hold it, and is verified by the full identifier, read from those buckets only. What is
verified forms a small graph whose components are the messages.
"""

from __future__ import annotations

from collections.abc import Iterator

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import timestamps as ts
from millrace.session import cut, registry_rows, ship

#: Time buckets; as many as a word of the filters has bits.
BUCKETS = 64
BITS_PER_KEY = 12
HASHES = 5
#: Identifiers of one hash range, about; its filters take BITS_PER_KEY bits for each.
RANGE_KEYS = 4_000_000
#: Hashes a task packs at a time.
PACK = 1 << 18
#: Bits of a fingerprint within its hash range; what meets by chance is verified like what the filters let through.
FINGERPRINT = 40
#: Possible repeats (16 bytes each) and repeated identifiers (their bytes) are broadcast up to this many, beyond it they are joined
#: by shuffle.
BROADCAST_REPEATS = 2_000_000
BROADCAST_IDENTIFIERS = 400_000


class Blooms:
    """A Bloom filter for each of up to 64 buckets, over 64-bit hashes, in numpy. Place p of all filters lies in one word, bucket b
    being bit b, so that one look at a place asks all filters."""

    def __init__(self, expected: int, bits_per_key: int = BITS_PER_KEY, hashes: int = HASHES):
        """``expected``: keys of the fullest bucket."""
        self.places = max(64, 1 << math.ceil(math.log2(max(1, expected) * bits_per_key)))
        self.words = np.zeros(self.places, np.uint64)
        self.hashes = hashes

    def _places(self, h: np.ndarray) -> Iterator[np.ndarray]:
        x = h.astype(np.uint64)
        a = x * np.uint64(0x9E3779B97F4A7C15)
        b = (x ^ (x >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F) | np.uint64(1)
        for i in range(self.hashes):
            yield ((a + np.uint64(i) * b) >> np.uint64(17)) & np.uint64(self.places - 1)

    def add(self, h: np.ndarray, bucket: int) -> None:
        for p in self._places(h):
            self.words[p] |= np.uint64(1 << bucket)

    def held_by(self, h: np.ndarray) -> np.ndarray:
        """Per hash a word with the bit of every bucket that may hold it."""
        out = np.full(len(h), ~np.uint64(0))
        for p in self._places(h):
            out &= self.words[p]
        return out


def identifiers(records: DataFrame, topics: DataFrame) -> DataFrame:
    """One row per delivery and identifier: delivery_id, at (microseconds), identifier (bytes).

    The place counts if topic, partition and offset are there; the content if the topic has id columns and none of them is
    null or missing in record_value. Content is compared as JSON: key order, spacing and the spelling of numbers aside.
    Deliveries without delivery_id are left out."""
    ids = {r.topic: [c.strip() for c in r.table_id_columns.split(",") if c.strip()] for r in registry_rows(topics.select("topic", "table_id_columns")) if r.topic is not None and r.table_id_columns}
    src = records.where(F.col("delivery_id").isNotNull()).select("delivery_id", "topic", "kafka_partition", "kafka_offset", "record_value", _at(records).alias("at"))
    src = src.withColumn("v", F.expr("try_parse_json(record_value)"))
    whole = F.lit(False)
    for columns in sorted({tuple(c) for c in ids.values() if c}):
        of = sorted(t for t, c in ids.items() if tuple(c) == columns)
        there = F.lit(True)
        for c in columns:
            there = there & F.expr("try_variant_get(v, \"$['" + c.replace("'", "\\'") + "']\", 'string')").isNotNull()
        whole = whole | (F.col("topic").isin(of) & there)
    place = F.when(F.col("kafka_partition").isNotNull() & F.col("kafka_offset").isNotNull() & F.col("topic").isNotNull(), F.concat_ws("\x01", F.lit("p"), "topic", "kafka_partition", "kafka_offset").cast("binary"))
    content = F.when(whole, F.concat(F.concat_ws("\x01", F.lit("c"), F.col("topic"), F.lit("")).cast("binary"), F.unhex(F.sha2(F.to_json("v"), 256))))
    return src.select("delivery_id", "at", F.explode(F.array(place, content)).alias("identifier")).where("identifier is not null")


def _at(records: DataFrame) -> Column:
    return ts.micros("delivered_at", dict(records.dtypes)["delivered_at"])


def _bucket(at: Column, edges: list[int]) -> Column:
    """Number of the edges below ``at``, by halving; null is 0."""
    if not edges:
        return F.lit(0)
    mid = len(edges) // 2
    return F.when(at > edges[mid], F.lit(mid + 1) + _bucket(at, edges[mid + 1 :])).otherwise(_bucket(at, edges[:mid]))


def _unpacked(prints: bytes) -> np.ndarray:
    wide = np.zeros((len(prints) * 8 // FINGERPRINT, 8), np.uint8)
    wide[:, : FINGERPRINT // 8] = np.frombuffer(prints, np.uint8).reshape(-1, FINGERPRINT // 8)
    return wide.view("<u8").ravel()


def _pack():
    """(key, bucket) to rows (range, bucket, packed fingerprints). Of keys a task meets again two are sent, so that a hot one is
    little."""

    def packed(key: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((key, b, key >> np.uint64(FINGERPRINT)))
        key, b = key[order], b[order]
        third = np.zeros(len(key), bool)
        third[2:] = (key[2:] == key[:-2]) & (b[2:] == b[:-2])
        key, b = key[~third], b[~third]
        r = key >> np.uint64(FINGERPRINT)
        starts = np.flatnonzero(np.r_[True, (b[1:] != b[:-1]) | (r[1:] != r[:-1])])
        ends = np.r_[starts[1:], len(key)]
        low = key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : FINGERPRINT // 8]
        return pa.RecordBatch.from_arrays([pa.array(r[starts].astype(np.int32)), pa.array(b[starts].astype(np.int32)), pa.array([low[i:j].tobytes() for i, j in zip(starts, ends, strict=True)], pa.binary())], names=["range", "bucket", "prints"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hs, bs, n = [], [], 0
        for batch in it:
            hs.append(batch.column(0).to_numpy().view(np.uint64))
            bs.append(batch.column(1).to_numpy())
            n += batch.num_rows
            if n >= PACK:
                yield packed(np.concatenate(hs), np.concatenate(bs))
                hs, bs, n = [], [], 0
        if n:
            yield packed(np.concatenate(hs), np.concatenate(bs))

    return run


def _screen(expected: int):
    """Per partition (whole hash ranges, buckets in order): (key, bucket) of possible repeats and of the buckets that may hold them."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, filters = None, None
        for batch in it:
            out_h, out_b = [], []
            for r, bucket, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r != at:
                    at, filters = r, Blooms(expected)
                h, n = np.unique(_unpacked(packed), return_counts=True)
                held = filters.held_by(h)
                filters.add(h, bucket)
                hit = (held != 0) | (n > 1)
                if hit.any():
                    h, held = h[hit] | np.uint64(r << FINGERPRINT), held[hit] | np.uint64(1 << bucket)
                    for b in range(BUCKETS):
                        mine = h[(held >> np.uint64(b)) & np.uint64(1) == 1]
                        if len(mine):
                            out_h.append(mine)
                            out_b.append(np.full(len(mine), b, np.int32))
            if out_h:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_h).view(np.int64)), pa.array(np.concatenate(out_b))], names=["key", "bucket"])

    return run


def verified(records: DataFrame, topics: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(delivery_id, low, high): the least and greatest first delivery over the identifiers a delivery shares with others.

    Records are read twice: their times, for the edges of the buckets, and once whole."""
    ship(records.sparkSession)
    buckets = min(max(2, buckets), BUCKETS)
    span = records.agg(F.percentile_approx(_at(records), [i / buckets for i in range(1, buckets)], 10_000).alias("edges"), (F.count(F.lit(1)) * 2).alias("n")).first()
    edges = sorted(set(span.edges or []))
    crowd = 1 + max((list(span.edges).count(e) for e in edges), default=buckets - 1)  # shares of the rows that lie in one bucket, if times are equal
    ranges = max(1, math.ceil(span.n / RANGE_KEYS), int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    h = F.xxhash64("identifier")
    key = F.pmod(h, F.lit(ranges)) * F.lit(1 << FINGERPRINT) + F.shiftrightunsigned(h, 64 - FINGERPRINT)  # range and fingerprint
    stored = identifiers(records, topics).select("delivery_id", _bucket(F.col("at"), edges).cast("int").alias("bucket"), key.alias("key"), "identifier")
    stored = cut(stored.sortWithinPartitions("bucket"))
    packed = stored.select("key", "bucket").mapInArrow(_pack(), "range int, bucket int, prints binary")
    expected = max(64, 2 * span.n * crowd // (ranges * buckets))
    possible = cut(packed.repartition(ranges, "range").sortWithinPartitions("range", "bucket").mapInArrow(_screen(expected), "key long, bucket int").distinct())
    met = possible.agg(F.count(F.lit(1)).alias("n"), F.collect_set("bucket").alias("buckets")).first()
    matching = stored.where(F.col("bucket").isin(sorted(met.buckets)))
    held = cut(matching.join(F.broadcast(possible) if met.n <= BROADCAST_REPEATS else possible, ["key", "bucket"]).select("delivery_id", "bucket", "identifier"))
    repeated = cut(held.groupBy("identifier").agg(F.min("delivery_id").alias("low"), F.max("delivery_id").alias("high")).where("low <> high").select("identifier", "low"))
    if repeated.count() <= BROADCAST_IDENTIFIERS:
        shared = held.join(F.broadcast(repeated), "identifier")
    else:  # a hot identifier's deliveries are spread over the buckets
        firsts = held.select("identifier", "bucket").distinct().join(repeated, "identifier")
        shared = held.join(firsts, ["identifier", "bucket"])
    # a delivery has two identifiers at most, so least and greatest are both
    return shared.groupBy("delivery_id").agg(F.min("low").alias("low"), F.max("low").alias("high"))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the least node of everything reachable over the links (a, b).

    Every round a node's parent falls to the least grandparent among its neighbours', the parent's too, so that whole trees
    are hooked on at once; chains of n take about log n rounds. Each round's state is cut off in the shared folder."""
    edges = cut(links.select("a", "b").union(links.select("b", "a")).toDF("a", "b").distinct())
    state = cut(edges.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("parent")))
    for _ in range(rounds):
        up = state.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        seen = state.join(up, "parent").select("node", "parent", "grand")
        near = edges.join(seen.select(F.col("node").alias("b"), "grand"), "b").groupBy("a").agg(F.min("grand").alias("grand"))
        hooks = near.join(state.withColumnRenamed("node", "a"), "a").select("parent", "a", "grand")
        falls = seen.select("node", "grand").union(hooks.select("parent", "grand")).union(hooks.select("a", "grand"))
        new = cut(falls.groupBy("node").agg(F.min("grand").alias("parent")))
        changed = new.join(state.withColumnRenamed("parent", "old"), "node").where("parent <> old").limit(1).count()
        state = new
        if not changed:
            return state.withColumnRenamed("parent", "root")
    raise RuntimeError(f"copies of copies didn't settle in {rounds} rounds")


def groups(records: DataFrame, topics: DataFrame) -> DataFrame:
    """(delivery_id, first_id) of all deliveries that have copies; identifiers joined by a common delivery are one message."""
    shared = cut(verified(records, topics))
    links = cut(shared.where("low <> high").select(F.col("high").alias("a"), F.col("low").alias("b")).distinct())
    if links.isEmpty():
        return shared.select("delivery_id", F.col("low").alias("first_id"))
    roots = components(links).withColumnRenamed("node", "low")
    return shared.join(roots, "low", "left").select("delivery_id", F.coalesce("root", "low").alias("first_id"))


def copies(records: DataFrame, topics: DataFrame) -> DataFrame:
    """Every delivery that isn't the first of its group: first_id, copy_id. Empty input: no rows; a delivery_id that
    appears in several identical rows counts once; other columns are not read."""
    return groups(records, topics).where("delivery_id <> first_id").select("first_id", F.col("delivery_id").alias("copy_id"))


def keep_first(records: DataFrame, topics: DataFrame) -> DataFrame:
    """The records without their copies."""
    gone = copies(records, topics).select(F.col("copy_id").alias("__gone"))
    return records.join(gone, records["delivery_id"] == gone["__gone"], "left_anti")
