"""The sink as a Structured Streaming query: micro-batches of records into tables, effectively once.

A micro-batch is routed by topic. For each table its records are split by format (JSON text, Arrow payloads), checked
against the wanted schema, and written as one commit that carries the query's name and the batch id, so that a replayed
batch is a no-op. Offsets are committed by the checkpoint after the batch; a failure replays it. Buffering and flush timers are
the engine's: trigger interval, admission limits of the source. No file holds more than ``flush.size`` rows, whatever the source
admits; why a table's part of a batch was due is counted in the metrics as ``flush.<reason>``. With ``spill.enabled`` a
micro-batch is kept on disk only.

Records are ordered by (timestamp, where the stream has it, partition, offset): offsets of different partitions say nothing about
each other, so without timestamps the later partition's record counts as the later one. No two records have the same place.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.util import inheritable_thread_target

from millrace import routing
from millrace.config import Config
from millrace.metrics import Metrics
from millrace.operators import dlq, infer
from millrace.session import registry_rows
from millrace.operators.upsert import last_wins
from millrace.sources import arrow_ipc
from millrace.sources.table import Catalog, Table

#: Tables written at a time, unless the option ``threads`` says otherwise.
MOST_TABLES = 8
#: Columns of a record stream.
RECORD = "topic string, partition int, offset long, value binary"


def admission(config: Config, source: str, partitions: int = 1) -> dict[str, str]:
    """How much a micro-batch may take: the flush sizes, as the source's own limits. ``partitions`` are flushed together."""
    if source == "kafka":
        return {"maxOffsetsPerTrigger": str(config["flush.size"] * partitions), "kafka.max.poll.records": str(config["consumer.override.max.poll.records"])}
    return {"maxBytesPerTrigger": str(config["file.size.bytes"] * partitions)}


def records(spark: SparkSession, source: str, path: str | None, options: dict[str, str] | None = None, config: Config | None = None) -> DataFrame:
    """A record stream: ``kafka`` where its connector is on the class path (topic, partition, offset, value), else a file
    source of that format whose files have these columns (Kafka's has the record's timestamp too). With ``config``, flush sizes
    bound each micro-batch."""
    options = {**(admission(config, source) if config else {}), **(options or {})}
    reader = spark.readStream.format(source).options(**options)
    if source == "kafka":
        return reader.load().select("topic", "partition", "offset", "value", "timestamp")
    return reader.schema(RECORD).load(path)


class Progress(StreamingQueryListener):
    """Feeds the engine's own progress reports of a sink's query into its metrics."""

    def __init__(self, name: str, metrics: Metrics):
        self.name, self.metrics = name, metrics

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if p.name == self.name:
            self.metrics.record("input-rows", p.numInputRows)
            self.metrics.record("trigger-ms", p.batchDuration)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def _order(rows: DataFrame) -> list[str]:
    """The columns that order records."""
    return [c for c in ("timestamp", "partition", "offset") if c in rows.columns]


class Sink:
    """foreachBatch target. ``transform`` maps each table's typed rows before they are written."""

    def __init__(self, spark: SparkSession, config: Config, name: str = "sink", transform: Callable[[str, DataFrame], DataFrame] | None = None, dead_letters: bool = True, metrics: Metrics | None = None):
        self.spark, self.config, self.name, self.transform, self.dead_letters = spark, config, name, transform, dead_letters
        self.metrics = metrics or Metrics()
        self.routes = routing.parse(config["topic2table.map"])
        self.catalog = Catalog(spark, str(config["data_path"]), self.metrics, str(config["catalog_uri"]) or None)
        self.level = StorageLevel.DISK_ONLY if config["spill.enabled"] else StorageLevel.MEMORY_AND_DISK
        for key, value in config.hadoop().items():
            spark._jsc.hadoopConfiguration().set(key, value)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(self.level)
        try:
            routed = batch.withColumn("__table", routing.route("topic", self.routes))
            names = [r[0] for r in registry_rows(routed.select("__table").distinct().orderBy("__table")) if r[0] is not None]

            @inheritable_thread_target(self.spark)
            def one(name: str) -> None:
                self.write(name, routed.where(F.col("__table") == name).drop("__table"), batch_id)

            if self.config["parallel.partition.flush"] and len(names) > 1:  # tables are independent: their jobs run side by side
                with ThreadPoolExecutor(min(len(names), self.config["threads"] or MOST_TABLES)) as pool:
                    list(pool.map(one, names))
            else:
                for name in names:
                    one(name)
        finally:
            batch.unpersist()

    def write(self, name: str, rows: DataFrame, batch_id: int) -> None:
        """One table's part of a micro-batch."""
        payloads, texts = arrow_ipc.split_formats(rows, "value")
        options = self.config.table(name)
        table = self.catalog.table(name)
        common = {"small": self.config["data.inlining.row.limit"] or 0, "keys": list(options.id_columns), "auto_create": options.auto_create, "partition_by": list(options.partition_by), "retries": self.config["max_retry_count"], "max_records": self.config["flush.size"], "batch": batch_id}
        if not texts.isEmpty():
            self._write_texts(name, table, texts.withColumn("value", F.col("value").cast("string")), common)
        if not payloads.isEmpty():
            places = _order(payloads)
            hidden = {c: f"__{c}" for c in places}
            typed = arrow_ipc.read(payloads, "value", keep=hidden, row="__row")
            self.finish(name, table, typed, [*hidden.values(), "__row"], common, f"{self.name}/ipc")  # within a payload the last row

    def finish(self, name: str, table: Table, typed: DataFrame, places: list[str], common: dict, stream: str) -> None:
        """Typed rows into the table: of several states of a key the last by their places, which are then dropped."""
        keys = common["keys"]
        if keys and {k.lower() for k in keys} <= {c.lower() for c in typed.columns}:
            typed = last_wins(typed, keys, places)
        typed = typed.drop(*places)
        typed = self.transform(name, typed) if self.transform else typed
        table.write(typed, stream=stream, **common)

    def _write_texts(self, name: str, table: Table, texts: DataFrame, common: dict) -> None:
        keep = [c for c in ("topic", "partition", "offset", "timestamp") if c in texts.columns]
        state = table.state()
        if state and state.batches.get(f"{self.name}/text", -1) >= common["batch"]:
            return
        places = _order(texts)
        schema = dlq.wanted(texts, "value", places, state.schema if state else None)
        marked = dlq.checked(texts, "value", schema, keep).persist(self.level)
        try:
            n, n_bad, size = dlq.counts(marked, "value")
            self.metrics.record(f"flush.{self.reason(n, size)}", n)
            self.metrics.record("good-records", n - n_bad)
            bad = marked.where("error is not null")
            if n_bad:
                if not self.dead_letters:
                    first = bad.select("error").first()[0]
                    raise dlq.SchemaConflict(f"{first} {dlq.offsets_sample(bad)}")
                letters = self.catalog.table(f"{name}__dlq")
                letters.write(bad.select("topic", "partition", "offset", "value", "error"), auto_create=True, stream=f"{self.name}/text", batch=common["batch"])
                self.metrics.record("dead-letters", n_bad)
            good = marked.where("error is null").select("value", *[F.col(c).alias(f"__{c}") for c in places])
            typed = infer.parse(good, "value", schema, [f"__{c}" for c in places])
            self.finish(name, table, typed, [f"__{c}" for c in places], common, f"{self.name}/text")
        finally:
            marked.unpersist()

    def reason(self, n: int, size: int) -> str:
        """Why a table's part of a micro-batch was due: what the trigger hadn't to wait for, or its time."""
        return "record_count" if n >= self.config["flush.size"] else "file_size" if size >= self.config["file.size.bytes"] else "time"

    def typed(self, topic: str) -> Callable[[DataFrame, int], None]:
        """A foreachBatch target for a stream of typed rows of one topic (Parquet, ORC, Avro, schema-bearing decoders): no
        inference, the rows' own schema creates and evolves the table."""
        name = routing.table_of(topic, self.routes)

        def write(batch: DataFrame, batch_id: int) -> None:
            options = self.config.table(name)
            rows = self.transform(name, batch) if self.transform else batch
            self.catalog.table(name).write(rows, keys=list(options.id_columns), auto_create=options.auto_create, partition_by=list(options.partition_by), retries=self.config["max_retry_count"], stream=f"{self.name}/{topic}", batch=batch_id, small=self.config["data.inlining.row.limit"] or 0)

        return write

    def start(self, stream: DataFrame, checkpoint: str, once: bool = False):
        """Starts the query: everything there is and stop (``once``), or a batch per flush interval."""
        self.spark.streams.addListener(Progress(self.name, self.metrics))
        w = stream.writeStream.queryName(self.name).option("checkpointLocation", checkpoint).foreachBatch(self)
        return (w.trigger(availableNow=True) if once else w.trigger(**self.config.trigger())).start()
