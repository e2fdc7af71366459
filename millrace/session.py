"""Session helpers: reading tables, spreading small inputs, cutting lineage in the shared folder."""

from __future__ import annotations

import io
import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: Registries (topics, fields, settings, mixes) are held by the driver only up to this many rows.
MAX_REGISTRY_ROWS = 200_000


_SHIPPED: set[str] = set()
_SHIPPING = threading.Lock()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, so that executors need no installation of it. The
    archive is made on the driver and served by Spark's own file server, which takes one file of a name only: threads wait
    for the first."""
    sc = spark.sparkContext
    with _SHIPPING:
        if sc.applicationId in _SHIPPED:
            return
        root = os.path.dirname(os.path.abspath(__file__))
        content = io.BytesIO()
        with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as z:
            for base, _, names in sorted(os.walk(root)):
                for n in sorted(names):
                    if n.endswith(".py"):
                        z.write(os.path.join(base, n), os.path.relpath(os.path.join(base, n), os.path.dirname(root)))
        path = os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace.zip")
        with open(path, "wb") as f:
            f.write(content.getvalue())
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registry_rows(df: DataFrame, limit: int = MAX_REGISTRY_ROWS) -> list:
    """Rows of a registry table, refused beyond ``limit`` instead of filling the driver."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"registry has more than {limit} rows; raise the limit or partition the job by topic")
    return rows


def spread(df: DataFrame) -> DataFrame:
    """Repartition a scan of fewer partitions than half the cluster's cores (small inputs only); larger ones stay as read, and
    so do results of shuffles, which have their partitions only as they run: their plans have an adaptive root."""
    ship(df.sparkSession)
    if df._jdf.queryExecution().executedPlan().getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor shares: ``spark.checkpoint.dir``. Where it is unset (tests, local runs) one is made."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if conf:
        if not sc._jsc.sc().getCheckpointDir().isDefined():
            sc.setCheckpointDir(conf)
        return conf
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder's name in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder as Parquet and reads that: cuts the lineage, survives the loss of executors, and gives
    the planner true sizes and the readers pruning."""
    path = scratch(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
