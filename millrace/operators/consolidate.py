"""Runs of batches with equal schemas, and batches by size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows of one stretch of the order, about; what one task numbers.
STRETCH = 1_000_000


def _stretches(df: DataFrame, order: str, rows: int) -> DataFrame:
    """Adds __s, the stretch of the order a row lies in: equal widths between the least and the largest value, so many that
    each holds about ``rows`` rows. The numbers follow from two constants, so they are the same in every pass."""
    span = df.agg(F.min(order).alias("lo"), F.max(order).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    if not span.n or span.lo is None:
        return df.withColumn("__s", F.lit(0).cast("long"))
    width = max(1, -(-(span.hi - span.lo + 1) // max(1, -(-span.n // rows))))
    return df.withColumn("__s", F.coalesce(F.floor((F.col(order) - F.lit(span.lo)) / F.lit(width)), F.lit(-1)).cast("long"))


def _join(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Equi-join in which null keys are equal."""
    named = other.select(*[F.col(k).alias(f"__j_{k}") for k in keys], *[c for c in other.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"__j_{k}")) for k in keys]
    return rows.join(named, on).drop(*[f"__j_{k}" for k in keys])


def runs(df: DataFrame, order: str, signature: str, partition: list[str] | None = None, stretch: int = STRETCH) -> DataFrame:
    """Adds run_id: numbers the stretches of equal ``signature`` along ``order`` (whole numbers, ties in any order) within a
    partition, from 1 (gaps and islands). Nulls are equal to each other.

    Runs are counted by stretches of the order: each stretch by its own window, then joined with what the earlier stretches
    of its partition end with and add up to, so that neither one long sequence nor a hot partition is numbered by one task."""
    keys = partition or []
    rows = _stretches(df, order, stretch)
    own = Window.partitionBy(*keys, "__s").orderBy(order)
    previous = F.lag(signature).over(own)
    rows = rows.withColumn("__first", F.row_number().over(own) == 1).withColumn("__start", F.when(F.col("__first") | previous.eqNullSafe(F.col(signature)), 0).otherwise(1))
    rows = rows.withColumn("__upto", F.sum("__start").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    ends = rows.groupBy(*keys, "__s").agg(F.sum("__start").alias("__starts"), F.min_by(signature, order).alias("__head"), F.max_by(signature, order).alias("__tail"))
    along = Window.partitionBy(*keys).orderBy("__s")
    joined = F.when(F.row_number().over(along) == 1, 1).when(F.lag("__tail").over(along).eqNullSafe(F.col("__head")), 0).otherwise(1)
    ends = ends.withColumn("__open", joined)
    before = F.sum(F.col("__open") + F.col("__starts")).over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__starts")
    ends = ends.select(*keys, "__s", before.alias("__before"))
    return _join(rows, ends, [*keys, "__s"]).withColumn("run_id", F.col("__before") + F.col("__upto")).drop("__s", "__first", "__start", "__upto", "__before")


def consolidated(df: DataFrame, order: str, signature: str, partition: list[str] | None = None) -> DataFrame:
    """One row per run: partition columns, run_id, the signature, n_rows, first_id."""
    keys = [*(partition or []), "run_id"]
    return runs(df, order, signature, partition).groupBy(*keys).agg(F.first(signature).alias("sig"), F.count(F.lit(1)).alias("n_rows"), F.min(order).alias("first_id"))


def flush_batches(df: DataFrame, partition: Column, order: str, size: int, stretch: int = STRETCH) -> DataFrame:
    """Adds p (the partition) and b: the number of the flush a row falls into, ``size`` rows each in order, from 0.

    Row numbers are counted as in :func:`runs`: within a stretch of the order, plus the rows of earlier stretches."""
    rows = _stretches(df.withColumn("p", partition), order, stretch)
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("p").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = rows.groupBy("p", "__s").agg(F.count(F.lit(1)).alias("__n")).withColumn("__before", before).drop("__n")
    within = F.row_number().over(Window.partitionBy("p", "__s").orderBy(order)) - 1
    return _join(rows.withColumn("__within", within), offsets, ["p", "__s"]).withColumn("b", F.floor((F.col("__before") + F.col("__within")) / size)).drop("__s", "__within", "__before")


def buffers(df: DataFrame, topic: str, partition: Column, value: str) -> DataFrame:
    """What each topic and partition has gathered: topic, p, n (records), n_bytes of their values; nulls are a partition and a topic of
    their own, null values have no bytes. Combined before the shuffle, so that a hot partition is a row per task."""
    return df.groupBy(F.col(topic).alias("topic"), partition.alias("p")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(value)), F.lit(0)).cast("bigint").alias("n_bytes"))


def flush_reason(n: Column, size: Column, age: Column, limit_n: int, limit_size: int, limit_age: int, pressure: Column | None = None) -> Column:
    """Why a buffer is flushed: record count, then size, then time; memory pressure only where nothing else is due."""
    out = F.when(n >= limit_n, "record_count").when(size >= limit_size, "file_size").when(age >= limit_age, "time")
    return out.when(pressure, "memory_pressure") if pressure is not None else out
