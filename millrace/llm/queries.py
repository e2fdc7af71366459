"""Queries over the text operators (problems 6 to 8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import encoding, garbled, mixing
from millrace.session import cut, read_table


def p6_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.encode(read_table(spark, sf, "documents"), encoding.vocabulary(spark))


def _mix(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    counts = cut(encoding.token_counts(read_table(spark, sf, "documents"), encoding.vocabulary(spark), ["doc_id", "source"]))
    return mixing.choose(counts, read_table(spark, sf, "mix_targets"))


def p7_chosen(spark: SparkSession, sf: str) -> DataFrame:
    return _mix(spark, sf)[0]


def p7_shares(spark: SparkSession, sf: str) -> DataFrame:
    return _mix(spark, sf)[1]


def p7_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of every mix and source: no document comes more often than allowed, and the target is met unless the source
    gives all it may."""
    chosen, shares = _mix(spark, sf)
    targets = read_table(spark, sf, "mix_targets").where("mix_name is not null and source is not null").select("mix_name", "source", "max_repeats")
    most = chosen.groupBy("mix_name", "source").agg(F.max("repeats").alias("most"), (F.count(F.lit(1)) == F.count_distinct("doc_id")).alias("once"))
    both = shares.join(targets, ["mix_name", "source"]).join(most, ["mix_name", "source"], "left")
    allowed = F.coalesce(F.col("most") <= F.col("max_repeats"), F.lit(True)) & F.coalesce("once", F.lit(True))
    met = F.col("reached") | (F.col("actual_tokens") >= F.col("available_tokens") * F.col("max_repeats"))
    return both.select("mix_name", "source", "target_share", allowed.alias("allowed"), met.alias("met"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return garbled.found(read_table(spark, sf, "documents"))


def p8_restored(spark: SparkSession, sf: str) -> DataFrame:
    return garbled.repair(read_table(spark, sf, "documents"))


QUERIES = {f.__name__: f for f in (p6_ids, p7_chosen, p7_shares, p7_bounds, p8_found, p8_restored)}
ORACLES: dict[str, str] = {"p7_bounds": "SELECT mix_name, source, target_share, true AS allowed, true AS met FROM mix_targets WHERE mix_name IS NOT NULL AND source IS NOT NULL"}
