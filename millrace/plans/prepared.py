"""Queries over the data-preparation operators of the core (problems 1 to 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import compaction, dedupe, drift, rejects, timenorm
from millrace.plans import prepared_sql as sql
from millrace.session import cut, read_table, scratch


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return drift.found(read_table(spark, sf, "sink_records"), read_table(spark, sf, "topic_fields"))


def p1_casts(spark: SparkSession, sf: str) -> DataFrame:
    return drift.cast_report(read_table(spark, sf, "sink_records"), read_table(spark, sf, "topic_fields"))


def p1_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The consistent tables: every record's typed row."""
    return drift.table_rows(read_table(spark, sf, "sink_records"), read_table(spark, sf, "topic_fields"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return rejects.found(read_table(spark, sf, "raw_records"), read_table(spark, sf, "sink_topics"), read_table(spark, sf, "topic_fields"))


def p2_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The readable rows; fields as one JSON text of checked values."""
    rows = rejects.split(read_table(spark, sf, "raw_records"), read_table(spark, sf, "sink_topics"), read_table(spark, sf, "topic_fields"))
    return rows.where("reason is null").select("line_id", "topic", F.to_json("fields", {"ignoreNullFields": "false"}).alias("row"))


def p2_typed(spark: SparkSession, sf: str) -> DataFrame:
    """Values, least and greatest of every field of the typed tables of all topics."""
    topics, fields = read_table(spark, sf, "sink_topics"), read_table(spark, sf, "topic_fields")
    return rejects.profile(cut(rejects.split(read_table(spark, sf, "raw_records"), topics, fields)), rejects.registry(topics, fields))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return compaction.found(read_table(spark, sf, "data_files"), read_table(spark, sf, "sink_settings"))


def p3_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Merges the small files into the shared folder; one row per merged file."""
    target = scratch(spark, "merged")
    done = compaction.compact(read_table(spark, sf, "data_files"), read_table(spark, sf, "sink_settings"), target)
    return done.select("topic", "kafka_partition", "shard", "group_no", "n_files", "n_records", "n_bytes")


def p3_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Files, records and bytes in the merged files of each topic and partition."""
    done = p3_groups(spark, sf).groupBy("topic", "kafka_partition")
    return done.agg(F.sum("n_files").alias("n_files"), F.sum("n_records").alias("n_records"), F.sum("n_bytes").alias("n_bytes"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return timenorm.found(read_table(spark, sf, "intake_rows"), read_table(spark, sf, "sink_topics"))


def p4_status(spark: SparkSession, sf: str) -> DataFrame:
    """Texts per topic, field and status."""
    rows = timenorm.normalise(read_table(spark, sf, "intake_rows"), read_table(spark, sf, "sink_topics"))
    return rows.groupBy("topic", "field_name", "status").agg(F.count(F.lit(1)).alias("n"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.copies(read_table(spark, sf, "sink_records"), read_table(spark, sf, "sink_topics"))


def p5_kept(spark: SparkSession, sf: str) -> DataFrame:
    kept = dedupe.keep_first(read_table(spark, sf, "sink_records"), read_table(spark, sf, "sink_topics"))
    return kept.select("delivery_id", "topic", "kafka_partition", "kafka_offset")


QUERIES = {f.__name__: f for f in (p1_found, p1_casts, p1_rows, p2_found, p2_rows, p2_typed, p3_found, p3_groups, p3_merged, p4_found, p4_status, p5_found, p5_kept)}

ORACLES = {
    "p2_found": sql.REJECTS,
    "p2_typed": sql.TYPED,
    "p4_found": sql.TIMES,
    "p4_status": f"""
WITH t AS (
  SELECT row_id, topic, 'created_at' AS field_name, created_at AS raw FROM intake_rows WHERE created_at IS NOT NULL
  UNION ALL SELECT row_id, topic, 'record_timestamp', record_timestamp FROM intake_rows WHERE record_timestamp IS NOT NULL),
f AS ({sql.TIMES})
SELECT topic, field_name, CASE WHEN utc_us IS NOT NULL THEN 'normalised'
    WHEN regexp_full_match(raw, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\\.[0-9]{{6}}Z') AND try_cast(raw[1:10] AS DATE) IS NOT NULL THEN 'canonical'
    ELSE 'unreadable' END AS status, count(*) AS n
FROM t LEFT JOIN f USING (row_id, field_name) GROUP BY ALL""",
    "p5_found": sql.COPIES + " SELECT * FROM copies",
    "p5_kept": sql.COPIES + " SELECT delivery_id, topic, kafka_partition, kafka_offset FROM sink_records WHERE delivery_id NOT IN (SELECT copy_id FROM copies)",
    "p3_found": sql.SMALL,
    "p3_merged": sql.MERGED,
}
