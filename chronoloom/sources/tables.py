"""Timeline views over the given tables, in Spark and as the matching SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events on a seconds timeline: video, time, speaker or track, kind, value. Eight users make a video, so videos grow in number with the input."""
    rows = table(spark, sf_dir, "events")
    seconds = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))") / 1e6
    return rows.select("event_id", F.expr("user_id div 8").alias("video_id"), seconds.alias("t"), "user_id", "event_type", "value")


def spans(rows: DataFrame, kind: str) -> DataFrame:
    """Events of a kind as intervals of value * 100 seconds."""
    picked = rows.where(F.col("event_type") == kind)
    return picked.select("video_id", F.col("event_id").alias("turn_id"), F.col("user_id").alias("speaker"), F.col("t").alias("start"), (F.col("t") + F.col("value") * 100).alias("end"))


EVENTS_SQL = "ev AS (SELECT event_id, user_id // 8 AS video_id, epoch_us(ts) / 1000000.0::DOUBLE AS t, user_id, event_type, value FROM events)"


def spans_sql(name: str, kind: str) -> str:
    return f"{name} AS (SELECT video_id, event_id AS turn_id, user_id AS speaker, t AS start, t + value * 100 AS \"end\" FROM ev WHERE event_type = '{kind}')"
