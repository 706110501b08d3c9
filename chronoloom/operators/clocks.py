"""Frame numbers to seconds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rate and step where the index says nothing.
DEFAULT_RATE, DEFAULT_STEP = 25.0, 0.04


def frame_times(frames: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    """frames with timestamp from index (keys, frame_number, pts): beyond its last frame by the mean step, in gaps and without index at 25 a second.

    The index is one small row a key for the extrapolation; repeated index frames count once, at their latest time.
    """
    known = index.groupBy(*keys, "frame_number").agg(F.max("pts").alias("_pts"))
    ends = known.groupBy(*keys).agg(F.max("frame_number").alias("_last"), F.max_by("_pts", "frame_number").alias("_end"), F.min_by("_pts", "frame_number").alias("_begin"), F.count("*").alias("_n"))
    rows = frames.join(known, [*keys, "frame_number"], "left").join(ends, keys, "left")
    step = F.nullif((F.col("_end") - F.col("_begin")) / F.greatest(F.col("_n") - 1, F.lit(1)), F.lit(0.0))
    beyond = F.col("_end") + F.coalesce(step, F.lit(DEFAULT_STEP)) * (F.col("frame_number") - F.col("_last"))
    guess = F.when(F.col("frame_number") > F.col("_last"), beyond).otherwise(F.col("frame_number") / DEFAULT_RATE)
    return rows.withColumn("timestamp", F.round(F.coalesce("_pts", guess), 6)).drop("_pts", "_last", "_end", "_begin", "_n")
