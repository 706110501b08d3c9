"""Counts and rates of tables and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def tally(rows: DataFrame, keys: list[str], states: list[str]) -> DataFrame:
    """(keys, column, state, rows) of columns with a closed vocabulary, in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("state")) for c in states])
    return rows.select(*keys, F.explode(pairs).alias("p")).groupBy(*keys, "p.column", "p.state").agg(F.count("*").alias("rows"))


def alignment_coverage(words: DataFrame, keys: list[str]) -> DataFrame:
    aligned = F.count_if(F.col("alignment_status") == "aligned")
    return words.groupBy(*keys).agg(F.count("*").alias("words"), aligned.alias("aligned"), F.round(aligned / F.count("*"), 4).alias("coverage"))


def assignment_statistics(rows: DataFrame, keys: list[str]) -> DataFrame:
    given = F.count("speaker")
    return rows.groupBy(*keys).agg(F.count("*").alias("rows"), (F.count("*") - given).alias("unassigned"), F.count_distinct("speaker").alias("speakers"), F.round(F.try_divide(given, F.count("*")), 4).alias("assignment_rate"))


def frame_statistics(frames: DataFrame, keys: list[str]) -> DataFrame:
    return frames.groupBy(*keys).agg(
        F.count("*").alias("frames"), F.count("track_id").alias("with_face"), F.count_if(F.coalesce("is_active_speaker", F.lit(False))).alias("active"),
        F.count_distinct("track_id").alias("tracks"), F.count_distinct("scene_id").alias("scenes"),
    )


def person_statistics(sightings: DataFrame, keys: list[str]) -> DataFrame:
    """Counts over frames first, so that no task holds a recording's sightings."""
    by_frame = sightings.groupBy(*keys, "frame_number").agg(F.count("*").alias("_n"), F.count_if(F.col("timestamp").isNull()).alias("_untimed"))
    people = sightings.groupBy(*keys).agg(F.count_distinct("person_id").alias("persons"))
    frames = by_frame.groupBy(*keys).agg(F.sum("_n").alias("rows"), F.count("*").alias("frames_with_person"), F.max("_n").alias("max_persons_in_frame"), F.sum("_untimed").alias("rows_without_timestamp"))
    return frames.join(people, keys)


def overlap_statistics(turns: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, engine, turns, speakers, overlapping): the diarizers side by side."""
    return turns.groupBy(*keys, "engine").agg(F.count("*").alias("turns"), F.count_distinct("speaker").alias("speakers"), F.count_if(F.col("overlap_s") > 0).alias("overlapping"))


def by_engine(tables: dict[str, DataFrame]) -> DataFrame:
    """Turns of several diarizers in one table, told apart by engine: their speakers are different names even where they look alike."""
    found = [rows.withColumn("engine", F.lit(name)) for name, rows in tables.items()]
    out = found[0]
    for rows in found[1:]:
        out = out.unionByName(rows)
    return out


def batch_summary(videos: DataFrame) -> DataFrame:
    """One row: videos, those completed, partial, failed, and their seconds."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    return videos.agg(F.count("*").alias("videos"), count("completed"), count("partial"), count("failed"), F.round(F.coalesce(F.sum("seconds"), F.lit(0.0)), 3).alias("seconds"))


def batch_report(videos: DataFrame) -> DataFrame:
    """(json) lines of a report: the summary, then one line a video; written as text, it never passes through one row."""
    head = batch_summary(videos).select(F.to_json(F.struct(F.lit("summary").alias("kind"), "*")).alias("json"))
    return head.unionByName(videos.select(F.to_json(F.struct(F.lit("video").alias("kind"), "*")).alias("json")))


def usage(requests: DataFrame, keys: list[str], counts: str = "usage", last: int = 200) -> tuple[DataFrame, DataFrame]:
    """(keys, kind, total) of the token counts of requests, and their last timings."""
    totals = requests.select(*keys, F.explode(F.map_entries(counts)).alias("e")).groupBy(*keys, F.col("e.key").alias("kind")).agg(F.sum("e.value").alias("total"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("at")))
    return totals, requests.withColumn("_n", place).where(F.col("_n") <= last).select(*keys, "at", "seconds")


def story_outcomes(judged: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, windows, empty_windows, dropped, accepted) of validated stories."""
    by_window = judged.groupBy(*keys, "window").agg(F.count_if(F.col("status") == "accepted").alias("_a"), F.count_if(F.col("status") == "dropped").alias("_d"))
    return by_window.groupBy(*keys).agg(F.count("*").alias("windows"), F.count_if(F.col("_a") == 0).alias("empty_windows"), F.sum("_d").alias("dropped"), F.sum("_a").alias("accepted"))


def evidence(problems: DataFrame, keys: list[str], value: str, k: int) -> DataFrame:
    """(keys, problems, shown): how many there are, and the first k in order, each kept by rank rather than from a whole list."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(value))
    ranked = problems.withColumn("_n", place)
    return ranked.groupBy(*keys).agg(F.count("*").alias("problems"), F.sort_array(F.collect_list(F.when(F.col("_n") <= k, F.col(value)))).alias("shown"))
