"""Nested model documents as typed rows: one JSON file a recording or a frame, read with a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FILE = "_metadata.file_name AS file"
#: Tags of a container that are kept.
KEPT_TAGS = "creation_time encoder major_brand minor_version compatible_brands title comment date time".split()
#: Positions that a score array may lack at its end and still lend its last score.
TAIL = 2


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema + ", _bad string").option("multiLine", True).option("columnNameOfCorruptRecord", "_bad").json(path).selectExpr("*", FILE)


def _number(name: str) -> Column:
    return F.col(name).try_cast("double")


def asr_segments(spark: SparkSession, path: str) -> DataFrame:
    """(file, segment_index, start, end, language, speaker, text, words) of recogniser documents; a number that does not parse is null."""
    word = "struct<word: string, start: string, end: string, score: string, speaker: string>"
    docs = _json(spark, path, f"language string, segments array<struct<start: string, end: string, text: string, speaker: string, words: array<{word}>>>")
    rows = docs.where("_bad is null").select("file", "language", F.posexplode("segments").alias("segment_index", "s"))
    return rows.select("file", "segment_index", _number("s.start").alias("start"), _number("s.end").alias("end"), "language", F.col("s.speaker").alias("speaker"), F.trim(F.coalesce("s.text", F.lit(""))).alias("text"), F.col("s.words").alias("words"))


def asr_words(segments: DataFrame) -> DataFrame:
    """(file, segment_index, word_index, word, start, end, score, alignment_status): a segment without words lends its span to its text's words."""
    pieces = F.filter(F.split("text", r"\s+"), lambda x: x != "")
    plain = F.transform(pieces, lambda x: F.struct(x.alias("word"), F.col("start").alias("start"), F.col("end").alias("end"), F.lit(None).cast("double").alias("score"), F.lit("segment_only").alias("status")))

    def timed(w: Column) -> Column:
        start, end = w["start"].try_cast("double"), w["end"].try_cast("double")
        status = F.when(start.isNotNull() & end.isNotNull(), "aligned").otherwise("missing_timestamp")
        return F.struct(w["word"].alias("word"), start.alias("start"), end.alias("end"), w["score"].try_cast("double").alias("score"), status.alias("status"))

    found = F.when(F.size("words") > 0, F.transform("words", timed)).otherwise(plain)
    rows = segments.select("file", "segment_index", F.posexplode(found).alias("word_index", "w"))
    return rows.select("file", "segment_index", "word_index", "w.word", "w.start", "w.end", "w.score", F.col("w.status").alias("alignment_status"))


def segment_turns(spark: SparkSession, path: str) -> DataFrame:
    """(file, turn_id, start, end, speaker) of diarizer documents with segments as objects: in order of time, without empty or nameless spans."""
    docs = _json(spark, path, "segments array<struct<start: string, end: string, speaker_id: string>>")
    rows = docs.select("file", F.posexplode("segments").alias("_at", "s")).select("file", "_at", _number("s.start").alias("start"), _number("s.end").alias("end"), F.col("s.speaker_id").alias("speaker"))
    rows = rows.where((F.col("end") > F.col("start")) & (F.length("speaker") > 0))
    place = F.row_number().over(Window.partitionBy("file").orderBy("start", "end", "speaker", "_at"))
    return rows.select("file", F.format_string("turn%06d", place).alias("turn_id"), "start", "end", "speaker")


def speaker_frames(spark: SparkSession, path: str, frame: str) -> DataFrame:
    """(file, frame_count, track_count, and the fields of frame) of active-speaker documents; frame is the DDL of one frame."""
    docs = _json(spark, path, f"frame_count bigint, track_count bigint, active_frame_count bigint, frames array<struct<{frame}>>")
    return docs.where("_bad is null").select("file", "frame_count", "track_count", F.explode("frames").alias("f")).select("file", "frame_count", "track_count", "f.*")


#: Keys without which a person document is no document.
PERSON_KEYS = ["frames", "frames_measured", "person_ids"]


def person_documents(spark: SparkSession, path: str, frame: str) -> tuple[DataFrame, DataFrame]:
    """Sightings (file, frames_measured, and the fields of frame), and (file, missing) of documents that lack a key."""
    docs = _json(spark, path, f"frames_measured bigint, person_ids array<bigint>, frames array<struct<{frame}>>")
    missing = F.filter(F.array(*[F.when(F.col(k).isNull(), k) for k in PERSON_KEYS]), lambda k: k.isNotNull())
    checked = docs.withColumn("missing", missing)
    rows = checked.where(F.size("missing") == 0).select("file", "frames_measured", F.explode("frames").alias("f")).select("file", "frames_measured", "f.*")
    return rows, checked.where(F.size("missing") > 0).select("file", "missing")


def pose_frames(spark: SparkSession, path: str, document: str) -> DataFrame:
    """(file, frame_number, and the fields of document) of one JSON file a frame; names without number, and files that are no objects, are left out."""
    docs = _json(spark, path, document)
    number = F.regexp_extract("file", r"(\d+)(?:_keypoints)?\.json$", 1).try_cast("bigint")
    return docs.where("_bad is null").withColumn("frame_number", number).where("frame_number is not null").drop("_bad")


def scene_spans(spark: SparkSession, path: str) -> DataFrame:
    """(file, scene, first_frame, end_frame) of scene lists: rows below the one that names Scene Number, frames from zero, end exclusive."""
    whole = spark.read.text(path, wholetext=True).selectExpr("trim(LEADING '﻿' FROM value) AS value", FILE)
    lines = F.filter(F.transform(F.split("value", r"\r?\n"), lambda x: F.transform(F.split(x, ","), lambda c: F.trim(F.replace(c, F.lit('"'), F.lit(""))))), lambda c: F.size(c) > 0)
    rows = whole.select("file", lines.alias("lines"))
    heads = F.filter(F.col("lines"), lambda c: F.array_contains(c, "Scene Number"))
    rows = rows.select("file", "lines", F.get(heads, F.lit(0)).alias("head")).where("head is not null")
    below = rows.select("file", "head", F.array_position("lines", F.col("head")).alias("_top"), F.posexplode("lines").alias("_at", "c")).where("_at >= _top")

    def cell(name: str) -> Column:
        return F.get("c", F.array_position("head", name).cast("int") - 1).try_cast("bigint")

    spans = below.select("file", cell("Scene Number").alias("scene"), (cell("Start Frame") - 1).alias("first_frame"), cell("End Frame").alias("end_frame"))
    return spans.where("scene is not null and first_frame is not null and end_frame is not null")


def frame_index(spark: SparkSession, path: str) -> DataFrame:
    """(file, frame_number, pts) of packet lists: times that parse, at least zero, numbered in order."""
    rows = _json(spark, path, "packets array<struct<pts_time: string>>").select("file", F.explode("packets.pts_time").alias("p"))
    times = rows.select("file", F.greatest(F.col("p").try_cast("double"), F.lit(0.0)).alias("pts"), F.col("p").try_cast("double").isNotNull().alias("_ok")).where("_ok")
    return times.select("file", (F.row_number().over(Window.partitionBy("file").orderBy("pts")) - 1).cast("bigint").alias("frame_number"), "pts")


def _ratio(text: Column) -> Column:
    parts = F.split(text, "/")
    over = F.coalesce(F.get(parts, F.lit(1)).try_cast("double"), F.lit(1.0))
    return F.get(parts, F.lit(0)).try_cast("double") / F.nullif(over, F.lit(0.0))


def media_metadata(spark: SparkSession, path: str) -> DataFrame:
    """One row a probe document: container, duration, codecs, sizes, rates and the frame count, measured or from duration and mean rate."""
    stream = "codec_type: string, codec_name: string, pix_fmt: string, width: int, height: int, r_frame_rate: string, avg_frame_rate: string, nb_frames: string, duration: string, time_base: string, sample_rate: string, channels: string"
    docs = _json(spark, path, f"format struct<format_name: string, format_long_name: string, duration: string, tags: map<string,string>>, streams array<struct<{stream}>>").where("_bad is null")

    def first(kind: str) -> Column:
        """Of several streams the one with a width and a height, then the last."""
        ranked = F.transform(F.filter("streams", lambda s: s["codec_type"] == kind), lambda s, i: F.struct(F.coalesce(s["width"] > 0, F.lit(False)).alias("w"), F.coalesce(s["height"] > 0, F.lit(False)).alias("h"), i.alias("i"), s.alias("s")))
        return F.array_max(ranked)["s"] if kind == "video" else F.get(F.transform(ranked, lambda x: x["s"]), F.lit(0))

    rows = docs.select("file", "format", first("video").alias("v"), first("audio").alias("a"), F.sort_array(F.array_distinct(F.filter("streams.codec_type", lambda x: x.isNotNull()))).alias("streams_present"))
    rate, mean = _ratio(F.col("v.r_frame_rate")), _ratio(F.col("v.avg_frame_rate"))
    duration = F.coalesce(_number("format.duration"), _number("v.duration"), _number("a.duration"))
    mean = F.coalesce(F.nullif(mean, F.lit(0.0)), rate)
    frames = F.coalesce(F.col("v.nb_frames").try_cast("bigint"), F.when((duration != 0) & (mean != 0), F.bround(duration * mean).cast("bigint")))
    return rows.select(
        "file", F.col("format.format_name").alias("container"), duration.alias("duration_seconds"), F.col("v.codec_name").alias("video_codec"), F.col("v.pix_fmt").alias("pixel_format"), "v.width", "v.height",
        rate.alias("frame_rate"), mean.alias("average_frame_rate"), frames.alias("frame_count"), F.col("v.time_base").alias("time_base"), F.col("a.codec_name").alias("audio_codec"),
        F.col("a.sample_rate").try_cast("bigint").alias("audio_sample_rate"), F.col("a.channels").try_cast("bigint").alias("audio_channels"), "streams_present",
        F.map_filter(F.coalesce("format.tags", F.create_map().cast("map<string,string>")), lambda k, v: F.lower(k).isin(*KEPT_TAGS)).alias("tags"),
    )


def track_candidates(tracks: DataFrame, keys: list[str], frame_count: str) -> DataFrame:
    """(keys, track_id, frame, bbox, score, imputed, reason) from rows (keys, track_id, frames, boxes, scores, and a frame count).

    Boxes of fewer than four finite numbers and frames outside the recording are left out. A score array that ends early
    lends its last score to TAIL positions; beyond, and where a score is not finite, the face stays with a null score.
    """
    rows = tracks.where(F.col("scores").isNotNull()).select(*keys, "track_id", "scores", frame_count, F.posexplode(F.arrays_zip("frames", "boxes")).alias("_at", "x"))
    n = F.size("scores")

    def finite(c: Column) -> Column:
        return F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))

    own, last = F.get("scores", F.col("_at")).cast("double"), F.get("scores", n - 1).cast("double")
    inside, tail = F.col("_at") < n, F.col("_at") < n + TAIL
    reason = (
        F.when(inside, F.when(finite(own), "scored").otherwise("score_not_finite"))
        .when(n == 0, "track_has_no_scores")
        .when(tail, F.when(finite(last), "imputed_tail").otherwise("tail_score_not_finite"))
        .otherwise("past_scored_tail")
    )
    box = F.slice(F.col("x.boxes").cast("array<double>"), 1, 4)
    found = rows.select(*keys, "track_id", "_at", F.col("x.frames").cast("bigint").alias("frame"), box.alias("bbox"), reason.alias("reason"), own.alias("_own"), last.alias("_last"), F.col(frame_count).alias("_n"))
    found = found.where((F.col("frame") >= 0) & (F.col("frame") < F.col("_n")) & (F.size("bbox") == 4) & F.forall("bbox", finite))
    score = F.when(F.col("reason") == "scored", F.col("_own")).when(F.col("reason") == "imputed_tail", F.col("_last"))
    kept = found.withColumn("_row", F.struct("bbox", score.alias("score"), (F.col("reason") == "imputed_tail").alias("imputed"), "reason"))
    # A track that names a frame twice keeps its later box.
    return kept.groupBy(*keys, "track_id", "frame").agg(F.max_by("_row", "_at").alias("_row")).select(*keys, "track_id", "frame", "_row.*")


def stage_states(spark: SparkSession, path: str) -> DataFrame:
    """(file, video_id, stage, status, started_at, completed_at, duration_seconds) of state documents, one row a stage."""
    stage = "struct<status: string, started_at: string, completed_at: string, duration_seconds: string>"
    docs = _json(spark, path, f"video_id string, stages map<string, {stage}>").where("_bad is null")
    rows = docs.select("file", "video_id", F.explode(F.map_entries("stages")).alias("e"))
    return rows.select(
        "file", "video_id", F.col("e.key").alias("stage"), F.col("e.value.status").alias("status"), F.col("e.value.started_at").try_cast("timestamp").alias("started_at"),
        F.col("e.value.completed_at").try_cast("timestamp").alias("completed_at"), _number("e.value.duration_seconds").alias("duration_seconds"),
    )
