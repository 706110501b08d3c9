"""Canonical rows of the tables from raw rows: ids, clamped times, fall-backs, names of key points, one row a frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.operators.intervals import other_speaker_overlap
from chronoloom.operators.pose import triples

#: Names of the body's key points in their order; of a hand's; landmarks of a face.
BODY_25 = "Nose Neck RShoulder RElbow RWrist LShoulder LElbow LWrist MidHip RHip RKnee RAnkle LHip LKnee LAnkle REye LEye REar LEar LBigToe LSmallToe LHeel RBigToe RSmallToe RHeel Background".split()
HAND = "Wrist TH1 TH2 TH3 TH4 Index1 Index2 Index3 Index4 Middle1 Middle2 Middle3 Middle4 Ring1 Ring2 Ring3 Ring4 Pinky1 Pinky2 Pinky3 Pinky4".split()
FACE_LANDMARKS = 70
#: Frames a second of the working grid, and the score from which a face speaks.
GRID_RATE, SPEAKING = 25.0, 0.0


def clamped_duration(start: Column, end: Column) -> Column:
    return F.round(F.greatest(end - start, F.lit(0.0)), 6) + F.when(start.isNull() | end.isNull(), F.lit(None)).otherwise(0.0)


def segment_id(raw: Column, index: Column) -> Column:
    """seg and six digits from a whole number, counted from one; a text as it is; else from the segment's place. raw is a VARIANT."""
    text = raw.try_cast("string")
    whole = F.schema_of_variant(raw).rlike("^BIGINT") & ~text.isin("true", "false")
    return F.when(whole, F.format_string("seg%06d", text.try_cast("bigint") + 1)).when(F.schema_of_variant(raw).rlike("^STRING") & (F.length(text) > 0), text).otherwise(F.format_string("seg%06d", index + 1))


def segments(rows: DataFrame) -> DataFrame:
    """rows (segment_index, raw_id VARIANT, start, end, text, speaker, confidence, avg_logprob) with segment_id, duration, and the
    confidence that either column gives."""
    return rows.withColumns(
        {"segment_id": segment_id(F.col("raw_id"), F.col("segment_index")), "duration": clamped_duration(F.col("start"), F.col("end")), "text": F.trim(F.coalesce("text", F.lit(""))), "confidence": F.coalesce("confidence", "avg_logprob")}
    ).drop("raw_id", "avg_logprob")


def words(rows: DataFrame) -> DataFrame:
    """rows (segment_id, word_index, word, start, end, speaker, segment_speaker, confidence, score) as words with ids and what is
    known of their alignment."""
    timed = F.col("start").isNotNull() & F.col("end").isNotNull()
    return rows.select(
        *[c for c in rows.columns if c not in ("word", "speaker", "segment_speaker", "confidence", "score")], F.format_string("%s-w%05d", "segment_id", "word_index").alias("word_id"), F.trim("word").alias("word"),
        F.coalesce(F.nullif("speaker", F.lit("")), "segment_speaker").alias("speaker_id"), F.coalesce("confidence", "score").alias("confidence"), clamped_duration(F.col("start"), F.col("end")).alias("duration"),
        F.when(timed, "aligned").otherwise("missing_timestamp").alias("alignment_status"),
    )


def overlapping_turns(rows: DataFrame, keys: list[str], width: float = 5000.0) -> DataFrame:
    """Turns of a diarizer whose speakers may overlap: without empty or nameless spans, numbered by time, with the seconds
    that others speak in them."""
    kept = rows.where((F.col("end") > F.col("start")) & (F.length(F.col("speaker").cast("string")) > 0))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("start", "end", "speaker"))
    numbered = kept.withColumn("turn_id", F.format_string("turn%06d", place))
    seconds = other_speaker_overlap(numbered, keys, "turn_id", width).select(*keys, "turn_id", "overlap_s")
    return numbered.join(seconds, [*keys, "turn_id"]).select(*keys, "turn_id", "speaker", "start", "end", clamped_duration(F.col("start"), F.col("end")).alias("duration"), F.lit("overlapping").alias("diarization_type"), "overlap_s")


def cap_speakers(rows: DataFrame, keys: list[str], most: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the first `most` channels, and (keys, speaker, dropped) of the others."""
    beyond = F.col("speaker") >= most
    return rows.where(~beyond | F.col("speaker").isNull()), rows.where(beyond).groupBy(*keys, "speaker").agg(F.count("*").alias("dropped"))


def _points(people: DataFrame, keys: list[str], flat: str) -> DataFrame:
    return people.select(*keys, "detection_index", F.posexplode(triples(F.col(flat))).alias("keypoint_id", "p")).select(*keys, "detection_index", "keypoint_id", "p.x", "p.y", F.col("p.score").alias("confidence")).where("confidence > 0")


def _named(points: DataFrame, names: list[str]) -> DataFrame:
    listed = F.array(*[F.lit(n) for n in names])
    return points.withColumn("keypoint_name", F.coalesce(F.get(listed, F.col("keypoint_id")), F.concat(F.lit("K"), F.col("keypoint_id").cast("string"))))


def body_rows(people: DataFrame, keys: list[str], flat: str = "pose") -> DataFrame:
    """Key points of bodies that have a name, without the background."""
    return _named(_points(people, keys, flat).where(F.col("keypoint_id") < BODY_25.index("Background")), BODY_25)


def hand_rows(people: DataFrame, keys: list[str], left: str = "hand_left", right: str = "hand_right") -> DataFrame:
    sides = [_points(people, keys, flat).withColumn("hand", F.lit(side)) for side, flat in (("left", left), ("right", right))]
    return _named(sides[0].unionByName(sides[1]), HAND)


def face_rows(people: DataFrame, keys: list[str], flat: str = "face") -> DataFrame:
    return _points(people, keys, flat).where(F.col("keypoint_id") < FACE_LANDMARKS).withColumnRenamed("keypoint_id", "landmark_id")


def face_frames(rows: DataFrame) -> DataFrame:
    """rows (track_id, face_status, score_reason, talknet_score, score_imputed, is_active_speaker, box) with what is missing said:
    a status and a reason for each, a box only if it is whole, flags that are not null."""
    none, scored = F.col("track_id").isNull(), F.col("talknet_score").isNotNull()
    imputed = F.coalesce("score_imputed", F.lit(False))
    status = F.when(none, "no_face").when(F.col("face_status").isin("no_face", "tracked", "tracked_unscored"), F.col("face_status")).when(scored, "tracked").otherwise("tracked_unscored")
    reason = F.when(none, "no_face").when(F.col("score_reason").isNotNull(), F.col("score_reason")).when(~scored, "unknown").when(imputed, "imputed_tail").otherwise("scored")
    box = ["x1", "y1", "x2", "y2"]
    whole = ~none & F.col("x1").isNotNull() & F.col("y1").isNotNull() & F.col("x2").isNotNull() & F.col("y2").isNotNull()
    return rows.withColumns({"face_status": status, "frame_reason": reason, "score_imputed": imputed, "is_active_speaker": F.coalesce("is_active_speaker", F.lit(False)), **{c: F.when(whole, F.col(c)) for c in box}}).drop("score_reason")


def person_frames(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows (frame_number, box, track_confidence, confidence_reason) with the box's own area, a reason, and the people of the frame."""
    reason = F.coalesce("confidence_reason", F.when(F.col("track_confidence").isNotNull(), "tracked").otherwise("no_track_confidence"))
    together = F.count("*").over(Window.partitionBy(*keys, "frame_number"))
    return rows.withColumns({"confidence_reason": reason, "bbox_area": (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")), "persons_in_frame": together})


def of_variant(rows: DataFrame, variant: str, version: str) -> DataFrame:
    return rows.withColumns({"variant": F.lit(variant), "schema_version": F.lit(version)})


def translation_rows(segments: DataFrame, answers: DataFrame, keys: list[str], model: str, prompt: str) -> DataFrame:
    """Every segment with its answer, or none."""
    said = answers.select(*keys, F.col("id").alias("segment_id"), F.col("text").alias("english_text"))
    return segments.join(said, [*keys, "segment_id"], "left").withColumns({"translation_model": F.lit(model), "translation_prompt_version": F.lit(prompt)})


def story_rows(stories: DataFrame) -> DataFrame:
    """stories (window, story_id, parent_id, text, evidence) with ids of their window, trimmed text, and evidence as JSON."""
    own = lambda c: F.when(F.col(c).isNotNull(), F.concat(F.lit("w"), F.col("window").cast("string"), F.lit("-"), F.trim(c)))
    return stories.withColumns({"story_id": own("story_id"), "parent_id": own("parent_id"), "text": F.trim("text"), "evidence_segment_ids": F.to_json("evidence"), "window_index": F.col("window").cast("int")}).drop("evidence", "window")


def uniform_grid(counts: DataFrame, keys: list[str], count: str, rate: float = GRID_RATE) -> DataFrame:
    """(keys, frame, timestamp): the instants of an even grid of each key's count."""
    rows = counts.where(F.col(count) > 0).select(*keys, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count).cast("bigint") - 1)).alias("frame"))
    return rows.withColumn("timestamp", F.round(F.col("frame") / rate, 6))


def evenly_spaced(rows: DataFrame, keys: list[str], order: str, k: int) -> DataFrame:
    """k rows of each key at even distances, first and last among them; all if there are fewer."""
    w = Window.partitionBy(*keys)
    placed = rows.withColumns({"_i": F.row_number().over(w.orderBy(order)) - 1, "_n": F.count("*").over(w)})
    # One row is the first.
    wanted = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * (F.col("_n") - 1) / max(1, k - 1)).cast("int"))
    return placed.where((F.col("_n") <= k) | F.array_contains(wanted, F.col("_i"))).drop("_i", "_n")


def scenes_of_frames(spans: DataFrame, keys: list[str], place: str) -> DataFrame:
    """(keys, frame, scene) from spans (scene, first_frame, end_frame); a frame of several belongs to the one listed last."""
    frames = spans.where("end_frame > first_frame and end_frame > 0").select(*keys, "scene", place, F.explode(F.sequence(F.greatest("first_frame", F.lit(0)), F.col("end_frame") - 1)).alias("frame"))
    return frames.groupBy(*keys, "frame").agg(F.max_by("scene", place).alias("scene"))


def frame_document(grid: DataFrame, chosen: DataFrame, visible: DataFrame, keys: list[str], threshold: float = SPEAKING) -> DataFrame:
    """One row for each frame of the grid (keys, frame): the face chosen, else the one of the lowest track that was seen and not
    scored, else none. visible: (keys, frame, track_id, box as x1 to y2, raw, smoothed, imputed, reason)."""
    seen = visible.select(*keys, "frame", "track_id", F.struct("x1", "y1", "x2", "y2", "raw", "smoothed", "imputed", "reason").alias("_f"))
    lowest = seen.groupBy(*keys, "frame").agg(F.min("track_id").alias("_lowest"))
    rows = grid.join(chosen.where("track_id is not null").select(*keys, "frame", F.col("track_id").alias("_chosen")), [*keys, "frame"], "left").join(lowest, [*keys, "frame"], "left")
    rows = rows.withColumn("track_id", F.coalesce("_chosen", "_lowest")).join(seen, [*keys, "frame", "track_id"], "left")
    tracked, scored = F.col("_chosen").isNotNull(), F.col("_f.smoothed").isNotNull()
    status = F.when(tracked, "tracked").when(F.col("_lowest").isNotNull(), "tracked_unscored").otherwise("no_face")
    return rows.select(
        *keys, "frame", F.round(F.col("frame") / GRID_RATE, 6).alias("timestamp"), "track_id", status.alias("face_status"), F.when(F.col("track_id").isNull(), "no_face").otherwise(F.coalesce("_f.reason", F.lit("unknown"))).alias("frame_reason"),
        *[F.round(f"_f.{c}", 3).alias(c) for c in ("x1", "y1", "x2", "y2")], F.when(scored, F.round("_f.raw", 4)).alias("talknet_score_raw"), F.round("_f.smoothed", 4).alias("talknet_score"),
        F.coalesce(scored & F.col("_f.imputed"), F.lit(False)).alias("score_imputed"), F.coalesce(tracked & (F.col("_f.smoothed") >= threshold), F.lit(False)).alias("is_active_speaker"),
    )


def manifest_rows(recordings: DataFrame, catalog: list[str], files: DataFrame, keys: list[str]) -> DataFrame:
    """recordings with the artifacts of a closed catalog that they have, and those that were not generated."""
    have = files.groupBy(*keys).agg(F.collect_set("artifact").alias("_have"))
    names = F.array(*[F.lit(x) for x in sorted(catalog)])
    own = F.coalesce("_have", F.array().cast("array<string>"))
    rows = recordings.join(have, keys, "left")
    return rows.withColumns({"artifacts": F.filter(names, lambda x: F.array_contains(own, x)), "not_generated": F.filter(names, lambda x: ~F.array_contains(own, x))}).drop("_have")


def first_language(rows: DataFrame, keys: list[str], order: str, language: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.min_by(language, F.when(F.col(language).isNotNull(), F.col(order))).alias(language))
