"""Summaries of face and person tracks, sighting runs, and stable selection of the active face."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.operators.running import running
from chronoloom.operators.runs import smooth


def face_tracks(frames: DataFrame, keys: list[str]) -> DataFrame:
    """Span, counts, scores and scenes of each face track; with boxes (x1, y1, x2, y2) their mean area."""
    boxed = {"x1", "y1", "x2", "y2"} <= set(frames.columns)
    area = [F.round(F.avg((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))), 2).alias("mean_bbox_area")] if boxed else []
    return frames.where("track_id is not null").groupBy(*keys, "track_id").agg(
        F.min("t").alias("first_timestamp"), F.max("t").alias("last_timestamp"), F.count("*").alias("frame_count"), F.count_if("active").alias("active_frame_count"),
        F.round(F.count_if("active") / F.count("*"), 4).alias("active_ratio"), F.round(F.avg("score"), 6).alias("mean_score"), F.round(F.max("score"), 6).alias("max_score"),
        F.array_join(F.array_sort(F.collect_set("scene")), ",").alias("scenes"), *area,
    )


def person_tracks(sightings: DataFrame, keys: list[str], frames_measured: DataFrame) -> DataFrame:
    """Span, coverage of the frames measured, longest gap and order of appearance of each person; with boxes (x1, y1, x2, y2) their
    mean and largest area."""
    boxed = {"x1", "y1", "x2", "y2"} <= set(sightings.columns)
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")) if boxed else None
    areas = [F.round(F.avg(area), 2).alias("mean_bbox_area"), F.round(F.max(area), 2).alias("max_bbox_area")] if boxed else []
    w = Window.partitionBy(*keys, "person_id").orderBy("t")
    gaps = sightings.withColumn("gap", F.col("t") - F.lag("t").over(w))
    people = gaps.groupBy(*keys, "person_id").agg(
        F.min("t").alias("first_timestamp"), F.max("t").alias("last_timestamp"), F.count("*").alias("frame_count"), F.round(F.coalesce(F.max("gap"), F.lit(0.0)), 6).alias("longest_gap_seconds"),
        F.round(F.avg("confidence"), 6).alias("mean_confidence"), F.round(F.max("confidence"), 6).alias("max_confidence"), *areas,
    )
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("first_timestamp"), "person_id")
    people = people.join(frames_measured, keys).withColumn("appearance_order", F.row_number().over(order) - 1)
    return people.select(
        *keys, "person_id", "first_timestamp", "last_timestamp", F.round(F.col("last_timestamp") - F.col("first_timestamp"), 6).alias("duration_seconds"), "frame_count",
        F.round(F.col("frame_count") / F.col("frames_measured"), 6).alias("frame_coverage"), "longest_gap_seconds", "mean_confidence", "max_confidence", F.col("appearance_order").cast("bigint").alias("appearance_order"),
        *(["mean_bbox_area", "max_bbox_area"] if boxed else []),
    )


def sighting_runs(sightings: DataFrame, keys: list[str], index: DataFrame) -> DataFrame:
    """Runs of consecutive frames of a person; frames join only if both times agree with the frame index within 1e-6 s."""
    once = Window.partitionBy(*keys, "person_id", "frame_number").orderBy(F.col("t").isNull(), "t")
    rows = sightings.withColumn("_n", F.row_number().over(once)).where("_n = 1").drop("_n")
    checked = rows.join(index.select(*keys, "frame_number", F.col("pts").alias("_pts")), [*keys, "frame_number"], "left")
    checked = checked.withColumn("verified", F.coalesce(F.abs(F.col("t") - F.col("_pts")) <= 1e-6, F.lit(False)))
    w = Window.partitionBy(*keys, "person_id").orderBy("frame_number")
    before = F.coalesce(F.lag("verified").over(w), F.lit(True))
    joined = F.col("verified") & F.lag("verified").over(w) & (F.col("frame_number") == F.lag("frame_number").over(w) + 1)
    cut = checked.withColumns({"_joined": F.coalesce(joined, F.lit(False)), "_edge": ~(F.col("verified") & before) & F.lag("frame_number").over(w).isNotNull()})
    cut = cut.withColumn("_run", F.sum(F.when(F.col("_joined"), 0).otherwise(1)).over(w))
    runs = cut.groupBy(*keys, "person_id", "_run").agg(
        F.min("frame_number").alias("first_frame"), F.max("frame_number").alias("last_frame"), F.min("t").alias("start"), F.max("t").alias("end"),
        F.count("*").alias("sightings"), F.count_if("verified").alias("verified"), F.bool_or(~F.col("_joined") & F.col("_edge")).alias("_open"), F.count("_pts").alias("_known"),
    )
    # A run's edge counts as unverified if either side of the gap before or after it could not be placed in the index.
    beside = Window.partitionBy(*keys, "person_id").orderBy("_run")
    edge = F.col("_open") | F.coalesce(F.lead("_open").over(beside), F.lit(False))
    no_index = F.sum("_known").over(Window.partitionBy(*keys)) == 0
    marker = (
        F.when(no_index, "no index").when((F.col("verified") == 0) | (edge & (F.col("sightings") == 1)), "unverified")
        .when(edge, "verified; split").otherwise("verified")
    )
    return runs.withColumn("adjacency", marker).drop("_run", "_open", "_known")


#: What selection carries from frame to frame: the chosen face, its challenger, the challenger's frames in a row.
Held = tuple[int | None, int | None, int]


def choose(found: dict[int, float], held: Held, margin: float, frames_needed: int) -> Held:
    """What is held after a frame whose scored faces are found: the one chosen stays until another leads lastingly."""
    current, challenger, wins = held
    best = min(found, key=lambda k: (-found[k], k))
    if current not in found:
        return best, None, 0
    if best == current or found[best] < found[current] + margin:
        return current, None, 0
    wins = wins + 1 if best == challenger else 1
    return (best, None, 0) if wins >= frames_needed else (current, best, wins)


def selection_islands(by_frame: DataFrame, keys: list[str], stretch: int = 4096) -> DataFrame:
    """by_frame (keys, frame, scene, tracks) with island: the frame at which its run began. A run ends where the scene changes and
    where nothing is scored; frames are numbered once in a key, and a stretch of them is what one window runs over."""
    bucket, order = F.floor(F.col("frame") / stretch), ["frame", "scene"]
    # A struct, so that a null scene is a scene too.
    state = F.struct("scene", (F.size("tracks") > 0).alias("scored"))
    seen = running(by_frame, keys, order, bucket, strict=True, _before=("last", state))
    goes_on = F.col("_before.scored") & (F.size("tracks") > 0) & F.col("_before.scene").eqNullSafe(F.col("scene"))
    fresh = F.when(~F.coalesce(goes_on, F.lit(False)), F.col("frame"))
    return running(seen, keys, order, bucket, island=("max", fresh)).drop("_before")


def stable_selection(candidates: DataFrame, keys: list[str], window: int = 5, margin: float = 0.5, frames_needed: int = 3, stretch: int = 4096) -> DataFrame:
    """(keys, scene, frame, track_id): the face that stays chosen until another leads by margin for frames_needed frames.

    The state starts anew with each scene and after each frame in which nothing is scored, which chooses none: its track is
    null. The runs between are dealt out over tasks, which walk sorted frames one by one and hold the state of one run.
    """
    scored = smooth(candidates, [*keys, "scene", "track_id"], "frame", "score", window)
    seen = F.sort_array(F.collect_list(F.when(F.col("smoothed").isNotNull(), F.struct("track_id", "smoothed"))))
    by_frame = scored.groupBy(*keys, "scene", "frame").agg(seen.alias("_seen"))
    by_frame = by_frame.select(*keys, "scene", "frame", F.transform("_seen", lambda x: x["track_id"]).alias("tracks"), F.transform("_seen", lambda x: x["smoothed"]).alias("scores"))
    rows = selection_islands(by_frame, keys, stretch)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Held = (None, None, 0)
        for frames in batches:
            out = []
            for frame, island, tracks, scores in zip(frames["frame"], frames["island"], frames["tracks"], frames["scores"], strict=True):
                held = (None, None, 0) if frame == island else held
                held = choose(dict(zip(tracks, scores, strict=True)), held, margin, frames_needed) if len(tracks) else held
                out.append(held[0])
            yield frames[[*keys, "scene", "frame"]].assign(track_id=pd.Series(out, index=frames.index, dtype=object))

    kinds = {f.name: f.dataType.simpleString() for f in candidates.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in [*keys, "scene", "frame", "track_id"])
    runs = [*keys, "island"]
    return rows.repartition(*runs).sortWithinPartitions(*runs, "frame").mapInPandas(walk, schema)
