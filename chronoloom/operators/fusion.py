"""Agreement of speaker turns with face activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.operators.intervals import FINEST, range_join

MIN_ACTIVE_RATIO, MIN_FACE_FRAMES = 0.5, 2


def fuse(turns: DataFrame, frames: DataFrame, keys: list[str], id_col: str, width: float = FINEST, min_ratio: float = MIN_ACTIVE_RATIO, min_frames: int = MIN_FACE_FRAMES) -> DataFrame:
    """For each turn the face that speaks in it, and how far picture and sound agree.

    frames has t, track_id (null: no face), score (null: unscored) and active. A face qualifies if it is active in
    min_frames frames and in min_ratio of those where it is seen; the qualified come first, then more active frames,
    the higher mean score, the lower track.
    """
    right = frames.where("t is not null").select(*keys, F.col("t").alias("r_start"), F.col("t").alias("r_end"), "track_id", "score", "active")
    pairs = range_join(turns.where("start is not null and end is not null").select(*keys, id_col, "start", "end"), right, keys, width)
    by_track = pairs.groupBy(*keys, id_col, "track_id").agg(
        F.count("*").alias("n"), F.count_if(F.coalesce("active", F.lit(False)) & F.col("track_id").isNotNull()).alias("active"), F.avg("score").alias("mean"), F.max("score").alias("top")
    )
    qualified = (F.col("active") >= min_frames) & (F.col("active") / F.col("n") >= min_ratio)
    order = Window.partitionBy(*keys, id_col).orderBy(F.desc("candidate"), F.desc("qualified"), F.desc("active"), F.desc(F.round(F.coalesce("mean", F.lit(0.0)), 6)), F.asc_nulls_last("track_id"))
    whole = Window.partitionBy(*keys, id_col)
    alike = Window.partitionBy(*keys, id_col, "candidate", "qualified", "active")
    ranked = by_track.withColumns({"candidate": F.col("track_id").isNotNull() & (F.col("active") > 0), "qualified": qualified})
    ranked = ranked.withColumns({"rank": F.row_number().over(order), "tracks": F.count("track_id").over(whole), "tied": F.when(F.col("candidate"), F.sort_array(F.collect_list("track_id").over(alike))), "frames_in_turn": F.sum("n").over(whole), "face_frames": F.sum(F.when(F.col("track_id").isNotNull(), F.col("n")).otherwise(0)).over(whole)}).where("rank = 1")
    best = ranked.select(*keys, id_col, "track_id", "active", "n", "mean", "top", "candidate", "qualified", "frames_in_turn", "face_frames", "tracks", "tied")
    out = turns.join(best, [*keys, id_col], "left")
    state = (
        F.when(F.coalesce("frames_in_turn", F.lit(0)) == 0, "no_frames_measured").when(F.col("face_frames") == 0, "no_face_visible")
        .when(~F.col("candidate"), "face_never_active").when(F.col("qualified"), "face_matched").otherwise("face_partial")
    )
    won = F.col("candidate")
    return out.select(
        *keys, id_col, "speaker", F.coalesce("frames_in_turn", F.lit(0)).alias("frames_in_turn"), F.coalesce("face_frames", F.lit(0)).alias("face_frames_in_turn"),
        F.when(won, F.col("track_id")).alias("face_track_id"), F.when(won, F.col("active")).otherwise(0).alias("face_active_frames"),
        F.when(won, F.round("mean", 6)).alias("face_mean_score"), F.when(won, F.round("top", 6)).alias("face_score_max"), state.alias("agreement"), detail(min_ratio, min_frames).alias("agreement_detail"),
    )


def detail(min_ratio: float, min_frames: int) -> Column:
    """The numbers of a verdict in words: ties and how they were resolved, frames without a face, what fell short."""
    text = lambda c: F.col(c).cast("string")
    ratio = F.format_string("%.2f", F.col("active") / F.col("n"))
    mean = F.coalesce(F.format_string("%.2f", "mean"), F.lit("n/a"))
    hidden = F.col("frames_in_turn") - F.col("face_frames")
    gap = F.when(hidden > 0, F.concat(F.lit("; no face located on "), hidden.cast("string"), F.lit("/"), text("frames_in_turn"), F.lit(" measured frames of the window"))).otherwise("")
    tie = F.when(F.size("tied") > 1, F.concat(F.lit("tie between tracks "), F.array_join(F.transform("tied", lambda x: x.cast("string")), ", "), F.lit(" resolved to "), text("track_id"), F.lit(" by mean score, then track id; "))).otherwise("")
    few = F.when(F.col("active") < min_frames, F.concat(text("active"), F.lit(f" active frame(s) is below min_face_frames {min_frames}")))
    seldom = F.when(F.col("active") / F.col("n") < min_ratio, F.concat(F.lit("ratio "), ratio, F.lit(f" is below min_active_ratio {min_ratio:g}")))
    head = F.concat(tie, F.lit("track "), text("track_id"), F.lit(" active on "), text("active"), F.lit("/"), text("n"), F.lit(" frames in turn (ratio "), ratio)
    matched = F.concat(head, F.lit(f" >= min_active_ratio {min_ratio:g}, "), text("active"), F.lit(f" >= min_face_frames {min_frames}), mean score "), mean, gap)
    partly = F.concat(head, F.lit(", mean score "), mean, F.lit(") — "), F.concat_ws("; ", few, seldom), gap)
    never = F.concat(F.lit("faces visible on "), text("face_frames"), F.lit("/"), text("frames_in_turn"), F.lit(" measured frames across "), text("tracks"), F.lit(" track(s), but no track was ever flagged an active speaker (silent mouth or cutaway face)"))
    return (
        F.when(F.coalesce("frames_in_turn", F.lit(0)) == 0, "the active-speaker frame table covers no frame in this turn's window, so nothing was measured here (absence of measurement, not a sighting of an empty scene)")
        .when(F.col("face_frames") == 0, F.concat(F.lit("no face was located in any of the "), text("frames_in_turn"), F.lit(" ASD frames in this turn (voice with nothing visible: off-screen narrator or audio bed)")))
        .when(~F.col("candidate"), never).when(F.col("qualified"), matched).otherwise(partly)
    )
