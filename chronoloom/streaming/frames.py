"""Live frame streams: fixed windows, visibility sessions, frames that meet segments, late rows, body coordinates."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chronoloom.operators import pose


def windows(frames: DataFrame, time: str, keys: list[str], width: str, late: str, *aggregates: Column) -> DataFrame:
    """Tumbling windows from the epoch; frames later than `late` are dropped by the watermark."""
    cut = frames.withWatermark(time, late).groupBy(*keys, F.window(time, width).alias("w")).agg(*aggregates)
    return cut.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), *[c for c in cut.columns if c not in (*keys, "w")])


def sessions(frames: DataFrame, time: str, keys: list[str], gap: str, late: str) -> DataFrame:
    """Runs of frames no further apart than the gap."""
    cut = frames.withWatermark(time, late).groupBy(*keys, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("frames"))
    return cut.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "frames")


def frames_in_segments(frames: DataFrame, segments: DataFrame, keys: list[str], time: str, late: str, width: float = 60.0) -> DataFrame:
    """A static table of segments (start, end as timestamps) met by a stream of frames, bucket by bucket of `width` seconds, so
    that a frame meets the segments of its own bucket alone. Frames later than the watermark allows are left out."""
    second = lambda c: F.unix_micros(c) / 1e6
    cut = segments.withColumn("_b", F.explode(F.sequence(F.floor(second("start") / width), F.floor(F.greatest(second("start"), second("end")) / width))))
    live = frames.withWatermark(time, late).withColumn("_b", F.floor(second(time) / width))
    return live.join(cut, [*keys, "_b"]).where(F.col(time).between(F.col("start"), F.col("end"))).drop("_b")


def frames_in_live_segments(frames: DataFrame, segments: DataFrame, keys: list[str], time: str, late: str, longest: str, width: float = 60.0) -> DataFrame:
    """Frames that meet segments, both streams: (keys, time, segments' and frames' other columns), start and end as timestamps.

    Both sides are watermarked and cut into buckets of `width` seconds. A frame is held until no segment that is still to come
    can hold it, a segment until `longest` after its start, so state is bounded by the two delays, not by the recording. A
    segment longer than that ends the query with an error, as it would lose frames. What comes later than `late` meets nothing.
    """
    second = lambda c: F.unix_micros(c) / 1e6
    limit = F.expr(f"INTERVAL {longest}")
    whole = F.when(F.col("end") > F.col("start") + limit, F.raise_error(F.lit(f"a segment is longer than {longest}")).cast("timestamp")).otherwise(F.col("end"))
    cut = segments.withWatermark("start", late).withColumn("end", whole)
    cut = cut.withColumn("_sb", F.explode(F.sequence(F.floor(second("start") / width), F.floor(F.greatest(second("start"), second("end")) / width))))
    cut = cut.withColumnsRenamed({k: f"_s_{k}" for k in keys})
    live = frames.withWatermark(time, late).withColumn("_fb", F.floor(second(time) / width))
    same = [F.col(k) == F.col(f"_s_{k}") for k in keys]
    within = (F.col(time) >= F.col("start")) & (F.col(time) <= F.col("start") + limit) & (F.col(time) <= F.col("end"))
    return live.join(cut, reduce(Column.__and__, [*same, F.col("_fb") == F.col("_sb"), within])).drop("_fb", "_sb", *[f"_s_{k}" for k in keys])


def late_frames(frames: DataFrame, time: str, keys: list[str], late: str) -> DataFrame:
    """(keys, frames, out_of_order): how many frames of each key came after a later one of the same trigger was seen."""
    kinds = {f.name: f.dataType.simpleString() for f in frames.schema}

    def count(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        top, seen, behind = state.get if state.exists else (None, 0, 0)
        for batch in batches:
            for at in batch["_at"]:
                seen += 1
                behind += top is not None and at < top
                top = at if top is None else max(top, at)
        state.update((int(top), seen, behind))
        yield pd.DataFrame([(*key, seen, behind)], columns=[*keys, "frames", "out_of_order"])

    live = frames.withWatermark(time, late).select(*keys, F.unix_micros(time).alias("_at")).where("_at is not null")
    out = ", ".join([*(f"{c} {kinds[c]}" for c in keys), "frames bigint, out_of_order bigint"])
    return live.groupBy(*keys).applyInPandasWithState(count, out, "top bigint, seen bigint, behind bigint", "update", GroupStateTimeout.NoTimeout)


def normalized_pose(points: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """pose.normalize on a stream: keys and time name one body in one frame, which is held until the watermark passes it
    and emitted once; points of a frame that has been emitted are dropped as late."""
    others = [c for c in points.columns if c not in (*keys, time)]
    bodies = points.withWatermark(time, late).groupBy(*keys, time).agg(*[v.alias(n) for n, v in pose.joints().items()], F.collect_list(F.struct(*others)).alias("_points"))
    rows = bodies.select(*keys, time, *pose.joints(), F.explode("_points").alias("_p")).select(*keys, time, *pose.joints(), "_p.*")
    return pose.relative(rows, points.columns)
