"""Acoustic statistics of transcript segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.operators.intervals import FINEST, range_join


#: Columns of formants in Hz; frames may lack them.
FORMANTS = ("f1", "f2", "f3")


def finite(value: Column) -> Column:
    """The number, or null for NaN and infinities."""
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def frame_is_quiet(threshold_db: float | None = None, level: str = "intensity_db", voiced: str = "voiced") -> Column:
    """Whether a frame is quiet: its level is below the threshold, if one is set and the level was measured; else it is not voiced."""
    unvoiced = ~F.coalesce(F.col(voiced), F.lit(False))
    if threshold_db is None:
        return unvoiced
    measured = finite(F.col(level).cast("double"))
    return F.when(measured.isNotNull(), measured < threshold_db).otherwise(unvoiced)


def within_ceiling(formant: Column, ceiling_hz: float) -> Column:
    """A formant above zero and up to the ceiling; null for any other, which is worse than none."""
    return F.when((formant > 0) & (formant <= ceiling_hz), formant)


def statistics(value: str, prefix: str, keep: Column | None = None) -> list[Column]:
    """mean, exact median, min, max and population deviation of finite values, null if there are none."""
    x = finite(F.col(value)) if keep is None else F.when(keep, finite(F.col(value)))
    each = {"mean": F.avg(x), "median": F.percentile(x, F.lit(0.5)), "min": F.min(x), "max": F.max(x), "std": F.stddev_pop(x)}
    return [F.round(c, 6).alias(f"{prefix}_{n}") for n, c in each.items()]


def segment_features(segments: DataFrame, frames: DataFrame, pauses: DataFrame, keys: list[str], id_col: str, media_seconds: DataFrame, width: float = FINEST) -> DataFrame:
    """Features of each segment over the frames inside it, and its pauses against the length of the media.

    A segment without a start or an end holds no frame; its pauses are clipped at the bound that it has."""
    eps = 1e-9
    right = frames.select(*keys, F.col("t").alias("r_start"), F.col("t").alias("r_end"), "pitch", "level", "voiced", *[F.col(c) for c in FORMANTS if c in frames.columns])
    formants = [c for c in FORMANTS if c in frames.columns]
    inside = range_join(segments.select(*keys, id_col, "start", "end"), right, keys, width, eps)
    found = inside.groupBy(*keys, id_col).agg(
        F.count("*").alias("frames"), F.round(F.count_if(F.coalesce("voiced", F.lit(False))) / F.count("*"), 6).alias("voiced_ratio"), *statistics("pitch", "f0", F.col("voiced")), *statistics("level", "intensity"), *[F.round(F.avg(finite(F.col(c))), 6).alias(f"{c}_mean") for c in formants]
    )
    open_ends = pauses.groupBy(*keys).agg(F.min("start").alias("_first"), F.max("end").alias("_last"))
    bounded = segments.join(open_ends, keys).select(*keys, id_col, F.coalesce("start", "_first").alias("start"), F.coalesce("end", "_last").alias("end"))
    quiet = range_join(bounded, pauses.select(*keys, F.col("start").alias("r_start"), F.col("end").alias("r_end")), keys, width)
    clipped = quiet.withColumn("cut", F.least("end", "r_end") - F.greatest("start", "r_start")).where("cut > 0")
    paused = clipped.groupBy(*keys, id_col).agg(F.count("*").alias("pause_count"), F.sum("cut").alias("pause_seconds"))
    out = segments.select(*keys, id_col).join(found, [*keys, id_col], "left").join(paused, [*keys, id_col], "left").join(media_seconds, keys, "left")
    stats = [f"{p}_{s}" for p in ("f0", "intensity") for s in ("mean", "median", "min", "max", "std")] + [f"{c}_mean" for c in formants]
    return out.select(
        *keys, id_col, F.coalesce("frames", F.lit(0)).alias("frames"), "voiced_ratio", *stats, F.coalesce("pause_count", F.lit(0)).alias("pause_count"),
        F.round(F.coalesce("pause_seconds", F.lit(0.0)), 6).alias("pause_duration"), F.round(F.coalesce("pause_seconds", F.lit(0.0)) / F.col("media_seconds"), 6).alias("pause_ratio"),
    )
