"""Runs, gaps, steps, windows and nearest neighbours along ordered samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(rows: DataFrame, keys: list[str], order: list[str], label: Column) -> DataFrame:
    """rows with _label and _island: a number that changes where the label does. A null flag counts as false."""
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = rows.withColumn("_label", label)
    if marked.schema["_label"].dataType.typeName() == "boolean":
        marked = marked.withColumn("_label", F.coalesce("_label", F.lit(False)))
    changed = F.coalesce((~F.col("_label").eqNullSafe(F.lag("_label").over(w))).cast("int"), F.lit(1))
    first = F.when(F.row_number().over(w) == 1, 1).otherwise(changed)
    return marked.withColumn("_changed", first).withColumn("_island", F.sum("_changed").over(w)).drop("_changed")


def collapse_runs(rows: DataFrame, keys: list[str], time: str, label: Column) -> DataFrame:
    """(keys, label, start, end, samples) for each run of equal labels; end gains the median positive step."""
    w = Window.partitionBy(*keys).orderBy(time)
    gaps = rows.select(*keys, (F.col(time) - F.lag(time).over(w)).alias("gap"))
    steps = gaps.where("gap > 0").groupBy(*keys).agg(F.percentile("gap", F.lit(0.5)).alias("step"))
    runs = islands(rows, keys, [time], label).groupBy(*keys, "_island").agg(F.first("_label").alias("label"), F.min(time).alias("start"), F.max(time).alias("last"), F.count("*").alias("samples"))
    step = F.coalesce("step", F.lit(0.0))
    return runs.join(steps, keys, "left").select(*keys, "label", "start", (F.col("last") + step).alias("end"), "samples")


def silences(frames: DataFrame, keys: list[str], time: str, quiet: Column, minimum: float) -> DataFrame:
    """(keys, start, end): runs of quiet frames from the first one to the last plus the upper-median step, of at least minimum."""
    w = Window.partitionBy(*keys).orderBy(time)
    gaps = frames.select(*keys, (F.col(time) - F.lag(time).over(w)).alias("gap")).where("gap > 0")
    step = gaps.groupBy(*keys).agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY gap DESC)").alias("step"))
    runs = islands(frames, keys, [time], F.coalesce(quiet, F.lit(False))).where("_label").groupBy(*keys, "_island").agg(F.min(time).alias("start"), F.max(time).alias("last"))
    found = runs.join(step, keys, "left").select(*keys, F.round("start", 6).alias("start"), F.round(F.col("last") + F.coalesce("step", F.lit(0.0)), 6).alias("end"))
    return found.where(F.col("end") - F.col("start") + 1e-9 >= minimum)


def smooth(rows: DataFrame, keys: list[str], frame: str, score: str, window: int = 5) -> DataFrame:
    """rows with smoothed: the mean over frames within half the window; unscored rows stay null."""
    half = window // 2
    w = Window.partitionBy(*keys).orderBy(frame).rangeBetween(-half, half)
    return rows.withColumn("smoothed", F.when(F.col(score).isNotNull(), F.round(F.avg(score).over(w), 6)))


def fixed_windows(rows: DataFrame, keys: list[str], time: str, columns: str | list[str], width: float, fill: float = 0.5) -> DataFrame:
    """(keys, slot, start, end, frames, measured, value): low median of each window from the first sample; null where too few were measured.

    Of several columns a frame counts as measured if all are finite there, and value is a struct of their medians by name.
    """
    names = [columns] if isinstance(columns, str) else columns
    first = Window.partitionBy(*keys)
    placed = rows.withColumn("_first", F.min(time).over(first)).withColumn("slot", F.floor((F.col(time) - F.col("_first")) / width))
    # The edge is computed once as first + slot * width, and membership follows it.
    edge = lambda n: F.col("_first") + n * width
    placed = placed.withColumn("slot", F.when(F.col(time) < edge(F.col("slot")), F.col("slot") - 1).when(F.col(time) >= edge(F.col("slot") + 1), F.col("slot") + 1).otherwise(F.col("slot")))
    whole = reduce(Column.__and__, [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")) for c in names])
    placed = placed.withColumn("_whole", whole).withColumns({f"_{c}": F.when(F.col("_whole"), F.col(c)) for c in names})
    cells = placed.groupBy(*keys, "slot").agg(
        F.min("_first").alias("_first"), F.count("*").alias("frames"), F.count_if("_whole").alias("measured"),
        *[F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `_{c}`)").alias(c) for c in names],
    )
    found = F.col(names[0]) if isinstance(columns, str) else F.struct(*names)
    value = F.when((F.col("measured") >= fill * F.col("frames")) & (F.col("measured") > 0), found)
    return cells.select(*keys, "slot", (F.col("_first") + F.col("slot") * width).alias("start"), (F.col("_first") + (F.col("slot") + 1) * width).alias("end"), "frames", "measured", value.alias("value"))


def refused_windows(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, windows, thin_windows): windows with frames, and those of them in which too few were measured."""
    return cells.groupBy(*keys).agg(F.count("*").alias("windows"), F.count_if(F.col("value").isNull()).alias("thin_windows"))


def merge_windows(cells: DataFrame, keys: list[str], label: Column) -> DataFrame:
    """Neighbouring windows with the same label as one row; a refused or missing window ends a run."""
    kept = cells.withColumn("label", label).where("label is not null")
    w = Window.partitionBy(*keys).orderBy("slot")
    breaks = F.coalesce(((F.col("label") != F.lag("label").over(w)) | (F.col("slot") != F.lag("slot").over(w) + 1)).cast("int"), F.lit(1))
    runs = kept.withColumn("_n", breaks).withColumn("_run", F.sum("_n").over(w))
    return runs.groupBy(*keys, "_run").agg(F.first("label").alias("label"), F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("windows"), F.sum("measured").alias("measured")).drop("_run")


def nearest(probes: DataFrame, marks: DataFrame, keys: list[str], probe_time: str, mark_time: str, value: str) -> DataFrame:
    """probes with nearest and nearest_value: the mark closest in time on either side, the earlier of a tie."""
    columns = [c for c in probes.columns if c not in keys]
    a = probes.select(*keys, F.col(probe_time).alias("_t"), F.lit(1).alias("_kind"), F.struct(*columns).alias("_p"), F.lit(None).cast("struct<t:double,v:bigint>").alias("_m"))
    b = marks.select(*keys, F.col(mark_time).alias("_t"), F.lit(0).alias("_kind"), F.lit(None).cast(probes.select(F.struct(*columns).alias("x")).schema["x"].dataType).alias("_p"), F.struct(F.col(mark_time).cast("double").alias("t"), F.col(value).cast("bigint").alias("v")).alias("_m"))
    both = a.unionByName(b)
    back = Window.partitionBy(*keys).orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    # The next mark is the last one seen from the end: a growing frame costs one step a row, a shrinking one a whole pass.
    ahead = Window.partitionBy(*keys).orderBy(F.desc("_t"), F.desc("_kind")).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumns({"_l": F.last("_m", ignorenulls=True).over(back), "_r": F.last("_m", ignorenulls=True).over(ahead)}).where("_kind = 1")
    left_wins = F.col("_r").isNull() | (F.col("_l").isNotNull() & (F.col("_t") - F.col("_l.t") <= F.col("_r.t") - F.col("_t")))
    best = F.when(left_wins, F.col("_l")).otherwise(F.col("_r"))
    return found.select(*keys, "_p.*", best.alias("_best")).select(*keys, *columns, F.col("_best.t").alias("nearest"), F.col("_best.v").alias("nearest_value"))


def fill_scenes(rows: DataFrame, keys: list[str], order: str, scene: str) -> DataFrame:
    """rows with filled: the next known scene, or for a trailing gap the first known scene."""
    ahead = Window.partitionBy(*keys).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    first = F.min_by(scene, F.when(F.col(scene).isNotNull(), F.col(order))).over(Window.partitionBy(*keys))
    return rows.withColumn("filled", F.coalesce(F.last(scene, ignorenulls=True).over(ahead), first))
