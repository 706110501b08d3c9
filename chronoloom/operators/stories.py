"""Model answers about a transcript: what is refused, what is dropped, what is kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Decimals at which a boundary counts as one of the transcript's.
DECIMALS = 3
STORIES = "array<struct<story_id: string, parent_id: string, start: double, end: double, confidence: double, evidence: array<string>>>"


def propagate(dropped: Column, stories: Column) -> Column:
    """The dropped ids of an answer with all their descendants: at most as many rounds as there are stories."""
    def more(ids: Column, _: Column) -> Column:
        below = F.filter(stories, lambda s: F.array_contains(ids, s["parent_id"]))
        return F.array_union(ids, F.transform(below, lambda s: s["story_id"]))

    return F.aggregate(stories, dropped, more)


def in_cycle(stories: Column) -> Column:
    """True where a chain of parents is still going after as many steps as there are stories."""
    def climbs(s: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            return F.get(F.filter(stories, lambda p: p["story_id"] == at), F.lit(0))["parent_id"]

        return F.aggregate(stories, s["parent_id"], step).isNotNull()

    return F.exists(stories, climbs)


def validate(answers: DataFrame, segments: DataFrame, keys: list[str], window: str = "window") -> DataFrame:
    """(keys, window, story_id, status, reason, window_breach): each story accepted, dropped or, with its whole answer, rejected.

    answers: one row a window with stories (STORIES) and no_story_reason; segments: (keys, window, segment_id, start, end).
    A breach is an invented segment or boundary, a confidence outside 0 to 1, a missing or repeated id, a parent that the
    answer lacks, a cycle, or no story without a reason. A drop rests on another window's segments, or on a dropped parent.
    An answer without stories is one row with a null story_id.
    """
    unit = [*keys, window]

    def blank(c: Column) -> Column:
        return F.nullif(F.trim(c), F.lit(""))

    def homes(of: Column, name: str) -> DataFrame:
        return segments.groupBy(*keys, of.alias(name)).agg(F.collect_set(window).alias("_homes"))

    tidy = answers.select(*unit, F.length(blank(F.col("no_story_reason"))).isNotNull().alias("_excused"), F.posexplode_outer("stories").alias("_at", "s"))
    rows = tidy.select(*unit, "_excused", "_at", blank(F.col("s.story_id")).alias("story_id"), blank(F.col("s.parent_id")).alias("parent_id"), F.col("s.start").alias("_start"), F.col("s.end").alias("_end"), F.col("s.confidence").alias("_conf"), F.col("s.evidence").alias("_ev"))

    cited = rows.select(*unit, "_at", F.explode("_ev").alias("segment_id")).join(homes(F.col("segment_id"), "segment_id"), [*keys, "segment_id"], "left")
    cited = cited.groupBy(*unit, "_at").agg(F.bool_or(F.col("_homes").isNull()).alias("_invented"), F.bool_or(~F.array_contains("_homes", F.col(window))).alias("_elsewhere"))
    rows = rows.join(cited, [*unit, "_at"], "left")
    for side in ("start", "end"):
        rounded = rows.withColumn("_b", F.round(f"_{side}", DECIMALS))
        rows = rounded.join(homes(F.round(side, DECIMALS), "_b"), [*keys, "_b"], "left").withColumn(f"_{side}_homes", F.col("_homes")).drop("_b", "_homes")

    own = F.array_contains("_start_homes", F.col(window)) & F.array_contains("_end_homes", F.col(window))
    real = F.col("_start_homes").isNotNull() & F.col("_end_homes").isNotNull()
    breach = (
        F.when(F.col("_at").isNull(), F.when(~F.col("_excused"), "no stories and no reason"))
        .when(F.col("story_id").isNull(), "no story id")
        .when(F.coalesce(F.size("_ev") < 1, F.lit(True)), "no evidence")
        .when(F.col("_invented"), "invented evidence")
        .when(F.col("_start").isNull() | F.col("_end").isNull() | (F.col("_start") >= F.col("_end")), "no interval")
        .when(~real, "invented boundary")
        .when(F.col("_conf").isNull() | F.isnan("_conf") | ~F.col("_conf").between(0, 1), "bad confidence")
    )
    outside = F.when(F.col("_elsewhere"), "evidence in another window").when(~own, "boundary in another window")
    judged = rows.select(*unit, "_at", "story_id", "parent_id", breach.alias("_breach"), outside.alias("_outside"))

    one = F.struct("_at", "story_id", "parent_id", "_breach", "_outside")
    whole = judged.groupBy(*unit).agg(F.sort_array(F.collect_list(one)).alias("_all"))
    ids = F.transform("_all", lambda s: s["story_id"])
    whole = whole.withColumn("_dropped", propagate(F.transform(F.filter("_all", lambda s: s["_outside"].isNotNull()), lambda s: s["story_id"]), F.col("_all")))
    kept = F.filter("_all", lambda s: ~F.array_contains(F.col("_dropped"), s["story_id"]))
    first = F.get(F.filter(F.transform("_all", lambda s: s["_breach"]), lambda b: b.isNotNull()), F.lit(0))
    lost = F.exists("_all", lambda s: s["parent_id"].isNotNull() & ~F.coalesce(F.array_contains(ids, s["parent_id"]), F.lit(False)))
    refused = F.coalesce(first, F.when(F.size(F.array_distinct(ids)) < F.size(ids), "repeated story id"), F.when(lost, "unknown parent"), F.when(in_cycle(kept), "cycle of parents"))
    found = whole.select(*unit, "_dropped", refused.alias("window_breach"), F.explode("_all").alias("s"))
    gone = F.coalesce(F.array_contains("_dropped", F.col("s.story_id")), F.lit(False))
    status = F.when(F.col("window_breach").isNotNull(), "rejected").when(F.col("s.story_id").isNull(), "none").when(gone, "dropped").otherwise("accepted")
    reason = F.when(F.col("window_breach").isNotNull(), F.col("s._breach")).when(gone, F.coalesce("s._outside", F.lit("parent dropped")))
    named = F.when(F.col("s.story_id").isNotNull(), F.concat(F.lit("w"), F.col(window).cast("string"), F.lit("-"), F.col("s.story_id")))
    return found.select(*unit, named.alias("story_id"), status.alias("status"), reason.alias("reason"), "window_breach")
