"""Data-quality contracts of the tables, as rows (rule, key): each is a list of named conditions that a row must not meet.

Conditions on single rows are checked in one pass; those on groups or on other tables are aggregations and joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.operators.canonical import BODY_25
from chronoloom.operators.pose import present
from chronoloom.operators.quality import violations
from chronoloom.operators.running import running

#: The closed vocabularies of the tables.
FRAME_REASONS = ["no_face", "scored", "imputed_tail", "score_not_finite", "track_has_no_scores", "tail_score_not_finite", "past_scored_tail", "unknown"]
UNSCORED_REASONS = FRAME_REASONS[3:]
CONFIDENCE_REASONS = ["tracked", "no_track_confidence"]
ENGINES = ["pyannote", "nemotron"]
AGREEMENTS = ["no_frames_measured", "no_face_visible", "face_never_active", "face_matched", "face_partial"]
BASIS_STATES = ["basis_ok", "basis_missing_joint", "basis_degenerate", "basis_non_finite"]
VALUE_STATES = ["normalized", "no_coordinate", "basis_unusable"]


def _infinite(c: str) -> Column:
    return F.col(c).isNull() | F.isnan(c) | (F.abs(c) == float("inf"))


def _box_rules() -> dict[str, Column]:
    whole = ~reduce(Column.__or__, [_infinite(c) for c in ("x1", "y1", "x2", "y2")])
    return {"box_missing": ~whole, "box_inverted": whole & ((F.col("x1") > F.col("x2")) | (F.col("y1") > F.col("y2")))}


def table_rules(time: str, duration: str) -> dict[str, Column]:
    """Times of a table against the media: not null, not before zero, not a second past the end."""
    return {"no_time": F.col(time).isNull(), "before_zero": F.col(time) < -1e-6, "past_duration": F.col(time) > F.col(duration) + 1.0}


def out_of_order(rows: DataFrame, keys: list[str], place: str, time: str, key: str) -> DataFrame:
    """(rule, key) of rows whose time is before that of the row stored before them."""
    before = F.lag(time).over(Window.partitionBy(*keys).orderBy(place))
    return violations(rows.withColumn("_before", before), key, {"out_of_order": F.col(time) < F.col("_before")})


def missing_columns(rows: DataFrame, expected: list[str]) -> list[str]:
    return [c for c in expected if c not in rows.columns]


def interval_rules(start: str, end: str, duration: str) -> dict[str, Column]:
    return {"ends_before_start": F.col(end) < F.col(start) - 1e-6, "starts_before_zero": F.col(start) < -1e-3, "starts_past_duration": F.col(start) > F.col(duration) + 1.0}


def transcript_problems(recordings: DataFrame, segments: DataFrame, words: DataFrame, keys: list[str], stretch: int = 100_000) -> DataFrame:
    """(rule, key) of a transcript: recordings (keys, language, duration) without a language; segments (keys, place, segment_id, start,
    end) and words (keys, word_id, segment_id, start, end) with impossible times; segments that begin before the one stored
    before them; words of segments that are not there. A segment without a start stands in nobody's way."""
    held = recordings.select(*keys, "duration")
    named = recordings.withColumn("_key", F.concat_ws(":", *[F.col(k).cast("string") for k in keys]))
    found = [violations(named, "_key", {"no_language": ~F.coalesce(F.length(F.trim("language")) > 0, F.lit(False))})]
    for name, rows in (("segment", segments), ("word", words)):
        rules = {f"{name}_{rule}": bad for rule, bad in interval_rules("start", "end", "duration").items()}
        found.append(violations(rows.join(held, keys, "left"), f"{name}_id", rules))
    # The row stored just before counts, with a start or without one.
    before = running(segments, keys, ["place"], F.floor(F.col("place") / stretch), strict=True, _before=("last", F.struct("start")))
    found.append(violations(before, "segment_id", {"segment_out_of_order": F.col("start") < F.col("_before.start")}))
    known = segments.select(*keys, "segment_id").distinct()
    orphans = words.select(*keys, "segment_id").distinct().join(known, [*keys, "segment_id"], "left_anti")
    found.append(orphans.select(F.lit("unknown_segment").alias("rule"), F.col("segment_id").cast("string").alias("key")))
    return reduce(DataFrame.unionByName, found)


def person_document_problems(documents: DataFrame, summaries: DataFrame, frames: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rule, person_id) where the raw document's claims (keys, person_ids, max_persons_in_frame, frames_with_person) and the two
    tables disagree: people declared and absent, present and undeclared, summarised twice, and the counts of frames."""
    ids = frames.where("person_id is not null").select(*keys, F.col("person_id").cast("bigint").alias("person_id")).distinct().withColumn("_there", F.lit(True))
    told = documents.select(*keys, F.explode(F.array_distinct("person_ids")).alias("person_id")).withColumn("_declared", F.lit(True))
    both = told.join(ids, [*keys, "person_id"], "full")
    rule = F.when(F.col("_there").isNull(), "declared_and_absent").when(F.col("_declared").isNull(), "never_declared")
    twice = summaries.groupBy(*keys, F.col("person_id").cast("bigint").alias("person_id")).count().where("count > 1").select(*keys, F.lit("summarised_twice").alias("rule"), "person_id")
    by_frame = frames.where("person_id is not null").groupBy(*keys, "frame_number").agg(F.count("*").alias("_n"))
    counts = documents.join(by_frame.groupBy(*keys).agg(F.max("_n").alias("_most"), F.count("*").alias("_frames")), keys, "left")
    wrong = {"max_persons_in_frame": F.col("max_persons_in_frame") != F.coalesce("_most", F.lit(0)), "frames_with_person": F.coalesce("frames_with_person", F.lit(0)) != F.coalesce("_frames", F.lit(0))}
    broken = F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in wrong.items()]), lambda x: x.isNotNull())
    totals = counts.select(*keys, F.explode(broken).alias("rule"), F.lit(None).cast("bigint").alias("person_id"))
    return both.withColumn("rule", rule).where("rule is not null").select(*keys, "rule", "person_id").unionByName(twice).unionByName(totals)


def metadata_rules() -> dict[str, Column]:
    """A probed recording has a positive duration, a size and a rate, and a codec."""
    return {
        "no_duration": ~F.coalesce(F.col("duration_seconds") > 0, F.lit(False)), "no_size": ~F.coalesce((F.col("width") > 0) & (F.col("height") > 0), F.lit(False)),
        "no_rate": ~F.coalesce(F.col("average_frame_rate") > 0, F.lit(False)), "no_codec": ~F.coalesce(F.length("video_codec") > 0, F.lit(False)),
    }


def dense_sequence(rows: DataFrame, keys: list[str], number: str, place: str | None = None) -> DataFrame:
    """(keys, problem, at) where a key's numbers are not 0 to n - 1: null, duplicate, out of order (by place), missing, out of range."""
    facts = rows.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count(number).alias("known"), F.count_distinct(number).alias("distinct"), F.min(number).alias("low"), F.max(number).alias("high"),
    )
    twice = rows.where(F.col(number).isNotNull()).groupBy(*keys, number).count().where("count > 1").groupBy(*keys).agg(F.min(number).alias("twice"))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(number)) - 1
    gap = rows.where(F.col(number).isNotNull()).select(*keys, number).distinct().withColumn("_at", first).where(F.col("_at") < F.col(number)).groupBy(*keys).agg(F.min("_at").alias("gap"))
    facts = facts.join(twice, keys, "left").join(gap, keys, "left")
    if place:
        stored = rows.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(place)) - 1).where(F.col("_at") != F.col(number))
        facts = facts.join(stored.groupBy(*keys).agg(F.min("_at").alias("moved")), keys, "left")
    else:
        facts = facts.withColumn("moved", F.lit(None).cast("bigint"))
    found = (
        F.when(F.col("known") < F.col("n"), F.struct(F.lit("null").alias("problem"), F.lit(None).cast("bigint").alias("at")))
        .when(F.col("twice").isNotNull(), F.struct(F.lit("duplicate").alias("problem"), F.col("twice").cast("bigint").alias("at")))
        .when(F.col("low") < 0, F.struct(F.lit("out_of_range").alias("problem"), F.col("low").cast("bigint").alias("at")))
        .when(F.col("gap").isNotNull(), F.struct(F.lit("missing").alias("problem"), F.col("gap").cast("bigint").alias("at")))
        .when(F.col("moved").isNotNull(), F.struct(F.lit("out_of_order").alias("problem"), F.col("moved").cast("bigint").alias("at")))
    )
    return facts.withColumn("_p", found).where("_p is not null").select(*keys, "_p.problem", "_p.at")


def sequence_breaks(rows: DataFrame, keys: list[str], number: str, place: str | None = None) -> DataFrame:
    """(keys, problem, rows, first, last): every way in which a key's numbers are not 0 to n - 1. Rows without a number, or else numbers
    that come twice, stand alone; numbers that are missing and those outside are named together; where all are there, the
    places (by place) that hold another number are out of order, the first of them being named."""
    values = rows.groupBy(*keys, F.col(number).cast("bigint").alias("_x")).agg(F.count("*").alias("_c"))
    facts = values.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.sum(F.when(F.col("_x").isNull(), F.col("_c")).otherwise(0)).alias("_nulls"), F.count_if(F.col("_x").isNotNull() & (F.col("_c") > 1)).alias("_twice"))
    known = values.where("_x is not null").join(facts, keys).withColumn("_in", F.col("_x").between(0, F.col("_n") - 1))
    own = Window.partitionBy(*keys, "_in")
    up, down = F.row_number().over(own.orderBy("_x")) - 1, F.row_number().over(own.orderBy(F.desc("_x"))) - 1
    placed = known.withColumns({"_up": up, "_down": down})
    inside = F.col("_in")
    seen = placed.groupBy(*keys).agg(
        F.max("_n").alias("_n"), F.max("_nulls").alias("_nulls"), F.max("_twice").alias("_twice"), F.count_if(inside).alias("_held"), F.min(F.when(F.col("_c") > 1, F.col("_x"))).alias("_dup"), F.max(F.when(F.col("_c") > 1, F.col("_x"))).alias("_dup_last"),
        F.min(F.when(inside & (F.col("_up") < F.col("_x")), F.col("_up"))).alias("_gap"), F.max(F.when(inside & (F.col("_n") - 1 - F.col("_down") > F.col("_x")), F.col("_n") - 1 - F.col("_down"))).alias("_gap_last"),
        F.count_if(~inside).alias("_out"), F.min(F.when(~inside, F.col("_x"))).alias("_out_first"), F.max(F.when(~inside, F.col("_x"))).alias("_out_last"),
    )
    seen = facts.select(*keys).join(seen, keys, "left").join(facts.select(*keys, F.col("_n").alias("_rows"), F.col("_nulls").alias("_lost")), keys)
    if place:
        stored = rows.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(place)) - 1).where(F.col("_at") != F.col(number))
        seen = seen.join(stored.groupBy(*keys).agg(F.count("*").alias("_moved"), F.min("_at").alias("_moved_first"), F.max("_at").alias("_moved_last")), keys, "left")
    else:
        seen = seen.withColumns({c: F.lit(None).cast("bigint") for c in ("_moved", "_moved_first", "_moved_last")})

    def told(problem: str, n: Column, first: Column, last: Column) -> Column:
        return F.struct(F.lit(problem).alias("problem"), n.cast("bigint").alias("rows"), first.cast("bigint").alias("first"), last.cast("bigint").alias("last"))

    none = F.lit(None)
    lost = F.col("_n") - F.col("_held")
    missing = F.when(lost > 0, told("missing", lost, F.coalesce("_gap", "_held"), F.coalesce("_gap_last", F.col("_n") - 1 - F.col("_held"))))
    outside = F.when(F.col("_out") > 0, told("out_of_range", F.col("_out"), F.col("_out_first"), F.col("_out_last")))
    moved = F.when((lost == 0) & F.col("_moved").isNotNull(), told("out_of_order", F.col("_moved"), F.col("_moved_first"), F.col("_moved_last")))
    problems = (
        F.when(F.col("_lost") > 0, F.array(told("null", F.col("_lost"), none, none))).when(F.col("_twice") > 0, F.array(told("duplicate", F.col("_twice"), F.col("_dup"), F.col("_dup_last"))))
        .otherwise(F.filter(F.array(missing, outside, moved), lambda x: x.isNotNull()))
    )
    return seen.select(*keys, F.explode(problems).alias("p")).select(*keys, "p.*")


def face_frame_rules() -> dict[str, Column]:
    """Rows (track_id, face_status, frame_reason, talknet_score, talknet_score_raw, score_imputed, is_active_speaker, box)."""
    reason, status, scored = F.col("frame_reason"), F.col("face_status"), F.col("talknet_score").isNotNull()
    claims, face, unscored = reason.isin("scored", "imputed_tail"), F.col("track_id").isNotNull(), status == "tracked_unscored"
    return {
        "unknown_reason": reason.isNull() | ~reason.isin(*FRAME_REASONS), "no_face_disagrees": (status == "no_face") != (reason == "no_face"), "claims_a_score": claims & ~scored, "hides_a_score": scored & ~claims,
        "imputed_disagrees": F.col("score_imputed") != (reason == "imputed_tail"), "unscored_without_reason": unscored & ~reason.isin(*UNSCORED_REASONS), "active_without_face": ~face & F.col("is_active_speaker"),
        "status_without_track": ~face & (status != "no_face"), "unscored_with_score": face & unscored & (scored | F.col("talknet_score_raw").isNotNull()),
        "unscored_and_active": face & unscored & (F.col("score_imputed") | F.col("is_active_speaker")), "score_not_finite": face & ~unscored & _infinite("talknet_score"),
        **{name: face & bad for name, bad in _box_rules().items()},
    }


def person_frame_rules() -> dict[str, Column]:
    """Rows (person_id, confidence, track_confidence, confidence_reason, box, bbox_area, persons_in_frame)."""
    reason, known = F.col("confidence_reason"), F.col("track_confidence").isNotNull()
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    return {
        "no_person": F.col("person_id").isNull(), "unknown_reason": reason.isNull() | ~reason.isin(*CONFIDENCE_REASONS), "denies_track_confidence": known & (reason != "tracked"), "claims_track_confidence": ~known & (reason == "tracked"),
        "no_confidence": F.col("confidence").isNull(), "confidence_range": ~F.col("confidence").between(0, 1), **_box_rules(), "no_area": F.col("bbox_area").isNull() & area.isNotNull(),
        "area_differs": F.abs(F.col("bbox_area") - area) > F.greatest(F.lit(1e-6), F.abs(area) * 1e-6), "no_count": F.col("persons_in_frame").isNull(), "count_below_one": F.col("persons_in_frame") < 1,
    }


def person_counts(frames: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, frame_number, rule, declared, held): frames whose rows declare another number of people than they are."""
    held = frames.where("person_id is not null").groupBy(*keys, "frame_number").agg(F.count("*").alias("held"), F.min("persons_in_frame").alias("declared"), F.max("persons_in_frame").alias("_most"))
    rule = F.when(F.col("declared") < F.col("_most"), "declares_several").when(F.col("declared") != F.col("held"), "declares_another")
    return held.withColumn("rule", rule).where("rule is not null").select(*keys, "frame_number", "rule", "declared", "held")


def person_track_problems(summaries: DataFrame, frames: DataFrame, keys: list[str], measured: DataFrame) -> DataFrame:
    """(keys, person_id, rule): summaries that their frames do not bear out, people without either."""
    gap = F.col("t") - F.lag("t").over(Window.partitionBy(*keys, "person_id").orderBy("t"))
    own = frames.withColumn("_gap", gap).groupBy(*keys, "person_id").agg(F.count("*").alias("_n"), F.min("t").alias("_first"), F.max("t").alias("_last"), F.coalesce(F.max("_gap"), F.lit(0.0)).alias("_longest"))
    rows = summaries.join(own, [*keys, "person_id"], "full").join(measured, keys, "left").withColumn("_cover", F.coalesce(F.try_divide("_n", "frames_measured"), F.lit(0.0)))
    off = lambda a, b, most: F.abs(F.coalesce(F.col(a), F.lit(0.0)) - F.col(b)) > most
    rules = {
        "no_frames": F.col("_n").isNull(), "no_summary": F.col("frame_count").isNull(), "frame_count": off("frame_count", "_n", 0), "first_timestamp": off("first_timestamp", "_first", 1e-6), "last_timestamp": off("last_timestamp", "_last", 1e-6),
        "duration": F.abs(F.col("duration_seconds") - (F.col("last_timestamp") - F.col("first_timestamp"))) > 2e-6, "coverage": off("frame_coverage", "_cover", 1e-3), "coverage_above_one": F.col("frame_coverage") > 1, "longest_gap": off("longest_gap_seconds", "_longest", 1e-3),
    }
    broken = F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules.items()]), lambda x: x.isNotNull())
    return rows.select(*keys, "person_id", F.explode(broken).alias("rule"))


def fusion_rules() -> dict[str, Column]:
    """Rows (agreement, frames_in_turn, face_frames_in_turn, face_active_frames, face_track_id)."""
    state, won = F.col("agreement"), F.col("face_track_id").isNotNull()
    return {
        "unknown_agreement": state.isNull() | ~state.isin(*AGREEMENTS), "counts_not_nested": (F.col("face_active_frames") > F.col("face_frames_in_turn")) | (F.col("face_frames_in_turn") > F.col("frames_in_turn")),
        "winner_without_activity": won & (F.col("face_active_frames") < 1), "match_without_winner": state.isin("face_matched", "face_partial") & ~won, "winner_without_match": won & ~state.isin("face_matched", "face_partial"),
        "frames_disagree": (state == "no_frames_measured") != (F.col("frames_in_turn") == 0),
        "no_face_disagrees": (state == "no_face_visible") & ~((F.col("frames_in_turn") > 0) & (F.col("face_frames_in_turn") == 0)),
    }


def fusion_problems(rows: DataFrame, turns: DataFrame, keys: list[str], engine: str, id_col: str = "turn_id", duration: str | None = None) -> DataFrame:
    """(rule, key) of one engine's fused table: its rules row by row, an engine of its own, a detail in every row, each turn once,
    and the turns that it was made from. rows also have engine, agreement_detail, start and end."""
    rules = fusion_rules() | {
        "unknown_engine": F.col("engine").isNull() | ~F.col("engine").isin(*ENGINES), "other_engine": F.col("engine").isin(*ENGINES) & (F.col("engine") != engine), "no_detail": ~F.coalesce(F.length("agreement_detail") > 0, F.lit(False)),
        "ends_before_start": F.col("end") < F.col("start") - 1e-6, "starts_before_zero": F.col("start") < -1e-3,
    }
    if duration:
        rules["starts_past_duration"] = F.col("start") > F.col(duration) + 1.0
    key = [*keys, id_col]
    counted = rows.groupBy(*key).agg(F.count("*").alias("_n"))
    both = counted.join(turns.select(*key, F.lit(True).alias("_asked")).distinct(), key, "full")
    rule = F.when(F.col("_n") > 1, "repeated_turn").when(F.col("_n").isNull(), "missing_turn").when(F.col("_asked").isNull(), "unknown_turn")
    sets = both.withColumn("rule", rule).where("rule is not null").select("rule", F.col(id_col).cast("string").alias("key"))
    return violations(rows, id_col, rules).unionByName(sets)


def pose_rules(whole: bool = False) -> dict[str, Column]:
    """Rows of normalised key points; whole: of the stored table, which also has basis_detail, keypoint_id and keypoint_name."""
    placed = F.col("x_norm").isNotNull() & F.col("y_norm").isNotNull()
    rules = {
        "unknown_basis": F.col("basis_state").isNull() | ~F.col("basis_state").isin(*BASIS_STATES), "unknown_status": F.col("value_status").isNull() | ~F.col("value_status").isin(*VALUE_STATES),
        "status_disagrees": (F.col("value_status") == "normalized") != placed, "normalized_without_basis": (F.col("value_status") == "normalized") & (F.col("basis_state") != "basis_ok"),
        "coordinate_disagrees": (F.col("value_status") == "no_coordinate") != (present(F.col("x")).isNull() | present(F.col("y")).isNull()),
        "placed_without_basis": placed & (F.col("basis_state") != "basis_ok"), "unusable_within_ok": (F.col("value_status") == "basis_unusable") & (F.col("basis_state") == "basis_ok"),
    }
    if whole:
        names = F.array(*[F.lit(x) for x in BODY_25[:-1]])
        known = F.col("keypoint_id").between(0, len(BODY_25) - 2)
        rules |= {
            "no_basis_detail": ~F.coalesce(F.length("basis_detail") > 0, F.lit(False)), "unknown_point": ~F.coalesce(known, F.lit(False)),
            "wrong_name": known & ~F.get(names, F.col("keypoint_id").cast("int")).eqNullSafe(F.col("keypoint_name")),
        }
    return rules


def keypoint_rules(names: int) -> dict[str, Column]:
    """Raw key points: a time, a frame, a positive score, coordinates, a number below names."""
    return {"no_time": F.col("timestamp").isNull(), "negative_frame": F.col("frame_number") < 0, "no_score": ~F.coalesce(F.col("score") > 0, F.lit(False)), "no_coordinate": F.col("x").isNull() | F.col("y").isNull(), "unknown_point": ~F.col("keypoint_id").between(0, names - 1)}


def answers(requested: DataFrame, answered: DataFrame, keys: list[str], id_col: str, text_col: str) -> DataFrame:
    """(keys, id, rule): ids asked for that have no answer, have several or an empty one, and answers nobody asked for."""
    counted = answered.groupBy(*keys, id_col).agg(F.count("*").alias("_n"), F.bool_or(F.length(F.trim(F.coalesce(text_col, F.lit("")))) == 0).alias("_empty"))
    both = requested.select(*keys, id_col, F.lit(True).alias("_asked")).distinct().join(counted, [*keys, id_col], "full")
    rule = F.when(F.col("_n").isNull(), "missing").when(F.col("_asked").isNull(), "extra").when(F.col("_n") > 1, "repeated").when(F.col("_empty"), "empty")
    return both.withColumn("rule", rule).where("rule is not null").select(*keys, id_col, "rule")


def table_of_answers(segments: DataFrame, rows: DataFrame, keys: list[str], id_col: str, source_col: str) -> DataFrame:
    """(keys, id, rule): a table of answers has the segments' ids, and their source text unchanged."""
    both = segments.select(*keys, id_col, F.col(source_col).alias("_said"), F.lit(1).alias("_a")).join(rows.select(*keys, id_col, F.col(source_col).alias("_kept"), F.lit(1).alias("_b")), [*keys, id_col], "full")
    rule = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra").when(~F.col("_said").eqNullSafe(F.col("_kept")), "source_changed")
    return both.withColumn("rule", rule).where("rule is not null").select(*keys, id_col, "rule")


def story_table(stories: DataFrame, segments: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, story_id, rule): ids once, parents that exist, boundaries that are a segment's to the millisecond."""
    ids = stories.groupBy(*keys, "story_id").count()
    twice = ids.where("count > 1").select(*keys, "story_id", F.lit("repeated_id").alias("rule"))
    orphan = stories.where("parent_id is not null").join(ids.select(*keys, F.col("story_id").alias("parent_id")), [*keys, "parent_id"], "left_anti").select(*keys, "story_id", F.lit("unknown_parent").alias("rule"))
    found = [twice, orphan]
    for side in ("start", "end"):
        real = segments.select(*keys, F.round(side, 3).alias("_b")).distinct()
        found.append(stories.withColumn("_b", F.round(side, 3)).join(real, [*keys, "_b"], "left_anti").select(*keys, "story_id", F.lit(f"unknown_{side}").alias("rule")))
    return reduce(DataFrame.unionByName, found)


def token_problems(tokens: DataFrame, sentences: DataFrame, keys: list[str]) -> DataFrame:
    """(token_id, rule): tokens whose sentence is unknown, whose id repeats, or that say nothing of their timing."""
    lost = tokens.join(sentences.select(*keys, "sentence_id").distinct(), [*keys, "sentence_id"], "left_anti").select("token_id", F.lit("unknown_sentence").alias("rule"))
    twice = tokens.groupBy(*keys, "token_id").count().where("count > 1").select("token_id", F.lit("repeated_id").alias("rule"))
    return lost.unionByName(twice).unionByName(tokens.where("alignment_status is null").select("token_id", F.lit("no_status").alias("rule")))


def turn_problems(turns: DataFrame, keys: list[str], most_speakers: int) -> DataFrame:
    """(rule, key): turns without speaker or length or with a negative overlap, and recordings with too many speakers."""
    rules = {"no_speaker": F.coalesce(F.length("speaker"), F.lit(0)) == 0, "no_length": ~F.coalesce(F.col("end") > F.col("start"), F.lit(False)), "negative_overlap": F.col("overlap_s") < 0}
    many = turns.groupBy(*keys).agg(F.count_distinct("speaker").alias("_n")).where(F.col("_n") > most_speakers)
    return violations(turns, "turn_id", rules).unionByName(many.select(F.lit("too_many_speakers").alias("rule"), F.concat_ws("|", *keys).alias("key")))


def assignment_problems(rows: DataFrame, turns: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """(rule, key): speakers that no turn has, shares outside 0 to 1, overlaps longer than their span."""
    known = turns.select(*keys, "speaker").distinct()
    lost = rows.where("speaker is not null").join(known, [*keys, "speaker"], "left_anti").select(F.lit("unknown_speaker").alias("rule"), F.col(id_col).cast("string").alias("key"))
    return lost.unionByName(violations(rows, id_col, {"ratio_range": ~F.col("overlap_ratio").between(0, 1), "overlap_too_long": F.col("overlap_seconds") > F.col("end") - F.col("start") + 1e-6}))


def acoustic_problems(rows: DataFrame, segments: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """(rule, key): features of segments that do not exist, whose times have drifted, or with more pause than time."""
    own = segments.select(*keys, id_col, F.col("start").alias("_s"), F.col("end").alias("_e"), F.lit(True).alias("_there"))
    both = rows.join(own, [*keys, id_col], "left")
    drift = (F.abs(F.col("start") - F.col("_s")) > 1e-6) | (F.abs(F.col("end") - F.col("_e")) > 1e-6)
    return violations(both, id_col, {"unknown_segment": F.col("_there").isNull(), "times_differ": drift, "pause_ratio": F.col("pause_ratio") > 1})


def manifest_problems(files: DataFrame, present_files: DataFrame) -> DataFrame:
    """(path, rule): paths that are absolute, that leave the data set, or that are not there."""
    rule = F.when(F.col("path").rlike(r"^(/|[A-Za-z]:|\w+://)"), "absolute").when(F.col("path").rlike(r"(^|/)\.\.(/|$)"), "outside")
    odd = files.select("path", rule.alias("rule"))
    gone = odd.where("rule is null").select("path").join(present_files.select("path").distinct(), "path", "left_anti").select("path", F.lit("absent").alias("rule"))
    return odd.where("rule is not null").unionByName(gone)


def report_problems(summary: DataFrame, videos: DataFrame) -> DataFrame:
    """(rule): a batch's summary counts (videos, completed, failed) that its list of videos does not give."""
    real = videos.agg(F.count("*").alias("_videos"), F.count_if(F.col("status") == "completed").alias("_completed"), F.count_if(F.col("status") == "failed").alias("_failed"))
    both = summary.join(F.broadcast(real))  # one row beside the summary's one
    return both.select(F.explode(F.filter(F.array(*[F.when(F.col(c) != F.col(f"_{c}"), F.lit(f"{c}_differs")) for c in ("videos", "completed", "failed")]), lambda x: x.isNotNull())).alias("rule"))


def drift_rules(audio: str = "audio_seconds", video: str = "video_seconds") -> dict[str, Column]:
    """Sound and picture may differ by two seconds or two per cent."""
    return {"audio_drift": F.abs(F.col(audio) - F.col(video)) > F.greatest(F.lit(2.0), 0.02 * F.col(video))}
