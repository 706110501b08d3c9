"""Queries over contracts, canonical rows, answers and summaries, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronoloom.operators import answers, canonical, contracts, fusion, intervals, quality, summaries
from chronoloom.plans.export import FACES_SQL, faces
from chronoloom.plans.registry import register
from chronoloom.plans.timeline import face_frames
from chronoloom.sources.tables import EVENTS_SQL, events, spans, spans_sql, table

VIDEO = ["video_id"]


def rules_sql(source: str, key: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS rule, {key}::VARCHAR AS key FROM {source} WHERE {bad}" for name, bad in rules.items())


@register(
    "lineitem_contract",
    "WITH l AS (SELECT l_orderkey * 10 + l_linenumber AS id, epoch(l_shipdate)::DOUBLE AS s, epoch(l_shipdate)::DOUBLE + (l_quantity - 5) * 86400.0 AS e FROM lineitem), r AS (SELECT id, s - 700000000 AS s, e - 700000000 AS e, 200000000.0 AS d FROM l) "
    + rules_sql("r", "id", {"ends_before_start": "e < s - 1e-6", "starts_before_zero": "s < -1e-3", "starts_past_duration": "s > d + 1", "no_time": "s IS NULL", "before_zero": "s < -1e-6", "past_duration": "s > d + 1"}),
)
def lineitem_contract(spark, sf_dir):
    start = F.unix_seconds(F.col("l_shipdate").cast("timestamp")).cast("double") - 700000000
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), start.alias("s"), (start + (F.col("l_quantity") - 5) * 86400.0).alias("e"), F.lit(200000000.0).alias("d"))
    return quality.violations(rows, "id", contracts.interval_rules("s", "e", "d") | contracts.table_rules("s", "d"))


@register(
    "out_of_order",
    f"""WITH {EVENTS_SQL}, o AS (SELECT event_id, value, lag(value) OVER (PARTITION BY video_id ORDER BY event_id) AS b FROM ev) SELECT 'out_of_order' AS rule, event_id::VARCHAR AS key FROM o WHERE value < b""",
)
def out_of_order(spark, sf_dir):
    return contracts.out_of_order(events(spark, sf_dir), VIDEO, "event_id", "value", "event_id")


@register(
    "dense_sequence",
    f"""WITH {EVENTS_SQL}, n AS (SELECT user_id AS k, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 + CASE WHEN event_type = 'error' AND value > 60 THEN 1 ELSE 0 END AS f, event_id FROM ev),
    a AS (SELECT k, count(*) AS n, count(DISTINCT f) AS d, max(f) AS hi FROM n GROUP BY 1), tw AS (SELECT k, min(f) AS twice FROM (SELECT k, f FROM n GROUP BY ALL HAVING count(*) > 1) GROUP BY 1),
    g AS (SELECT k, min(place) AS gap FROM (SELECT k, f, row_number() OVER (PARTITION BY k ORDER BY f) - 1 AS place FROM (SELECT DISTINCT k, f FROM n)) WHERE place < f GROUP BY 1)
    SELECT k AS user_id, CASE WHEN twice IS NOT NULL THEN 'duplicate' ELSE 'missing' END AS problem, coalesce(twice, gap) AS "at" FROM a LEFT JOIN tw USING (k) LEFT JOIN g USING (k) WHERE twice IS NOT NULL OR gap IS NOT NULL""",
)
def dense_sequence(spark, sf_dir):
    shifted = F.when((F.col("event_type") == "error") & (F.col("value") > 60), 1).otherwise(0)
    rows = events(spark, sf_dir).withColumn("f", (F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1 + shifted).cast("bigint"))
    return contracts.dense_sequence(rows, ["user_id"], "f", "event_id")


_FACE_RULES = {
    "no_face_disagrees": "(face_status = 'no_face') <> (frame_reason = 'no_face')", "claims_a_score": "frame_reason IN ('scored', 'imputed_tail') AND s IS NULL", "hides_a_score": "s IS NOT NULL AND frame_reason NOT IN ('scored', 'imputed_tail')",
    "imputed_disagrees": "imputed <> (frame_reason = 'imputed_tail')", "active_without_face": "track_id IS NULL AND active", "unscored_with_score": "track_id IS NOT NULL AND face_status = 'tracked_unscored' AND s IS NOT NULL",
    "unscored_and_active": "track_id IS NOT NULL AND face_status = 'tracked_unscored' AND (imputed OR active)", "score_not_finite": "track_id IS NOT NULL AND face_status <> 'tracked_unscored' AND s IS NULL",
    "box_inverted": "track_id IS NOT NULL AND x1 > x2",
}


@register(
    "face_frame_contract",
    f"""WITH {EVENTS_SQL}, {FACES_SQL}, f AS (SELECT video_id || ':' || timestamp::BIGINT AS id, track_id, face_status, frame_reason, CASE WHEN score < 2 THEN score END AS s, frame_reason = 'imputed_tail' OR score > 1.5 AS imputed, is_active_speaker OR score < 0.01 AS active, score * 10 AS x1, 12.0 AS x2 FROM fa) """
    + rules_sql("f", "id", _FACE_RULES),
)
def face_frame_contract(spark, sf_dir):
    s = F.col("score")
    rows = faces(events(spark, sf_dir)).withColumns(
        {"id": F.concat_ws(":", "video_id", F.bround("timestamp").cast("bigint")), "talknet_score": F.when(s < 2, s), "talknet_score_raw": F.lit(None).cast("double"), "score_imputed": F.col("score_imputed") | (s > 1.5),
         "is_active_speaker": F.col("is_active_speaker") | (s < 0.01), "x1": s * 10, "x2": F.lit(12.0), "y1": F.lit(0.0), "y2": F.lit(1.0)}
    )
    return quality.violations(rows, "id", contracts.face_frame_rules())


@register(
    "person_frames",
    f"""WITH {EVENTS_SQL}, p AS (SELECT video_id, event_id, floor(t / 3600)::BIGINT AS frame_number, user_id AS person_id, value, CASE WHEN event_type <> 'error' THEN value / 1000 END AS track_confidence FROM ev)
    SELECT video_id, event_id, frame_number, person_id, track_confidence, CASE WHEN track_confidence IS NULL THEN 'no_track_confidence' ELSE 'tracked' END AS confidence_reason, (value + 2 - value) * (value - 1) AS bbox_area, count(*) OVER (PARTITION BY video_id, frame_number) AS persons_in_frame FROM p""",
)
def person_frames(spark, sf_dir):
    rows = person_rows(spark, sf_dir)
    found = canonical.person_frames(rows, VIDEO)
    return found.select("video_id", "event_id", "frame_number", "person_id", "track_confidence", "confidence_reason", "bbox_area", "persons_in_frame")


def person_rows(spark, sf_dir):
    v = F.col("value")
    return events(spark, sf_dir).select(
        "video_id", "event_id", "t", F.floor(F.col("t") / 3600).alias("frame_number"), F.col("user_id").alias("person_id"), v.alias("x1"), (v + 2).alias("x2"), F.lit(1.0).alias("y1"), v.alias("y2"), (v / 400).alias("confidence"),
        F.when(F.col("event_type") != "error", v / 1000).alias("track_confidence"), F.lit(None).cast("string").alias("confidence_reason"),
    )


@register(
    "person_frame_contract",
    f"""WITH {EVENTS_SQL}, p AS (SELECT event_id, value / 400 AS c, value FROM ev) """ + rules_sql("p", "event_id", {"confidence_range": "c > 1", "box_inverted": "value < 1"}),
)
def person_frame_contract(spark, sf_dir):
    return quality.violations(canonical.person_frames(person_rows(spark, sf_dir), VIDEO), "event_id", contracts.person_frame_rules())


@register(
    "person_counts",
    f"""WITH {EVENTS_SQL}, p AS (SELECT video_id, floor(t / 3600)::BIGINT AS frame_number, count(*) AS held, min(CASE WHEN value > 100 THEN 1 ELSE 2 END)::BIGINT AS lo, max(CASE WHEN value > 100 THEN 1 ELSE 2 END)::BIGINT AS hi FROM ev GROUP BY ALL)
    SELECT video_id, frame_number, CASE WHEN lo < hi THEN 'declares_several' ELSE 'declares_another' END AS rule, lo AS declared, held FROM p WHERE lo < hi OR lo <> held""",
)
def person_counts(spark, sf_dir):
    rows = person_rows(spark, sf_dir).withColumn("persons_in_frame", F.when(F.col("x1") > 100, 1).otherwise(2).cast("bigint"))
    return contracts.person_counts(rows, VIDEO)


@register(
    "person_track_check",
    f"""WITH {EVENTS_SQL}, m AS (SELECT video_id, count(*) AS measured FROM ev GROUP BY 1), p AS (SELECT video_id, user_id AS person_id, count(*) AS n, count(*) FILTER (event_type <> 'error') AS own FROM ev GROUP BY ALL),
    g AS (SELECT video_id, user_id AS person_id, max(t) AS b, min(t) AS a, max(t) FILTER (event_type <> 'error') AS b2, min(t) FILTER (event_type <> 'error') AS a2 FROM ev GROUP BY ALL)
    SELECT video_id, person_id, 'frame_count' AS rule FROM p WHERE n <> own AND own > 0 UNION ALL SELECT video_id, person_id, 'no_frames' FROM p WHERE own = 0 UNION ALL SELECT video_id, person_id, 'first_timestamp' FROM g WHERE abs(a - a2) > 1e-6
    UNION ALL SELECT video_id, person_id, 'last_timestamp' FROM g WHERE abs(b - b2) > 1e-6 UNION ALL SELECT video_id, person_id, 'coverage' FROM p JOIN m USING (video_id) WHERE own > 0 AND abs(round(n / measured, 6) - own / measured) > 1e-3
    UNION ALL SELECT video_id, person_id, 'longest_gap' FROM (SELECT video_id, user_id AS person_id, max(gap) AS gap FROM (SELECT *, t - lag(t) OVER (PARTITION BY video_id, user_id ORDER BY t) AS gap FROM ev) GROUP BY ALL)
      JOIN (SELECT video_id, user_id AS person_id, coalesce(max(gap), 0.0) AS gap2 FROM (SELECT *, t - lag(t) OVER (PARTITION BY video_id, user_id ORDER BY t) AS gap FROM ev WHERE event_type <> 'error') GROUP BY ALL) USING (video_id, person_id) WHERE abs(coalesce(gap, 0.0) - gap2) > 1e-3""",
)
def person_track_check(spark, sf_dir):
    from chronoloom.operators import tracks

    ev = events(spark, sf_dir)
    measured = ev.groupBy("video_id").agg(F.count("*").alias("frames_measured"))
    seen = lambda rows: rows.select("video_id", F.col("user_id").alias("person_id"), "t", F.col("value").alias("confidence"))
    # The summaries count sightings that the table of frames has lost.
    return contracts.person_track_problems(tracks.person_tracks(seen(ev), VIDEO, measured), seen(ev.where("event_type <> 'error'")), VIDEO, measured)


FUSED_SQL = f"""{EVENTS_SQL}, {spans_sql("turns", "click")}, fr AS (SELECT video_id, t, CASE WHEN event_type <> 'signup' THEN user_id END AS track_id, event_type NOT IN ('signup', 'error') AND value > 40 AS active FROM ev),
    bt AS (SELECT u.video_id, u.turn_id, f.track_id, count(*) AS n, count(*) FILTER (f.active AND f.track_id IS NOT NULL) AS active FROM turns u JOIN fr f ON f.video_id = u.video_id AND f.t BETWEEN u.start AND u."end" GROUP BY ALL)"""


@register(
    "fusion_gaps",
    f"""WITH {FUSED_SQL}, s AS (SELECT video_id, turn_id, sum(n) AS frames, sum(CASE WHEN track_id IS NOT NULL THEN n ELSE 0 END) AS face, count(track_id) AS tracks, max(active) AS best FROM bt GROUP BY ALL)
    SELECT u.video_id, u.turn_id, CASE WHEN frames IS NULL THEN 'the active-speaker frame table covers no frame in this turn''s window, so nothing was measured here (absence of measurement, not a sighting of an empty scene)'
      WHEN face = 0 THEN 'no face was located in any of the ' || frames || ' ASD frames in this turn (voice with nothing visible: off-screen narrator or audio bed)'
      ELSE 'faces visible on ' || face || '/' || frames || ' measured frames across ' || tracks || ' track(s), but no track was ever flagged an active speaker (silent mouth or cutaway face)' END AS agreement_detail
    FROM turns u LEFT JOIN s USING (video_id, turn_id) WHERE coalesce(best, 0) = 0""",
)
def fusion_gaps(spark, sf_dir):
    ev = events(spark, sf_dir)
    rows = fusion.fuse(spans(ev, "click"), face_frames(ev), VIDEO, "turn_id")
    return rows.where("face_track_id is null").select("video_id", "turn_id", "agreement_detail")


@register("fusion_contract", f"WITH {FUSED_SQL} SELECT 'unknown_agreement' AS rule, turn_id::VARCHAR AS key FROM turns WHERE speaker % 5 = 0")
def fusion_contract(spark, sf_dir):
    ev = events(spark, sf_dir)
    rows = fusion.fuse(spans(ev, "click"), face_frames(ev), VIDEO, "turn_id")
    # A speaker number that five divides stands for a writer with another vocabulary.
    said = F.when(F.col("speaker") % 5 == 0, F.concat(F.lit("my "), "agreement")).otherwise(F.col("agreement"))
    return quality.violations(rows.withColumn("agreement", said).withColumn("face_track_id", F.when(F.col("speaker") % 5 != 0, F.col("face_track_id"))).where("agreement like 'my %' or face_active_frames >= 0"), "turn_id", contracts.fusion_rules() | {"frames_disagree": F.lit(False), "match_without_winner": F.col("agreement").isin("face_matched", "face_partial") & F.col("face_track_id").isNull()})


@register(
    "translation_check",
    """WITH a AS (SELECT conv_id, turn AS id, text FROM conversations WHERE role = 'user'), b AS (SELECT conv_id, CASE WHEN role = 'user' THEN turn ELSE turn - 1 END AS id, CASE WHEN length(text) > 200 THEN text ELSE ' ' END AS text FROM conversations WHERE length(text) > 100),
    c AS (SELECT conv_id, id, count(*) AS n, bool_or(length(trim(text)) = 0) AS empty FROM b GROUP BY ALL), j AS (SELECT coalesce(a.conv_id, c.conv_id) AS conv_id, coalesce(a.id, c.id) AS id, CASE WHEN n IS NULL THEN 'missing' WHEN a.id IS NULL THEN 'extra' WHEN n > 1 THEN 'repeated' WHEN empty THEN 'empty' END AS rule FROM a FULL JOIN c ON a.conv_id = c.conv_id AND a.id = c.id)
    SELECT * FROM j WHERE rule IS NOT NULL""",
)
def translation_check(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    asked = rows.where("role = 'user'").select("conv_id", F.col("turn").alias("id"))
    said = rows.where("length(text) > 100").select("conv_id", F.when(F.col("role") == "user", F.col("turn")).otherwise(F.col("turn") - 1).alias("id"), F.when(F.length("text") > 200, F.col("text")).otherwise(" ").alias("text"))
    return contracts.answers(asked, said, ["conv_id"], "id", "text")


@register(
    "translation_table_check",
    """SELECT conv_id, turn AS id, CASE WHEN length(text) < 40 THEN 'missing' ELSE 'source_changed' END AS rule FROM conversations WHERE length(text) < 40 OR text <> lower(text)""",
)
def translation_table_check(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("id"), "text")
    return contracts.table_of_answers(rows, rows.where("length(text) >= 40").withColumn("text", F.lower("text")), ["conv_id"], "id", "text")


@register(
    "story_table_check",
    """WITH s AS (SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN 's' || turn ELSE 's' || (turn // 4) END AS story_id, CASE WHEN turn > 0 THEN 's' || (turn + 1) END AS parent_id, turn::DOUBLE AS start, turn + CASE WHEN length(text) > 300 THEN 0.5 ELSE 1 END AS "end" FROM conversations),
    i AS (SELECT conv_id, story_id, count(*) AS n FROM s GROUP BY ALL)
    SELECT conv_id, story_id, 'repeated_id' AS rule FROM i WHERE n > 1 UNION ALL SELECT conv_id, story_id, 'unknown_parent' FROM s WHERE parent_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM i WHERE i.conv_id = s.conv_id AND i.story_id = s.parent_id)
    UNION ALL SELECT conv_id, story_id, 'unknown_end' FROM s WHERE "end" <> floor("end")""",
)
def story_table_check(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    turn = F.col("turn")
    ends = turn + F.when(F.length("text") > 300, 0.5).otherwise(1)
    stories = rows.select(
        "conv_id", F.concat(F.lit("s"), F.when(F.col("role") == "user", turn).otherwise(F.floor(turn / 4)).cast("string")).alias("story_id"), F.when(turn > 0, F.concat(F.lit("s"), (turn + 1).cast("string"))).alias("parent_id"),
        turn.cast("double").alias("start"), ends.cast("double").alias("end"),
    )
    segments = rows.select("conv_id", turn.cast("double").alias("start"), (turn + 1).cast("double").alias("end"))
    return contracts.story_table(stories, segments, ["conv_id"])


@register(
    "turn_contract",
    f"""WITH {EVENTS_SQL}, {spans_sql("u", "view")}, w AS (SELECT turn_id, video_id, CASE WHEN speaker % 7 <> 0 THEN speaker::VARCHAR ELSE '' END AS speaker, start, CASE WHEN "end" - start > 100 THEN "end" ELSE start END AS "end" FROM u)
    SELECT 'no_speaker' AS rule, turn_id::VARCHAR AS key FROM w WHERE speaker = '' UNION ALL SELECT 'no_length', turn_id::VARCHAR FROM w WHERE "end" <= start UNION ALL SELECT 'too_many_speakers', video_id::VARCHAR FROM w GROUP BY video_id HAVING count(DISTINCT speaker) > 7""",
)
def turn_contract(spark, sf_dir):
    rows = spans(events(spark, sf_dir), "view").withColumns({"speaker": F.when(F.col("speaker") % 7 != 0, F.col("speaker").cast("string")).otherwise(""), "end": F.when(F.col("end") - F.col("start") > 100, F.col("end")).otherwise(F.col("start")), "overlap_s": F.lit(0.0)})
    return contracts.turn_problems(rows, VIDEO, 7)


@register(
    "overlapping_turns",
    f"""WITH {EVENTS_SQL}, {spans_sql("u", "purchase")}, k AS (SELECT *, 'turn' || printf('%06d', row_number() OVER (PARTITION BY video_id ORDER BY start, "end", speaker)) AS id FROM u WHERE "end" > start)
    SELECT a.video_id, a.id AS turn_id, a.speaker, round(greatest(a."end" - a.start, 0.0), 3) AS duration, 'overlapping' AS diarization_type, round(coalesce(sum(least(a."end", b."end") - greatest(a.start, b.start)) FILTER (b.id IS NOT NULL), 0.0), 3) AS overlap_s
    FROM k a LEFT JOIN k b ON a.video_id = b.video_id AND a.speaker <> b.speaker AND b.start <= a."end" AND b."end" >= a.start GROUP BY a.video_id, a.id, a.speaker, a.start, a."end" """,
)
def overlapping_turns(spark, sf_dir):
    rows = canonical.overlapping_turns(spans(events(spark, sf_dir), "purchase").drop("turn_id"), VIDEO)
    return rows.select("video_id", "turn_id", "speaker", F.round("duration", 3).alias("duration"), "diarization_type", F.round("overlap_s", 3).alias("overlap_s"))


@register("speaker_cap", f"""WITH {EVENTS_SQL} SELECT video_id, user_id % 8 AS speaker, count(*) AS dropped FROM ev WHERE user_id % 8 >= 4 GROUP BY ALL""")
def speaker_cap(spark, sf_dir):
    return canonical.cap_speakers(events(spark, sf_dir).select("video_id", (F.col("user_id") % 8).alias("speaker")), VIDEO, 4)[1]


@register(
    "canonical_segments",
    r"""SELECT event_id, CASE WHEN json_extract_string(props, '$.k')::BIGINT < 50 THEN 'seg' || printf('%06d', json_extract_string(props, '$.k')::BIGINT + 1) ELSE 'seg' || printf('%06d', event_id + 1) END AS segment_id, round(greatest(value - 5, 0.0), 6) AS duration, 'x' AS text, CASE WHEN value > 50 THEN value ELSE -value END AS confidence FROM events""",
)
def canonical_segments(spark, sf_dir):
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    raw = F.when(k < 50, F.expr("variant_get(parse_json(props), '$.k', 'variant')"))
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_id").alias("segment_index"), raw.alias("raw_id"), F.lit(5.0).alias("start"), F.col("value").alias("end"), F.lit(" x ").alias("text"), F.when(F.col("value") > 50, F.col("value")).alias("confidence"), (-F.col("value")).alias("avg_logprob"))
    return canonical.segments(rows).select("event_id", "segment_id", "duration", "text", "confidence")


@register(
    "body_points",
    f"""WITH n AS (SELECT vec_id, unnest(range(0, 21)) AS k, embedding FROM embeddings), p AS (SELECT vec_id, k, embedding[3 * k + 1]::DOUBLE AS x, embedding[3 * k + 2]::DOUBLE AS y, embedding[3 * k + 3]::DOUBLE AS c FROM n)
    SELECT vec_id, k AS keypoint_id, ({canonical.BODY_25})[k + 1] AS keypoint_name, x, y, c AS confidence FROM p WHERE c > 0""",
)
def body_points(spark, sf_dir):
    people = table(spark, sf_dir, "embeddings").select("vec_id", F.lit(0).alias("detection_index"), F.col("embedding").cast("array<double>").alias("pose"))
    return canonical.body_rows(people, ["vec_id"]).select("vec_id", F.col("keypoint_id").cast("bigint").alias("keypoint_id"), "keypoint_name", "x", "y", "confidence")


@register(
    "frame_document",
    f"""WITH {EVENTS_SQL}, v AS (SELECT video_id, user_id AS track_id, floor((t - 1704067200) / 3600)::BIGINT AS frame, max(value) AS x, max(CASE WHEN event_type <> 'error' THEN value / 100 END) AS s FROM ev GROUP BY ALL),
    c AS (SELECT video_id, frame, arg_max(track_id, s) AS track_id FROM v WHERE s > 0.9 GROUP BY ALL), g AS (SELECT DISTINCT video_id, unnest(range(0, 720)) AS frame FROM ev), l AS (SELECT video_id, frame, min(track_id) AS lowest FROM v GROUP BY ALL),
    j AS (SELECT g.video_id, g.frame, c.track_id AS chosen, lowest, coalesce(c.track_id, lowest) AS track_id FROM g LEFT JOIN c USING (video_id, frame) LEFT JOIN l USING (video_id, frame))
    SELECT j.video_id, j.frame, round(j.frame / 25.0, 6) AS timestamp, j.track_id, CASE WHEN chosen IS NOT NULL THEN 'tracked' WHEN lowest IS NOT NULL THEN 'tracked_unscored' ELSE 'no_face' END AS face_status, round(x, 3) AS x1, round(s, 4) AS talknet_score, coalesce(chosen IS NOT NULL AND s >= 1.0, false) AS is_active_speaker
    FROM j LEFT JOIN v ON v.video_id = j.video_id AND v.frame = j.frame AND v.track_id = j.track_id""",
)
def frame_document(spark, sf_dir):
    ev = events(spark, sf_dir)
    score = F.max(F.when(F.col("event_type") != "error", F.col("value") / 100)).alias("smoothed")
    seen = ev.groupBy("video_id", F.col("user_id").alias("track_id"), F.floor((F.col("t") - 1704067200) / 3600).alias("frame")).agg(F.max("value").alias("x1"), score, F.min("event_id").alias("first_seen"))
    seen = seen.withColumns({"y1": F.col("x1"), "x2": F.col("x1"), "y2": F.col("x1"), "raw": F.col("smoothed"), "imputed": F.lit(False), "reason": F.lit("scored")})
    # Of equal scores SQL's arg_max keeps the one that it meets first: in the order of events, the track seen first in the frame.
    best = F.max_by("track_id", F.struct("smoothed", -F.col("first_seen")))
    chosen = seen.where("smoothed > 0.9").groupBy("video_id", "frame").agg(best.alias("track_id"))
    grid = canonical.uniform_grid(ev.select("video_id").distinct().withColumn("n", F.lit(720)), VIDEO, "n").select("video_id", "frame")
    return canonical.frame_document(grid, chosen, seen, VIDEO, 1.0).select("video_id", "frame", "timestamp", "track_id", "face_status", "x1", "talknet_score", "is_active_speaker")


@register(
    "scene_frames",
    """WITH s AS (SELECT user_id, event_id, floor(value)::BIGINT - 1 AS a, floor(value)::BIGINT + 5 AS b FROM events), f AS (SELECT user_id, event_id, unnest(range(greatest(a, 0), b)) AS frame FROM s WHERE b > 0) SELECT user_id, frame, arg_max(event_id, event_id) AS scene FROM f GROUP BY ALL""",
)
def scene_frames(spark, sf_dir):
    at = F.floor("value")
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("scene"), (at - 1).alias("first_frame"), (at + 5).alias("end_frame"))
    return canonical.scenes_of_frames(rows.withColumn("place", F.col("scene")), ["user_id"], "place")


@register("even_sample", f"""WITH {EVENTS_SQL}, n AS (SELECT video_id, event_id, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY video_id) AS n FROM ev WINDOW w AS (PARTITION BY video_id ORDER BY event_id)) SELECT video_id, event_id FROM n WHERE n <= 12 OR i IN (SELECT unnest([round_even(k * (n - 1) / 11, 0)::BIGINT for k in range(0, 12)]))""")
def even_sample(spark, sf_dir):
    return canonical.evenly_spaced(events(spark, sf_dir).select("video_id", "event_id"), VIDEO, "event_id", 12)


@register("manifest_rows", """WITH v AS (SELECT user_id, array_agg(DISTINCT event_type) AS have FROM events GROUP BY 1), c AS (SELECT ['click', 'error', 'pose', 'purchase', 'signup', 'view'] AS names) SELECT user_id AS video_id, array_to_string(list_filter(names, lambda x: list_contains(have, x)), ',') AS artifacts, array_to_string(list_filter(names, lambda x: NOT list_contains(have, x)), ',') AS not_generated FROM v, c""")
def manifest_rows(spark, sf_dir):
    files = table(spark, sf_dir, "events").select(F.col("user_id").alias("video_id"), F.col("event_type").alias("artifact"))
    rows = canonical.manifest_rows(files.select("video_id").distinct(), ["click", "error", "pose", "purchase", "signup", "view"], files, VIDEO)
    return rows.select("video_id", F.array_join("artifacts", ",").alias("artifacts"), F.array_join("not_generated", ",").alias("not_generated"))


@register("first_language", """SELECT source, arg_min(lang, doc_id) FILTER (n_chars > 500) AS lang FROM documents GROUP BY 1""")
def first_language(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("source", "doc_id", F.when(F.col("n_chars") > 500, F.col("lang")).alias("lang"))
    return canonical.first_language(rows, ["source"], "doc_id", "lang")


@register(
    "language_grades",
    """WITH g AS (SELECT doc_id, lang, n_chars / 20.0 AS s, CASE WHEN n_chars > 300 THEN least(n_chars / 3000.0, 1.0) END AS p, CASE WHEN source = 'web' THEN 'xx' END AS e FROM documents),
    r AS (SELECT *, CASE WHEN e IS NULL AND s < 30 THEN 'audio is ' || printf('%.1f', s) || 's, below the 30s detection window' END AS r1, CASE WHEN e IS NULL AND p IS NULL THEN 'detection probability unavailable' WHEN e IS NULL AND p < 0.5 THEN 'detection probability ' || printf('%.2f', p) END AS r2 FROM g)
    SELECT doc_id, CASE WHEN e IS NOT NULL THEN 'configured' WHEN r1 IS NOT NULL OR r2 IS NOT NULL THEN 'low' ELSE 'ok' END AS status, (r1 IS NOT NULL)::INT + (r2 IS NOT NULL)::INT AS reasons, CASE WHEN e IS NOT NULL OR (r1 IS NULL AND r2 IS NULL) THEN lang END AS trusted FROM r""",
)
def language_grades(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    seconds, sure = F.col("n_chars") / 20.0, F.when(F.col("n_chars") > 300, F.least(F.col("n_chars") / 3000.0, F.lit(1.0)))
    graded = rows.withColumn("g", answers.language_grade(seconds, sure, F.when(F.col("source") == "web", "xx")))
    return graded.select("doc_id", "g.status", F.size("g.reasons").alias("reasons"), answers.trusted_language(F.col("lang"), F.col("g.status")).alias("trusted"))


@register(
    "model_resolution",
    """SELECT doc_id, CASE lang WHEN 'en' THEN 'en_large' WHEN 'fr' THEN 'fr_small' WHEN 'es' THEN 'es_base' ELSE 'blank' END AS model, CASE lang WHEN 'en' THEN 'configured' WHEN 'fr' THEN 'substituted_family' WHEN 'de' THEN 'fallback_missing_model' WHEN 'es' THEN 'discovered' ELSE 'fallback_no_model' END AS status FROM documents""",
)
def model_resolution(spark, sf_dir):
    configured = spark.createDataFrame([("en", "en_large"), ("fr", "fr_large"), ("de", "de_large")], "language string, model string")
    installed = spark.createDataFrame([("en_large",), ("fr_small",), ("fr_tiny",), ("es_base",)], "model string")
    return answers.resolve_models(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", configured, installed).select("doc_id", "model", "status")


@register("answer_parsing", """SELECT conv_id, turn::VARCHAR AS id, CASE WHEN length(text) > 0 THEN 'en: ' || role END AS text FROM conversations""")
def answer_parsing(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    # Answers as models write them: in a fence, within words, nested or plain.
    own = F.when(F.col("role") == "user", F.to_json(F.create_map(F.col("turn").cast("string"), F.concat(F.lit("en: "), "role")))).otherwise(F.to_json(F.create_map(F.col("turn").cast("string"), F.struct(F.concat(F.lit("en: "), "role").alias("text")))))
    said = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("```json\n"), own, F.lit("\n```"))).otherwise(F.concat(F.lit("Here: "), own, F.lit(" as asked.")))
    return answers.translations(rows.withColumn("answer", said), ["conv_id"], "answer").drop("problem")


@register(
    "table_statistics",
    f"""WITH {EVENTS_SQL}, {FACES_SQL} SELECT video_id, count(*) AS frames, count(track_id) AS with_face, count(*) FILTER (is_active_speaker) AS active, count(DISTINCT track_id) AS tracks, count(DISTINCT floor(timestamp / 86400)) AS scenes FROM fa GROUP BY 1""",
)
def table_statistics(spark, sf_dir):
    return summaries.frame_statistics(faces(events(spark, sf_dir)).withColumn("scene_id", F.floor(F.col("timestamp") / 86400)), VIDEO)


@register("state_tally", f"""WITH {EVENTS_SQL}, {FACES_SQL} SELECT video_id, 'face_status' AS "column", face_status AS state, count(*) AS rows FROM fa GROUP BY ALL UNION ALL SELECT video_id, 'frame_reason', frame_reason, count(*) FROM fa GROUP BY ALL""")
def state_tally(spark, sf_dir):
    return summaries.tally(faces(events(spark, sf_dir)), VIDEO, ["face_status", "frame_reason"])


@register(
    "person_statistics",
    f"""WITH {EVENTS_SQL}, f AS (SELECT video_id, floor(t / 3600) AS frame, count(*) AS n, count(*) FILTER (value < 1) AS u FROM ev GROUP BY ALL), p AS (SELECT video_id, count(DISTINCT user_id) AS persons FROM ev GROUP BY 1)
    SELECT video_id, sum(n)::BIGINT AS rows, count(*) AS frames_with_person, max(n) AS max_persons_in_frame, sum(u)::BIGINT AS rows_without_timestamp, persons FROM f JOIN p USING (video_id) GROUP BY video_id, persons""",
)
def person_statistics(spark, sf_dir):
    ev = events(spark, sf_dir)
    seen = ev.select("video_id", F.floor(F.col("t") / 3600).alias("frame_number"), F.col("user_id").alias("person_id"), F.when(F.col("value") >= 1, F.col("t")).alias("timestamp"))
    return summaries.person_statistics(seen, VIDEO)


@register(
    "engine_comparison",
    f"""WITH {EVENTS_SQL}, {spans_sql("a", "view")}, {spans_sql("b", "click")}, u AS (SELECT 'pyannote' AS engine, * FROM a UNION ALL SELECT 'nemotron', * FROM b),
    o AS (SELECT x.engine, x.video_id, x.turn_id, x.speaker, coalesce(sum(least(x."end", y."end") - greatest(x.start, y.start)) FILTER (y.turn_id IS NOT NULL), 0.0) AS o FROM u x LEFT JOIN u y ON x.engine = y.engine AND x.video_id = y.video_id AND x.speaker <> y.speaker AND y.start < x."end" AND y."end" > x.start GROUP BY ALL)
    SELECT video_id, engine, count(*) AS turns, count(DISTINCT speaker) AS speakers, count(*) FILTER (round(o, 6) > 0) AS overlapping FROM o GROUP BY ALL""",
)
def engine_comparison(spark, sf_dir):
    ev = events(spark, sf_dir)
    both = summaries.by_engine({"pyannote": spans(ev, "view"), "nemotron": spans(ev, "click")})
    seconds = intervals.other_speaker_overlap(both, [*VIDEO, "engine"], "turn_id")
    return summaries.overlap_statistics(seconds, VIDEO)


@register(
    "assignment_statistics",
    f"""WITH {EVENTS_SQL}, {spans_sql("u", "view")}, s AS (SELECT video_id, event_id, t, CASE WHEN EXISTS (SELECT 1 FROM u WHERE u.video_id = ev.video_id AND u.start <= t + 1e-9 AND u."end" >= t - 1e-9) THEN 1 END AS hit FROM ev WHERE event_type = 'purchase')
    SELECT video_id, count(*) AS rows, count(*) - count(hit) AS unassigned, round(count(hit) / count(*), 4) AS assignment_rate FROM s GROUP BY 1""",
)
def assignment_statistics(spark, sf_dir):
    ev = events(spark, sf_dir)
    points = ev.where("event_type = 'purchase'").select("video_id", F.col("event_id").alias("segment_id"), F.col("t").alias("start"), F.lit(None).cast("double").alias("end"))
    return summaries.assignment_statistics(intervals.assign_speakers(points, spans(ev, "view"), VIDEO, "segment_id"), VIDEO).drop("speakers")


@register(
    "batch_report",
    """WITH v AS (SELECT o_orderkey AS video_id, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'failed' ELSE 'partial' END AS status, o_totalprice AS seconds FROM orders)
    SELECT count(*) AS videos, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'partial') AS partial, count(*) FILTER (status = 'failed') AS failed, round(sum(seconds), 1) AS seconds FROM v""",
)
def batch_report(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "failed").otherwise("partial")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("video_id"), status.alias("status"), F.col("o_totalprice").cast("double").alias("seconds"))
    return summaries.batch_summary(rows).withColumn("seconds", F.round("seconds", 1))


@register("evidence_lists", """WITH p AS (SELECT o_custkey AS k, o_orderkey AS v, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) SELECT k, count(*) AS problems, array_to_string(list(v ORDER BY v) FILTER (n <= 5), ',') AS shown FROM p GROUP BY 1""")
def evidence_lists(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"))
    return summaries.evidence(rows, ["k"], "v", 5).withColumn("shown", F.array_join(F.transform("shown", lambda x: x.cast("string")), ","))
