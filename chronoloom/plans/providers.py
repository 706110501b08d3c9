"""Queries over engines, answer providers, footers and whole-table contracts, each with its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.operators import acoustic, answers, consumers, contracts, engines, fusion, observed, quality, stories, tiers
from chronoloom.plans.export import EXPORT_SQL, SPEECH_SQL, TIER_ROWS_SQL, speech_tables
from chronoloom.plans.registry import register
from chronoloom.plans.timeline import FRAMES_SQL, face_frames
from chronoloom.sources.packed import footer_counts as footers
from chronoloom.sources.tables import EVENTS_SQL, events, spans, spans_sql, table

VIDEO = ["video_id"]

FUSED_ENGINES_SQL = f"""{spans_sql("ta", "click")}, {spans_sql("tb", "purchase")}, {FRAMES_SQL},
    tu AS (SELECT 'pyannote' AS engine, *, NULL::DOUBLE AS overlap_s FROM ta UNION ALL SELECT 'nemotron', *, ("end" - start) / 2 FROM tb),
    bt AS (SELECT u.video_id, u.engine, u.turn_id, f.track_id, count(*) AS n, count(*) FILTER (f.active AND f.track_id IS NOT NULL) AS active, avg(f.score) AS mean
      FROM tu u JOIN frames f ON f.video_id = u.video_id AND f.t BETWEEN u.start AND u."end" GROUP BY ALL),
    mk AS (SELECT *, track_id IS NOT NULL AND active > 0 AS candidate, active >= 2 AND active / n >= 0.5 AS qualified, sum(n) OVER p AS frames_in_turn, sum(CASE WHEN track_id IS NOT NULL THEN n ELSE 0 END) OVER p AS face_frames FROM bt WINDOW p AS (PARTITION BY video_id, engine, turn_id)),
    be AS (SELECT *, row_number() OVER (PARTITION BY video_id, engine, turn_id ORDER BY candidate DESC, qualified DESC, active DESC, round(coalesce(mean, 0), 6) DESC, track_id ASC NULLS LAST) AS rank,
      list(track_id) OVER (PARTITION BY video_id, engine, turn_id, candidate, qualified, active) AS alike FROM mk)"""


def turn_tables(ev: DataFrame) -> dict[str, DataFrame]:
    second = spans(ev, "purchase")
    return {"speaker_turns": spans(ev, "click"), "speaker_turns_nemotron": second.withColumn("overlap_s", (F.col("end") - F.col("start")) / 2)}


@register(
    "engine_fusion",
    f"""WITH {EVENTS_SQL}, {FUSED_ENGINES_SQL} SELECT u.video_id, u.engine, u.turn_id, u.speaker, coalesce(frames_in_turn, 0)::BIGINT AS frames_in_turn, CASE WHEN candidate THEN track_id END AS face_track_id, CASE WHEN candidate THEN active ELSE 0 END AS face_active_frames,
      CASE WHEN frames_in_turn IS NULL THEN 'no_frames_measured' WHEN face_frames = 0 THEN 'no_face_visible' WHEN NOT candidate THEN 'face_never_active' WHEN qualified THEN 'face_matched' ELSE 'face_partial' END AS agreement, round(u.overlap_s, 6) AS overlap_s
    FROM tu u LEFT JOIN be b ON b.video_id = u.video_id AND b.engine = u.engine AND b.turn_id = u.turn_id AND b.rank = 1""",
)
def engine_fusion(spark, sf_dir):
    ev = events(spark, sf_dir)
    fused = engines.fuse_engines(engines.engine_turns(turn_tables(ev), VIDEO), face_frames(ev), VIDEO)
    return fused.select("video_id", "engine", "turn_id", "speaker", "frames_in_turn", "face_track_id", "face_active_frames", "agreement", F.round("overlap_s", 6).alias("overlap_s"))


@register(
    "fusion_details",
    f"""WITH {EVENTS_SQL}, {FUSED_ENGINES_SQL}, w AS (SELECT *, printf('%.2f', active / n + 1e-9) AS ratio, coalesce(printf('%.2f', mean + 1e-9), 'n/a') AS shown, frames_in_turn - face_frames AS hidden, list_sort(alike) AS tied FROM be WHERE rank = 1 AND candidate),
    t AS (SELECT *, CASE WHEN len(tied) > 1 THEN 'tie between tracks ' || array_to_string(tied, ', ') || ' resolved to ' || track_id || ' by mean score, then track id; ' ELSE '' END || 'track ' || track_id || ' active on ' || active || '/' || n || ' frames in turn (ratio ' || ratio AS head,
      CASE WHEN hidden > 0 THEN '; no face located on ' || hidden::BIGINT || '/' || frames_in_turn::BIGINT || ' measured frames of the window' ELSE '' END AS gap FROM w)
    SELECT video_id, engine, turn_id, CASE WHEN qualified THEN head || ' >= min_active_ratio 0.5, ' || active || ' >= min_face_frames 2), mean score ' || shown || gap
      ELSE head || ', mean score ' || shown || ') — ' || concat_ws('; ', CASE WHEN active < 2 THEN active || ' active frame(s) is below min_face_frames 2' END, CASE WHEN active / n < 0.5 THEN 'ratio ' || ratio || ' is below min_active_ratio 0.5' END) || gap END AS agreement_detail FROM t""",
)
def fusion_details(spark, sf_dir):
    """The wordings of turns with a face: matched, partial, ties, frames without a face."""
    ev = events(spark, sf_dir)
    # Scores shown with two decimals lie a billionth off a tie, where both engines round alike.
    frames = face_frames(ev).withColumn("score", F.col("score") + 1e-9)
    fused = engines.fuse_engines(engines.engine_turns(turn_tables(ev), VIDEO), frames, VIDEO)
    return fused.where("face_track_id is not null").select("video_id", "engine", "turn_id", "agreement_detail")


#: What a provider is asked: three turns of a dialogue at a time.
REQUESTS_SQL = "rq AS (SELECT conv_id, turn, role, text, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 3 AS request FROM conversations)"


def requests(spark, sf_dir, size: int = 3) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", F.floor(place / size).alias("request"))
    segment = F.struct(F.col("turn").alias("id"), "text", F.col("turn").cast("double").alias("start"), (F.col("turn") + 1).cast("double").alias("end"))
    return rows.groupBy("conv_id", "request").agg(F.sort_array(F.collect_list(segment)).alias("segments"))


@register(
    "translation_requests",
    f"""WITH {REQUESTS_SQL} SELECT conv_id, request, turn AS id, CASE WHEN length(trim(text)) > 0 THEN rtrim('[en] ' || text, ' ' || chr(10) || chr(9) || chr(13)) END AS english_text, CASE WHEN length(trim(text)) > 0 THEN NULL ELSE 'missing' END AS problem FROM rq""",
)
def translation_requests(spark, sf_dir):
    """Requests, a provider's answers, what they parse to, what is wrong with them, and the segments that they belong to."""
    asked = requests(spark, sf_dir)
    unit = ["conv_id", "request"]
    told = answers.translations(engines.ask(asked, "mock_translation"), unit, "answer").where("problem is null")
    segments = asked.select(*unit, F.explode("segments").alias("s")).select(*unit, F.col("s.id").cast("string").alias("id"))
    bad = contracts.answers(segments, told.select(*unit, "id", "text"), unit, "id", "text")
    rows = segments.join(told.select(*unit, "id", F.col("text").alias("english_text")), [*unit, "id"], "left").join(bad, [*unit, "id"], "left")
    return rows.select(*unit, F.col("id").cast("bigint").alias("id"), "english_text", F.col("rule").alias("problem"))


@register(
    "story_requests",
    f"""WITH {REQUESTS_SQL}, w AS (SELECT conv_id, request, count(*) AS n FROM rq GROUP BY ALL) SELECT conv_id, request AS "window", CASE WHEN n >= 2 THEN 'w' || request || '-s1' END AS story_id, CASE WHEN n >= 2 THEN 'accepted' ELSE 'none' END AS status, NULL::VARCHAR AS reason FROM w""",
)
def story_requests(spark, sf_dir):
    """Windows of a dialogue, a provider's stories about them, and which of those stand."""
    asked = requests(spark, sf_dir).withColumnRenamed("request", "window")
    told = engines.ask(asked, "mock_stories")
    parsed = F.from_json(answers.fenced_json(F.col("answer")).cast("string"), f"stories {stories.STORIES}, no_story_reason string")
    rows = told.select("conv_id", "window", parsed.alias("_a")).select("conv_id", "window", "_a.*")
    segments = asked.select("conv_id", "window", F.explode("segments").alias("s")).select("conv_id", "window", F.col("s.id").cast("string").alias("segment_id"), "s.start", "s.end")
    return stories.validate(rows, segments, ["conv_id"]).select("conv_id", "window", "story_id", "status", "reason")


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@register("footer_counts", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows FROM {t}" for t in TABLES))
def footer_counts(spark, sf_dir):
    counts = [footers(spark, f"{sf_dir}/{t}.parquet").agg(F.sum("rows").alias("rows")).select(F.lit(t).alias("name"), "rows") for t in TABLES]
    return reduce(DataFrame.unionByName, counts)


CLAIMED = ["words", "segments_src", "gloss_en", "turns_pyannote"]


@register(
    "table_claims",
    f"""WITH {EVENTS_SQL}, {SPEECH_SQL}, {TIER_ROWS_SQL}, {EXPORT_SQL}, c AS (SELECT tier, count(*) AS n FROM ex GROUP BY 1), d AS (SELECT min(start_ms) / 1000 AS a, max(end_ms) / 1000 AS b, count(*) AS n FROM ex)
    SELECT 'min_rows' AS rule, '1000000000' AS claimed, n::VARCHAR AS found FROM d
    UNION ALL SELECT 'census:' || tier, '0', n::VARCHAR FROM c WHERE tier IN ('{"', '".join(CLAIMED)}') UNION ALL SELECT 'coverage:words', 'False', 'True' FROM c WHERE tier = 'words'
    UNION ALL SELECT 'unclaimed', '0', sum(n)::BIGINT::VARCHAR FROM c WHERE tier NOT IN ('{"', '".join(CLAIMED)}')""",
)
def table_claims(spark, sf_dir):
    """The exported annotations against claims that do not hold, measured while the table is written."""
    rows = tiers.annotations(tiers.build(speech_tables(events(spark, sf_dir)), VIDEO), VIDEO)
    rows = rows.withColumns({"start": F.col("start_ms") / 1000, "end": F.col("end_ms") / 1000, "_before": F.lit(None).cast("double"), "_until": F.lit(None).cast("double")})
    measures = observed.table_measures("start", "end", tier="tier", tiers=CLAIMED)
    claims = {"min_rows": 10**9, "duration": 10.0**9, "whole": True, "apart": True, "census": dict.fromkeys(CLAIMED, 0), "covered": CLAIMED[1:]}
    return observed.checked(spark, rows, "annotations", measures, claims)[1]


@register(
    "fusion_table_check",
    f"""WITH {EVENTS_SQL}, {spans_sql("u", "click")}, r AS (SELECT turn_id::VARCHAR AS key, turn_id % 11 AS k FROM u)
    SELECT unnest(CASE k WHEN 0 THEN ['unknown_agreement', 'winner_without_match'] WHEN 1 THEN ['counts_not_nested'] WHEN 2 THEN ['winner_without_activity'] WHEN 3 THEN ['match_without_winner'] WHEN 4 THEN ['frames_disagree', 'winner_without_match']
      WHEN 5 THEN ['no_face_disagrees', 'winner_without_match'] WHEN 6 THEN ['unknown_engine'] WHEN 7 THEN ['other_engine'] WHEN 8 THEN ['no_detail'] WHEN 9 THEN ['ends_before_start'] ELSE ['missing_turn'] END) AS rule, key FROM r
    UNION ALL SELECT 'unknown_turn', (-1 - turn_id)::VARCHAR FROM u WHERE turn_id % 11 = 10""",
)
def fusion_table_check(spark, sf_dir):
    """Every rule of a fused table, each broken by the turns whose number leaves that remainder."""
    turns = spans(events(spark, sf_dir), "click")
    k = F.col("turn_id") % 11
    broken = lambda n, bad, good: F.when(k == n, bad).otherwise(good)
    state = F.when(k == 0, "odd").when(k == 4, "no_frames_measured").when(k == 5, "no_face_visible").otherwise("face_matched")
    rows = turns.select(
        "video_id", F.when(k == 10, -1 - F.col("turn_id")).otherwise(F.col("turn_id")).alias("turn_id"), "start", broken(9, F.col("start") - 1, F.col("end")).alias("end"), state.alias("agreement"), F.lit(5).alias("frames_in_turn"), broken(1, 6, 4).alias("face_frames_in_turn"),
        broken(2, 0, 3).alias("face_active_frames"), F.when(k != 3, 1).alias("face_track_id"), F.when(k == 6, "third").when(k == 7, "nemotron").otherwise("pyannote").alias("engine"), broken(8, "", "as measured").alias("agreement_detail"),
    )
    return contracts.fusion_problems(rows, turns, VIDEO, "pyannote")


@register(
    "pose_table_check",
    """WITH p AS (SELECT vec_id, vec_id % 10 AS k FROM embeddings) SELECT unnest(CASE k WHEN 0 THEN ['unknown_basis', 'normalized_without_basis', 'placed_without_basis'] WHEN 1 THEN ['unknown_status', 'status_disagrees'] WHEN 2 THEN ['status_disagrees', 'unusable_within_ok']
      WHEN 3 THEN ['status_disagrees'] WHEN 4 THEN ['coordinate_disagrees'] WHEN 5 THEN ['no_basis_detail'] WHEN 6 THEN ['unknown_point'] WHEN 7 THEN ['wrong_name'] WHEN 8 THEN ['normalized_without_basis', 'placed_without_basis'] ELSE [] END) AS rule, vec_id::VARCHAR AS key FROM p""",
)
def pose_table_check(spark, sf_dir):
    """Every rule of a table of normalised key points, each broken by the rows whose number leaves that remainder."""
    k = F.col("vec_id") % 10
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(k == 4, 0.0).otherwise(1.0).alias("x"), F.lit(1.0).alias("y"), F.when(k == 0, "odd").when(k == 8, "basis_degenerate").otherwise("basis_ok").alias("basis_state"),
        F.when(k == 1, "odd").when(k == 2, "basis_unusable").otherwise("normalized").alias("value_status"), F.when(k != 3, 0.5).alias("x_norm"), F.lit(0.5).alias("y_norm"), F.when(k != 5, "from two joints").alias("basis_detail"),
        F.when(k == 6, 25).otherwise(0).alias("keypoint_id"), F.when(k == 7, "Neck").otherwise("Nose").alias("keypoint_name"),
    )
    return quality.violations(rows, "vec_id", contracts.pose_rules(whole=True))


@register(
    "quiet_frames",
    f"""WITH {EVENTS_SQL} SELECT event_id, CASE WHEN event_type = 'signup' THEN event_type <> 'error' AND value < 60 ELSE value / 2 - 60 < -45 END AS quiet, CASE WHEN value * 60 > 0 AND value * 60 <= 5500 THEN value * 60 END AS f1_hz FROM ev""",
)
def quiet_frames(spark, sf_dir):
    """Frames by level, or by voice where no level was measured; formants up to a ceiling."""
    v, kind = F.col("value"), F.col("event_type")
    frames = events(spark, sf_dir).select("event_id", F.when(kind != "signup", v / 2 - 60).alias("intensity_db"), (v >= 60).alias("voiced"), (v * 60).alias("f1"))
    return frames.select("event_id", acoustic.frame_is_quiet(-45.0).alias("quiet"), acoustic.within_ceiling(F.col("f1"), 5500.0).alias("f1_hz"))


@register(
    "faces_of_turns",
    f"""WITH {EVENTS_SQL}, {FUSED_ENGINES_SQL}, tk AS (SELECT video_id, track_id, count(*) AS frame_count FROM frames WHERE track_id IS NOT NULL GROUP BY ALL)
    SELECT b.video_id, b.turn_id, b.track_id AS face_track_id, tk.frame_count FROM be b LEFT JOIN tk USING (video_id, track_id) WHERE rank = 1 AND candidate AND engine = 'pyannote'""",
)
def faces_of_turns(spark, sf_dir):
    ev = events(spark, sf_dir)
    seen = face_frames(ev)
    fused = fusion.fuse(spans(ev, "click"), seen, VIDEO, "turn_id").where("face_track_id is not null")
    summary = seen.where("track_id is not null").groupBy("video_id", "track_id").agg(F.count("*").alias("frame_count"))
    return consumers.faces_of_turns(fused, summary, VIDEO).select("video_id", "turn_id", "face_track_id", "frame_count")


@register(
    "transcript_check",
    """WITH s AS (SELECT o_custkey AS video_id, o_orderkey AS segment_id, o_totalprice AS start, o_totalprice + CASE WHEN o_orderkey % 7 = 0 THEN -1 ELSE 5 END AS "end" FROM orders),
    w AS (SELECT o_custkey AS video_id, o_orderkey AS word_id, o_orderkey - CASE WHEN o_orderkey % 5 = 0 THEN 1000000000 ELSE 0 END AS segment_id, CASE WHEN o_orderkey % 11 = 0 THEN -2.0 ELSE 1.0 END AS start FROM orders),
    o AS (SELECT segment_id, start, lag(start) OVER (PARTITION BY video_id ORDER BY segment_id) AS before FROM s)
    SELECT 'no_language' AS rule, c_custkey::VARCHAR AS key FROM customer WHERE c_custkey % 3 = 0
    UNION ALL SELECT 'segment_ends_before_start', segment_id::VARCHAR FROM s WHERE "end" < start UNION ALL SELECT 'segment_starts_past_duration', segment_id::VARCHAR FROM s JOIN customer ON c_custkey = video_id WHERE start > 300000 + 1
    UNION ALL SELECT 'word_starts_before_zero', word_id::VARCHAR FROM w WHERE start < 0 UNION ALL SELECT 'segment_out_of_order', segment_id::VARCHAR FROM o WHERE start < before
    UNION ALL SELECT 'unknown_segment', segment_id::VARCHAR FROM w WHERE segment_id < 0""",
)
def transcript_check(spark, sf_dir):
    """Orders as segments of their customers, each with one word; every rule is broken by some."""
    orders, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    start = F.col("o_totalprice").cast("double")
    segments = orders.select(F.col("o_custkey").alias("video_id"), k.alias("place"), k.alias("segment_id"), start.alias("start"), (start + F.when(k % 7 == 0, -1.0).otherwise(5.0)).alias("end"))
    words = orders.select(F.col("o_custkey").alias("video_id"), k.alias("word_id"), (k - F.when(k % 5 == 0, 1_000_000_000).otherwise(0)).alias("segment_id"), F.when(k % 11 == 0, -2.0).otherwise(1.0).alias("start"), F.lit(1.5).alias("end"))
    recordings = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("video_id"), F.when(F.col("c_custkey") % 3 == 0, " ").otherwise("en").alias("language"), F.lit(300_000.0).alias("duration"))
    return contracts.transcript_problems(recordings, segments, words, VIDEO)


@register(
    "sequence_breaks",
    f"""WITH {EVENTS_SQL}, n AS (SELECT user_id, event_id, CASE WHEN user_id % 5 = 0 AND value > 120 THEN NULL ELSE row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 + CASE WHEN event_type = 'error' AND value > 60 AND user_id % 2 = 0 THEN 100000 WHEN value > 150 THEN -1 ELSE 0 END END AS f FROM ev),
    a AS (SELECT user_id, count(*) AS n, count(*) - count(f) AS lost FROM n GROUP BY 1), d AS (SELECT user_id, f, count(*) AS c FROM n WHERE f IS NOT NULL GROUP BY ALL),
    tw AS (SELECT user_id, count(*) AS k, min(f) AS a, max(f) AS b FROM d WHERE c > 1 GROUP BY 1), free AS (SELECT user_id FROM a LEFT JOIN tw USING (user_id) WHERE lost = 0 AND k IS NULL),
    ex AS (SELECT user_id, unnest(range(0, n)) AS f FROM a JOIN free USING (user_id)), mi AS (SELECT user_id, count(*) AS k, min(ex.f) AS a, max(ex.f) AS b FROM ex ANTI JOIN d ON d.user_id = ex.user_id AND d.f = ex.f GROUP BY 1),
    ou AS (SELECT user_id, count(*) AS k, min(f) AS a, max(f) AS b FROM d JOIN free USING (user_id) JOIN a USING (user_id) WHERE f < 0 OR f >= n GROUP BY 1)
    SELECT user_id, 'null' AS problem, lost::BIGINT AS rows, NULL::BIGINT AS first, NULL::BIGINT AS last FROM a WHERE lost > 0 UNION ALL SELECT user_id, 'duplicate', k, a, b FROM tw JOIN a USING (user_id) WHERE lost = 0
    UNION ALL SELECT user_id, 'missing', k, a, b FROM mi UNION ALL SELECT user_id, 'out_of_range', k, a, b FROM ou""",
)
def sequence_breaks(spark, sf_dir):
    """Numbers of a user's events with some lost, shifted far away, or moved onto the one before."""
    own = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    user, v = F.col("user_id"), F.col("value")
    shift = F.when((F.col("event_type") == "error") & (v > 60) & (user % 2 == 0), 100_000).when(v > 150, -1).otherwise(0)
    rows = events(spark, sf_dir).withColumn("f", F.when((user % 5 == 0) & (v > 120), F.lit(None)).otherwise(own + shift).cast("bigint"))
    return contracts.sequence_breaks(rows, ["user_id"], "f", "event_id")
