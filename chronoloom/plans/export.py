"""Queries over annotation tiers and their export, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.operators import tiers, tracks
from chronoloom.plans.registry import register
from chronoloom.sources.tables import EVENTS_SQL, events, table

VIDEO = ["video_id"]
#: The clock of the recordings begins at the first second of the data.
ZERO = 1704067200

SPEECH_SQL = f"""sp AS (SELECT video_id, event_id, event_type, user_id, t - {ZERO} - 60 AS start, CASE WHEN value < 1 THEN NULL WHEN value > 300 THEN 'NaN'::DOUBLE ELSE t - {ZERO} - 60 + value END AS "end",
      CASE WHEN value >= 2 THEN user_id END AS speaker_id, 's' || (event_id // 2) AS segment_id FROM ev)"""


def speech(ev):
    """Events as spans: no end below a value of 1, an end that is no number above 300, no speaker below 2; the first minute lies before zero."""
    start = F.col("t") - ZERO - 60
    end = F.when(F.col("value") < 1, F.lit(None)).when(F.col("value") > 300, F.lit(float("nan"))).otherwise(start + F.col("value"))
    return ev.select("video_id", "event_id", "event_type", "user_id", start.alias("start"), end.alias("end"), F.when(F.col("value") >= 2, F.col("user_id")).alias("speaker_id"), F.concat(F.lit("s"), F.expr("event_id div 2").cast("string")).alias("segment_id"))


def speech_tables(ev):
    rows = speech(ev)
    of = lambda kind: rows.where(F.col("event_type") == kind)
    words = of("view").withColumns({"word": F.concat(F.lit("w"), F.col("user_id").cast("string")), "word_id": F.col("event_id").cast("string")})
    texts = of("click").withColumns({"text": F.concat(F.lit("said  by\n"), F.col("user_id").cast("string")), "english_text": F.lit("told")})
    turns = of("purchase").withColumns({"turn_id": F.col("event_id").cast("string"), "diarization_type": F.when(F.col("user_id") % 3 != 0, "inclusive")})
    verdict = of("error").withColumns(
        {"turn_id": F.col("event_id").cast("string"), "agreement": F.lit("face_partial"), "engine": F.lit("pyannote"), "face_track_id": F.when(F.col("user_id") % 2 == 0, F.col("user_id")), "agreement_detail": F.lit("as measured")}
    )
    return {"speech_words": words, "speech_segments": texts, "translation_segments": texts, "speaker_turns": turns, "speaker_fusion_pyannote": verdict}


TIER_ROWS_SQL = """tr AS (
    SELECT 'words' AS tier, video_id, event_id::VARCHAR AS row_id, start, "end", 'w' || user_id || ' · ' || coalesce(speaker_id::VARCHAR, 'unknown') || ' · ' || event_id || ' · [' || segment_id || ']' AS text FROM sp WHERE event_type = 'view'
    UNION ALL SELECT 'segments_src', video_id, segment_id, start, "end", coalesce(speaker_id::VARCHAR, 'unknown') || ': said by ' || user_id || ' · [' || segment_id || ']' FROM sp WHERE event_type = 'click'
    UNION ALL SELECT 'gloss_en', video_id, segment_id, start, "end", coalesce(speaker_id::VARCHAR, 'unknown') || ': told · [' || segment_id || ']' FROM sp WHERE event_type = 'click'
    UNION ALL SELECT 'turns_pyannote', video_id, event_id::VARCHAR, start, "end", 'speaker ' || coalesce(speaker_id::VARCHAR, 'unknown') || ' (pyannote, ' || CASE WHEN user_id % 3 <> 0 THEN 'inclusive' ELSE 'unknown' END || ') · ' || event_id FROM sp WHERE event_type = 'purchase'
    UNION ALL SELECT 'fusion_pyannote', video_id, event_id::VARCHAR, start, "end", 'face_partial: turn ' || event_id || ' · turn speaker ' || coalesce(speaker_id::VARCHAR, 'unknown') || ' (pyannote) | face track ' || CASE WHEN user_id % 2 = 0 THEN user_id::VARCHAR ELSE 'unknown' END || ' | as measured' FROM sp WHERE event_type = 'error'),
    pl AS (SELECT *, CASE WHEN "end" IS NULL THEN 'missing_time' WHEN isnan("end") THEN 'non_finite' WHEN start < -0.0005 OR "end" < -0.0005 THEN 'missing_time' END AS refused FROM tr),
    ms AS (SELECT *, CASE WHEN refused IS NULL THEN greatest(floor(start * 1000 + 0.5), 0)::BIGINT END AS start_ms, CASE WHEN refused IS NULL THEN greatest(CASE WHEN floor("end" * 1000 + 0.5) <= 0 THEN 1 ELSE floor("end" * 1000 + 0.5) END, greatest(floor(start * 1000 + 0.5), 0) + 1)::BIGINT END AS end_ms FROM pl)"""


@register("tiers_speech", f"""WITH {EVENTS_SQL}, {SPEECH_SQL}, {TIER_ROWS_SQL} SELECT tier, video_id, row_id, start_ms, end_ms, text, refused FROM ms""")
def tiers_speech(spark, sf_dir):
    rows = tiers.placed(tiers.build(speech_tables(events(spark, sf_dir)), VIDEO))
    return rows.select("tier", "video_id", "row_id", "start_ms", "end_ms", "text", "refused")


@register("tier_drops", f"""WITH {EVENTS_SQL}, {SPEECH_SQL}, {TIER_ROWS_SQL} SELECT tier, video_id, count(*) AS rows, count(*) FILTER (refused = 'missing_time') AS missing_time, count(*) FILTER (refused = 'non_finite') AS non_finite FROM ms GROUP BY ALL HAVING count(refused) > 0""")
def tier_drops(spark, sf_dir):
    return tiers.drop_counts(tiers.build(speech_tables(events(spark, sf_dir)), VIDEO), VIDEO)


EXPORT_SQL = """fl AS (SELECT tier, video_id, row_id, text, start_ms, end_ms, coalesce(start_ms < max(end_ms) OVER (PARTITION BY tier, video_id ORDER BY start_ms, end_ms, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS hit FROM ms WHERE refused IS NULL),
    an AS (SELECT tier, video_id, bool_or(hit) AS busy FROM fl GROUP BY ALL),
    po AS (SELECT DISTINCT tier, video_id, t FROM (SELECT tier, video_id, start_ms AS t FROM fl UNION ALL SELECT tier, video_id, end_ms FROM fl)),
    ce AS (SELECT tier, video_id, t AS a, lead(t) OVER (PARTITION BY tier, video_id ORDER BY t) AS b FROM po),
    xx AS (SELECT ce.tier, ce.video_id, a, b, list(text ORDER BY text, row_id) AS texts FROM ce JOIN fl ON fl.tier = ce.tier AND fl.video_id = ce.video_id AND fl.start_ms < b AND fl.end_ms > a JOIN an ON an.tier = ce.tier AND an.video_id = ce.video_id AND an.busy WHERE b IS NOT NULL GROUP BY ALL),
    ex AS (SELECT tier, video_id, a AS start_ms, b AS end_ms, CASE WHEN len(texts) = 1 THEN texts[1] ELSE '["' || array_to_string(texts, '","') || '"]' END AS value FROM xx
      UNION ALL SELECT fl.tier, fl.video_id, start_ms, end_ms, text FROM fl JOIN an ON an.tier = fl.tier AND an.video_id = fl.video_id AND NOT an.busy)"""


@register("tier_export", f"""WITH {EVENTS_SQL}, {SPEECH_SQL}, {TIER_ROWS_SQL}, {EXPORT_SQL} SELECT * FROM ex""")
def tier_export(spark, sf_dir):
    return tiers.annotations(tiers.build(speech_tables(events(spark, sf_dir)), VIDEO), VIDEO, 100_000.0)


@register("tier_census", f"""WITH {EVENTS_SQL}, {SPEECH_SQL}, {TIER_ROWS_SQL}, {EXPORT_SQL} SELECT tier, video_id, count(*) AS annotations FROM ex GROUP BY ALL""")
def tier_census(spark, sf_dir):
    return tiers.census(tiers.annotations(tiers.build(speech_tables(events(spark, sf_dir)), VIDEO), VIDEO, 100_000.0), VIDEO)


@register(
    "tier_check",
    f"""WITH {EVENTS_SQL}, {SPEECH_SQL}, {TIER_ROWS_SQL}, m AS (SELECT *, max(end_ms) OVER (PARTITION BY tier, video_id ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until FROM ms WHERE refused IS NULL)
    SELECT tier, video_id, 'overlap' AS rule, count(*) AS rows FROM m WHERE start_ms < until GROUP BY ALL UNION ALL SELECT tier, video_id, 'unclaimed_tier', count(*) FROM m WHERE tier = 'fusion_pyannote' GROUP BY ALL""",
)
def tier_check(spark, sf_dir):
    rows = tiers.placed(tiers.build(speech_tables(events(spark, sf_dir)), VIDEO)).where("refused is null")
    return tiers.check(rows, VIDEO, ["words", "segments_src", "gloss_en", "turns_pyannote"])


FACES_SQL = """fa AS (SELECT video_id, t AS timestamp, value > 40 AS is_active_speaker, CASE WHEN value < 3 THEN 'no_face' WHEN value < 6 THEN 'tracked_unscored' ELSE 'tracked' END AS face_status,
      CASE WHEN value < 3 THEN 'no_face' WHEN value < 6 THEN 'past_scored_tail' WHEN value > 100 THEN 'imputed_tail' ELSE 'scored' END AS frame_reason, CASE WHEN value >= 3 THEN user_id % 4 END AS track_id, value / 100 AS score FROM ev)"""


def faces(ev):
    v = F.col("value")
    return ev.select(
        "video_id", F.col("t").alias("timestamp"), (v > 40).alias("is_active_speaker"), F.when(v < 3, "no_face").when(v < 6, "tracked_unscored").otherwise("tracked").alias("face_status"),
        F.when(v < 3, "no_face").when(v < 6, "past_scored_tail").when(v > 100, "imputed_tail").otherwise("scored").alias("frame_reason"), F.when(v >= 3, F.col("user_id") % 4).alias("track_id"), (v > 100).alias("score_imputed"), (v / 100).alias("score"),
    )


def block_sql(name: str, source: str, label: str) -> str:
    """Runs of equal labels of a grid, each one median step longer than its last sample."""
    return f"""{name}_q AS (SELECT video_id, timestamp, {label} AS label, coalesce(lag({label}) OVER w IS DISTINCT FROM ({label}), true) OR row_number() OVER w = 1 AS fresh, timestamp - lag(timestamp) OVER w AS gap FROM {source} WINDOW w AS (PARTITION BY video_id ORDER BY timestamp)),
    {name}_s AS (SELECT video_id, quantile_cont(gap, 0.5) FILTER (gap > 0) AS step FROM {name}_q GROUP BY 1),
    {name}_i AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY video_id ORDER BY timestamp) AS island FROM {name}_q),
    {name} AS (SELECT video_id, any_value(label) AS label, min(timestamp) AS start, max(timestamp) + coalesce(any_value(step), 0.0) AS "end" FROM {name}_i JOIN {name}_s USING (video_id) GROUP BY video_id, island)"""


_SPEAKING = """CASE WHEN frame_reason = 'no_face' THEN 'no face' WHEN face_status = 'tracked_unscored' THEN 'not evaluated' ELSE CASE WHEN is_active_speaker THEN 'speaking track ' || track_id ELSE 'not speaking' END || CASE WHEN frame_reason = 'imputed_tail' THEN ' (imputed score)' ELSE '' END END"""


@register(
    "tiers_frames",
    f"""WITH {EVENTS_SQL}, {FACES_SQL}, {block_sql("sb", "fa", _SPEAKING)}, pp AS (SELECT video_id, t AS timestamp, bool_or(value / 100 >= 0.3) AS seen, bool_or(event_type <> 'error') AS f0 FROM ev GROUP BY ALL), {block_sql("pb", "pp", "seen")}, {block_sql("vb", "pp", "f0")},
    st AS (SELECT video_id, quantile_cont(gap, 0.5) FILTER (gap > 0) AS step FROM sb_q GROUP BY 1),
    tk AS (SELECT video_id, track_id, min(timestamp) AS a, max(timestamp) AS b, count(*) AS n, count(*) FILTER (is_active_speaker) AS act, round(avg(score), 6) AS mean FROM fa WHERE track_id IS NOT NULL GROUP BY ALL)
    SELECT 'asd_speaking' AS tier, video_id, start, "end", label AS text FROM sb UNION ALL SELECT 'pose_presence', video_id, start, "end", 'body present' FROM pb WHERE label UNION ALL SELECT 'voiced_blocks', video_id, start, "end", 'voiced (f0)' FROM vb WHERE label
    UNION ALL SELECT 'face_tracks', video_id, a, b + coalesce(step, 0.0), 'track ' || track_id || ' · ' || act || '/' || n || ' act · mean ' || printf('%.3f', mean) FROM tk JOIN st USING (video_id)""",
)
def tiers_frames(spark, sf_dir):
    ev = events(spark, sf_dir)
    seen = faces(ev)
    summaries = tracks.face_tracks(seen.withColumnsRenamed({"timestamp": "t", "is_active_speaker": "active"}).withColumn("scene", F.lit(0)), VIDEO)
    points = ev.select("video_id", F.col("t").alias("timestamp"), (F.col("value") / 100).alias("confidence"), F.when(F.col("event_type") != "error", F.col("value")).alias("f0_hz"))
    tables = {"active_speaker_frames": seen, "active_speaker_tracks": summaries, "pose_body": points}
    voiced = tiers.voiced(points, VIDEO).select(F.lit("voiced_blocks").alias("tier"), "*")
    return tiers.build(tables, VIDEO).unionByName(voiced).select("tier", "video_id", "start", "end", "text")


def windows_sql(name: str, columns: list[str], label: str) -> str:
    whole = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return f"""{name}_c AS (SELECT video_id, timestamp, {", ".join(f"CASE WHEN {whole} THEN {c} END AS {c}" for c in columns)}, min(timestamp) OVER (PARTITION BY video_id) AS first FROM ac),
    {name}_0 AS (SELECT *, floor((timestamp - first) / 7200) AS n FROM {name}_c), {name}_1 AS (SELECT *, CASE WHEN timestamp < first + n * 7200 THEN n - 1 WHEN timestamp >= first + (n + 1) * 7200 THEN n + 1 ELSE n END AS slot FROM {name}_0),
    {name}_l AS (SELECT video_id, slot, min(first) AS first, {label.format(*[f"quantile_disc({c}, 0.5)" for c in columns])} AS label FROM {name}_1 GROUP BY ALL HAVING count({columns[0]}) >= 0.5 * count(*) AND count({columns[0]}) > 0),
    {name}_b AS (SELECT *, CASE WHEN label = lag(label) OVER w AND slot = lag(slot) OVER w + 1 THEN 0 ELSE 1 END AS fresh FROM {name}_l WINDOW w AS (PARTITION BY video_id ORDER BY slot)),
    {name}_r AS (SELECT *, sum(fresh) OVER (PARTITION BY video_id ORDER BY slot) AS run FROM {name}_b),
    {name} AS (SELECT video_id, any_value(label) AS text, min(first + slot * 7200) AS start, max(first + (slot + 1) * 7200) AS "end" FROM {name}_r GROUP BY video_id, run)"""


_PITCH = "'f0 med ' || (['C', 'C#', 'D', 'D#', 'E', 'F', 'F#', 'G', 'G#', 'A', 'A#', 'B'])[(floor(12 * log2({0} / 440) + 69)::INT % 12 + 12) % 12 + 1] || (floor(floor(12 * log2({0} / 440) + 69) / 12)::INT - 1)"
_LEVEL = "'int med ' || (floor({0} / 2) * 2)::BIGINT || ' to ' || (floor({0} / 2) * 2 + 2)::BIGINT || ' dB'"
_BANDS = "'med F1~' || (floor({0} / 300) * 300)::BIGINT || 'Hz F2~' || (floor({1} / 600) * 600)::BIGINT || 'Hz F3~' || (floor({2} / 1000) * 1000)::BIGINT || 'Hz'"


@register(
    "tiers_acoustic",
    f"""WITH {EVENTS_SQL}, ac AS (SELECT video_id, t AS timestamp, CASE WHEN event_type <> 'error' AND value > 0 THEN value * 4 END AS f0_hz, value * 3 - 60 AS intensity_db, value * 10 AS f1_hz, CASE WHEN event_type <> 'view' THEN value * 20 END AS f2_hz, CASE WHEN event_type <> 'click' THEN value * 30 END AS f3_hz FROM ev WHERE value >= 0.5),
    {windows_sql("p", ["f0_hz"], _PITCH)}, {windows_sql("l", ["intensity_db"], _LEVEL)}, {windows_sql("b", ["f1_hz", "f2_hz", "f3_hz"], _BANDS)}
    SELECT 'f0_blocks' AS tier, video_id, start, "end", text FROM p UNION ALL SELECT 'intensity_blocks', video_id, start, "end", text FROM l UNION ALL SELECT 'formant_blocks', video_id, start, "end", text FROM b
    UNION ALL SELECT unnest(['f0_blocks', 'intensity_blocks', 'formant_blocks']), video_id, NULL, NULL, unnest(['f0_hz=' || CASE WHEN event_type <> 'error' AND value > 0 THEN printf('%.2f', value * 4) ELSE 'unknown' END, 'intensity_db=' || printf('%.2f', value * 3 - 60),
      'f1_hz=' || printf('%.2f', value * 10) || ' f2_hz=' || CASE WHEN event_type <> 'view' THEN printf('%.2f', value * 20) ELSE 'unknown' END || ' f3_hz=' || CASE WHEN event_type <> 'click' THEN printf('%.2f', value * 30) ELSE 'unknown' END]) FROM ev WHERE value < 0.5""",
)
def tiers_acoustic(spark, sf_dir):
    v, kind = F.col("value"), F.col("event_type")
    frames = events(spark, sf_dir).select(
        "video_id", F.when(v >= 0.5, F.col("t")).alias("timestamp"), F.when((kind != "error") & (v > 0), v * 4).alias("f0_hz"), (v * 3 - 60).alias("intensity_db"), (v * 10).alias("f1_hz"),
        F.when(kind != "view", v * 20).alias("f2_hz"), F.when(kind != "click", v * 30).alias("f3_hz"),
    )
    made = {"f0_blocks": tiers.pitch_blocks, "intensity_blocks": tiers.intensity_blocks, "formant_blocks": tiers.formant_blocks}
    rows = [make(frames, VIDEO, 7200.0).select(F.lit(name).alias("tier"), "video_id", "start", "end", "text") for name, make in made.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@register(
    "tiers_people",
    f"""WITH {EVENTS_SQL}, ix AS (SELECT video_id, t AS pts, row_number() OVER (PARTITION BY video_id ORDER BY t) - 1 AS frame_number, user_id, event_type, value FROM ev),
    si AS (SELECT video_id, user_id % 3 AS person_id, frame_number, CASE WHEN event_type = 'error' THEN pts + 1 ELSE pts END AS t, event_type <> 'error' AS ok, value FROM ix),
    su AS (SELECT video_id, person_id, round(avg(value / 1000), 6) AS conf, round(count(*) / 1000.0, 6) AS cov, round(coalesce(max(gap), 0.0), 6) AS gap FROM (SELECT *, t - lag(t) OVER (PARTITION BY video_id, person_id ORDER BY t) AS gap FROM si) WHERE person_id > 0 GROUP BY ALL),
    jo AS (SELECT *, ok AND coalesce(lag(ok) OVER w, false) AND frame_number = lag(frame_number) OVER w + 1 AS joined, lag(frame_number) OVER w IS NOT NULL AND NOT (ok AND coalesce(lag(ok) OVER w, true)) AS edge FROM si WINDOW w AS (PARTITION BY video_id, person_id ORDER BY frame_number)),
    rn AS (SELECT *, sum(CASE WHEN joined THEN 0 ELSE 1 END) OVER (PARTITION BY video_id, person_id ORDER BY frame_number) AS run FROM jo),
    ag AS (SELECT video_id, person_id, run, min(frame_number) AS f0, max(frame_number) AS f1, min(t) AS start, max(t) AS "end", count(*) AS n, count(*) FILTER (ok) AS ok, bool_or(NOT joined AND edge) AS opened FROM rn GROUP BY ALL),
    ma AS (SELECT *, opened OR coalesce(lead(opened) OVER (PARTITION BY video_id, person_id ORDER BY run), false) AS edged, sum(n) OVER (PARTITION BY video_id, person_id) AS total FROM ag)
    SELECT video_id, start, "end", 'person ' || person_id || ' · ' || CASE WHEN n = 1 THEN 'sighting mark 1 frame' ELSE 'sighting run ' || n || ' frames' END || ' of ' || total || ' · conf ' || coalesce(printf('%.3f', conf), 'unknown') || ' · track coverage ' || coalesce(printf('%.3f', cov), 'unknown')
      || ' · max gap reported ' || CASE WHEN total < 2 AND gap = 0 THEN 'unknown' ELSE coalesce(printf('%.3f', gap), 'unknown') END || ' · covers src ' || CASE WHEN n = 1 THEN 'frame ' || f0 ELSE f0 || '-' || f1 END
      || ' · ' || CASE WHEN ok = 0 OR (edged AND n = 1) THEN 'unverified' WHEN edged THEN 'verified; split' ELSE 'verified' END AS text FROM ma LEFT JOIN su USING (video_id, person_id)""",
)
def tiers_people(spark, sf_dir):
    from pyspark.sql import Window

    numbered = events(spark, sf_dir).withColumn("frame_number", (F.row_number().over(Window.partitionBy("video_id").orderBy("t")) - 1).cast("bigint"))
    late = F.when(F.col("event_type") == "error", F.col("t") + 1).otherwise(F.col("t"))
    seen = numbered.select("video_id", (F.col("user_id") % 3).alias("person_id"), "frame_number", late.alias("t"), (F.col("value") / 1000).alias("confidence"))
    measured = numbered.select("video_id").distinct().withColumn("frames_measured", F.lit(1000))
    # The track table knows nothing of person 0.
    summaries = tracks.person_tracks(seen.where("person_id > 0"), VIDEO, measured)
    index = numbered.select("video_id", "frame_number", F.col("t").alias("pts"))
    return tiers.people(seen, summaries, index, VIDEO).select("video_id", "start", "end", "text")
