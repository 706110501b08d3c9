"""Queries over clocks, references, exports, stories and token times, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronoloom.operators import alignment, clocks, consistency, folding, stories
from chronoloom.plans.registry import register
from chronoloom.sources.tables import EVENTS_SQL, events, table

VIDEO = ["video_id"]


@register(
    "frame_clock_extrapolate",
    f"""WITH {EVENTS_SQL}, n AS (SELECT video_id, t, event_id, event_type, row_number() OVER (PARTITION BY video_id ORDER BY t, event_id) - 1 AS frame_number FROM ev),
    i AS (SELECT video_id, frame_number, t - 1704067200 AS pts FROM n WHERE event_type <> 'error'),
    e AS (SELECT video_id, max(frame_number) AS last, arg_max(pts, frame_number) AS stop, arg_min(pts, frame_number) AS begin, count(*) AS n FROM i GROUP BY ALL),
    f AS (SELECT video_id, event_id, frame_number + frame_number // 3 AS frame_number FROM n)
    SELECT f.video_id, f.event_id, f.frame_number, round(round(coalesce(i.pts, CASE WHEN f.frame_number > e.last THEN e.stop + coalesce(nullif((e.stop - e.begin) / greatest(e.n - 1, 1), 0.0), 0.04) * (f.frame_number - e.last) ELSE f.frame_number / 25.0 END), 6), 3) AS timestamp
    FROM f LEFT JOIN i USING (video_id, frame_number) LEFT JOIN e USING (video_id)""",
)
def frame_clock_extrapolate(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn("frame_number", F.row_number().over(Window.partitionBy("video_id").orderBy("t", "event_id")).cast("bigint") - 1)
    index = ev.where("event_type <> 'error'").select("video_id", "frame_number", (F.col("t") - 1704067200).alias("pts"))
    frames = ev.select("video_id", "event_id", F.expr("frame_number + frame_number div 3").alias("frame_number"))
    return clocks.frame_times(frames, index, VIDEO).withColumn("timestamp", F.round("timestamp", 3))


@register(
    "cross_modal_check",
    f"""WITH {EVENTS_SQL}, b AS (SELECT video_id, min(t) + 3600 AS zero, max(t) - min(t) - 7200 AS duration FROM ev GROUP BY ALL), r AS (SELECT ev.*, t - zero AS rel, duration FROM ev JOIN b USING (video_id)),
    s AS (SELECT DISTINCT video_id, user_id AS speaker FROM ev WHERE event_type = 'view' AND value > 40), c AS (SELECT DISTINCT video_id, user_id AS speaker FROM ev WHERE event_type = 'click')
    SELECT video_id, event_type || 's' AS table_name, 'before_start' AS issue, count(*) AS rows FROM r WHERE event_type IN ('view', 'click') AND rel < -0.001 GROUP BY ALL
    UNION ALL SELECT video_id, event_type || 's', 'past_duration', count(*) FROM r WHERE event_type IN ('view', 'click') AND rel > duration + 1 GROUP BY ALL
    UNION ALL SELECT video_id, 'clicks', 'unresolved_speaker', count(*) FROM c ANTI JOIN s USING (video_id, speaker) WHERE video_id IN (SELECT video_id FROM s) GROUP BY ALL""",
)
def cross_modal_check(spark, sf_dir):
    ev = events(spark, sf_dir)
    ends = ev.groupBy("video_id").agg((F.min("t") + 3600).alias("zero"), (F.max("t") - F.min("t") - 7200).alias("duration"))
    rows = ev.join(ends.select("video_id", "zero"), VIDEO).withColumns({"rel": F.col("t") - F.col("zero"), "speaker": F.col("user_id")})
    views, clicks = rows.where("event_type = 'view'"), rows.where("event_type = 'click'")
    late = consistency.outside_media({"views": (views, "rel"), "clicks": (clicks, "rel")}, ends, VIDEO)
    return late.unionByName(consistency.unresolved(clicks, views.where("value > 40"), VIDEO, "speaker", "clicks"))


@register(
    "coverage_inventory",
    """WITH f AS (SELECT user_id AS video_id, event_type AS artifact, count(*) AS file_count, sum(event_id % 1000)::BIGINT AS size_bytes FROM events WHERE value >= 2 GROUP BY ALL),
    c(artifact, exported, summarised) AS (VALUES ('click', true, false), ('error', false, false), ('purchase', false, true), ('signup', true, true), ('view', true, false), ('pose', true, false))
    SELECT v.video_id, c.artifact, CASE WHEN file_count IS NULL THEN 'absent' WHEN exported THEN 'exported' WHEN summarised THEN 'summarised' ELSE 'present, not exported' END AS state, CASE WHEN file_count IS NOT NULL THEN 'directory' END AS kind, file_count, size_bytes
    FROM (SELECT DISTINCT user_id AS video_id FROM events) v CROSS JOIN c LEFT JOIN f ON f.video_id = v.video_id AND f.artifact = c.artifact""",
)
def coverage_inventory(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumnRenamed("user_id", "video_id")
    name = F.when(F.col("value") < 2, "explanation.md").otherwise("part.parquet")
    files = ev.select("video_id", F.col("event_type").alias("artifact"), F.lit(True).alias("in_folder"), name.alias("file_name"), F.expr("event_id % 1000").alias("size"))
    catalog = [("click", True, False), ("error", False, False), ("purchase", False, True), ("signup", True, True), ("view", True, False), ("pose", True, False)]
    present = consistency.artifacts(files, VIDEO)
    return consistency.coverage(ev, catalog, present, VIDEO).join(present, ["video_id", "artifact"], "left")


@register(
    "story_validation",
    """WITH s AS (SELECT conv_id, turn, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 3 AS w FROM conversations),
    k AS (SELECT *, turn % 5 = 4 AND EXISTS (SELECT 1 FROM s o WHERE o.conv_id = s.conv_id AND o.turn = 0) AND w > 0 AS outside, conv_id % 10 = 7 AND turn = 1 AS bad FROM s),
    j AS (SELECT *, bool_or(bad) OVER (PARTITION BY conv_id, w) AS refused, bool_or(outside) OVER (PARTITION BY conv_id, w ORDER BY turn) AS gone FROM k)
    SELECT conv_id, w AS "window", 'w' || w || '-s' || turn AS story_id, CASE WHEN refused THEN 'rejected' WHEN gone THEN 'dropped' ELSE 'accepted' END AS status,
      CASE WHEN refused THEN CASE WHEN bad THEN 'bad confidence' END WHEN gone THEN CASE WHEN outside THEN 'evidence in another window' ELSE 'parent dropped' END END AS reason, CASE WHEN refused THEN 'bad confidence' END AS window_breach
    FROM j""",
)
def story_validation(spark, sf_dir):
    # Each turn is a story below the turn before it; some rest on the first turn of the dialogue, some have no valid confidence.
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.floor(place / 3).alias("window"))
    segments = rows.select("conv_id", "window", F.col("turn").cast("string").alias("segment_id"), F.col("turn").cast("double").alias("start"), (F.col("turn") + 1).cast("double").alias("end"))
    before = F.lag("turn").over(Window.partitionBy("conv_id", "window").orderBy("turn"))
    has_first = F.min("turn").over(Window.partitionBy("conv_id")) == 0
    evidence = F.when(F.expr("turn % 5 = 4") & has_first, F.array(F.col("turn").cast("string"), F.lit("0"))).otherwise(F.array(F.col("turn").cast("string")))
    made = rows.withColumns({"parent": before, "ev": evidence})
    story = F.struct(
        F.concat(F.lit("s"), F.col("turn").cast("string")).alias("story_id"), F.concat(F.lit("s"), F.col("parent").cast("string")).alias("parent_id"), F.col("turn").cast("double").alias("start"),
        (F.col("turn") + 1).cast("double").alias("end"), F.when(F.expr("conv_id % 10 = 7 AND turn = 1"), 1.5).otherwise(0.9).alias("confidence"), F.col("ev").alias("evidence"),
    )
    answers = made.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list(story)).alias("stories")).withColumn("no_story_reason", F.lit(None).cast("string"))
    return stories.validate(answers, segments, ["conv_id"])


#: Edge marks as SQL text, and the folding that the given texts need: they hold no compatibility forms, and one letter that lower() leaves.
_MARKS = "'" + "".join(c for c in folding.EDGE_MARKS if c not in "'\f\v") + "'' ' || chr(11) || chr(12)"
_RAW = "trim(replace(lower(nfc_normalize({0})), 'ß', 'ss'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


@register(
    "token_alignment",
    f"""WITH RECURSIVE t AS (SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations),
    wa AS (SELECT conv_id, turn, unnest(range(0, len(p))) AS i, unnest(p) AS word FROM (SELECT conv_id, turn, list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS p FROM t)),
    ta AS (SELECT conv_id, turn, unnest(range(0, len(p))) AS j, unnest(p) AS token FROM (SELECT conv_id, turn, regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}} \t\n\x0B\f\r]') AS p FROM t)),
    w AS (SELECT *, {_RAW.format("word")} AS raw, trim({_RAW.format("word")}, {_MARKS}) AS core FROM wa),
    k AS (SELECT *, {_RAW.format("token")} AS raw, trim({_RAW.format("token")}, {_MARKS}) AS core FROM ta),
    lists AS (SELECT conv_id, turn, list(raw ORDER BY i) AS raws, list(core ORDER BY i) AS cores FROM w GROUP BY ALL),
    hits AS (SELECT k.*, raws, cores FROM k JOIN lists USING (conv_id, turn)),
    walk AS (
      SELECT conv_id, turn, -1 AS j, 0 AS cursor, NULL::BIGINT AS last, NULL::BIGINT AS place, '' AS status, 0.0::DOUBLE AS sure FROM lists
      UNION ALL
      SELECT conv_id, turn, j, CASE WHEN off >= 0 THEN cursor + off + 1 ELSE cursor END, CASE WHEN off >= 0 THEN cursor + off ELSE last END,
        CASE WHEN off >= 0 THEN cursor + off WHEN core = '' THEN coalesce(last, CASE WHEN cursor < len(raws) THEN cursor END) WHEN part THEN cursor END,
        CASE WHEN off = 0 THEN 'aligned' WHEN off > 0 OR core = '' OR part THEN 'approximate' ELSE 'unmatched' END,
        CASE WHEN off = 0 THEN 1.0 WHEN off > 0 AND core <> '' THEN greatest(0.3, 1.0 - 0.25 * off) WHEN off > 0 THEN 0.5 WHEN core = '' THEN 0.2 WHEN part THEN 0.3 ELSE 0.0 END
      FROM (SELECT h.*, s.cursor, s.last, coalesce(contains(cores[s.cursor + 1], core) AND cores[s.cursor + 1] <> core AND core <> '', false) AS part,
          coalesce(CASE WHEN core <> '' THEN list_position(cores[s.cursor + 1:s.cursor + 4], core) WHEN h.raw <> '' THEN list_position(raws[s.cursor + 1:s.cursor + 2], h.raw) END, 0) - 1 AS off
        FROM walk s JOIN hits h ON h.conv_id = s.conv_id AND h.turn = s.turn AND h.j = s.j + 1)
    )
    SELECT conv_id, turn, ta.j::INT AS token_index, token, CASE WHEN place IS NOT NULL THEN round(place * 0.4::DOUBLE, 6) END AS token_start, CASE WHEN place IS NOT NULL THEN round(place * 0.4::DOUBLE + 0.3::DOUBLE, 6) END AS token_end,
      CASE WHEN place IS NULL THEN 'unmatched' ELSE status END AS alignment_status, CASE WHEN place IS NULL THEN 0.0 ELSE sure END::DOUBLE AS alignment_confidence FROM walk JOIN ta USING (conv_id, turn, j)""",
)
def token_alignment(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    words = rows.select("conv_id", "turn", F.posexplode(F.filter(F.split("text", r"\s+"), lambda x: x != "")).alias("word_index", "word"))
    words = words.withColumns({"start": F.col("word_index") * F.lit(0.4), "end": F.col("word_index") * F.lit(0.4) + F.lit(0.3)})
    tokens = rows.select("conv_id", "turn", F.posexplode(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"), F.lit(0))).alias("token_index", "token"))
    return alignment.align_tokens(tokens, words, ["conv_id", "turn"])


@register(
    "core_texts",
    rf"""WITH w AS (SELECT unnest(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS word FROM documents), d AS (SELECT word, {_RAW.format("word")} AS raw_key FROM w)
    SELECT raw_key, trim(raw_key, {_MARKS}) AS core, count(DISTINCT word) AS spellings, count(*) AS uses FROM d GROUP BY ALL""",
)
def core_texts(spark, sf_dir):
    """Spellings of words that are compared as one."""
    words = table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("word"))
    # Each spelling is folded once, however often it is used.
    spelt = words.groupBy("word").agg(F.count("*").alias("n")).withColumn("raw_key", folding.raw_key(F.col("word")))
    return spelt.groupBy("raw_key", folding.core_of(F.col("raw_key")).alias("core")).agg(F.count("*").alias("spellings"), F.sum("n").alias("uses"))
