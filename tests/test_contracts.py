"""Contracts, canonical rows, answers, tiers and the mended rules on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from chronoloom.operators import acoustic, alignment, answers, canonical, contracts, intervals, quality, runs, summaries, text, tiers, tracks
from chronoloom.sources import raw

V = ["video_id"]


def one(spark, column, ddl="x string", row=(None,)):
    return spark.createDataFrame([row], ddl).select(column.alias("r")).first()["r"]


def keys(rows):
    return sorted((r["rule"], r["key"]) for r in rows.collect())


def test_a_segment_that_ends_before_its_start_overlaps_nothing(spark):
    turns = spark.createDataFrame([(1, 1, "a", 0.0, 9.0)], "video_id int, turn_id long, speaker string, start double, end double")
    rows = spark.createDataFrame([(1, 1, 5.0, 3.0), (1, 2, 5.0, 5.0)], "video_id int, segment_id long, start double, end double")
    got = {r["segment_id"]: r["method"] for r in intervals.assign_speakers(rows, turns, V, "segment_id").collect()}
    assert got == {1: "no_overlap", 2: "point_containment"}


def test_statistics_of_finite_values(spark):
    rows = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (float("inf"),), (None,)], "x double")
    got = rows.agg(*acoustic.statistics("x", "x")).first()
    assert (got["x_mean"], got["x_median"], got["x_max"], got["x_std"]) == (2.0, 2.0, 3.0, 1.0)


def test_null_flags_are_false_in_runs(spark):
    rows = spark.createDataFrame([(1, float(i), x) for i, x in enumerate([False, None, False, True])], "video_id int, t double, x boolean")
    assert sorted(r["samples"] for r in runs.collapse_runs(rows, V, "t", F.col("x")).collect()) == [1, 3]


def test_words_of_a_long_text_in_linear_time(spark):
    rows = spark.createDataFrame([(1, "ab  c " * 40_000), (1, " x"), (2, None)], "id long, t string")
    got = text.fallback_words(rows, "id", "t").orderBy("character_end", "word").collect()
    assert len(got) == 80_001 and (got[0]["word"], got[0]["character_start"], got[0]["word_id"]) == ("ab", 0, "1-w00001")
    assert got[-1]["character_end"] == 6 * 40_000 - 1 and got[-1]["word_id"] == "1-w80000"


def test_tokens_of_sentences(spark):
    got = text.token_rows(spark.createDataFrame([(7, "It is 12.  Yes, A!")], "id long, t string"), "id", "t").orderBy("token_id").collect()
    assert [(r["token_id"], r["token"], r["start"], r["end"]) for r in got][:4] == [("7-s001-t0001", "It", 0, 2), ("7-s001-t0002", "is", 3, 5), ("7-s001-t0003", "12", 6, 8), ("7-s001-t0004", ".", 8, 9)]
    assert [r["token"] for r in got if r["sentence_id"] == "7-s002"] == ["Yes", ",", "A", "!"]
    assert [(r["is_alpha"], r["is_digit"], r["is_lower"], r["is_punct"]) for r in got][1:4] == [(True, False, True, False), (False, True, False, False), (False, False, False, True)]


def test_untimed_words_hand_on_their_status(spark):
    tokens = spark.createDataFrame([(1, 0, "“a”"), (1, 1, "b")], "s int, token_index int, token string")
    words = spark.createDataFrame([(1, 0, "a", None, None, "missing_timestamp"), (1, 1, "b", 1.0, 2.0, "aligned")], "s int, word_index int, word string, start double, end double, alignment_status string")
    got = [(r["token_start"], r["alignment_status"]) for r in alignment.align_tokens(tokens, words, ["s"]).orderBy("token_index").collect()]
    assert got[1] == (1.0, "aligned") and got[0][0] is None


def test_frames_without_a_score_choose_nobody(spark):
    rows = spark.createDataFrame([(1, 1, 0, 5, 0.9), (1, 1, 1, 5, None), (1, 1, 2, 5, 0.8)], "video_id int, scene long, frame long, track_id long, score double")
    got = {r["frame"]: r["track_id"] for r in tracks.stable_selection(rows, V, window=1).collect()}
    assert got == {0: 5, 1: None, 2: 5}


def test_readers_of_broken_and_untimed_rows(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"rate": 16000}\n{"frame": [0.01, 120.5, -20, true, 1, 2, 3]}\n[0.02, null, "x", 0]\n{"silences": [[0, 1]]}\n')
    got = sorted(tuple(r)[1:5] for r in raw.acoustic_frames(spark, str(tmp_path / "a.jsonl")).collect())
    assert got == [(0.01, 120.5, -20.0, True), (0.02, None, None, False)]
    (tmp_path / "b.jsonl").write_text('{"frame": [0.01, 1\n')
    with pytest.raises(Exception, match="not a line of JSON"):
        raw.acoustic_frames(spark, str(tmp_path / "b.jsonl")).collect()
    (tmp_path / "d.json").write_text('{"turns": [["x", "2.0", "B"], ["0.5", "1.0", "A"], ["3.0"]]}')
    got = [tuple(r)[1:5] for r in raw.diarization_turns(spark, str(tmp_path / "d.json")).orderBy("turn_id").collect()]
    assert got == [("turn000001", None, 2.0, "B"), ("turn000002", 0.5, 1.0, "A")]
    frame = spark.createDataFrame([], "video_id string, x double")
    raw.write_table(frame, frame.schema, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).columns == ["video_id", "x"]


def test_labels_and_milliseconds(spark):
    n = "x double"
    for value, name in ((440.0, "A4"), (261.7, "C4"), (27.5, "A0"), (466.2, "A#4")):
        assert one(spark, tiers.pitch_label(F.col("x")), n, (value,)) == name
    assert one(spark, tiers.intensity_label(F.col("x")), n, (-299.5,)) == "-300 to -298 dB"
    assert one(spark, tiers.formant_label(F.col("x"), F.col("x"), F.col("x")), n, (1250.0,)) == "F1~1200Hz F2~1200Hz F3~1000Hz"
    assert [one(spark, tiers.shown_number(F.col("x"), 3), n, (v,)) for v in (0.0, None, float("nan"), 1.23456)] == ["0.000", "unknown", "unknown", "1.235"]
    assert [one(spark, tiers.shown_field(F.col("x"), True), "x string", (v,)) for v in (None, " ", " a\nb ")] == ["none", "none", "a b"]
    assert [one(spark, tiers.seconds_to_ms(F.col("x"), end=True), n, (v,)) for v in (0.0, -0.2, 0.0125, 1.0005)] == [1, 1, 13, 1001]
    rows = spark.createDataFrame([("t", 1, "a", 0.0, 0.0, "x"), ("t", 1, "b", None, 1.0, "x"), ("t", 1, "c", 1.0, float("inf"), "x"), ("t", 1, "d", -1.0, 1.0, "x"), ("t", 1, "e", -0.0002, 0.0001, "x")], "tier string, video_id int, row_id string, start double, end double, text string")
    got = {r["row_id"]: (r["start_ms"], r["end_ms"], r["refused"]) for r in tiers.placed(rows).collect()}
    assert got == {"a": (0, 1, None), "b": (None, None, "missing_time"), "c": (None, None, "non_finite"), "d": (None, None, "missing_time"), "e": (0, 1, None)}
    assert [tuple(r)[2:] for r in tiers.drop_counts(rows, V).collect()] == [(5, 2, 1)]


def test_person_tier_markers(spark):
    index = spark.createDataFrame([(1, i, i / 10) for i in range(6)], "video_id int, frame_number long, pts double")
    seen = spark.createDataFrame([(1, 7, f, t, 0.5) for f, t in ((0, 0.0), (1, 0.1), (3, 0.3), (4, 9.0))], "video_id int, person_id long, frame_number long, t double, confidence double")
    summary = spark.createDataFrame([], "video_id int, person_id long, mean_confidence double, frame_coverage double, longest_gap_seconds double")
    got = [r["text"] for r in tiers.people(seen, summary, index, V).orderBy("start").collect()]
    assert got[0] == "person 7 · sighting run 2 frames of 4 · conf unknown · track coverage unknown · max gap reported unknown · covers src 0-1 · verified"
    assert got[1].endswith("covers src frame 3 · unverified") and got[2].endswith("covers src frame 4 · unverified")
    assert all(r["text"].endswith("no index") for r in tiers.people(seen, summary, index.limit(0), V).collect())


def test_pose_token_and_other_contracts(spark):
    pose = spark.createDataFrame([(1, 1.0, 1.0, "basis_ok", "normalized", 0.1, 0.2), (2, 0.0, 1.0, "basis_ok", "normalized", None, 0.2), (3, 1.0, 1.0, "odd", "basis_unusable", None, None)], "id int, x double, y double, basis_state string, value_status string, x_norm double, y_norm double")
    assert keys(quality.violations(pose, "id", contracts.pose_rules())) == [("coordinate_disagrees", "2"), ("status_disagrees", "2"), ("unknown_basis", "3")]
    raw_points = spark.createDataFrame([(1, 0.0, 0, 0.5, 1.0, 1.0, 3), (2, None, -1, 0.0, None, 1.0, 30)], "id int, timestamp double, frame_number int, score double, x double, y double, keypoint_id int")
    assert [r for r, _ in keys(quality.violations(raw_points, "id", contracts.keypoint_rules(25)))] == ["negative_frame", "no_coordinate", "no_score", "no_time", "unknown_point"]
    tokens = spark.createDataFrame([(1, "s1", "t1", "aligned"), (1, "s1", "t1", None), (1, "s9", "t2", "aligned")], "d int, sentence_id string, token_id string, alignment_status string")
    got = sorted(tuple(r) for r in contracts.token_problems(tokens, tokens.where("sentence_id = 's1'"), ["d"]).collect())
    assert got == [("t1", "no_status"), ("t1", "repeated_id"), ("t2", "unknown_sentence")]
    media = spark.createDataFrame([(1, 10.0, 640, 480, 25.0, "h264"), (2, None, 0, 480, None, "")], "id int, duration_seconds double, width int, height int, average_frame_rate double, video_codec string")
    assert [r for r, _ in keys(quality.violations(media, "id", contracts.metadata_rules()))] == ["no_codec", "no_duration", "no_rate", "no_size"]
    files = spark.createDataFrame([("a/b.parquet",), ("/x",), ("../y",), ("gone",)], "path string")
    assert sorted(tuple(r) for r in contracts.manifest_problems(files, files.where("path like 'a%'")).collect()) == [("../y", "outside"), ("/x", "absolute"), ("gone", "absent")]
    videos = spark.createDataFrame([(1, "completed"), (2, "failed")], "video_id int, status string")
    summary = spark.createDataFrame([(2, 1, 0)], "videos long, completed long, failed long")
    assert [r["rule"] for r in contracts.report_problems(summary, videos).collect()] == ["failed_differs"]
    drift = spark.createDataFrame([(1, 100.0, 101.9), (2, 100.0, 103.0), (3, 1000.0, 1015.0)], "id int, audio_seconds double, video_seconds double")
    assert keys(quality.violations(drift, "id", contracts.drift_rules())) == [("audio_drift", "2")]


def test_assignment_and_acoustic_contracts(spark):
    turns = spark.createDataFrame([(1, "a")], "video_id int, speaker string")
    rows = spark.createDataFrame([(1, 1, "a", 0.5, 1.0, 0.0, 2.0), (1, 2, "b", 1.5, 3.0, 0.0, 2.0)], "video_id int, id int, speaker string, overlap_ratio double, overlap_seconds double, start double, end double")
    assert [r for r, k in keys(contracts.assignment_problems(rows, turns, V, "id")) if k == "2"] == ["overlap_too_long", "ratio_range", "unknown_speaker"]
    features = rows.select("video_id", "id", "start", F.lit(3.0).alias("end"), F.lit(1.5).alias("pause_ratio"))
    assert keys(contracts.acoustic_problems(features, rows.where("id = 1"), V, "id")) == [("pause_ratio", "1"), ("pause_ratio", "2"), ("times_differ", "1"), ("unknown_segment", "2")]


def test_canonical_words_faces_and_variants(spark):
    words = spark.createDataFrame([("seg000001", 0, " hi ", 0.0, 0.5, "", "B", None, 0.4), ("seg000001", 1, "you", None, 0.5, "A", "B", 0.9, 0.4)], "segment_id string, word_index int, word string, start double, end double, speaker string, segment_speaker string, confidence double, score double")
    got = [(r["word_id"], r["word"], r["speaker_id"], r["confidence"], r["duration"], r["alignment_status"]) for r in canonical.words(words).orderBy("word_id").collect()]
    assert got == [("seg000001-w00000", "hi", "B", 0.4, 0.5, "aligned"), ("seg000001-w00001", "you", "A", 0.9, None, "missing_timestamp")]
    frames = spark.createDataFrame([(None, None, None, 0.5, None, None, 1.0, 1.0, 2.0, 2.0), (4, None, None, 0.5, True, True, 1.0, None, 2.0, 2.0), (5, "odd", None, None, None, None, 1.0, 1.0, 2.0, 2.0)],
        "track_id int, face_status string, score_reason string, talknet_score double, score_imputed boolean, is_active_speaker boolean, x1 double, y1 double, x2 double, y2 double")
    got = [(r["face_status"], r["frame_reason"], r["x1"], r["is_active_speaker"]) for r in canonical.face_frames(frames).orderBy("track_id").collect()]
    assert got == [("no_face", "no_face", None, False), ("tracked", "imputed_tail", None, True), ("tracked_unscored", "unknown", 1.0, False)]
    people = spark.createDataFrame([(1, 0, [1.0, 2.0, 0.5] * 22, [1.0, 1.0, 0.0] * 2, [3.0, 3.0, 0.1] * 72)], "f int, detection_index int, hand_left array<double>, hand_right array<double>, face array<double>")
    hands = canonical.hand_rows(people, ["f"]).collect()
    assert len(hands) == 22 and {r["hand"] for r in hands} == {"left"} and sorted(r["keypoint_name"] for r in hands)[4] == "K21" and canonical.face_rows(people, ["f"]).count() == 70
    assert canonical.of_variant(people.select("f"), "source", "1.0").first()["variant"] == "source"
    stories = spark.createDataFrame([(0, "s1", None, " t ", ["1", "2"])], "window long, story_id string, parent_id string, text string, evidence array<string>")
    got = canonical.story_rows(stories).first()
    assert (got["story_id"], got["parent_id"], got["text"], got["evidence_segment_ids"], got["window_index"]) == ("w0-s1", None, "t", '["1","2"]', 0)


def test_answers_of_models(spark):
    content = lambda x: one(spark, answers.message_content(F.col("x")), "x string", (x,))
    assert content('{"choices": [{"message": {"content": " hi "}}]}') == " hi " and content("{}") is None
    assert content('{"choices": [{"message": {"content": [{"text": "a"}, {"text": "b"}]}}]}') == "ab"
    number = lambda x: one(spark, answers.strict_number(F.try_parse_json("x")), "x string", (x,))
    assert [number(x) for x in ("1.5", '"2"', "true", '"x"', "null")] == [1.5, 2.0, None, None, None]
    assert one(spark, answers.label_list(F.col("x")), "x string", ('["a","b"]',)) == ["a", "b"] and one(spark, answers.label_list(F.col("x")), "x string", ('["a"]',)) is None
    assert one(spark, answers.seconds_between(F.lit("2024-01-01T00:00:00Z"), F.lit("2024-01-01T00:00:01.5Z"))) == 1.5
    assert tuple(one(spark, answers.axis(F.lit(5.0), F.lit(7.0)))) == (7.0, "media, widened") and tuple(one(spark, answers.axis(F.lit(None).cast("double"), F.lit(7.0)))) == (7.0, "latest end")
    masked = spark.range(1).select(answers.mask_secrets(F.create_map(F.lit("api_key"), F.lit("s"), F.lit("n"), F.lit("v"))).alias("m"), answers.mask_command(F.array(F.lit("run"), F.lit("--token"), F.lit("s"))).alias("c")).first()
    assert masked["m"] == {"api_key": "***masked***", "n": "v"} and masked["c"] == ["run", "--token", "***masked***"]
    facts = spark.createDataFrame([(1, "m", None)], "video_id int, model string, weights string")
    assert [tuple(r) for r in answers.provenance(facts, V, "t", ["model", "weights"]).collect()] == [(1, "t", "model", "m")]
    hashes = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "y int, x string").select(answers.content_hash(["x", "y"], 8).alias("h")).collect()
    assert hashes[0] == hashes[1] != hashes[2] and len(hashes[0]["h"]) == 8


def test_usage_outcomes_and_report(spark):
    asked = spark.createDataFrame([(1, float(i), 0.1, {"in": 2, "out": i}) for i in range(5)], "v int, at double, seconds double, usage map<string,int>")
    totals, last = summaries.usage(asked, ["v"], last=2)
    assert {r["kind"]: r["total"] for r in totals.collect()} == {"in": 10, "out": 10} and sorted(r["at"] for r in last.collect()) == [3.0, 4.0]
    judged = spark.createDataFrame([(1, 0, "accepted"), (1, 0, "dropped"), (1, 1, "none")], "v int, window int, status string")
    assert tuple(summaries.story_outcomes(judged, ["v"]).first()) == (1, 2, 1, 1, 1)
    lines = [r["json"] for r in summaries.batch_report(spark.createDataFrame([(1, "completed", 2.0)], "video_id int, status string, seconds double")).collect()]
    assert len(lines) == 2 and '"kind":"summary"' in lines[0] and '"completed":1' in lines[0]
