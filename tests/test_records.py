"""Clocks, references, stories, token times and document readers."""

import json

from chronoloom.operators import alignment, clocks, consistency, stories
from chronoloom.sources import documents


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_frame_times(spark):
    index = spark.createDataFrame([(1, 0, 0.0), (1, 1, 0.5), (1, 3, 1.5), (2, 0, 4.0)], "v int, frame_number bigint, pts double")
    frames = spark.createDataFrame([(1, 1), (1, 2), (1, 5), (2, 2), (3, 50)], "v int, frame_number bigint")
    assert rows(clocks.frame_times(frames, index, ["v"])) == [(1, 1, 0.5), (1, 2, 0.08), (1, 5, 3.0), (2, 2, 4.08), (3, 50, 2.0)]


def test_align_tokens(spark):
    words = [(1, 0, "Hello,", 0.0, 0.5), (1, 1, "l'homme", 0.5, 1.0), (1, 2, "the", 1.0, 1.1), (1, 3, "—", 1.1, 1.2), (1, 4, "end", None, 2.0)]
    tokens = [(1, i, t) for i, t in enumerate(["hello", ",", "l'", "homme", "xyz", "the", "—", "end", "!"])] + [(2, 0, "a")]
    found = alignment.align_tokens(spark.createDataFrame(tokens, "s int, token_index int, token string"), spark.createDataFrame(words, "s int, word_index int, word string, start double, end double"), ["s"])
    assert [(r.token, r.token_start, r.alignment_status, r.alignment_confidence) for r in found.orderBy("s", "token_index").collect()] == [
        ("hello", 0.0, "aligned", 1.0), (",", 0.0, "approximate", 0.2), ("l'", 0.5, "approximate", 0.3), ("homme", 0.5, "approximate", 0.3), ("xyz", None, "unmatched", 0.0),
        ("the", 1.0, "approximate", 0.75), ("—", 1.1, "aligned", 1.0), ("end", None, "unmatched", 0.0), ("!", None, "unmatched", 0.0), ("a", None, "no_timing", 0.0),
    ]


def story(i, parent=None, start=0.0, end=1.0, confidence=0.5, evidence=("a",)):
    return (i, parent, start, end, confidence, list(evidence))


def test_stories(spark):
    segments = spark.createDataFrame([(1, w, s, float(t), float(t + 1)) for w, s, t in [(0, "a", 0), (0, "b", 1), (1, "c", 2)]], "v int, window int, segment_id string, start double, end double")

    def judge(*told, reason=None):
        answers = spark.createDataFrame([(1, 0, reason, list(told))], f"v int, window int, no_story_reason string, stories {stories.STORIES}")
        return [(r.story_id, r.status, r.window_breach) for r in stories.validate(answers, segments, ["v"]).orderBy("story_id").collect()]

    far = story("x", evidence=("c",))
    assert judge(story("s"), far, story("y", "x"), story("z", "y")) == [("w0-s", "accepted", None), ("w0-x", "dropped", None), ("w0-y", "dropped", None), ("w0-z", "dropped", None)]
    assert judge(story("s", start=2.0, end=3.0)) == [("w0-s", "dropped", None)]
    assert judge(reason="nothing told") == [(None, "none", None)]
    for told, why in [
        ([], "no stories and no reason"), ([story("")], "no story id"), ([story("s"), story("s")], "repeated story id"), ([story("s", evidence=("q",))], "invented evidence"), ([story("s", evidence=())], "no evidence"),
        ([story("s", end=1.5)], "invented boundary"), ([story("s", end=0.0)], "no interval"), ([story("s", confidence=1.5)], "bad confidence"), ([story("s", confidence=float("nan"))], "bad confidence"),
        ([story("s", "t")], "unknown parent"), ([story("s", "t"), story("t", "s")], "cycle of parents"), ([story("s", "s")], "cycle of parents"), ([story("x", "gone", evidence=("c",))], "unknown parent"),
    ]:
        assert {(s, b) for _, s, b in judge(*told)} <= {("rejected", why)} and judge(*told), (told, why)


def test_consistency(spark):
    times = spark.createDataFrame([(1, -0.5), (1, 3.0), (1, 11.5), (2, 99.0)], "v int, t double")
    durations = spark.createDataFrame([(1, 10.0), (2, None)], "v int, duration double")
    assert rows(consistency.outside_media({"frames": (times, "t")}, durations, ["v"])) == [(1, "frames", "before_start", 1), (1, "frames", "past_duration", 1)]
    cited = spark.createDataFrame([(1, "a"), (1, "b"), (1, None), (2, "a")], "v int, speaker string")
    assert rows(consistency.unresolved(cited, cited.where("v = 1 and speaker = 'a'"), ["v"], "speaker", "segments")) == [(1, "segments", "unresolved_speaker", 1)]
    files = spark.createDataFrame([(1, "raw", True, "explanation.md", 9), (1, "raw", True, "a.json", 4), (1, "tab", False, "t.parquet", 2), (2, "raw", True, "explanation.md", 9)], "v int, artifact string, in_folder boolean, file_name string, size bigint")
    present = consistency.artifacts(files, ["v"])
    assert rows(present) == [(1, "raw", "directory", 1, 4), (1, "tab", "file", 1, 2)]
    catalog = [("raw", False, True), ("tab", False, False)]
    assert rows(consistency.coverage(files, catalog, present, ["v"])) == [(1, "raw", "summarised"), (1, "tab", "present, not exported"), (2, "raw", "absent"), (2, "tab", "absent")]


def test_documents(spark, tmp_path):
    def put(name, what):
        (tmp_path / name).write_text(what if isinstance(what, str) else json.dumps(what))
        return str(tmp_path / name)

    asr = documents.asr_segments(spark, put("a.json", {"language": "en", "segments": [{"start": 0, "end": 1.5, "text": " hi you ", "words": []}, {"start": 2, "end": "x", "text": "so", "words": [{"word": "so", "start": 2, "end": 2.5, "score": 0.5}]}]}))
    assert rows(asr.select("segment_index", "start", "end", "text")) == [(0, 0.0, 1.5, "hi you"), (1, 2.0, None, "so")]
    assert rows(documents.asr_words(asr).select("segment_index", "word", "start", "alignment_status")) == [(0, "hi", 0.0, "segment_only"), (0, "you", 0.0, "segment_only"), (1, "so", 2.0, "aligned")]
    turns = documents.segment_turns(spark, put("d.json", {"segments": [{"start": 3, "end": 4, "speaker_id": "b"}, {"start": 1, "end": 2, "speaker_id": "a"}, {"start": 5, "end": 5, "speaker_id": "a"}, {"start": 6, "end": 7}]}))
    assert rows(turns) == [("d.json", "turn000001", 1.0, 2.0, "a"), ("d.json", "turn000002", 3.0, 4.0, "b")]
    assert rows(documents.speaker_frames(spark, put("s.json", {"frame_count": 2, "track_count": 1, "frames": [{"n": 0}, {"n": 1}]}), "n: bigint")) == [("s.json", 2, 1, 0), ("s.json", 2, 1, 1)]
    people, bad = documents.person_documents(spark, put("p.json", {"frames_measured": 3, "frames": [{"person_id": 1}]}), "person_id: bigint")
    assert people.count() == 0 and rows(bad) == [("p.json", ["person_ids"])]
    pose = tmp_path / "pose"
    pose.mkdir()
    for name, what in {"v_000000000012_keypoints.json": '{"people": []}', "v_000000000013_keypoints.json": "{broken", "notes.json": '{"people": []}'}.items():
        (pose / name).write_text(what)
    assert [r.frame_number for r in documents.pose_frames(spark, str(pose), "people array<struct<x: int>>").collect()] == [12]
    scenes = documents.scene_spans(spark, put("c.csv", "﻿Timecode List:,00:01\nScene Number,Start Frame,End Frame\n1,1,10\nx,2,3\n2,11,20\n"))
    assert rows(scenes) == [("c.csv", 1, 0, 10), ("c.csv", 2, 10, 20)]
    assert rows(documents.frame_index(spark, put("f.json", {"packets": [{"pts_time": "0.2"}, {"pts_time": "-0.1"}, {"pts_time": "N/A"}, {}]}))) == [("f.json", 0, 0.0), ("f.json", 1, 0.2)]
    probe = {"format": {"format_name": "mp4", "duration": "2.0"}, "streams": [{"codec_type": "video", "codec_name": "h264", "r_frame_rate": "30000/1001", "avg_frame_rate": "0/0"}, {"codec_type": "audio", "sample_rate": "48000"}]}
    meta = documents.media_metadata(spark, put("m.json", probe)).first()
    assert (meta.container, meta.duration_seconds, meta.frame_count, meta.audio_sample_rate, meta.streams_present) == ("mp4", 2.0, 60, 48000, ["audio", "video"])
    states = documents.stage_states(spark, put("st.json", {"video_id": "v", "stages": {"asr": {"status": "ok", "duration_seconds": 1.5}}}))
    assert [(r.video_id, r.stage, r.status, r.duration_seconds) for r in states.collect()] == [("v", "asr", "ok", 1.5)]


def test_track_candidates(spark):
    box = [0.0, 0.0, 1.0, 1.0]
    data = [(1, 0, [0, 1, 2, 3, 9], [box, box, box, box, box], [0.5], 4), (1, 1, [0, 1], [[0.0, float("nan"), 1.0, 1.0], box], [], 4), (1, 2, [2], [box], [float("nan")], 4)]
    found = documents.track_candidates(spark.createDataFrame(data, "v int, track_id int, frames array<int>, boxes array<array<double>>, scores array<double>, n int"), ["v"], "n")
    assert rows(found.select("track_id", "frame", "score", "reason")) == [(0, 0, 0.5, "scored"), (0, 1, 0.5, "imputed_tail"), (0, 2, 0.5, "imputed_tail"), (0, 3, None, "past_scored_tail"), (1, 1, None, "track_has_no_scores"), (2, 2, None, "score_not_finite")]
