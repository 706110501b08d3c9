"""Running aggregates, buckets of fitting widths, islands, segmented walks, packed files, claims, engines, rules of answers."""

import json
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.operators import alignment, answers, canonical, consumers, contracts, engines, folding, fusion, intervals, observed, quality, running, tiers, tracks
from chronoloom.sources import packed

V = ["video_id"]


def test_running_aggregates_against_plain_loops(spark):
    rng = np.random.default_rng(6)
    rows = [(int(rng.integers(0, 3)), int(t), None if rng.random() < 0.3 else float(rng.integers(-9, 9))) for t in rng.choice(1000, 300, replace=False)]
    frame = spark.createDataFrame(rows, "k int, t int, x double")
    kinds = ["max", "min", "sum", "last", "first"]
    for strict in (False, True):
        for backward in (False, True):
            got = running.running(frame, ["k"], ["t"], F.floor(F.col("t") / 37), strict, backward, **{n: (n, F.col("x")) for n in kinds})
            for r in got.collect():
                seen = sorted((t, x) for k, t, x in rows if k == r["k"] and x is not None and (t == r["t"] and not strict or (t > r["t"] if backward else t < r["t"])))
                values = [x for _, x in (seen[::-1] if backward else seen)]
                want = [max(values), min(values), sum(values), values[-1], values[0]] if values else [None] * 5
                assert [r[n] for n in kinds] == want


def test_one_long_span_does_not_widen_the_buckets_of_short_ones(spark):
    long = spark.createDataFrame([(1, 0, 0.0, 1e7)], "video_id int, i int, start double, end double")
    short = spark.range(20_000).select(F.lit(1).alias("video_id"), F.col("id").alias("j"), (F.col("id") * 500.0).alias("r_start"), (F.col("id") * 500.0 + 1).alias("r_end"))
    both = long.unionByName(short.select("video_id", F.col("j").cast("int").alias("i"), F.col("r_start").alias("start"), F.col("r_end").alias("end")))
    pairs = intervals.range_join(both, short, V).count()
    # The long one meets all, each short one itself.
    assert pairs == 40_000
    assert intervals.bucket_pairs(both, short, V).count() <= 2 * pairs


def test_points_are_not_stored_at_every_level_of_the_spans(spark):
    rng = np.random.default_rng(8)
    a = [(float(s), float(s + d)) for s, d in zip(rng.uniform(0, 2e6, 600), rng.exponential(5000, 600), strict=True)]
    left = spark.createDataFrame([(1, i, *x) for i, x in enumerate(a)], "k int, i int, start double, end double")
    points = [float(t) for t in rng.uniform(0, 2e6, 3000)]
    right = spark.createDataFrame([(1, j, t, t) for j, t in enumerate(points)], "k int, j int, r_start double, r_end double")
    stored = [rows.count() for rows in intervals.bucket_rows(left, right)]
    assert stored[1] <= 2 * 3000 and sum(stored) <= 4 * 3600
    got = sorted((r["i"], r["j"]) for r in intervals.range_join(left, right, ["k"]).collect())
    assert got == sorted((i, j) for i, x in enumerate(a) for j, t in enumerate(points) if x[0] <= t <= x[1])
    assert intervals.range_join(left.where("i < 0"), right, ["k"]).count() == 0


def test_range_join_of_any_lengths_against_all_pairs(spark):
    rng = np.random.default_rng(12)
    make = lambda n: [(float(s), float(s + d)) for s, d in zip(rng.uniform(-1e4, 1e4, n), 10 ** rng.uniform(-3, 4, n), strict=True)]
    a, b = make(120), [*make(120), (5.0, 5.0)]
    left = spark.createDataFrame([(1, i, *x) for i, x in enumerate(a)] + [(1, -1, None, 3.0)], "k int, i int, start double, end double")
    right = spark.createDataFrame([(1, j, *x) for j, x in enumerate(b)], "k int, j int, r_start double, r_end double")
    for width in (0.5, 100.0):
        got = sorted((r["i"], r["j"]) for r in intervals.range_join(left, right, ["k"], width, 0.25).collect())
        assert got == sorted((i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[0] - 0.25 <= y[1] and y[0] <= x[1] + 0.25)


def test_islands_reach_over_stretches(spark):
    rng = np.random.default_rng(3)
    spans = sorted((int(s), int(s + d)) for s, d in zip(rng.integers(0, 5000, 300), rng.integers(1, 40, 300), strict=True))
    rows = spark.createDataFrame([(1, float(s), float(e), f"x{i}", i) for i, (s, e) in enumerate(spans)], "k int, start double, end double, text string, row_id int")
    want, until, at = [], None, None
    for s, e in spans:
        if until is None or s >= until:
            at, until = s, e
        until = max(until, e)
        want.append(at)
    got = [int(r["island"]) for r in intervals.overlap_islands(rows, ["k"], 11.0).orderBy("row_id").collect()]
    assert got == want
    cut = intervals.project_overlaps(rows, ["k"], 11.0).collect()
    cover = {(r["start"] + 0.5 + i): r["n_labels"] for r in cut for i in range(int(r["end"] - r["start"]))}
    assert cover == {t + 0.5: n for t in range(5100) if (n := sum(s <= t < e for s, e in spans))}


def test_selection_of_a_long_recording_is_dealt_out(spark):
    rng = np.random.default_rng(5)
    rows = [(1, f // 500 % 2, f, t, None if (f % 97 == 0) else float(rng.choice([0.0, 0.4, 1.0, 1.5]))) for f in range(3000) for t in (1, 2, 3) if rng.random() < 0.8]
    frame = spark.createDataFrame(rows, "video_id int, scene int, frame long, track_id long, score double").repartition(5)
    chosen = tracks.stable_selection(frame, V, window=1, stretch=64)
    # Runs between changes of scene and empty frames are what is dealt out: a few hundred frames of 3000 at most.
    by = frame.groupBy(*V, "scene", "frame").agg(F.collect_list(F.when(F.col("score").isNotNull(), F.col("track_id"))).alias("tracks"))
    sizes = [r["count"] for r in tracks.selection_islands(by, V, 64).groupBy(*V, "island").count().collect()]
    assert len(sizes) > 30 and max(sizes) < 300
    got = {r["frame"]: r["track_id"] for r in chosen.collect()}
    held, before, want = (None, None, 0), None, {}
    by_frame = {}
    for _, scene, f, t, s in rows:
        by_frame.setdefault(f, (scene, {}))[1].update({t: s} if s is not None else {})
    for f in sorted(by_frame):
        scene, found = by_frame[f]
        held = (None, None, 0) if scene != before or not found else held
        held = tracks.choose(found, held, 0.5, 3) if found else held
        before, want[f] = scene, held[0]
    assert got == want


def test_folding_is_pythons_on_every_code_point(spark):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    frame = spark.createDataFrame([(c, f" {chr(c)}A{chr(c)}. ") for c in points], "c int, x string").repartition(8)
    got = {r["c"]: (r["raw"], r["core"]) for r in frame.select("c", folding.raw_key(F.col("x")).alias("raw"), folding.core_text(F.col("x")).alias("core")).collect()}
    for c in points:
        raw = unicodedata.normalize("NFKC", f" {chr(c)}A{chr(c)}. ").strip().casefold()
        assert got[c] == (raw, raw.strip(folding.EDGE_MARKS))
    assert [r[0] for r in spark.createDataFrame([("...",), (None,), ("a",)], "x string").select(folding.has_core(F.col("x"))).collect()] == [False, False, True]


def test_alignment_borrows_and_hands_on(spark):
    words = spark.createDataFrame([(1, i, w, s, s and s + 0.5, st) for i, (w, s, st) in enumerate([("Hello,", 1.0, None), ("l'homme", 2.0, None), ("gone", None, "interpolated"), ("—", 4.0, None), ("end", 5.0, None)])], "s int, word_index int, word string, start double, end double, alignment_status string")
    said = ["hello", ",", "l'", "homme", "gone", "—", "nowhere", "end", "!"]
    tokens = spark.createDataFrame([(1, i, t) for i, t in enumerate(said)] + [(2, 0, "alone")], "s int, token_index int, token string")
    rows = alignment.align_tokens(tokens, words, ["s"]).orderBy("s", "token_index").collect()
    assert [(r["token_start"], r["alignment_status"], r["alignment_confidence"]) for r in rows] == [
        (1.0, "aligned", 1.0), (1.0, "approximate", 0.2), (2.0, "approximate", 0.3), (2.0, "approximate", 0.3), (None, "interpolated", 0.0), (4.0, "aligned", 1.0),
        (None, "unmatched", 0.0), (5.0, "aligned", 1.0), (5.0, "approximate", 0.2), (None, "no_timing", 0.0),
    ]


def test_packed_files_are_few_tasks(spark, tmp_path):
    for i in range(500):
        (tmp_path / f"v_{i:012d}_keypoints.json").write_text(json.dumps({"people": [{"x": i}]}))
    (tmp_path / "v_000000000999_keypoints.json").write_text("not json")
    (tmp_path / "v_000000001000_keypoints.json").write_text("[1]")
    (tmp_path / "nameless.json").write_text("{}")
    rows = packed.packed_pose_frames(spark, str(tmp_path), "people array<struct<x: int>>", tasks=3)
    assert rows.rdd.getNumPartitions() <= 3
    assert sorted((r["frame_number"], r["people"][0]["x"]) for r in rows.collect()) == [(i, i) for i in range(500)]
    assert packed.deal([("a", 10**9), ("b", 1), ("c", 1), ("d", 1)], 2) == [["a"], ["b", "c", "d"]] and packed.deal([], 4) == []
    spark.range(1000).repartition(4).write.parquet(str(tmp_path / "t"))
    counted = packed.footer_counts(spark, str(tmp_path / "t"))
    assert sum(r["rows"] for r in counted.collect()) == 1000 and counted.count() == 4
    assert "ReadSchema: struct<>" in counted._jdf.queryExecution().toString()


def test_claims_are_measured_while_a_table_is_written(spark, tmp_path):
    rows = spark.createDataFrame([(1, i, "a" if i % 3 else "b", float(s), float(e), "en" if i else " ") for i, (s, e) in enumerate([(0, 2), (1, 3), (5, 5), (4, 9)])], "video_id int, place long, tier string, start double, end double, language string")
    placed = observed.with_order(rows, V, "place", "start", "end", stretch=2)
    found = observed.write_observed(placed, str(tmp_path / "t"), observed.table_measures("start", "end", "language", "tier", ["a", "c"]))
    assert found["rows"] == 4 and spark.read.parquet(str(tmp_path / "t")).columns == rows.columns
    claims = {"min_rows": 5, "duration": 7.0, "ordered": True, "whole": True, "apart": True, "language": True, "census": {"a": 2, "c": 0}, "covered": ["a", "c"]}
    assert sorted(r for r, _, _ in observed.broken_claims(found, claims)) == ["behind", "coverage:c", "min_rows", "no_language", "no_length", "overlaps", "past_duration", "unclaimed"]
    assert observed.broken_claims(found, {"min_rows": 4, "duration": 8.0, "whole": True}) == []


def test_engines_and_providers_by_name(spark):
    turns = spark.createDataFrame([(1, 0, "a", 0.0, 2.0, 0.5)], "video_id int, turn_id int, speaker string, start double, end double, ov double")
    frames = spark.createDataFrame([(1, t / 2, 7, 1.0, True) for t in range(5)], "video_id int, t double, track_id int, score double, active boolean")
    engines.register_engine(engines.TurnTable("third", "turns_third", "ov"))
    try:
        told = engines.engine_turns({"speaker_turns": turns, "turns_third": turns}, V)
        rows = {r["engine"]: (r["agreement"], r["overlap_s"]) for r in engines.fuse_engines(told, frames, V).collect()}
        assert rows == {"pyannote": ("face_matched", None), "third": ("face_matched", 0.5)}
        assert engines.chosen_engines("third, pyannote,third") == ["third", "pyannote"]
    finally:
        del engines.TURN_TABLES["third"]
    for asked in ("third", "", []):
        with pytest.raises(ValueError, match="unknown engines"):
            engines.chosen_engines(asked)
    with pytest.raises(ValueError, match="unknown provider"):
        engines.ask(turns, "nobody")


def test_consumer_joins_refuse_other_namespaces(spark):
    for left, right in (("frame_number", "frame_25fps"), ("person_id", "track_id"), ("face_track_id", "speaker_id"), ("x", "x")):
        with pytest.raises(ValueError, match="does not join"):
            consumers.refuse(left, right)
    turns = spark.createDataFrame([(1, "s1")], "video_id int, speaker_id string")
    with pytest.raises(ValueError, match="numbered by an engine"):
        consumers.join_by_id(turns, turns, V, "speaker_id", "speaker_id")
    pose = spark.createDataFrame([(1, 0, 0.04), (1, 1, 0.08)], "video_id int, frame_number int, timestamp double")
    faces = spark.createDataFrame([(1, 0, 0.0, 0.04), (1, 1, 0.04, 0.04)], "video_id int, frame_number int, timestamp double, source_timestamp double")
    assert [r["n"] for r in consumers.pose_beside_faces(pose, faces, V).groupBy("frame_number").agg(F.count("source_timestamp").alias("n")).orderBy("frame_number").collect()] == [2, 0]
    spans = spark.createDataFrame([(1, 0.04, 0.08)], "video_id int, start_time double, end_time double")
    assert consumers.instants_in_spans(pose, spans, V).count() == 1


def test_masks_and_answers(spark):
    kind = T.StructType([T.StructField("hf_token_env", T.StringType()), T.StructField("api_key", T.StringType()), T.StructField("token", T.IntegerType()), T.StructField("inner", T.ArrayType(T.MapType(T.StringType(), T.StringType())))])
    rows = spark.createDataFrame([(("HF", "s", 5, [{"password": "p", "secret": "", "n": "v"}]),), (("HF", None, 0, None),)], T.StructType([T.StructField("c", kind)]))
    first, second = [r[0] for r in rows.select(answers.mask_secrets(F.col("c"), kind)).collect()]
    assert (first["hf_token_env"], first["api_key"], first["token"], first["inner"]) == ("HF", answers.MASK, None, [{"password": answers.MASK, "secret": "", "n": "v"}])
    assert (second["api_key"], second["token"], second["inner"]) == (None, 0, None)
    masked = lambda words: spark.range(1).select(answers.mask_command(F.array(*map(F.lit, words)))).first()[0]
    assert masked(["--api-key=zzz", "HF_TOKEN", "q"]) == ["--api-key=zzz", "HF_TOKEN", answers.MASK]
    assert masked(["run", "--token", "s", "x"]) == ["run", "--token", answers.MASK, "x"]

    said = ['{"a": 42, "b": "  padded\\u00a0 "}', '```JSON\n{"a": {"text": "", "translation": "x"}}\n```', 'Sure:\n{"a": "{not json"}\nBye.', '{"translations": {"a": "x"}, "b": "y"}', '{"a": "x", "b": null}', "[1, 2]", "null", "not json", '{"a": {"text": null}}']
    told = answers.translations(spark.createDataFrame(list(enumerate(said)), "k int, x string"), ["k"], "x")
    got = {}
    for r in told.collect():
        got.setdefault(r["k"], []).append((r["id"], r["text"], r["problem"]))
    assert sorted(got[0]) == [("a", "42", None), ("b", "padded", None)] and got[1] == [("a", "x", None)] and got[2] == [("a", "{not json", None)]
    assert got[3] == [("translations", None, "null translation")]
    assert got[4] == [("b", None, "null translation")] and got[8] == [("a", None, "null translation")]
    assert [got[k] for k in (5, 6, 7)] == [[(None, None, "not an object")], [(None, None, "not an object")], [(None, None, "not JSON")]]
    content = lambda x: spark.range(1).select(answers.message_content(F.lit(x))).first()[0]
    assert content('{"choices": [{"message": {"content": "[{\\"text\\":\\"x\\"}]"}}]}') == '[{"text":"x"}]' and content('{"choices": [{"message": {"content": " \\u00a0"}}]}') is None


def test_tiers_without_optional_tables_and_odd_values(spark):
    nan = float("nan")
    points = spark.createDataFrame([(1, 0.0, nan), (1, 1.0, 0.9), (1, 2.0, None)], "video_id int, timestamp double, confidence double")
    assert [(r["start"], r["text"]) for r in tiers.pose_presence(points, V).collect()] == [(1.0, "body present")]
    show = lambda c: spark.range(1).select(c).first()[0]
    assert show(tiers.one_line(F.lit("a   b\n"))) == "a b" and show(tiers.shown_field(F.lit("\n "))) == tiers.ABSENT
    tracks_ = spark.createDataFrame([(1, 5, 0.0, 2.0, 3, 1, 0.5)], "video_id int, track_id int, first_timestamp double, last_timestamp double, frame_count long, active_frame_count long, mean_score double")
    seen = spark.createDataFrame([(1, 7, 0, 0.0), (1, 7, 1, 0.04)], "video_id int, person_id int, frame_number long, t double")
    people = spark.createDataFrame([(1, 7, 0.9, 0.5, 0.04)], "video_id int, person_id int, mean_confidence double, frame_coverage double, longest_gap_seconds double")
    tables = {"active_speaker_tracks": tracks_, "person_frames": seen, "person_tracks": people}
    rows = tiers.build(tables, V).orderBy("tier", "start").collect()
    assert [(r["tier"], r["start"], r["end"]) for r in rows] == [("face_tracks", 0.0, 2.0), ("person_tracks", 0.0, 0.0), ("person_tracks", 0.04, 0.04)] and rows[1]["text"].endswith("no index")
    gone = tiers.skipped({"person_tracks": people})
    assert gone["person_tracks"] == "requires person_frames" and gone["words"] == "speech_words not produced" and "face_tracks" in gone
    rows = spark.range(5).select(F.lit(1).alias("video_id"), "id")
    assert [r["id"] for r in canonical.evenly_spaced(rows, V, "id", 1).collect()] == [0]


def test_every_rule_of_fused_and_posed_tables(spark):
    good = (1, 0, "pyannote", "face_matched", 5, 4, 3, 7, "as measured", 0.0, 1.0)
    columns = "video_id int, turn_id int, engine string, agreement string, frames_in_turn int, face_frames_in_turn int, face_active_frames int, face_track_id int, agreement_detail string, start double, end double"
    turns = spark.createDataFrame([(1, 0), (1, 1), (1, 5)], "video_id int, turn_id int")
    rows = spark.createDataFrame([good, (1, 1, "pyannote", "no_face_visible", 5, 5, 0, None, "", 0.0, 1.0), (1, 1, "pyannote", "no_face_visible", 5, 5, 0, None, "", 0.0, 1.0)], columns)
    found = sorted({(r["rule"], r["key"]) for r in contracts.fusion_problems(rows, turns, V, "pyannote").collect()})
    assert found == [("missing_turn", "5"), ("no_detail", "1"), ("no_face_disagrees", "1"), ("repeated_turn", "1")]
    pose = spark.createDataFrame([(0, 1.0, 1.0, "basis_ok", "basis_unusable", None, None, "", 3, "Nose"), (1, 1.0, 1.0, "basis_ok", "normalized", 0.0, 0.0, "d", 0, "Nose")], "id int, x double, y double, basis_state string, value_status string, x_norm double, y_norm double, basis_detail string, keypoint_id int, keypoint_name string")
    assert sorted(r["rule"] for r in quality.violations(pose, "id", contracts.pose_rules(whole=True)).collect()) == ["no_basis_detail", "unusable_within_ok", "wrong_name"]
    assert fusion.MIN_FACE_FRAMES == 2


def test_small_operators_that_queries_do_not_reach(spark, tmp_path):
    from chronoloom.operators import summaries, text
    from chronoloom.sources import documents

    seen = spark.createDataFrame([(1, 7, 0.0, 0.5, 0.0, 0.0, 2.0, 2.0), (1, 7, 1.0, 0.7, 0.0, 0.0, 4.0, 2.0)], "video_id int, person_id int, t double, confidence double, x1 double, y1 double, x2 double, y2 double")
    row = tracks.person_tracks(seen, V, spark.createDataFrame([(1, 4)], "video_id int, frames_measured int")).first()
    assert (row["mean_bbox_area"], row["max_bbox_area"], row["frame_coverage"]) == (6.0, 8.0, 0.5)
    probe = {"format": {"format_name": "mov", "duration": "2.0", "tags": {"title": "t", "Encoder": "e", "location": "secret"}}, "streams": [{"codec_type": "video", "width": 4, "height": 4, "r_frame_rate": "25/2", "avg_frame_rate": "0/0"}]}
    (tmp_path / "p.json").write_text(json.dumps(probe))
    row = documents.media_metadata(spark, str(tmp_path / "p.json")).first()
    assert (row["tags"], row["frame_count"]) == ({"title": "t", "Encoder": "e"}, 25)
    words = spark.createDataFrame([(1, "aligned"), (1, None), (1, "aligned")], "video_id int, alignment_status string")
    assert tuple(summaries.alignment_coverage(words, V).first()) == (1, 3, 2, 0.6667)
    segments = spark.createDataFrame([(1, "s1"), (1, "s2")], "video_id int, segment_id string")
    told = spark.createDataFrame([(1, "s1", "hi")], "video_id int, id string, text string")
    rows = canonical.translation_rows(segments, told, V, "m", "v1").orderBy("segment_id").collect()
    assert [(r["segment_id"], r["english_text"], r["translation_model"]) for r in rows] == [("s1", "hi", "m"), ("s2", None, "m")]
    second = spark.createDataFrame([(1, "s0", "n1", "speech", 0.0, 1.0)], "video_id int, speaker_id string, turn_id string, diarization_type string, start double, end double")
    fused = second.select("video_id", "turn_id", "speaker_id", "start", "end", F.lit("face_matched").alias("agreement"), F.lit("nemotron").alias("engine"), F.lit(3).alias("face_track_id"), F.lit("d").alias("agreement_detail"))
    shown = {r["tier"]: r["text"] for r in tiers.build({"speaker_turns_nemotron": second, "speaker_fusion_nemotron": fused}, V).collect()}
    assert shown == {"turns_nemotron": "speaker s0 (nemotron, speech) · n1", "fusion_nemotron": "face_matched: turn n1 · turn speaker s0 (nemotron) | face track 3 | d"}
    texts = spark.createDataFrame([(1, "  Ünï 日本  x\n"), (2, None), (3, "")], "id int, x string")
    got = [(r["word_id"], r["word"], r["character_start"], r["character_end"]) for r in text.fallback_words(texts, "id", "x").collect()]
    assert got == [("1-w00001", "Ünï", 2, 5), ("1-w00002", "日本", 6, 8), ("1-w00003", "x", 10, 11)]


def test_claims_of_person_documents(spark):
    docs = spark.createDataFrame([(1, [7, 8], 1, 2), (2, [], 0, 0)], "video_id int, person_ids array<bigint>, max_persons_in_frame int, frames_with_person int")
    frames = spark.createDataFrame([(1, 7, 0), (1, 9, 0), (1, None, 5)], "video_id int, person_id int, frame_number int")
    summary = spark.createDataFrame([(1, 7), (1, 7), (1, 9)], "video_id int, person_id int")
    found = sorted((r["rule"], r["person_id"]) for r in contracts.person_document_problems(docs, summary, frames, V).collect())
    assert found == [("declared_and_absent", 8), ("frames_with_person", None), ("max_persons_in_frame", None), ("never_declared", 9), ("summarised_twice", 7)]


def test_numbers_are_shown_as_printf_shows_them(spark):
    rng = np.random.default_rng(0)
    ties = [k / 2000 for k in range(-3000, 3000)] + [0.125, 2.675, 1.005, 0.285, 1e9 + 0.125, 4e9 + 0.5, 1e15 + 0.5, 1e-9, 123456.0005]
    values = [*ties, *rng.normal(0, 100, 500).round(4).tolist(), float("nan"), float("inf"), None]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double").coalesce(2)
    got = {r["i"]: r for r in frame.select("i", *[tiers.shown_number(F.col("x"), p).alias(f"p{p}") for p in (1, 2, 3)]).collect()}
    for i, v in enumerate(values):
        for p in (1, 2, 3):
            want = tiers.UNKNOWN if v is None or v != v or v == float("inf") else f"{v:.{p}f}"
            assert got[i][f"p{p}"] == want, (v, p)


def test_every_break_of_a_sequence(spark):
    cases = {"dense": [0, 1, 2], "gap": [0, 1, 3], "both": [-1, 0, 1], "twice": [0, 0, 2, 2], "null": [0, None], "order": [0, 2, 1], "far": [7, 8, 9, 1], "end": [0, 1, 2, 9, 5]}
    rows = spark.createDataFrame([(k, i, x) for k, v in cases.items() for i, x in enumerate(v)], "k string, place int, x int")
    got = {}
    for r in contracts.sequence_breaks(rows, ["k"], "x", "place").collect():
        got.setdefault(r["k"], []).append((r["problem"], r["rows"], r["first"], r["last"]))
    want = {}
    for k, v in cases.items():
        n = len(v)
        if None in v:
            want[k] = [("null", v.count(None), None, None)]
        elif len(set(v)) < n:
            twice = sorted({x for x in v if v.count(x) > 1})
            want[k] = [("duplicate", len(twice), twice[0], twice[-1])]
        elif sorted(v) == list(range(n)):
            bad = [i for i, x in enumerate(v) if x != i]
            want |= {k: [("out_of_order", len(bad), bad[0], bad[-1])]} if bad else {}
        else:
            lost, extra = sorted(set(range(n)) - set(v)), sorted(set(v) - set(range(n)))
            want[k] = [("missing", len(lost), lost[0], lost[-1]), ("out_of_range", len(extra), extra[0], extra[-1])]
    assert got == want
