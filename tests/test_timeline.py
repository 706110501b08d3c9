"""Timeline operators on hand-made rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoloom.operators import acoustic, fusion, intervals, pose, runs, text, tracks

V = ["video_id"]


def turns(spark, rows):
    return spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], "video_id int, turn_id long, speaker string, start double, end double")


def segments(spark, rows):
    return spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], "video_id int, segment_id long, start double, end double")


@pytest.mark.parametrize(
    ("span", "expected"),
    [((0.0, 10.0), ("a", 6.0, 0.6, "max_overlap")), ((20.0, 21.0), (None, 0.0, 0.0, "no_overlap")), ((3.0, None), ("a", 0.0, 1.0, "point_containment")), ((6.0, 8.0), ("b", 2.0, 1.0, "max_overlap")), ((10.0, 12.0), (None, 0.0, 0.0, "no_overlap"))],
)
def test_assignment(spark, span, expected):
    said = turns(spark, [("a", 0.0, 4.0), ("b", 6.0, 10.0), ("a", 4.0, 6.0), ("c", 9.0, None)])
    (row,) = intervals.assign_speakers(segments(spark, [span]), said, V, "segment_id", width=3.0).collect()
    assert (row["speaker"], row["overlap_seconds"], row["overlap_ratio"], row["method"]) == expected


def test_assignment_ties_go_to_the_first_turn(spark):
    said = turns(spark, [("b", 0.0, 1.0), ("b", 5.0, 6.0), ("a", 6.0, 7.0)])
    (row,) = intervals.assign_speakers(segments(spark, [(5.0, 7.0)]), said, V, "segment_id").collect()
    assert (row["speaker"], row["runner_up"]) == ("b", "a")


def test_range_join_against_all_pairs(spark):
    rng = np.random.default_rng(7)
    a, b = ([(float(s), float(s + d)) for s, d in zip(rng.uniform(-50, 50, 80), rng.exponential(6, 80), strict=True)] for _ in range(2))
    left = spark.createDataFrame([(1, i, *x) for i, x in enumerate(a)], "k int, i int, start double, end double")
    right = spark.createDataFrame([(1, j, *x) for j, x in enumerate(b)], "k int, j int, r_start double, r_end double")
    got = sorted((r["i"], r["j"]) for r in intervals.range_join(left, right, ["k"], 4.0).collect())
    assert got == sorted((i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[0] <= y[1] and y[0] <= x[1])


def test_coverage_of_stacked_turns(spark):
    (row,) = intervals.coverage(turns(spark, [("a", 0.0, 10.0), ("b", 2.0, 4.0), ("c", 3.0, 5.0), ("d", 20.0, 21.0)]), V).collect()
    assert (row["speaker_seconds"], row["overlap_seconds"], row["deepest"], row["speaker_time"]) == (11.0, 3.0, 3, 15.0)


def test_overlap_projection(spark):
    rows = spark.createDataFrame([(1, 0.0, 4.0, "x", 1), (1, 2.0, 6.0, "y", 2), (2, 0.0, 1.0, "z", 1), (2, 1.0, 2.0, "z", 2)], "video_id int, start double, end double, text string, row_id int")
    got = sorted((r["video_id"], r["start"], r["end"], r["value"]) for r in intervals.project_overlaps(rows, V, 3.0).collect())
    assert got == [(1, 0.0, 2.0, "x"), (1, 2.0, 4.0, '["x","y"]'), (1, 4.0, 6.0, "y"), (2, 0.0, 1.0, "z"), (2, 1.0, 2.0, "z")]


@pytest.mark.parametrize(
    ("frames", "state", "track"),
    [([], "no_frames_measured", None), ([(1.0, None, None, False)], "no_face_visible", None), ([(1.0, 5, 0.1, False)], "face_never_active", None), ([(1.0, 5, 0.9, True), (2.0, 5, 0.8, True), (2.5, 4, 0.9, True)], "face_matched", 5), ([(1.0, 5, 0.9, True)], "face_partial", 5)],
)
def test_fusion_states(spark, frames, state, track):
    seen = spark.createDataFrame([(1, *f) for f in frames], "video_id int, t double, track_id long, score double, active boolean")
    (row,) = fusion.fuse(turns(spark, [("a", 0.0, 3.0)]), seen, V, "turn_id").collect()
    assert (row["agreement"], row["face_track_id"]) == (state, track)


def test_statistics_skip_what_is_not_finite(spark):
    rows = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (float("inf"),), (None,)], "x double").withColumn("x", acoustic.finite(F.col("x")))
    assert tuple(rows.agg(*acoustic.statistics("x", "x")).first()) == (2.0, 2.0, 1.0, 3.0, 1.0)


def test_silences_keep_edges_and_drop_blips(spark):
    frames = spark.createDataFrame([(1, k / 10, k < 3 or k == 5 or k > 7) for k in range(11)], "video_id int, t double, quiet boolean")
    got = sorted((r["start"], r["end"]) for r in runs.silences(frames, V, "t", F.col("quiet"), 0.3).collect())
    assert got == [(0.0, 0.3), (0.8, 1.1)]


def test_windows_refuse_thin_cells(spark):
    rows = spark.createDataFrame([(1, 0.0, 1.0), (1, 0.5, None), (1, 1.0, None), (1, 1.5, None), (1, 2.0, 4.0), (1, 2.5, 6.0)], "video_id int, t double, x double")
    cells = {r["slot"]: r["value"] for r in runs.fixed_windows(rows, V, "t", "x", 1.0).collect()}
    assert cells == {0: 1.0, 1: None, 2: 4.0}


def test_nearest_takes_the_earlier_of_a_tie(spark):
    probes = spark.createDataFrame([(1, 5, 2.0), (1, 6, 9.0), (1, 7, -1.0)], "video_id int, id long, t double")
    marks = spark.createDataFrame([(1, 1.0, 10), (1, 3.0, 11)], "video_id int, mt double, m long")
    assert {r["id"]: r["nearest_value"] for r in runs.nearest(probes, marks, V, "t", "mt", "m").collect()} == {5: 10, 6: 11, 7: 10}


def test_pose_frame_of_the_body(spark):
    points = spark.createDataFrame([(1, 8, 1.0, 1.0, 1.0), (1, 1, 1.0, 3.0, 1.0), (1, 4, 0.0, 2.0, 1.0), (2, 8, 1.0, 1.0, 1.0), (2, 1, 1.0, 1.0, 1.0), (3, 1, 2.0, 2.0, 1.0)], "f int, keypoint_id int, x double, y double, score double")
    got = {(r["f"], r["keypoint_id"]): (r["basis_state"], r["value_status"], r["x_norm"], r["y_norm"]) for r in pose.normalize(points, ["f"]).collect()}
    assert got[1, 8] == ("basis_ok", "normalized", 0.0, 0.0) and got[1, 1] == ("basis_ok", "normalized", 1.0, 0.0)
    assert got[1, 4][1] == "no_coordinate" and got[2, 1][0] == "basis_degenerate" and got[3, 1][0] == "basis_missing_joint"


def test_selection_needs_a_lasting_lead(spark):
    scores = {1: [1, 1, 1, 1, 1, 1, 1, 1], 2: [0, 2, 0, 2, 2, 2, 2, 2]}
    rows = [(1, 0, k, t, float(s)) for t, x in scores.items() for k, s in enumerate(x)]
    frame = spark.createDataFrame(rows, "video_id int, scene int, frame long, track_id long, score double")
    got = [r["track_id"] for r in tracks.stable_selection(frame, V, window=1).orderBy("frame").collect()]
    assert got == [1, 1, 1, 1, 1, 2, 2, 2]


def test_words_shapes_and_names(spark):
    rows = spark.createDataFrame([(1, "ab  cd\n12")], "id long, text string")
    assert [(r["word_id"], r["word"], r["character_start"], r["character_end"]) for r in text.fallback_words(rows, "id", "text").collect()] == [("1-w00001", "ab", 0, 2), ("1-w00002", "cd", 4, 6), ("1-w00003", "12", 7, 9)]
    shapes = spark.createDataFrame([("Xd1",), ("ABCDEFGHIJKLMN",)], "w string").select(text.word_shape(F.col("w"))).collect()
    assert [r[0] for r in shapes] == ["Xxd", "XXXXXXXXXXXX…"]
    names = spark.createDataFrame([("a/My clip.mp4",), ("b/my_clip.mov",), ("c/日本.mp4",)], "path string")
    ids = {r["path"]: r["video_id"] for r in text.unique_slugs(names, "path").collect()}
    assert ids["c/日本.mp4"] == "video" and ids["a/My clip.mp4"].startswith("My_clip-") and ids["b/my_clip.mov"].startswith("my_clip-")


def made_events(spark, rows, folder):
    """Event rows (user, type, seconds, value), in their order, as a table that both Spark and SQL read."""
    frame = spark.createDataFrame([(i, *r, '{"k": 1}') for i, r in enumerate(rows)], "event_id long, user_id long, event_type string, at double, value double, props string")
    frame = frame.select("event_id", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(at AS DECIMAL(18, 6)))").alias("ts"), "user_id", "event_type", "value", "props")
    frame.coalesce(1).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def against_sql(spark, name, folder):
    import duckdb

    from chronoloom.plans import contracts, registry, timeline  # noqa: F401

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute("SET threads = 1")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    found = registry.queries()[name](spark, folder)
    want = con.execute(registry.oracle_sql()[name])
    assert found.columns == [d[0] for d in want.description]
    order = lambda rows: sorted((tuple(r) for r in rows), key=repr)
    got = order(found.collect())
    assert got == order(want.fetchall())
    return got


def test_equal_scores_choose_as_sql_does(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(int(rng.integers(0, 24)), str(rng.choice(["click", "error", "view"])), float(t), float(rng.integers(8, 14) * 10)) for t in np.sort(rng.uniform(0, 400_000, 1500)).round(3)]
    got = against_sql(spark, "frame_document", made_events(spark, rows, tmp_path))
    assert sum(r[4] == "tracked" for r in got) > 100


def test_a_span_of_no_length_overlaps_nobody_as_in_sql(spark, tmp_path):
    rows = [(1, "view", 0.0, 1.0), (2, "view", 10.0, 1.0), (1, "click", 50.0, 0.0), (1, "purchase", 50.0, 0.0), (1, "click", 50.0, 0.3), (1, "click", 500.0, 0.0)]
    got = against_sql(spark, "speaker_assignment", made_events(spark, rows, tmp_path))
    assert {r[1]: r[7] for r in got} == {2: "no_overlap", 3: "point_containment", 4: "max_overlap", 5: "no_overlap"}
