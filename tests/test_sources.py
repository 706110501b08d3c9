"""Raw sources, sinks and streams over small files."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.operators import pose, tracks
from chronoloom.sources import raw
from chronoloom.streaming import frames, stateful


def test_rttm_round_trip(spark, tmp_path):
    turns = spark.createDataFrame([("v", "a", 0.5, 2.0), ("v", "b", 2.0, 3.25)], "video_id string, speaker string, start double, end double")
    raw.write_rttm(turns, str(tmp_path / "r"))
    (tmp_path / "r" / "bad.txt").write_text("SPEAKER v 1 x 1.0 <NA> <NA> a\nOTHER v\nSPEAKER v 1\n")
    got = sorted((r["start"], r["duration"], r["speaker"]) for r in raw.rttm(spark, str(tmp_path / "r")).collect())
    assert got == [(0.5, 1.5, "a"), (2.0, 1.25, "b")]


def test_acoustic_lines(spark, tmp_path):
    lines = ['{"step": 0.01}', '{"frame": [0.0, 120.5, -30, true, 500, null, "x"]}', "[0.01, null, -40, false]", "[null, 1]", '{"silences": [[0, 1]]}']
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    got = raw.acoustic_frames(spark, str(tmp_path / "a.jsonl")).orderBy("timestamp").collect()
    assert [(r["timestamp"], r["f0_hz"], r["voiced"], r["f3_hz"]) for r in got] == [(0.0, 120.5, True, None), (0.01, None, False, None)]


def test_turns_prefer_the_exclusive_timeline(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"turns": [[0, 1, "x"]], "exclusive_turns": [[2, 3, "b"], [1], [0, 1, "a"]]}))
    got = raw.diarization_turns(spark, str(tmp_path / "d.json")).orderBy("start").collect()
    assert [(r["turn_id"], r["speaker"]) for r in got] == [("turn000001", "a"), ("turn000003", "b")]


def test_conform_adds_drops_and_casts(spark, tmp_path):
    schema = T.StructType([T.StructField("video_id", T.StringType()), T.StructField("n", T.LongType()), T.StructField("missing", T.DoubleType())])
    rows = spark.createDataFrame([("v", "7", 1), ("w", "junk", 2)], "video_id string, n string, other int")
    raw.write_table(rows, schema, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t")).orderBy("video_id").collect()
    assert [(r["n"], r["missing"]) for r in back] == [(7, None), (None, None)]
    assert raw.inventory(spark, str(tmp_path / "t"), ("parquet",)).count() == 2


def test_streamed_windows_equal_the_batch(spark, tmp_path):
    rows = spark.range(200).select((F.col("id") % 3).alias("video_id"), F.timestamp_millis(F.col("id") * 37).alias("ts"), F.col("id").alias("x"))
    rows.write.parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    args = ("ts", ["video_id"], "100 milliseconds", "1 hour", F.sum("x").alias("x"))
    query = frames.windows(live, *args).writeStream.outputMode("complete").format("memory").queryName("win").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert sorted(map(tuple, spark.table("win").collect())) == sorted(map(tuple, frames.windows(rows, *args).collect()))


def streamed(spark, rows, folder, name, make):
    """Rows of a query over files that arrive one at a time."""
    for k, part in enumerate(rows):
        part.coalesce(1).write.parquet(f"{folder}/{name}/{k}")
    stateful.use_keyed_state(spark)
    live = spark.readStream.schema(rows[0].schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).option("latestFirst", False).parquet(f"{folder}/{name}")
    query = make(live).writeStream.outputMode("append").format("memory").queryName(name).trigger(availableNow=True).start()
    try:
        assert query.awaitTermination(120)
    finally:
        query.stop()
    return spark.table(name)


def test_streamed_selection_equals_the_batch(spark, tmp_path):
    import random

    draw, data = random.Random(5), []
    for video in (1, 2):
        for frame in range(60):
            data += [(video, frame // 25, frame, t, draw.choice([0.0, 0.4, 1.0, 1.5, None])) for t in (1, 2, 3) if draw.random() < 0.7]
    batch = tracks.stable_selection(spark.createDataFrame(data, "video_id int, scene int, frame long, track_id long, score double"), ["video_id"], window=1)
    by_frame = {(v, f): [] for v in (1, 2) for f in range(60)}
    for v, _, f, t, s in data:
        by_frame[v, f].append((t, s))
    whole = [(v, f // 25, f, 5_000_000 + f * 40_000, seen or None) for (v, f), seen in by_frame.items()]
    draw.shuffle(whole)
    whole.sort(key=lambda r: r[2] // 8)  # within eight frames they arrive in any order
    whole.append((3, None, 999, 999 * 40_000, None))
    frame = lambda rows: spark.createDataFrame(rows, "video_id int, scene int, frame long, us long, seen array<struct<track_id: long, smoothed: double>>").select("video_id", "scene", "frame", F.timestamp_micros("us").alias("ts"), "seen")
    parts = [frame(whole[:40]), frame(whole[40:90]), frame(whole[90:]), frame([(1, 0, 3, 5_120_000, None)])]
    got = streamed(spark, parts, tmp_path, "selection", lambda live: stateful.stable_selection(live, ["video_id"], "ts", "1 second"))
    rows = got.collect()
    assert len(rows) == 120 and {(r.video_id, r.frame) for r in rows} == set(by_frame)
    want = sorted((r.video_id, r.scene, r.frame, r.track_id) for r in batch.collect() if r.track_id is not None)
    assert sorted((r.video_id, r.scene, r.frame, r.track_id) for r in rows if r.track_id is not None) == want


def test_streamed_pose_equals_the_batch(spark, tmp_path):
    points = spark.range(400).select((F.col("id") % 2).alias("video_id"), F.timestamp_millis((F.col("id") / 20).cast("int") * 40 + 5000).alias("ts"), (F.col("id") % 10).cast("int").alias("keypoint_id"), (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 11).cast("double").alias("y"), F.lit(1.0).alias("score"))
    last = points.limit(1).withColumn("ts", F.timestamp_millis(F.lit(90_000)))
    got = streamed(spark, [points.where("ts < timestamp_millis(5300)"), points.where("ts >= timestamp_millis(5300)"), last], tmp_path, "pose", lambda live: frames.normalized_pose(live, ["video_id"], "ts", "1 second"))
    want = pose.normalize(points, ["video_id", "ts"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 400
