"""Streams against the batch: segments that stream too, order, restarts, sessions, late rows."""

import random

import pytest
from pyspark.sql import functions as F

from chronoloom.streaming import frames, stateful

T0 = 1_700_000_000


def at(us):
    return F.timestamp_micros(F.col(us))


def feed(rows, folder, parts):
    """Files that are read one a trigger, in this order."""
    for k, some in enumerate(parts):
        rows(some).coalesce(1).write.parquet(f"{folder}/{k}")
    spark = rows(parts[0]).sparkSession
    return spark.readStream.schema(rows(parts[0]).schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(folder))


def run(live, name, folder, mode="append"):
    query = live.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", f"{folder}/state-{name}").trigger(availableNow=True).start()
    try:
        assert query.awaitTermination(180)
    finally:
        query.stop()
    return live.sparkSession.table(name).collect(), query


def test_streamed_segments_meet_streamed_frames(spark, tmp_path):
    draw = random.Random(3)
    seen = [(draw.randrange(2), i, T0 * 10**6 + i * 500_000 + draw.randrange(400_000)) for i in range(400)]
    said = [(i % 2, i, T0 * 10**6 + i * 5_000_000, T0 * 10**6 + i * 5_000_000 + draw.randrange(12_000_000)) for i in range(40)]
    make_frames = lambda rows: spark.createDataFrame(rows, "video_id int, frame int, us long").select("video_id", "frame", at("us").alias("ts"))
    make_segments = lambda rows: spark.createDataFrame(rows, "video_id int, segment_id int, a long, b long").select("video_id", "segment_id", at("a").alias("start"), at("b").alias("end"))
    # Triggers in order, rows within one in any.
    cut = lambda rows, n: [draw.sample(rows[k : k + n], len(rows[k : k + n])) for k in range(0, len(rows), n)]
    live = frames.frames_in_live_segments(
        feed(make_frames, tmp_path / "f", cut(seen, 40)), feed(make_segments, tmp_path / "s", cut(said, 4)), ["video_id"], "ts", "30 seconds", "15 seconds", width=7.0
    )
    got, query = run(live, "met", tmp_path)
    want = sorted((v, f, s) for v, f, t in seen for w, s, a, b in said if v == w and a <= t <= b)
    assert sorted((r["video_id"], r["frame"], r["segment_id"]) for r in got) == want
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    # Of 400 frames in 200 s and 40 segments in several buckets, the two delays (45 s) and a trigger's rows are held.
    assert max(held) < 260 and held[-1] < 200


def test_a_segment_beyond_the_longest_ends_the_query(spark, tmp_path):
    make_frames = lambda rows: spark.createDataFrame(rows, "video_id int, us long").select("video_id", at("us").alias("ts"))
    make_segments = lambda rows: spark.createDataFrame(rows, "video_id int, a long, b long").select("video_id", at("a").alias("start"), at("b").alias("end"))
    live = frames.frames_in_live_segments(
        feed(make_frames, tmp_path / "f", [[(1, T0 * 10**6)]]), feed(make_segments, tmp_path / "s", [[(1, T0 * 10**6, (T0 + 60) * 10**6)]]), ["video_id"], "ts", "1 second", "15 seconds"
    )
    with pytest.raises(Exception, match="longer than 15 seconds"):
        run(live, "long", tmp_path)


def test_rows_that_go_back_end_the_query(spark, tmp_path):
    stateful.use_keyed_state(spark)
    make = lambda rows: spark.createDataFrame(rows, "video_id int, us long").select("video_id", at("us").alias("ts"))
    second = lambda *s: [(1, (T0 + x) * 10**6) for x in s]
    got, _ = run(stateful.in_order(feed(make, tmp_path / "a", [second(3, 1, 2), second(3, 9), second(20)]), ["video_id"], "ts", "1 minute"), "ordered", tmp_path)
    assert len(got) == 6
    with pytest.raises(Exception, match="came after"):
        run(stateful.in_order(feed(make, tmp_path / "b", [second(1, 5), second(4)]), ["video_id"], "ts", "1 minute"), "disordered", tmp_path)


def test_selection_goes_on_after_a_restart(spark, tmp_path):
    stateful.use_keyed_state(spark)
    draw = random.Random(8)
    rows = [(v, 0, f, (5_000 + f * 40) * 1000, [(t, draw.choice([0.0, 0.4, 1.0, 1.5])) for t in (1, 2, 3)]) for f in range(90) for v in (1, 2)] + [(3, 0, 0, 99_000_000, None)]
    make = lambda some: spark.createDataFrame(some, "video_id int, scene int, frame long, us long, seen array<struct<track_id: long, smoothed: double>>").select("video_id", "scene", "frame", at("us").alias("ts"), "seen")

    def started(folder, parts, name):
        """One query a part: each is a new start from the checkpoint."""
        out = []
        for k, some in enumerate(parts):
            make(some).coalesce(1).write.parquet(f"{folder}/in/{k}")
            live = spark.readStream.schema(make(some).schema).option("recursiveFileLookup", True).parquet(f"{folder}/in")
            chosen = stateful.stable_selection(live, ["video_id"], "ts", "1 second")
            query = chosen.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/out").trigger(availableNow=True).start()
            assert query.awaitTermination(180)
        out = spark.read.parquet(f"{folder}/out").where("video_id < 3").collect()
        return sorted((r["video_id"], r["frame"], r["track_id"]) for r in out)

    whole = started(tmp_path / "one", [rows], "one")
    assert len(whole) == 180
    assert started(tmp_path / "three", [rows[:50], rows[50:120], rows[120:]], "three") == whole


def test_sessions_static_segments_and_late_rows(spark, tmp_path):
    rows = [(1, f, T0 * 10**6 + f * 1_000_000 + (30_000_000 if f >= 10 else 0)) for f in range(20)] + [(2, 0, T0 * 10**6)]
    make = lambda some: spark.createDataFrame(some, "video_id int, frame int, us long").select("video_id", "frame", at("us").alias("ts"))
    parts = [rows[:12], rows[12:], [(9, 0, (T0 + 900) * 10**6)]]
    live = lambda name: feed(make, tmp_path / name, parts)
    got, _ = run(frames.sessions(live("a"), "ts", ["video_id"], "5 seconds", "10 seconds"), "sessions", tmp_path)
    batch = frames.sessions(make(rows), "ts", ["video_id"], "5 seconds", "10 seconds")
    assert sorted(map(tuple, got)) == sorted(map(tuple, batch.collect())) and len(got) == 3
    said = spark.createDataFrame([(1, 7, 3.0, 12.0), (1, 8, 45.0, 46.0), (2, 9, -5.0, 0.0)], "video_id int, segment_id int, a double, b double")
    said = said.select("video_id", "segment_id", *[F.timestamp_micros(((F.col(c) + T0) * 10**6).cast("long")).alias(n) for c, n in (("a", "start"), ("b", "end"))])
    got, _ = run(frames.frames_in_segments(live("b"), said, ["video_id"], "ts", "1 minute", width=4.0), "static", tmp_path)
    want = [(v, f, s) for v, f, us in rows for w, s, a, b in [(1, 7, 3, 12), (1, 8, 45, 46), (2, 9, -5, 0)] if v == w and a <= us / 10**6 - T0 <= b]
    assert sorted((r["video_id"], r["frame"], r["segment_id"]) for r in got) == sorted(want)
    disordered = [[(1, 0, T0 * 10**6), (1, 1, (T0 + 5) * 10**6)], [(1, 2, (T0 + 3) * 10**6), (1, 3, (T0 + 6) * 10**6)]]
    got, _ = run(frames.late_frames(feed(make, tmp_path / "c", disordered), "ts", ["video_id"], "1 minute"), "late", tmp_path, "update")
    assert max((r["frames"], r["out_of_order"]) for r in got) == (4, 1)
