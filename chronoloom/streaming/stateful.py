"""Operators with a state of their own on live streams: order of arrival, stable selection.

Each keeps what it needs in keyed state (values and maps by key, in the RocksDB store) and is woken by event-time timers, so
a trigger touches what changed and what is due, not all that waits. A row is walked once the watermark has passed it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from chronoloom.operators.tracks import choose

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_keyed_state(spark: SparkSession) -> None:
    """Sets the state store that these operators need; for queries that start afterwards."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _schema(rows: DataFrame, columns: list[str], *more: T.StructField) -> T.StructType:
    return T.StructType([*[rows.schema[c] for c in columns], *more])


class InOrder(StatefulProcessor):
    """Passes rows on; one that begins before a row of an earlier trigger ends the query."""

    def __init__(self, time: str) -> None:
        self.time = time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = handle.getValueState("top", "at timestamp")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        top, new = (pd.Timestamp(self.top.get()[0]) if self.top.exists() else None), None
        for batch in rows:
            least, most = batch[self.time].min(), batch[self.time].max()
            if top is not None and least < top:
                raise ValueError(f"{key}: a row at {least} came after one at {top}")
            new = most if new is None else max(new, most)
            yield batch
        if new is not None and not pd.isna(new):
            self.top.update((new.to_pydatetime(),))

    def close(self) -> None:
        pass


def in_order(rows: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """rows, whose times may not go back from one trigger to the next within a key; within a trigger any order is fine."""
    out = T.StructType([rows.schema[c] for c in rows.columns])
    return rows.withWatermark(time, late).groupBy(*keys).transformWithStateInPandas(InOrder(time), out, "Append", "EventTime", eventTimeColumnName=time)


class Selection(StatefulProcessor):
    """The walk of tracks.stable_selection over the frames of a key, which wait by time and number until they are due."""

    def __init__(self, keys: list[str], margin: float, frames_needed: int) -> None:
        self.keys, self.margin, self.frames_needed = keys, margin, frames_needed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "scene bigint, current bigint, challenger bigint, wins bigint, walked bigint")
        self.waiting = handle.getMapState("waiting", "due bigint", "frames array<struct<at bigint, frame bigint, scene bigint, tracks array<bigint>, scores array<double>>>")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        walked = self.held.get()[4] if self.held.exists() else None
        fresh: dict[int, list[tuple]] = {}
        for batch in rows:
            # Computed columns come without their names: the last five, by place.
            for frame, scene, at, tracks, scores in zip(*[batch[c] for c in batch.columns[-5:]], strict=True):
                if walked is None or at > walked:
                    row = (int(at), int(frame), None if pd.isna(scene) else int(scene), [int(x) for x in tracks], [float(x) for x in scores])
                    fresh.setdefault(int(at) // 1000 + 1, []).append(row)
        for due, found in fresh.items():
            before = [tuple(x) for x in self.waiting.getValue((due,))[0]] if self.waiting.containsKey((due,)) else []
            self.waiting.updateValue((due,), (before + found,))
            self.handle.registerTimer(due)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        if not self.waiting.containsKey((due,)):
            return
        scene, *state, walked = self.held.get() if self.held.exists() else (None, None, None, 0, None)
        out, held = [], tuple(state)
        for at, frame, of, tracks, scores in sorted((tuple(x) for x in self.waiting.getValue((due,))[0]), key=lambda x: x[:2]):
            found = dict(zip(tracks, scores, strict=True))
            held = (None, None, 0) if of != scene or not found else held
            held = choose(found, held, self.margin, self.frames_needed) if found else held
            scene, walked = of, at
            out.append((*key, frame, of, held[0]))
        self.waiting.removeKey((due,))
        self.held.update((scene, *held, walked))
        yield pd.DataFrame(out, columns=[*self.keys, "frame", "scene", "track_id"]).astype({"scene": "Int64", "track_id": "Int64"})

    def close(self) -> None:
        pass


def stable_selection(frames: DataFrame, keys: list[str], time: str, late: str, margin: float = 0.5, frames_needed: int = 3) -> DataFrame:
    """(keys, frame, scene, track_id): the stable selection on a stream of whole frames.

    A frame is a row of keys, time, frame, scene and seen, an array of (track_id bigint, smoothed double). Frames wait
    until the watermark passes them and are then walked in order of time and frame, so what is held for a key is bounded
    by the delay. A frame before one already walked is left out. A frame without a scored face has a null track_id and,
    like a new scene, starts anew; a null scene is a scene of its own; null seen means none.
    """
    kind = frames.schema["seen"].dataType
    scored = F.filter(F.coalesce("seen", F.array().cast(kind)), lambda x: x["smoothed"].isNotNull())
    live = frames.withWatermark(time, late).withColumn("_seen", scored)
    live = live.select(
        *keys, time, F.col("frame").cast("bigint").alias("frame"), F.col("scene").cast("bigint").alias("scene"), F.unix_micros(time).alias("_at"),
        F.transform("_seen", lambda x: x["track_id"].cast("bigint")).alias("_tracks"), F.transform("_seen", lambda x: x["smoothed"].cast("double")).alias("_scores"),
    )
    number = lambda n: T.StructField(n, T.LongType())
    out = _schema(frames, keys, number("frame"), number("scene"), number("track_id"))
    return live.where("frame is not null and _at is not null").groupBy(*keys).transformWithStateInPandas(Selection(keys, margin, frames_needed), out, "Append", "EventTime")
