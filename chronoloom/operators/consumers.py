"""Joins that readers of the tables make, by name, and a refusal of those that would mix namespaces.

A track of faces, a person, a speaker of one engine, a frame of the source and a frame of the working grid are numbered
independently: equal numbers say nothing. Every joinable column has a namespace; two columns are joined only within one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.operators.intervals import range_join

#: The namespace of each column of the tables.
NAMESPACES = {
    "track_id": "face track", "face_track_id": "face track", "person_id": "person", "speaker_id": "speaker of an engine", "segment_id": "transcript segment", "turn_id": "turn of an engine",
    "frame_number": "source frame", "frame_25fps": "grid frame", "timestamp": "time of the table's own clock", "source_timestamp": "source time", "pts_seconds": "source time",
}
#: Columns that are a source time under another name in one table.
SOURCE_TIME = {"pose": "timestamp"}


def refuse(left: str, right: str) -> None:
    """Raises where columns of two namespaces would be joined, or of none that is known."""
    known = [NAMESPACES.get(c) for c in (left, right)]
    if None in known or known[0] != known[1]:
        raise ValueError(f"{left!r} ({known[0]}) does not join {right!r} ({known[1]})")


def join_by_id(left: DataFrame, right: DataFrame, keys: list[str], left_on: str, right_on: str, engine: str | None = None) -> DataFrame:
    """left with right where keys and ids agree. Speakers and turns are numbered by an engine, so both sides need its column."""
    refuse(left_on, right_on)
    own = [engine] if engine else []
    if "engine" in NAMESPACES[left_on] and not own:
        raise ValueError(f"{left_on!r} is numbered by an engine: name the column that tells engines apart")
    moved = right.withColumnsRenamed({right_on: left_on})
    return left.join(moved, [*keys, *own, left_on], "left")


def faces_of_turns(fused: DataFrame, tracks: DataFrame, keys: list[str]) -> DataFrame:
    """Fused turns with the summary of the face that speaks in them."""
    return join_by_id(fused, tracks, keys, "face_track_id", "track_id")


def pose_beside_faces(pose: DataFrame, faces: DataFrame, keys: list[str], decimals: int = 6) -> DataFrame:
    """Key points with the rows of the working grid that map to their source frame; several rows may, and all are kept."""
    at = F.round("source_timestamp", decimals)
    marked = faces.withColumnsRenamed({c: f"face_{c}" for c in faces.columns if c in pose.columns and c not in keys}).withColumn("_at", at)
    return pose.withColumn("_at", F.round(SOURCE_TIME["pose"], decimals)).join(marked, [*keys, "_at"], "left").drop("_at")


def instants_in_spans(instants: DataFrame, spans: DataFrame, keys: list[str], time: str = "timestamp") -> DataFrame:
    """Instants with the spans (start_time, end_time) that hold them, start included and end not."""
    cut = spans.withColumns({"r_start": F.col("start_time"), "r_end": F.col("end_time")})
    points = instants.withColumns({"start": F.col(time), "end": F.col(time)})
    return range_join(points, cut, keys).where((F.col(time) >= F.col("r_start")) & (F.col(time) < F.col("r_end"))).drop("start", "end", "r_start", "r_end")
