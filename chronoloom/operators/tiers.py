"""Annotation tiers: what each table says on the timeline, as rows (keys, row_id, start, end, text), and their export.

A tier is a function of DataFrames; TIERS names the builders in their order of export. Times stay in seconds until the
export, which places them in milliseconds, refuses rows without a usable time (counted by reason), and cuts tiers whose
rows overlap at every endpoint.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.operators import runs, tracks
from chronoloom.operators.folding import BLANKS
from chronoloom.operators.intervals import project_overlaps
from chronoloom.shared import written

#: What a label prints for a value that is not known, for one that is known to be absent, and for no text.
UNKNOWN, ABSENT, EMPTY = "unknown", "none", "(empty)"
#: Seconds before zero that count as rounding, and the shortest annotation in milliseconds.
NEGATIVE_TOLERANCE, SHORTEST_MS = 0.0005, 1
#: Names of the semitones of an octave; widths of the bands of three formants in Hz; of one of intensity in dB.
SEMITONES = ["C", "C#", "D", "D#", "E", "F", "F#", "G", "G#", "A", "A#", "B"]
FORMANT_BANDS, INTENSITY_STEP = (300, 600, 1000), 2
#: Confidence from which a key point shows that a body is present; seconds of one window of the acoustic tiers.
PRESENT, WINDOW_SECONDS = 0.3, 0.1
#: Reasons for which a face that was seen has no score.
UNSCORED = ["score_not_finite", "track_has_no_scores", "tail_score_not_finite", "past_scored_tail", "unknown"]


def one_line(text: Column) -> Column:
    """Text on one line; a marker where there is none."""
    flat = F.trim(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), f"[{BLANKS}]+", " "))
    return F.when(F.length(flat) > 0, flat).otherwise(EMPTY)


def shown_number(value: Column, places: int) -> Column:
    """A number with up to five fixed decimals; unknown for null, NaN and infinities.

    Rounded by the binary value itself, as printf does, and to even where that lies just between: the shortest decimal of a
    double decides unless it is a tie, and then the fraction left after scaling by a power of two, which is exact, tells on which
    side of the tie the double lies.
    """
    x = value.cast("double")
    size = F.abs(x)
    plain = F.format_string(f"%.{places}f", x)
    shortest = F.when(size < 2.0**32, size).cast("decimal(24,12)")
    steps = shortest * F.lit(2 * 10**places)
    tie = (steps == F.floor(steps)) & (F.floor(steps) % 2 == 1)
    scaled = F.when(size < 2.0**32, size * 2.0**30)
    whole = F.floor(scaled)
    over = (scaled - whole).cast("decimal(24,20)") - (shortest * F.lit(1 << 30) - whole.cast("decimal(20,0)"))
    up = F.round(shortest, places)
    settled = F.when(F.abs(over) < F.lit(1e-12).cast("decimal(14,13)"), F.bround(shortest, places)).when(over > 0, up).otherwise(up - F.lit(10**-places).cast(f"decimal(10,{places})"))
    sign = F.when(x < 0, "-").otherwise("")
    shown = F.when(tie, F.concat(sign, settled.cast(f"decimal(24,{places})").cast("string"))).otherwise(plain)
    return F.when(x.isNotNull() & ~F.isnan(x) & (size != float("inf")), shown).otherwise(UNKNOWN)


def shown_id(value: Column) -> Column:
    flat = one_line(value)
    return F.when(flat != EMPTY, flat).otherwise(UNKNOWN)


def shown_field(value: Column, null_is_answer: bool = False) -> Column:
    """A text that may be known to be absent: blank always is, null where the column says so."""
    return F.when(value.isNull(), ABSENT if null_is_answer else UNKNOWN).when(F.length(F.btrim(value.cast("string"), F.lit(BLANKS))) == 0, ABSENT).otherwise(one_line(value))


def seconds_to_ms(seconds: Column, end: bool = False) -> Column:
    """Half up, not below zero; an end at zero is the shortest span."""
    ms = F.greatest(F.floor(F.coalesce(seconds, F.lit(0.0)) * 1000 + 0.5), F.lit(0)).cast("bigint")
    return F.when(ms == 0, F.lit(SHORTEST_MS).cast("bigint")).otherwise(ms) if end else ms


def refusal(start: Column, end: Column) -> Column:
    """Why an interval cannot be placed: missing_time (null or before zero), non_finite, or null if it can."""
    odd = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    early = (start < -NEGATIVE_TOLERANCE) | (end < -NEGATIVE_TOLERANCE)
    return F.when(start.isNull() | end.isNull(), "missing_time").when(odd(start) | odd(end), "non_finite").when(early, "missing_time")


def pitch_label(hertz: Column) -> Column:
    """The semitone bin that holds a pitch, A4 at 440 Hz."""
    midi = F.floor(12 * F.log2(hertz / 440.0) + 69).cast("int")
    names = F.array(*[F.lit(x) for x in SEMITONES])
    return F.concat(F.get(names, F.pmod(midi, F.lit(12))), (F.floor(midi / 12) - 1).cast("string"))


def intensity_label(decibel: Column) -> Column:
    low = (F.floor(decibel / INTENSITY_STEP) * INTENSITY_STEP).cast("bigint")
    return F.concat(low.cast("string"), F.lit(" to "), (low + INTENSITY_STEP).cast("string"), F.lit(" dB"))


def formant_label(f1: Column, f2: Column, f3: Column) -> Column:
    parts = [F.concat(F.lit(f"F{i + 1}~"), (F.floor(x / band) * band).cast("bigint").cast("string"), F.lit("Hz")) for i, (band, x) in enumerate(zip(FORMANT_BANDS, (f1, f2, f3), strict=True))]
    return F.concat_ws(" ", *parts)


def speaking_label(active: Column, status: Column, reason: Column, track: Column, imputed: Column) -> Column:
    """One frame's reading: no face, then a face without a score, then what the score says and whether it was carried on."""
    false = F.lit(False)
    carried = F.when(F.coalesce(imputed, false) | F.coalesce(reason == "imputed_tail", false), " (imputed score)").otherwise("")
    speaks = F.when(track.isNotNull(), F.concat(F.lit("speaking track "), track.cast("string"))).otherwise("speaking")
    return (
        F.when(F.coalesce(reason == "no_face", false) | F.coalesce(status == "no_face", false), "no face")
        .when(F.coalesce(status == "tracked_unscored", false) | F.coalesce(reason.isin(*UNSCORED), false), "not evaluated")
        .otherwise(F.concat(F.when(F.coalesce(active, false), speaks).otherwise("not speaking"), carried))
    )


def _tier(rows: DataFrame, keys: list[str], row_id: str, start: str, end: str, text: Column) -> DataFrame:
    return rows.select(*keys, F.col(row_id).cast("string").alias("row_id"), F.col(start).cast("double").alias("start"), F.col(end).cast("double").alias("end"), one_line(text).alias("text"))


def words(rows: DataFrame, keys: list[str]) -> DataFrame:
    text = F.concat(F.coalesce("word", F.lit("None")), F.lit(" · "), shown_id(F.col("speaker_id")), F.lit(" · "), shown_id(F.col("word_id")), F.lit(" · ["), shown_id(F.col("segment_id")), F.lit("]"))
    return _tier(rows, keys, "word_id", "start", "end", text)


def segments(rows: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """Source segments; with text_col="english_text" their translations."""
    text = F.concat(shown_id(F.col("speaker_id")), F.lit(": "), F.coalesce(text_col, F.lit("None")), F.lit(" · ["), shown_id(F.col("segment_id")), F.lit("]"))
    return _tier(rows, keys, "segment_id", "start", "end", text)


def turns(rows: DataFrame, keys: list[str], engine: str) -> DataFrame:
    text = F.concat(F.lit("speaker "), shown_id(F.col("speaker_id")), F.lit(f" ({engine}, "), shown_id(F.col("diarization_type")), F.lit(") · "), shown_id(F.col("turn_id")))
    return _tier(rows, keys, "turn_id", "start", "end", text)


def fusion(rows: DataFrame, keys: list[str]) -> DataFrame:
    text = F.concat(
        F.coalesce("agreement", F.lit("None")), F.lit(": turn "), shown_id(F.col("turn_id")), F.lit(" · turn speaker "), shown_id(F.col("speaker_id")), F.lit(" ("), shown_id(F.col("engine")),
        F.lit(") | face track "), shown_id(F.col("face_track_id")), F.lit(" | "), F.coalesce("agreement_detail", F.lit("None")),
    )
    return _tier(rows, keys, "turn_id", "start", "end", text)


def _blocks(found: DataFrame, keys: list[str], text: Column) -> DataFrame:
    return _tier(found.withColumn("_row", F.concat(F.lit("at "), F.col("start").cast("string"))), keys, "_row", "start", "end", text)


def speaking(frames: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of equal readings of frames (timestamp, is_active_speaker, face_status, frame_reason, track_id, score_imputed)."""
    label = speaking_label(F.col("is_active_speaker"), F.col("face_status"), F.col("frame_reason"), F.col("track_id"), F.col("score_imputed"))
    return _blocks(runs.collapse_runs(frames, keys, "timestamp", label), keys, F.col("label"))


def grid_step(frames: DataFrame, keys: list[str], time: str = "timestamp") -> DataFrame:
    """(keys, step): the median positive step of a grid, 0.0 where there is none."""
    gap = F.col(time) - F.lag(time).over(Window.partitionBy(*keys).orderBy(time))
    gaps = frames.where(F.col(time).isNotNull()).select(*keys, gap.alias("gap"))
    return gaps.groupBy(*keys).agg(F.coalesce(F.percentile(F.when(F.col("gap") > 0, F.col("gap")), F.lit(0.5)), F.lit(0.0)).alias("step"))


def face_tracks(summaries: DataFrame, frames: DataFrame | None, keys: list[str]) -> DataFrame:
    """Spans of face tracks, each one step of the frames longer than its last sample; without frames the step is zero."""
    stepped = summaries.withColumn("step", F.lit(0.0)) if frames is None else summaries.join(grid_step(frames, keys), keys, "left")
    rows = stepped.withColumn("_end", F.col("last_timestamp") + F.coalesce("step", F.lit(0.0)))
    text = F.concat(F.lit("track "), F.col("track_id").cast("string"), F.lit(" · "), F.col("active_frame_count").cast("string"), F.lit("/"), F.col("frame_count").cast("string"), F.lit(" act · mean "), shown_number(F.col("mean_score"), 3))
    return _tier(rows, keys, "track_id", "first_timestamp", "_end", text)


def people(sightings: DataFrame, summaries: DataFrame, index: DataFrame | None, keys: list[str]) -> DataFrame:
    """Runs of sightings of a person with what the track table reports; people it lacks are unknown there. Without an index of
    frames nothing is verified: every sighting stands alone, and says so."""
    if index is None:
        index = sightings.where("false").select(*keys, "frame_number", F.col("t").alias("pts"))
    found = tracks.sighting_runs(sightings, keys, index)
    total = F.sum("sightings").over(Window.partitionBy(*keys, "person_id"))
    known = summaries.select(*keys, "person_id", "mean_confidence", "frame_coverage", "longest_gap_seconds")
    rows = found.withColumn("_total", total).join(known, [*keys, "person_id"], "left")
    one, n = F.col("sightings") == 1, F.col("sightings").cast("string")
    head = F.when(one, "sighting mark 1 frame").otherwise(F.concat(F.lit("sighting run "), n, F.lit(" frames")))
    covers = F.when(one, F.concat(F.lit("covers src frame "), F.coalesce(F.col("first_frame").cast("string"), F.lit(UNKNOWN)))).otherwise(F.concat(F.lit("covers src "), F.col("first_frame").cast("string"), F.lit("-"), F.col("last_frame").cast("string")))
    # The gap of a single sighting is no measurement.
    gap = F.when((F.col("_total") < 2) & (F.col("longest_gap_seconds") == 0), UNKNOWN).otherwise(shown_number(F.col("longest_gap_seconds"), 3))
    text = F.concat(
        F.lit("person "), F.col("person_id").cast("string"), F.lit(" · "), head, F.lit(" of "), F.col("_total").cast("string"), F.lit(" · conf "), shown_number(F.col("mean_confidence"), 3),
        F.lit(" · track coverage "), shown_number(F.col("frame_coverage"), 3), F.lit(" · max gap reported "), gap, F.lit(" · "), covers, F.lit(" · "), F.col("adjacency"),
    )
    return _tier(rows.withColumn("_row", F.concat_ws(":", "person_id", "first_frame")), keys, "_row", "start", "end", text)


def pose_presence(points: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of instants with a key point of enough confidence, over the grid of all instants."""
    grid = points.where("timestamp is not null").groupBy(*keys, "timestamp").agg(F.bool_or(F.coalesce(~F.isnan("confidence") & (F.col("confidence") >= PRESENT), F.lit(False))).alias("_seen"))
    return _blocks(runs.collapse_runs(grid, keys, "timestamp", F.col("_seen")).where("label"), keys, F.lit("body present"))


def voiced(frames: DataFrame, keys: list[str]) -> DataFrame:
    found = runs.collapse_runs(frames.where("timestamp is not null"), keys, "timestamp", F.col("f0_hz").isNotNull())
    return _blocks(found.where("label"), keys, F.lit("voiced (f0)"))


def windowed(frames: DataFrame, keys: list[str], columns: list[str], label: Callable[..., Column], width: float = WINDOW_SECONDS) -> DataFrame:
    """Windows from the first frame on, labelled by the low medians of columns; frames without a time follow, to be refused."""
    cells = runs.fixed_windows(frames.where("timestamp is not null"), keys, "timestamp", columns, width)
    merged = runs.merge_windows(cells, keys, F.when(F.col("value").isNotNull(), label(*[F.col(f"value.{c}") for c in columns])))
    text = F.concat_ws(" ", *[F.concat(F.lit(f"{c}="), shown_number(F.col(c), 2)) for c in columns])
    lost = frames.where("timestamp is null").select(*keys, F.lit("without time").alias("row_id"), F.lit(None).cast("double").alias("start"), F.lit(None).cast("double").alias("end"), text.alias("text"))
    return _blocks(merged, keys, F.col("label")).unionByName(lost)


def pitch_blocks(frames: DataFrame, keys: list[str], width: float = WINDOW_SECONDS) -> DataFrame:
    return windowed(frames, keys, ["f0_hz"], lambda x: F.concat(F.lit("f0 med "), pitch_label(x)), width)


def intensity_blocks(frames: DataFrame, keys: list[str], width: float = WINDOW_SECONDS) -> DataFrame:
    return windowed(frames, keys, ["intensity_db"], lambda x: F.concat(F.lit("int med "), intensity_label(x)), width)


def formant_blocks(frames: DataFrame, keys: list[str], width: float = WINDOW_SECONDS) -> DataFrame:
    return windowed(frames, keys, ["f1_hz", "f2_hz", "f3_hz"], lambda a, b, c: F.concat(F.lit("med "), formant_label(a, b, c)), width)


#: Tiers in their order of export: the tables that each is built from, and its builder. A table in brackets may be absent.
TIERS: dict[str, tuple[list[str], Callable[..., DataFrame]]] = {
    "words": (["speech_words"], words),
    "segments_src": (["speech_segments"], segments),
    "gloss_en": (["translation_segments"], lambda rows, keys: segments(rows, keys, "english_text")),
    "turns_pyannote": (["speaker_turns"], lambda rows, keys: turns(rows, keys, "pyannote")),
    "turns_nemotron": (["speaker_turns_nemotron"], lambda rows, keys: turns(rows, keys, "nemotron")),
    "fusion_pyannote": (["speaker_fusion_pyannote"], fusion),
    "fusion_nemotron": (["speaker_fusion_nemotron"], fusion),
    "asd_speaking": (["active_speaker_frames"], speaking),
    "face_tracks": (["active_speaker_tracks", "[active_speaker_frames]"], face_tracks),
    "person_tracks": (["person_frames", "person_tracks", "[frame_index]"], people),
    "pose_presence": (["pose_body"], pose_presence),
    "voiced_blocks": (["acoustic_frames"], voiced),
    "f0_blocks": (["acoustic_frames"], pitch_blocks),
    "intensity_blocks": (["acoustic_frames"], intensity_blocks),
    "formant_blocks": (["acoustic_frames"], formant_blocks),
}
#: The table of a tier itself, where it is not the first that it is built from.
OWN_TABLE = {"person_tracks": "person_tracks"}


def skipped(tables: dict[str, DataFrame]) -> dict[str, str]:
    """Why a tier cannot be built: its own table was not produced, or one that it requires was not."""
    out = {}
    for name, (needed, _) in TIERS.items():
        lost = [t for t in needed if not t.startswith("[") and t not in tables]
        own = OWN_TABLE.get(name, needed[0])
        if lost:
            out[name] = f"{own} not produced" if own in lost else f"requires {lost[0]}"
    return out


def build(tables: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """(tier, keys, row_id, start, end, text) of every tier whose required tables are given; skipped() has the reasons of the others."""
    gone = skipped(tables)
    made = [make(*[tables.get(t.strip("[]")) for t in needed], keys).select(F.lit(name).alias("tier"), "*") for name, (needed, make) in TIERS.items() if name not in gone]
    if not made:
        raise ValueError(f"no tier can be built: {gone}")
    return reduce(DataFrame.unionByName, made)


def placed(rows: DataFrame) -> DataFrame:
    """rows with start_ms, end_ms and refused: an end is after its start by the shortest span at least."""
    rows = rows.withColumn("refused", refusal(F.col("start"), F.col("end")))
    fine = F.col("refused").isNull()
    start, end = seconds_to_ms(F.col("start")), seconds_to_ms(F.col("end"), end=True)
    return rows.withColumns({"start_ms": F.when(fine, start), "end_ms": F.when(fine, F.greatest(end, start + SHORTEST_MS))})


def annotations(rows: DataFrame, keys: list[str], stretch: float = 3600.0) -> DataFrame:
    """(tier, keys, start_ms, end_ms, value): what is exported of placed rows; rows that overlap in their tier are cut at every endpoint.

    The rows are written once, as their builders read many tables; stretch is the seconds that one window runs over.
    """
    spans = placed(rows).where("refused is null").select("tier", *keys, F.col("start_ms").alias("start"), F.col("end_ms").alias("end"), "text", "row_id")
    cut = project_overlaps(written(spans, "tiers"), ["tier", *keys], stretch * 1000)
    return cut.select("tier", *keys, F.col("start").alias("start_ms"), F.col("end").alias("end_ms"), "value")


def drop_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(tier, keys, rows, missing_time, non_finite) of tiers that lose rows; the two reasons are never added up."""
    count = lambda why: F.count_if(F.col("refused") == why).alias(why)
    return placed(rows).groupBy("tier", *keys).agg(F.count("*").alias("rows"), count("missing_time"), count("non_finite")).where("missing_time > 0 or non_finite > 0")


def census(exported: DataFrame, keys: list[str]) -> DataFrame:
    """(tier, keys, annotations)."""
    return exported.groupBy("tier", *keys).agg(F.count("*").alias("annotations"))


def write_annotations(exported: DataFrame, path: str, partition: str = "video_id") -> None:
    """One folder a recording, as Parquet."""
    exported.write.mode("overwrite").option("compression", "zstd").partitionBy(partition).parquet(path)


def check(exported: DataFrame, keys: list[str], claimed: list[str]) -> DataFrame:
    """(tier, keys, rule, rows): annotations before zero, without length, that overlap in their tier, or of a tier that is not claimed."""
    before = Window.partitionBy("tier", *keys).orderBy("start_ms", "end_ms").rowsBetween(Window.unboundedPreceding, -1)
    marked = exported.withColumn("_until", F.max("end_ms").over(before))
    rules = {"before_zero": F.col("start_ms") < 0, "no_length": F.col("end_ms") <= F.col("start_ms"), "overlap": F.col("start_ms") < F.col("_until"), "unclaimed_tier": ~F.col("tier").isin(*claimed)}
    broken = F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules.items()]), lambda x: x.isNotNull())
    return marked.select("tier", *keys, F.explode(broken).alias("rule")).groupBy("tier", *keys, "rule").agg(F.count("*").alias("rows"))
