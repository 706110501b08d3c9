"""Raw outputs of recognisers, diarizers, pose and face models as typed rows; sinks with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rttm(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, duration, speaker) of RTTM lines with at least eight fields; bad numbers are left out."""
    fields = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file")).withColumn("f", fields)
    rows = rows.where((F.get("f", F.lit(0)) == "SPEAKER") & (F.size("f") >= 8))
    rows = rows.select("file", F.get("f", F.lit(3)).try_cast("double").alias("start"), F.get("f", F.lit(4)).try_cast("double").alias("duration"), F.get("f", F.lit(7)).alias("speaker"))
    return rows.where("start is not null and duration is not null")


def write_rttm(turns: DataFrame, path: str, file_col: str = "video_id") -> None:
    """One line a turn, three decimals; no turns make an empty data set."""
    line = F.format_string("SPEAKER %s 1 %.3f %.3f <NA> <NA> %s <NA> <NA>", F.col(file_col).cast("string"), F.col("start"), F.col("end") - F.col("start"), F.col("speaker").cast("string"))
    turns.select(line.alias("value")).write.mode("overwrite").text(path)


ACOUSTIC = ["timestamp", "f0_hz", "intensity_db", "voiced", "f1_hz", "f2_hz", "f3_hz"]


def acoustic_frames(spark: SparkSession, path: str) -> DataFrame:
    """(file, timestamp, f0_hz, ...) of lines {"frame": [...]} or [...]; values that are no numbers are null, lines without time
    are left out, as are the header and the footer: objects without a frame. A line that is no JSON is an error."""
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0).select("value", F.col("_metadata.file_name").alias("file"), F.try_parse_json("value").alias("v"))
    broken = F.raise_error(F.concat(F.lit("not a line of JSON in "), "file", F.lit(": "), F.substring("value", 1, 80))).cast("array<string>")
    cells = F.coalesce(F.try_variant_get("v", "$.frame", "array<string>"), F.try_variant_get("v", "$", "array<string>"))
    rows = lines.select("file", F.when(F.col("v").isNull(), broken).otherwise(cells).alias("c")).where("c is not null")
    columns = [(F.get("c", F.lit(i)).isin("true", "1", "1.0") if name == "voiced" else F.get("c", F.lit(i)).try_cast("double")).alias(name) for i, name in enumerate(ACOUSTIC)]
    return rows.select("file", *columns).where("timestamp is not null")


def diarization_turns(spark: SparkSession, path: str, exclusive: bool = True) -> DataFrame:
    """(file, turn_id, start, end, speaker) from turns or, where asked for and present, exclusive_turns; short triples keep their number."""
    triples = "array<array<string>>"
    docs = spark.read.schema(f"turns {triples}, exclusive_turns {triples}").option("multiLine", True).json(path).select("*", F.col("_metadata.file_name").alias("file"))
    chosen = F.when(F.lit(exclusive) & (F.size("exclusive_turns") > 0), F.col("exclusive_turns")).otherwise(F.col("turns"))
    # A time that does not parse sorts as 0 and stays null; turns of equal times keep their order.
    at = lambda t, k: F.get(t, F.lit(k)).try_cast("double")
    sorted_ = F.array_sort(F.transform(chosen, lambda t, i: F.struct(F.coalesce(at(t, 0), F.lit(0.0)).alias("s"), F.coalesce(at(t, 1), F.lit(0.0)).alias("e"), i.alias("i"), t.alias("t"))))
    rows = docs.select("file", F.posexplode(sorted_).alias("i", "x")).where(F.size("x.t") >= 3)
    kind = F.lit("exclusive" if exclusive else "inclusive")
    return rows.select("file", F.format_string("turn%06d", F.col("i") + 1).alias("turn_id"), at(F.col("x.t"), 0).alias("start"), at(F.col("x.t"), 1).alias("end"), F.get("x.t", F.lit(2)).alias("speaker"), kind.alias("diarization_type"))


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in their order and types: a missing one is null, others are dropped, values that do not cast are null."""
    return rows.select([(F.col(f.name).try_cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def write_table(rows: DataFrame, schema: T.StructType, path: str, partition: str = "video_id") -> None:
    """Rows under one folder a recording. A table without rows would leave no file and so no columns: it is written flat."""
    whole = conform(rows, schema)
    writer = whole.write.mode("overwrite").option("compression", "zstd")
    (writer if whole.isEmpty() else writer.partitionBy(partition)).parquet(path)


def inventory(spark: SparkSession, root: str, extensions: tuple[str, ...]) -> DataFrame:
    """(path, length) of files below root with one of the extensions in any case; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    return files.where(F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).isin(*extensions)).orderBy("path")
