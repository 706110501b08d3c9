"""Many small files, and what their footers know: read without a task a file and without a scan."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: What opening a file costs, in bytes of reading; bytes of texts in one batch of a task.
OPEN_COST, BATCH_BYTES = 64 << 10, 8 << 20


def footer_counts(spark: SparkSession, path: str) -> DataFrame:
    """(file, rows) of a Parquet table: no column is read, so the counts come from the footers."""
    return spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count("*").alias("rows"))


@dataclass
class Files(InputPartition):
    """The files of one task."""

    names: list[str]


def deal(sizes: list[tuple[str, int]], tasks: int) -> list[list[str]]:
    """Files in order of name, cut into at most `tasks` runs of about equal cost."""
    total = sum(size + OPEN_COST for _, size in sizes)
    out: list[list[str]] = []
    spent = 0
    for name, size in sizes:
        at = min(tasks - 1, spent * tasks // max(1, total))
        while len(out) <= at:
            out.append([])
        out[at].append(name)
        spent += size + OPEN_COST
    return [names for names in out if names]


def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path if "://" in path or not path.startswith("file:") else path.replace("file:", "file://", 1))


class PackedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.ending, self.tasks = options["path"], options.get("ending", ""), int(options["tasks"])

    def partitions(self) -> list[Files]:
        fs, plain = file_system(self.path)
        found = fs.get_file_info(pa.fs.FileSelector(plain, recursive=True))
        files = sorted((f.path, f.size) for f in found if f.is_file and f.path.endswith(self.ending))
        return [Files(names) for names in deal(files, self.tasks)] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.path)
        names, texts, held = [], [], 0
        for name in partition.names:
            with fs.open_input_file(name) as file:
                raw = file.read()
            names.append(name)
            texts.append(raw.decode("utf-8", "replace"))
            held += len(raw)
            if held >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["path", "text"])
                names, texts, held = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["path", "text"])


class PackedFiles(DataSource):
    """(path, text) of whole small files below a folder, dealt to a set number of tasks by size. Options: path, ending, tasks."""

    @classmethod
    def name(cls) -> str:
        return "packed_files"

    def schema(self) -> str:
        return "path string, text string"

    def reader(self, schema) -> PackedReader:  # noqa: ANN001
        return PackedReader(dict(self.options))


def packed_texts(spark: SparkSession, path: str, ending: str = "", tasks: int | None = None) -> DataFrame:
    """(path, text): at most `tasks` tasks read all files, twice the cores if it is not given. For file systems that Arrow knows."""
    spark.dataSource.register(PackedFiles)
    return spark.read.format("packed_files").option("ending", ending).option("tasks", str(tasks or 2 * spark.sparkContext.defaultParallelism)).load(path)


def packed_pose_frames(spark: SparkSession, path: str, document: str, tasks: int | None = None) -> DataFrame:
    """(file, frame_number, and the fields of document) of one JSON file a frame, hundreds of thousands of them a recording; names
    without number, and files that are no objects, are left out."""
    rows = packed_texts(spark, path, ".json", tasks).withColumn("file", F.regexp_extract("path", r"[^/]+$", 0))
    number = F.regexp_extract("file", r"(\d+)(?:_keypoints)?\.json$", 1).try_cast("bigint")
    kind = F.schema_of_variant(F.try_parse_json("text"))
    made = rows.withColumn("frame_number", number).where(F.col("frame_number").isNotNull() & kind.startswith("OBJECT"))
    return made.select("file", "frame_number", F.from_json("text", document).alias("_d")).select("file", "frame_number", "_d.*")
