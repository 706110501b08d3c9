"""Size-tiered compaction of immutable shards under a versioned manifest.

Arrivals are appended as the small Parquet files that Spark's writer makes; nothing is shuffled. Shards whose sizes lie
in one tier (a factor of fan_in) are runs; a tier with several runs is merged into files of about target size by one
task for each merged file, which streams row groups and holds one at a time. A merge can cascade: its results are runs
of the next tier. Merges are planned over the manifest as a DataFrame.

A manifest version is a Parquet table of live shards, written aside and made current by one rename that fails if the
version exists: a reader sees a whole version or the one before, and of two writers one retries. Shards that a merge has
replaced stay for the readers of older versions until expire() is called. The rename is atomic on HDFS and local file
systems; an object store needs a committer or a catalog that makes it so.

Defined results: the first arrival sets the table's columns; an empty one adds no shard, and a table without rows is
read as an empty one; a null arrival is one of its own, and arrivals may have any integer; null ids and repeated rows are
rows like others; columns keep their names whatever they are (read() takes other names for its own two if they clash).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoloom.llm.common import materialize, shared_fs

TARGET_BYTES, FAN_IN, MIN_RUNS = 128 << 20, 8, 2
ROW_GROUP = 20_000

MANIFEST = "path string, bytes bigint, rows bigint, level int, arrival bigint"


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target, jvm.org.apache.hadoop.fs.Path


def versions(spark: SparkSession, root: str) -> list[int]:
    fs, folder, _ = _hadoop(spark, f"{root}/manifest")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n[1:]) for n in names if n.startswith("v"))


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Live shards of a version, by default the latest."""
    known = versions(spark, root)
    if not known:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest/v{known[-1] if version is None else version:08d}")


def commit(shards: DataFrame, root: str, base: int) -> int:
    """Makes version base + 1 of these shards; raises if another writer made it first."""
    spark = shards.sparkSession
    aside, final = f"{root}/aside-{uuid.uuid4().hex}", f"{root}/manifest/v{base + 1:08d}"
    shards.coalesce(1).write.parquet(aside)
    fs, source, path = _hadoop(spark, aside)
    fs.mkdirs(path(f"{root}/manifest"))
    jvm = spark.sparkContext._jvm
    renames = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    # Unlike FileSystem.rename this raises if the version exists.
    context.rename(source, path(final), renames)
    return base + 1


def append(spark: SparkSession, arrivals: DataFrame, root: str, arrival_col: str) -> int:
    """Adds rows as small shards, several arrivals in one job: a task writes one file for each arrival that it holds."""
    folder, own = f"{root}/data/{uuid.uuid4().hex}", f"arrival{uuid.uuid4().hex}"
    rows = arrivals.withColumn(own, F.col(arrival_col).cast("bigint")).drop(arrival_col)
    known = versions(spark, root)
    if not known:
        rows.drop(own).limit(0).write.mode("ignore").parquet(f"{root}/columns")
    rows.write.partitionBy(own).parquet(folder)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(folder).select("path", "length")

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                fs, plain = shared_fs(path)
                rows.append(pq.read_metadata(plain, filesystem=fs).num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.int64())], names=["path", "bytes", "rows"])

    counted = files.mapInArrow(footers, "path string, bytes bigint, rows bigint").where("rows > 0")
    arrival = F.regexp_extract("path", own + r"=(-?\d+)", 1).try_cast("bigint")
    added = counted.select("path", "bytes", "rows", F.lit(0).alias("level"), arrival.alias("arrival"))
    return commit(manifest(spark, root).unionByName(added), root, known[-1] if known else 0)


def merge_groups(shards: DataFrame, target: int = TARGET_BYTES, fan_in: int = FAN_IN, min_runs: int = MIN_RUNS) -> DataFrame:
    """(tier, place, paths, level, arrival): runs of similar size, oldest first, in groups of about the target size; a lone
    run waits for others of its tier, and shards of half the target or more stay as they are."""
    tier = F.greatest(F.lit(0), F.ceil(F.log(float(fan_in), F.lit(float(target)) / F.greatest(F.col("bytes"), F.lit(1))) - 1)).cast("int")
    runs = shards.where(F.col("bytes") < target // 2).withColumn("tier", tier)
    before = Window.partitionBy("tier").orderBy("level", F.asc_nulls_first("arrival"), "path").rowsBetween(Window.unboundedPreceding, 0)
    placed = runs.withColumn("place", F.floor((F.sum("bytes").over(before) - 1) / target).cast("bigint"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("level", "arrival", "path"))), lambda x: x["path"])
    groups = placed.groupBy("tier", "place").agg(in_order.alias("paths"), (F.max("level") + 1).alias("level"), F.min("arrival").alias("arrival"))
    return groups.where(F.size("paths") >= min_runs)


def merge(groups: DataFrame, root: str) -> DataFrame:
    """One task a group streams the rows of its shards, in order, into one new file; (path, bytes, rows, level, arrival, replaced)."""
    folder = f"{root}/data/{uuid.uuid4().hex}"
    todo = groups.select("paths", "level", "arrival").repartition(max(1, groups.count()), "paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for job in batch.to_pylist():
                out = f"{folder}/merged-{uuid.uuid4().hex}.parquet"
                fs, plain = shared_fs(out)
                fs.create_dir(plain.rsplit("/", 1)[0], recursive=True)
                rows, writer = 0, None
                for path in job["paths"]:
                    source, name = shared_fs(path)
                    with source.open_input_file(name) as file:
                        for part in pq.ParquetFile(file).iter_batches(batch_size=2048):
                            # The same columns in every shard; the schema is the first one's.
                            writer = writer or pq.ParquetWriter(plain, part.schema, filesystem=fs, compression="snappy", use_dictionary=False)
                            writer.write_batch(part, row_group_size=ROW_GROUP)
                            rows += part.num_rows
                writer.close()
                kinds = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("rows", pa.int64()), ("level", pa.int32()), ("arrival", pa.int64()), ("replaced", pa.list_(pa.string()))])
                yield pa.RecordBatch.from_pydict({"path": [out], "bytes": [fs.get_file_info(plain).size], "rows": [rows], "level": [job["level"]], "arrival": [job["arrival"]], "replaced": [job["paths"]]}, schema=kinds)

    return todo.mapInArrow(run, MANIFEST + ", replaced array<string>")


def compact(spark: SparkSession, root: str, target: int = TARGET_BYTES, fan_in: int = FAN_IN, min_runs: int = MIN_RUNS) -> int:
    """Merges until no tier has runs to merge, one version a pass; the latest version. Replaced shards stay until they expire."""
    while True:
        known = versions(spark, root)
        if not known:
            return 0
        live = manifest(spark, root, known[-1])
        groups = materialize(merge_groups(live, target, fan_in, min_runs), "merge-plan")
        if groups.isEmpty():
            return known[-1]
        merged = materialize(merge(groups, root), "merged")
        gone = merged.select(F.explode("replaced").alias("path"))
        kept = live.join(gone, "path", "left_anti").select(*live.columns).unionByName(merged.drop("replaced"))
        rows = lambda of: of.agg(F.sum("rows")).first()[0]
        if rows(kept) != rows(live):
            raise RuntimeError("a merge changed the number of rows")
        commit(kept, root, known[-1])


def expire(spark: SparkSession, root: str, before: int) -> int:
    """Drops the versions older than `before` and the shards that only they name; how many shards. Their readers must be done."""
    known = versions(spark, root)
    old, held = [v for v in known if v < before], [v for v in known if v >= before]
    if not old or not held:
        return 0
    folders = lambda vs: [f"{root}/manifest/v{v:08d}" for v in vs]
    paths = lambda vs: spark.read.schema(MANIFEST).parquet(*folders(vs)).select("path").distinct()
    dead = materialize(paths(old).join(paths(held), "path", "left_anti"), "expired")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, plain = shared_fs(path)
                # A repeated attempt finds some of them gone.
                if fs.get_file_info(plain).type != pa.fs.FileType.NotFound:
                    fs.delete_file(plain)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    for folder in folders(old):
        fs, target, _ = _hadoop(spark, folder)
        fs.delete(target, True)
    return dead.mapInArrow(drop, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read(spark: SparkSession, root: str, version: int | None = None, shard_col: str = "_shard", row_col: str = "_row") -> DataFrame:
    """Rows of a version, with the file that holds each and its place there."""
    if not versions(spark, root):
        raise ValueError("nothing has been appended")
    columns = spark.read.parquet(f"{root}/columns").schema
    if clash := {shard_col, row_col} & set(columns.names):
        raise ValueError(f"the table has columns {clash}: name others for shard_col and row_col")
    paths = [row["path"] for row in manifest(spark, root, version).select("path").toLocalIterator()]  # names of files, as any Parquet table's
    rows = spark.read.schema(columns).parquet(*(paths or [f"{root}/columns"]))
    return rows.select("*", F.col("_metadata.file_name").alias(shard_col), F.col("_metadata.row_index").alias(row_col))
