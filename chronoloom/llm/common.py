"""What the corpus operators share: the shared folder, written intermediate tables, words, Arrow slices."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a run of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see (spark.checkpoint.dir). Only a session that is one process on one
    machine, as in tests, gets one of its own where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Writes df to the shared folder and reads it again, with the path that it has there."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """df, written and read again: lineage ends there, and a lost executor costs a reread."""
    return materialize_at(df, label)[0]


#: Rows of a narrow table in one file, and files at least.
NARROW_ROWS, NARROW_FILES = 500_000, 16


def narrow(df: DataFrame, rows: int) -> DataFrame:
    """A table of a few numbers a row, of at most so many rows, in few partitions: else each of many shuffle partitions would write a
    file of a few kilobytes in every round. A large table keeps its partitions."""
    return df.coalesce(max(NARROW_FILES, -(-rows // NARROW_ROWS)))


def shared_fs(path: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path for reads and writes inside tasks: any scheme that Arrow knows, local paths without one."""
    return pa.fs.FileSystem.from_uri(path if "://" in path or not path.startswith("file:") else path.replace("file:", "file://", 1))


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Lowers the session's Arrow batches, so that whole long texts stay within a task's memory; never raises them.

    The plan reads the setting when it runs, so it stays lowered for the session.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        if not 0 < int(spark.conf.get(key).rstrip("bB")) <= most:
            spark.conf.set(key, str(most))


def integer_ids(df: DataFrame, id_col: str) -> None:
    """Refuses ids that are no integers, before any work is done."""
    kind = df.schema[id_col].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{id_col} must hold integers, not {kind.simpleString()}")


def words(text: Column) -> Column:
    """All words of a text; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spread_rows(df: DataFrame, n: int, seed: int = 7) -> DataFrame:
    """About n rows drawn from all partitions, all of a smaller table. They never leave the executors; whole texts may be among them."""
    rows = df.count()
    return df if rows <= n else df.sample(n / rows, seed)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that later filters and projections use by name: a generator of one row keeps them from being copied below."""
    made = df.withColumn("_once", F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
    return made.drop(*columns).select("*", *[f"_once.{n}" for n in columns]).drop("_once")


def slices(batch: pa.RecordBatch, column: int, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that one column holds about max_bytes in each part; a longer row stands alone."""
    sizes = batch.column(column)
    total, rows = sizes.nbytes, batch.num_rows
    if total <= max_bytes or rows <= 1:
        if rows:
            yield batch
        return
    middle = rows // 2
    yield from slices(batch.slice(0, middle), column, max_bytes)
    yield from slices(batch.slice(middle), column, max_bytes)
