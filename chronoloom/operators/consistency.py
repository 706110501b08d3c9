"""Checks across the tables of a recording, and what an export shows of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _issues(rows: DataFrame, keys: list[str], name: str, issue: str, count: str) -> DataFrame:
    return rows.select(*keys, F.lit(name).alias("table_name"), F.lit(issue).alias("issue"), F.col(count).cast("bigint").alias("rows"))


def outside_media(tables: dict[str, tuple[DataFrame, str]], durations: DataFrame, keys: list[str], before: float = 1e-3, after: float = 1.0) -> DataFrame:
    """(keys, table_name, issue, rows) of times before zero or past the duration; a recording without duration is not judged."""
    found = []
    for name, (rows, column) in tables.items():
        # Partial aggregation leaves one row a recording, so the join is small whatever the table holds.
        ends = rows.select(*keys, F.col(column).alias("_t")).join(durations.select(*keys, "duration").where("duration > 0"), keys)
        counted = ends.groupBy(*keys).agg(F.count_if(F.col("_t") < -before).alias("_early"), F.count_if(F.col("_t") > F.col("duration") + after).alias("_late"))
        found.append(_issues(counted.where("_early > 0"), keys, name, "before_start", "_early"))
        found.append(_issues(counted.where("_late > 0"), keys, name, "past_duration", "_late"))
    return reduce(DataFrame.unionByName, found)


def unresolved(rows: DataFrame, known: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    """(keys, table_name, issue, rows): distinct ids of rows that known lacks, for recordings of which known has any id."""
    cited = rows.where(F.col(column).isNotNull()).select(*keys, column).distinct()
    ids = known.where(F.col(column).isNotNull()).select(*keys, column).distinct()
    lost = cited.join(ids, [*keys, column], "left_anti").join(ids.select(*keys).distinct(), keys, "left_semi")
    return _issues(lost.groupBy(*keys).agg(F.count("*").alias("_n")), keys, name, f"unresolved_{column}", "_n")


def artifacts(files: DataFrame, keys: list[str], guide: str = "explanation.md") -> DataFrame:
    """(keys, artifact, kind, file_count, size_bytes) over files (keys, artifact, in_folder, file_name, size); guides do not count."""
    counted = files.where((F.col("file_name") != guide) | ~F.col("in_folder")).groupBy(*keys, "artifact")
    kind = F.when(F.bool_or("in_folder"), "directory").otherwise("file")
    return counted.agg(kind.alias("kind"), F.count("*").alias("file_count"), F.sum("size").alias("size_bytes"))


def coverage(recordings: DataFrame, catalog: list[tuple[str, bool, bool]], present: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, artifact, state) for every recording and catalog entry (artifact, exported, summarised): a file that is absent comes first.

    The catalog is a closed list of table names, held as one literal array beside each recording.
    """
    names = F.array(*[F.struct(F.lit(name).alias("artifact"), F.lit(exported).alias("exported"), F.lit(summarised).alias("summarised")) for name, exported, summarised in catalog])
    all_ = recordings.select(*keys).distinct().select(*keys, F.explode(names).alias("c")).select(*keys, "c.*")
    seen = present.select(*keys, "artifact", F.lit(True).alias("_seen")).distinct()
    state = F.when(F.col("_seen").isNull(), "absent").when(F.col("exported"), "exported").when(F.col("summarised"), "summarised").otherwise("present, not exported")
    return all_.join(seen, [*keys, "artifact"], "left").select(*keys, "artifact", state.alias("state"))
