"""What a table holds against what is said of it, measured while it is written: no second scan.

The measures are aggregates that ride along with the write (an Observation), so a table of any size costs one pass; the claims
are compared with a handful of numbers afterwards.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chronoloom.operators.running import running
from chronoloom.shared import shared_dir

TOLERANCE, PAST_END = 1e-6, 1.0


def table_measures(time: str | None = None, end: str | None = None, language: str | None = None, tier: str | None = None, tiers: list[str] | None = None) -> dict[str, Column]:
    """Aggregates of a table: its rows; the span of its times; languages; rows of each claimed tier, and of none of them."""
    out = {"rows": F.count(F.lit(1))}
    if time:
        out |= {"first": F.min(time), "last": F.max(end or time), "no_time": F.count_if(F.col(time).isNull() | F.isnan(time)), "behind": F.count_if(F.coalesce(F.col("_before") > F.col(time) + TOLERANCE, F.lit(False)))}
    if end:
        out |= {"no_length": F.count_if(F.col(end) <= F.col(time)), "overlaps": F.count_if(F.coalesce(F.col("_until") > F.col(time), F.lit(False)))}
    if language:
        out["no_language"] = F.count_if(~F.coalesce(F.length(F.trim(language)) > 0, F.lit(False)))
    if tier:
        claimed = tiers or []
        out |= {f"tier_{k}": F.count_if(F.col(tier) == name) for k, name in enumerate(claimed)}
        out["unclaimed"] = F.count_if(~F.coalesce(F.col(tier).isin(*claimed), F.lit(False)))
    return out


def write_observed(rows: DataFrame, path: str, measures: dict[str, Column], label: str = "table") -> dict[str, Any]:
    """Writes rows as Parquet and returns the measures of what was written."""
    seen = Observation(label)
    rows.observe(seen, *[v.alias(k) for k, v in measures.items()]).drop("_before", "_until").write.mode("overwrite").parquet(path)
    return dict(seen.get)


def with_order(rows: DataFrame, keys: list[str], place: str, time: str, end: str | None = None, stretch: int = 100_000) -> DataFrame:
    """rows with _before, the time of the row stored before, and _until, the latest end so far, by place, a whole number."""
    bucket = F.floor(F.col(place) / stretch)
    wanted = {"_before": ("last", F.col(time))} | ({"_until": ("max", F.col(end))} if end else {})
    return running(rows, keys, [place], bucket, strict=True, **wanted)


def broken_claims(found: dict[str, Any], claims: dict[str, Any]) -> list[tuple[str, str, str]]:
    """(rule, claimed, found) of each claim that does not hold.

    Claims: min_rows; duration (times lie from zero to a second past it); ordered; whole (no row without time); apart (no overlap,
    no row without length); language (each row has one); census, the rows of each claimed tier in the order of the measures;
    covered, the tiers that a coverage table says are there.
    """
    out: list[tuple[str, Any, Any]] = []
    say = lambda bad, rule, claimed, held: out.append((rule, claimed, held)) if bad else None
    say(found["rows"] < claims.get("min_rows", 0), "min_rows", claims.get("min_rows"), found["rows"])
    if "duration" in claims and found.get("first") is not None:
        say(found["first"] < -TOLERANCE, "before_zero", 0, found["first"])
        say(found["last"] > claims["duration"] + PAST_END, "past_duration", claims["duration"], found["last"])
    for claim, measures in (("ordered", ["behind"]), ("whole", ["no_time"]), ("apart", ["no_length", "overlaps"]), ("language", ["no_language"])):
        for m in measures if claims.get(claim) else []:
            say(found.get(m, 0) > 0, m, 0, found.get(m))
    for k, (tier, n) in enumerate(claims.get("census", {}).items()):
        say(found[f"tier_{k}"] != n, f"census:{tier}", n, found[f"tier_{k}"])
        covered = claims.get("covered")
        say(covered is not None and (tier in covered) != (found[f"tier_{k}"] > 0), f"coverage:{tier}", tier in (covered or []), found[f"tier_{k}"] > 0)
    say("census" in claims and found.get("unclaimed", 0) > 0, "unclaimed", 0, found.get("unclaimed"))
    return [(r, str(a), str(b)) for r, a, b in out]


def checked(spark: SparkSession, rows: DataFrame, label: str, measures: dict[str, Column], claims: dict[str, Any]) -> tuple[DataFrame, DataFrame]:
    """rows, written to the shared folder, and (rule, claimed, found) of the claims that they break."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    found = write_observed(rows, path, measures, label)
    kept = [f for f in rows.schema.fields if f.name not in ("_before", "_until")]
    problems = spark.createDataFrame(broken_claims(found, claims), "rule string, claimed string, found string")
    return spark.read.schema(rows.select(*[f.name for f in kept]).schema).parquet(path), problems
