"""Engines and answer providers by name: one more is one more row of a registry, and every plan takes it up."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.operators.fusion import fuse


@dataclass(frozen=True)
class TurnTable:
    """Where an engine's turns are, and the column of its overlap in seconds, if it measures one."""

    engine: str
    table: str
    overlap: str | None = None


#: The engines that are known from the start, with their tables.
TURN_TABLES: dict[str, TurnTable] = {t.engine: t for t in (TurnTable("pyannote", "speaker_turns"), TurnTable("nemotron", "speaker_turns_nemotron", "overlap_s"))}


def register_engine(spec: TurnTable) -> None:
    """Adds an engine; one of the same name is replaced."""
    TURN_TABLES[spec.engine] = spec


def chosen_engines(asked: str | list[str] | None) -> list[str]:
    """The engines that a configuration asks for: all of them for null or "all", else names that must be known, each once."""
    if asked is None or asked == "all":
        return list(TURN_TABLES)
    names = [x.strip() for x in asked.split(",")] if isinstance(asked, str) else list(asked)
    unknown = [x for x in names if x not in TURN_TABLES]
    if unknown or not names:
        raise ValueError(f"unknown engines {unknown}; known are {sorted(TURN_TABLES)}")
    return list(dict.fromkeys(names))


def engine_turns(tables: dict[str, DataFrame], keys: list[str], id_col: str = "turn_id", asked: str | list[str] | None = None) -> DataFrame:
    """(keys, engine, id_col, speaker, start, end, overlap_s) of every engine asked for whose table is there; an engine that does
    not measure overlap has null, not zero."""
    parts = []
    for name in chosen_engines(asked):
        spec = TURN_TABLES[name]
        if spec.table in tables:
            own = F.col(spec.overlap).cast("double") if spec.overlap else F.lit(None).cast("double")
            parts.append(tables[spec.table].select(*keys, F.lit(name).alias("engine"), id_col, "speaker", "start", "end", own.alias("overlap_s")))
    if not parts:
        raise ValueError(f"none of the tables {[TURN_TABLES[x].table for x in chosen_engines(asked)]} is given")
    return reduce(DataFrame.unionByName, parts)


def fuse_engines(turns: DataFrame, frames: DataFrame, keys: list[str], id_col: str = "turn_id", **options) -> DataFrame:
    """fusion.fuse for the turns of all engines in one plan, which reads the frames once: rows stay apart by engine."""
    own = F.struct("engine", id_col)
    fused = fuse(turns.withColumn("_turn", own).drop(id_col), frames, keys, "_turn", **options)
    fused = fused.select(*keys, F.col("_turn.engine").alias("engine"), F.col(f"_turn.{id_col}").alias(id_col), *[c for c in fused.columns if c not in (*keys, "_turn")])
    measured = turns.select(*keys, "engine", id_col, "overlap_s")
    return fused.join(measured, [*keys, "engine", id_col])


#: A provider answers requests: rows (keys, request, segments array<struct<id, text>>) gain answer, a text.
Provider = Callable[[DataFrame], DataFrame]
PROVIDERS: dict[str, Provider] = {}


def provider(name: str) -> Callable[[Provider], Provider]:
    """Registers a provider of answers; a model's endpoint is a mapInPandas over the requests, one call a row."""

    def keep(answer: Provider) -> Provider:
        PROVIDERS[name] = answer
        return answer

    return keep


def ask(requests: DataFrame, name: str) -> DataFrame:
    """requests with answer, by the provider of that name."""
    if name not in PROVIDERS:
        raise ValueError(f"unknown provider {name!r}; known are {sorted(PROVIDERS)}")
    return PROVIDERS[name](requests)


def _said(x: Column) -> Column:
    return F.length(F.trim(x["text"])) > 0


@provider("mock_translation")
def mock_translation(requests: DataFrame) -> DataFrame:
    """Each segment that says something, marked as translated; a column expression."""
    entries = F.transform(F.filter("segments", _said), lambda x: F.struct(x["id"].cast("string"), F.concat(F.lit("[en] "), x["text"])))
    return requests.withColumn("answer", F.to_json(F.map_from_entries(entries)))


@provider("mock_stories")
def mock_stories(requests: DataFrame) -> DataFrame:
    """One story over all segments of a request with two or more, else the reason for none."""
    ids = F.transform("segments", lambda x: x["id"].cast("string"))
    bounds = [F.array_min(F.transform("segments", lambda x: x["start"])).alias("start"), F.array_max(F.transform("segments", lambda x: x["end"])).alias("end")]
    story = F.struct(F.lit("s1").alias("story_id"), F.lit(None).cast("string").alias("parent_id"), *bounds, F.lit(0.5).alias("confidence"), ids.alias("evidence"))
    told = F.size("segments") >= 2
    return requests.withColumn("answer", F.to_json(F.struct(F.when(told, F.array(story)).otherwise(F.array().cast("array<struct<story_id:string,parent_id:string,start:double,end:double,confidence:double,evidence:array<string>>>")).alias("stories"), F.when(~told, "fewer than two segments").alias("no_story_reason"))))
