"""Token times from the timed words of the same segment."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.operators.folding import core_of, raw_key

#: Words that a token may lie ahead of the cursor, and the same for a punctuation mark timed as a word.
WORD_REACH, MARK_REACH = 3, 1
_STATE = "struct<cursor:int,last:int,found:array<struct<at:int,status:string,sure:double>>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _step(state: Column, token: Column, raws: Column, cores: Column) -> Column:
    """The cursor's move for one token: what it found is added, as a place among the words, a status and a confidence."""
    cursor, last = state["cursor"], state["last"]
    core, raw = token["core"], token["raw"]
    has_core = F.length(core) > 0
    ahead = lambda keys, key, reach: F.array_position(F.slice(keys, cursor + 1, F.lit(reach + 1)), key) - 1
    offset = F.when(has_core, ahead(cores, core, WORD_REACH)).when(F.length(raw) > 0, ahead(raws, raw, MARK_REACH)).otherwise(F.lit(-1))

    def moved(off: Column) -> Column:
        hit, here = off >= 0, F.get(cores, cursor)
        at = (cursor + off).cast("int")
        part = has_core & here.isNotNull() & F.contains(here, core) & (here != core)
        in_reach = F.when(cursor < F.size(raws), cursor)
        place = F.when(hit, at).when(~has_core, F.coalesce(last, in_reach)).when(part, cursor)
        status = F.when(hit & (off == 0), "aligned").when(hit | ~has_core | part, "approximate").otherwise("unmatched")
        far = F.when(has_core, F.greatest(F.lit(0.3), F.lit(1.0) - off * F.lit(0.25))).otherwise(F.lit(0.5))
        sure = F.when(hit & (off == 0), F.lit(1.0)).when(hit, far).when(~has_core, F.lit(0.2)).when(part, F.lit(0.3)).otherwise(F.lit(0.0))
        found = F.struct(place.cast("int").alias("at"), status.alias("status"), sure.cast("double").alias("sure"))
        new = F.struct(F.when(hit, at + 1).otherwise(cursor).cast("int").alias("cursor"), F.when(hit, at).otherwise(last).cast("int").alias("last"), F.concat(state["found"], F.array(found)).alias("found"))
        return new.cast(_STATE)

    return _let(offset.cast("int"), moved)


def align_tokens(tokens: DataFrame, words: DataFrame, keys: list[str], key: Callable[[Column], Column] = raw_key) -> DataFrame:
    """tokens (keys, token_index, token) with times, a status and a confidence from words (keys, word_index, word, start, end).

    A cursor moves forward over a segment's words. The word at the cursor is aligned (1.0), one up to three ahead is
    approximate; part of a word borrows its time and consumes nothing (0.3); punctuation borrows the last word's (0.2).
    A segment without words is no_timing; a word without times lends its alignment_status instead (unmatched where
    it has none). keys must name one segment: its tokens and words are two arrays, bounded by what is said in it, and the
    cursor is a fold over them in the JVM. key folds a text for comparison.
    """
    own = F.coalesce("alignment_status", F.lit("unmatched")) if "alignment_status" in words.columns else F.lit("unmatched")
    said = words.select(*keys, "word_index", key(F.col("word")).alias("raw"), F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"), own.alias("own"))
    said = said.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("word_index", "raw", "start", "end", "own"))).alias("_words"))
    asked = tokens.select(*keys, "token_index", "token", key(F.col("token")).alias("raw")).withColumn("core", core_of(F.col("raw")))
    asked = asked.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("token_index", "token", "raw", "core"))).alias("_tokens"))
    both = asked.join(said, keys, "left").withColumn("_words", F.coalesce("_words", F.array().cast(said.schema["_words"].dataType)))
    both = both.withColumns({"_raws": F.transform("_words", lambda w: w["raw"]), "_cores": F.transform("_words", lambda w: core_of(w["raw"]))})
    start = F.struct(F.lit(0).alias("cursor"), F.lit(None).cast("int").alias("last"), F.array().cast("array<struct<at:int,status:string,sure:double>>").alias("found")).cast(_STATE)
    found = F.aggregate("_tokens", start, lambda s, t: _step(s, t, F.col("_raws"), F.col("_cores")), lambda s: s["found"])
    rows = both.select(*keys, "_words", F.explode(F.arrays_zip(F.col("_tokens").alias("t"), found.alias("f"))).alias("_r"))
    rows = rows.withColumns({"_w": F.get("_words", F.col("_r.f.at")), "_any": F.size("_words") > 0})
    timed = F.col("_w.start").isNotNull() & F.col("_w.end").isNotNull()
    # A word without times hands on what its own aligner said of it.
    status = F.when(timed, F.col("_r.f.status")).when(F.col("_w").isNotNull(), F.col("_w.own")).when(F.col("_any"), "unmatched").otherwise("no_timing")
    return rows.select(
        *keys, F.col("_r.t.token_index").alias("token_index"), F.col("_r.t.token").alias("token"), F.when(timed, F.round("_w.start", 6)).alias("token_start"), F.when(timed, F.round("_w.end", 6)).alias("token_end"),
        status.alias("alignment_status"), F.when(timed, F.col("_r.f.sure")).otherwise(0.0).alias("alignment_confidence"),
    )
