"""Words, sentences, shapes, names, batches and the parsing of structured answers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def piece_ends(pieces: Column) -> Column:
    """Where each piece of an array of texts ends in the whole, in characters: a running sum within the row, in Arrow."""

    @F.arrow_udf("array<int>")
    def run(lists: pa.Array) -> pa.Array:
        bounds = np.asarray(lists.offsets).astype(np.int64)
        sizes = np.asarray(pc.utf8_length(lists.flatten()).fill_null(0)).astype(np.int64)
        sums = np.concatenate([[0], np.cumsum(sizes)])
        first = bounds - bounds[0]
        ends = sums[1:] - np.repeat(sums[first[:-1]], np.diff(bounds))
        return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ends, pa.int32()))

    return run(pieces)


def fallback_words(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id_col, word_id, word, character_start, character_end): one row for each run without blanks, by its segment's id."""
    # Words and blanks in turn; their lengths add up to places without leaving the row.
    pieces = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^ \t\n\r]+|[ \t\n\r]+"), F.lit(0))
    cut = rows.select(F.col(id_col), pieces.alias("_pieces")).withColumn("_ends", piece_ends(F.col("_pieces")))
    cut = cut.select(id_col, F.posexplode(F.arrays_zip(F.col("_pieces").alias("word"), F.col("_ends").alias("end"))).alias("i", "x")).select(id_col, "i", "x.word", "x.end")
    cut = cut.where(~F.col("word").rlike(r"^[ \t\n\r]"))
    return cut.select(id_col, F.format_string("%s-w%05d", F.col(id_col).cast("string"), F.expr("i div 2 + 1")).alias("word_id"), "word", (F.col("end") - F.length("word")).cast("int").alias("character_start"), F.col("end").alias("character_end"))


def token_rows(rows: DataFrame, id_col: str, text_col: str, longest: int = 100_000) -> DataFrame:
    """(id_col, sentence_id, token_id, token, start, end, is_alpha, is_digit, is_lower, is_punct, lemma, pos): tokens of each
    sentence with their places in it; a sentence over `longest` characters is cut there. What a model would add is null."""
    parts = F.split(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"([.!?\u3002\uFF01\uFF1F])[ \t\n\r]+", "$1\u0001"), "\u0001")
    chunk = lambda x: F.transform(F.sequence(F.lit(0), F.greatest(F.length(x) - 1, F.lit(0)), F.lit(longest)), lambda at: F.substring(x, at + 1, F.lit(longest)))
    pieces = F.filter(F.flatten(F.transform(parts, chunk)), lambda x: F.length(x) > 0)
    cut = rows.select(id_col, F.posexplode(pieces).alias("_s", "_sentence"))
    # Each token with the blanks before it, so that lengths add up to places.
    found = F.regexp_extract_all("_sentence", F.lit(r"[ \t\n\r]*(?:[\p{L}\p{N}]+|[^\p{L}\p{N} \t\n\r])"), F.lit(0))
    tokens = cut.select(id_col, "_s", found.alias("_pieces")).withColumn("_ends", piece_ends(F.col("_pieces")))
    tokens = tokens.select(id_col, "_s", F.posexplode(F.arrays_zip(F.col("_pieces").alias("p"), F.col("_ends").alias("e"))).alias("_t", "_x"))
    tokens = tokens.withColumns({"end": F.col("_x.e"), "token": F.regexp_replace("_x.p", r"^[ \t\n\r]+", "")})
    sentence = F.format_string("%s-s%03d", F.col(id_col).cast("string"), F.col("_s") + 1)
    return tokens.select(
        id_col, sentence.alias("sentence_id"), F.concat(sentence, F.format_string("-t%04d", F.col("_t") + 1)).alias("token_id"), "token", (F.col("end") - F.length("token")).alias("start"), "end",
        F.col("token").rlike(r"^\p{L}+$").alias("is_alpha"), F.col("token").rlike(r"^\p{Nd}+$").alias("is_digit"), (F.col("token").rlike(r"\p{Ll}") & ~F.col("token").rlike(r"\p{Lu}")).alias("is_lower"),
        F.col("token").rlike(r"^[^\p{L}\p{N}]$").alias("is_punct"), F.lit(None).cast("string").alias("lemma"), F.lit(None).cast("string").alias("pos"),
    )


def sentences(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id_col, sentence_id, text, token_count): split after closing marks that white space follows."""
    parts = F.split(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"([.!?])[ \t\n\r]+", "$1\u0001"), "\u0001")
    cut = rows.select(id_col, F.posexplode(F.filter(parts, lambda x: F.length(x) > 0)).alias("i", "text"))
    tokens = F.regexp_count("text", F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N} \t\n\r]"))
    return cut.select(id_col, F.format_string("%s-s%03d", F.col(id_col).cast("string"), F.col("i") + 1).alias("sentence_id"), "text", tokens.cast("bigint").alias("token_count"))


def word_shape(word: Column) -> Column:
    """Upper-case letters X, other letters x, digits d; longer than 12 is cut and marked."""
    # The three classes are disjoint and each replacement is kept apart until the last one.
    marked = F.regexp_replace(F.regexp_replace(F.regexp_replace(word, r"\p{Lu}", "\u0001"), r"\p{L}", "x"), r"\p{Nd}", "d")
    shape = F.regexp_replace(marked, "\u0001", "X")
    return F.when(F.length(shape) > 12, F.concat(F.substring(shape, 1, 12), F.lit("…"))).otherwise(shape)


def slug(name: Column) -> Column:
    """Name with other characters as _, trimmed of _ and -, at most 80 long, video if nothing is left."""
    plain = F.regexp_replace(F.regexp_replace(name, r"[^A-Za-z0-9_-]+", "_"), r"^[_-]+|[_-]+$", "")
    cut = F.regexp_replace(F.substring(plain, 1, 80), r"[_-]+$", "")
    return F.when(F.length(cut) > 0, cut).otherwise("video")


def unique_slugs(rows: DataFrame, path_col: str) -> DataFrame:
    """rows with video_id: the path's stem as slug, told apart by a hash of the path where stems repeat."""
    stem = F.regexp_replace(F.regexp_replace(F.col(path_col), r"^.*/", ""), r"\.[A-Za-z0-9]+$", "")
    named = rows.withColumn("_slug", slug(stem)).withColumn("_n", F.count("*").over(Window.partitionBy(F.lower("_slug"))))
    full = F.when(F.col("_n") > 1, F.concat("_slug", F.lit("-"), F.substring(F.sha2(path_col, 256), 1, 8))).otherwise(F.col("_slug"))
    return named.withColumn("video_id", full).drop("_slug", "_n")


def batches(rows: DataFrame, keys: list[str], order: str, text: Column, size: int, context: int) -> DataFrame:
    """(keys, batch, first_row, rows, body, before, after, request_key): fixed-size batches with context rows on both sides."""
    w = Window.partitionBy(*keys).orderBy(order)
    lines = rows.select(*keys, (F.row_number().over(w) - 1).alias("rn"), text.alias("line"))
    near = lines.withColumn("batch", F.explode(F.sequence(F.floor((F.greatest(F.col("rn") - context, F.lit(0))) / size), F.floor((F.col("rn") + context) / size))))
    place = F.when(F.col("rn") < F.col("batch") * size, "before").when(F.col("rn") >= (F.col("batch") + 1) * size, "after").otherwise("body")
    near = near.withColumn("place", place)
    joined = lambda p: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("place") == p, F.struct("rn", "line")))), lambda x: x["line"]), "\n")
    made = near.groupBy(*keys, "batch").agg(F.count_if(F.col("place") == "body").alias("rows"), joined("before").alias("before"), joined("body").alias("body"), joined("after").alias("after")).where("rows > 0")
    return made.withColumn("request_key", F.substring(F.sha2(F.concat_ws("\u0001", "before", "body", "after"), 256), 1, 16))
