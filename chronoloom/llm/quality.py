"""Quality rules as a short-circuit cascade.

Base counts are built-in array and text functions over whole texts. A text repeats a five-word window exactly when
its window hashes are not all distinct; only then are the windows themselves sorted and compared, so the count is
exact and most texts pay for hashing alone. The verdict is a chain of rules joined by AND: their cost and the share
they reject are measured on a sample spread over all partitions (about SAMPLE_ROWS rows, never at the driver), and the chain runs the rules by rejection per cost,
stopping at the first that rejects. The order changes the time, never the verdict.

Defined results: null and empty texts have no words and fail the base rule; repeated rows get equal results; columns
of the input named like a result column are replaced.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.common import WORD, spread_rows, let, materialize, once, words

WINDOW = 5
#: About so many rows, drawn from all partitions, on which costs and rejections are measured, and the times of each measurement.
SAMPLE_ROWS, REPEATS = 2000, 3

SYMBOLS = r"[#*$%&|<>]"
#: Letters of scripts without spaces between words: Thai, Lao, Burmese, Khmer, Japanese, Chinese.
UNSPACED = r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF]"


def repeated_words(found: Column) -> Column:
    """Words that lie in a five-word window found at least twice in the text."""
    last = F.size(found) - WINDOW

    def at(i: Column) -> list[Column]:
        return [F.get(found, i + k) for k in range(WINDOW)]

    def exact(hashes: Column) -> Column:
        windows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), F.concat_ws(" ", *at(i)).alias("s"), i.alias("i"))))

        def covered(rows: Column) -> Column:
            twice = F.filter(rows, lambda x, j: (x["s"] == F.get(rows, j - 1)["s"]) | (x["s"] == F.get(rows, j + 1)["s"]))
            starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
            nothing = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
            return F.aggregate(starts, nothing, lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n"), (i + WINDOW).alias("end")), lambda a: a["n"])

        return let(windows, covered)

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(exact(hashes))

    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*at(i)))
    return F.when(last < 1, 0).otherwise(let(hashes, count)).cast("bigint")


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, and what the rules need."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.withColumns({"_words": words(F.col(text_col)), "_lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))})
    counted = counted.withColumns(
        {
            "n_words": F.size("_words").cast("bigint"),
            "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "n_repeat_words": repeated_words(F.col("_words")),
            "_n_lines": F.size("_lines"),
        }
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def rules(text_col: str = "text") -> dict[str, Column]:
    """True where a text passes. Cheap ones read the counts; the others read the text again."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return {
        # Scripts that do not part words by spaces have no length of words to judge.
        "word_length": (F.col("word_chars") >= 2 * F.col("n_words"))
        & F.when(F.col("word_chars") <= 12 * F.col("n_words"), True).otherwise(F.col("word_chars") - F.regexp_count(text, F.lit(UNSPACED)) <= 12 * F.col("n_words")),
        "symbols": 10 * F.col("n_symbols") <= F.col("n_words"),
        "duplicate_lines": 2 * F.col("n_dup_lines") <= F.col("_n_lines"),
        "shouting": 2 * F.regexp_count(text, F.lit(r"\p{Lu}")) <= F.regexp_count(text, F.lit(r"\p{L}")),
        "words_with_letters": 2 * F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]*\p{L}[^\x20\x09-\x0D]*")) >= F.col("n_words"),
    }


def cascade_order(docs: DataFrame, checks: dict[str, Column], prepare: Callable[[DataFrame], DataFrame], sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by rejected share per second, measured one by one on a written sample; the shortest of REPEATS times counts."""
    sample = materialize(prepare(spread_rows(docs, sample_rows)).repartition(docs.sparkSession.sparkContext.defaultParallelism), "quality-sample")

    def measured(passed: Column) -> tuple[float, int, int]:
        times = []
        for _ in range(REPEATS):
            began = time.perf_counter()
            row = sample.agg(F.count(F.when(~passed, 1)).alias("rejected"), F.count("*").alias("rows")).first()
            times.append(time.perf_counter() - began)
        return min(times), row["rejected"], row["rows"]

    idle = measured(F.lit(True))[0]
    worth = {}
    for name, passed in checks.items():
        cost, rejected, rows = measured(passed)
        worth[name] = rejected / max(rows, 1) / max(cost - idle, 1e-3)
    return sorted(checks, key=lambda name: -worth[name])


def judge(docs: DataFrame, text_col: str = "text", order: list[str] | None = None) -> DataFrame:
    """docs with the base counts, base_failed and kept."""
    checks = rules(text_col)
    if order is None:
        order = cascade_order(docs.select(text_col), checks, lambda d: base_counts(d, text_col).drop("_words", "_lines"))
    verdict = F.when(F.col("base_failed"), False)
    for name in order:
        verdict = verdict.when(~checks[name], False)
    # Computed once for each row, so that a filter on the verdict does not copy the counts into itself.
    judged = once(base_counts(docs, text_col), kept=verdict.otherwise(True))
    return judged.drop("_words", "_lines", "_n_lines")
