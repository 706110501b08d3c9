"""Resampling by importance towards a target distribution: array-scored weights, a cutoff by bisection, ranks by range.

Features are runs of 1 to max_run words, hashed into a fixed number of buckets (crc32). A bucket's gain is a whole number:
1000 times the logarithm of its smoothed share in the target texts over that in all documents. A document's weight is the
sum of its features' gains, looked up in one array of that fixed size; its score adds Gumbel noise drawn from its id, so
that the highest scores are a draw without replacement by weight. The cutoff is found by bisection: each job counts exactly
how many written scores lie on or below several thresholds, then ids (and rows) are bisected among the tied. Selected rows
are dealt out by range, and a row's rank is its place in its range behind the sizes of the ranges before it: no task sees
more than one range, and the driver holds counts alone.

Defined results: null and empty texts have no features and weight 0; a null id draws its noise as an empty string and stands
behind all others; repeated rows are drawn each for itself; without documents, or with too few to draw one, no rank is given;
a target without texts leaves every bucket's share smoothed alone; other columns of docs are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.common import integer_ids, materialize, slices, small_batches

#: Buckets of features, thousandths of a logarithm, and thresholds that one job counts.
BUCKETS, SCALE, WAYS = 10_000, 1000, 31
_LAST = 2**63 - 1
#: Lower-cased ASCII letters, digits and all bytes of other characters stay; the rest parts words.
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def hashed(text: bytes, max_run: int = 1, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of each feature."""
    found = text.translate(_KEEP).split()
    crcs = [np.fromiter(map(zlib.crc32, found), np.uint32, len(found))]
    for n in range(2, max_run + 1):
        runs = map(b" ".join, zip(*[found[k:] for k in range(n)], strict=False))
        crcs.append(np.fromiter(map(zlib.crc32, runs), np.uint32, max(0, len(found) - n + 1)))
    return len(found), (np.concatenate(crcs) % np.uint32(buckets)).astype(np.int32)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_run: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(_id, n_words, at): the buckets of a row's features, repeats included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                rows = [hashed(x or b"", max_run, buckets) for x in batch.column(1).cast(pa.binary()).to_pylist()]
                ends = np.cumsum([0, *(len(at) for _, at in rows)])
                at = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([at for _, at in rows])))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in rows], pa.int64()), at], names=["_id", "n_words", "at"])

    return docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col)).mapInArrow(run, "_id bigint, n_words bigint, at array<int>")


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket: a task counts its own rows first, so what is shuffled and collected has a fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(np.asarray(batch.column(0).flatten()), minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in rows.select("at").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A whole number for each bucket."""
    s, t, n = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(SCALE * math.log((b + 1) * (s + n) / ((a + 1) * (t + n)))) for a, b in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths, from the first 32 bits of a hash of seed and id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(rows: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """(_id, n_words, n_features, weight, score) of rows of features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2)
            ends = np.asarray(at.offsets).astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(gain[np.asarray(at.flatten())])])
            weight = sums[ends[1:] - ends[0]] - sums[ends[:-1] - ends[0]]
            score = weight + np.array([noise(x, seed) for x in batch.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(ends)), pa.array(weight), pa.array(score)], names=["_id", "n_words", "n_features", "weight", "score"])

    return rows.mapInArrow(run, "_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


def first_k(rows: DataFrame, keys: list[Column], k: int, ways: int = WAYS) -> Column:
    """The condition that holds for exactly k rows of a written table: the smallest by the whole-number keys, the last of
    which tells all rows apart. Each job counts the rows at or below `ways` thresholds of one key."""
    chosen, tied = F.lit(False), F.lit(True)
    for key in keys:
        there = rows.where(tied)
        low, high = there.agg(F.min(key), F.max(key)).first()
        if k <= 0 or low is None:
            return chosen
        below, upto = 0, None
        while low < high or upto is None:
            cuts = sorted({low + (high - low) * i // (ways + 1) for i in range(1, ways + 1)} | {high})
            at = there.agg(*[F.count_if(key <= F.lit(c).cast("bigint")).alias(str(i)) for i, c in enumerate(cuts)]).first()
            place = next((i for i, n in enumerate(at) if n >= k), None)
            if place is None:  # fewer rows than k
                return chosen | tied
            upto, high = at[place], cuts[place]
            if place:
                below, low = at[place - 1], cuts[place - 1] + 1
        edge = F.lit(high).cast("bigint")
        if upto == k:
            return chosen | (tied & (key <= edge))
        chosen, tied, k = chosen | (tied & (key < edge)), tied & (key == edge), k - below
    return chosen


def with_ranks(rows: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """rows in order of keys with their place, from 1: ranges of keys, sorted each for itself, behind the sizes of those before."""
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed = materialize(placed, "ranges")
    part, sizes, before = F.shiftright("_at", 33), [], 0
    for row in placed.groupBy(part.alias("part")).count().orderBy("part").toLocalIterator():
        sizes.append((row["part"], before))
        before += row["count"]
    # One row for each range: bounded by the number of partitions.
    starts = F.broadcast(rows.sparkSession.createDataFrame(sizes, "_part bigint, _before bigint"))
    out = placed.withColumn("_part", part).join(starts, "_part")
    return out.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).select(*rows.columns, name)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_run: int = 1, buckets: int = BUCKETS, least_words: int = 20, percent: int = 10, seed: int = 2024) -> DataFrame:
    """(id_col, n_features, weight, score, rank) for every row of docs; rank is null for what is not drawn."""
    integer_ids(docs, id_col)
    small_batches(docs.sparkSession)
    rows = materialize(features(docs, id_col, text_col, max_run, buckets), "features")
    wanted = features(target.select(F.lit(0).alias("_none"), F.col(text_col)), "_none", text_col, max_run, buckets)
    gain = gains(bucket_counts(rows, buckets), bucket_counts(wanted, buckets))
    table = materialize(scored(rows, gain, seed).withColumn("_row", F.monotonically_increasing_id()), "scores")
    drawn = table.where(F.col("n_words") >= least_words)
    keys = [-F.col("score"), F.coalesce("_id", F.lit(_LAST)), F.col("_row")]
    chosen = (F.col("n_words") >= least_words) & first_k(drawn, keys, drawn.count() * percent // 100)
    ranked = with_ranks(table.where(chosen), keys, "rank")
    both = ranked.unionByName(table.where(~chosen).withColumn("rank", F.lit(None).cast("bigint")))
    return both.select(F.col("_id").alias(id_col), "n_features", "weight", "score", "rank")
