"""Joins and sweeps over intervals in seconds.

A pure range predicate plans as a nested loop. Here an interval is stored in buckets of a width that fits its length: levels
grow by a factor of RADIX, and an interval lies at the finest level where it meets a handful of buckets. Two intervals meet at
the coarser of their levels, so each is stored at its own level and at the coarser ones that the other side has. How many rows
that makes is known from the counts of each level: rare short intervals are lifted, and long ones cut, to levels that store
the fewest. A pair that
shares several buckets is kept in the bucket of the later start alone. One very long interval thus costs a few rows, short
ones share a bucket with their neighbours only, and buckets also break up one long video.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.operators.running import running
from chronoloom.shared import written

EPS = 1e-9
#: Growth of the buckets from level to level; buckets that an interval meets at its own level, less one; seconds of the finest.
RADIX, REACH, FINEST = 4, 4, 1.0


def _level(length: Column, width: float) -> Column:
    """The level of an interval's length; one or two levels off costs buckets, never pairs."""
    steps = F.greatest(length, F.lit(0.0)) / (REACH * width)
    return F.when(steps > 1, F.ceil(F.log(float(RADIX), steps))).otherwise(0).cast("int")


def _histogram(rows: DataFrame, start: Column, end: Column, width: float) -> DataFrame:
    """(level, n, seconds): how many intervals each level has, and their length; a few dozen rows at most."""
    length = F.greatest(end - start, F.lit(0.0))
    return rows.groupBy(_level(length, width).alias("level")).agg(F.count("*").alias("n"), F.sum(length).alias("seconds"))


def fitting_levels(sides: list[dict[int, tuple[int, float]]], width: float) -> tuple[int, int]:
    """The finest and the coarsest level that store the fewest rows. sides: rows and seconds of each level, left and right.

    Shorter intervals are lifted to the finest one where on one side these are a third of the rows at most, so that the buckets
    in which the others compare stay what they are; longer ones are cut into more buckets, 65 at most."""
    levels = sorted({x for side in sides for x in side})
    if not levels or not all(sides):
        return 0, 0
    own = lambda x, low, high: max(low, min(x, high))

    def stored(low: int, high: int) -> float:
        kept = [{own(x, low, high) for x in side} for side in sides]
        rows = 0.0
        for side, others in zip(sides, reversed(kept), strict=True):
            for x, (n, seconds) in side.items():
                rows += sum(seconds / (width * RADIX**k) + n for k in {own(x, low, high)} | {k for k in others if k > own(x, low, high)})
        return rows

    share = lambda side, low: sum(n for x, (n, _) in side.items() if x < low) / sum(n for n, _ in side.values())
    # The meeting of two intervals that are shorter on both sides is what lifting widens.
    low = max(x for x in range(max(levels[-1], 0) + 1) if x == 0 or min(share(side, x) for side in sides) <= 1 / 3)
    return min(((stored(a, b), a, b) for a in range(low + 1) for b in range(max(a, levels[-1] - 2), levels[-1] + 1)), key=lambda x: (x[0], x[1], -x[2]))[1:]


def _cells(rows: DataFrame, start: Column, end: Column, bounds: tuple[int, int], others: set[int], width: float) -> DataFrame:
    """rows in each of their buckets: own level _own, level _l and bucket _b of its width. others: the other side's levels."""
    at = lambda x, level: F.floor(x / (width * F.pow(F.lit(float(RADIX)), level)))
    placed = rows.withColumn("_own", F.greatest(F.lit(bounds[0]), F.least(_level(end - start, width), F.lit(bounds[1]))))
    known = F.array(*[F.lit(x) for x in sorted(others)]).cast("array<int>")
    # Without an other side at its level or a finer one, a row meets others at theirs only.
    levels = F.concat(F.filter(F.array("_own"), lambda x: F.coalesce(x >= F.array_min(known), F.lit(False))), F.filter(known, lambda x: x > F.col("_own")))
    buckets = F.flatten(F.transform(levels, lambda level: F.transform(F.sequence(at(start, level), at(F.greatest(start, end), level)), lambda b: F.struct(level.alias("l"), b.alias("b")))))
    return placed.withColumn("_cell", F.explode(buckets)).withColumns({"_l": F.col("_cell.l"), "_b": F.col("_cell.b")}).drop("_cell")


def bucket_rows(left: DataFrame, right: DataFrame, width: float = FINEST, slack: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Both sides in their buckets, as they are shuffled. The histograms of levels are counted at once, in one job."""
    spans = [(left, F.col("start") - slack, F.col("end") + slack), (right, F.col("r_start"), F.col("r_end"))]
    spans = [(rows.where(s.isNotNull() & e.isNotNull()), s, e) for rows, s, e in spans]
    counted = [_histogram(rows, s, e, width).withColumn("side", F.lit(k)) for k, (rows, s, e) in enumerate(spans)]
    sides: list[dict[int, tuple[int, float]]] = [{}, {}]
    for r in counted[0].unionByName(counted[1]).collect():
        sides[r["side"]][r["level"]] = (r["n"], r["seconds"])
    low, high = fitting_levels(sides, width)
    kept = [{max(low, min(x, high)) for x in side} for side in sides]
    a, b = (_cells(rows, s, e, (low, high), other, width) for (rows, s, e), other in zip(spans, reversed(kept), strict=True))
    return a, b.withColumnRenamed("_own", "_r_own")


def bucket_pairs(left: DataFrame, right: DataFrame, keys: list[str], width: float = FINEST, slack: float = 0.0) -> DataFrame:
    """Pairs that share a bucket at the level where they would meet: the candidates of range_join, some of them several times."""
    a, b = bucket_rows(left, right, width, slack)
    return a.join(b, [*keys, "_l", "_b"]).where(F.col("_l") == F.greatest("_own", "_r_own"))


def range_join(left: DataFrame, right: DataFrame, keys: list[str], width: float = FINEST, slack: float = 0.0) -> DataFrame:
    """Pairs whose closed intervals (start, end; r_start, r_end), widened by slack, meet; an interval without both times meets none.

    Right columns other than keys must have their own names. width is that of the finest buckets; it changes cost, never pairs.
    """
    met = (F.col("r_start") <= F.col("end") + slack) & (F.col("r_end") >= F.col("start") - slack)
    first = F.col("_b") == F.floor(F.greatest(F.col("start") - slack, F.col("r_start")) / (width * F.pow(F.lit(float(RADIX)), F.col("_l"))))
    return bucket_pairs(left, right, keys, width, slack).where(met & first).drop("_b", "_l", "_own", "_r_own")


def clean_turns(turns: DataFrame) -> DataFrame:
    """Turns with both times and an end not before the start; zero length stays."""
    return turns.where(F.col("start").isNotNull() & F.col("end").isNotNull() & (F.col("end") + EPS >= F.col("start")))


def assign_speakers(segments: DataFrame, turns: DataFrame, keys: list[str], id_col: str, width: float = FINEST, point: Column | None = None) -> DataFrame:
    """The speaker who covers most of each segment.

    Overlaps are summed for each speaker; the largest sum wins, then the earliest first turn, then the label. A point takes a
    turn that contains its start: a segment without an end, or without length, unless point says which are. What nothing covers
    gets no_overlap, as does a segment that ends before it starts.
    """
    turns = clean_turns(turns)
    first = turns.groupBy(*keys, "speaker").agg(F.min("start").alias("first_start"))
    right = turns.select(*keys, "speaker", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    point = F.col("end").isNull() | (F.abs(F.col("end") - F.col("start")) <= EPS) if point is None else point
    marked = segments.withColumn("_point", point)
    spans = marked.withColumn("end", F.when(F.col("_point"), F.col("start")).otherwise(F.col("end")))
    pairs = range_join(spans.where("start is not null and end >= start").select(*keys, id_col, "start", "end", "_point"), right, keys, width, EPS)
    overlap = F.greatest(F.lit(0.0), F.least("end", "r_end") - F.greatest("start", "r_start"))
    pairs = pairs.withColumn("_o", F.when(F.col("_point"), F.lit(0.0)).otherwise(overlap)).where("_point or _o > 1e-9")
    sums = pairs.groupBy(*keys, id_col, "speaker", "_point").agg(F.sum("_o").alias("overlap")).join(first, [*keys, "speaker"])
    ranked = Window.partitionBy(*keys, id_col).orderBy(F.desc("overlap"), "first_start", "speaker")
    sums = sums.withColumns({"rank": F.row_number().over(ranked), "runner_up": F.lead("speaker").over(ranked)}).where("rank = 1")
    best = sums.select(*keys, id_col, "speaker", "overlap", "runner_up")
    joined = marked.join(best, [*keys, id_col], "left")
    length = F.col("end") - F.col("start")
    ratio = F.when(F.col("speaker").isNull(), 0.0).when(F.col("_point"), 1.0).otherwise(F.least(F.lit(1.0), F.col("overlap") / length))
    method = F.when(F.col("speaker").isNull(), "no_overlap").when(F.col("_point"), "point_containment").otherwise("max_overlap")
    return joined.select(
        *keys, id_col, "start", "end", "speaker", F.round(F.coalesce("overlap", F.lit(0.0)), 6).alias("overlap_seconds"),
        F.round(ratio, 6).alias("overlap_ratio"), method.alias("method"), "runner_up",
    )


def coverage(turns: DataFrame, keys: list[str]) -> DataFrame:
    """Seconds with at least one and at least two turns active, by a sweep over starts and ends."""
    events = turns.select(*keys, F.explode(F.array(F.struct(F.col("start").alias("t"), F.lit(1).alias("d")), F.struct(F.col("end").alias("t"), F.lit(-1).alias("d")))).alias("e")).select(*keys, "e.*")
    steps = events.groupBy(*keys, "t").agg(F.sum("d").alias("d"))
    order = Window.partitionBy(*keys).orderBy("t")
    swept = steps.withColumns({"active": F.sum("d").over(order), "span": F.lead("t").over(order) - F.col("t")})
    total = turns.groupBy(*keys).agg(F.count("*").alias("turns"), F.round(F.sum(F.col("end") - F.col("start")), 3).alias("speaker_time"))
    seconds = swept.groupBy(*keys).agg(
        F.round(F.coalesce(F.sum(F.when(F.col("active") >= 1, F.col("span"))), F.lit(0.0)), 3).alias("speaker_seconds"),
        F.round(F.coalesce(F.sum(F.when(F.col("active") >= 2, F.col("span"))), F.lit(0.0)), 3).alias("overlap_seconds"),
        F.max("active").alias("deepest"),
    )
    return total.join(seconds, keys)


def other_speaker_overlap(turns: DataFrame, keys: list[str], id_col: str, width: float = FINEST) -> DataFrame:
    """Sum of the pairwise overlaps of each turn with turns of other speakers; it can exceed the turn's length."""
    right = turns.select(*keys, F.col(id_col).alias("_r"), F.col("speaker").alias("_rs"), F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    pairs = range_join(turns.select(*keys, id_col, "speaker", "start", "end"), right, keys, width).where(F.col("speaker") != F.col("_rs"))
    sums = pairs.groupBy(*keys, id_col).agg(F.sum(F.greatest(F.lit(0.0), F.least("end", "r_end") - F.greatest("start", "r_start"))).alias("o"))
    return turns.join(sums, [*keys, id_col], "left").select(*keys, id_col, "speaker", F.round(F.coalesce("o", F.lit(0.0)), 6).alias("overlap_s"))


def overlap_islands(rows: DataFrame, keys: list[str], stretch: float = 100_000.0) -> DataFrame:
    """rows (start, end, row_id) with island: the start of the run of overlapping rows that they belong to; rows that only touch
    are islands of their own. A stretch is what one window runs over; how far an island reaches beyond it does not matter."""
    bucket = F.floor(F.col("start") / stretch)
    order = ["start", "end", "row_id"]
    seen = running(rows, keys, order, bucket, strict=True, _until=("max", F.col("end")))
    fresh = F.when(F.coalesce(F.col("start") >= F.col("_until"), F.lit(True)), F.col("start"))
    return running(seen, keys, order, bucket, island=("max", fresh)).drop("_until")


def project_overlaps(rows: DataFrame, keys: list[str], stretch: float = 100_000.0) -> DataFrame:
    """Rows without overlaps: where rows of a key overlap, they are cut at every endpoint and simultaneous texts become a list.

    (keys, start, end, n_labels, value). Rows need start, end, text, row_id. Each island of overlapping rows is cut by itself; a
    row that overlaps none passes as it is. rows are read several times: a table, or what is cheap to compute.
    """
    found = overlap_islands(rows.select(*keys, "start", "end", "text", "row_id"), keys, stretch)
    own = [*keys, "island"]
    sized = written(found.withColumn("_n", F.count("*").over(Window.partitionBy(*own))), "islands")
    busy = sized.where("_n > 1").drop("_n")
    # A row of no length covers nothing, and stays only where nothing of its key is cut.
    empty = sized.where("_n = 1 and end <= start").join(busy.select(*keys).distinct(), keys, "left_anti")
    plain = sized.where("_n = 1 and end > start").unionByName(empty)
    plain = plain.select(*keys, "start", "end", F.lit(1).cast("bigint").alias("n_labels"), F.col("text").alias("value"))
    points = busy.select(*own, F.explode(F.array("start", "end")).alias("t")).distinct()
    cells = points.withColumn("next", F.lead("t").over(Window.partitionBy(*own).orderBy("t"))).where("next is not null")
    cells = cells.select(*own, F.col("t").alias("start"), F.col("next").alias("end"))
    right = busy.select(*own, F.col("start").alias("r_start"), F.col("end").alias("r_end"), "text", "row_id")
    covered = range_join(cells, right, own).where((F.col("r_start") < F.col("end")) & (F.col("r_end") > F.col("start")))
    texts = F.transform(F.sort_array(F.collect_list(F.struct("text", "row_id"))), lambda x: x["text"])
    cut = covered.groupBy(*own, "start", "end").agg(texts.alias("texts"))
    value = F.when(F.size("texts") == 1, F.get("texts", F.lit(0))).otherwise(F.to_json("texts"))
    return plain.unionByName(cut.select(*keys, "start", "end", F.size("texts").cast("bigint").alias("n_labels"), value.alias("value")))
