"""Running aggregates over keys of any size.

A window by key puts all rows of a key into one task. Here a key is cut into buckets along its order: a window runs within a
bucket, and what all earlier buckets of the key amount to is one small row a bucket, run over by itself and joined back.
Buckets are a function of the row, so both sides agree however often they are computed, and nothing is written or collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How two parts of a running aggregate come together: what was before, and what is here.
MERGED = {
    "max": lambda before, here: F.greatest(before, here),
    "min": lambda before, here: F.least(before, here),
    "sum": lambda before, here: F.coalesce(before + here, before, here),
    "last": lambda before, here: F.coalesce(here, before),
    "first": lambda before, here: F.coalesce(before, here),
}
_AGGREGATE = {"max": F.max, "min": F.min, "sum": F.sum}


def running(rows: DataFrame, keys: list[str], order: list[str], bucket: Column, strict: bool = False, backward: bool = False, **wanted: tuple[str, Column]) -> DataFrame:
    """rows with a column for each of wanted, name=(kind, value): max, min, sum, or the last or first value that is not null,
    over the rows of the key up to this one, or strictly before it; backward runs from the end.

    bucket is a whole number that never falls along order. Rows that are equal in order need another column there.
    """
    towards = F.desc if backward else F.asc
    ordered = [towards(c) for c in order]
    within = Window.partitionBy(*keys, "_bucket").orderBy(*ordered).rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
    earlier = Window.partitionBy(*keys).orderBy(towards("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    # First and last need the row's place, so they are taken as the value at the least or greatest place.
    place = F.struct(*order)
    marked = rows.withColumn("_bucket", bucket).withColumns({f"_v_{n}": v for n, (_, v) in wanted.items()})

    def whole(name: str, kind: str) -> Column:
        value = F.col(f"_v_{name}")
        if kind in _AGGREGATE:
            return _AGGREGATE[kind](value)
        latest = (kind == "last") != backward
        return (F.max_by if latest else F.min_by)(value, F.when(value.isNotNull(), place))

    def over(name: str, kind: str, value: str, window) -> Column:
        if kind in _AGGREGATE:
            return _AGGREGATE[kind](value).over(window)
        return (F.last if kind == "last" else F.first)(value, ignorenulls=True).over(window)

    pieces = marked.groupBy(*keys, "_bucket").agg(*[whole(n, k).alias(f"_p_{n}") for n, (k, _) in wanted.items()])
    before = pieces.select(*keys, "_bucket", *[over(n, k, f"_p_{n}", earlier).alias(f"_b_{n}") for n, (k, _) in wanted.items()])
    here = marked.withColumns({f"_h_{n}": over(n, k, f"_v_{n}", within) for n, (k, _) in wanted.items()})
    both = here.join(before, [*keys, "_bucket"])
    return both.select(*[c for c in rows.columns if c not in wanted], *[MERGED[k](F.col(f"_b_{n}"), F.col(f"_h_{n}")).alias(n) for n, (k, _) in wanted.items()])
