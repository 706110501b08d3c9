"""Data-quality rules as rows (rule, key, message)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(rule, key) for each row and rule that it breaks, in one pass."""
    broken = F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules.items()]), lambda x: x.isNotNull())
    return rows.select(F.explode(broken).alias("rule"), F.col(key).cast("string").alias("key"))


def unresolved(rows: DataFrame, column: str, known: DataFrame, known_column: str, rule: str) -> DataFrame:
    """Values that the other table lacks; null is allowed."""
    ids = known.select(F.col(known_column).alias(column)).distinct()
    return rows.where(F.col(column).isNotNull()).join(ids, column, "left_anti").select(F.lit(rule).alias("rule"), F.col(column).cast("string").alias("key")).distinct()


def repeated(rows: DataFrame, column: str, rule: str) -> DataFrame:
    return rows.groupBy(column).count().where("count > 1").select(F.lit(rule).alias("rule"), F.col(column).cast("string").alias("key"))


def together(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)
