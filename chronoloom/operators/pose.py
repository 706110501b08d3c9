"""Key points from flat arrays, and coordinates relative to the body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The points that span the body's frame.
ORIGIN, BASIS = 8, 1


def triples(flat: Column) -> Column:
    """(x, y, score) structs of a flat array; a ragged tail is left out."""
    return F.when(F.size(flat) >= 3, F.transform(F.sequence(F.lit(0), F.size(flat) - 3, F.lit(3)), lambda i: F.struct(F.get(flat, i).alias("x"), F.get(flat, i + 1).alias("y"), F.get(flat, i + 2).alias("score")))).otherwise(
        F.array().cast("array<struct<x:double,y:double,score:double>>")
    )


def keypoints(rows: DataFrame, keys: list[str], flat: str) -> DataFrame:
    """(keys, keypoint_id, x, y, score) with a positive score."""
    points = rows.select(*keys, F.posexplode(triples(F.col(flat))).alias("keypoint_id", "p"))
    return points.select(*keys, "keypoint_id", "p.x", "p.y", "p.score").where("score > 0")


def present(value: Column) -> Column:
    """Zero and non-finite coordinates are absent."""
    return F.when((value != 0) & ~F.isnan(value) & (F.abs(value) != float("inf")), value)


def normalize(points: DataFrame, keys: list[str], origin: int = ORIGIN, basis: int = BASIS) -> DataFrame:
    """points with basis_state, x_norm, y_norm and value_status: origin at (0, 0), basis at (1, 0), the second axis perpendicular."""
    w = Window.partitionBy(*keys)
    return relative(points.withColumns({name: value.over(w) for name, value in joints(origin, basis).items()}), points.columns)


def joints(origin: int = ORIGIN, basis: int = BASIS) -> dict[str, Column]:
    """Aggregates over the points of one body that relative() needs."""
    pick = lambda point, axis: F.max(F.when(F.col("keypoint_id") == point, present(F.col(axis))))
    return {"_ox": pick(origin, "x"), "_oy": pick(origin, "y"), "_ix": pick(basis, "x"), "_iy": pick(basis, "y")}


def relative(rows: DataFrame, columns: list[str]) -> DataFrame:
    """columns of points that know their body's joints, with basis_state, x_norm, y_norm and value_status."""
    rows = rows.withColumns({"_vx": F.col("_ix") - F.col("_ox"), "_vy": F.col("_iy") - F.col("_oy")})
    # w = (v.y, -v.x); d = v.x * w.y - w.x * v.y
    rows = rows.withColumn("_d", F.col("_vx") * (-F.col("_vx")) - F.col("_vy") * F.col("_vy"))
    state = F.when(F.col("_d").isNull(), "basis_missing_joint").when(F.isnan("_d") | (F.abs("_d") == float("inf")), "basis_non_finite").when(F.col("_d") == 0, "basis_degenerate").otherwise("basis_ok")
    rows = rows.withColumns({"basis_state": state, "_rx": present(F.col("x")) - F.col("_ox"), "_ry": present(F.col("y")) - F.col("_oy")})
    fine = (F.col("basis_state") == "basis_ok") & F.col("_rx").isNotNull() & F.col("_ry").isNotNull()
    x = F.when(fine, F.try_divide(F.col("_rx") * (-F.col("_vx")) - F.col("_vy") * F.col("_ry"), F.col("_d")))
    y = F.when(fine, F.try_divide(F.col("_vx") * F.col("_ry") - F.col("_rx") * F.col("_vy"), F.col("_d")))
    absent = present(F.col("x")).isNull() | present(F.col("y")).isNull()
    status = F.when(absent, "no_coordinate").when(F.col("basis_state") != "basis_ok", "basis_unusable").otherwise("normalized")
    return rows.select(*columns, "basis_state", x.alias("x_norm"), y.alias("y_norm"), status.alias("value_status"))
