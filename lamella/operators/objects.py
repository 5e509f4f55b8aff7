"""Boxes, crops and stacks of objects that are keyed by slice and tissue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def biggest_boxes(boxes: DataFrame) -> DataFrame:
    """(idx, z, w, h): each tissue's box of largest w * h over the slices; ties to the first slice, which is the reference."""
    best = F.row_number().over(Window.partitionBy("idx").orderBy(F.desc(F.col("w") * F.col("h")), "z"))
    return boxes.withColumn("r", best).where("r = 1").select("idx", "z", "w", "h")


def expand_box(boxes: DataFrame, sx: int, sy: int, padding: int, width: int, height: int) -> DataFrame:
    """Full-resolution box (x1, y1, x2, y2) around (cx, cy) of size (w, h), clamped, scaled, padded and clamped again."""

    def side(c: str, size: str, s: int, limit: int) -> tuple:
        half = F.expr(f"{size} div 2")
        low, high = F.greatest(F.col(c) - half, F.lit(0)) * s, F.least(F.col(c) + half, F.lit(limit)) * s
        return F.greatest(low - padding, F.lit(0)), F.least(high + padding, F.lit(limit))

    (x1, x2), (y1, y2) = side("cx", "w", sx, width), side("cy", "h", sy, height)
    return boxes.withColumns({"x1": x1.cast("long"), "y1": y1.cast("long"), "x2": x2.cast("long"), "y2": y2.cast("long")})


def crop(pixels: DataFrame, boxes: DataFrame, cell: int = 512) -> DataFrame:
    """Pixels inside each box [x1, x2) x [y1, y2) with coordinates from its corner.

    Boxes are dealt to the square cells of a grid that they meet, so a pixel meets the boxes of its cell only.
    """
    last = lambda c: F.expr(f"greatest({c} - 1, 0) div {cell}")
    own = boxes.where("x1 < x2 and y1 < y2").select("z", "idx", "x1", "y1", "x2", "y2", F.explode(F.sequence(F.expr(f"y1 div {cell}"), last("y2"))).alias("gy"), F.expr(f"x1 div {cell}").alias("first"), last("x2").alias("last"))
    own = own.withColumn("gx", F.explode(F.sequence("first", "last"))).drop("first", "last")
    inside = pixels.withColumns({"gy": F.expr(f"y div {cell}"), "gx": F.expr(f"x div {cell}")}).join(own, ["z", "gy", "gx"]).where("x >= x1 and x < x2 and y >= y1 and y < y2")
    return inside.select("z", "idx", (F.col("y") - F.col("y1")).alias("y"), (F.col("x") - F.col("x1")).alias("x"), "v")


def apply_mask(pixels: DataFrame, mask: DataFrame) -> DataFrame:
    """Pixels under the mask; all others are zero, so their rows go."""
    return pixels.join(mask.select("z", "y", "x"), ["z", "y", "x"], "left_semi").where("v <> 0")


def pad_stack(crops: DataFrame) -> DataFrame:
    """Crops of a tissue on one size: the smaller ones are padded at the top and the left."""
    size = crops.groupBy("idx", "z").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"))
    room = Window.partitionBy("idx")
    shift = size.select("idx", "z", (F.max("h").over(room) - F.col("h")).alias("dy"), (F.max("w").over(room) - F.col("w")).alias("dx"))
    return crops.join(shift, ["idx", "z"]).select("idx", "z", (F.col("y") + F.col("dy")).alias("y"), (F.col("x") + F.col("dx")).alias("x"), "v")


def nonuniform_groups(crops: DataFrame) -> DataFrame:
    """Tissues whose crops differ in shape."""
    size = crops.groupBy("idx", "z").agg(F.max("y").alias("h"), F.max("x").alias("w"))
    return size.groupBy("idx").agg(F.count_distinct("h", "w").alias("shapes")).where("shapes > 1").select("idx", "shapes")


def assert_same_count(objects: DataFrame) -> DataFrame:
    """(n) objects of every slice; slices with different numbers raise an error when read."""
    counts = objects.groupBy("z").agg(F.count("*").alias("n")).agg(F.min("n").alias("low"), F.max("n").alias("high"))
    return counts.select(F.when(F.col("low") != F.col("high"), F.raise_error(F.lit("slices have different numbers of tissues")).cast("long")).otherwise(F.col("low")).alias("n"))
