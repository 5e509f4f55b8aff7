"""Connected components of masks, inside tiles and by star contraction between them, and what builds on them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from . import tiles
from .tiles import MISSING, repeated, to_blocks


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a local folder only where it is unset and Spark runs in one process, as in tests."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the session's folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the checkpoint folder.  A checkpoint keeps its partitioning; a table doesn't, so a hot key can be split where it is joined."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, shuffled where it is joined: Spark guesses pixels and keypoints from the compressed files they come from, and a broadcast would pass them whole through the driver."""
    return df.hint("merge")


def _components(edges: DataFrame) -> DataFrame | None:
    """(z, node, root) for edges (z, u, v), u > v: large-star and small-star rounds until nothing moves; None without edges.

    A component's root comes to have all its runs as neighbours, so its minimum is joined as a table of its own.
    """
    e = checkpointed(edges.distinct())
    if e.isEmpty():
        return None
    mark = None
    while True:
        both = e.union(e.select("z", F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("z", "u").agg(F.min("v").alias("m")).select("z", "u", F.least("u", "m").alias("m")))
        large = both.join(low, ["z", "u"]).where("v > u and v > m").select("z", F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("z", "u").agg(F.min("v").alias("m"))
        small = large.join(low, ["z", "u"]).where("v > m").select("z", F.col("v").alias("u"), F.col("m").alias("v"))
        e = checkpointed(small.union(low.select("z", "u", "m")).distinct())
        last, mark = mark, tuple(e.agg(F.count("*"), F.sum(F.xxhash64("z", "u", "v").cast("decimal(38,0)"))).first())
        if last == mark:
            return e.select("z", F.col("u").alias("node"), F.col("v").alias("root"))


def _united(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least of each group of 0 ... n - 1 that edges (u, v) join."""
    root = np.arange(n)
    while True:
        a, b = root[u], root[v]
        live = a != b
        if not live.any():
            return root
        u, v = u[live], v[live]
        np.minimum.at(root, np.maximum(a, b)[live], np.minimum(a, b)[live])
        while ((r := root[root]) != root).any():
            root = r


def first_pixels(on: np.ndarray, diagonal: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(y, x) of the set pixels and of the first pixel, in reading order, of their component inside the array."""
    wide = np.pad(on, ((0, 0), (1, 1))).astype(np.int8)
    step = np.diff(wide, axis=1)
    row, start = np.nonzero(step == 1)
    end = np.nonzero(step == -1)[1] - 1
    span, reach = on.shape[1] + 4, int(diagonal)
    # Runs of the line above that touch: those that end at or after its start and start at or before its end.
    low = np.searchsorted(row * span + end + 2, (row - 1) * span + start + 2 - reach, "left")
    high = np.searchsorted(row * span + start + 2, (row - 1) * span + end + 2 + reach, "right")
    many = np.maximum(high - low, 0)
    below = np.repeat(np.arange(len(row)), many)
    above = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
    root = _united(len(row), above, below)
    of = np.repeat(root, end - start + 1)
    y, x = np.nonzero(on)
    return y, x, row[of], start[of]


def _across(border: DataFrame, diagonal: bool) -> DataFrame | None:
    """(z, node, root) of components (local) whose pixels (z, y, x, local) at tiles' borders touch; None if none do."""
    ways = [(0, 1), (1, 0)] + [(1, 1), (1, -1)] * diagonal
    to = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ways))).alias("d")
    near = border.select("z", "y", "x", F.col("local").alias("other"), to).select("z", (F.col("y") + F.col("d.i")).alias("y"), (F.col("x") + F.col("d.j")).alias("x"), "other")
    return _components(near.join(border, ["z", "y", "x"]).where("local <> other").select("z", F.greatest("local", "other").alias("u"), F.least("local", "other").alias("v")))


def connected_components(mask: DataFrame, diagonal: bool = True, width: int = 1 << 20) -> DataFrame:
    """(z, y, x, label) of mask rows (z, y, x); a label is the least y * width + x of its component.

    Components are found inside tiles; only those that touch across the tiles' borders are joined by rounds over tables.
    """
    ones = mask.select("z", "y", "x", F.lit(1).alias("v"))
    blocks = to_blocks(ones, ["z"], "u1", sized=False)
    schema = T.StructType([blocks.schema["z"], *(T.StructField(c, T.LongType()) for c in ("y", "x", "local")), T.StructField("at_edge", T.BooleanType())])
    side = tiles.SIDE

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                y0, x0, ny, nx = (batch.column(c)[i].as_py() for c in ("at_y", "at_x", "n_y", "n_x"))
                on = np.frombuffer(batch.column("data")[i].as_buffer(), "u1").reshape(ny, nx) == 1
                y, x, fy, fx = first_pixels(on, diagonal)
                y, x, first = y + y0, x + x0, (fy + y0) * width + fx + x0
                edge = ((y % side == 0) & (y > 0)) | (y % side == side - 1) | ((x % side == 0) & (x > 0)) | (x % side == side - 1)
                yield pa.RecordBatch.from_arrays([*repeated(batch.slice(i, 1), ["z"], len(y)).values(), *map(pa.array, (y, x, first, edge))], names=["z", "y", "x", "local", "at_edge"])

    found = checkpointed(blocks.mapInArrow(local, schema))
    roots = _across(found.where("at_edge").select("z", "y", "x", "local"), diagonal)
    if roots is None:
        return found.select("z", "y", "x", F.col("local").alias("label"))
    return found.join(roots.withColumnRenamed("node", "local"), ["z", "local"], "left").select("z", "y", "x", F.coalesce("root", "local").alias("label"))


def component_stats(labels: DataFrame) -> DataFrame:
    """(z, label, area, x_min, y_min, w, h) of each component."""
    return labels.groupBy("z", "label").agg(
        F.count("*").alias("area"), F.min("x").alias("x_min"), F.min("y").alias("y_min"), (F.max("x") - F.min("x") + 1).alias("w"), (F.max("y") - F.min("y") + 1).alias("h")
    )


def fill_holes(pixels: DataFrame, area: int | Column) -> DataFrame:
    """Dense binary planes with background components (4-connected) of fewer pixels than ``area`` filled.

    ``area`` is a number or an expression of a plane's height ``h`` and width ``w``.
    """
    dense = pixels.select("z", "y", "x", F.col("v").cast("long").alias("v"))
    return tiles.as_pixels(fill_blocks(to_blocks(dense, ["z"], "u1", MISSING, sized=False), area), ["z"], "u1", MISSING)


def fill_blocks(blocks: DataFrame, area: int | Column, width: int = 1 << 20) -> DataFrame:
    """:func:`fill_holes` from blocks, one for each tile, to blocks.

    Background is labelled inside tiles, which give a row for each component and one for each pixel at their borders; what those are
    joined to is known by rounds over tables, and the labels to fill come back to their block as one list.
    """
    blocks = checkpointed(blocks)
    side, names = tiles.SIDE, blocks.columns
    place = [T.StructField(c, T.LongType()) for c in ("at_y", "at_x")]
    rest = [T.StructField(c, T.LongType()) for c in ("local", "n", "y", "x", "h", "w")]

    def background(batch: pa.RecordBatch, i: int) -> tuple:
        y0, x0, ny, nx = (batch.column(c)[i].as_py() for c in ("at_y", "at_x", "n_y", "n_x"))
        a = np.frombuffer(batch.column("data")[i].as_buffer(), "u1").reshape(ny, nx)
        y, x, fy, fx = first_pixels(a == 0, False)
        return a, y0, x0, y, x, (fy + y0) * width + fx + x0

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, y0, x0, y, x, local = background(batch, i)
                labels, n = np.unique(local, return_counts=True)
                y, x = y + y0, x + x0
                edge = ((y % side == 0) & (y > 0)) | (y % side == side - 1) | ((x % side == 0) & (x > 0)) | (x % side == side - 1)
                there = np.argwhere(a != MISSING).max(axis=0) + 1
                # Components have a number of pixels, border pixels a place, and a row with neither has the ends of the block.
                total = len(labels) + int(edge.sum()) + 1
                pad = lambda v, at: pa.array([None] * at + v.tolist() + [None] * (total - at - len(v)), pa.int64())  # noqa: B023, E731
                columns = [
                    pa.array([y0] * total), pa.array([x0] * total), pad(np.concatenate([labels, local[edge]]), 0), pad(n, 0), pad(y[edge], len(labels)), pad(x[edge], len(labels)),
                    pad(np.array([there[0] + y0]), total - 1), pad(np.array([there[1] + x0]), total - 1),
                ]
                yield pa.RecordBatch.from_arrays([*repeated(batch.slice(i, 1), ["z"], total).values(), *columns], names=["z", "at_y", "at_x", *(f.name for f in rest)])

    found = checkpointed(blocks.mapInArrow(summary, T.StructType([blocks.schema["z"], *place, *rest])))
    roots = _across(found.where("y is not null").select("z", "y", "x", "local"), diagonal=False)
    parts = found.where("n is not null").select("z", "at_y", "at_x", "local", "n")
    parts = parts.withColumn("label", F.col("local")) if roots is None else parts.join(roots.withColumnRenamed("node", "local"), ["z", "local"], "left").withColumn("label", F.coalesce("root", "local"))
    size = found.groupBy("z").agg(F.max("h").alias("h"), F.max("w").alias("w"))
    few = parts.groupBy("z", "label").agg(F.sum("n").alias("count")).join(size, "z").where(F.col("count") < area).select("z", "label")
    holes = parts.join(few, ["z", "label"], "left_semi").groupBy("z", "at_y", "at_x").agg(F.collect_list("local").alias("holes"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = []
            for i in range(batch.num_rows):
                own = batch.column("holes")[i].as_py()
                if own:
                    a, _, _, y, x, local = background(batch, i)
                    a, hit = a.copy(), np.isin(local, own)
                    a[y[hit], x[hit]] = 1
                    data.append(a.tobytes())
                else:
                    data.append(batch.column("data")[i].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary()) if c == "data" else batch.column(c) for c in names], names=names)

    return blocks.join(holes, ["z", "at_y", "at_x"], "left").select(*names, "holes").mapInArrow(fill, blocks.schema)


def top_components(stats: DataFrame, n: int, plane: int | None = None) -> DataFrame:
    """The n components of largest area of each plane; all that tie with the last one stay.

    With ``plane``, the pixels of a plane, the cut is the area in place n + 1 with the background among them, as in
    the workflow that this repeats: a background smaller than a component lets one component more stay.
    """
    whole = Window.partitionBy("z")
    rank = F.rank().over(whole.orderBy(F.desc("area")))
    if plane is not None:
        background = F.lit(plane) - F.sum("area").over(whole)
        rank = rank - 1 + (background > F.col("area")).cast("int")
    return stats.withColumn("r", rank).where(F.col("r") <= n).drop("r")


def renumber(stats: DataFrame) -> DataFrame:
    """Numbers 1, 2, ... of the kept components of each plane, in the order of their labels."""
    return stats.withColumn("number", F.dense_rank().over(Window.partitionBy("z").orderBy("label")).cast("long"))


def centroids(labels: DataFrame) -> DataFrame:
    return labels.groupBy("z", "label").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))


def u_order(points: DataFrame) -> DataFrame:
    """Index from 1: the left half (by cx) from the largest cy down, then the right half from the smallest cy up."""
    by_x = points.withColumn("r", F.row_number().over(Window.partitionBy("z").orderBy("cx", "label"))).withColumn("n", F.count("*").over(Window.partitionBy("z")))
    half = (F.col("r") > F.expr("n div 2")).cast("int")
    key = F.when(half == 0, -F.col("cy")).otherwise(F.col("cy"))
    return by_x.withColumn("idx", F.row_number().over(Window.partitionBy("z").orderBy(half, key, "r")).cast("long")).drop("r", "n")


def label_mode(under: DataFrame) -> DataFrame:
    """Most frequent label of each plane, background 0 included, the lowest on ties."""
    return under.groupBy("z").agg(F.mode("label", True).alias("label"))
