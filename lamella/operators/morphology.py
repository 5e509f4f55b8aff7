"""Morphology on binary planes (z, y, x, v of 0 and 1), tile by tile.

A sequence of steps is one exchange of strips between tiles, as wide as all its kernels reach; inside a tile a
rectangle is two passes of differences of running sums, so the cost doesn't depend on the kernel's size.
Pixels outside the plane, and missing ones, never count.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .raster import median_filter
from .tiles import MISSING, SIDE, Tile, as_pixels, block_schema, block_table, deal, to_blocks, trimmed


def as_blocks(df: DataFrame) -> DataFrame:
    """Blocks of planes of 0 and 1, for a chain of steps without pixels as rows between them."""
    return to_blocks(df, ["z"], "u1", MISSING, sized=False)


def from_blocks(blocks: DataFrame) -> DataFrame:
    return as_pixels(blocks, ["z"], "u1", MISSING)


def _changed(blocks: DataFrame, reach: int, change: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Blocks of 0 and 1 after ``change`` of each tile with ``reach`` pixels around it."""

    def work(tile: Tile, table):
        a = np.where(tile.a == MISSING, MISSING, change(tile.a))[tile.own].astype("u1")
        return trimmed(table, ["z"], a, tile.top, tile.left, tile.height, tile.width, MISSING)

    return deal(blocks, ["z"], "u1", reach, work, block_schema(blocks, ["z"]), MISSING)


def _tiled(df: DataFrame, reach: int, change: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Planes of 0 and 1 after ``change`` of each tile with ``reach`` pixels around it."""
    return from_blocks(_changed(as_blocks(df), reach, change))


def _counts(on: np.ndarray, first: int, last: int, axis: int) -> np.ndarray:
    """Set pixels from ``first`` to ``last`` places on along an axis."""
    n = on.shape[axis]
    upto = np.concatenate([np.zeros_like(on.take([0], axis), np.int32), np.cumsum(on, axis, dtype=np.int32)], axis)
    at = np.arange(n)
    return upto.take(np.clip(at + last + 1, 0, n), axis) - upto.take(np.clip(at + first, 0, n), axis)


def _rectangle(a: np.ndarray, k: int, erode: bool) -> np.ndarray:
    here = a != MISSING
    for axis in (1, 0):
        on = _counts(a == 1, -(k // 2), k - 1 - k // 2, axis)
        a = np.where(here, on == _counts(here, -(k // 2), k - 1 - k // 2, axis) if erode else on > 0, MISSING)
    return a


def steps(df: DataFrame, sizes: list[tuple[int, bool]]) -> DataFrame:
    """Erosions (True) and dilations with squares of the given sizes, one after the other; sizes below 1 stand for 3."""
    return from_blocks(block_steps(as_blocks(df), sizes))


def block_steps(blocks: DataFrame, sizes: list[tuple[int, bool]]) -> DataFrame:
    """:func:`steps` from blocks to blocks."""
    sizes = [(k if k >= 1 else 3, erode) for k, erode in sizes]

    def change(a: np.ndarray) -> np.ndarray:
        for k, erode in sizes:
            a = _rectangle(a, k, erode)
        return a

    return _changed(blocks, sum(k // 2 for k, _ in sizes), change)


def dilate(df: DataFrame, k: int, times: int = 1) -> DataFrame:
    return steps(df, [(k, False)] * times)


def erode(df: DataFrame, k: int, times: int = 1) -> DataFrame:
    return steps(df, [(k, True)] * times)


#: Steps of an operation, True for an erosion; any other name, 'erode' too, has none.
OPERATIONS = {"opening": (True, False), "closing": (False, True), "dilation": (False,), "erosion": (True,)}


def sequence(df: DataFrame, operations: list[tuple[str, int]]) -> DataFrame:
    """Operations ('opening', 'closing', 'dilation', 'erosion') with their sizes, in one exchange; any other name changes nothing."""
    sizes = _sizes(operations)
    return steps(df, sizes) if sizes else df


def block_sequence(blocks: DataFrame, operations: list[tuple[str, int]]) -> DataFrame:
    """:func:`sequence` from blocks to blocks."""
    sizes = _sizes(operations)
    return block_steps(blocks, sizes) if sizes else blocks


def _sizes(operations: list[tuple[str, int]]) -> list[tuple[int, bool]]:
    return [(k, erode) for name, k in operations for erode in OPERATIONS.get(name, ())]


def morphology(df: DataFrame, k: int, operation: str) -> DataFrame:
    """'opening', 'closing', 'dilation' or 'erosion'; any other name, 'erode' too, leaves the planes as they are."""
    return sequence(df, [(operation, k)])


def ellipse(k: int) -> list[tuple[int, int, int]]:
    """Rows (dy, first dx, last dx) of the ellipse inscribed in k x k."""
    if k < 1:
        raise ValueError("an elliptic kernel needs a size of 1 or more")
    r = k // 2
    out = []
    for i in range(k):
        dy = i - r
        reach = round(r * (1 - (dy / r) ** 2) ** 0.5) if r else 0
        out.append((dy, max(-r, -reach), min(k - 1 - r, reach)))
    return out


def ellipse_open(df: DataFrame, k: int) -> DataFrame:
    """Erosion and dilation with an ellipse: counts in ranges of each line, shifted over the lines, inside one tile."""
    rows = ellipse(k)

    def any_under(on: np.ndarray) -> np.ndarray:
        """Where a pixel under the kernel is set."""
        out, n = np.zeros(on.shape, bool), len(on)
        lines = {(a, b): _counts(on, a, b, 1) > 0 for _, a, b in rows}
        for dy, a, b in rows:
            out[max(-dy, 0) : n - max(dy, 0)] |= lines[a, b][max(dy, 0) : n - max(-dy, 0)]
        return out

    return _tiled(df, 2 * (k // 2), lambda a: any_under((a != MISSING) & ~any_under(a == 0)))


def remove_islands(planes: DataFrame, noise: int = 3, blob: int = 3) -> DataFrame:
    """Dense binary planes (0 and anything above) without lone pixels and small blobs: a median, then an elliptic opening."""
    on = planes.select("z", "y", "x", (F.col("v") > 0).cast("long").alias("v"))
    return ellipse_open(median_filter(on, noise), blob)


def _cubic_weight(d: float) -> float:
    """Cubic convolution with a = -0.75."""
    d = abs(d)
    return (1.25 * d - 2.25) * d * d + 1 if d <= 1 else ((-0.75 * d + 3.75) * d - 6) * d + 3 if d < 2 else 0.0


def _cubic(df: DataFrame, sy: int, sx: int, finish: Callable[[np.ndarray], np.ndarray], dtype: str) -> DataFrame:
    """(z, y, x, v) that ``finish`` makes of scaled-up planes, rounded to six decimals; missing pixels are 0, edges are repeated, results of 0 have no row.

    A tile gets two pixels around it and adds up lines first, then columns; it is smaller, the larger it comes out.
    """
    side = max(SIDE // max(sy, sx), 16)
    sums = df.groupBy("z", "y", "x").agg(F.coalesce(F.sum("v"), F.lit(0)).cast("double").alias("v"))
    blocks = to_blocks(sums, ["z"], "f8", side=side)

    def spread(a: np.ndarray, s: int, first: int, last: int, begin: int, size: int) -> np.ndarray:
        """Lines first to last, scaled up, of a plane of ``size`` lines; ``a`` begins with its line ``begin``."""
        lines, out = np.arange(first, last), np.zeros((last - first, s, a.shape[1]))
        for t in range(s):
            at = (t + 0.5) / s - 0.5
            for k in range(math.floor(at) - 1, math.floor(at) + 3):
                out[:, t] += _cubic_weight(at - k) * a[np.clip(lines + k, 0, size - 1) - begin]
        return out.reshape(-1, a.shape[1])

    def work(tile: Tile, table):
        a = spread(tile.a, sy, tile.top, tile.bottom, tile.y, tile.height)
        a = spread(a.T, sx, tile.left, tile.right, tile.x, tile.width).T
        a = finish(np.copysign(np.floor(np.abs(a) * 1e6 + 0.5) / 1e6, a)).astype(dtype)
        return block_table(table, ["z"], a, tile.top * sy, tile.left * sx, tile.height * sy, tile.width * sx)

    return as_pixels(deal(blocks, ["z"], "f8", 2, work, block_schema(blocks, ["z"]), side=side), ["z"], dtype, 0)


def cubic_upsample(df: DataFrame, sy: int, sx: int) -> DataFrame:
    """Mask scaled up by cubic convolution (a = -0.75, edges repeated), positive after rounding: foreground rows (z, y, x)."""
    return _cubic(df.withColumn("v", (F.col("v") > 0).cast("long")), sy, sx, lambda s: s > 0.5, "u1").select("z", "y", "x")


def cubic_upsample_grey(df: DataFrame, sy: int, sx: int, top: int = 255) -> DataFrame:
    """Grey planes scaled up likewise, rounded half to even and kept within 0 to ``top``; pixels that come out as 0 have no row."""
    return _cubic(df, sy, sx, lambda s: np.clip(np.rint(s), 0, top), "i8")
