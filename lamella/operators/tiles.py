"""Planes as blocks of pixels: what a neighbourhood needs from other tiles is exchanged as strips.

A block is a rectangle of one plane as bytes.  :func:`deal` sends each block's parts to the square tiles
whose surroundings they lie in, so the bytes shuffled are those of the plane and of the tiles' borders, and a
task works on one tile with its surroundings at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

#: Pixels of a tile's side; the height and width of planes whose end isn't known.
SIDE, ENDLESS = 512, 1 << 40
#: What isn't there in blocks of 0 and 1.
MISSING = 255

PLACE = ["height", "width", "at_y", "at_x", "n_y", "n_x"]
_BLOCK = [*(T.StructField(c, T.LongType()) for c in PLACE), T.StructField("data", T.BinaryType())]


@dataclass
class Tile:
    """The pixels ``a`` from (y, x) of a plane of height x width; those from (top, left) to (bottom, right) are the tile's own."""

    a: np.ndarray
    y: int
    x: int
    top: int
    left: int
    bottom: int
    right: int
    height: int
    width: int

    @property
    def own(self) -> tuple[slice, slice]:
        return slice(self.top - self.y, self.bottom - self.y), slice(self.left - self.x, self.right - self.x)


def fields(df: DataFrame, keys: list[str]) -> list[T.StructField]:
    return [df.schema[k] for k in keys]


def repeated(table: pa.Table | pa.RecordBatch, keys: list[str], n: int) -> dict[str, pa.Array]:
    """The keys of a table's first row, n times."""
    return {k: table.column(k).take(pa.array(np.zeros(n, np.int64))) for k in keys}


def to_blocks(pixels: DataFrame, keys: list[str], dtype: str, missing: float = 0, side: int | None = None, sized: bool = True) -> DataFrame:
    """Blocks (keys, height, width, at_y, at_x, n_y, n_x, data) of pixels (keys, y, x, v), one for each tile with pixels.

    Without ``sized`` planes have no known end, and what isn't there is ``missing``.
    """
    side = side or SIDE
    cells = pixels.select(*keys, F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), "v")
    cells = cells.withColumns({"ty": F.expr(f"y div {side}"), "tx": F.expr(f"x div {side}")})

    def gather(table: pa.Table) -> pa.Table:
        y, x, v = (table.column(c).to_numpy() for c in ("y", "x", "v"))
        y0, x0 = int(y.min()), int(x.min())
        a = np.full((int(y.max()) - y0 + 1, int(x.max()) - x0 + 1), missing, dtype)
        a[y - y0, x - x0] = v
        return block_table(table, keys, a, y0, x0, ENDLESS, ENDLESS)

    blocks = cells.groupBy(*keys, "ty", "tx").applyInArrow(gather, T.StructType([*fields(cells, keys), *_BLOCK]))
    if not sized:
        return blocks
    size = pixels.groupBy(*keys).agg((F.max("y") + 1).cast("long").alias("height"), (F.max("x") + 1).cast("long").alias("width"))
    return blocks.drop("height", "width").join(size, keys).select(*keys, *PLACE, "data")


def _strips(keys: list[str], dtype: str, side: int, reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                height, width, y0, x0, ny, nx = (batch.column(c)[i].as_py() for c in PLACE)
                a = np.frombuffer(batch.column("data")[i].as_buffer(), dtype).reshape(ny, nx)
                near = lambda first, n, whole: range(max(0, first - reach) // side, min(whole - 1, first + n - 1 + reach) // side + 1)
                rows = []
                for ty in near(y0, ny, height):
                    ya, yz = max(y0, ty * side - reach), min(y0 + ny, (ty + 1) * side + reach)
                    for tx in near(x0, nx, width):
                        xa, xz = max(x0, tx * side - reach), min(x0 + nx, (tx + 1) * side + reach)
                        rows.append((ty, tx, height, width, ya, xa, yz - ya, xz - xa, a[ya - y0 : yz - y0, xa - x0 : xz - x0].tobytes()))
                columns = [pa.array(c, pa.binary() if k == 8 else pa.int64()) for k, c in enumerate(zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays([*repeated(batch.slice(i, 1), keys, len(rows)).values(), *columns], names=[*keys, "ty", "tx", *PLACE, "data"])

    return run


def deal(blocks: DataFrame, keys: list[str], dtype: str, reach: int, work: Callable[[Tile, pa.Table], pa.Table], schema: T.StructType, missing: float = 0, side: int | None = None) -> DataFrame:
    """What ``work`` makes of each tile with ``reach`` pixels around it (fewer at the plane's edges), from blocks of any places and sizes.

    ``work`` gets the tile and a table that begins with the tile's keys.
    """
    side = side or SIDE
    dealt = T.StructType([*fields(blocks, keys), T.StructField("ty", T.LongType()), T.StructField("tx", T.LongType()), *_BLOCK])

    def assemble(table: pa.Table) -> pa.Table:
        ty, tx, height, width = (table.column(c)[0].as_py() for c in ("ty", "tx", "height", "width"))
        top, left, bottom, right = ty * side, tx * side, min(height, (ty + 1) * side), min(width, (tx + 1) * side)
        y, x = max(0, top - reach), max(0, left - reach)
        a = np.full((min(height, bottom + reach) - y, min(width, right + reach) - x), missing, dtype)
        for i in range(len(table)):
            ya, xa, ny, nx = (table.column(c)[i].as_py() for c in PLACE[2:])
            a[ya - y : ya - y + ny, xa - x : xa - x + nx] = np.frombuffer(table.column("data")[i].as_buffer(), dtype).reshape(ny, nx)
        return work(Tile(a, y, x, top, left, bottom, right, height, width), table)

    # Few bytes, much work: a number of partitions keeps tiles from being coalesced by their size.
    parts = blocks.mapInArrow(_strips(keys, dtype, side, reach), dealt).repartition(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "ty", "tx")
    return parts.groupBy(*keys, "ty", "tx").applyInArrow(assemble, schema)


def as_pixels(blocks: DataFrame, keys: list[str], dtype: str, missing: float | None = None, kind: str = "long") -> DataFrame:
    """Pixels (keys, y, x, v) of blocks; those equal to ``missing`` have no row."""
    schema = T.StructType([*fields(blocks, keys), *(T.StructField(c, T.LongType()) for c in "yx"), T.StructField("v", T._parse_datatype_string(kind))])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                y0, x0, ny, nx = (batch.column(c)[i].as_py() for c in PLACE[2:])
                a = np.frombuffer(batch.column("data")[i].as_buffer(), dtype).reshape(ny, nx)
                y, x = np.indices(a.shape).reshape(2, -1)
                if missing is not None:
                    y, x = np.nonzero(a != missing)
                v = a[y, x].astype("i8" if kind == "long" else "f8")
                yield pa.RecordBatch.from_arrays([*repeated(batch.slice(i, 1), keys, len(y)).values(), pa.array(y + y0), pa.array(x + x0), pa.array(v)], names=[*keys, "y", "x", "v"])

    return blocks.mapInArrow(spread, schema)


def block_table(table: pa.Table, keys: list[str], a: np.ndarray, y: int, x: int, height: int, width: int) -> pa.Table:
    """One block as a result of ``work``."""
    numbers = zip(PLACE, (height, width, y, x, *a.shape), strict=True)
    return pa.table({**repeated(table, keys, 1), **{k: pa.array([n], pa.int64()) for k, n in numbers}, "data": pa.array([a.tobytes()], pa.binary())})


def trimmed(block: pa.Table, keys: list[str], a: np.ndarray, y: int, x: int, height: int, width: int, missing: float) -> pa.Table:
    """:func:`block_table` of the smallest rectangle that holds all but ``missing``, so that a block is no larger than its pixels' span; no row without pixels."""
    ys, xs = (np.flatnonzero((a != missing).any(axis=i)) for i in (1, 0))
    if not len(ys):
        return block_table(block, keys, a[:1, :1], y, x, height, width).slice(0, 0)
    return block_table(block, keys, a[ys[0] : ys[-1] + 1, xs[0] : xs[-1] + 1], y + int(ys[0]), x + int(xs[0]), height, width)


def block_schema(df: DataFrame, keys: list[str]) -> T.StructType:
    return T.StructType([*fields(df, keys), *_BLOCK])
