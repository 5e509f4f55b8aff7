"""Outputs: trial records as JSON, label planes as PNG files, stacks as Parquet by tissue."""

from __future__ import annotations

import struct
import uuid
import zlib

from pyspark.sql import DataFrame, functions as F

from ..operators.raster import minmax_normalize


def write_trials(trials: DataFrame, folder: str) -> None:
    """One JSON record {number, value, params} on each line, best first; that of each tissue with its ``idx``."""
    tissue = [c for c in trials.columns if c == "idx"]
    trials.select(*tissue, "number", "value", "params").orderBy(*tissue, F.desc("value"), "number").coalesce(1).write.mode("errorifexists").json(folder)  # a study's few trials


def label_colours(labels: DataFrame) -> DataFrame:
    """(z, y, x, r, g, b): a colour by the label's number, the same on all slices; the background, 0, is black."""
    part = lambda k, s: F.when(F.col("label") == 0, 0).otherwise((F.col("label") * k + s) % 255 + 1).cast("long")
    return labels.select("z", "y", "x", part(73, 11).alias("r"), part(151, 83).alias("g"), part(199, 157).alias("b"))


def grey_levels(pixels: DataFrame) -> DataFrame:
    """(z, y, x, r, g, b): each plane stretched to 0 to 255, in grey."""
    return minmax_normalize(pixels).select("z", "y", "x", *(F.col("v").alias(c) for c in "rgb"))


def _png(width: int, height: int, rgb: bytes) -> bytes:
    lines = b"".join(b"\0" + rgb[y * 3 * width : (y + 1) * 3 * width] for y in range(height))
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def png_tiles(colours: DataFrame, side: int = 2048) -> DataFrame:
    """(z, ty, tx, png) of planes (z, y, x, r, g, b): PNG images of at most side x side pixels, so that a task holds one tile.

    Missing pixels are black.
    """
    kind = next(f.dataType.simpleString() for f in colours.schema if f.name == "z")

    def draw(pdf):
        ty, tx = int(pdf["ty"].iloc[0]), int(pdf["tx"].iloc[0])
        y, x = pdf["y"].to_numpy() - ty * side, pdf["x"].to_numpy() - tx * side
        height, width = int(y.max()) + 1, int(x.max()) + 1
        image = bytearray(3 * width * height)
        for k, c in enumerate("rgb"):
            for at, v in zip(((y * width + x) * 3 + k).tolist(), pdf[c].tolist(), strict=True):
                image[at] = v
        return pdf[["z", "ty", "tx"]].iloc[:1].assign(png=[_png(width, height, bytes(image))])

    tiles = colours.withColumns({"ty": F.expr(f"y div {side}"), "tx": F.expr(f"x div {side}")})
    return tiles.groupBy("z", "ty", "tx").applyInPandas(draw, f"z {kind}, ty long, tx long, png binary")


def write_stacks(stacks: DataFrame, path: str, tissue: str = "idx") -> None:
    """Pixels of stacks as Parquet, a folder for each tissue, its rows in the order of slices and channels."""
    stacks.repartition(tissue, "z").sortWithinPartitions(tissue, "z", "c", "y", "x").write.partitionBy(tissue).parquet(path)


def write_images(tiles: DataFrame, folder: str, prefix: str) -> DataFrame:
    """Tiles of :func:`png_tiles` as files ``<folder>/<prefix>_<z>_<ty>_<tx>.png``; (path) of those written.

    A task writes a file under a name of its attempt and then gives it its own, so that repeated tasks do no harm.
    """

    def write(frames):
        from .tiff import fs_of

        for frame in frames:
            out = []
            for z, ty, tx, png in frame[["z", "ty", "tx", "png"]].itertuples(index=False):
                path = f"{folder}/{prefix}_{z}_{ty}_{tx}.png"
                system, place = fs_of(path)
                system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(own := f"{place}.{uuid.uuid4().hex}.part") as f:
                    f.write(png)
                system.move(own, place)
                out.append(path)
            yield frame.iloc[:0].__class__({"path": out})

    return tiles.mapInPandas(write, "path string")
