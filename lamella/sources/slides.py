"""Slides as a data source: ``spark.read.format("slides")`` with bands of segments as partitions.

Filters on z, c, y and x, and boxes given as an option, decide which segments are opened.  The driver reads
only the directories of the pages; the places of segments, which can be many, are read by the tasks that open them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from . import tiff

#: Samples that a partition holds at least, if its page has as many.
BAND = 1 << 22
#: Bytes of a tag's values up to which they are read with the directory.
SMALL = 256
AXES = ("z", "c", "y", "x")


class Band(InputPartition):
    """Rows ``first`` to ``last`` of segments of the page at ``at`` in a file, whose first channel is ``channel``."""

    def __init__(self, path: str, z: int, channel: int, at: int, first: int, last: int):
        self.path, self.z, self.channel, self.at, self.first, self.last = path, z, channel, at, first, last


def _shape(tags: dict) -> SimpleNamespace:
    """How a page is cut into segments."""
    one = lambda tag, other: tags.get(tag, (other,))[0]
    high, wide, tiled = one(tiff.HEIGHT, 0), one(tiff.WIDTH, 0), tiff.TILES in tags
    rows, columns = (one(tiff.TILE_HEIGHT, 0), one(tiff.TILE_WIDTH, 0)) if tiled else (min(one(tiff.STRIP_ROWS, high), high), wide)
    apart = one(tiff.PLANAR, 1) == 2
    return SimpleNamespace(high=high, wide=wide, rows=rows, columns=columns, down=-(-high // rows), across=-(-wide // columns), apart=apart, samples=one(tiff.SAMPLES, 1), places=tiff.TILES if tiled else tiff.STRIPS, sizes=tiff.TILE_BYTES if tiled else tiff.STRIP_BYTES)


class SlideReader(DataSourceReader):
    def __init__(self, options: dict, kind: str):
        self.path, self.suffix, self.level, self.kind = options["path"], options.get("suffix", "qptiff"), int(options.get("level", 0)), kind
        self.boxes = [tuple(b) for b in json.loads(options["boxes"])] if "boxes" in options else None
        self.low, self.high, self.only = dict.fromkeys(AXES, 0), dict.fromkeys(AXES, 1 << 62), {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Narrows what is opened; Spark still checks each row."""
        for f in filters:
            name = getattr(f, "attribute", (None,))[-1]
            if name in AXES:
                if isinstance(f, EqualTo):
                    self.low[name], self.high[name] = max(self.low[name], f.value), min(self.high[name], f.value)
                elif isinstance(f, In):
                    self.only[name] = self.only.get(name, set(f.value)) & set(f.value)
                elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self.low[name] = max(self.low[name], f.value + isinstance(f, GreaterThan))
                elif isinstance(f, (LessThan, LessThanOrEqual)):
                    self.high[name] = min(self.high[name], f.value - isinstance(f, LessThan))
            yield f

    def _wanted(self, name: str, first: int, last: int) -> bool:
        return self.low[name] <= last and first <= self.high[name] and (name not in self.only or any(first <= v <= last for v in self.only[name]))

    def _in_boxes(self, z: int, y: int, x: int, rows: int, columns: int) -> bool:
        return self.boxes is None or any(b == z and x < x2 and x + columns > x1 and y < y2 and y + rows > y1 for b, x1, y1, x2, y2 in self.boxes)

    def _opened(self, z: int, y: int, x: int, rows: int, columns: int) -> bool:
        return self._wanted("y", y, y + rows - 1) and self._wanted("x", x, x + columns - 1) and self._in_boxes(z, y, x, rows, columns)

    def partitions(self) -> list[Band]:
        out = []
        for z, path in enumerate(tiff.slide_paths(self.path, self.suffix)):
            if not self._wanted("z", z, z) or self.boxes is not None and all(b[0] != z for b in self.boxes):
                continue
            with tiff._open(path) as f:
                pages = tiff._level(tiff._pages(f, SMALL), self.level)
            channel = 0
            for tags in pages:
                s = _shape(tags)
                many = max(1, BAND // max(1, s.rows * s.wide * (1 if s.apart else s.samples)))
                if self._wanted("c", channel, channel + s.samples - 1):
                    lines = [r for r in range(s.down) if any(self._opened(z, r * s.rows, k * s.columns, s.rows, s.columns) for k in range(s.across))]
                    # Rows of segments that are wanted, in lots of neighbours.
                    lots = [[r for r in lines if r // many == k] for k in sorted({r // many for r in lines})]
                    out += [Band(path, z, channel, tags[tiff.AT][0], lot[0], lot[-1]) for lot in lots]
                channel += s.samples
        return out

    def read(self, partition: Band | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # so Spark reads a source without partitions
            return
        with tiff._open(partition.path) as f:
            tags = tiff._directory(f, partition.at, SMALL)
            s = _shape(tags)
            one = lambda tag, other: tags.get(tag, (other,))[0]
            for plane in range(s.samples if s.apart else 1):
                channel = partition.channel + plane
                if not self._wanted("c", channel, channel + (0 if s.apart else s.samples - 1)):
                    continue
                for row in range(partition.first, partition.last + 1):
                    start = (plane * s.down + row) * s.across
                    places, sizes = (tiff._values(f, tags, tag, start, s.across) for tag in (s.places, s.sizes))
                    for k, (offset, n) in enumerate(zip(places, sizes, strict=True)):
                        y, x = row * s.rows, k * s.columns
                        if self._opened(partition.z, y, x, s.rows, s.columns):
                            yield from self._segment(f, partition, channel, y, x, SimpleNamespace(
                                path=partition.path, offset=offset, bytes=n, rows=min(s.rows, s.high - y), line=s.columns, columns=min(s.columns, s.wide - x), samples=1 if s.apart else s.samples, order=tags[0][0],
                                bits=one(tiff.BITS, 1), format=one(tiff.FORMAT, 1), compression=one(tiff.COMPRESSION, 1), predictor=one(tiff.PREDICTOR, 1),
                            ))

    def _segment(self, f, partition: Band, channel: int, y0: int, x0: int, segment: SimpleNamespace) -> Iterator[pa.RecordBatch]:
        for first, block in tiff._lines(f, segment):
            block = block[:, : segment.columns]
            y, x, c = (i.ravel() for i in np.indices(block.shape))
            columns = [np.full(len(y), partition.z), c + channel, y + y0 + first, x + x0, block.ravel().astype("f8" if self.kind == "double" else "i8")]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], names=[*AXES, "v"])


class SlideSource(DataSource):
    """Options: path (a file, or a folder of files with ``suffix``), level, kind ('long' or 'double'), boxes (JSON rows z, x1, y1, x2, y2)."""

    @classmethod
    def name(cls) -> str:
        return "slides"

    def schema(self) -> str:
        return f"z long, c long, y long, x long, v {self.options.get('kind', 'long')}"

    def reader(self, schema) -> SlideReader:
        return SlideReader(dict(self.options), self.options.get("kind", "long"))


def read_slides(spark: SparkSession, path: str, suffix: str = "qptiff", level: int = 0, kind: str = "long", boxes: list[tuple[int, int, int, int, int]] | None = None) -> DataFrame:
    """Pixels (z, c, y, x, v) as of :func:`tiff.read_tiff`, by the data source: filters on z, c, y and x open only what they need.

    With ``boxes`` (z, x1, y1, x2, y2; few, as objects of slices are) only segments that meet one of their slice are opened;
    pixels of these segments outside the boxes are there too.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SlideSource)
    reader = spark.read.format("slides").options(suffix=suffix, level=level, kind=kind)
    if boxes is not None:
        reader = reader.option("boxes", json.dumps([[int(v) for v in b] for b in boxes]))
    return reader.load(path)
