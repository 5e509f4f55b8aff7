"""TIFF slides as pixel tables, read segment by segment, and planes of stacks as TIFF files.

Headers are read in one job and give a row for each strip or tile; these are spread over the cluster
and decoded in blocks of rows, so that no task holds a plane.  Files are opened by their URI with
pyarrow's file systems.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from xml.sax.saxutils import quoteattr

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSelector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.labels import checkpointed
from .codecs import DECODERS, samples
from .rasters import order_files

# Numbers of tags, and struct codes of the types of their values.
WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, SAMPLES, STRIP_ROWS, STRIP_BYTES, PLANAR = 256, 257, 258, 259, 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, SUB_IFDS, FORMAT = 317, 322, 323, 324, 325, 330, 339
DESCRIPTION, X_RESOLUTION, Y_RESOLUTION, UNIT = 270, 282, 283, 296
CODES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "Q", 6: "b", 8: "h", 9: "i", 13: "I", 16: "Q", 17: "q", 18: "Q"}

#: Keys beside the tags of a directory, and what stands for values that aren't read yet.
AT, NEXT, LATER = -1, -2, "later"

#: Samples decoded at once.
BLOCK = 1 << 20

SEGMENT = "z long, path string, page int, sample int, y long, x long, rows long, columns long, line long, offset long, bytes long, bits int, format int, order string, compression int, predictor int, samples int"


def fs_of(path: str):
    """(file system, place in it) of a URI or an absolute path."""
    from pyarrow import fs

    if path.startswith("/"):
        path = f"file://{path}"
    return fs.FileSystem.from_uri("file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path)


def _open(path: str):
    system, name = fs_of(path)
    return system.open_input_file(name)


def _at(f, offset: int, n: int) -> bytes:
    f.seek(offset)
    return f.read(n)


def _form(f) -> tuple[str, bool]:
    """(byte order, whether it is a big TIFF)."""
    head = _at(f, 0, 4)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    kind = struct.unpack(order + "H", head[2:4])[0] if order and len(head) == 4 else 0
    if kind not in (42, 43):
        raise ValueError("not a TIFF file")
    return order, kind == 43


def _directory(f, at: int, most: int | None = None) -> dict[int, tuple]:
    """The tags of the directory at ``at``; further keys: 0 is the byte order, AT and NEXT the places of this directory and the next.

    Values of more than ``most`` bytes aren't read: see :func:`_values`.
    """
    order, big = _form(f)
    many, entry, word = ("Q", 20, "Q") if big else ("H", 12, "I")
    size, step = struct.calcsize(many), struct.calcsize(word)
    n = struct.unpack(order + many, _at(f, at, size))[0]
    body = _at(f, at + size, n * entry + step)
    tags: dict[int, tuple] = {0: (order,), AT: (at,), NEXT: struct.unpack(order + word, body[n * entry :])}
    for i in range(n):
        e = body[i * entry : (i + 1) * entry]
        tag, type_ = struct.unpack(order + "HH", e[:4])
        count = struct.unpack(order + word, e[4 : 4 + step])[0]
        if type_ in CODES:
            code, value = f"{order}{count}{CODES[type_]}", e[4 + step :]
            if struct.calcsize(code) > len(value):
                place = struct.unpack(order + word, value)[0]
                if most is not None and struct.calcsize(code) > most:
                    tags[tag] = (LATER, place, CODES[type_])
                    continue
                value = _at(f, place, struct.calcsize(code))
            tags[tag] = struct.unpack(code, value[: struct.calcsize(code)])
    return tags


def _values(f, tags: dict[int, tuple], tag: int, first: int, n: int) -> tuple:
    """n values of a tag from ``first`` on, whether or not they were read with the directory."""
    own = tags[tag]
    if own[0] is not LATER:
        return own[first : first + n]
    code = f"{tags[0][0]}{n}{own[2]}"
    return struct.unpack(code, _at(f, own[1] + first * struct.calcsize(tags[0][0] + own[2]), struct.calcsize(code)))


def _pages(f, most: int | None = None) -> list[list[dict[int, tuple]]]:
    """The tags of each page, followed by those of its smaller versions."""
    order, big = _form(f)
    at = struct.unpack(order + ("Q" if big else "I"), _at(f, 8 if big else 4, 8 if big else 4))[0]
    pages = []
    while at:
        tags = _directory(f, at, most)
        at = tags[NEXT][0]
        pages.append([tags, *(_directory(f, sub, most) for sub in tags.get(SUB_IFDS, ()))])
    return pages


def _micrometres(tags: dict[int, tuple], resolution: int) -> float | None:
    """A pixel's side by the pixels per inch or centimetre; a fraction is read as one number of 64 bits."""
    unit = {2: 25400.0, 3: 10000.0}.get(tags.get(UNIT, (2,))[0])
    if unit is None or resolution not in tags:
        return None
    high, low = divmod(tags[resolution][0], 1 << 32)
    over, under = (low, high) if tags[0][0] == "<" else (high, low)
    return unit * under / over if over else None


def _info(level: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for z, path in zip(frame["slice_id"], frame["path"], strict=True):
                with _open(path) as f:
                    pages = _pages(f)
                t, first = _level(pages, level)[0], pages[0][0]
                text = first.get(DESCRIPTION, (b"",))[0].rstrip(b"\0").decode("utf-8", "replace")
                out.append((z, path, t[HEIGHT][0], t[WIDTH][0], text if "<OME" in text else None, _micrometres(first, X_RESOLUTION), _micrometres(first, Y_RESOLUTION)))
            yield pd.DataFrame(out, columns=["slice_id", "path", "height", "width", "ome_xml", "x_um", "y_um"])

    return run


def _level(pages: list[list[dict]], level: int) -> list[dict]:
    """Pages of the largest size, or their smaller versions, or as many pages of the next smaller sizes."""
    size = lambda t: (t[HEIGHT][0], t[WIDTH][0])
    top = max((size(p[0]) for p in pages), key=lambda s: s[0] * s[1])
    whole = [p for p in pages if size(p[0]) == top]
    if level == 0 or all(len(p) > level for p in whole):
        return [p[level] for p in whole]
    sizes = sorted({size(p[0]) for p in pages}, key=lambda s: -s[0] * s[1])
    full = [s for s in sizes if sum(size(p[0]) == s for p in pages) == len(whole)]
    if level >= len(full):
        raise ValueError(f"the slide has no level {level}")
    return [p[0] for p in pages if size(p[0]) == full[level]]


def _segments(level: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in SEGMENT.split(", ")]
        for frame in frames:
            for z, path in zip(frame["slice_id"], frame["path"], strict=True):
                with _open(path) as f:
                    pages = _level(_pages(f), level)
                for page, t in enumerate(pages):
                    one = lambda tag, other: t.get(tag, (other,))[0]  # noqa: E731, B023
                    high, wide, samples = one(HEIGHT, 0), one(WIDTH, 0), one(SAMPLES, 1)
                    tiled = TILES in t
                    rows, columns = (one(TILE_HEIGHT, 0), one(TILE_WIDTH, 0)) if tiled else (min(one(STRIP_ROWS, high), high), wide)
                    down, right = -(-high // rows), -(-wide // columns)
                    apart = one(PLANAR, 1) == 2
                    out = []
                    for i, (offset, n) in enumerate(zip(t[TILES if tiled else STRIPS], t[TILE_BYTES if tiled else STRIP_BYTES], strict=True)):
                        sample, place = divmod(i, down * right) if apart else (0, i)
                        y, x = place // right * rows, place % right * columns
                        out.append((z, path, page * samples, sample, y, x, min(rows, high - y), min(columns, wide - x), columns, offset, n, one(BITS, 1), one(FORMAT, 1), t[0][0], one(COMPRESSION, 1), one(PREDICTOR, 1), 1 if apart else samples))
                    yield pd.DataFrame(out, columns=names)

    return run


def _lines(f, s) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, rows x line x samples) blocks of a segment."""
    if s.compression not in DECODERS:
        raise ValueError(f"compression {s.compression} of {s.path} can't be decoded: plain, LZW, deflate and PackBits can")
    sound = {1: (8, 16, 32), 2: (8, 16, 32), 3: (16, 32, 64)}
    if s.bits not in sound.get(s.format, ()) or s.predictor not in ((1, 3) if s.format == 3 else (1, 2)):
        raise ValueError(f"samples of {s.bits} bits with predictor {s.predictor} in {s.path} can't be decoded")
    at = 0

    def feed() -> bytes:
        nonlocal at
        part = _at(f, s.offset + at, min(BLOCK, s.bytes - at))
        at += len(part)
        return part

    stored, one = DECODERS[s.compression](feed), s.line * s.samples * s.bits // 8
    rows = max(1, BLOCK // (s.line * s.samples))
    for first in range(0, s.rows, rows):
        want = min(rows, s.rows - first) * one
        try:
            got = stored.read(want)
        except (ValueError, zlib.error) as e:
            raise ValueError(f"a segment of {s.path} at {s.offset} is damaged: {e}") from e
        if len(got) < want:
            raise ValueError(f"a segment of {s.path} at {s.offset} is too short")
        yield first, samples(got, s.order, s.bits, s.format, s.predictor, s.line, s.samples)


def _decode(kind: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for s in frame.itertuples(index=False):
                with _open(s.path) as f:
                    for first, block in _lines(f, s):
                        block = block[:, : s.columns]
                        y, x, c = (i.ravel() for i in np.indices(block.shape))
                        v = block.ravel().astype("f8" if kind == "double" else "i8")
                        yield pd.DataFrame({"z": s.z, "c": c + s.page + s.sample, "y": y + s.y + first, "x": x + s.x, "v": v})

    return run


def _files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    reader = spark.read.format("binaryFile")
    if not path.endswith(f".{suffix}"):
        reader = reader.option("pathGlobFilter", f"*.{suffix}")
    files = order_files(reader.load(path).select("path").withColumn("name", F.element_at(F.split("path", "/"), -1)))
    return files.select("slice_id", "path").repartition("path")


def slide_paths(path: str, suffix: str) -> list[str]:
    """The file, or the folder's files that end in ``suffix``, ordered as by :func:`order_files`; the listing is the driver's."""
    from pyarrow import fs

    if path.endswith(f".{suffix}"):
        return [path]
    system, folder = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    files = [i for i in system.get_file_info(fs.FileSelector(folder)) if i.is_file and i.base_name.endswith(f".{suffix}")]
    head = path.split("://")[0] + "://" if "://" in path else ""
    names = sorted(((i.base_name[:3].lower(), i.base_name) for i in files))
    return [f"{path.rstrip('/') if head else folder.rstrip('/')}/{name}" for _, name in names]


def slide_info(spark: SparkSession, path: str, suffix: str = "qptiff", level: int = 0) -> DataFrame:
    """(slice_id, path, height, width, ome_xml, x_um, y_um) of the same slides, a row each, from their headers.

    Height and width are those of ``level``; ome_xml is null without such a description, x_um and y_um are null without a
    resolution in inches or centimetres.
    """
    return _files(spark, path, suffix).mapInPandas(_info(level), "slice_id long, path string, height long, width long, ome_xml string, x_um double, y_um double")


def read_tiff(spark: SparkSession, path: str, suffix: str = "qptiff", level: int = 0, kind: str = "long") -> DataFrame:
    """Pixels (z, c, y, x, v) of a TIFF file or of the files of a folder that end in ``suffix``, in the order of ``slide_files``.

    Classic and big TIFF, strips and tiles, whole numbers of 8 to 32 bits and floating-point ones of 16 to 64, plain, LZW, deflate
    or PackBits, with or without differences; ``level`` picks a smaller version.  Pages of a slide are its channels, and so are a page's samples.  ``kind`` is the type of v, 'long' or
    'double'.  Other compressions and damaged files raise an error when read; a folder without slides gives no rows.
    """
    if kind not in ("long", "double"):
        raise ValueError("kind is 'long' or 'double'")
    segments = _files(spark, path, suffix).mapInPandas(_segments(level), SEGMENT)
    return segments.repartition("path", "page", "offset").mapInPandas(_decode(kind), f"z long, c long, y long, x long, v {kind}")


def _header(height: int, width: int, bits: int) -> bytes:
    """Everything before the samples of a big TIFF file with one plain strip."""
    size = height * width * bits // 8
    xml = f'<OME xmlns="http://www.openmicroscopy.org/Schemas/OME/2016-06"><Image ID="Image:0"><Pixels ID="Pixels:0" DimensionOrder="XYZCT" Type={quoteattr(f"uint{bits}")} SizeX="{width}" SizeY="{height}" SizeZ="1" SizeC="1" SizeT="1"><TiffData/></Pixels></Image></OME>\0'.encode()
    tags = [(WIDTH, 4, 1, width), (HEIGHT, 4, 1, height), (BITS, 3, 1, bits), (COMPRESSION, 3, 1, 1), (262, 3, 1, 1), (270, 2, len(xml), None), (STRIPS, 16, 1, None), (SAMPLES, 3, 1, 1), (STRIP_ROWS, 4, 1, height), (STRIP_BYTES, 16, 1, size)]
    after = 16 + 8 + 20 * len(tags) + 8
    entries = b"".join(struct.pack("<HHQQ", tag, type_, n, {270: after, STRIPS: after + len(xml)}.get(tag, value)) for tag, type_, n, value in tags)
    return struct.pack("<2sHHHQQ", b"II", 43, 8, 0, 16, len(tags)) + entries + struct.pack("<Q", 0) + xml


def write_planes(stacks: DataFrame, folder: str, bits: int = 16) -> DataFrame:
    """Each plane of stacks (idx, z, c, y, x, v) as ``<folder>/<idx>_<z>_<c>.ome.tif``; (idx, z, c, path, height, width) of those written.

    Rows of a plane come to one task in order and are written as they come, so that it holds one line and a batch.
    Missing pixels are 0; a value outside 0 to 2^bits - 1 raises an error.  The files are written when the result is read, under a name of
    the attempt until they are whole, and again, the same, if a task is repeated.
    """
    key = ["idx", "z", "c"]
    size = stacks.groupBy(*key).agg((F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width"))
    cells = stacks.select(*key, "y", "x", "v").join(size, key)
    kinds = {f.name: f.dataType.simpleString() for f in cells.schema}
    top = (1 << bits) - 1

    def write(frames: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        now, out, line, row = None, None, None, 0
        mark = f".{uuid.uuid4().hex}.part"

        def end() -> None:
            flush(height)
            out.close()
            system.move(place + mark, place)

        def flush(upto: int) -> None:
            nonlocal line, row
            while row < upto:
                out.write(line.tobytes())
                line[:] = 0
                row += 1

        for frame in frames:
            done = []
            for name, part in frame.groupby(key, sort=False):
                if name != now:
                    if out is not None:
                        end()
                    now, height, width = name, int(part["height"].iloc[0]), int(part["width"].iloc[0])
                    path = f"{folder}/{name[0]}_{name[1]}_{name[2]}.ome.tif"
                    system, place = fs_of(path)
                    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    out, line, row = system.open_output_stream(place + mark), np.zeros(width, f"<u{bits // 8}"), 0
                    out.write(_header(height, width, bits))
                    done.append((*name, path, height, width))
                y, x, v = (part[k].to_numpy() for k in "yxv")
                if len(v) and (v.min() < 0 or v.max() > top):
                    raise ValueError(f"values of {path} don't fit {bits} bits")
                cuts = np.flatnonzero(np.diff(y)) + 1
                for a, b in zip([0, *cuts], [*cuts, len(y)], strict=True):
                    flush(int(y[a]))
                    line[x[a:b]] = v[a:b]
            yield pd.DataFrame(done, columns=[*key, "path", "height", "width"])
        if out is not None:
            end()

    ordered = cells.repartition(*key).sortWithinPartitions(*key, "y", "x")
    return ordered.mapInPandas(write, ", ".join(f"{k} {kinds[k]}" for k in key) + ", path string, height long, width long")


#: Rows of a strip in files of whole stacks.
STRIP = 64


def ome_xml(height: Column, width: Column, slices: Column, channels: Column, names: list[str] | None = None, bits: int = 16, sizes: dict[str, float] | None = None) -> Column:
    """The description of a stack whose planes are ordered by slice, then channel; ``sizes`` are the micrometres of a pixel along X, Y and Z."""
    physical = "".join(f' PhysicalSize{d}="{sizes[d]!r}" PhysicalSize{d}Unit="µm"' for d in "XYZ" if sizes and d in sizes)
    text = lambda c: c.cast("string")
    named = F.create_map(*(F.lit(v) for i, n in enumerate(names or []) for v in (i, quoteattr(n)))) if names else F.create_map().cast("map<int,string>")
    tag = lambda i: F.concat(F.lit('<Channel ID="Channel:0:'), text(i), F.lit('" SamplesPerPixel="1"'), F.coalesce(F.concat(F.lit(" Name="), F.try_element_at(named, i)), F.lit("")), F.lit("/>"))
    list_ = F.array_join(F.transform(F.sequence(F.lit(0), channels.cast("int") - 1), tag), "")
    head = f'<OME xmlns="http://www.openmicroscopy.org/Schemas/OME/2016-06"><Image ID="Image:0"><Pixels ID="Pixels:0" DimensionOrder="XYCZT" Type="uint{bits}"{physical} SizeT="1"'
    return F.concat(F.lit(head), *(p for n, c in (("X", width), ("Y", height), ("Z", slices), ("C", channels)) for p in (F.lit(f' Size{n}="'), text(c), F.lit('"'))), F.lit(">"), list_, F.lit("<TiffData/></Pixels></Image></OME>"))


def _strip_data(bits: int, strip: int):
    """One compressed strip of a plane from its pixels; the row at y = -1 only says that there is a strip."""
    top, names = (1 << bits) - 1, ["file", "z", "c", "band", "height", "width"]

    def pack(table: pa.Table) -> pa.Table:
        file, _, _, band, height, width = (table.column(k)[0].as_py() for k in names)
        a = np.zeros((min(strip, height - band * strip), width), f"<u{bits // 8}")
        y, x, v = (table.column(k).to_numpy() for k in "yxv")
        real = y >= 0
        y, x, v = y[real], x[real], v[real]
        if len(v) and (v.min() < 0 or v.max() > top):
            raise ValueError(f"values of {file} don't fit {bits} bits")
        a[y - band * strip, x] = v
        data = zlib.compress(a.tobytes(), 6)
        return table.select(names).slice(0, 1).append_column("data", pa.array([data], pa.binary())).append_column("n", pa.array([len(data)], pa.int64()))

    return pack


def _stack_header(xml: bytes, planes: list[tuple[int, int]], sizes: np.ndarray, bits: int, strip: int) -> bytes:
    """Everything before the strips of a big TIFF file; ``planes`` are (height, width) in order, ``sizes`` the bytes of all strips."""

    def build(base: int) -> bytes:
        offsets = base + np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype("<u8") if len(sizes) else np.zeros(0, "<u8")
        out, at, done = [struct.pack("<2sHHHQ", b"II", 43, 8, 0, 16)], 16, 0
        for i, (height, width) in enumerate(planes):
            n = -(-height // strip)
            arrays = {STRIPS: offsets[done : done + n].astype("<u8").tobytes(), STRIP_BYTES: sizes[done : done + n].astype("<u8").tobytes()}
            if not i:
                arrays[DESCRIPTION] = xml + b"\0"
            done += n
            tags = [(WIDTH, 4, 1, width), (HEIGHT, 4, 1, height), (BITS, 3, 1, bits), (COMPRESSION, 3, 1, 8), (262, 3, 1, 1), *([(DESCRIPTION, 2, len(arrays[DESCRIPTION]), None)] if not i else []), (STRIPS, 16, n, None), (SAMPLES, 3, 1, 1), (STRIP_ROWS, 4, 1, strip), (STRIP_BYTES, 16, n, None)]
            after = at + 8 + 20 * len(tags) + 8
            entries, extra = [], b""
            for tag, type_, count, value in tags:
                if tag in arrays and len(arrays[tag]) > 8:
                    value = after + len(extra)
                    extra += arrays[tag] + bytes(-len(arrays[tag]) % 8)
                    entries.append(struct.pack("<HHQQ", tag, type_, count, value))
                elif tag in arrays:
                    entries.append(struct.pack("<HHQ8s", tag, type_, count, arrays[tag]))
                else:
                    entries.append(struct.pack("<HHQQ", tag, type_, count, value))
            following = after + len(extra) if i + 1 < len(planes) else 0
            out.append(struct.pack("<Q", len(tags)) + b"".join(entries) + struct.pack("<Q", following) + extra)
            at = after + len(extra)
        return b"".join(out)

    return build(len(build(0)))  # the length doesn't depend on the places


def write_stacks(pixels: DataFrame, descriptions: DataFrame, folder: str, bits: int = 16, strip: int = STRIP, mounted: bool | None = None) -> DataFrame:
    """Each ``file`` of pixels (file, z, c, y, x, v) as one big TIFF ``<folder>/<file>.ome.tif``, planes ordered by slice, then channel.

    ``descriptions`` (file, ome_xml) go to the first plane; a file without one has an empty description.  Missing pixels of a
    plane are 0; a plane is as large as its file's largest; a value outside 0 to 2^bits - 1 raises an error.  Returns (file, path, planes, height, width).

    Strips are compressed where their pixels meet and stored by Spark, so a repeated task does no harm.  Their places in
    the file are running sums of their lengths.  On a file system that is ``mounted`` everywhere (a path or URI of files, if not told) tasks write
    them at their places, the same bytes however often, into a file that gets its name when all have ended; elsewhere a task writes a
    file from its sorted strips, holding one at a time.
    """
    spark, size = pixels.sparkSession, pixels.groupBy("file").agg((F.max("y") + 1).cast("long").alias("height"), (F.max("x") + 1).cast("long").alias("width"))
    size = checkpointed(size)
    planes = checkpointed(pixels.select("file", "z", "c").distinct()).join(F.broadcast(size), "file")
    empty = planes.withColumn("band", F.explode(F.expr(f"sequence(0L, (height - 1) div {strip})"))).select("file", "z", "c", "band", "height", "width", F.lit(-1).cast("long").alias("y"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("v"))
    cells = pixels.join(F.broadcast(size), "file").select("file", "z", "c", F.expr(f"y div {strip}").cast("long").alias("band"), "height", "width", *(F.col(c).cast("long").alias(c) for c in "yxv"))
    order = ["file", "z", "c", "band"]
    strips = cells.unionByName(empty).withColumns({c: F.col(c).cast("long") for c in ("z", "c")}).groupBy(*order).applyInArrow(_strip_data(bits, strip), "file string, z long, c long, band long, height long, width long, data binary, n long")
    strips = checkpointed(strips)

    def head(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in order[1:]])
        first = np.flatnonzero(table.column("band").to_numpy() == 0)
        shapes = list(zip(table.column("height").take(pa.array(first)).to_pylist(), table.column("width").take(pa.array(first)).to_pylist(), strict=True))
        n = table.column("n").to_numpy()
        header = _stack_header((table.column("ome_xml")[0].as_py() or "").encode(), shapes, n, bits, strip)
        at = len(header) + np.cumsum(n) - n
        return table.select(order).append_column("at", pa.array(at)).append_column("header", pa.array([header] + [None] * (len(table) - 1), pa.binary()))

    # Lengths only, not strips: a row for each strip of a file.
    lengths = strips.select(*order, "height", "width", "n").join(descriptions.select("file", "ome_xml"), "file", "left")
    places = checkpointed(lengths.groupBy("file").applyInArrow(head, "file string, z long, c long, band long, at long, header binary"))
    mark = f".{uuid.uuid4().hex}.part"
    whole = strips.select(*order, "data").join(places, order)

    def write_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, at, data, header in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "data", "header")), strict=True):
                path = f"{folder.removeprefix('file://')}/{file}.ome.tif{mark}"
                f = os.open(path, os.O_WRONLY | os.O_CREAT)
                try:
                    for place, body in ((0, header or b""), (at, data)):
                        while body:
                            done = os.pwrite(f, body, place)
                            place, body = place + done, body[done:]
                finally:
                    os.close(f)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    def write_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, None
        for batch in batches:
            for file, data, header in zip(*(batch.column(c).to_pylist() for c in ("file", "data", "header")), strict=True):
                if file != now:
                    if out is not None:
                        out.close()
                    system, place = fs_of(f"{folder}/{file}.ome.tif{mark}")
                    now, out = file, system.open_output_stream(place)
                out.write((header or b"") + data)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])
        if out is not None:
            out.close()

    system, place = fs_of(folder)
    system.create_dir(place, recursive=True)
    mounted = folder.startswith(("/", "file:")) if mounted is None else mounted
    job = whole.repartition(*order) if mounted else whole.repartition("file").sortWithinPartitions(*order)
    try:
        job.mapInArrow(write_at if mounted else write_whole, "n long").agg(F.sum("n")).collect()
        files = [r["file"] for r in size.select("file").collect()]
        for file in files:
            system.move(f"{place}/{file}.ome.tif{mark}", f"{place}/{file}.ome.tif")
    except BaseException:
        for i in system.get_file_info(FileSelector(place)):
            if i.base_name.endswith(mark):
                system.delete_file(i.path)
        raise
    made = planes.groupBy("file").agg(F.count("*").alias("planes"), F.first("height").alias("height"), F.first("width").alias("width"))
    return made.select("file", F.concat(F.lit(f"{folder}/"), "file", F.lit(".ome.tif")).alias("path"), "planes", "height", "width")
