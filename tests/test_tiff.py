import struct
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PythonException

from lamella.plans import command
from lamella.sources import metadata, tiff


def lzw(data):
    """Dictionary coding by the book: codes of 9 to 12 bits, a new dictionary before it is full."""
    out, bits, width = 0, 0, 9

    def put(code):
        nonlocal out, bits
        out, bits = out << width | code, bits + width

    put(256)
    table = {bytes([i]): i for i in range(256)}
    free, held = 258, b""
    for i in range(len(data)):
        more = held + data[i : i + 1]
        if more in table:
            held = more
            continue
        put(table[held])
        table[more] = free
        if free == (1 << width) - 1:  # entry 511, 1023, 2047
            width += 1
        free += 1
        held = data[i : i + 1]
        if free == 4095:
            put(table[held])
            put(256)
            table, free, width, held = {bytes([i]): i for i in range(256)}, 258, 9, b""
    if held:
        put(table[held])
        if free == (1 << width) - 1:
            width += 1
    put(257)
    pad = -bits % 8
    return (out << pad).to_bytes((bits + pad) // 8, "big")


def packbits(data):
    out, i = bytearray(), 0
    while i < len(data):
        n = 1
        while n < 128 and i + n < len(data) and data[i + n] == data[i]:
            n += 1
        if n > 1:
            out += bytes([257 - n, data[i]])
        else:
            while n < 128 and i + n < len(data) and data[i + n] != data[i + n - 1]:
                n += 1
            out += bytes([128, n - 1]) + data[i : i + n]  # 128 stands for nothing
        i += n
    return bytes(out)


CODERS = {1: bytes, 5: lzw, 8: zlib.compress, 32773: packbits}


def write(path, pages, order="<", tile=None, compression=1, predictor=1, subs=False, rows=7, more=None):
    """A classic TIFF of arrays (y, x) or (y, x, sample), each a page; ``subs`` makes the later ones smaller versions of the first."""
    out = bytearray(struct.pack(order + "2sHI", {"<": b"II", ">": b"MM"}[order], 42, 0))
    at = []
    for a in pages:
        a = a if a.ndim == 3 else a[:, :, None]
        high, wide, samples = a.shape
        th, tw = tile or (rows, wide)
        offsets, sizes = [], []
        for y in range(0, high, th):
            for x in range(0, wide, tw):
                part = a[y : y + th, x : x + tw]
                if tile:
                    part = np.pad(part, ((0, th - part.shape[0]), (0, tw - part.shape[1]), (0, 0)))
                if predictor == 2:
                    part = np.diff(part, axis=1, prepend=np.zeros_like(part[:, :1]))
                data = part.astype(part.dtype.newbyteorder(order)).tobytes()
                if predictor == 3:
                    n = part.dtype.itemsize
                    planes = part.astype(part.dtype.newbyteorder(">")).reshape(len(part), -1, 1).view("u1").transpose(0, 2, 1).reshape(len(part), -1, samples)
                    data = np.diff(planes, axis=1, prepend=np.zeros_like(planes[:, :1])).astype("u1").tobytes()
                    assert len(data) == part.size * n
                data = CODERS.get(compression, bytes)(data)
                offsets.append(len(out))
                sizes.append(len(data))
                out += data
        kind = {"u": 1, "i": 2, "f": 3}[a.dtype.kind]
        tags = {256: [wide], 257: [high], 258: [a.dtype.itemsize * 8] * samples, 259: [compression], 277: [samples], 317: [predictor], 339: [kind] * samples}
        tags |= {322: [tw], 323: [th], 324: offsets, 325: sizes} if tile else {273: offsets, 278: [th], 279: sizes}
        tags |= more or {}
        at.append((len(out), tags))
    starts = []
    for n, (_, tags) in list(enumerate(at))[::-1]:
        if subs and n == 0:
            tags[330] = starts
        body = b""
        for tag in sorted(tags):
            values = tags[tag]
            if isinstance(values, tuple) and values[0] == "Q":
                body += struct.pack(order + "HHII", tag, 5, 1, len(out))
                out += struct.pack(order + "Q", values[1])
                continue
            values = [values[1]] if isinstance(values, tuple) else values
            code = f"{order}{len(values)}I"
            if len(values) == 1:
                field = struct.pack(code, *values)
            else:
                field = struct.pack(order + "I", len(out))
                out += struct.pack(code, *values)
            body += struct.pack(order + "HHI", tag, 4, len(values)) + field
        following = 0 if subs or n == len(at) - 1 else starts[0]
        starts.insert(0, len(out))
        out += struct.pack(order + "H", len(tags)) + body + struct.pack(order + "I", following)
    out[4:8] = struct.pack(order + "I", starts[0])
    path.write_bytes(out)


def cells(arrays):
    return sorted((z, c, y, x, v.item()) for (z, c), a in arrays.items() for (y, x), v in np.ndenumerate(a))


def read(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("how", [{}, {"order": ">"}, {"tile": (8, 16)}, {"tile": (8, 16), "compression": 8, "predictor": 2}, {"compression": 8, "order": ">", "predictor": 2}])
@pytest.mark.parametrize("dtype", ["u1", "u2", "i4"])
def test_slides_are_read(spark, tmp_path, monkeypatch, how, dtype):
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 200, (21, 37)).astype(dtype) for _ in range(2))
    write(tmp_path / "b_second.qptiff", [b, a], **how)
    write(tmp_path / "a_first.qptiff", [a, b], **how)
    assert read(tiff.read_tiff(spark, str(tmp_path))) == cells({(0, 0): a, (0, 1): b, (1, 0): b, (1, 1): a})


@pytest.mark.parametrize("how", [{"compression": 5}, {"compression": 5, "predictor": 2, "tile": (16, 16)}, {"compression": 5, "order": ">", "predictor": 2}, {"compression": 32773}, {"compression": 32773, "predictor": 2, "tile": (16, 16)}])
@pytest.mark.parametrize("dtype", ["u1", "u2"])
def test_dictionary_and_run_compression(spark, tmp_path, how, dtype):
    rng = np.random.default_rng(7)
    smooth = (np.add.outer(np.arange(90), np.arange(130)) // 3 % 250).astype(dtype)
    noisy = rng.integers(0, 250, (90, 130)).astype(dtype)  # fills the dictionary more than once
    colours = np.stack([smooth, noisy, smooth // 2], axis=2)
    write(tmp_path / "a.qptiff", [smooth, noisy], rows=90, **how)
    write(tmp_path / "b.qptiff", [colours], rows=90, **how)
    want = {(0, 0): smooth, (0, 1): noisy} | {(1, c): colours[:, :, c] for c in range(3)}
    assert read(tiff.read_tiff(spark, str(tmp_path))) == cells(want)


@pytest.mark.parametrize(("dtype", "compression"), [("f4", 5), ("f4", 8), ("f8", 5), ("f2", 32773)])
@pytest.mark.parametrize("order", ["<", ">"])
def test_floating_point_differences(spark, tmp_path, dtype, compression, order):
    a = np.random.default_rng(3).normal(size=(20, 31, 2)).astype(dtype)
    write(tmp_path / "a.qptiff", [a], tile=(16, 16), predictor=3, compression=compression, order=order)
    got = read(tiff.read_tiff(spark, str(tmp_path), kind="double"))
    assert got == cells({(0, c): a[:, :, c].astype("f8") for c in (0, 1)})


@pytest.mark.parametrize(("compression", "coder"), [(5, lzw), (32773, packbits), (8, zlib.compress), (1, bytes)])
def test_decoders_give_any_portion(compression, coder):
    from lamella.sources.codecs import DECODERS

    rng = np.random.default_rng(compression)
    data = bytes(200) + rng.integers(0, 256, 9000).astype("u1").tobytes() + bytes(range(256)) * 9 + bytes(5000)
    packed = coder(data)
    for step, portion in ((1, 4000), (7, 977), (len(packed), 1)):
        stream = iter([packed[i : i + step] for i in range(0, len(packed), step)])
        decoder = DECODERS[compression](lambda: next(stream, b""))  # noqa: B023
        got = [decoder.read(portion) for _ in range(-(-len(data) // portion))]
        assert b"".join(got) == data and all(len(g) == portion for g in got[:-1]) and decoder.read(5) == b""


@pytest.mark.parametrize("compression", [5, 8, 32773])
@pytest.mark.parametrize("harm", ["short", "codes"])
def test_damaged_segments_raise(spark, tmp_path, compression, harm, monkeypatch):
    a = np.random.default_rng(1).integers(0, 250, (40, 40)).astype("u1")
    good = CODERS[compression]
    bad = {"short": lambda d: good(d)[: len(good(d)) // 2], "codes": lambda d: b"\xff" * 9 if compression != 32773 else b"\x05"}[harm]
    monkeypatch.setitem(CODERS, compression, bad)
    write(tmp_path / "a.qptiff", [a], rows=40, compression=compression)
    with pytest.raises(PythonException, match="damaged|too short"):
        tiff.read_tiff(spark, str(tmp_path)).collect()


def test_blocks_of_a_strip(monkeypatch, tmp_path):
    a = np.arange(50 * 30, dtype="u2").reshape(50, 30)
    for compression in (1, 5, 8, 32773):
        write(tmp_path / "a.qptiff", [a], rows=50, compression=compression)
        monkeypatch.setattr(tiff, "BLOCK", 100)
        parts = next(tiff._segments(0)(iter([pd.DataFrame({"slice_id": [0], "path": [str(tmp_path / "a.qptiff")]})])))
        with tiff._open(str(tmp_path / "a.qptiff")) as f:
            blocks = list(tiff._lines(f, next(parts.itertuples(index=False))))
        assert len(blocks) == 17 and (np.concatenate([b for _, b in blocks])[:, :, 0] == a).all()


@pytest.mark.parametrize("subs", [False, True])
def test_levels(spark, tmp_path, subs):
    a = np.arange(400, dtype="u2").reshape(20, 20)
    write(tmp_path / "a.qptiff", [a, a[::2, ::2], a[::4, ::4]], subs=subs)
    for level, step in ((0, 1), (1, 2), (2, 4)):
        assert read(tiff.read_tiff(spark, str(tmp_path / "a.qptiff"), level=level)) == cells({(0, 0): a[::step, ::step]})
    with pytest.raises(PythonException, match="no level 3"):
        tiff.read_tiff(spark, str(tmp_path), level=3).collect()


def test_samples_and_kinds(spark, tmp_path):
    a = np.random.default_rng(2).random((9, 11, 3)).astype("f4")
    write(tmp_path / "a.tif", [a])
    got = read(tiff.read_tiff(spark, str(tmp_path), "tif", kind="double"))
    assert got == cells({(0, k): a[:, :, k] for k in range(3)})


def test_what_cannot_be_read(spark, tmp_path):
    write(tmp_path / "a.qptiff", [np.zeros((5, 5), "u1")], compression=7)
    with pytest.raises(PythonException, match="compression 7"):
        tiff.read_tiff(spark, str(tmp_path)).collect()
    (tmp_path / "a.qptiff").write_bytes(b"not a slide at all")
    with pytest.raises(PythonException, match="not a TIFF"):
        tiff.read_tiff(spark, str(tmp_path)).collect()
    (tmp_path / "none").mkdir()
    assert read(tiff.read_tiff(spark, str(tmp_path / "none"))) == []


def test_planes_come_back(spark, tmp_path):
    rng = np.random.default_rng(3)
    planes = {(i, z, c): rng.integers(0, 60000, (13 + i, 9)) for i in (1, 2) for z in (0, 1) for c in (0, 1)}
    rows = [(*k, y, x, int(v)) for k, a in planes.items() for (y, x), v in np.ndenumerate(a) if (y + x) % 5 or y in (12, 14)]
    out = tiff.write_planes(spark.createDataFrame(rows, "idx long, z long, c long, y long, x long, v long"), f"file://{tmp_path}/planes").collect()
    assert len(out) == 8
    for r in out:
        a = planes[r.idx, r.z, r.c].copy()
        gone = np.add(*np.indices(a.shape)) % 5 == 0
        gone[[i for i in (12, 14) if i < len(a)]] = False
        a[gone] = 0
        assert read(tiff.read_tiff(spark, r.path, "tif")) == cells({(0, 0): a})
    with pytest.raises(PythonException, match="don't fit"):
        tiff.write_planes(spark.createDataFrame([(1, 0, 0, 0, 0, 70000)], "idx long, z long, c long, y long, x long, v long"), f"file://{tmp_path}/planes").collect()


def test_command_from_slides_to_files(spark, tmp_path):
    rng = np.random.default_rng(5)
    texture = [np.kron(rng.integers(80, 200, (2, 7, 7)), np.ones((1, 4, 4), int)) for _ in range(2)]
    (tmp_path / "in").mkdir()
    for z, (dy, dx) in enumerate(((0, 0), (1, 2))):
        v = np.zeros((2, 72, 72), "u2")
        for (y, x), t in zip(((3, 3), (38, 39)), texture, strict=True):
            v[:, y + dy : y + dy + 28, x + dx : x + dx + 28] = t
        write(tmp_path / "in" / f"00{z}.qptiff", [v[0], v[1]], compression=8, more={282: ("Q", 3333 | 1 << 32), 283: ("Q", 3333 | 1 << 32), 296: ("I", 3)})
    (tmp_path / "names.txt").write_text("one\ntwo\n")
    common = ["--input_path", str(tmp_path / "in"), "--num_tissue", "2", "--thresh", "40", "--kernel_size", "5", "--padding", "2", "--channel_names", str(tmp_path / "names.txt")]
    done = command.run(spark, command.options().parse_args([*common, "--output_dir", str(tmp_path / "out")]))
    assert [r.name for r in done["channels"].orderBy("channel").collect()] == ["one", "two"]
    assert sorted(r.idx for r in done["metrics"].collect()) == [1, 2] and all(r.dice > 0.9 for r in done["metrics"].collect())
    files = done["aligned"].collect()
    assert sorted((r.file, r.planes) for r in files) == [("aligned_tissue_1", 4), ("aligned_tissue_2", 4)]
    assert done["sumChannels"].count() == done["sumChannels_beforeAlignment"].count() == 2
    kept = {(r.idx, r.z, r.c): r.n for r in spark.read.parquet(f"{tmp_path}/out/aligned_tissue_stacks").where("v >= 0.5").groupBy("idx", "z", "c").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    for r in files:
        pages = tiff.read_tiff(spark, r.path, "tif").where("v > 0").groupBy("c").count().collect()
        assert len(pages) == 4
        for page in pages:
            assert page["count"] == pytest.approx(kept[int(r.file[-1]), page.c // 2, page.c % 2], abs=9)
        xml = tiff.slide_info(spark, r.path, "tif").first().ome_xml
        assert 'Name="one"' in xml and 'Name="two"' in xml and 'SizeZ="2" SizeC="2"' in xml
        sizes = {x.dimension: x.value_um for x in metadata.slide_sizes(spark.createDataFrame([(0, xml)], "slice_id long, ome_xml string")).collect()}
        assert sizes == pytest.approx({"X": 10000 / 3333, "Y": 10000 / 3333, "Z": 1.0})
    assert done["labels"].count() == 2 and all(open(r.path.removeprefix("file://"), "rb").read(4) == b"\x89PNG" for r in done["labels"].collect())
    stages = {r.stage: r.rows for r in done["stages"].collect()}
    assert stages["aligned stacks"] == spark.read.parquet(f"{tmp_path}/out/aligned_tissue_stacks").count() and stages["tissues"] > 0 and "crops" in stages
    crops = command.run(spark, command.options().parse_args([*common, "--output_dir", str(tmp_path / "crops"), "--crop_only"]))
    assert sorted((r.file, r.planes) for r in crops["crops"].collect()) == [(f"aligned_tissue_{i}_{z}", 2) for i in (1, 2) for z in (0, 1)]
    assert set(crops) == {"channels", "crops", "labels", "stages"}


@pytest.mark.parametrize("mounted", [True, False])
def test_stacks_are_one_file_each(spark, tmp_path, mounted):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(8)
    a = {(f, z, c): rng.integers(0, 60000, (150 if f == "a" else 3, 70)) for f in "ab" for z in (1, 4) for c in (0, 1, 2)}
    rows = [(f, z, c, y, x, int(v)) for (f, z, c), p in a.items() for (y, x), v in np.ndenumerate(p) if (f, z, c) != ("b", 4, 1) or (y, x) == (0, 5)]
    pixels = spark.createDataFrame(rows, "file string, z long, c long, y long, x long, v long").repartition(5)
    told = pixels.groupBy("file").agg(tiff.ome_xml(F.max("y") + 1, F.max("x") + 1, F.lit(2), F.lit(3), ["DAPI", 'a "b" <c>'], 16, {"X": 0.5, "Y": 0.25, "Z": 2.0}).alias("ome_xml"))
    done = tiff.write_stacks(pixels, told, f"file://{tmp_path}/out", strip=16, mounted=mounted).collect()
    assert sorted((r.file, r.planes, r.height, r.width) for r in done) == [("a", 6, 150, 70), ("b", 6, 3, 70)]
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.endswith(".crc")) == ["a.ome.tif", "b.ome.tif"]
    a["b", 4, 1] = np.where(np.arange(210).reshape(3, 70) == 5, a["b", 4, 1], 0)
    for f in "ab":
        want = {(0, i): a[f, z, c] for i, (z, c) in enumerate((z, c) for z in (1, 4) for c in (0, 1, 2))}
        assert read(tiff.read_tiff(spark, f"{tmp_path}/out/{f}.ome.tif", "tif")) == cells(want)
    import xml.etree.ElementTree as tree

    xml = tree.fromstring(tiff.slide_info(spark, f"{tmp_path}/out/a.ome.tif", "tif").first().ome_xml)
    part = {k: [e for e in xml.iter() if e.tag.endswith(k)] for k in ("Pixels", "Channel")}
    got = part["Pixels"][0].attrib
    assert [got[k] for k in ("DimensionOrder", "SizeX", "SizeY", "SizeZ", "SizeC", "PhysicalSizeX", "PhysicalSizeY", "PhysicalSizeZ")] == ["XYCZT", "70", "150", "2", "3", "0.5", "0.25", "2.0"]
    assert [c.attrib.get("Name") for c in part["Channel"]] == ["DAPI", 'a "b" <c>', None]


def test_stacks_that_do_not_fit_leave_no_file(spark, tmp_path):
    pixels = spark.createDataFrame([("a", 0, 0, 0, 0, 70000)], "file string, z long, c long, y long, x long, v long")
    with pytest.raises(PythonException, match="don't fit"):
        tiff.write_stacks(pixels, spark.createDataFrame([], "file string, ome_xml string"), f"file://{tmp_path}/out")
    assert not (tmp_path / "out").exists() or not list((tmp_path / "out").iterdir())


def test_slide_info(spark, tmp_path):
    a = np.zeros((8, 6), "u1")
    write(tmp_path / "a.qptiff", [a], more={282: ("Q", 20000 | 1 << 32), 283: ("Q", 5000 | 1 << 32), 296: ("I", 3)})
    write(tmp_path / "b.qptiff", [a], order=">", more={282: ("Q", 50800 << 32 | 2)})
    one, two = tiff.slide_info(spark, str(tmp_path)).orderBy("slice_id").collect()
    assert (one.height, one.width, one.ome_xml, one.x_um, one.y_um) == (8, 6, None, 0.5, 2.0)
    assert (two.x_um, two.y_um) == (1.0, None)
