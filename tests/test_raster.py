"""Raster queries against the same SQL in DuckDB, and hand-made cases."""

import glob
import os

import duckdb
import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from lamella.operators import labels as lab, matching as mat, morphology as mor, objects as obj, raster as ras, register as reg
from lamella.plans import registry
from lamella.sources import rasters as src

@pytest.fixture(scope="module")
def sql():
    c = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def pixels(spark, rows, names="z long, y long, x long, v long"):
    return spark.createDataFrame(rows, names)


def rows(df, *by):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", [n for n in registry.SQL])
def test_equals_sql(spark, sql, name):
    df = registry.QUERIES[name](spark, SMALL)
    want = sql.sql(registry.SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(str(tuple(r[i] for i in at)) for r in want.fetchall())


def test_sums_truncate_and_wrap(spark):
    df = spark.createDataFrame([(0, 0, 0, 0, 1.9), (0, 1, 0, 0, 2.9)], "z long, c long, y long, x long, v double")
    assert rows(ras.channel_sum_u16(df)) == [(0, 0, 0, 3)]
    df = spark.createDataFrame([(0, 0, 0, 0, 60000), (0, 1, 0, 0, 10000)], "z long, c long, y long, x long, v long")
    assert rows(ras.channel_sum_u16(df)) == [(0, 0, 0, 4464)]
    df = spark.createDataFrame([(0, 0, 0, 0, 300)], "z long, c long, y long, x long, v long")
    assert rows(ras.channel_sum_u8(df)) == [(0, 0, 0, 44)]


def test_ragged_block_mean(spark):
    df = pixels(spark, [(0, 0, 0, 1), (0, 0, 1, 2), (0, 0, 2, 3)])
    assert rows(ras.block_mean(df, 1, 2)) == [(0, 0, 0, 1.5), (0, 0, 1, 1.5)]


def test_dilation_of_one_pixel(spark):
    df = pixels(spark, [(0, y, x, int(x == 5 and y == 2)) for y in range(5) for x in range(11)])
    on = lambda k: {r.x for r in mor.dilate(df, k).where("v = 1").collect()}
    assert on(3) == {4, 5, 6}
    assert len(on(4)) == 4
    assert rows(mor.morphology(df, 3, "erode")) == rows(df)


@pytest.mark.parametrize("k", [1, 8])
def test_elliptic_opening_against_arrays(spark, k):
    m = (np.random.default_rng(1).random((19, 23)) < 0.93).astype(int)
    want = m
    for how in (min, max):
        out = np.zeros_like(want)
        for y, x in np.ndindex(want.shape):
            out[y, x] = how(want[y + dy, c] for dy, a, b in mor.ellipse(k) if 0 <= y + dy < 19 for c in range(max(0, x + a), min(23, x + b + 1)))
        want = out
    got = np.zeros_like(m)
    for r in mor.ellipse_open(pixels(spark, [(0, y, x, int(v)) for (y, x), v in np.ndenumerate(m)]), k).collect():
        got[r.y, r.x] = r.v
    assert (got == want).all() and want.any()


def test_order_in_a_u(spark):
    df = spark.createDataFrame([(0, 1, 1.0, 1.0), (0, 2, 1.0, 5.0), (0, 3, 5.0, 1.0), (0, 4, 5.0, 5.0)], "z long, label long, cx double, cy double")
    assert {r.label: r.idx for r in lab.u_order(df).collect()} == {2: 1, 1: 2, 3: 3, 4: 4}


def test_top_components_keep_ties(spark):
    df = spark.createDataFrame([(0, i, a) for i, a in enumerate((50, 9, 7, 7, 3))], "z long, label long, area long")
    assert [r.area for r in lab.top_components(df, 3).orderBy("label").collect()] == [50, 9, 7, 7]


def test_components_against_flood_fill(spark):
    import random

    random.seed(4)
    on = {(y, x) for y in range(30) for x in range(30) if random.random() < 0.45}
    got = {(r.y, r.x): r.label for r in lab.connected_components(pixels(spark, [(0, y, x, 1) for y, x in on])).collect()}
    seen = {}
    for start in sorted(on):
        stack = [start]
        while stack:
            p = stack.pop()
            if p in seen:
                continue
            seen[p] = start
            stack += [(p[0] + a, p[1] + b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (p[0] + a, p[1] + b) in on]
    assert got == {p: y * (1 << 20) + x for p, (y, x) in seen.items()}
    assert lab.connected_components(pixels(spark, [])).count() == 0


def test_box_and_pad(spark):
    df = spark.createDataFrame([(0, 1, 10, 8, 5, 4)], "z long, idx long, cx long, cy long, w long, h long")
    r = obj.expand_box(df, 8, 8, 50, 200, 150).first()
    assert (r.x1, r.y1, r.x2, r.y2) == (14, 0, 146, 130)
    crops = spark.createDataFrame([(1, 0, y, 0, 1) for y in range(2)] + [(1, 1, y, 0, 1) for y in range(4)], "idx long, z long, y long, x long, v long")
    assert sorted(r.y for r in obj.pad_stack(crops).where("z = 0").collect()) == [2, 3]
    tie = spark.createDataFrame([(0, 1, 3, 4), (1, 1, 3, 4)], "z long, idx long, w long, h long")
    assert obj.biggest_boxes(tie).first().z == 0


def test_dice_and_area(spark):
    df = pixels(spark, [(z, 0, x, v) for z, line in enumerate(([1, 1, 0, 0], [1, 0, 1, 0])) for x, v in enumerate(line)])
    assert mat.dice_adjacent(df).first().dice == 0.5
    assert mat.area_consistency(df).first().agreement == round(2 / 3 + 1 / 3, 6)
    empty = pixels(spark, [(z, 0, 0, 0) for z in (0, 1)])
    assert mat.dice_adjacent(empty).first().dice is None


def test_propagate_and_relabel(spark):
    m = spark.createDataFrame([(0, 1, 2), (0, 2, 1), (1, 1, 1), (1, 2, 2)], "z long, src long, dst long")
    first = spark.createDataFrame([(1,), (2,)], "label long")
    assert rows(mat.propagate(m, first, 3)) == [(0, 1, 1), (0, 2, 2), (1, 1, 2), (1, 2, 1), (2, 1, 2), (2, 2, 1)]
    labels = spark.createDataFrame([(0, 0, 0, 1), (0, 0, 1, 5)], "z long, y long, x long, label long")
    assert rows(mat.relabel(labels, spark.createDataFrame([(0, 1, 7)], "z long, label long, new long"))) == [(0, 0, 0, 7), (0, 0, 1, 0)]


def test_validations(spark):
    good = spark.createDataFrame([(0, "X", 0.5), (1, "X", 0.5)], "slice_id long, dimension string, value_um double")
    assert src.physical_sizes(spark, good).first().value_um == 0.5
    with pytest.raises(Exception, match="different physical sizes"):
        src.physical_sizes(spark, good.union(spark.createDataFrame([(2, "X", 0.6)], good.schema))).collect()
    counts = spark.createDataFrame([(0, 1), (0, 2), (1, 1)], "z long, idx long")
    with pytest.raises(Exception, match="different numbers"):
        obj.assert_same_count(counts).collect()


def test_files_and_channels(spark, tmp_path):
    for name in ("b2.qptiff", "A10.qptiff", "a1x.qptiff", "note.txt"):
        (tmp_path / name).write_bytes(b"x")
    assert [r.name for r in src.slide_files(spark, str(tmp_path)).orderBy("slice_id").collect()] == ["A10.qptiff", "a1x.qptiff", "b2.qptiff"]
    (tmp_path / "channelnames.txt").write_text("DAPI \n\nCD3\n")
    assert rows(src.channel_names(spark, str(tmp_path / "channelnames.txt"))) == [(0, "DAPI"), (1, ""), (2, "CD3")]


def test_homography_is_recovered(spark):
    pts = [(0, float(x), float(y), 1.1 * x + 3, 0.9 * y - 2) for x in range(0, 50, 10) for y in range(0, 50, 10)] + [(0, 1.0, 1.0, 900.0, 900.0), (1, 0.0, 0.0, 1.0, 1.0)]
    out = {r.z: r for r in reg.find_homographies(spark.createDataFrame(pts, "z long, sx double, sy double, dx double, dy double"), ["z"]).collect()}
    assert out[0].status == "aligned" and out[0].inliers == 25
    assert out[0].h == pytest.approx([1.1, 0, 3, 0, 0.9, -2, 0, 0, 1], abs=1e-6)
    assert out[1].status == "failed" and out[1].h is None


def test_registries_agree():
    assert registry.SQL.keys() <= registry.QUERIES.keys()


@pytest.mark.parametrize("name", ["refine_mask", "align_stack", "shape_features", "greedy_overlap", "label_png"])
def test_queries_without_sql_give_rows(spark, name):
    assert registry.QUERIES[name](spark, SMALL).count() > 0


@pytest.mark.parametrize("lines", [1, 3, 4096])
def test_otsu_does_not_depend_on_portions(spark, lines):
    rng = np.random.default_rng(8)
    hist = {z: dict(zip(sorted(rng.choice(900, 40, False).tolist()), rng.integers(1, 50, 40).tolist(), strict=True)) for z in (3, 7)}
    hist[8], hist[9] = {5: 10}, {5: 10, 6: 2}
    df = spark.createDataFrame([(z, v, n) for z, h in hist.items() for v, n in h.items()], "z long, v long, n long")
    want = []
    for z in (3, 7):
        v, n = (np.array(x) for x in zip(*hist[z].items(), strict=True))
        goal = lambda i, j: round(sum((n[a:b] @ v[a:b]) ** 2 / n[a:b].sum() for a, b in ((0, i), (i, j), (j, 40))), 4)  # noqa: E731, B023
        i, j = min(((i, j) for i in range(1, 39) for j in range(i + 1, 40)), key=lambda p: (-goal(*p), p))
        want.append((z, int(v[i - 1]), int(v[j - 1])))
    assert rows(ras.multi_otsu(df, lines)) == want


def test_grey_upsampling_of_edges(spark):
    flat = pixels(spark, [(0, y, x, 77) for y in range(4) for x in range(5)] + [(1, 0, 0, 300)])
    got = rows(mor.cubic_upsample_grey(flat, 3, 2))
    assert got == [(0, y, x, 77) for y in range(12) for x in range(10)] + [(1, y, x, 255) for y in range(3) for x in range(2)]


def test_lone_pixels_go(spark):
    m = np.zeros((12, 12), int)
    m[2:7, 3:9] = 255
    m[10, 10] = m[4, 5] = 1
    on = {(r.y, r.x) for r in mor.remove_islands(pixels(spark, [(0, y, x, int(v)) for (y, x), v in np.ndenumerate(m)])).where("v = 1").collect()}
    assert (10, 10) not in on and (4, 5) in on and {(y, x) for y in range(3, 6) for x in range(4, 8)} <= on


def test_planes_without_a_threshold_are_not_lost(spark):
    from pyspark.errors import PySparkException

    from lamella.operators import raster as ras
    from lamella.plans import chain

    rows = [(0, 0, x, x * 40) for x in range(8)] + [(1, 0, x, x % 2) for x in range(8)]
    df = spark.createDataFrame(rows, "z long, y long, x long, v long")
    assert ras.binarize_auto(df.where("z = 0")).count() == 8
    for read in (lambda: ras.binarize_auto(df).collect(), lambda: chain.thresholds(df, chain.Settings()).collect(), lambda: chain.tissue_mask(df, chain.thresholds(df, chain.Settings()), 10).collect()):
        with pytest.raises(PySparkException, match="fewer than three grey values"):
            read()


def plain_step(a, k, erode):
    """Minimum or maximum over k x k, by shifts; -1 is missing and never counts."""
    out = np.full(a.shape, -1)
    for y, x in np.argwhere(a >= 0):
        near = a[max(0, y - k // 2) : y + k - k // 2, max(0, x - k // 2) : x + k - k // 2]
        out[y, x] = (near[near >= 0].min() if erode else near.max())
    return out


@pytest.mark.parametrize("side", [5, 8, 512])
def test_morphology_does_not_depend_on_tiles(spark, monkeypatch, side):
    from lamella.operators import morphology as mor, tiles

    monkeypatch.setattr(tiles, "SIDE", side)
    a = (np.random.default_rng(side).random((2, 23, 31)) > 0.6).astype(int)
    df = spark.createDataFrame([(z, y, x, int(v)) for (z, y, x), v in np.ndenumerate(a)], "z long, y long, x long, v long")
    got = mor.sequence(df, [("closing", 3), ("erosion", 4), ("nothing", 9), ("dilation", 7), ("opening", 0)])
    for z in (0, 1):
        want = a[z]
        for k, erode in ((3, False), (3, True), (4, True), (7, False), (3, True), (3, False)):
            want = plain_step(want, k, erode)
        assert {(r.y, r.x): r.v for r in got.where(f"z = {z}").collect()} == {(y, x): v for (y, x), v in np.ndenumerate(want)}
    opened, k = mor.ellipse_open(df.where("z = 0"), 5), mor.ellipse(5)
    under = lambda p, f: np.array([[f(p[y + dy, x + dx] for dy, i, j in k for dx in range(i, j + 1) if 0 <= y + dy < 23 and 0 <= x + dx < 31) for x in range(31)] for y in range(23)])
    want = under(under(a[0], min), max)
    assert {(r.y, r.x): r.v for r in opened.collect()} == {(y, x): v for (y, x), v in np.ndenumerate(want)}


@pytest.mark.parametrize("side", [4, 9, 512])
@pytest.mark.parametrize("diagonal", [True, False])
def test_components_do_not_depend_on_tiles(spark, monkeypatch, side, diagonal):
    from lamella.operators import labels as lab, tiles

    monkeypatch.setattr(tiles, "SIDE", side)
    rng = np.random.default_rng(side)
    on = {(z, y, x) for z in (0, 3) for y in range(26) for x in range(33) if rng.random() < 0.55}
    on |= {(0, y, 0) for y in range(26)} | {(0, 25, x) for x in range(33)}  # one that goes through many tiles
    got = {(r.z, r.y, r.x): r.label for r in lab.connected_components(spark.createDataFrame(sorted(on), "z long, y long, x long"), diagonal).collect()}
    want = {}
    for start in sorted(on):
        todo = [] if start in want else [start]
        while todo:
            z, y, x = todo.pop()
            if (z, y, x) in on and (z, y, x) not in want:
                want[z, y, x] = start[1] * (1 << 20) + start[2]
                todo += [(z, y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i or j) and (diagonal or not (i and j))]
    assert got == want
    assert lab.connected_components(spark.createDataFrame([], "z long, y long, x long")).count() == 0


@pytest.mark.parametrize("cell", [3, 8, 512])
def test_crops_do_not_depend_on_cells(spark, cell):
    boxes = [(0, 1, 2, 3, 9, 7), (0, 2, 0, 0, 20, 20), (0, 3, 5, 5, 5, 9), (1, 1, 8, 8, 16, 9), (2, 1, 0, 0, 9, 9)]
    pixels = [(z, y, x, z * 1000 + y * 20 + x) for z in (0, 1) for y in range(12) for x in range(17)]
    out = obj.crop(spark.createDataFrame(pixels, "z long, y long, x long, v long"), spark.createDataFrame(boxes, "z long, idx long, x1 long, y1 long, x2 long, y2 long"), cell)
    want = sorted((z, i, y - y1, x - x1, v) for z, y, x, v in pixels for b, i, x1, y1, x2, y2 in boxes if b == z and x1 <= x < x2 and y1 <= y < y2)
    assert sorted(tuple(r) for r in out.select("z", "idx", "y", "x", "v").collect()) == want


@pytest.mark.parametrize("sy, sx", [(3, 2), (1, 5)])
def test_upsampling_over_tiles_spreads_no_rows(spark, monkeypatch, sy, sx):
    """Tiles of 16 pixels, some without any, against whole planes; pixels aren't exploded to the places that they count in."""
    monkeypatch.setattr(mor, "SIDE", 16)
    a = np.random.default_rng(2).integers(0, 256, (37, 50))
    a[:, 18:45] = a[18:] = 0
    a[36, 49] = 9

    def axis(size, s):
        t = (np.arange(size * s) + 0.5) / s - 0.5
        m = np.zeros((size * s, size))
        for k in range(-2, size + 2):
            m[:, min(max(k, 0), size - 1)] += [mor._cubic_weight(d) for d in t - k]
        return m

    whole = np.round(axis(37, sy) @ a @ axis(50, sx).T, 6)
    df = pixels(spark, [(0, y, x, int(v)) for (y, x), v in np.ndenumerate(a) if v])
    grey, mask = mor.cubic_upsample_grey(df, sy, sx), mor.cubic_upsample(df, sy, sx)
    assert all("explode" not in f._jdf.queryExecution().executedPlan().toString() for f in (grey, mask))
    want = np.clip(np.rint(whole), 0, 255)
    assert rows(grey) == [(0, y, x, int(v)) for (y, x), v in np.ndenumerate(want) if v]
    on = np.round(axis(37, sy) @ (a > 0) @ axis(50, sx).T, 6) > 0.5
    assert rows(mask) == [(0, y, x) for y, x in zip(*np.nonzero(on), strict=True)]


def test_blocks_after_a_step_are_no_larger_than_their_planes(spark):
    """A plane of 5 x 7 pixels isn't carried on as a whole tile."""
    df = pixels(spark, [(z, y, x, int(y > 1)) for z in range(3) for y in range(5) for x in range(7)])
    blocks = mor.block_steps(mor.as_blocks(df), [(3, True), (3, False)])
    assert [(r.n_y, r.n_x, len(r.data)) for r in blocks.collect()] == [(5, 7, 35)] * 3
    assert rows(mor.from_blocks(blocks)) == rows(mor.morphology(df, 3, "opening"))


def test_holes_over_tiles_are_filled_without_pixels_as_rows(spark, monkeypatch):
    """Holes across tiles of 8 pixels; the planes aren't joined pixel by pixel."""
    monkeypatch.setattr(lab.tiles, "SIDE", 8)
    m = np.ones((24, 30), int)
    m[5:11, 6:10] = m[20, 3] = m[14:17, 12:28] = m[:4, 29] = 0
    df = pixels(spark, [(z, y, x, int(v)) for z in range(2) for (y, x), v in np.ndenumerate(m)])
    got = lab.fill_holes(df, F.expr("(h * w) div 25"))
    joins = [x for x in got._jdf.queryExecution().executedPlan().toString().split("\n") if "Join" in x]
    assert joins and not any(", y#" in x for x in joins)
    want = m.copy()
    want[5:11, 6:10] = want[20, 3] = want[:4, 29] = 1
    assert rows(got) == [(z, y, x, int(v)) for z in range(2) for (y, x), v in np.ndenumerate(want)]
