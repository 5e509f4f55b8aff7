"""Outlines, refined masks, alignment, matching in turn and image files on hand-made cases."""

import struct
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.operators import align, labels as lab, matching as mat, refine, register as reg, shapes
from lamella.operators.scalespace import Detector
from lamella.sources import sinks


def picture(spark, lines, label=1):
    cells = [(0, y, x, label) for y, line in enumerate(lines) for x, c in enumerate(line) if c == "#"]
    return spark.createDataFrame(cells, "z long, y long, x long, label long")


def plain_eccentricity(points):
    """Of the conic whose six factors solve the constrained least squares as one generalised eigenproblem."""
    x, y = (np.array(c, float) - np.mean(c) for c in zip(*points, strict=True))
    d = np.column_stack([x * x, x * y, y * y, x, y, np.ones(len(x))])
    c = np.zeros((6, 6))
    c[0, 2] = c[2, 0] = 2
    c[1, 1] = -1
    values, vectors = np.linalg.eig(np.linalg.solve(d.T @ d, c))
    a, b, g = vectors[:3, np.argmax(values.real)].real
    small, large = sorted(abs(np.linalg.eigvalsh([[a, b / 2], [b / 2, g]])))
    return (1 - small / large) ** 0.5


def test_outline_of_a_rectangle_with_a_hole(spark):
    df = picture(spark, ["#######", "#.....#", "#.....#", "#######"]).union(picture(spark, ["", "", "..#"], 2))
    out = {r.label: r for r in shapes.contour_centroids(df).collect()}
    assert (out[1].area, out[1].cx, out[1].cy) == (18.0, 3, 1)
    assert (out[2].area, out[2].cx, out[2].cy) == (0.0, 0, 0)
    f = {r.label: r for r in shapes.shape_features(df).collect()}
    assert f[1].perimeter == 18.0 and f[1].solidity == pytest.approx(1) and f[1].cx == 3.0 and f[1].cy == 1.5
    assert f[1].compactness == pytest.approx(18**2 / (4 * np.pi * 18))
    assert f[1].hu1 == pytest.approx(np.log10((6 * 3**3 / 12 + 3 * 6**3 / 12) / 18**2))
    assert f[1].eccentricity == pytest.approx(plain_eccentricity([(x, y) for x in range(7) for y in range(4) if x in (0, 6) or y in (0, 3)]), abs=1e-6)
    assert f[2].solidity is None and f[2].hu1 is None


def plain_fill(cells):
    """An object's pixels and those that a walk from its box's corner doesn't reach."""
    ys, xs = zip(*cells, strict=True)
    box = {(y, x) for y in range(min(ys) - 1, max(ys) + 2) for x in range(min(xs) - 1, max(xs) + 2)}
    todo, seen = [(min(ys) - 1, min(xs) - 1)], set()
    while todo:
        y, x = at = todo.pop()
        if at in box and at not in cells and at not in seen:
            seen.add(at)
            todo += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)]
    return box - seen


def test_small_objects_are_filled_in_bulk(spark, monkeypatch):
    rng = np.random.default_rng(5)
    want, rows = {}, []
    for z in range(2):
        for label in range(12):
            cells = {(int(y) + 3 * label, int(x)) for y, x in np.argwhere(rng.random((6 + label, 9)) < 0.6)}
            rows += [(z, y, x, label) for y, x in cells]
            want |= {(z, label, y, x): 1 for y, x in plain_fill(cells)}
    rows += [(5, y, x, 8) for y, x in ((0, 1), (1, 0), (1, 2), (2, 1))] + [(6, 4, x, 8) for x in range(9)]  # the smallest hole; a line has none
    want |= {(5, 8, y, x): 1 for y, x in ((0, 1), (1, 0), (1, 2), (2, 1), (1, 1))} | {(6, 8, 4, x): 1 for x in range(9)}
    df = spark.createDataFrame(rows, "z long, y long, x long, label long")
    filled = lambda: sorted((r.z, r.label, r.y, r.x) for r in shapes.filled(df).collect())
    tables = shapes.connected_components
    monkeypatch.setattr(shapes, "connected_components", None)  # a group of its own for each object
    assert filled() == sorted(want)
    assert "FlatMapGroups" not in shapes.shape_features(df)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(shapes, "connected_components", tables)
    monkeypatch.setattr(shapes.tiles, "SIDE", 9)  # larger boxes go by components over tables
    assert filled() == sorted(want)


def test_outline_with_slopes(spark):
    """A diamond: its outline cuts every corner, its four tips are corners of the polygon."""
    df = picture(spark, ["..#..", ".###.", "#####", ".###.", "..#.."])
    r = shapes.shape_features(df).first()
    assert r.area == 8.0 and r.perimeter == pytest.approx(8 * 2**0.5) and r.solidity == pytest.approx(1)
    assert (r.cx, r.cy) == (2.0, 2.0) and r.hu3 == pytest.approx(0, abs=1e-9)


def _square(m, k, op, empty):
    out = np.full_like(m, empty)
    for y, x in np.ndindex(*m.shape):
        out[y, x] = op(m[max(0, y - k // 2) : y + k - k // 2, max(0, x - k // 2) : x + k - k // 2])
    return out


def _parts(m, diagonal):
    seen, parts = np.zeros(m.shape, int), 0
    for start in zip(*np.nonzero(m), strict=True):
        if seen[start]:
            continue
        parts, stack = parts + 1, [start]
        while stack:
            y, x = stack.pop()
            if 0 <= y < m.shape[0] and 0 <= x < m.shape[1] and m[y, x] and not seen[y, x]:
                seen[y, x] = parts
                stack += [(y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1) if diagonal or not a * b]
    return seen


def _without_holes(m, area):
    holes = _parts(1 - m, False)
    small = [i for i in range(1, holes.max() + 1) if (holes == i).sum() < area]
    return np.where(np.isin(holes, small), 1, m)


def test_refined_mask_against_arrays(spark):
    rng = np.random.default_rng(5)
    v = rng.integers(0, 60, (40, 44))
    v[6:18, 5:20] += 70
    v[24:36, 26:40] += 70
    v[10, 10] = 0
    planes = spark.createDataFrame([(3, y, x, int(v[y, x])) for y, x in np.ndindex(*v.shape)], "z long, y long, x long, v long")
    under = planes.where("y between 22 and 37 and x between 24 and 41").select("z", "y", "x")
    mask, status = refine.refine_mask(planes, under, 130, 5, last=3)
    grow, shrink = lambda m, k: _square(m, k, np.max, 0), lambda m, k: _square(m, k, np.min, 1)
    m = (v > 65).astype(int)
    m = grow(_without_holes(grow(m, 4), 176), 1)  # kernels of one pixel change nothing
    parts = _parts(m, True)
    inside = parts[22:38, 24:42]
    counts = np.bincount(inside.ravel())
    want = _without_holes(shrink(grow((parts == counts.argmax()).astype(int), 3), 3), 17)
    got = np.zeros_like(want)
    for r in mask.collect():
        got[r.y, r.x] = r.v
    assert (got == want).all() and 0 < want.sum() < want.size
    assert [(r.z, r.status) for r in status.collect()] == [(3, "found")]
    none, status = refine.refine_mask(planes, under.where("y < 0"), 130, 5, last=3)
    assert status.first().status == "empty" and none.where("v = 1").count() == 0


def test_moved_slices_are_aligned(spark):
    rng = np.random.default_rng(2)
    base = np.kron(rng.integers(0, 200, (16, 16)), np.ones((4, 4), int))
    cells = [(1, 0, y, x, int(base[y, x])) for y, x in np.ndindex(64, 64)]
    cells += [(1, 2, y, x, int(base[y - 3, x + 5]) if y >= 3 and x + 5 < 64 else 0) for y, x in np.ndindex(64, 64)]
    cells += [(9, z, y, x, 7) for z in (0, 1) for y, x in np.ndindex(20, 20)]  # nothing to align by
    stack = spark.createDataFrame(cells, "idx long, z long, y long, x long, v long")
    reference = spark.createDataFrame([(1, 0), (9, 0)], "idx long, z long")
    pixels, status = align.align_stack(stack, reference, 64, 64)
    state = {(r.idx, r.z): r for r in status.collect()}
    assert state[1, 2].status == "aligned" and state[9, 1].status == "failed"
    h = np.array(state[1, 2].h).reshape(3, 3)
    for y, x in ((5, 5), (32, 32), (55, 50)):  # keypoints of coarse octaves aren't moved exactly, but by far less than a pixel
        at = h @ [x - 5, y + 3, 1]
        assert at[:2] / at[2] == pytest.approx([x, y], abs=0.15)
    got = {(r.z, r.y, r.x): r.v for r in pixels.where("idx = 1").collect()}
    assert pixels.where("idx = 9").count() == 0
    for y, x in ((10, 10), (30, 41), (50, 21)):  # inside squares
        assert got[2, y, x] == pytest.approx(base[y, x], abs=0.5) and got[0, y, x] == base[y, x]


def test_partners_taken_in_turn(spark):
    counts = spark.createDataFrame([(0, 1, 2, 3), (0, 1, 3, 5), (0, 2, 3, 9), (0, 2, 4, 1), (0, 3, 3, 4)], "z long, src long, dst long, n long")
    assert sorted((r.src, r.dst, r.n) for r in mat.greedy_matches(counts).collect()) == [(1, 3, 5), (2, 4, 1), (3, None, 0)]


def test_holes_by_share_of_the_plane(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(0, y, x, int((y, x) != (2, 2))) for y in range(5) for x in range(5)], "z long, y long, x long, v long")
    assert lab.fill_holes(df, F.expr("(h * w) div 10")).where("v = 0").count() == 0
    assert lab.fill_holes(df, 1).where("v = 0").count() == 1


def test_images_and_trials(spark, tmp_path):
    rows = spark.createDataFrame([(0, 0, 0, 0), (0, 1, 2, 5)], "z long, y long, x long, label long")
    png = sinks.png_tiles(sinks.label_colours(rows)).first().png
    assert png[:8] == b"\x89PNG\r\n\x1a\n" and struct.unpack(">II", png[16:24]) == (3, 2)
    size = struct.unpack(">I", png[33:37])[0]
    image = zlib.decompress(png[41 : 41 + size])
    assert image[1:4] == b"\0\0\0" and image[-3:] == bytes([(5 * k + t) % 255 + 1 for k, t in ((73, 11), (151, 83), (199, 157))])
    assert len(sinks.png_tiles(sinks.label_colours(rows), side=2).collect()) == 2
    trials = spark.createDataFrame([(0, 0.5, (1,)), (1, 0.7, (2,))], "number long, value double, params struct<a:int>")
    sinks.write_trials(trials, str(tmp_path / "trials"))
    assert [r.number for r in spark.read.json(str(tmp_path / "trials")).collect()] == [1, 0]


def test_trials_align_with_their_own_parameters(spark):
    rng = np.random.default_rng(2)
    base = np.kron(rng.integers(0, 200, (16, 16)), np.ones((4, 4), int))
    cells = [(1, 0, y, x, int(base[y, x])) for y, x in np.ndindex(64, 64)]
    cells += [(1, 2, y, x, int(base[y - 3, x + 5]) if y >= 3 and x + 5 < 64 else 0) for y, x in np.ndindex(64, 64)]
    cells += [(9, z, y, x, 7) for z in (0, 1) for y, x in np.ndindex(20, 20)]  # nothing to align by
    stack = spark.createDataFrame(cells, "idx long, z long, y long, x long, v long")
    reference = spark.createDataFrame([(1, 0), (9, 0)], "idx long, z long")
    trials = spark.createDataFrame(
        [(0, 3, 0.01, 5.0, 1.6, 4, 0.75), (1, 0, 0.01, 5.0, 1.6, 4, 0.75), (2, 0, 0.9, 5.0, 1.6, 4, 0.75), (3, 0, 0.01, 5.0, 1.6, 4, 0.0)],
        "number long, n_features long, contrast_threshold double, edge_threshold double, sigma double, n_octave_layers long, ratio_threshold double",
    )
    out = reg.search(trials, align.trial_scores(stack, reference, trials, 64, 64, 100)).collect()
    assert [(r.idx, r.number) for r in out] == [(1, 1), (1, 0), (1, 2), (1, 3), (9, 0), (9, 1), (9, 2), (9, 3)]
    assert out[0].value > 0.9 and 0 < out[0].unaligned < 0.7
    assert [(r.value, r.unaligned) for r in out[1:]] == [(0, 0)] * 7


def test_trials_of_small_planes_store_no_keypoints(spark, monkeypatch):
    """Slices that lie in a tile are tried in a task each, with the scores that the exchange between tiles gives."""
    from lamella.operators import tiles

    folder = Path(lab.checkpoint_folder(spark).removeprefix("file:"))
    kept = lambda: sum(f.stat().st_size for f in folder.rglob("*") if f.is_file())
    rng = np.random.default_rng(3)
    cells = []
    for idx, (high, wide) in enumerate([(44, 44), (64, 48), (40, 40)]):
        base = np.kron(rng.integers(0, 256, (high // 4, wide // 4)), np.ones((4, 4), int))
        for z, a in ((4, base), (2, np.roll(base, (3, 5), (0, 1))), (7, np.roll(base, (-2, 1), (0, 1)))):
            cells += [(idx, z, y, x, int(a[y, x])) for y, x in np.ndindex(high, wide) if idx or y + x != 9]  # a few pixels are missing
    stack = spark.createDataFrame(cells, "idx long, z long, y long, x long, v long")
    reference = spark.createDataFrame([(0, 4), (1, 4)], "idx long, z long")  # the third tissue has none
    trials = spark.createDataFrame(
        [(0, 90, 0.01, 5.0, 1.6, 3, 0.8), (1, 0, 0.01, 9.0, 1.2, 4, 0.85), (2, 7, 0.9, 5.0, 1.6, 4, 0.75)],
        "number long, n_features long, contrast_threshold double, edge_threshold double, sigma double, n_octave_layers long, ratio_threshold double",
    )
    before = kept()
    one = sorted(align.trial_scores(stack, reference, trials, 64, 48, 128).collect())
    assert kept() - before < 500_000  # 9 planes of about 2,000 pixels
    monkeypatch.setattr(tiles, "SIDE", 88)  # planes of up to 44 pixels stay in one tile
    assert one == sorted(align.trial_scores(stack, reference, trials, 64, 48, 128).collect())
    assert [(r.number, r.idx) for r in one] == [(n, i) for n in range(3) for i in range(3)]
    assert one[3].value > 0.8 > one[3].unaligned > 0 and one[8].value == 0


def test_trials_describe_no_more_than_they_use(monkeypatch):
    from lamella.operators import scalespace as sca

    described, f = [], sca._descriptors
    monkeypatch.setattr(sca, "_descriptors", lambda field, at, *more: described.append(len(at)) or f(field, at, *more))
    a = np.kron(np.random.default_rng(5).integers(0, 256, (16, 16)), np.ones((4, 4), int))
    planes, detector = np.stack([a, a[::-1]]), Detector(1.6, 3, 0.01, 10.0)
    every = sca.small_planes(planes, detector, 4)
    assert sum(described) == sum(len(rows) for rows, _ in every) and all(len(rows) > 60 for rows, _ in every)
    described.clear()
    some = sca.small_planes(planes, Detector(1.6, 3, 0.01, 10.0, 40), 4)
    assert sum(described) == 80  # many places have more than one direction; those beyond the limit aren't described
    for (rows, v), (few, own) in zip(every, some, strict=True):
        assert (rows[:40] == few).all() and (v[:40] == own).all()
    assert all((x == y).all() for k in (0, 1) for x, y in zip(every[k], sca.small_planes(planes[k : k + 1], detector, 4)[0], strict=True))


def test_search_of_the_small_table(spark):
    from lamella.plans import registry

    out = registry.QUERIES["param_search"](spark, "/root/testdata/sf0.001").collect()
    assert len(out) % 25 == 0 and len({r.value for r in out}) > 2
    for idx in {r.idx for r in out}:
        assert [r.value for r in out if r.idx == idx] == sorted((r.value for r in out if r.idx == idx), reverse=True)


def test_all_peaks_are_keypoints(spark):
    cells = [(1, 0, y, x, 200 - 20 * abs(y % 9 - 5) - 15 * abs(x % 9 - 5)) for y, x in np.ndindex(227, 227)]
    found = align.keypoints(spark.createDataFrame(cells, "idx long, z long, y long, x long, v long"), detector=Detector(1.6, 3, 0.01, 10.0))
    at = np.array([(r.y, r.x) for r in found.select("y", "x").collect()])
    assert len(at) >= 25 * 25  # more than any limit of a few hundred
    for y, x in np.ndindex(23, 23):
        assert np.abs(at - [9 * y + 14, 9 * x + 14]).max(axis=1).min() < 1.5


def test_few_inliers_are_found(spark):
    rng = np.random.default_rng(4)
    rows = []
    for z in range(8):
        at = rng.uniform(0, 2000, (60, 2))
        to = np.where(np.arange(60)[:, None] < 12, at * [1.1, 0.9] + [30 + z, -20], rng.uniform(0, 2000, (60, 2)))
        rows += [(z, *map(float, a), *map(float, b)) for a, b in zip(at, to, strict=True)]
    out = reg.find_homographies(spark.createDataFrame(rows, "z long, sx double, sy double, dx double, dy double"), ["z"]).collect()
    assert len(out) == 8
    for r in out:
        assert r.inliers >= 12 and r.h == pytest.approx([1.1, 0, 30 + r.z, 0, 0.9, -20, 0, 0, 1], abs=1e-3)


def test_nearest_two_do_not_depend_on_blocks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.integers(0, 9, (90, 3)).astype(float)
    df = spark.createDataFrame([(i % 2, i, v.tolist()) for i, v in enumerate(x)], "g long, id long, a array<double>")
    monkeypatch.setattr(mat, "BLOCK", 7)
    got = {(r.g, r.id): (r.near, r.d1, r.d2) for r in mat.knn_ratio(df.where("id < 40"), df.where("id >= 40").toDF("g", "near", "b"), 0.9).collect()}
    want = {}
    for i in range(40):
        near = sorted((round(float(np.linalg.norm(x[i] - x[j])), 6), j) for j in range(40, 90) if j % 2 == i % 2)
        if near[0][0] < 0.9 * near[1][0]:
            want[i % 2, i] = (near[0][1], near[0][0], near[1][0])
    assert want and got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v)


def test_blobs_are_matched_by_shape(spark):
    rows = []
    for z, shift in ((0, 0), (1, 3)):
        for label, (y, x, h, w) in {1: (5, 5, 10, 10), 2: (5, 40, 4, 30), 3: (40, 10, 25, 6)}.items():
            rows += [(z, y + i, x + shift + j, label if z == 0 else label + 10) for i in range(h) for j in range(w)]
        rows.append((z, 60, 60, 99))  # no area
    got = shapes.match_blobs(spark.createDataFrame(rows, "z long, y long, x long, label long")).collect()
    assert sorted((r.z, r.src, r.dst) for r in got) == [(0, 1, 11), (0, 2, 12), (0, 3, 13)]


def test_ellipses_are_recovered(spark):
    rows, want = [], {}
    for label, (cy, cx, a, b, turn) in enumerate([(60, 70, 40, 20, 0.5), (55.5, 64, 30, 30, 0), (70, 90.5, 50, 12, 2.6), (50, 50, 25, 15, np.pi / 2)]):
        y, x = np.mgrid[:140, :180]
        u, v = (x - cx) * np.cos(turn) + (y - cy) * np.sin(turn), (y - cy) * np.cos(turn) - (x - cx) * np.sin(turn)
        want[label] = (cx, cy, a, b, turn)
        rows += [(label, 1, int(j), int(i)) for j, i in np.argwhere((u / a) ** 2 + (v / b) ** 2 <= 1)]
    rows += [(9, 1, 5, i) for i in range(20)] + [(10, 1, 0, 0)]  # a line and a pixel have none
    got = {r.z: r for r in shapes.fit_ellipses(spark.createDataFrame(rows, "z long, label long, y long, x long")).collect()}
    assert got[9].major is None and got[10].major is None and len(got) == 6
    for label, (cx, cy, a, b, turn) in want.items():
        r = got[label]
        assert (r.cx, r.cy) == pytest.approx((cx, cy), abs=0.3) and (r.major, r.minor) == pytest.approx((a, b), abs=1.0)
        assert a == b or abs((r.angle - turn + np.pi / 2) % np.pi - np.pi / 2) < 0.03


def test_proposals_beat_random_draws():
    space = {"a": (0.0, 1.0, False), "b": (-3.0, 5.0, False), "n": (1, 20, True)}
    goal = lambda p: np.exp(-abs(p["a"] - 0.3) * 5 - abs(p["b"] - 1.2)) * (1 - abs(p["n"] - 15) / 20)

    def best(seed, startup):
        told = []
        while len(told) < 40:
            new = reg.propose(told, 10 if not told else 5, seed, space, startup)
            assert all(low <= p[k] <= high and isinstance(p[k], int) == whole for p in new for k, (low, high, whole) in space.items())
            told += [(p, goal(p)) for p in new]
        return max(v for _, v in told)

    learned, drawn = (np.mean([best(seed, startup) for seed in range(20)]) for startup in (10, 1000))
    assert learned > drawn * 1.1
    assert reg.propose([], 3, 5) == reg.propose([], 3, 5) != reg.propose([], 3, 6)


def test_a_study_learns_for_each_tissue(spark):
    from pyspark.sql import functions as F

    rounds = []

    def score(trials):
        rounds.append(sorted((r.idx, r.number) for r in trials.collect()))
        off = F.abs(F.col("sigma") - F.when(F.col("idx") == 1, 0.5).otherwise(1.5))
        return trials.select("number", "idx", F.when(F.col("number") != 3, 1 - off).alias("value"), F.lit(0).alias("more"))

    out = reg.study(spark.createDataFrame([(1,), (7,)], "idx long"), score, trials=14, startup=8, batch=4).collect()
    assert rounds == [[(i, n) for i in (1, 7) for n in part] for part in (range(8), range(8, 12), range(12, 14))]
    assert [r.idx for r in out] == [1] * 14 + [7] * 14 and out[0].value > 0.8 and out[14].value > 0.8
    assert all([r.value for r in out if r.idx == i] == sorted((r.value for r in out if r.idx == i), reverse=True) for i in (1, 7))
    assert {r.value for r in out if r.number == 3} == {0.0} and out[0].params.sigma != out[14].params.sigma
    assert reg.study(spark.createDataFrame([], "idx long"), score).count() == 0


def test_alignment_broadcasts_no_pixels_and_spreads_the_slices(spark):
    pixels = spark.range(64).select(F.lit(0).alias("idx"), F.lit(1).alias("z"), (F.col("id") % 8).alias("y"), F.expr("id div 8").alias("x"), F.col("id").alias("v"))
    maps = spark.createDataFrame([(0, 1, [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0])], "idx int, z int, h array<double>")
    seen = align.warp_each(pixels, maps, 8, 8)
    assert "Broadcast" not in seen._jdf.queryExecution().executedPlan().toString()
    assert {(r.y, r.x): r.v for r in seen.collect()} == {(r.y, r.x): r.v for r in pixels.collect()}
    square = [(0.0, 0.0), (9.0, 0.0), (0.0, 7.0), (8.0, 9.0), (4.0, 3.0)]
    matches = spark.createDataFrame([(z, x, y, x + z, y - z) for z in range(40) for x, y in square], "z long, sx double, sy double, dx double, dy double")
    found = reg.find_homographies(matches, ["z"])
    parts = found.rdd.glom().map(len).collect()
    assert sum(parts) == 40 and sum(n > 0 for n in parts) == int(spark.conf.get("spark.sql.shuffle.partitions"))
