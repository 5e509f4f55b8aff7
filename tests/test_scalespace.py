"""Keypoints in scale space against a plain version of whole planes, and what they are for: turned and scaled slices."""

import math

import numpy as np
import pytest

from lamella.operators import align, scalespace as sca, tiles as til
from lamella.operators.scalespace import Detector


def blobs(n, turn=0.0, scale=1.0, seed=1, middle=None, at=(0.0, 0.0)):
    """A made plane of n x n: bright and dark blobs, the whole turned and scaled about the middle and moved."""
    rng = np.random.default_rng(seed)
    places, sizes = rng.uniform(-n, n, (n * n // 12, 2)), rng.uniform(0.8, 3, n * n // 12)
    tops = rng.choice([-1, 1], len(sizes)) * rng.uniform(60, 140, len(sizes))
    y, x = np.mgrid[:n, :n].astype(float)
    v, u = (y - n / 2 - at[0]) / scale, (x - n / 2 - at[1]) / scale
    c, s = math.cos(turn), math.sin(turn)
    v, u = c * v - s * u, c * u + s * v
    out = np.full((n, n), 120.0)
    for (p, q), size, top in zip(places, sizes, tops, strict=True):
        out += top * np.exp(-((v - p) ** 2 + (u - q) ** 2) / (2 * size * size))
    return np.clip(np.round(out), 0, 255).astype(int)


def planes(spark, *images):
    rows = [(1, z, y, x, int(v)) for z, a in enumerate(images) for (y, x), v in np.ndenumerate(a)]
    return spark.createDataFrame(rows, "idx long, z long, y long, x long, v long")


def plain_blur(a, blur):
    """The same Gaussian as matrices: one for lines, one for columns."""
    if not blur:
        return a
    r = math.ceil(4 * blur)
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / blur) ** 2)
    k /= k.sum()

    def matrix(n):
        m = np.zeros((n, n))
        for i in range(n):
            for j, w in zip(range(i - r, i + r + 1), k, strict=True):
                while not 0 <= j < n:
                    j = -j if j < 0 else 2 * n - 2 - j
                m[i, j] += w
        return m

    return matrix(a.shape[0]) @ a @ matrix(a.shape[1]).T


def plain_points(a, detector):
    """(octave, y, x, size, gain) of a whole plane, one candidate after the other."""
    wide = np.array(a, float)
    for axis in (0, 1):
        wide = np.moveaxis(wide, axis, 0)
        out = np.zeros((2 * len(wide), wide.shape[1]))
        for i in range(len(wide)):
            out[2 * i] = wide[i]
            out[2 * i + 1] = (wide[i] + wide[min(i + 1, len(wide) - 1)]) / 2
        wide = np.moveaxis(out, 0, axis)
    base = plain_blur(wide, math.sqrt(detector.sigma**2 - 1))
    out = []
    for octave in range(math.floor(math.log2(2 * min(a.shape))) - 2):
        images = [plain_blur(base, detector.sigma * math.sqrt(4 ** (i / detector.layers) - 1)) for i in range(detector.layers + 3)]
        d = np.diff(np.stack(images), axis=0)
        for start in np.argwhere(np.abs(d) > 0.5 * detector.contrast / detector.layers * 255):
            s, y, x = start
            if not (1 <= s <= detector.layers and 5 <= y < d.shape[1] - 5 and 5 <= x < d.shape[2] - 5):
                continue
            cube = d[s - 1 : s + 2, y - 1 : y + 2, x - 1 : x + 2]
            if not (d[s, y, x] > 0 and d[s, y, x] == cube.max() or d[s, y, x] < 0 and d[s, y, x] == cube.min()):
                continue
            for _ in range(5):
                c = d[s - 1 : s + 2, y - 1 : y + 2, x - 1 : x + 2]
                g = np.array([c[2, 1, 1] - c[0, 1, 1], c[1, 2, 1] - c[1, 0, 1], c[1, 1, 2] - c[1, 1, 0]]) / 2
                h = np.diag([c[2, 1, 1] + c[0, 1, 1], c[1, 2, 1] + c[1, 0, 1], c[1, 1, 2] + c[1, 1, 0]]) - 2 * c[1, 1, 1] * np.eye(3)
                h[0, 1] = h[1, 0] = (c[2, 2, 1] - c[2, 0, 1] - c[0, 2, 1] + c[0, 0, 1]) / 4
                h[0, 2] = h[2, 0] = (c[2, 1, 2] - c[2, 1, 0] - c[0, 1, 2] + c[0, 1, 0]) / 4
                h[1, 2] = h[2, 1] = (c[1, 2, 2] - c[1, 2, 0] - c[1, 0, 2] + c[1, 0, 0]) / 4
                if abs(np.linalg.det(h)) < 1e-12:
                    break
                to = -np.linalg.solve(h, g)
                if (np.abs(to) < 0.5).all():
                    gain = abs(c[1, 1, 1] + g @ to / 2)
                    product, trace = h[1, 1] * h[2, 2] - h[1, 2] ** 2, h[1, 1] + h[2, 2]
                    if gain * detector.layers >= detector.contrast * 255 and product > 0 and trace**2 * detector.edge < (detector.edge + 1) ** 2 * product:
                        scale = 2.0 ** (octave - 1)
                        out.append((octave, (y + to[1]) * scale, (x + to[2]) * scale, detector.sigma * 2 ** ((s + to[0]) / detector.layers) * scale, gain))
                    break
                s, y, x = np.array([s, y, x]) + np.round(to).astype(int)
                if not (1 <= s <= detector.layers and 5 <= y < d.shape[1] - 5 and 5 <= x < d.shape[2] - 5):
                    break
        base = images[detector.layers][::2, ::2]
    return out


def found(spark, a, detector, side, monkeypatch):
    monkeypatch.setattr(til, "SIDE", side)
    one = spark.createDataFrame([(0, detector.sigma, detector.layers, detector.contrast, detector.edge, detector.most)], sca.DETECTORS)
    return sca.scale_space(planes(spark, a), ["idx", "z"], one).collect()


@pytest.mark.parametrize("detector", [Detector(1.6, 3, 0.03, 8.0), Detector(2.0, 4, 0.02, 5.0)])
def test_points_equal_a_plain_version(spark, monkeypatch, detector):
    a = blobs(66)[:60]
    got = sorted({(r.octave, r.y, r.x, r["size"], r.gain) for r in found(spark, a, detector, 32, monkeypatch)})
    want = sorted(set(plain_points(a, detector)))
    assert len(got) == len(want) > 20
    assert np.array(got) == pytest.approx(np.array(want), abs=1e-3)


def test_tiles_make_no_difference(spark, monkeypatch):
    a, detector = blobs(70, seed=3)[:50], Detector(1.6, 3, 0.03, 8.0)
    key = lambda r: (r.octave, r.y, r.x, r["size"], r.angle, tuple(r.descriptor))
    assert sorted(map(key, found(spark, a, detector, 16, monkeypatch))) == sorted(map(key, found(spark, a, detector, 512, monkeypatch)))


def test_parameters_change_keypoints(spark, monkeypatch):
    a = blobs(64, seed=4)
    places = lambda **more: {(round(r.y, 3), round(r.x, 3)) for r in found(spark, a, Detector(**more), 64, monkeypatch)}
    usual = places()
    assert usual and places(sigma=1.2) != usual and places(layers=2) != usual
    assert len(places(edge=1.5)) < len(usual) < len(places(edge=15.0, contrast=0.01)) and len(places(contrast=0.2)) < len(usual)


@pytest.mark.parametrize(("turn", "scale"), [(math.radians(30), 1.0), (0.0, 1.5), (math.radians(30), 1.5), (math.radians(170), 0.8)])
def test_turned_and_scaled_slices_are_aligned(spark, turn, scale):
    n = 128
    stack = planes(spark, blobs(n), blobs(n, turn, scale, at=(2.0, -3.0)))
    _, status = align.align_stack(stack, spark.createDataFrame([(1, 0)], "idx long, z long"), n, n)
    row = status.first()
    assert row.status == "aligned" and row.inliers >= 8
    h = np.array(row.h).reshape(3, 3)
    for y, x in ((64, 64), (40, 70), (80, 50)):  # places of the reference, and where they are in the other slice
        c, s = math.cos(turn), math.sin(turn)
        v, u = y - n / 2, x - n / 2
        there = np.array([(c * u - s * v) * scale + n / 2 - 3.0, (s * u + c * v) * scale + n / 2 + 2.0, 1.0])
        back = h @ there
        assert back[:2] / back[2] == pytest.approx([x, y], abs=1.0)


def test_planes_without_keypoints(spark):
    flat = planes(spark, np.full((40, 40), 7), np.zeros((3, 3), int))
    assert align.keypoints(flat).count() == 0
    assert align.keypoints(flat.limit(0)).count() == 0


def test_the_strongest_are_those_of_all(spark, monkeypatch):
    monkeypatch.setattr(til, "SIDE", 16)
    df = planes(spark, blobs(60, seed=6))
    key = lambda r: (r.kp, r.gain, r.y, r.x, r["size"], r.angle, tuple(r.descriptor))
    every = sorted(map(key, align.keypoints(df, detector=Detector(1.6, 3, 0.01, 10.0)).collect()))
    assert len(every) > 40 and sorted(map(key, align.keypoints(df, 12, Detector(1.6, 3, 0.01, 10.0)).collect())) == every[:12]
