"""Keypoints of planes in scale space, found tile by tile: places, sizes, directions and descriptors.

A plane is doubled and blurred by growing Gaussians; an octave ends where the blur has doubled, and the next one
works on every second pixel.  Keypoints are extrema of differences of neighbouring blurs in place and scale, moved to the
top of a fitted paraboloid, if they have contrast and don't lie on an edge.  Directions come from a histogram of
gradients around, descriptors from 4 x 4 such histograms turned by it.  An octave is one exchange of strips between tiles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import tiles
from .labels import checkpointed
from .tiles import PLACE, Tile, block_schema, block_table, deal, fields, repeated, to_blocks

# Fixed values of the detector and the descriptor.
CAMERA_BLUR, EDGE, STEPS = 0.5, 5, 5
DIRECTION_BINS, DIRECTION_BLUR, DIRECTION_SHARE = 36, 1.5, 0.8
CELLS, CELL_BINS, CELL_SIZE, MOST = 4, 8, 3.0, 0.2


#: Rows of detectors, the numbers being the caller's.
DETECTORS = "number long, sigma double, layers int, contrast double, edge double, most int"
PARTS = ("sigma", "layers", "contrast", "edge", "most")


@dataclass(frozen=True)
class Detector:
    """Blur of an octave's first image, images between doublings of the blur, least contrast (of 1), most ratio of curvatures.

    A tile keeps its ``most`` strongest keypoints of an octave (0: all): more can't be among as many of the plane.
    """

    sigma: float = 2.0
    layers: int = 4
    contrast: float = 0.03
    edge: float = 5.0
    most: int = 0

    @property
    def blurs(self) -> list[float]:
        """Blurs of an octave's images, by their distance from its first image, whose blur is ``sigma``."""
        sigma = max(self.sigma, 0.1)
        return [sigma * math.sqrt(4 ** (i / self.layers) - 1) for i in range(self.layers + 3)]

    @property
    def first_blur(self) -> float:
        return math.sqrt(max(max(self.sigma, 0.1) ** 2 - (2 * CAMERA_BLUR) ** 2, 0.01))

    @property
    def reach(self) -> int:
        """Pixels around a tile that its keypoints and their descriptors depend on."""
        largest = max(self.sigma, 0.1) * 2 ** (1 + 1 / self.layers)
        around = max(CELL_SIZE * math.sqrt(2) * (CELLS + 1) / 2, 3 * DIRECTION_BLUR)
        return _radius(self.blurs[-1]) + math.ceil(around * largest) + STEPS + 3


def _radius(blur: float) -> int:
    return math.ceil(4 * blur)


def gaussians(a: np.ndarray, blurs: list[float]) -> np.ndarray:
    """Planes (plane, y, x) under Gaussians of 4 deviations to each side, as (plane, blur, y, x); they are mirrored at their edges, the edge pixel not repeated.

    A pixel's sum takes its neighbours in pairs, wherever it lies, so that tiles and whole planes give the same.
    """
    reach = np.array([_radius(blur) for blur in blurs])
    order = np.argsort(-reach, kind="stable")
    reach, most = reach[order], int(reach.max())
    width = np.array([blurs[i] or 1.0 for i in order])
    at = np.arange(most + 1)
    kernels = np.where(at <= reach[:, None], np.exp(-0.5 * (at / width[:, None]) ** 2), 0)
    kernels = (kernels / (kernels[:, :1] + 2 * kernels[:, 1:].sum(axis=1, keepdims=True)))[:, :, None, None, None]
    a, reaching = a.astype("f8", copy=False)[None], (reach[:, None] >= at[1:]).sum(axis=0).tolist()
    for _ in range(2):  # lines, then, transposed, columns
        n = a.shape[-2]
        at = np.abs(np.arange(-most, n + most)) % max(2 * n - 2, 1)
        wide = np.take(a, np.minimum(at, 2 * n - 2 - at) if n > 1 else at * 0, -2)
        out = kernels[:, 0] * wide[:, :, most : most + n]
        pairs, parts = np.empty((len(wide), *out.shape[1:])), np.empty_like(out)
        for k, some in enumerate(reaching, 1):
            pair, part, own = pairs[:some], parts[:some], out[:some]
            np.add(wide[:some, :, most - k : most - k + n], wide[:some, :, most + k : most + k + n], out=pair)
            np.multiply(kernels[:some, k], pair, out=part)
            np.add(own, part, out=own)
        a = out.swapaxes(-1, -2)
    own = np.empty((a.shape[1], len(blurs), *a.shape[2:]))
    own[:, order] = a.swapaxes(0, 1)
    return own


def gaussian(a: np.ndarray, blur: float) -> np.ndarray:
    """:func:`gaussians` of one plane."""
    return gaussians(a[None], [blur])[0, 0]


def doubled(a: np.ndarray) -> np.ndarray:
    """Twice as many pixels each way: every second one is the mean of its neighbours, the last repeats."""
    for axis in (0, 1):
        n = a.shape[axis]
        after = np.take(a, np.minimum(np.arange(1, n + 1), n - 1), axis)
        a = np.stack([a, (a + after) / 2], axis + 1).reshape(*(2 * s if i == axis else s for i, s in enumerate(a.shape)))
    return a


@dataclass
class Octave:
    """Images (plane, blur, y, x) of planes of one size, and what part of their plane these are."""

    images: np.ndarray
    tile: Tile


#: Pixels of planes that are blurred by several Gaussians at once.
TOGETHER = 1 << 14


def _blurred(a: np.ndarray, tile: Tile, detector: Detector) -> Octave:
    """An octave of planes (plane, y, x)."""
    if a.size <= TOGETHER:
        return Octave(gaussians(a, detector.blurs), tile)
    images = np.empty((len(a), detector.layers + 3, *a.shape[1:]))
    for i, blur in enumerate(detector.blurs):
        for k, plane in enumerate(a):
            images[k, i] = gaussian(plane, blur) if blur else plane
    return Octave(images, tile)


#: Neighbours in layer, y and x: those that a paraboloid is fitted to, and all but those beside a pixel in its own layer.
_FITTED = np.array([(0, 0, 0), (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1), *((i, j, 0) for i in (1, -1) for j in (1, -1)), *((i, 0, k) for i in (1, -1) for k in (1, -1)), *((0, j, k) for j in (1, -1) for k in (1, -1))])
_FURTHER = np.array([*((i, 0, 0) for i in (1, -1)), *((0, j, k) for j in (1, -1) for k in (1, -1)), *((i, j, k) for i in (1, -1) for j in (0, 1, -1) for k in (0, 1, -1) if j or k)])


def _extrema(d: np.ndarray, tile: Tile, detector: Detector) -> np.ndarray:
    """Places (rows of plane, layer, y, x) of extrema of differences (plane, layer, y, x) among the tile's own pixels."""
    rows, columns = tile.own
    # Own pixels that aren't too near to the plane's edge, and all 26 neighbours.
    ya, yz = max(rows.start, EDGE - tile.y), min(rows.stop, tile.height - EDGE - tile.y)
    xa, xz = max(columns.start, EDGE - tile.x), min(columns.stop, tile.width - EDGE - tile.x)
    if ya >= yz or xa >= xz:
        return np.zeros((0, 4), np.int64)
    layers, high, wide = d.shape[1:]
    flat, least = d.ravel(), 0.5 * detector.contrast / detector.layers * 255
    # What is as high as its four neighbours, or as low, in the flat array; then edges go, and what others of the 26 neighbours are beyond.
    first, last = high * wide, len(flat) - high * wide
    peaks, pits = np.zeros((2, *d.shape), bool)
    keeps = [keep.ravel()[first:last] for keep in (peaks, pits)]
    np.greater(flat[first:last], least, out=keeps[0])
    np.less(flat[first:last], -least, out=keeps[1])
    for step in (1, wide):
        falls, rises = (beyond(flat[first - step : last], flat[first : last + step]) for beyond in (np.greater_equal, np.less_equal))
        for keep, down, up in zip(keeps, (falls, rises), (rises, falls), strict=True):
            keep &= down[step:]
            keep &= up[:-step]
    found, steps = [], np.split(_FURTHER @ [high * wide, wide, 1], (2, 6, 12))
    for beyond, keep in ((np.greater_equal, peaks), (np.less_equal, pits)):
        for edge in (keep[:, 0], keep[:, -1], keep[:, :, :ya], keep[:, :, yz:], keep[..., :xa], keep[..., xz:]):
            edge[...] = False
        centre = np.flatnonzero(keep)
        for some in steps:
            centre = centre[beyond(flat[centre], flat[centre + some[:, None]]).all(axis=0)]
        found.append(np.stack(np.unravel_index(centre, d.shape), axis=1))
    return np.concatenate(found)


def _keypoints(octaves: list[Octave], detector: Detector) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(octave, plane, place, contrast) of the keypoints among the tiles' own pixels; places are layer, y and x in the images, with fractions.

    Extrema of all octaves are moved to the top of a paraboloid together.
    """
    flat, found, strides, first = [], [], [], 0
    for k, octave in enumerate(octaves):
        d, tile = np.diff(octave.images, axis=1), octave.tile
        own, (_, layers, high, wide) = _extrema(d, tile, detector), d.shape
        ends = [max(EDGE - tile.y, 1), min(tile.height - EDGE - tile.y, high - 1), max(EDGE - tile.x, 1), min(tile.width - EDGE - tile.x, wide - 1)]
        found.append(np.column_stack([np.full(len(own), k), own, np.tile(ends, (len(own), 1)), first + own[:, 0] * layers * high * wide]))
        strides.append((high * wide, wide, 1))
        flat.append(d.ravel())
        first += d.size
    flat, (octave, plane, s, y, x, top, bottom, left, right, first) = np.concatenate(flat), np.concatenate(found).T.copy()
    at, strides = np.stack([s, y, x]), np.array(strides).T
    steps = _FITTED @ strides
    alive, settled = np.ones(len(s), bool), np.zeros(len(s), bool)
    shift, contrast, bent = np.zeros((3, len(s))), np.zeros(len(s)), np.zeros((2, len(s)))
    for _ in range(STEPS):
        go = np.flatnonzero(alive & ~settled)
        if not len(go):
            break
        kind = octave[go]
        place = np.take(steps, kind, axis=1)
        place += first[go] + at[0, go] * strides[0, kind] + at[1, go] * strides[1, kind] + at[2, go]
        v = flat[place]
        slope = (v[1:7:2] - v[2:7:2]) / 2
        a, b, c = v[1:7:2] + v[2:7:2] - 2 * v[0]
        e, f, g = (v[7::4] + v[10::4] - v[8::4] - v[9::4]) / 4  # layer and y, layer and x, y and x
        p, q, r = b * c - g * g, f * g - e * c, e * g - f * b
        product = a * p + e * q + f * r
        flat_top = np.abs(product) < 1e-12
        with np.errstate(all="ignore"):
            inverse = (p, q, r, q, a * c - f * f, e * f - a * g, r, e * f - a * g, a * b - e * e)
            own = -np.stack([sum(m * n for m, n in zip(inverse[3 * i : 3 * i + 3], slope, strict=True)) for i in range(3)]) / np.where(flat_top, 1.0, product)
        shift[:, go], contrast[go] = own, v[0] + (slope * own).sum(axis=0) / 2
        bent[:, go] = b + c, p
        done = (np.abs(own) < 0.5).all(axis=0) & ~flat_top
        far = flat_top | ~(np.abs(own) <= 1e6).all(axis=0)
        settled[go] = done
        at[:, go] += np.where(done | far, 0, np.round(np.where(far, 0, own))).astype(np.int64)
        s, y, x = at[:, go]
        inside = (s >= 1) & (s <= detector.layers) & (y >= top[go]) & (y < bottom[go]) & (x >= left[go]) & (x < right[go])
        alive[go] = inside & ~far
    trace, product = bent
    contrast = np.abs(contrast)
    alive &= settled & (contrast * detector.layers >= detector.contrast * 255) & (product > 0) & (trace**2 * detector.edge < (detector.edge + 1) ** 2 * product)
    if detector.most:
        group = octave * (plane.max(initial=0) + 1) + plane
        for own in np.flatnonzero(np.bincount(group[alive]) > detector.most):
            same = np.flatnonzero(alive & (group == own))
            alive[same] = contrast[same] >= np.sort(contrast[same])[-detector.most]
    return octave[alive], plane[alive], (at + shift).T[alive], contrast[alive]


@cache
def _offsets(r: int) -> tuple[np.ndarray, np.ndarray]:
    dy, dx = np.mgrid[-r : r + 1, -r : r + 1]
    return dy.ravel(), dx.ravel()


@cache
def _squares(r: int) -> np.ndarray:
    dy, dx = _offsets(r)
    return dy * dy + dx * dx


#: Pixels around keypoints that are held at once, and those of the images that these lie in.
PORTION, FIELD = 1 << 15, 1 << 18


def _portions(radius: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Keypoints of like radius and the largest one, as many as ``PORTION`` allows."""
    order = np.argsort(radius, kind="stable")
    pixels, first = (2 * radius[order] + 1) ** 2, 0
    while first < len(order):
        few = pixels[first : first + max(1, PORTION // int(pixels[first]))]
        n = max(1, int((np.arange(1, len(few) + 1) * few <= PORTION).sum()))
        part = order[first : first + n]
        yield int(radius[part[-1]]), part
        first += n


def _gradients(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(size, angle) of the gradient at each pixel but those at the array's edge, where the size is 0."""
    gy, gx = np.zeros_like(image), np.zeros_like(image)
    gy[..., 1:-1, 1:-1] = image[..., 2:, 1:-1] - image[..., :-2, 1:-1]
    gx[..., 1:-1, 1:-1] = image[..., 1:-1, 2:] - image[..., 1:-1, :-2]
    return np.sqrt(gy * gy + gx * gx), np.arctan2(gy, gx)


@dataclass
class Field:
    """Gradients of some images under each other, as flat arrays with lines of one length; nothing but 0 is around an image."""

    size: np.ndarray
    direction: np.ndarray
    bins: np.ndarray
    wide: int


def _fields(octaves: list[Octave], octave: np.ndarray, plane: np.ndarray, layer: np.ndarray, y: np.ndarray, x: np.ndarray, edge: int) -> Iterator[tuple[Field, np.ndarray, np.ndarray]]:
    """(gradients of images, the points in these, their places there), in portions of ``FIELD`` pixels."""
    sizes = len(octaves), *octaves[0].images.shape[:2]
    images, which = np.unique(np.ravel_multi_index((octave, plane, layer), sizes), return_inverse=True)
    images = np.stack(np.unravel_index(images, sizes))
    wide = max(octaves[k].images.shape[3] for k in images[0]) + edge
    high = np.array([octaves[k].images.shape[2] + edge for k in images[0]], np.int64)
    lot = np.cumsum(high * wide) // FIELD
    for own in np.unique(lot).tolist():
        ones = np.flatnonzero(lot == own)
        begin = edge + np.cumsum(high[ones]) - high[ones]
        size, direction = np.zeros((2, edge + int(high[ones].sum()), wide))
        for k in np.unique(images[0, ones]).tolist():
            same = np.flatnonzero(images[0, ones] == k)
            for at, *both in zip(begin[same], *_gradients(octaves[k].images[images[1, ones[same]], images[2, ones[same]]]), strict=True):
                h, w = both[0].shape
                size[at : at + h, :w], direction[at : at + h, :w] = both
        bins = np.round(direction * (DIRECTION_BINS / (2 * math.pi))).astype(np.int64)
        bins += DIRECTION_BINS * (bins < 0)
        points = np.flatnonzero(lot[which] == own)
        yield Field(size.ravel(), direction.ravel(), bins.ravel(), wide), points, (begin[which[points] - ones[0]] + y[points]) * wide + x[points]


def _directions(field: Field, at: np.ndarray, scale: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which keypoint, angle) of the peaks of the smoothed histograms of gradient directions around keypoints."""
    peaks = []
    for r, part in _portions(radius):
        dy, dx = _offsets(r)
        around = at[part, None] + (dy * field.wide + dx)
        weight = np.exp(np.outer(-0.5 / (DIRECTION_BLUR * scale[part]) ** 2, _squares(r)))
        weight *= field.size[around]
        if radius[part[0]] < r:
            weight *= np.maximum(np.abs(dy), np.abs(dx)) <= radius[part, None]
        own = field.bins[around] + DIRECTION_BINS * np.arange(len(part))[:, None]
        h = np.bincount(own.ravel(), weight.ravel(), DIRECTION_BINS * len(part)).reshape(-1, DIRECTION_BINS)
        around = np.take(h, np.arange(-2, DIRECTION_BINS + 2) % DIRECTION_BINS, 1)
        h = (around[:, :-4] + around[:, 4:] + 4 * (around[:, 1:-3] + around[:, 3:-1]) + 6 * h) / 16
        around = np.take(h, np.arange(-1, DIRECTION_BINS + 1) % DIRECTION_BINS, 1)
        before, after = around[:, :-2], around[:, 2:]
        peak = np.divmod(np.flatnonzero((h > before) & (h > after) & (h >= DIRECTION_SHARE * h.max(axis=1, keepdims=True))), DIRECTION_BINS)
        tops = peak[1] + (before[peak] - after[peak]) / (2 * (before[peak] - 2 * h[peak] + after[peak]))
        peaks.append((part[peak[0]], tops % DIRECTION_BINS * 2 * math.pi / DIRECTION_BINS))
    return tuple(np.concatenate(c) for c in zip(*peaks, strict=True)) if peaks else (np.zeros(0, np.int64), np.zeros(0))


def _descriptors(field: Field, at: np.ndarray, scale: np.ndarray, turn: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """4 x 4 histograms of 8 directions in a keypoint's own frame, shared out linearly, at unit length; 0 where there is no gradient."""
    out, whole = np.empty((len(at), CELLS * CELLS * CELL_BINS)), (CELLS + 3) * (CELLS + 2) * CELL_BINS
    c, s, bins = (np.cos(turn) / (CELL_SIZE * scale)).astype("f4"), (np.sin(turn) / (CELL_SIZE * scale)).astype("f4"), np.float32(CELL_BINS / (2 * math.pi))
    turn, size, direction = (v.astype("f4") for v in (turn, field.size, field.direction))  # shares of pixels; their sums are double
    for r, part in _portions(radius):
        n, (dy, dx) = len(part), _offsets(r)
        disc = np.flatnonzero(_squares(r) <= 1.0001 * (CELLS + 1) ** 2 / 2 * (CELL_SIZE * scale[part].max()) ** 2)  # with room for rounding
        dy, dx = dy[disc], dx[disc]
        cx, sx, cy, sy = (np.outer(own[part], v) for v in (dx.astype("f4"), dy.astype("f4")) for own in (c, s))
        across, down, limit = np.add(cx, sy, out=cx), np.subtract(cy, sx, out=cy), (CELLS + 1) / 2
        inside = (np.abs(across) < limit) & (np.abs(down) < limit)
        inside = np.flatnonzero(inside)
        pixels = np.diff(np.searchsorted(inside, np.arange(n + 1) * len(dy)))
        across, down, near = across.ravel()[inside], down.ravel()[inside], (at[part, None] + (dy * field.wide + dx)).ravel()[inside]
        weight = across * across
        weight += down * down
        weight *= -2.0 / (CELLS * CELLS)
        np.exp(weight, out=weight)
        weight *= size[near]
        across += CELLS / 2 + 0.5
        down += CELLS / 2 + 0.5
        bin_ = direction[near]
        bin_ -= np.repeat(turn[part], pixels)
        bin_ *= bins
        turned = np.floor(bin_)
        row, column = np.floor(down), np.floor(across)
        p, q, t = np.subtract(down, row, out=down), np.subtract(across, column, out=across), np.subtract(bin_, turned, out=bin_)
        row *= CELLS + 2
        row += column
        first = row.astype(np.int64)
        first *= CELL_BINS
        first += np.repeat(np.arange(n) * whole, pixels)
        k = turned.astype(np.int64)
        to, share = np.empty((8, len(near)), np.int64), np.empty((8, len(near)), "f4")
        np.add(first, k & (CELL_BINS - 1), out=to[0])
        k += 1
        k &= CELL_BINS - 1
        np.add(first, k, out=to[4])
        for m in (0, 4):
            for corner, step in ((1, 1), (2, CELLS + 2), (3, CELLS + 3)):
                np.add(to[m], step * CELL_BINS, out=to[m + corner])
        np.multiply(weight, p, out=share[6])
        np.subtract(weight, share[6], out=share[4])
        for m in (4, 6):
            np.multiply(share[m], q, out=share[m + 1])
            share[m] -= share[m + 1]
        for m in range(4):
            share_t = share[m + 4] * t
            np.subtract(share[m + 4], share_t, out=share[m])
            share[m + 4] = share_t
        h = np.bincount(to.ravel(), share.ravel(), n * whole).reshape(n, whole)[:, : (CELLS + 2) ** 2 * CELL_BINS]
        out[part] = h.reshape(n, CELLS + 2, CELLS + 2, CELL_BINS)[:, 1:-1, 1:-1].reshape(n, -1)
    np.minimum(out, MOST * np.sqrt(np.einsum("ij,ij->i", out, out))[:, None], out=out)
    norm = np.sqrt(np.einsum("ij,ij->i", out, out))
    out /= np.where(norm > 0, norm, 1)[:, None]
    return out


@dataclass
class _Points:
    """Keypoints of some octaves: which octave and plane, their place in the images and their contrast, the blur at their place and the image next to it."""

    octave: np.ndarray
    plane: np.ndarray
    place: np.ndarray
    gain: np.ndarray
    scale: np.ndarray
    layer: np.ndarray

    @classmethod
    def of(cls, octaves: list[Octave], detector: Detector) -> _Points:
        octave, plane, place, gain = _keypoints(octaves, detector)
        layer = np.clip(np.round(place[:, 0]), 0, detector.layers + 2).astype(np.int64)
        return cls(octave, plane, place, gain, max(detector.sigma, 0.1) * 2.0 ** (place[:, 0] / detector.layers), layer)

    def near(self, which: np.ndarray) -> np.ndarray:
        """Pixels each way that the direction depends on."""
        return np.round(3 * (DIRECTION_BLUR * self.scale[which])).astype(np.int64)

    def far(self, which: np.ndarray) -> np.ndarray:
        """Pixels each way that the descriptor depends on."""
        return np.round(CELL_SIZE * self.scale[which] * math.sqrt(2) * (CELLS + 1) / 2).astype(np.int64)

    def fields(self, octaves: list[Octave], which: np.ndarray) -> Iterator[tuple[Field, np.ndarray, np.ndarray]]:
        """(gradients, which of the keypoints lie there, their places)."""
        if len(which):
            y, x = np.round(self.place[which, 1:]).astype(np.int64).T
            edge = int(max(self.near(which).max(), self.far(which).max()))
            for field, own, at in _fields(octaves, self.octave[which], self.plane[which], self.layer[which], y, x, edge):
                yield field, which[own], at

    def table(self, octaves: list[Octave], which: np.ndarray, angle: np.ndarray) -> np.ndarray:
        """Rows of y, x, size, contrast and angle, in pixels of the octave's plane."""
        first = np.array([(o.tile.y, o.tile.x) for o in octaves])[self.octave[which]]
        return np.column_stack([self.place[which, 1:] + first, self.scale[which], self.gain[which], angle])


def octave(tile: Tile, detector: Detector) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keypoints of the tile's own pixels, their descriptors, the image the next octave begins with) of one octave.

    A keypoint is a row of y, x, size, contrast and angle, in pixels of this octave's plane.
    """
    octaves = [_blurred(tile.a[None], tile, detector)]
    points, rows, descriptors = _Points.of(octaves, detector), [np.zeros((0, 5))], [np.zeros((0, CELLS * CELLS * CELL_BINS))]
    for field, own, at in points.fields(octaves, np.arange(len(points.gain))):
        who, angle = _directions(field, at, points.scale[own], points.near(own))
        at, own = at[who], own[who]
        v = _descriptors(field, at, points.scale[own], angle, points.far(own))
        some = v.any(axis=1)
        rows.append(points.table(octaves, own[some], angle[some]))
        descriptors.append(v[some])
    return np.concatenate(rows), np.concatenate(descriptors), octaves[0].images[0, detector.layers]


def small_planes(planes: np.ndarray, detector: Detector, octaves: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each plane (plane, y, x) of one size: its keypoints, rows of y, x, size, contrast, angle and octave, and their descriptors.

    The planes lie, doubled, in one tile: all octaves come without an exchange.  Keypoints are in order from the strongest, ties in reading order;
    only the ``most`` strongest are described.
    """
    a, parts = gaussians(np.stack([doubled(v.astype("f4").astype("f8")).astype("f4") for v in planes]), [detector.first_blur])[:, 0].astype("f4"), []
    for _ in range(octaves):
        if min(a.shape[1:]) <= 2 * EDGE:
            break  # all is too near to the edge, here and in what follows
        parts.append(_blurred(a, Tile(a, 0, 0, 0, 0, *a.shape[1:], *a.shape[1:]), detector))
        a = parts[-1].images[:, detector.layers, ::2, ::2].astype("f4")
    found = [(np.zeros((0, 6)), np.zeros((0, CELLS * CELLS * CELL_BINS)))] * len(planes)
    if not parts:
        return found
    points = _Points.of(parts, detector)
    left = [np.flatnonzero(points.plane == k) for k in range(len(planes))]
    lacking = lambda k: detector.most - len(found[k][0]) if detector.most else len(left[k])
    while any(len(own) and lacking(k) for k, own in enumerate(left)):
        taken = [np.zeros(0, np.int64)]
        for k, own in enumerate(left):
            # As many as are missing, and those as strong as the last one; most have a direction, some more than one.
            n = lacking(k)
            strong = points.gain[own] >= (np.sort(points.gain[own])[-n] if 0 < n < len(own) else -np.inf) if n else np.zeros(len(own), bool)
            taken.append(own[strong])
            left[k] = own[~strong]
        fields = list(points.fields(parts, np.concatenate(taken)))
        turned = [(np.full(len(who), k), own[who], at[who], angle) for k, (field, own, at) in enumerate(fields) for who, angle in [_directions(field, at, points.scale[own], points.near(own))]]
        in_field, who, at, angle = (np.concatenate(c) for c in zip(*turned, strict=True))
        rows = points.table(parts, who, angle)
        rows[:, :3] *= 2.0 ** (points.octave[who, None] - 1)
        rows = np.column_stack([rows, points.octave[who]])
        order = np.lexsort((angle, *rows[:, 2::-1].T, -rows[:, 3]))
        while len(order):
            # Only those that have no gradient around, and so no descriptor, make room for weaker ones.
            plane = points.plane[who[order]]
            first = np.concatenate([np.flatnonzero(plane == k)[: lacking(k) if detector.most else None] for k in range(len(planes))])
            own, order = order[first], np.delete(order, first)
            if not len(own):
                break
            v = np.empty((len(own), CELLS * CELLS * CELL_BINS))
            for k, (field, *_) in enumerate(fields):
                here = np.flatnonzero(in_field[own] == k)
                v[here] = _descriptors(field, at[own[here]], points.scale[who[own[here]]], angle[own[here]], points.far(who[own[here]]))
            some = v.any(axis=1)
            for k in range(len(planes)):
                mine = some & (points.plane[who[own]] == k)
                found[k] = tuple(np.concatenate([old, more]) for old, more in zip(found[k], (rows[own[mine]], v[mine]), strict=True))
    return found


_POINT = [*(T.StructField(c, T.DoubleType()) for c in ("y", "x", "size", "gain", "angle")), T.StructField("octave", T.LongType()), T.StructField("descriptor", T.ArrayType(T.DoubleType()))]


def _halved(tile: Tile, a: np.ndarray) -> tuple[np.ndarray, int, int]:
    """Every second pixel of the tile's own, and their place in the next plane."""
    own = a[tile.own]
    own = own[tile.top % 2 :: 2, tile.left % 2 :: 2]
    return own, (tile.top + 1) // 2, (tile.left + 1) // 2


def octaves_of(side: int | None) -> int:
    """Octaves of planes whose smallest side has so many pixels."""
    return max(0, math.floor(math.log2(max(2 * (side or 0), 1))) - 2)


def whole_plane(height: int, width: int, y: int, x: int, ny: int, nx: int, data: np.ndarray, missing: float) -> np.ndarray:
    """A plane from its only block."""
    a = np.full((height, width), missing, data.dtype)
    a[y : y + ny, x : x + nx] = data.reshape(ny, nx)
    return a


def scale_space(planes: DataFrame, keys: list[str], detectors: DataFrame, octaves: int | None = None) -> DataFrame:
    """(keys, number, y, x, size, gain, angle, octave, descriptor) of planes (keys, y, x, v) with values of 0 to 255.

    ``detectors`` are the rows (number, sigma, layers, contrast, edge, most) of a few detectors: each plane is searched by each, or, if
    some of the keys are among their columns too, by those of its key.
    Missing pixels are 0.  A plane of fewer than 12 pixels each way has no keypoints; octaves go on while the smallest side
    has 8 pixels, unless a number is given.
    """
    few = [Detector(*r) for r in detectors.select(*PARTS).distinct().collect()]
    reach = max((d.reach for d in few), default=0)
    own = [*keys, "number", "detector"]
    on = [k for k in keys if k in detectors.columns]
    known = detectors.select(*on, "number", F.struct(*PARTS).alias("detector"))
    of = lambda table: Detector(**table.column("detector")[0].as_py())
    first = checkpointed(to_blocks(planes, keys, "f4"))
    size = first.agg(F.min(F.least("height", "width")), F.max(F.greatest("height", "width"))).first()
    octaves = octaves_of(size[0]) if octaves is None else octaves
    with_own = lambda df: df.join(F.broadcast(known), on) if on else df.crossJoin(F.broadcast(known))
    # A plane that lies in one tile, doubled, is searched whole; only larger ones exchange strips, octave by octave.
    small = F.greatest("height", "width") <= tiles.SIDE // 2
    names = [f.name for f in _POINT]

    def points_of(table: pa.Table, columns: list[str], points: np.ndarray, descriptors: np.ndarray) -> pa.Table:
        values = [*(pa.array(np.ascontiguousarray(c)) for c in points[:, :5].T), pa.array(points[:, 5].astype(np.int64))]
        ends = pa.array(np.arange(len(points) + 1, dtype=np.int32) * descriptors.shape[1])
        return pa.table({**repeated(table, columns, len(points)), **dict(zip(names, [*values, pa.ListArray.from_arrays(ends, descriptors.ravel())], strict=True))})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                a = whole_plane(*(row.column(c)[0].as_py() for c in PLACE), np.frombuffer(row.column("data")[0].as_buffer(), "f4"), 0)
                yield from points_of(row, [*keys, "number"], *small_planes(a[None], of(row), octaves)[0]).to_batches()

    dealt = with_own(first.where(small)).repartition(int(planes.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "number")
    out = dealt.mapInArrow(search, T.StructType([*fields(first, keys), known.schema["number"], *_POINT]))
    if (size[1] or 0) <= tiles.SIDE // 2:
        return out
    first = first.where(~small)

    def begin(tile: Tile, table: pa.Table) -> pa.Table:
        a = doubled(tile.a.astype("f8"))
        rows, columns = tile.own
        a = a[2 * rows.start : 2 * rows.stop, 2 * columns.start : 2 * columns.stop]
        return block_table(table, keys, a.astype("f4"), 2 * tile.top, 2 * tile.left, 2 * tile.height, 2 * tile.width)

    def blurred(tile: Tile, table: pa.Table) -> pa.Table:
        a = gaussian(tile.a, of(table).first_blur)[tile.own]
        return block_table(table, own, a.astype("f4"), tile.top, tile.left, tile.height, tile.width)

    start = deal(first, keys, "f4", 1, begin, block_schema(first, keys))
    start = with_own(start)
    blocks = deal(start, own, "f4", max((_radius(d.first_blur) for d in few), default=0), blurred, block_schema(start, own))
    for k in range(octaves):
        scale = 2.0 ** (k - 1)

        def work(tile: Tile, table: pa.Table, k: int = k, scale: float = scale) -> pa.Table:
            detector = of(table)
            points, descriptors, last = octave(tile, detector)
            half, y, x = _halved(tile, last)
            block = block_table(table, own, half.astype("f4"), y, x, (tile.height + 1) // 2, (tile.width + 1) // 2).slice(0, int(half.size > 0))
            points[:, :3] *= scale
            rows = points_of(table, own, np.column_stack([points, np.full(len(points), k)]), descriptors)
            return pa.concat_tables([rows, block], promote_options="default").select([*own, *PLACE, "data", *names])

        schema = T.StructType([*fields(blocks, own), *block_schema(blocks, []).fields, *_POINT])
        made = checkpointed(deal(blocks, own, "f4", reach, work, schema))
        points = made.where("octave is not null").select(*keys, "number", *(f.name for f in _POINT))
        out = out.unionByName(points)
        blocks = made.where("octave is null").select(*own, *PLACE, "data")
    return out
