"""Outlines of labelled objects: exact polygon moments, perimeters and features, without tracing a border.

The outline of an 8-connected object runs through the centres of its border pixels.  Once holes are
filled, the polygon is the union of one piece for each square of four neighbouring centres: the whole
square if all four are set, a triangle if three are, nothing otherwise.  So areas, moments and the
outline's length are sums over squares, which Spark aggregates before it shuffles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import tiles
from .labels import checkpointed, connected_components, first_pixels, shuffled
from .matching import nearest, zscore
from .tiles import fields


def _dealt(df: DataFrame) -> DataFrame:
    """Few bytes, much work: a number of partitions keeps objects from being coalesced by their size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "z", "label")


def filled(labels: DataFrame) -> DataFrame:
    """(z, label, y, x) of each object with its holes, that is what the outside of its box can't reach by 4 neighbours.

    Takes (z, y, x, label); a pixel can lie in several objects if one is nested in another's hole.  Objects whose box is no
    larger than a tile are filled one after the other in a task, the others by components over tables.
    """
    own = labels.select("z", "label", "y", "x")
    box = own.groupBy("z", "label").agg(F.min("y").alias("a"), F.max("y").alias("b"), F.min("x").alias("c"), F.max("x").alias("d"), F.count("*").alias("n"))
    # A hole has four pixels around it at least.
    box = checkpointed(box.where("n >= 4 and b - a >= 2 and d - c >= 2").drop("n"))
    fits = F.greatest(F.col("b") - F.col("a"), F.col("d") - F.col("c")) < tiles.SIDE
    few = _dealt(own).join(shuffled(box.where(fits)), ["z", "label"]).groupBy("z", "label").agg(F.collect_list(F.struct("y", "x")).alias("at"))
    solid = own.unionByName(few.mapInArrow(_holes, own.schema))
    large = box.where(~fits)
    if large.isEmpty():
        return solid
    line = large.withColumn("y", F.explode(F.sequence(F.col("a") - 1, F.col("b") + 1)))
    cells = line.withColumn("x", F.explode(F.sequence(F.col("c") - 1, F.col("d") + 1)))
    free = cells.join(own, ["z", "label", "y", "x"], "left_anti")
    # Shifted by the box, so that coordinates begin at 0 and the outside's first pixel, the corner, gives it the label 0.
    keyed = free.select(F.struct("z", "label", "a", "c").alias("z"), (F.col("y") - F.col("a") + 1).alias("y"), (F.col("x") - F.col("c") + 1).alias("x"))
    holes = connected_components(keyed, diagonal=False).where("label <> 0")
    holes = holes.select("z.z", "z.label", (F.col("y") + F.col("z.a") - 1).alias("y"), (F.col("x") + F.col("z.c") - 1).alias("x"))
    return solid.unionByName(holes)


def _lists(batch: pa.RecordBatch, column: str, names: list[str]) -> Iterator[tuple[np.ndarray, ...]]:
    """A list of structs' fields as arrays, row by row."""
    lists = batch.column(column)
    ends, values = lists.offsets.to_numpy(), lists.values
    parts = [values.field(n).to_numpy(zero_copy_only=False) for n in names]
    for i in range(len(lists)):
        yield tuple(v[ends[i] : ends[i + 1]] for v in parts)


def _holes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pixels of objects' holes, from rows of an object's pixels."""
    for batch in batches:
        who, ys, xs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, (y, x) in enumerate(_lists(batch, "at", ["y", "x"])):
            y0, x0 = int(y.min()) - 1, int(x.min()) - 1
            free = np.ones((int(y.max()) - y0 + 2, int(x.max()) - x0 + 2), bool)
            free[y - y0, x - x0] = False
            y, x, first_y, first_x = first_pixels(free, False)
            hole = (first_y > 0) | (first_x > 0)  # the outside's first pixel is the corner
            if hole.any():
                who.append(np.full(int(hole.sum()), i))
                ys.append(y[hole] + y0)
                xs.append(x[hole] + x0)
        who = pa.array(np.concatenate(who))
        yield pa.RecordBatch.from_arrays([batch.column("z").take(who), batch.column("label").take(who), pa.array(np.concatenate(ys)), pa.array(np.concatenate(xs))], names=["z", "label", "y", "x"])


def _squares(pixels: DataFrame) -> DataFrame:
    """(z, label, y, x, n, sy, sx, bits) of each square with a set corner; (y, x) is its first corner, bits tell which are set."""
    corners = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)))
    spread = pixels.withColumn("d", F.explode(corners)).select("z", "label", (F.col("y") - F.col("d.a")).alias("qy"), (F.col("x") - F.col("d.b")).alias("qx"), "y", "x", (F.col("d.a") * 2 + F.col("d.b")).alias("corner"))
    return spread.groupBy("z", "label", "qy", "qx").agg(
        F.count("*").alias("n"), F.sum("y").alias("sy"), F.sum("x").alias("sx"), F.sum(F.expr("shiftleft(1, corner)")).alias("bits")
    )


def _area(n: str = "n") -> Column:
    return F.when(F.col(n) == 4, 1.0).when(F.col(n) == 3, 0.5).otherwise(0.0)


def _moment(c: str) -> Column:
    """Twelve times a first moment of the pieces, in integers."""
    return F.sum(F.when(F.col("n") == 4, 3 * F.col(c)).when(F.col("n") == 3, 2 * F.col(c)).otherwise(0))


def contour_centroids(labels: DataFrame) -> DataFrame:
    """(z, label, area, cx, cy): the outline polygon's area and its centroid cut to integers; (0, 0) where the area is 0."""
    sums = _squares(filled(labels)).groupBy("z", "label").agg(
        F.sum(_area()).alias("area"), _moment("sx").alias("mx"), _moment("sy").alias("my")
    )
    middle = lambda m: F.when(F.col("area") > 0, (F.col(m) / (12 * F.col("area"))).cast("long")).otherwise(0).cast("long")
    return sums.select("z", "label", "area", middle("mx").alias("cx"), middle("my").alias("cy"))


def _nodes() -> Column:
    """Points and weights that integrate cubic polynomials exactly over the piece of a square, by its set corners."""
    g = 0.5 / math.sqrt(3)
    rules = {15: [(0.5 + a * g, 0.5 + b * g, 0.25) for a in (-1, 1) for b in (-1, 1)]}
    for missing in range(4):
        c = np.array([(k // 2, k % 2) for k in range(4) if k != missing], float)
        mid = c.mean(axis=0)
        rules[15 - (1 << missing)] = [(*mid, -27 / 96), *((*(0.4 * p + 0.6 * mid), 25 / 96) for p in c)]
    at = lambda r: F.array(*(F.struct(F.lit(float(y)).alias("v"), F.lit(float(x)).alias("u"), F.lit(float(w)).alias("w")) for y, x, w in r))
    out = F.when(F.col("bits") == 15, at(rules.pop(15)))
    for bits, r in rules.items():
        out = out.when(F.col("bits") == bits, at(r))
    return out


def _hull_area(y: np.ndarray, a: np.ndarray, b: np.ndarray) -> float:
    """Area of the convex hull of an object's line ends, two points for each line."""
    p = sorted({(float(x), float(y)) for y, *ends in zip(y.tolist(), a.tolist(), b.tolist(), strict=True) for x in ends})

    def chain(points):
        out: list = []
        for q in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]):
                out.pop()
            out.append(q)
        return out[:-1]

    h = np.array((chain(p) + chain(p[::-1])) or p)
    x, y = h[:, 0], h[:, 1]
    return float(abs(x @ np.roll(y, -1) - y @ np.roll(x, -1)) / 2)


def _hulls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        areas = [_hull_area(*line) for line in _lists(batch, "lines", ["y", "a", "b"])]
        yield pa.RecordBatch.from_arrays([batch.column("z"), batch.column("label"), pa.array(areas, pa.float64())], names=["z", "label", "hull"])


#: Powers (p, q) of x and y whose sums over the outline an ellipse is fitted to.
POWERS = [(p, q) for n in range(5) for p, q in ((n - k, k) for k in range(n + 1))]


def outline_sums(solid: DataFrame) -> DataFrame:
    """(z, label, x0, y0, s00, s10, s01, ...): sums of x^p y^q over the outline pixels of filled objects, from the corner (x0, y0) of their box.

    Outline pixels have a neighbour above, below, left or right that isn't the object's.
    """
    ways = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 0), (0, 1), (0, -1), (1, 0), (-1, 0))))
    spread = solid.withColumn("d", F.explode(ways)).select("z", "label", (F.col("y") + F.col("d.i")).alias("y"), (F.col("x") + F.col("d.j")).alias("x"), ((F.col("d.i") == 0) & (F.col("d.j") == 0)).cast("int").alias("own"))
    line = spread.groupBy("z", "label", "y", "x").agg(F.max("own").alias("own"), F.count("*").alias("n")).where("own = 1 and n < 5").select("z", "label", "y", "x")
    box = solid.groupBy("z", "label").agg(F.min("x").alias("x0"), F.min("y").alias("y0"))
    x, y = (F.col("x") - F.col("x0")).cast("double"), (F.col("y") - F.col("y0")).cast("double")
    power = lambda c, k: F.lit(1.0) if not k else c if k == 1 else power(c, k - 1) * c
    return line.join(box, ["z", "label"]).groupBy("z", "label", "x0", "y0").agg(*(F.sum(power(x, p) * power(y, q)).alias(f"s{p}{q}") for p, q in POWERS))


def _ellipse(sums: dict[tuple[int, int], float]) -> tuple[float, ...] | None:
    """(cx, cy, major, minor, angle) of the ellipse of least squares through points with these sums; None if there is none.

    The conic's factors solve an eigenproblem of 3 x 3, after its linear part is eliminated, in coordinates of mean 0 and spread 1.
    """
    n = sums[0, 0]
    mx, my = sums[1, 0] / n, sums[0, 1] / n
    spread = math.sqrt(max((sums[2, 0] + sums[0, 2]) / n - mx * mx - my * my, 0.0))
    if n < 5 or not spread:
        return None

    def moment(p: int, q: int) -> float:
        parts = (math.comb(p, i) * math.comb(q, j) * sums[i, j] * (-mx) ** (p - i) * (-my) ** (q - j) for i in range(p + 1) for j in range(q + 1))
        return sum(parts) / spread ** (p + q) / n

    terms = [(2, 0), (1, 1), (0, 2), (1, 0), (0, 1), (0, 0)]
    s = np.array([[moment(a + c, b + d) for c, d in terms] for a, b in terms])
    try:
        linear = -np.linalg.solve(s[3:, 3:], s[3:, :3])
        reduced = s[:3, :3] + s[:3, 3:] @ linear
        _, vectors = np.linalg.eig(np.array([reduced[2] / 2, -reduced[1], reduced[0] / 2]))
    except np.linalg.LinAlgError:
        return None
    vectors = vectors.real
    fits = 4 * vectors[0] * vectors[2] - vectors[1] ** 2
    if not fits.max() > 1e-12:
        return None
    a, b, c = top = vectors[:, fits.argmax()]
    d, e, f = linear @ top
    x, y = np.linalg.solve([[2 * a, b], [b, 2 * c]], [-d, -e])
    values, axes = np.linalg.eigh([[a, b / 2], [b / 2, c]])
    squares = -(f + (d * x + e * y) / 2) / values
    if not (squares > 0).all():
        return None
    k = int(squares.argmax())
    half = np.sqrt(squares) * spread
    return mx + x * spread, my + y * spread, half[k], half[1 - k], math.atan2(axes[1, k], axes[0, k]) % math.pi


def fit_ellipses(solid: DataFrame) -> DataFrame:
    """(z, label, cx, cy, major, minor, angle) of the ellipse fitted to each filled object's outline, half axes; nulls where none fits."""
    sums = outline_sums(solid)
    kinds = {f.name: f.dataType.simpleString() for f in sums.schema}
    names = ["z", "label", "cx", "cy", "major", "minor", "angle"]

    def fit(frames):
        for frame in frames:
            rows = []
            for r in frame.to_dict("records"):
                own = _ellipse({(p, q): r[f"s{p}{q}"] for p, q in POWERS})
                rows.append((r["z"], r["label"], *((own[0] + r["x0"], own[1] + r["y0"], *own[2:]) if own else (None,) * 5)))
            yield pd.DataFrame(rows, columns=names)

    return _dealt(sums).mapInPandas(fit, f"z {kinds['z']}, label {kinds['label']}, " + ", ".join(f"{n} double" for n in names[2:]))


def shape_features(labels: DataFrame) -> DataFrame:
    """(z, label, area, cx, cy, perimeter, compactness, solidity, eccentricity, hu1 ... hu7) of each object's outline.

    Hu moments are sign * log10(|h|), 0 where h is 0.  The eccentricity is that of the ellipse fitted to the outline's pixels,
    or where none fits, that with the outline's second moments.  Objects with an area of 0 have nulls but for area and perimeter.
    """
    solid = checkpointed(filled(labels))
    squares = _squares(solid)
    # A pair of neighbours without more in its square is a side of the outline; a diagonal pair is passed on both sides.
    length = F.when(F.col("n") == 3, math.sqrt(2)).when(F.col("bits").isin(6, 9), 2 * math.sqrt(2)).when(F.col("n") == 2, 1.0).otherwise(0.0)
    first = squares.groupBy("z", "label").agg(
        F.sum(_area()).alias("area"), F.sum(length).alias("perimeter"), F.try_divide(_moment("sx"), 12 * F.sum(_area())).alias("cx"), F.try_divide(_moment("sy"), 12 * F.sum(_area())).alias("cy")
    )
    points = squares.where("n >= 3").join(first.select("z", "label", "cx", "cy"), ["z", "label"]).withColumn("g", F.explode(_nodes()))
    dx, dy, w = F.col("qx") + F.col("g.u") - F.col("cx"), F.col("qy") + F.col("g.v") - F.col("cy"), F.col("g.w")
    powers = [(2, 0), (1, 1), (0, 2), (3, 0), (2, 1), (1, 2), (0, 3)]
    central = points.groupBy("z", "label").agg(*(F.sum(w * dx**p * dy**q).alias(f"m{p}{q}") for p, q in powers))
    lines = solid.groupBy("z", "label", "y").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    listed = _dealt(lines).groupBy("z", "label").agg(F.collect_list(F.struct("y", "a", "b")).alias("lines"))
    hulls = listed.mapInArrow(_hulls, T.StructType([*fields(lines, ["z", "label"]), T.StructField("hull", T.DoubleType())]))
    fitted = fit_ellipses(solid).select("z", "label", (1 - (F.col("minor") / F.col("major")) ** 2).alias("flat"))
    out = first.join(central, ["z", "label"], "left").join(hulls, ["z", "label"]).join(fitted, ["z", "label"], "left")
    n20, n11, n02, n30, n21, n12, n03 = (F.col(f"m{p}{q}") / F.col("area") ** (1 + (p + q) / 2) for p, q in powers)
    a, b, c, d = n30 + n12, n21 + n03, n30 - 3 * n12, 3 * n21 - n03
    hu = [
        n20 + n02, (n20 - n02) ** 2 + 4 * n11**2, c**2 + d**2, a**2 + b**2,
        c * a * (a**2 - 3 * b**2) + d * b * (3 * a**2 - b**2),
        (n20 - n02) * (a**2 - b**2) + 4 * n11 * a * b,
        d * a * (a**2 - 3 * b**2) - c * b * (3 * a**2 - b**2),
    ]
    logged = [F.when(F.abs(h) < 1e-30, h * 0).otherwise(F.signum(h) * F.log10(F.abs(h))).alias(f"hu{i}") for i, h in enumerate(hu, 1)]
    spread = F.sqrt((F.col("m20") - F.col("m02")) ** 2 + 4 * F.col("m11") ** 2)
    short = F.try_divide(F.col("m20") + F.col("m02") - spread, F.col("m20") + F.col("m02") + spread)
    return out.select(
        "z", "label", "area", "cx", "cy", "perimeter", F.try_divide(F.col("perimeter") ** 2, 4 * math.pi * F.col("area")).alias("compactness"),
        F.try_divide("area", "hull").alias("solidity"), F.when(F.col("area") > 0, F.sqrt(F.coalesce("flat", 1 - F.greatest(short, F.lit(0.0))))).alias("eccentricity"), *logged,
    )


def match_blobs(labels: DataFrame) -> DataFrame:
    """(z, src, dst, d): each object's most similar one of the next slice, by the standardised features of their outlines.

    Objects whose outline has no area take no part.
    """
    columns = [*(f"hu{i}" for i in range(1, 8)), "solidity", "eccentricity", "area", "cx", "cy", "perimeter", "compactness"]
    return nearest(zscore(shape_features(labels).where("area > 0"), columns), columns)
