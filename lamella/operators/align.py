"""Alignment of a tissue's slices to a reference slice: keypoints, matches, homographies and warps, tissue by tissue."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from . import tiles
from .labels import checkpointed, shuffled, written
from .matching import clear_matches, knn_ratio
from .register import find_homographies, homography
from .scalespace import DETECTORS, Detector, octaves_of, scale_space, small_planes, whole_plane
from .tiles import PLACE, fields, repeated, to_blocks


#: RANSAC draws of a trial's slice: many trials have no good model to find.
TRIAL_DRAWS = 2000


def _strongest(points: DataFrame, keys: list[str]) -> DataFrame:
    """Keypoints counted as kp from the strongest of each plane, ties in reading order."""
    order = Window.partitionBy(*keys).orderBy(F.desc("gain"), "y", "x", "size", "angle")
    return points.withColumn("kp", F.row_number().over(order).cast("long"))


def keypoints(planes: DataFrame, most: int = 0, detector: Detector = Detector()) -> DataFrame:
    """(idx, z, kp, y, x, size, angle, gain, descriptor) of planes (idx, z, y, x, v) of 0 to 255 in scale space.

    The ``most`` strongest of each plane stay (0: all); kp counts them from the strongest.
    """
    one = planes.sparkSession.createDataFrame([(0, detector.sigma, detector.layers, detector.contrast, detector.edge, most)], DETECTORS)
    found = _strongest(scale_space(planes, ["idx", "z"], one), ["idx", "z"])
    found = found.where(F.col("kp") <= most) if most else found
    return found.select("idx", "z", "kp", "y", "x", "size", "angle", "gain", "descriptor")


def match_to_reference(points: DataFrame, reference: DataFrame, ratio: float | Column = 0.75) -> DataFrame:
    """(idx, z, sx, sy, dx, dy): keypoints of the reference slice (idx, z) and their clearly nearest ones in each other slice.

    A column as ``ratio`` may read g.idx and g.z.
    """
    ref = points.join(reference.select("idx", "z"), ["idx", "z"], "left_semi").select("idx", F.col("kp").alias("id"), F.col("descriptor").alias("a"), F.col("x").alias("dx"), F.col("y").alias("dy"))
    rest = points.join(reference.select("idx", "z"), ["idx", "z"], "left_anti")
    rest = rest.select("idx", F.struct("idx", "z").alias("g"), F.col("kp").alias("near"), F.col("descriptor").alias("b"), F.col("x").alias("sx"), F.col("y").alias("sy"))
    asked = rest.select("idx", "g").distinct().join(shuffled(ref), "idx")
    pairs = knn_ratio(asked.select("g", "id", "a"), rest.select("g", "near", "b"), ratio)
    out = pairs.join(shuffled(asked.select("g", "id", "dx", "dy")), ["g", "id"]).join(shuffled(rest.select("g", "near", "sx", "sy")), ["g", "near"])
    return out.select("g.idx", "g.z", *(F.col(c).cast("double").alias(c) for c in ("sx", "sy", "dx", "dy")))


def warp_each(pixels: DataFrame, homographies: DataFrame, height: int, width: int) -> DataFrame:
    """Planes (idx, z, y, x, v) seen through their own homography (idx, z, h): inverse map, bilinear taps, zero outside."""
    a, b, c, d, e, f, g, h, i = (F.col("h")[k] for k in range(9))
    inverse = F.array(e * i - f * h, c * h - b * i, b * f - c * e, f * g - d * i, a * i - c * g, c * d - a * f, d * h - e * g, b * g - a * h, a * e - b * d)
    maps = homographies.where("h is not null").select("idx", "z", inverse.alias("m"))
    lines = maps.withColumn("ty", F.explode(F.sequence(F.lit(0), F.lit(height - 1)))).repartition("idx", "z", "ty")
    grid = lines.withColumn("tx", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    m = [F.col("m")[k] for k in range(9)]
    w = m[6] * F.col("tx") + m[7] * F.col("ty") + m[8]
    at = grid.select("idx", "z", "ty", "tx", *(F.round(F.try_divide(m[k] * F.col("tx") + m[k + 1] * F.col("ty") + m[k + 2], w), 9).alias(n) for k, n in ((0, "sx"), (3, "sy"))))
    corners = F.explode(F.array(*(F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p in (0, 1) for q in (0, 1))))
    part = lambda s, t: 1 - F.abs(F.col(s) - F.floor(s) - F.col(t))
    taps = at.withColumn("t", corners).select("idx", "z", "ty", "tx", (F.floor("sy") + F.col("t.p")).alias("y"), (F.floor("sx") + F.col("t.q")).alias("x"), (part("sy", "t.p") * part("sx", "t.q")).alias("c"))
    seen = shuffled(pixels).join(taps.where("c > 0"), ["idx", "z", "y", "x"]).groupBy("idx", "z", "ty", "tx").agg(F.round(F.sum(F.col("v") * F.col("c")), 6).alias("v"))
    return seen.select("idx", "z", F.col("ty").cast("long").alias("y"), F.col("tx").cast("long").alias("x"), "v")


def align_stack(stack: DataFrame, reference: DataFrame, height: int, width: int, ratio: float = 0.75, most: int = 0, detector: Detector = Detector()) -> tuple[DataFrame, DataFrame]:
    """(aligned pixels, status) of dense planes (idx, z, y, x, v); ``reference`` holds each tissue's reference slice (idx, z).

    The status (idx, z, h, inliers, status) has a row for each other slice.  A slice that can't be aligned fails its
    whole tissue: it has status rows, but no pixels.  The reference slice is copied as it is.
    """
    matches = match_to_reference(checkpointed(keypoints(stack, most, detector)), reference, ratio)
    found = find_homographies(matches, ["idx", "z"])
    others = stack.select("idx", "z").distinct().join(reference.select("idx", "z"), ["idx", "z"], "left_anti")
    status = checkpointed(others.join(found, ["idx", "z"], "left").withColumns({"inliers": F.coalesce("inliers", F.lit(0)), "status": F.coalesce("status", F.lit("failed"))}))
    lost = status.where("status = 'failed'").select("idx").distinct()
    moved = warp_each(stack, status.join(lost, "idx", "left_anti"), height, width)
    same = stack.join(reference.select("idx", "z"), ["idx", "z"], "left_semi").join(lost, "idx", "left_anti")
    return moved.unionByName(same.select("idx", "z", "y", "x", F.col("v").cast("double").alias("v"))), status


def trial_scores(stack: DataFrame, reference: DataFrame, trials: DataFrame, height: int, width: int, cut: float) -> DataFrame:
    """(number, idx, value, unaligned) of each trial and tissue: the mean Dice of its other slices with the reference slice, pixels above ``cut``.

    Each trial aligns with its own n_features (most keypoints of a slice, 0: all), sigma, n_octave_layers, contrast_threshold
    and edge_threshold of the detector and its ratio_threshold.  ``value`` scores the aligned slices, ``unaligned`` the
    slices as they were.  A trial with a slice that can't be aligned has 0 in both.  Trials with a column ``idx`` are tried on
    that tissue only.
    """
    return scorer(stack, reference, height, width, cut)(trials)


def scorer(stack: DataFrame, reference: DataFrame, height: int, width: int, cut: float) -> Callable[[DataFrame], DataFrame]:
    """:func:`trial_scores` of one stack's trials, for more than one round of them.

    A slice and its reference slice that lie, doubled, in a tile each are tried in one task, so that keypoints, matches and warped
    pixels, many times the size of the planes, aren't stored.  Tissues with larger slices exchange strips, keypoints and pixels.
    """
    sizes = checkpointed(stack.groupBy("idx", "z").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w")))
    least, side = sizes.agg(F.min(F.least("h", "w")), F.max(F.greatest("h", "w"))).first()
    octaves, limit = octaves_of(least), tiles.SIDE // 2
    if (side or 0) <= limit:
        pairs = _pairs(stack, reference)
        return lambda trials: _scores_of_pairs(pairs, trials, height, width, cut, octaves)
    large = checkpointed(sizes.groupBy("idx").agg(F.max(F.greatest("h", "w")).alias("side")).where(F.col("side") > limit).select("idx"))
    pairs = _pairs(stack.join(large, "idx", "left_anti"), reference)
    rest, of_rest = stack.join(large, "idx", "left_semi"), reference.join(large, "idx", "left_semi")
    return lambda trials: _scores_of_pairs(pairs, trials, height, width, cut, octaves).unionByName(_scores_by_exchange(rest, of_rest, trials, height, width, cut, octaves))


def _pairs(stack: DataFrame, reference: DataFrame) -> DataFrame:
    """(idx, z, own, ref): each other slice's block and its reference slice's, missing pixels being NaN."""
    block = F.struct(*PLACE, "data")
    blocks = written(to_blocks(stack, ["idx", "z"], "f8", np.nan))
    ref = blocks.join(F.broadcast(reference.select("idx", "z")), ["idx", "z"], "left_semi").select("idx", block.alias("ref"))
    others = blocks.join(F.broadcast(reference.select("idx", "z")), ["idx", "z"], "left_anti").select("idx", "z", block.alias("own"))
    return written(others.join(shuffled(ref), "idx", "left"))


def _warped(plane: np.ndarray, h: list[float], height: int, width: int) -> np.ndarray:
    """:func:`warp_each` of one plane; NaN where it has no row."""
    a, b, c, d, e, f, g, h, i = h
    m = (e * i - f * h, c * h - b * i, b * f - c * e, f * g - d * i, a * i - c * g, c * d - a * f, d * h - e * g, b * g - a * h, a * e - b * d)
    ty, tx = np.mgrid[:height, :width]
    with np.errstate(all="ignore"):
        w = m[6] * tx + m[7] * ty + m[8]
        sx, sy = (np.round((m[k] * tx + m[k + 1] * ty + m[k + 2]) / w, 9) for k in (0, 3))
    inside = (sx > -1) & (sy > -1) & (sx < plane.shape[1]) & (sy < plane.shape[0])
    sx, sy = sx[inside], sy[inside]
    wide = np.pad(plane, 1, constant_values=np.nan)
    y, x = np.floor(sy).astype(np.int64), np.floor(sx).astype(np.int64)
    v, some = np.zeros(len(y)), np.zeros(len(y), bool)
    for p in (0, 1):
        for q in (0, 1):
            share, pixel = (1 - np.abs(sy - y - p)) * (1 - np.abs(sx - x - q)), wide[y + p + 1, x + q + 1]
            hit = (share > 0) & ~np.isnan(pixel)
            v += np.where(hit, share * np.where(hit, pixel, 0), 0)
            some |= hit
    out = np.full((height, width), np.nan)
    out[inside] = np.where(some, np.copysign(np.floor(np.abs(v) * 1e6 + 0.5) / 1e6, v), np.nan)
    return out


def _dice(above: np.ndarray, still: np.ndarray) -> float | None:
    high, wide = (min(n) for n in zip(above.shape, still.shape, strict=True))
    sizes = int(above.sum()) + int(still.sum())
    return 2.0 * int((above[:high, :wide] & still[:high, :wide]).sum()) / sizes if sizes else None


def _aligned(plane: np.ndarray, ref: np.ndarray, trial: dict, octaves: int) -> list[float] | None:
    """The homography that a trial finds from a plane to its reference slice."""
    most = int(trial["n_features"])
    detector = Detector(trial["sigma"], int(trial["n_octave_layers"]), trial["contrast_threshold"], trial["edge_threshold"], most)
    both = [np.nan_to_num(a) for a in (ref, plane)]
    if ref.shape == plane.shape:
        points = small_planes(np.stack(both), detector, octaves)
    else:
        points = [small_planes(a[None], detector, octaves)[0] for a in both]
    if not all(len(rows) for rows, _ in points):
        return None
    (to, a), (at, b) = ((rows[:, 1::-1], v) for rows, v in points)
    who, near = clear_matches(a, b, trial["ratio_threshold"])
    return homography(at[near], to[who], rounds=TRIAL_DRAWS)[0]


def _scores_of_pairs(pairs: DataFrame, trials: DataFrame, height: int, width: int, cut: float, octaves: int) -> DataFrame:
    """:func:`trial_scores` of slices that lie, doubled, in one tile: a task tries a list of trials on a slice and its reference slice."""
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lots = max(1, parts // max(1, pairs.count()))  # few pairs have their trials dealt out
    own = F.struct("number", "n_features", "contrast_threshold", "edge_threshold", "sigma", "n_octave_layers", "ratio_threshold")
    on = [c for c in ("idx",) if c in trials.columns]
    lists = trials.groupBy(*on, F.pmod("number", F.lit(lots)).alias("lot")).agg(F.collect_list(own).alias("trials"))
    # Few bytes, much work: a number of partitions keeps pairs from being coalesced by their size.
    dealt = (pairs.join(shuffled(lists), on) if on else pairs.crossJoin(F.broadcast(lists))).repartition(parts, "idx", "z", "lot")
    schema = T.StructType([*fields(pairs, ["idx", "z"]), T.StructField("number", T.LongType()), T.StructField("found", T.BooleanType()), *(T.StructField(c, T.DoubleType()) for c in ("value", "unaligned"))])

    def plane(row: pa.RecordBatch, name: str) -> np.ndarray | None:
        block = row.column(name)[0].as_py()
        return block and whole_plane(*(block[c] for c in PLACE), np.frombuffer(block["data"], "f8"), np.nan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                moving, ref, asked = plane(row, "own"), plane(row, "ref"), row.column("trials")[0].as_py()
                still = np.zeros((0, 0), bool) if ref is None else ref > cut
                before, rows = _dice(moving > cut, still), []
                for trial in asked:
                    h = None if ref is None else _aligned(moving, ref, trial, octaves)
                    rows.append((trial["number"], h is not None, None if h is None else _dice(_warped(moving, h, height, width) > cut, still), before))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.bool_(), pa.float64(), pa.float64()), strict=True)]
                yield pa.RecordBatch.from_arrays([*repeated(row, ["idx", "z"], len(rows)).values(), *columns], names=[f.name for f in schema])

    return _means(dealt.mapInArrow(run, schema))


def _means(each: DataFrame) -> DataFrame:
    """(number, idx, value, unaligned) from a row for each slice, trial and tissue."""
    whole = F.count_if("found") == F.count("*")
    means = (F.round(F.when(whole, F.avg(c)).otherwise(0.0), 6).alias(c) for c in ("value", "unaligned"))
    return each.groupBy("number", "idx").agg(*means)


def _scores_by_exchange(stack: DataFrame, reference: DataFrame, trials: DataFrame, height: int, width: int, cut: float, octaves: int) -> DataFrame:
    """:func:`trial_scores` of planes of any size."""
    by = [c for c in ("number", "idx") if c in trials.columns]
    trials = checkpointed(trials.select(*by, "n_features", "contrast_threshold", "edge_threshold", "sigma", "n_octave_layers", "ratio_threshold"))
    detectors = trials.select(*by, "sigma", F.col("n_octave_layers").cast("int").alias("layers"), F.col("contrast_threshold").alias("contrast"), F.col("edge_threshold").alias("edge"), F.col("n_features").cast("int").alias("most"))
    points = _strongest(scale_space(stack, ["idx", "z"], detectors, octaves), ["number", "idx", "z"])
    key = F.struct("number", "ratio_threshold", "idx").alias("idx")
    strong = (F.col("n_features") == 0) | (F.col("kp") <= F.col("n_features"))
    asked = F.broadcast(trials)
    of_trials = lambda df: df.join(asked, "idx") if "idx" in by else df.crossJoin(asked)
    own = checkpointed(points.join(asked, by).where(strong).select(key, "z", "kp", "y", "x", "descriptor"))
    matches = match_to_reference(own, of_trials(reference.select("idx", "z")).select(key, "z"), F.col("g.idx.ratio_threshold"))
    found = find_homographies(matches.select("idx.number", "idx.idx", "z", "sx", "sy", "dx", "dy"), ["number", "idx", "z"], rounds=TRIAL_DRAWS)
    others = stack.select("idx", "z").distinct().join(reference.select("idx", "z"), ["idx", "z"], "left_anti")
    maps = checkpointed(of_trials(others).select("number", "idx", "z").join(found.select("number", "idx", "z", "h"), ["number", "idx", "z"], "left"))

    keyed = maps.where("h is not null").select(F.struct("number", "idx").alias("idx"), "z", "h")
    planes = shuffled(stack).join(maps.where("h is not null").select("number", "idx", "z"), ["idx", "z"]).select(F.struct("number", "idx").alias("idx"), "z", "y", "x", "v")
    moved = warp_each(planes, keyed, height, width).where(F.col("v") > cut).select("idx.number", "idx.idx", "z", "y", "x")
    above = stack.where(F.col("v") > cut).select("idx", "z", "y", "x")
    still = above.join(reference.select("idx", "z"), ["idx", "z"], "left_semi").select("idx", "y", "x", F.lit(1).alias("r"))
    area = still.groupBy("idx").agg(F.count("*").alias("a"))

    def dice(pixels: DataFrame, keys: list[str], of: DataFrame, name: str) -> DataFrame:
        sums = pixels.join(shuffled(still), ["idx", "y", "x"], "left").groupBy(*keys).agg(F.count("*").alias("b"), F.count("r").alias("both"))
        sums = of.join(sums, keys, "left").join(area, "idx", "left").na.fill(0, ["a", "b", "both"])
        return sums.select(*keys, F.try_divide(2.0 * F.col("both"), F.col("a") + F.col("b")).alias(name))

    aligned = dice(moved, ["number", "idx", "z"], maps.where("h is not null").select("number", "idx", "z"), "value")
    before = dice(above.join(others, ["idx", "z"], "left_semi"), ["idx", "z"], others, "unaligned")
    each = maps.join(aligned, ["number", "idx", "z"], "left").join(before, ["idx", "z"])
    return _means(each.withColumn("found", F.col("h").isNotNull()))
