"""The whole way from slides to aligned stacks of tissues, as one plan over pixels."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, functions as F

from ..operators import align, labels as lab, matching as mat, morphology as mor, objects as obj, raster as ras, refine, register as reg, shapes


@dataclass(frozen=True)
class Settings:
    """Options of a run.  ``holes_thresh``, ``scale_factor``, ``connect`` and ``align_upsample_factor`` are accepted without effect; ``keypoints`` is the most of a slice, 0 for all."""

    num_tissue: int = 8
    thresh: int | None = None
    kernel_size: int = 100
    padding: int = 50
    crop_only: bool = False
    optimize: bool = False
    ratio: float = 0.75
    keypoints: int = 0
    holes_thresh: int = 5000
    scale_factor: int = 8
    connect: int = 2
    align_upsample_factor: int = 2


@dataclass(frozen=True)
class Result:
    """``objects`` and ``boxes`` are keyed by (z, idx), ``stacks`` and ``aligned`` by (idx, z, c, y, x); those of a crop-only run have no ``aligned``.

    ``metrics`` (idx, dice, agreement) tells how well the slices of an aligned tissue agree.  A run with ``optimize`` has
    ``trials`` of alignment parameters, best first for each tissue, instead of ``status``, ``aligned`` and ``metrics``.
    ``labels`` (z, idx, y, x) are the pixels of the objects as detected; ``stages`` (stage, rows, seconds) what each step gave
    and took.
    """

    objects: DataFrame
    boxes: DataFrame
    masks: DataFrame
    stacks: DataFrame
    status: DataFrame | None
    aligned: DataFrame | None
    metrics: DataFrame | None = None
    trials: DataFrame | None = None
    labels: DataFrame | None = None
    stages: list[tuple[str, int, float]] = field(default_factory=list)


class Stages:
    """Steps of a run, each checkpointed; their rows are counted while they are written."""

    def __init__(self) -> None:
        self.done: list[tuple[str, int, float]] = []

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        seen, start = Observation(f"{name}-{uuid.uuid4().hex}"), time.monotonic()
        out = lab.checkpointed(df.observe(seen, F.count(F.lit(1)).alias("rows")))
        self.done.append((name, seen.get["rows"], round(time.monotonic() - start, 3)))
        return out


def thresholds(plane: DataFrame, settings: Settings) -> DataFrame:
    """(z, t): the given threshold, or half of each plane's first Otsu threshold; planes without one raise an error when read."""
    if settings.thresh is not None:
        return plane.select("z").distinct().withColumn("t", F.lit(float(settings.thresh)))
    return ras.half_otsu(plane)


def tissue_mask(plane: DataFrame, limits: DataFrame, k: int) -> DataFrame:
    """Dense binary planes of low resolution: what lies above the threshold, smoothed."""
    m = plane.join(limits, "z").select("z", "y", "x", (F.col("v") > F.col("t")).cast("long").alias("v"))
    m = lab.checkpointed(mor.sequence(m, [("closing", k), ("erosion", k), ("dilation", k // 10), ("dilation", k // 10)]))
    m = lab.checkpointed(mor.ellipse_open(m, 3 * k // 10))
    return mor.sequence(m, [("closing", 2 * k), ("dilation", k)])


def detect(mask: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """(objects, labels): the n largest components of each slice with idx, box size and outline centroid, and their pixels (z, idx, y, x).

    Slices with different numbers of objects raise an error.
    """
    found = lab.connected_components(mask.where("v = 1"))
    size = mask.groupBy("z").count().agg(F.max("count")).first()[0]  # planes are dense and of one size
    top = lab.top_components(lab.component_stats(found), n, size)
    kept = lab.checkpointed(found.join(top.select("z", "label"), ["z", "label"], "left_semi"))
    order = lab.u_order(lab.centroids(kept)).select("z", "label", "idx")
    middle = shapes.contour_centroids(kept).select("z", "label", F.col("cx"), F.col("cy"))
    objects = order.join(top, ["z", "label"]).join(middle, ["z", "label"]).select("z", "idx", "label", "area", "w", "h", "cx", "cy")
    objects = lab.checkpointed(objects)
    obj.assert_same_count(objects).collect()  # one row
    return objects, kept.join(objects.select("z", "label", "idx"), ["z", "label"]).select("z", "idx", "y", "x")


def rough_masks(mask: DataFrame, labels: DataFrame, k: int, sx: int, sy: int, height: int, width: int) -> DataFrame:
    """(z, idx, y, x) of each object, eroded and scaled up.

    A window that is all foreground lies in one component, so all objects of a slice are eroded at once.
    """
    own = mask.join(labels, ["z", "y", "x"], "left").select("z", "y", "x", F.col("idx").isNotNull().cast("long").alias("v"))
    left = mor.morphology(own, 2 * k, "erosion").where("v = 1").join(labels, ["z", "y", "x"])
    key = F.struct("z", "idx").alias("z")
    corners = labels.select(key).distinct().select("z", F.lit(height - 1).cast("long").alias("y"), F.lit(width - 1).cast("long").alias("x"), F.lit(0).cast("long").alias("v"))
    up = mor.cubic_upsample(left.select(key, "y", "x", "v").unionByName(corners), sy, sx)
    return up.select("z.z", "z.idx", "y", "x")


def run(pixels: DataFrame, sx: int, sy: int, height: int, width: int, settings: Settings = Settings(), boxed: Callable[[list[tuple]], DataFrame] | None = None) -> Result:
    """Slides (z, c, y, x, v), dense and of height x width pixels, to stacks of their tissues.

    ``sx`` and ``sy`` are the scale factors of detection.  As in the workflow that this repeats, sx divides y
    and sy divides x in the block means.  A tissue's reference slice is the one of its largest box.  Crops are
    masked: pixels outside a tissue's refined mask are 0.  A tissue with a slice that can't be aligned isn't in ``aligned``.
    ``boxed`` reads the pixels of boxes (z, x1, y1, x2, y2), a row for each tissue of each slice, and maybe others; without it
    crops are taken from ``pixels``.
    """
    k, stage = settings.kernel_size, Stages()
    low = stage("read and downsample", ras.channel_sum_u16(ras.block_mean(pixels, sx, sy, ("z", "c"))))
    limits = stage("thresholds", thresholds(low, settings))
    mask = stage("masks", tissue_mask(low, limits, k))
    objects, labels = detect(mask, settings.num_tissue)
    labels = stage("tissues", labels)
    best = obj.biggest_boxes(objects)
    sized = objects.select("z", "idx", "cx", "cy").join(best.select("idx", "w", "h"), "idx")
    boxes = lab.checkpointed(obj.expand_box(sized, sx, sy, settings.padding, width, height).select("z", "idx", "x1", "y1", "x2", "y2"))

    source = pixels if boxed is None else boxed([tuple(r) for r in boxes.select("z", "x1", "y1", "x2", "y2").collect()])
    cells = obj.crop(source.select("z", "y", "x", F.struct("c", "v").alias("v")), boxes)
    crops = stage("crops", cells.select(F.struct("z", "idx").alias("z"), F.col("v.c").alias("c"), "y", "x", F.col("v.v").alias("v")))
    rough = rough_masks(mask, labels, k, sx, sy, -(-height // sx), -(-width // sy))
    under = rough.join(boxes, ["z", "idx"]).where("x >= x1 and x < x2 and y >= y1 and y < y2")
    under = under.select(F.struct("z", "idx").alias("z"), (F.col("y") - F.col("y1")).alias("y"), (F.col("x") - F.col("x1")).alias("x"))
    # Each plane is refined at its own threshold: values move by it, so that one literal serves all.
    shift = ras.channel_sum_wide(crops).join(limits.withColumnRenamed("z", "slice"), F.col("z.z") == F.col("slice"))
    above = shift.select("z", "y", "x", (F.col("v") - F.floor(F.floor("t") / 2)).cast("long").alias("v"))
    masks, _ = refine.refine_mask(above, under, 0, k)
    masks = stage("refined masks", masks)
    masked = crops.join(masks.withColumnRenamed("v", "m"), ["z", "y", "x"]).select("z.z", F.struct("z.idx", "c").alias("idx"), "y", "x", (F.col("v") * F.col("m")).alias("v"))
    stacks = stage("stacks", obj.pad_stack(masked))
    flat = stacks.select("idx.idx", "z", "idx.c", "y", "x", "v")
    masks = masks.select("z.z", "z.idx", "y", "x", "v")
    if settings.crop_only:
        return Result(objects, boxes, masks, flat, None, None, labels=labels, stages=stage.done)

    summed = ras.minmax_normalize(ras.channel_sum_u16(flat.select(F.struct("idx", "z").alias("z"), "y", "x", "v")))
    planes = lab.checkpointed(summed.select("z.idx", "z.z", "y", "x", "v"))
    size = planes.agg(F.max("y"), F.max("x")).first()
    high, wide = (size[0] or 0) + 1, (size[1] or 0) + 1
    reference = best.select("idx", "z")
    if settings.optimize:
        trials = reg.study(reference, align.scorer(planes, reference, high, wide, 0))
        return Result(objects, boxes, masks, flat, None, None, trials=stage("trials", trials), labels=labels, stages=stage.done)
    _, status = align.align_stack(planes, reference, high, wide, settings.ratio, settings.keypoints)
    lost = status.where("status = 'failed'").select("idx").distinct()
    channels = stacks.select("idx").distinct().select(F.col("idx.idx").alias("tissue"), F.col("idx").alias("key"))
    maps = status.join(lost, "idx", "left_anti").join(channels, F.col("idx") == F.col("tissue")).select(F.col("key").alias("idx"), "z", "h")
    moved = align.warp_each(stacks, maps, high, wide).select("idx.idx", "z", "idx.c", "y", "x", "v")
    still = flat.join(reference, ["idx", "z"], "left_semi").join(lost, "idx", "left_anti").select("idx", "z", "c", "y", "x", F.col("v").cast("double").alias("v"))
    aligned = stage("aligned stacks", moved.unionByName(still))
    return Result(objects, boxes, masks, flat, status, aligned, mat.stack_metrics(aligned), labels=labels, stages=stage.done)
