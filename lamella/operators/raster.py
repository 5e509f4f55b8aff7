"""Block means, channel sums, normalisation, histograms, thresholds and filters of pixel tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F


def block_mean(pixels: DataFrame, by_y: int, by_x: int, keys: tuple[str, ...] = ("z",)) -> DataFrame:
    """Mean of by_y x by_x blocks; a ragged edge counts as zero-padded, so the divisor is the whole block's area."""
    blocks = pixels.groupBy(*keys, F.expr(f"y div {by_y}").alias("y"), F.expr(f"x div {by_x}").alias("x"))
    return blocks.agg((F.sum("v") / F.lit(float(by_y * by_x))).alias("v"))


def channel_sum_wide(pixels: DataFrame) -> DataFrame:
    """Sum over channels without a limit."""
    return pixels.groupBy("z", "y", "x").agg(F.sum("v").alias("v"))


def channel_sum_u16(pixels: DataFrame) -> DataFrame:
    """Sum over channels of values truncated toward zero, modulo 65536."""
    return pixels.groupBy("z", "y", "x").agg(F.pmod(F.sum(F.col("v").cast("long")), F.lit(65536)).alias("v"))


def channel_sum_u8(pixels: DataFrame) -> DataFrame:
    """Sum over channels modulo 256."""
    return pixels.groupBy("z", "y", "x").agg(F.sum(F.col("v").cast("long")).bitwiseAND(255).alias("v"))


def minmax_normalize(pixels: DataFrame) -> DataFrame:
    """255 (v - min) / (max - min) of each plane, rounded half to even; a constant plane is 0."""
    plane = pixels.groupBy("z").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    scaled = F.bround((F.col("v") - F.col("low")) * 255.0 / (F.col("high") - F.col("low"))).cast("long")
    return pixels.join(plane, "z").select("z", "y", "x", F.when(F.col("high") > F.col("low"), scaled).otherwise(0).cast("long").alias("v"))


def histogram(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("z", "v").agg(F.count("*").alias("n"))


def multi_otsu(hist: DataFrame, lines: int = 4096) -> DataFrame:
    """(z, t1, t2): the pair of grey values that maximises S1^2/P1 + S2^2/P2 + S3^2/P3 to four decimals; ties to the smallest pair.

    A plane's histogram is one row, bounded by the number of grey values; ``lines`` first thresholds are a task's
    portion, tried against all second ones in small matrices, so that no pair is ever a row.  Planes with fewer than three
    grey values have no pair.
    """
    bars = hist.where("v is not null").groupBy("z").agg(F.array_sort(F.collect_list(F.struct("v", "n"))).alias("bars"))
    starts = F.explode(F.expr(f"sequence(0, greatest(size(bars) - 3, 0), {lines})")).alias("first")
    portions = bars.where("size(bars) > 2").select("z", F.col("bars.v").alias("v"), F.col("bars.n").alias("n"), starts).repartition("z", "first")
    kinds = {f.name: f.dataType.simpleString() for f in hist.schema}

    def search(frames):
        for pdf in frames:
            found = []
            for z, v, n, first in pdf.itertuples(index=False):
                p, s = np.cumsum(n), np.cumsum(np.asarray(n) * v)
                whole, total = p[-1], s[-1]
                best = None
                for at in range(first, min(first + lines, len(v) - 2), 64):
                    i = np.arange(at, min(at + 64, first + lines, len(v) - 2))[:, None]
                    j = np.arange(at + 1, len(v) - 1)[None, :]
                    two, three = s[j] - s[i], total - s[j]
                    with np.errstate(divide="ignore", invalid="ignore"):
                        goal = s[i].astype(float) * s[i] / p[i] + two.astype(float) * two / (p[j] - p[i]) + three.astype(float) * three / (whole - p[j])
                    goal = np.where(j > i, np.floor(goal * 1e4 + 0.5) / 1e4, -np.inf)
                    k, m = divmod(int(goal.argmax()), goal.shape[1])
                    if best is None or goal[k, m] > best[0]:
                        best = (goal[k, m], v[at + k], v[at + 1 + m])
                found.append((z, best[1], best[2], best[0]))
            yield pd.DataFrame(found, columns=["z", "t1", "t2", "goal"])

    tried = portions.mapInPandas(search, f"z {kinds['z']}, t1 {kinds['v']}, t2 {kinds['v']}, goal double")
    best = F.min_by(F.struct("t1", "t2"), F.struct(-F.col("goal"), "t1", "t2")).alias("t")
    return tried.groupBy("z").agg(best).select("z", "t.t1", "t.t2")


def binarize(pixels: DataFrame, threshold: float) -> DataFrame:
    """v = 1 where the value is strictly above the threshold."""
    return pixels.select("z", "y", "x", (F.col("v") > threshold).cast("long").alias("v"))


def half_otsu(pixels: DataFrame) -> DataFrame:
    """(z, t): half of each plane's first Otsu threshold; a plane with fewer than three grey values raises an error when read."""
    hist = histogram(pixels)
    all_ = hist.select("z").distinct().join(multi_otsu(hist), "z", "left")
    none = F.raise_error(F.lit("a plane has fewer than three grey values, so it has no threshold")).cast("double")
    return all_.select("z", F.coalesce(F.col("t1") / 2, none).alias("t"))


def binarize_auto(pixels: DataFrame) -> DataFrame:
    """Threshold of each plane: half its first Otsu threshold; a plane with fewer than three grey values raises an error when read."""
    return pixels.join(F.broadcast(half_otsu(pixels)), "z", "left").select("z", "y", "x", (F.col("v") > F.col("t")).cast("long").alias("v"))


def median_filter(pixels: DataFrame, k: int = 3) -> DataFrame:
    """Exact median of the k x k neighbourhood inside dense planes (the lower one of an even count): lines, then columns of lines."""
    first, last = -(k - 1 - k // 2), k // 2
    across = Window.partitionBy("z", "y").orderBy("x").rangeBetween(first, last)
    down = Window.partitionBy("z", "x").orderBy("y").rangeBetween(first, last)
    lines = pixels.select("z", "y", "x", F.collect_list("v").over(across).alias("w"))
    near = lines.select("z", "y", "x", F.array_sort(F.flatten(F.collect_list("w").over(down))).alias("w"))
    return near.select("z", "y", "x", F.element_at("w", F.expr("cast((size(w) + 1) div 2 as int)")).alias("v"))
