"""Registration: homographies from matched points, warps, and a search over parameters."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .labels import checkpointed


def _fit(src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """Homography of least squares after normalising both point sets."""

    def norm(p):
        c, s = p.mean(axis=0), np.sqrt(2) / max(np.sqrt(((p - p.mean(axis=0)) ** 2).sum(axis=1)).mean(), 1e-12)
        return np.array([[s, 0, -s * c[0]], [0, s, -s * c[1]], [0, 0, 1]])

    a, b = norm(src), norm(dst)
    p, q = (np.column_stack([v, np.ones(len(v))]) @ m.T for v, m in ((src, a), (dst, b)))
    rows = np.zeros((len(p), 2, 9))
    for k in (0, 1):  # (-x, -y, -1, 0, 0, 0, ux, uy, u) and (0, 0, 0, -x, -y, -1, vx, vy, v)
        rows[:, k, 3 * k : 3 * k + 3], rows[:, k, 6:] = -p, q[:, k, None] * p
    # The small triangle has the same right singular vectors as the tall matrix.
    h = np.linalg.inv(b) @ np.linalg.svd(np.linalg.qr(rows.reshape(-1, 9), mode="r"))[2][-1].reshape(3, 3) @ a
    return h / h[2, 2]


def _basis(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maps from the projective frame to quadruples of points (draws, 4, 2), and which of them have no three points on a line."""
    x, y = p[:, :, 0], p[:, :, 1]
    area = lambda i, j, k: (x[:, j] - x[:, i]) * (y[:, k] - y[:, i]) - (x[:, k] - x[:, i]) * (y[:, j] - y[:, i])
    c = np.stack([area(3, 1, 2), area(0, 3, 2), area(0, 1, 3)], axis=1)
    q = np.stack([x[:, :3], y[:, :3], np.ones_like(c)], axis=1)
    return q * c[:, None, :], (np.abs(np.column_stack([c, area(0, 1, 2)])) > 1e-9).all(axis=1)


def _cross(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    (a0, a1, a2), (b0, b1, b2) = a.T, b.T
    return np.stack([a1 * b2 - a2 * b1, a2 * b0 - a0 * b2, a0 * b1 - a1 * b0], axis=1)


def _consensus(src: np.ndarray, dst: np.ndarray, limit: float, rounds: int, confidence: float, seed: int = 0) -> np.ndarray:
    """Inliers of the best homography through four matches.

    Draws go on until, at the share of inliers found so far, all-inlier draws have come with the confidence, or ``rounds`` are over.
    """
    n, best, done = len(src), np.zeros(len(src), bool), 0
    middle, rng = src.mean(axis=0), np.random.default_rng(seed)
    p, q = np.column_stack([src - middle, np.ones(n)]), dst - dst.mean(axis=0)
    step = max(1, min(256, (1 << 21) // n))
    tries, needed = 0, float(rounds)
    while done < needed and tries < 20 * rounds:
        pick = rng.integers(0, n, (step, 4))
        tries += step
        pick = pick[(np.diff(np.sort(pick, axis=1), axis=1) > 0).all(axis=1)]
        done += len(pick)
        (a, whole), (b, sound) = _basis(p[pick, :2]), _basis(q[pick])
        a, b = a[whole & sound], b[whole & sound]
        if not len(a):
            continue
        adjugate = np.stack([_cross(a[:, :, i], a[:, :, j]) for i, j in ((1, 2), (2, 0), (0, 1))], axis=1)
        top, models, lot = best, b @ adjugate, max(1, (1 << 14) // n)
        for i in range(0, len(models), lot):
            # Lines of the models' three sums for all points; a point's distance is compared times its third sum.
            at = (models[i : i + lot].reshape(-1, 3) @ p.T).reshape(-1, 3, n)
            with np.errstate(all="ignore"):
                off = at[:, :2] - at[:, 2:] * q.T
                off *= off
                square = at[:, 2] ** 2
                own = (off[:, 0] + off[:, 1] <= limit**2 * square) & (square > 0)
            sizes = np.count_nonzero(own, axis=1)
            if sizes.max() > top.sum():
                top = own[np.argmax(sizes)]
            if top.all():  # no later draw has more
                break
        if top.sum() > best.sum():
            best = top
            share = min((best.sum() / n) ** 4, 1 - 1e-12)
            needed = min(float(rounds), np.log(1 - confidence) / np.log1p(-share))
    return best


def homography(src: np.ndarray, dst: np.ndarray, limit: float = 5.0, rounds: int = 100_000, confidence: float = 0.995) -> tuple[list[float] | None, int]:
    """(h, inliers) of matched points in any order; h is None with fewer than four inliers."""
    order = np.lexsort((dst[:, 1], dst[:, 0], src[:, 1], src[:, 0]))
    src, dst = src[order], dst[order]
    best = _consensus(src, dst, limit, rounds, confidence) if len(src) >= 4 else np.zeros(len(src), bool)
    return _fit(src[best], dst[best]).ravel().tolist() if best.sum() >= 4 else None, int(best.sum())


def find_homographies(matches: DataFrame, keys: list[str], limit: float = 5.0, rounds: int = 100_000, confidence: float = 0.995) -> DataFrame:
    """(keys, h, inliers, status) from matches (keys, sx, sy, dx, dy): seeded RANSAC for each group of keypoint matches.

    Draws stop once the confidence for the observed share of inliers is reached, at ``rounds`` at the latest.
    Fewer than four matches, or no model with four inliers, give a null ``h`` and the status 'failed'.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        h, inliers = homography(pdf[["sx", "sy"]].to_numpy(float), pdf[["dx", "dy"]].to_numpy(float), limit, rounds, confidence)
        out = pdf[keys].iloc[:1].copy()
        out["h"], out["inliers"], out["status"] = [h], inliers, "failed" if h is None else "aligned"
        return out

    types = {f.name: f.dataType.simpleString() for f in matches.schema}
    # Few bytes, much work: a number of partitions keeps them from being coalesced by their size.
    dealt = matches.repartition(int(matches.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    return dealt.groupBy(*keys).applyInPandas(run, ", ".join(f"{k} {types[k]}" for k in keys) + ", h array<double>, inliers long, status string")


def warp(pixels: DataFrame, h: list[float], height: int, width: int) -> DataFrame:
    """Planes seen through the homography ``h`` (source to target): inverse map, four bilinear taps, zero outside."""
    i = np.linalg.inv(np.array(h, float).reshape(3, 3)).ravel().tolist()
    spark: SparkSession = pixels.sparkSession
    grid = spark.range(height * width).select(F.expr(f"id div {width}").alias("ty"), (F.col("id") % width).alias("tx"))
    w = i[6] * F.col("tx") + i[7] * F.col("ty") + i[8]
    at = grid.select("ty", "tx", F.round((i[0] * F.col("tx") + i[1] * F.col("ty") + i[2]) / w, 9).alias("sx"), F.round((i[3] * F.col("tx") + i[4] * F.col("ty") + i[5]) / w, 9).alias("sy"))
    corners = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1))))
    taps = at.withColumn("t", corners).select("ty", "tx", (F.floor("sy") + F.col("t.a")).alias("y"), (F.floor("sx") + F.col("t.b")).alias("x"), ((1 - F.abs(F.col("sy") - F.floor("sy") - F.col("t.a"))) * (1 - F.abs(F.col("sx") - F.floor("sx") - F.col("t.b")))).alias("c"))
    seen = pixels.join(taps.where("c > 0"), ["y", "x"]).groupBy("z", "ty", "tx").agg(F.round(F.sum(F.col("v") * F.col("c")), 6).alias("v"))
    return seen.select("z", F.col("ty").alias("y"), F.col("tx").alias("x"), "v")


#: Fixed values of the search: each parameter's lowest and highest value, and whether it is a whole number.
SPACE = {
    "n_features": (0, 1000, True), "contrast_threshold": (0.01, 0.1, False), "edge_threshold": (2.0, 15.0, False), "sigma": (0.0, 2.0, False),
    "n_octave_layers": (1, 10, True), "ratio_threshold": (0.5, 0.9, False), "flann_checks": (100, 500, True), "flann_trees": (5, 50, True),
}


def _drawn(space: dict, rng: np.random.Generator) -> dict:
    return {k: int(rng.integers(low, high + 1)) if whole else float(rng.uniform(low, high)) for k, (low, high, whole) in space.items()}


def propose(told: list[tuple[dict, float]], n: int, seed: int, space: dict = SPACE, startup: int = 10, candidates: int = 24, share: float = 0.2) -> list[dict]:
    """n parameter sets to try next, a larger value being better: a tree-structured Parzen estimator, seeded.

    The ``startup`` first trials are drawn at random.  After that, each parameter has one density over the best
    ``share`` of what was tried and one over the rest, both mixtures of normal distributions about the tried values, as wide as the
    gaps between them, and of the whole range; of some draws from the first one the one of the largest ratio is
    taken.  Trials of one round don't know of each other; only their draws differ.
    """
    rngs = [np.random.default_rng([seed, len(told) + i]) for i in range(n)]
    if len(told) < startup:
        return [_drawn(space, rng) for rng in rngs]
    ranked = sorted(range(len(told)), key=lambda j: (-told[j][1], j))
    cut = math.ceil(share * len(told))
    parts = {}
    for name, (low, high, whole) in space.items():
        ends = (low - 0.5, high + 0.5) if whole else (low, high)
        parts[name] = *ends, *(_kernels(np.array([told[j][0][name] for j in part], float), *ends) for part in (ranked[:cut], ranked[cut:]))
    out = []
    for rng in rngs:
        own = {}
        for name, (low, high, whole) in space.items():
            a, b, good, bad = parts[name]
            x = _mixture_draws(good, a, b, candidates, rng)
            pick = x[np.argmax(_mixture_density(x, good) - _mixture_density(x, bad))]
            own[name] = int(min(max(round(pick), low), high)) if whole else float(min(max(pick, low), high))
        out.append(own)
    return out


def _kernels(points: np.ndarray, low: float, high: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Middles, widths and shares inside the range of the normal distributions: about each point, as wide as its larger gap, and about the middle of the range."""
    order = np.sort(np.append(points, (low + high) / 2))
    gaps = np.diff(np.concatenate([[low], order, [high]]))
    width = np.clip(np.maximum(gaps[:-1], gaps[1:]), (high - low) / min(100.0, 1.0 + len(order)), high - low)
    width[np.searchsorted(order, (low + high) / 2)] = high - low
    inside = np.array([(math.erf((high - m) / w / math.sqrt(2)) - math.erf((low - m) / w / math.sqrt(2))) / 2 for m, w in zip(order, width, strict=True)])
    return order, width, inside


def _mixture_draws(kernels: tuple[np.ndarray, np.ndarray, np.ndarray], low: float, high: float, n: int, rng: np.random.Generator) -> np.ndarray:
    middle, width, _ = kernels
    which = rng.integers(0, len(middle), n)
    x = rng.normal(middle[which], width[which])
    for _ in range(20):  # draws outside the range are drawn again
        bad = (x < low) | (x > high)
        if not bad.any():
            break
        x[bad] = rng.normal(middle[which[bad]], width[which[bad]])
    return np.clip(x, low, high)


def _mixture_density(x: np.ndarray, kernels: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Logarithm of the mixture's density, each part cut off at the ends of the range."""
    middle, width, inside = kernels
    part = np.exp(-0.5 * ((x[:, None] - middle) / width) ** 2) / (width * np.sqrt(2 * np.pi) * np.maximum(inside, 1e-12))
    return np.log(part.mean(axis=1) + 1e-300)


PARAMETERS = ", ".join(f"{k} {'long' if whole else 'double'}" for k, (_, _, whole) in SPACE.items())


def trial_parameters(spark: SparkSession, trials: int = 25, seed: int = 0) -> DataFrame:
    """Random parameters of a registration search, one row for each trial."""
    rows = [(i, *_drawn(SPACE, np.random.default_rng([seed, i])).values()) for i in range(trials)]
    return spark.createDataFrame(rows, "number long, " + PARAMETERS)


def study(tissues: DataFrame, score: Callable[[DataFrame], DataFrame], trials: int = 25, startup: int = 9, batch: int = 8, seed: int = 0) -> DataFrame:
    """(idx, number, value, further columns of the scores, params): a search for each tissue (idx), best trial first.

    ``score`` gives (number, idx, value, ...) of trials (idx, number, parameters).  The first ``startup`` trials are one round of
    random draws, the others come in rounds of ``batch`` from :func:`propose`, which reads what that tissue's trials have scored.
    A task proposes for one tissue after the other; trials and scores stay tables.
    """
    names, kind = list(SPACE), tissues.schema["idx"].dataType.simpleString()
    columns = f"idx {kind}, number long, {PARAMETERS}"
    told = checkpointed(tissues.select("idx").distinct().withColumn("told", F.expr(f"cast(array() as array<struct<number: bigint, value: double, {', '.join(f'{k}: {t}' for k, t in (p.split() for p in PARAMETERS.split(', ')))}>>)")))
    if told.isEmpty():
        return tissues.sparkSession.createDataFrame([], columns).select("idx", "number", F.lit(0.0).alias("value"), F.struct(*names).alias("params"))
    asked, scores, first = [], [], 0

    def proposed(first: int, n: int) -> Callable:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                rows = []
                for idx, own in zip(frame["idx"], frame["told"], strict=True):
                    known = [({k: r[k] for k in names}, r["value"]) for r in sorted(own, key=lambda r: r["number"])]
                    rows += [(idx, first + i, *p.values()) for i, p in enumerate(propose(known, n, seed, startup=startup))]
                yield pd.DataFrame(rows, columns=["idx", "number", *names])

        return run

    parts = int(tissues.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while first < trials:
        n = min(startup if not first else batch, trials - first)
        asked.append(checkpointed(told.repartition(parts, "idx").mapInPandas(proposed(first, n), columns)))
        scores.append(checkpointed(score(asked[-1])))
        got = asked[-1].join(scores[-1].select("idx", "number", "value"), ["idx", "number"], "left").na.fill(0.0, ["value"])
        more = got.groupBy("idx").agg(F.collect_list(F.struct("number", "value", *names)).alias("more"))
        told = checkpointed(told.join(more, "idx").select("idx", F.concat("told", "more").alias("told")))
        first += n
    return search(reduce(DataFrame.unionByName, asked), reduce(DataFrame.unionByName, scores))


def search(trials: DataFrame, scores: DataFrame) -> DataFrame:
    """Trials with the value of (number, value), best first; failures are 0.

    Further columns of ``scores`` stay; with a tissue ``idx`` among them, each tissue's trials are ordered.  Trials may be those
    of a tissue, by ``idx``, too.
    """
    params = [c for c in trials.columns if c not in ("number", "idx")]
    on = [c for c in ("number", "idx") if c in trials.columns]
    out = trials.withColumn("params", F.struct(*params)).select(*on, "params").join(scores, on, "left").withColumn("value", F.coalesce("value", F.lit(0.0)))
    more = [c for c in scores.columns if c not in ("number", "value", "idx")]
    tissue = [c for c in scores.columns if c == "idx"]
    return out.select(*tissue, "number", "value", *more, "params").orderBy(*tissue, F.desc("value"), "number")
