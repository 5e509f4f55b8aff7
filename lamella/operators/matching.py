"""Matching of objects between slices, of features and of keypoints, and agreement of masks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .labels import checkpointed

#: Rows of a block of queries or of descriptors, and distances of a block that are held at once.
BLOCK, LOT = 1024, 1 << 17


def next_slice(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rows of slice z + 1 under z, renamed."""
    return df.select((F.col("z") - 1).alias("z"), *(F.col(k).alias(v) for k, v in names.items()))


def overlaps(labels: DataFrame) -> DataFrame:
    """(z, src, dst, n): pixels that a label of slice z shares with one of slice z + 1."""
    other = next_slice(labels, {"y": "y", "x": "x", "label": "dst"})
    return labels.withColumnRenamed("label", "src").join(other, ["z", "y", "x"]).groupBy("z", "src", "dst").agg(F.count("*").alias("n"))


def overlap_match(counts: DataFrame) -> DataFrame:
    """Each label's partner by overlap, the lowest on ties."""
    best = F.row_number().over(Window.partitionBy("z", "src").orderBy(F.desc("n"), "dst"))
    return counts.withColumn("r", best).where("r = 1").drop("r")


def point_lookup(points: DataFrame, labels: DataFrame) -> DataFrame:
    """Label at each point's truncated coordinates, null on the background."""
    at = points.withColumns({"x": F.col("cx").cast("long"), "y": F.col("cy").cast("long")})
    return at.join(labels.select("z", "y", "x", F.col("label").alias("found")), ["z", "y", "x"], "left").select("z", "label", "found")


def relabel(labels: DataFrame, mapping: DataFrame) -> DataFrame:
    """Labels by a map (z, label, new); unmapped ones become 0."""
    return labels.join(mapping, ["z", "label"], "left").select("z", "y", "x", F.coalesce("new", F.lit(0)).cast("long").alias("label"))


def propagate(matches: DataFrame, first: DataFrame, slices: int) -> DataFrame:
    """(z, label, origin): labels of slice 0 followed through matches (z, src, dst) of neighbouring slices; chains that break end.

    Chains that meet go on with the largest origin.  Jumps over 1, 2, 4, ... slices are joined from two of half the
    size, so the rounds, each cut off by a checkpoint, are the logarithm of the slices.
    """
    found = first.select(F.lit(0).cast("long").alias("z"), "label", F.col("label").alias("origin"))
    jumps, step = matches.select("z", "src", "dst").distinct(), 1
    while step < slices:
        ahead = found.join(jumps.withColumnRenamed("src", "label"), ["z", "label"]).select(F.col("z") + step, "dst", "origin")
        found = checkpointed(found.union(ahead).groupBy("z", "label").agg(F.max("origin").alias("origin")))
        further = jumps.select((F.col("z") - step).alias("z"), F.col("src").alias("dst"), F.col("dst").alias("far"))
        jumps = checkpointed(jumps.join(further, ["z", "dst"]).select("z", "src", F.col("far").alias("dst")).distinct())
        step *= 2
    return found.where(F.col("z") < slices)


def zscore(features: DataFrame, columns: list[str]) -> DataFrame:
    """Features of each slice minus their mean, over their population deviation (1 where that is 0)."""
    means = (F.avg(c).alias(f"{c}_mean") for c in columns)
    own = features.groupBy("z").agg(*means, *(F.stddev_pop(c).alias(f"{c}_dev") for c in columns))  # combined before the shuffle
    dev = lambda c: F.coalesce(F.nullif(F.col(f"{c}_dev"), F.lit(0.0)), F.lit(1.0))
    return features.join(own, "z").select("z", "label", *(((F.col(c) - F.col(f"{c}_mean")) / dev(c)).alias(c) for c in columns))


def nearest(features: DataFrame, columns: list[str]) -> DataFrame:
    """(z, src, dst, d): each label's nearest one of the next slice by Euclidean distance, the lowest on ties; rows with a null take no part."""
    own = features.select("z", "label", F.array(*columns).alias("v"))
    queries = own.select("z", F.col("label").alias("id"), F.col("v").alias("a"))
    two = nearest_two(queries, next_slice(own, {"label": "near", "v": "b"}), "z")
    return two.select("z", F.col("id").alias("src"), F.col("near").alias("dst"), F.col("d1").alias("d"))


def two_nearest(a: np.ndarray, b: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(place in ``b``, distance) of the nearest row for each row of ``a``, and of the second nearest if there is one; ties to the earlier row."""
    lot = max(1, LOT // len(b))
    with np.errstate(all="ignore"):
        squares = (b * b).sum(axis=1)
    parts = [_two_nearest(a[i : i + lot], b, squares) for i in range(0, len(a), lot)]
    return [tuple(np.concatenate(c) for c in zip(*one, strict=True)) for one in zip(*parts, strict=True)]


def _two_nearest(a: np.ndarray, b: np.ndarray, qb: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    # Only pairs that may be among the two nearest are worked out: a matrix product, with room for its rounding, tells them.
    with np.errstate(all="ignore"):
        qa = (a * a).sum(axis=1)
        kind, share = ("f4", 4e-7 * (a.shape[1] + 8)) if qa.max() + qb.max() < 1e30 else ("f8", 1e-9)
        rough = a.astype(kind, copy=False) @ (-2 * b.astype(kind, copy=False)).T
        rough += qb.astype(kind)
        rough += qa.astype(kind)[:, None]
        if not np.isfinite(rough.sum()):
            rough[np.isnan(rough)] = -np.inf
        rows, at = np.arange(len(a)), rough.argmin(axis=1)
        limit = rough[rows, at]
        if len(b) > 1:
            rough[rows, at] = np.inf
            limit, rough[rows, at] = rough.min(axis=1), limit
        limit = limit.astype("f8")
        # Distances are rounded to six decimals, so what lies within that of the second one may tie with it.
        edge = (np.sqrt(np.maximum(limit, 0)) + 2e-6) ** 2 + share * (qa + qb.max()) + 1e-9
        row, column = np.divmod(np.flatnonzero(~(rough > edge.astype(kind)[:, None])), len(b))
        step = np.ascontiguousarray((a[row] - b[column]).T)
        step *= step
        exact = step.sum(axis=0)  # line after line
    d = np.full((len(a), len(b)), np.inf)
    d[row, column] = np.where(np.isnan(exact), np.inf, np.floor(np.sqrt(exact) * 1e6 + 0.5) / 1e6)
    out = []
    for _ in range(min(2, len(b))):
        at = d.argmin(axis=1)
        out.append((at, d[rows, at]))
        d[rows, at] = np.inf
    return out


def clear_matches(a: np.ndarray, b: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` of :func:`knn_ratio`'s pairs, compared block by block."""
    who, to = [], []
    for i in range(0, len(a), BLOCK):
        near = [(at + j, d) for j in range(0, len(b), BLOCK) for at, d in two_nearest(a[i : i + BLOCK], b[j : j + BLOCK])]
        if len(near) < 2:
            continue
        at, d = (np.stack(c) for c in zip(*near, strict=True))
        order = np.lexsort((at, d), axis=0)[:2]
        (first, second), at = np.take_along_axis(d, order, 0), np.take_along_axis(at, order, 0)[0]
        clear = np.flatnonzero(first < ratio * second)
        who.append(clear + i)
        to.append(at[clear])
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(who or empty), np.concatenate(to or empty)


def _best_two(key: str):
    """The two nearest rows of one block for each query of another, ties to the lower ``near``."""

    def run(queries: pa.Table, train: pa.Table) -> pa.Table:
        names = [key, "id", "near", "d"]
        if not len(queries) or not len(train):
            return pa.table({key: queries.column(key).slice(0, 0), "id": pa.array([], pa.int64()), "near": pa.array([], pa.int64()), "d": pa.array([], pa.float64())})
        train = train.take(pa.compute.sort_indices(train, [("near", "ascending")]))
        a, b = (t.column(c).combine_chunks().flatten().to_numpy().reshape(len(t), -1) for t, c in ((queries, "a"), (train, "b")))
        out = two_nearest(a, b)
        at, d = (np.concatenate(c) for c in zip(*out, strict=True))
        who = pa.array(np.tile(np.arange(len(a)), len(out)))
        return pa.table([queries.column(key).take(who), queries.column("id").take(who), train.column("near").take(pa.array(at)), pa.array(d)], names=names)

    return run


def knn_ratio(queries: DataFrame, train: DataFrame, ratio: float | Column, key: str = "g") -> DataFrame:
    """:func:`nearest_two`, kept if the first is nearer than ratio * the second."""
    return nearest_two(queries, train, key).where(F.col("d1") < ratio * F.col("d2"))


def nearest_two(queries: DataFrame, train: DataFrame, key: str = "g") -> DataFrame:
    """(key, id, near, d1, d2): the nearest descriptor inside a group, its distance and that of the second nearest (null without one).

    Queries (key, id, a) and descriptors (key, near, b) are dealt into blocks of about ``BLOCK`` rows; a task compares two
    blocks and gives two rows for each query, so no pair of vectors leaves it.  Vectors of different lengths don't
    meet; rows with a null in key, id or vector take no part.
    """

    def clean(df: DataFrame, who: str, v: str) -> DataFrame:
        df = df.select(key, F.col(who).cast("long").alias(who), F.col(v).cast("array<double>").alias(v), F.size(v).alias("dim"))
        return df.where(F.col(key).isNotNull() & F.col(who).isNotNull() & (F.col("dim") > 0) & ~F.exists(v, lambda x: x.isNull()))

    q, t = clean(queries, "id", "a"), clean(train, "near", "b")
    parts = lambda df, name: F.broadcast(df.groupBy(key, "dim").agg(F.ceil(F.count("*") / BLOCK).alias(name)))
    blocks = parts(q, "nq").join(parts(t, "nt"), [key, "dim"])
    deal = lambda who, n: F.pmod(F.xxhash64(who), F.col(n))
    meet = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    q = q.join(F.broadcast(blocks), [key, "dim"]).select(key, "dim", deal("id", "nq").alias("i"), meet("nt").alias("j"), "id", "a")
    t = t.join(F.broadcast(blocks), [key, "dim"]).select(key, "dim", meet("nq").alias("i"), deal("near", "nt").alias("j"), "near", "b")
    by = [key, "dim", "i", "j"]
    other = ["o_" + c for c in by]
    t = t.select(*(F.col(c).alias(o) for c, o in zip(by, other, strict=True)), "near", "b")  # both sides may come from one table
    schema = T.StructType([T.StructField(key, q.schema[key].dataType), *(T.StructField(c, T.LongType()) for c in ("id", "near")), T.StructField("d", T.DoubleType())])
    pairs = q.groupBy(*by).cogroup(t.groupBy(*other)).applyInArrow(_best_two(key), schema)
    two = pairs.withColumn("r", F.row_number().over(Window.partitionBy(key, "id").orderBy("d", "near"))).where("r <= 2")
    return two.groupBy(key, "id").agg(F.min(F.when(F.col("r") == 1, F.col("near"))).alias("near"), F.min("d").alias("d1"), F.max(F.when(F.col("r") == 2, F.col("d"))).alias("d2"))


def dice_adjacent(mask: DataFrame) -> DataFrame:
    """(z, dice) of slices z and z + 1 from dense 0/1 planes; null if both are empty."""
    other = next_slice(mask, {"y": "y", "x": "x", "v": "w"})
    sums = mask.join(other, ["z", "y", "x"]).groupBy("z").agg(F.sum(F.col("v") * F.col("w")).alias("both"), F.sum("v").alias("a"), F.sum("w").alias("b"))
    return sums.select("z", F.round(F.try_divide(2.0 * F.col("both"), F.col("a") + F.col("b")), 6).alias("dice"))


def area_consistency(mask: DataFrame) -> DataFrame:
    """(z, agreement): pixels where slice z >= 1 equals the union of all slices, zeros too, over the union's area."""
    union = mask.groupBy("y", "x").agg(F.max("v").alias("u"))
    area = union.agg(F.sum("u").alias("area"))
    same = mask.where("z >= 1").join(union, ["y", "x"]).groupBy("z").agg(F.sum((F.col("v") == F.col("u")).cast("long")).alias("same"))
    return same.join(F.broadcast(area)).select("z", F.round(F.try_divide(F.col("same").cast("double"), F.col("area")), 6).alias("agreement"))


def dice_pairs(mask: DataFrame, reference: int = 0) -> DataFrame:
    """(z, dice) of every other slice with the reference slice."""
    ref = mask.where(F.col("z") == reference).select("y", "x", F.col("v").alias("w"))
    sums = mask.where(F.col("z") != reference).join(ref, ["y", "x"]).groupBy("z").agg(F.sum(F.col("v") * F.col("w")).alias("both"), F.sum("v").alias("a"), F.sum("w").alias("b"))
    return sums.select("z", F.round(F.try_divide(2.0 * F.col("both"), F.col("a") + F.col("b")), 6).alias("dice"))


def profile_mask(stack: DataFrame) -> DataFrame:
    """(z, y, x, v), y = 0: column profiles of planes (z, c, y, x, v) as 0/1.

    A channel's column sum wraps at 65536; the channels' sums are scaled to 0 ... 255 in each slice and count if above 0.
    """
    columns = stack.groupBy("z", "c", "x").agg(F.pmod(F.sum("v"), F.lit(65536)).alias("s")).groupBy("z", "x").agg(F.sum("s").alias("s"))
    whole = Window.partitionBy("z")
    low, high = F.min("s").over(whole), F.max("s").over(whole)
    scaled = F.when(high > low, F.bround((F.col("s") - low) * 255.0 / (high - low))).otherwise(0)
    return columns.select("z", F.lit(0).cast("long").alias("y"), "x", (scaled > 0).cast("long").alias("v"))


def greedy_matches(counts: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """(z, src, dst, n): labels in their order each take the partner of largest overlap that no earlier one took, or null.

    Takes (z, src, dst, n) of :func:`overlaps`; a group holds the label pairs of one slice, not its pixels.  Labels of
    ``sources`` (z, src) without any overlap get a row with null too.
    """

    def take(pdf):
        taken, rows = set(), []
        for src, own in pdf.sort_values(["src", "n", "dst"], ascending=[True, False, True]).groupby("src"):
            best = next(((int(d), int(n)) for d, n in zip(own["dst"], own["n"], strict=True) if d not in taken), (None, 0))
            taken.add(best[0])
            rows.append((pdf["z"].iloc[0], int(src), *best))
        out = pdf.iloc[:0]
        return out.__class__(rows, columns=["z", "src", "dst", "n"]).astype({"dst": "Int64"})

    met = counts.groupBy("z").applyInPandas(take, "z long, src long, dst long, n long")
    if sources is None:
        return met
    return sources.select("z", "src").distinct().join(met, ["z", "src"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def stack_metrics(stack: DataFrame) -> DataFrame:
    """(idx, dice, agreement) of stacks (idx, z, c, y, x, v): means over the slices after the first, from their column profiles.

    dice compares a slice with the one before, agreement with the union of all, zeros too, over the union's area.  A stack of one
    slice has 0 for both; 0 divided by 0 makes a mean NaN.
    """
    profile = profile_mask(stack.select(F.struct("idx", "z").alias("z"), "c", "y", "x", "v")).select("z.idx", "z.z", "x", "v")
    order = stack.select("idx", "z").distinct().withColumn("r", F.row_number().over(Window.partitionBy("idx").orderBy("z")))
    mask = profile.join(F.broadcast(order), ["idx", "z"]).withColumn("u", F.max("v").over(Window.partitionBy("idx", "x")))
    before = mask.select("idx", (F.col("r") + 1).alias("r"), "x", F.col("v").alias("w"))
    sums = mask.where("r > 1").join(before, ["idx", "r", "x"]).groupBy("idx", "r").agg(F.sum(F.col("v") * F.col("w")).alias("both"), F.sum(F.col("v") + F.col("w")).alias("sizes"), F.sum((F.col("v") == F.col("u")).cast("long")).alias("same"), F.sum("u").alias("area"))
    share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(float("nan")))
    means = sums.groupBy("idx").agg(F.avg(share(2 * F.col("both"), F.col("sizes"))).alias("dice"), F.avg(share(F.col("same"), F.col("area"))).alias("agreement"))
    return order.select("idx").distinct().join(means, "idx", "left").select("idx", *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("dice", "agreement")))
