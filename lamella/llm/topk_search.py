"""Exact top-k inner products with a KD-tree for each shard.

Rows are dealt to shards by the top levels of one KD-tree, fitted to a bounded sample, so that a shard
is a region; inside it, vectors are split at medians of their widest dimension and every node keeps a
tight bounding box.  Queries are a stated set in packed blocks of one region each.  A block first meets a
shard of its own region; the k-th score there bounds all others: only shards whose box can reach
it get the queries, nodes are visited best first, and the k-th score so far ends a search.
"""

from __future__ import annotations

from collections.abc import Iterator  # noqa: F401  (named in annotations of tasks)

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import drop, stored

#: Rows of a shard, queries of a block, vectors of a leaf.
SHARD_ROWS, BLOCK_QUERIES, LEAF = 8192, 4096, 256
#: Sampled rows that the regions are fitted to, and those of one region.
SAMPLE_ROWS, REGION_SAMPLE = 65_536, 64
#: Shards whose boxes meet a block of queries at once; blocks that a task searches one shard for.
BOXES, BLOCKS = 1024, 64
#: Queries that are compared with a leaf at once.
TOGETHER = 256


def usable(vector: str) -> Column:
    """Neither null nor with a null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & finite


def scaled(vector: str, by: int = 64) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * by))


def build_tree(ids: np.ndarray, x: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """Median splits on the widest dimension; nodes in preorder with tight boxes; leaves hold rows in id order."""
    order = np.argsort(ids, kind="stable")
    low, high, right, span, least = [], [], [], [], []

    def grow(rows: np.ndarray, start: int) -> np.ndarray:
        me = len(low)
        box = x[rows]
        low.append(box.min(axis=0))
        high.append(box.max(axis=0))
        least.append(ids[rows].min())
        right.append(-1)
        span.append((start, start + len(rows)))
        wide = high[me] - low[me]
        d = int(np.argmax(wide))
        if len(rows) <= leaf or wide[d] == 0:  # equal vectors stay together, the smallest id first
            return np.sort(rows)
        by = np.argsort(box[:, d], kind="stable")
        half = len(rows) // 2
        left = grow(np.sort(rows[by[:half]]), start)
        right[me] = len(low)
        return np.concatenate([left, grow(np.sort(rows[by[half:]]), start + half)])

    ids, x = ids[order], x[order]
    rows = grow(np.arange(len(ids)), 0)
    return {"ids": ids[rows], "x": x[rows], "low": np.array(low), "high": np.array(high), "right": np.array(right), "span": np.array(span), "least": np.array(least)}


def search(tree: dict[str, np.ndarray], queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each query's best (scores, ids) in the tree that can still be among its k best: scores reach ``floor``.

    Each query visits leaves best first, until the next box can't reach its k-th score.  It asks for one more leaf, then for as
    many as it has had; the queries that ask for a leaf in the same round are compared with it at once.
    """
    limit = np.abs(tree["x"]).max(initial=0).astype(float) * np.abs(queries).max(initial=0) * queries.shape[1]
    kind = np.float64 if limit < 2**53 else object  # products in floating point as long as they are exact
    q, x = queries.astype(kind), tree["x"].astype(kind)
    leaves = np.flatnonzero(tree["right"] < 0)
    bounds = np.maximum(q, 0) @ tree["high"][leaves].astype(kind).T + np.minimum(q, 0) @ tree["low"][leaves].astype(kind).T
    order = np.argsort(-bounds, axis=1, kind="stable")
    kth, best_s, best_i = floor.astype(kind), np.full((len(q), k), -np.inf, kind), np.full((len(q), k), np.iinfo(np.int64).max)
    todo, turn, more = np.arange(len(q)), 0, 1
    while turn < len(leaves):
        todo = todo[bounds[todo, order[todo, turn]] >= kth[todo]]  # else no other box reaches further
        if not len(todo):
            break
        leaf = order[todo, turn : turn + more].ravel()
        asks = np.repeat(todo, len(leaf) // len(todo))
        by = np.argsort(leaf, kind="stable")
        for same in np.split(by, np.flatnonzero(np.diff(leaf[by])) + 1):
            n = leaf[same[0]]
            a, z = tree["span"][leaves[n]]
            for first in range(0, len(same), TOGETHER):
                at = asks[same[first : first + TOGETHER]]
                late = (best_s[at, -1] == bounds[at, n]) & (tree["least"][leaves[n]] > best_i[at, -1])
                at = at[(bounds[at, n] >= kth[at]) & ~late]
                if len(at):
                    _improve(best_s, best_i, kth, at, q[at] @ x[a:z].T, tree["ids"][a:z], own)
        turn += more
        more = turn
    return [(best_s[i, : len(n)].astype(np.int64), n) for i in range(len(q)) for n in [best_i[i, best_s[i] > -np.inf]]]


def _improve(best_s: np.ndarray, best_i: np.ndarray, kth: np.ndarray, at: np.ndarray, score: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
    """Merge the scores of a leaf's ids with what the queries ``at`` have found so far."""
    k = best_s.shape[1]
    keep = (score >= kth[at][:, None]) & (ids != own[at][:, None])
    if len(ids) > 4 * k and score.dtype == np.float64:
        keep &= score >= np.partition(np.where(keep, score, -np.inf), len(ids) - k, axis=1)[:, [len(ids) - k]]
    i, j = np.nonzero(keep)
    new = np.unique(i)
    if not len(new):
        return
    rows = at[new]
    row = np.concatenate([np.repeat(np.arange(len(new)), k), np.searchsorted(new, i)])
    s, n = np.concatenate([best_s[rows].ravel(), score[i, j]]), np.concatenate([best_i[rows].ravel(), ids[j]])
    order = np.lexsort((n, -s, row))
    top = order[np.searchsorted(row[order], np.arange(len(new)))[:, None] + np.arange(k)]
    best_s[rows], best_i[rows] = s[top], n[top]
    kth[rows] = np.maximum(kth[rows], best_s[rows, -1])


def _pack(arrays: dict[str, np.ndarray]) -> bytes:
    import io

    np.savez(to := io.BytesIO(), **arrays)
    return to.getvalue()


def _unpack(packed: bytes) -> dict[str, np.ndarray]:
    import io

    return dict(np.load(io.BytesIO(packed)))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    x = column.combine_chunks().flatten().to_numpy().reshape(-1, dim)
    return x.astype(np.int32) if np.abs(x).max(initial=0) < 2**31 else x


def _regions(sample: np.ndarray, most: int) -> list[tuple[int, int, int, int]]:
    """Top of a KD-tree over a sample: (dimension, value, left, right); a negative child -r - 1 is the region r."""
    nodes, regions = [], 0

    def grow(x: np.ndarray, share: int) -> int:
        nonlocal regions
        if share > 1 and len(x) > 1:
            d = int(np.argmax(x.max(axis=0) - x.min(axis=0)))
            cut = int(np.median(x[:, d]))
            low = x[:, d] <= cut
            if low.any() and not low.all():
                me = len(nodes)
                nodes.append((0, 0, 0, 0))
                left = grow(x[low], share // 2)
                nodes[me] = (d, cut, left, grow(x[~low], share - share // 2))
                return me
        regions += 1
        return -regions

    grow(sample, most)
    return nodes


def _placed(nodes: list[tuple[int, int, int, int]], dim: int):
    """The region of each vector; vectors of other lengths are in region 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(nodes, np.int64).reshape(-1, 4)
        for batch in batches:
            region = np.zeros(batch.num_rows, np.int64)
            mine = np.flatnonzero(batch.column("dim").to_numpy() == dim)
            if len(mine) and len(table):
                x = batch.column("x").take(pa.array(mine)).flatten().to_numpy().reshape(-1, dim)
                at = np.zeros(len(mine), np.int64)
                while (go := np.flatnonzero(at >= 0)).size:
                    d, cut, left, right = table[at[go]].T
                    at[go] = np.where(x[go, d] <= cut, left, right)
                region[mine] = -at - 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(region.astype(np.int32))], names=[*batch.schema.names, "region"])

    return run


def _plant(table: pa.Table) -> pa.Table:
    dim, shard = table.column("dim")[0].as_py(), table.column("shard")[0].as_py()
    tree = build_tree(table.column("id").to_numpy(), _matrix(table.column("x"), dim))
    box = [pa.array([tree[k][0].tolist()], pa.list_(pa.int64())) for k in ("low", "high")]
    return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()), "tree": pa.array([_pack(tree)], pa.binary()), "low": box[0], "high": box[1]})


def _gather(table: pa.Table) -> pa.Table:
    dim, block, home = (table.column(k)[0].as_py() for k in ("dim", "block", "home"))
    packed = _pack({"ids": table.column("id").to_numpy(), "x": _matrix(table.column("x"), dim), "floor": table.column("floor").to_numpy()})
    return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([block], pa.int64()), "home": pa.array([home], pa.int32()), "queries": pa.array([packed], pa.binary())})


def _reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The queries of a block that each shard's box can give a score of at least their k-th, for shards with such queries."""
    for batch in batches:
        for i in range(batch.num_rows):
            dim, block, home, queries, boxes = (batch.column(k)[i].as_py() for k in ("dim", "block", "home", "queries", "boxes"))
            q = _unpack(queries)
            x, rows = q["x"].astype(float), []
            low, high = (np.array([b[k] for b in boxes], float) for k in ("low", "high"))
            bounds = np.maximum(x, 0) @ high.T + np.minimum(x, 0) @ low.T
            slack = 1e-9 * np.maximum(np.abs(x) @ np.maximum(np.abs(low), np.abs(high)).T, 1)  # beyond 2^53 sums are rounded
            for b, reach in zip(boxes, (bounds + slack >= q["floor"][:, None]).T, strict=True):
                if b["shard"] != home and reach.any():
                    rows.append((dim, b["shard"], block, _pack({k: v[reach] for k, v in q.items()})))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["dim", "shard", "block", "queries"])


def _meet(k: int):
    def run(table: pa.Table) -> pa.Table:
        rows = []
        for tree, queries in zip(table.column("tree"), table.column("queries"), strict=True):
            q = _unpack(queries.as_py())
            found = search(_unpack(tree.as_py()), q["x"], q["ids"], q["floor"], k)
            rows += [(np.full(len(s), i), n, s) for i, (s, n) in zip(q["ids"], found, strict=True)]
        columns = [np.concatenate(c).astype(np.int64) if rows else np.zeros(0, np.int64) for c in (zip(*rows, strict=True) if rows else [[]] * 3)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, columns), strict=True)))

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of each query, ties to the smaller vec_id.

    Both tables hold an integer id and an array of integers (see :func:`scaled`); a query doesn't find
    rows with its own id.  Null ids take no part, nor do null vectors or null components.  Vectors of
    different lengths don't meet.  Rows that repeat an id and vector are candidates each; a query that
    repeats both is asked once, and an id with several query vectors has the best of all.  With fewer than k
    other rows, all are returned; without queries or rows, nothing.  Further columns are ignored.
    """
    spark = vectors.sparkSession
    clean = lambda df: df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<long>").alias("x")).where("id is not null and x is not null and size(x) > 0 and not exists(x, v -> v is null)").withColumn("dim", F.size("x"))
    rows, asked = stored(clean(vectors), "vectors"), clean(queries).dropDuplicates()  # counted, sampled and placed: a table, so that they are made once
    counts = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    main = max(counts, key=counts.get, default=0)
    most = min(-(-counts.get(main, 0) // SHARD_ROWS), SAMPLE_ROWS // REGION_SAMPLE)
    sample = rows.where(F.col("dim") == main).orderBy(F.xxhash64("id", F.lit(3))).limit(most * REGION_SAMPLE).select("x").collect() if most > 1 else []
    place = _placed(_regions(np.array([r["x"] for r in sample], np.int64).reshape(-1, max(main, 1)), most), main)
    to = "id long, x array<long>, dim int, region int"
    plain, rows = rows, stored(rows.mapInArrow(place, to), "placed")
    drop(plain)
    asked = stored(asked.mapInArrow(place, to), "asked")
    # A region with more rows than a shard should hold (equal vectors, say) is dealt out by a hash.
    shards = rows.groupBy("dim", "region").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("parts"))
    first_shard = F.sum("parts").over(Window.partitionBy("dim").orderBy("region").rowsBetween(Window.unboundedPreceding, -1))
    shards = stored(shards.withColumn("first_shard", F.coalesce(first_shard, F.lit(0)).cast("int")), "shards")
    deal = lambda seed: (F.col("first_shard") + F.pmod(F.xxhash64("id", F.lit(seed), F.monotonically_increasing_id()), F.col("parts"))).cast("int")
    trees = rows.join(F.broadcast(shards), ["dim", "region"]).withColumn("shard", deal(1)).select("dim", "shard", "id", "x").groupBy("dim", "shard").applyInArrow(_plant, "dim int, shard int, tree binary, low array<long>, high array<long>")
    trees = stored(trees, "trees")
    lowest = F.lit(-(2**62))
    # A block holds queries of one region (of its nearest one, if the region has no rows) and has a shard of that region as its home.
    per = asked.groupBy("dim", "region").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("blocks"))
    homes = per.join(F.broadcast(shards), ["dim", "region"], "left").where(F.col("dim").isin(list(counts) or [-1]))
    homes = homes.withColumns({"first_shard": F.coalesce("first_shard", F.lit(0)), "parts": F.coalesce("parts", F.lit(1))})
    lot = F.pmod(F.xxhash64("id", F.lit(5)), F.col("blocks"))
    asked = stored(asked.join(F.broadcast(homes), ["dim", "region"]).select("dim", "id", "x", (F.shiftleft(F.col("region").cast("long"), 32) + lot).alias("block"), (F.col("first_shard") + F.pmod(lot, F.col("parts"))).cast("int").alias("home")), "blocks")
    n_blocks = asked.select("dim", "block").distinct().count()
    salts = max(1, -(-n_blocks // BLOCKS))
    boxes = trees.withColumn("portion", F.floor(F.col("shard") / BOXES).cast("int")).groupBy("dim", "portion").agg(F.collect_list(F.struct("shard", "low", "high")).alias("boxes"))
    boxes = stored(boxes, "boxes")

    def found(pairs: DataFrame) -> DataFrame:
        salted = trees.select("dim", "shard", "tree", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
        met = pairs.withColumn("salt", F.pmod("block", F.lit(salts)).cast("int")).join(salted.hint("shuffle_hash"), ["dim", "shard", "salt"])
        return met.groupBy("dim", "shard", "salt", "block").applyInArrow(_meet(k), "query_id long, vec_id long, score long")

    packed = lambda q: q.groupBy("dim", "block", "home").applyInArrow(_gather, "dim int, block long, home int, queries binary")
    first = stored(found(packed(asked.withColumn("floor", lowest)).withColumnRenamed("home", "shard")), "first")
    kth = first.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
    floors = packed(asked.join(kth, "id", "left").withColumn("floor", F.coalesce("kth", lowest)).drop("kth"))
    rest = stored(floors.join(boxes, "dim").mapInArrow(_reached, "dim int, shard int, block long, queries binary"), "reached")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return first.unionByName(found(rest)).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
