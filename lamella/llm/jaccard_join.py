"""Near-duplicate join on word shingles by a MinHash LSH forest with exact verification.

Each distinct shingle set (a class of copies) has a signature in each tree; the sorted signatures
are a prefix trie, whose nodes are the classes with a common prefix.  A class's prefix in a tree is as short
as its node stays small: all begin with long prefixes that are shortened to ``depth``, by which two
sets at the threshold meet with the target recall in a few trees already.  A class that lies in
crowded nodes there (common boilerplate) keeps double the length in them, and gets as many further trees as bring it
to the target recall; long prefixes split a crowded node into those that agree in more than the
boilerplate.  For each class, one minus the product over its trees of the chances to miss a set at the threshold
is the target recall or more.

All pairs of a node are verified exactly, in blocks inside tasks: what leaves a task is one row
per class, with its number of links and the smallest class it is linked to, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .components import connected_components
from .storage import drop, stored
from .wordhash import Texts, mix, slices, words

WORDS = 5
THRESHOLD = 0.8
TREES = 16
TARGET_RECALL = 0.999
#: Classes of a node that are compared at once.  A node with more is crowded; long prefixes that still agree are dealt out as pairs of parts of about this size.
BLOCK = 1024
#: Shingles compared at once: nodes of long texts have more parts, so a task's memory doesn't grow with the texts.
BLOCK_SHINGLES = 1 << 22

_PLACE = np.random.default_rng(8).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def recall(similarity: float, depth: int, trees: int = TREES) -> float:
    """Chance that two sets of this similarity share a prefix of this depth in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def prefix_depth(threshold: float = THRESHOLD, target: float = TARGET_RECALL, trees: int = TREES) -> int:
    """The longest prefix that has the target recall in this many trees."""
    depth = 1
    while recall(threshold, depth + 1, trees) >= target:
        depth += 1
    return depth


def trees_needed(depth: int, threshold: float = THRESHOLD, target: float = TARGET_RECALL) -> int:
    """How many trees give prefixes of this depth the target recall."""
    trees = 1
    while recall(threshold, depth, trees) < target:
        trees += 1
    return trees


def shingle_sets(texts: Texts, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each row, one after the other, and each row's start.

    A text of fewer words than a shingle, but not none, is one shingle.
    """
    w = words(texts)
    h, first, n = w.hashes, w.rows[:-1], np.diff(w.rows)
    padded = np.concatenate([h, np.zeros(size, np.uint64)])
    all_of = np.zeros(len(h), np.uint64)
    for j in range(size):
        all_of += padded[j : j + len(h)] * _PLACE[j]
    for i in np.flatnonzero((n > 0) & (n < size)):
        all_of[first[i]] = np.sum(np.append(h[first[i] : first[i] + n[i]] * _PLACE[: n[i]], _PLACE[size + n[i]]))
    all_of = mix(all_of)
    sets = [np.unique(all_of[a : a + max(k - size + 1, min(k, 1))]) for a, k in zip(first.tolist(), n.tolist(), strict=True)]
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), starts


def _digests(texts: Texts, s: np.ndarray, at: np.ndarray) -> pa.Array:
    """Class of each row: 128 bits of its shingle set; of its bytes where it has no word; null for an empty text."""
    full, bytes_of = np.flatnonzero(np.diff(at)), np.diff(texts.offsets)
    digest = np.zeros((len(texts), 2), np.uint64)
    if len(full):
        for k in (0, 1):
            digest[full, k] = np.bitwise_xor.reduceat(mix(s + _PLACE[60 + k]), at[full])
    for i in np.flatnonzero((np.diff(at) == 0) & (bytes_of > 0)):
        raw = texts.data[texts.offsets[i] : texts.offsets[i + 1]].astype(np.uint64)
        place = np.arange(len(raw), dtype=np.uint64)
        digest[i] = [np.bitwise_xor.reduce(mix(mix(place + _PLACE[62 + k]) ^ (raw * _PLACE[5]))) for k in (0, 1)]
    c = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(texts), [None, pa.py_buffer(digest)]).cast(pa.binary())
    return pa.compute.if_else(pa.array(bytes_of > 0), c, pa.scalar(None, pa.binary()))


def _prefixes(s: np.ndarray, at: np.ndarray, trees: int, depth: int) -> pa.Array:
    """The prefix of each row's signature in each tree, as one number; no prefix for an empty set."""
    full = np.flatnonzero(np.diff(at))
    keys = np.zeros((len(full), trees), np.uint64)
    for t in range(trees if len(full) else 0):
        times, plus = np.random.default_rng([8, t]).integers(1, 1 << 63, (2, 64), dtype=np.uint64)
        key = np.full(len(full), t, np.uint64)
        for k in range(depth):
            key = mix(key + np.minimum.reduceat(s * (times[k] * np.uint64(2) + np.uint64(1)) + plus[k], at[full]))
        keys[:, t] = key
    ends = np.concatenate([[0], np.cumsum(np.diff(at) > 0)]).astype(np.int32) * np.int32(trees)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.view(np.int64).ravel()))


def _sketches(trees: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column("text")):
                s, at = shingle_sets(texts)
                rows = batch.slice(texts.first, len(texts))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("th"), _digests(texts, s, at), pa.array(np.diff(at)), _prefixes(s, at, trees, depth)], names=["doc_id", "th", "c", "size", "keys"])

    return run


def _long_prefixes(trees: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("c").slice(texts.first, len(texts)), _prefixes(*shingle_sets(texts), trees, depth)], names=["c", "keys"])

    return run


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in slices(batch.column("text")):
            s, at = shingle_sets(texts)
            rows = batch.slice(texts.first, len(texts))
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(s.view(np.int64)))
            yield pa.RecordBatch.from_arrays([rows.column("c"), rows.column("copies"), rows.column("nodes"), lists], names=["c", "copies", "nodes", "s"])


def _verify(threshold: float, trees: int):
    def run(table: pa.Table) -> pa.Table:
        node, i, j = (table.column(k)[0].as_py() for k in ("node", "i", "j"))
        table = table.combine_chunks()
        c = np.array(table.column("c").to_pylist(), object)
        _, keep = np.unique(c.astype("S16") if len(c) else c, return_index=True)
        if len(keep) < len(c):
            table, c = table.take(pa.array(keep)), c[keep]
        n = len(c)
        copies, part = (table.column(k).to_numpy() for k in ("copies", "part"))
        where = np.zeros((n, trees), np.int64)
        col = table.column("nodes").combine_chunks()
        flat = col.flatten()
        owner = np.repeat(np.arange(n), col.value_lengths().to_numpy())
        where[owner, flat.field("tree").to_numpy()] = flat.field("node").to_numpy()
        col = table.column("s").combine_chunks()
        size = col.value_lengths().to_numpy().astype(np.int64)
        values, place = np.unique(col.flatten().to_numpy(), return_inverse=True)
        row = np.repeat(np.arange(n), size)
        shared = np.bincount(place, minlength=len(values)) > 1
        number = np.cumsum(shared) - 1
        row, place = row[shared[place]], number[place[shared[place]]]
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        both = np.zeros((len(left), len(right)), np.float32)
        order = np.argsort(place, kind="stable")
        row, place = row[order], place[order]
        width = 2048
        for start in range(0, int(number[-1]) + 1 if len(number) else 0, width):
            a, b = np.searchsorted(place, [start, start + width])
            m = np.zeros((n, width), np.float32)
            m[row[a:b], place[a:b] - start] = 1
            both += m[left] @ m[right].T
        union = size[left][:, None] + size[right][None, :] - both
        x, y = np.nonzero((both + 1e-6 >= threshold * union) & (both > 0))
        x, y = left[x], right[y]
        x, y = (x[x < y], y[x < y]) if i == j else (x, y)
        mine = np.zeros(len(x), bool)
        for at in range(0, len(x), 1 << 16):  # each pair counts in one of the nodes that it shares
            p, q = where[x[at : at + (1 << 16)]], where[y[at : at + (1 << 16)]]
            mine[at : at + (1 << 16)] = np.where((p == q) & (p != 0), p, np.iinfo(np.int64).max).min(axis=1) == node
        x, y = x[mine], y[mine]
        links = np.bincount(x, copies[y], n) + np.bincount(y, copies[x], n)
        root = np.arange(n)
        while len(x):
            low = np.minimum(root[x], root[y])
            new = root.copy()
            np.minimum.at(new, x, low)
            np.minimum.at(new, y, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        out = np.flatnonzero(links)
        return pa.table({"c": pa.array(list(c[out]), pa.binary()), "links": pa.array(links[out].astype(np.int64)), "root": pa.array(list(c[root[out]]), pa.binary())})

    return run


def _nodes(classes: DataFrame, first: int = 0) -> tuple[DataFrame, DataFrame]:
    """Each class's node in each tree (trees count from ``first``), and the nodes of two classes or more: parts, and a number that tells their members."""
    at = classes.select("c", "size", F.posexplode("keys").alias("tree", "key")).withColumn("tree", F.col("tree") + first)
    sizes = at.groupBy("tree", "key").agg(F.count("*").alias("n"), F.sum("size").alias("total"), F.bit_xor(F.xxhash64("c")).alias("members"))
    parts = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("total") / BLOCK_SHINGLES)).cast("long")
    # Nodes of different trees with the same members have the same number and are verified once.
    return at.select("c", "tree", "key"), stored(sizes.where("n > 1").select("tree", "key", parts.alias("parts"), F.xxhash64("members", "n").alias("node")), "nodes")


def _texts(source: DataFrame, classes: DataFrame, *columns: str) -> DataFrame:
    """The text of each class's representative, once, with columns of ``classes``."""
    wanted = classes.select("c", *columns, F.col("rep.doc_id").alias("rep_id"), F.col("rep.th").alias("rep_th"))
    met = source.join(wanted, source.doc_id.eqNullSafe(F.col("rep_id")) & (source.th == F.col("rep_th")))
    return met.select("c", *columns, "text").dropDuplicates(["c"])


def _candidates(source: DataFrame, classes: DataFrame, threshold: float, target: float, depth: int) -> tuple[DataFrame, int]:
    """(c, copies, rep, nodes) of the classes that share an opened node with another one, and the number of trees."""
    at, sizes = _nodes(classes)
    spare = TREES - trees_needed(depth, threshold, target)
    many = sizes.where("parts > 1").select("tree", "key")
    crowded = stored(at.join(many, ["tree", "key"], "left_semi").groupBy("c").count().where(F.col("count") > spare).select("c"), "crowded")
    members, trees = at.join(sizes.where("parts = 1"), ["tree", "key"]), TREES
    if not crowded.isEmpty():
        more = trees_needed(2 * depth, threshold, target)
        texts = _texts(source, classes.join(crowded, "c", "left_semi"), "size")
        long = stored(texts.mapInArrow(_long_prefixes(more, 2 * depth), "c binary, keys array<long>").join(classes.select("c", "size"), "c"), "long-prefixes")
        at, sizes = _nodes(long, TREES)
        members, trees = members.unionByName(at.join(sizes, ["tree", "key"])), TREES + more
    found = members.groupBy("c").agg(F.collect_list(F.struct("tree", "node", "parts")).alias("nodes"))
    return classes.select("c", "copies", "rep").join(found, "c"), trees


def _known(docs: DataFrame, threshold: float, target: float, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows, known): doc_id, text hash th and class c of each row; ids, links and the first row (none, doc_id, th) of each class's component."""
    depth = prefix_depth(threshold, target)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("th"))
    long, of = T.LongType(), source.schema["doc_id"].dataType
    kinds = {"doc_id": of, "th": long, "c": T.BinaryType(), "size": long, "keys": T.ArrayType(long)}
    rows = stored(source.mapInArrow(_sketches(TREES, depth), T.StructType([T.StructField(k, v) for k, v in kinds.items()])), "signatures")
    classes = rows.where("c is not null").groupBy("c").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("copy_id"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("rep"), F.first("size").alias("size"), F.first("keys").alias("keys")
    )
    classes = stored(classes, "classes")
    wanted, trees = _candidates(source, classes, threshold, target, depth)
    sets = _texts(source, wanted, "copies", "nodes").mapInArrow(_shingles, "c binary, copies long, nodes array<struct<tree:int,node:long,parts:long>>, s array<long>")
    node = F.explode(F.array_distinct(F.transform("nodes", lambda x: F.struct(x.node.alias("node"), x.parts.alias("parts")))))
    parts = F.col("at.parts").cast("int")
    placed = sets.withColumn("at", node).select("*", F.col("at.node").alias("node"), parts.alias("parts"), F.pmod(F.xxhash64("c", F.col("at.node")), parts).cast("int").alias("part"))
    meets = F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least(k, "part").alias("i"), F.greatest(k, "part").alias("j"))))
    blocks = placed.withColumn("ij", meets).select("node", F.col("ij.i").alias("i"), F.col("ij.j").alias("j"), "part", "c", "copies", "nodes", "s")
    links = stored(blocks.groupBy("node", "i", "j").applyInArrow(_verify(threshold, trees), "c binary, links long, root binary"), "links")
    degree = links.groupBy("c").agg(F.sum("links").alias("links"))
    parts_of = connected_components(links.select("c", "root"), "c", "root").select(F.col("node").alias("c"), "component")
    known = classes.select("c", "copies", "copy_id", "rep").join(degree, "c", "left").join(parts_of, "c", "left")
    known = stored(known.withColumn("component", F.coalesce("component", "c")), "linked")
    least = stored(known.where("links is not null").groupBy("component").agg(F.min("copy_id").alias("class_id"), F.min("rep").alias("first")), "components")
    # Tables of their own: joins on an aggregate's partitioning couldn't split a class or component with a third of all rows.
    known = known.join(least, "component", "left").select(
        "c", "copy_id", F.coalesce("class_id", "copy_id").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("first", "rep").alias("first")
    )
    known = stored(known, "known")
    drop(classes, links, least)
    return rows, known


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, target: float = TARGET_RECALL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, copy_id, n_links.

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles is the
    threshold or more; class_id is the smallest doc_id of the connected component, copy_id the
    smallest doc_id with the same shingle set, n_links the number of other rows linked to this one
    (copies included).  Texts of one to four words are one shingle.  Texts without a word are
    linked if they are equal.  Null and empty texts have no link and their own doc_id as class.
    Repeated rows are copies.  A null doc_id is a row like any other; it is nobody's smallest id
    unless all are null.  Ids may have any type with an order.  Further columns are ignored; an empty table gives no row.
    """
    rows, known = _known(docs, threshold, target, doc_id, text)
    met = rows.where("c is not null").select("doc_id", "c").join(known, "c").select("doc_id", "class_id", "copy_id", "n_links")
    alone = rows.where("c is null").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"), F.lit(0).cast("long").alias("n_links"))
    return met.unionByName(alone)


def removed_copies(docs: DataFrame, threshold: float = THRESHOLD, target: float = TARGET_RECALL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct (doc_id, th) of the rows that are not the first of their component; th is the text's xxhash64.

    The first row has the smallest doc_id, null after all others, and of its texts the one of least hash.
    """
    rows, known = _known(docs, threshold, target, doc_id, text)
    met = rows.where("c is not null").select("doc_id", "th", "c").join(known.select("c", "first"), "c")
    return met.where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th")))).select("doc_id", "th").distinct()
