"""The prefix trie of conversations: nodes by chained digests, sums over subtrees.

A prefix is known by a chain of SHA-256 digests over its turns.  Every conversation is exploded to all its
prefixes, and a node is a group of equal (depth, digest).  For sums over subtrees the trie is laid out in chains: a
node belongs to the smallest conversation that passes it and ends in a childless node, so a chain runs down to one such
node.  Each chain is exploded to all chains above it, with the place where it hangs, and a running sum up the chains gives
every node what is below it.  These rows can't outnumber the turns of conversations that end in childless nodes, while
pairs of nodes and ancestors would grow with the square of a long conversation.

Chains of digests begin anew every ``SEGMENT`` turns and are chained once more over the segments, so that no task hashes a
very long conversation turn by turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .running import running_sums
from .storage import stored

#: Turns of a chain of digests.
SEGMENT = 1024


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, said, chars) of each turn: its place from 1 on, a digest of role and text, code points of the text.

    Turns are ordered by turn (null first), role and text; null role and text are empty; repeated rows are turns of their
    own.  Rows with a null conv_id take no part.
    """
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).where("conv_id is not null")
    said = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    turns = turns.withColumns({"one": F.lit(1).cast("long"), "said": said, "chars": F.char_length("text").cast("long")})
    turns = turns.withColumn("lot", F.concat("role", F.lit("\0"), "text"))
    # Dealt out by the first characters only: sampled bounds of the range sort come to the driver.
    out = running_sums(turns, "conv_id", ["turn", "lot"], ["one"], by=["turn", F.substring("lot", 1, 128)], keep=["said", "chars"])
    return out.select("conv_id", F.col("one_upto").alias("place"), "said", "chars")


def grafted(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) in which conversation c begins with the first h turns of conversation c - c % group, h = crc32(c) % most.

    Its own turns follow after its first h.  Turns are (conv_id, depth, said, chars, is_last), conversations (conv_id, n_turns).
    """
    turns = stored(turns, "numbered")
    convs = stored(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "conversations")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most))
    sized = convs.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % group})
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    sized = sized.join(bases, "base", "left").withColumn("m", F.least("h", F.coalesce("there", F.lit(0))))
    sized = stored(sized.select("conv_id", "base", "h", "m", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns")), "grafts")
    own = turns.join(sized, "conv_id").where("place > h").withColumn("depth", F.col("place") - F.col("h") + F.col("m"))
    heads = turns.where((F.col("place") < most) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "base")
    taken = sized.join(heads, "base").where("place <= h").withColumn("depth", F.col("place"))
    columns = ["conv_id", "depth", "said", "chars", (F.col("depth") == F.col("n_turns")).alias("is_last")]
    return own.select(*columns).unionByName(taken.select(*columns)), sized.select("conv_id", "n_turns")


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """digest and the digest before (null at the beginning) along each (conv_id, segment), rows being in order."""
    now, digest = None, None
    for batch in batches:
        digests, before = [], []
        for conv, segment, said in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "segment", "said")), strict=True):
            if (conv, segment) != now:
                now, digest = (conv, segment), None
            before.append(digest)
            digest = hashlib.sha256((digest or b"") + said).digest()
            digests.append(digest)
        names = ["conv_id", "segment", "depth", "chars", "is_last"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(digests, pa.binary()), pa.array(before, pa.binary())], names=[*names, "digest", "before"])


def _outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of all segments so far, along each conversation."""
    now, digest = None, b""
    for batch in batches:
        out = []
        for conv, inner in zip(batch.column("conv_id").to_pylist(), batch.column("digest").to_pylist(), strict=True):
            digest = hashlib.sha256(digest + inner).digest() if conv == now else inner
            now = conv
            out.append(digest)
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("segment"), pa.array(out, pa.binary())], names=["conv_id", "segment", "outer"])


def prefixes(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, digest, parent, chars, is_last) of every prefix of every conversation, the empty one (depth 0) too."""
    cut = turns.withColumn("segment", F.expr(f"(depth - 1) div {SEGMENT}"))
    order = ["conv_id", "segment", "depth"]
    links = cut.repartition("conv_id", "segment").sortWithinPartitions(*order).select(*order, "chars", "is_last", "said")
    links = stored(links.mapInArrow(_chained, "conv_id long, segment long, depth long, chars long, is_last boolean, digest binary, before binary"), "links")
    ends = links.where(F.col("depth") % SEGMENT == 0).select("conv_id", "segment", "digest")
    outer = stored(ends.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(_outer, "conv_id long, segment long, outer binary"), "segments")
    first = links.where("segment = 0").select("conv_id", "depth", "digest", F.coalesce("before", F.lit(b"")).alias("parent"), "chars", "is_last")
    further = links.where("segment > 0").join(outer.withColumn("segment", F.col("segment") + 1), ["conv_id", "segment"])
    joined = lambda c: F.unhex(F.sha2(F.concat("outer", c), 256))
    further = further.select("conv_id", "depth", joined("digest").alias("digest"), F.when(F.col("before").isNull(), F.col("outer")).otherwise(joined("before")).alias("parent"), "chars", "is_last")
    roots = conversations.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(b"").alias("digest"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("chars"), (F.col("n_turns") == 0).alias("is_last"))
    return first.unionByName(further).unionByName(roots)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of each digest, joined by commas, in lots of a batch; rows are sorted."""
    for batch in batches:
        digests, ids = batch.column("digest").to_pylist(), batch.column("conv_id").to_pylist()
        starts = [i for i in range(len(ids)) if not i or digests[i] != digests[i - 1]]
        lots = [(digests[a], ids[a], ",".join(map(str, ids[a:z]))) for a, z in zip(starts, [*starts[1:], len(ids)], strict=True)]
        columns = list(zip(*lots, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.string()), strict=True)], names=["digest", "first", "listed"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each digest's lots in their order; only the state of one hash is held."""
    now, state = None, None
    for batch in batches:
        done = []
        for digest, listed in zip(batch.column("digest").to_pylist(), batch.column("listed").to_pylist(), strict=True):
            if digest == now:
                state.update(b"," + listed.encode())
                continue
            if state is not None:
                done.append((now, state.hexdigest()))
            now, state = digest, hashlib.sha256(listed.encode())
        columns = list(zip(*done, strict=True)) or [[]] * 2
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())], names=["digest", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["digest", "ends_sha256"])


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of ``conversations`` (conv_id, n_turns) with their ``turns`` (conv_id, depth, said, chars, is_last).

    A node has digest (empty for the root), parent (its digest), depth, conv_id (its smallest member), parent_conv_id,
    n_convs, n_children, n_leaves (childless nodes of its subtree), saved_tokens (over its subtree, n_convs - 1 times the code
    points of the last text) and ends_sha256 (of the ascending ids of the members that end here, joined by commas).

    Equal turns are those of equal ``said``.  Turnless conversations are members of the root, which exists if there is any
    conversation.  No conversation gives no node.
    """
    known = stored(prefixes(turns, conversations), "prefixes")
    nodes = known.groupBy("depth", "digest").agg(F.min("parent").alias("parent"), F.max("chars").alias("chars"), F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    nodes = stored(nodes, "nodes")
    kids = stored(nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("digest")).agg(F.count("*").alias("n_children")), "children")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("digest").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(kids, ["depth", "digest"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stored(nodes.join(above, ["depth", "parent"], "left"), "family")

    # Paths of one conversation for each childless node; a node belongs to the smallest of them.
    leaves = stored(nodes.where("n_children = 0").select("conv_id"), "leaves")
    paths = known.select("conv_id", "depth", "digest").join(leaves, "conv_id", "left_semi")
    owners = stored(paths.groupBy("depth", "digest").agg(F.min("conv_id").alias("owner")), "owners")
    hung = paths.join(owners, ["depth", "digest"]).where("owner <> conv_id").groupBy("conv_id", "owner").agg(F.max("depth").alias("depth"))
    saved = (F.col("n_convs") - 1) * F.col("chars")
    own = stored(nodes.join(owners, ["depth", "digest"]).withColumns({"saved": saved, "leaves": (F.col("n_children") == 0).cast("long"), "is_own": F.lit(1)}), "owned")
    totals = stored(own.groupBy(F.col("owner").alias("conv_id")).agg(F.sum("saved").alias("saved")), "totals")
    below = stored(hung, "hung").join(totals, "conv_id").groupBy("owner", "depth").agg(F.sum("saved").alias("saved"), F.count("*").alias("leaves"))
    columns = ["digest", "parent", "conv_id", "parent_conv_id", "n_convs", "n_children"]
    rows = own.select("owner", "depth", "saved", "leaves", "is_own", *columns).unionByName(below.withColumn("is_own", F.lit(0)), allowMissingColumns=True)
    sums = running_sums(rows.withColumn("up", -F.col("depth")), "owner", ["up", "is_own"], ["saved", "leaves"], keep=["depth", "is_own", *columns])

    ends = known.where("is_last").select("digest", "conv_id").repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")
    lots = ends.mapInArrow(_listed, "digest binary, first long, listed string").repartition("digest").sortWithinPartitions("digest", "first")
    ended = lots.mapInArrow(_hashed, "digest binary, ends_sha256 string")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    out = sums.where("is_own = 1").join(ended, "digest", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
    return out.select("digest", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", F.col("leaves_upto").alias("n_leaves"), F.col("saved_upto").alias("saved_tokens"), "ends_sha256")
