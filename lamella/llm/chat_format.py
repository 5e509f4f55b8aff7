"""Conversations as a prefix tree: shared first turns are written once, depth first.

A node is a distinct prefix of turns, known by a running 128-bit hash of (place, role, text).
Conversations are range-sorted by the path of their nodes, so those below a node are
neighbours; the first of them owns it, and walking the conversations in order while writing each
one's own nodes is a depth-first walk of the tree.  Nodes carry their tokens, their place in that
stream, the position id of their first token and the stream intervals of their ancestors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import stored

# The template's control strings.
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>\n"
_ESCAPED = re.compile(r"\\(.)", re.S)
#: Texts that are encoded at once.
TOGETHER = 1000


def escape(c: Column) -> Column:
    """A backslash before every ``\\``, ``<``, ``[`` and ``|``, so that no control string can occur in a text."""
    return F.regexp_replace(c, r"([\\<\[|])", r"\\$1")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def _ids(path: str, texts: list[str]) -> list[list[int]]:
    parts = (texts[i : i + TOGETHER] for i in range(0, len(texts), TOGETHER))  # encodings hold far more than ids
    return [e.ids for part in parts for e in _tokenizer(path).encode_batch_fast(part, add_special_tokens=False)]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (tail,) = _ids(path, [END])
        for batch in batches:
            heads = batch.column("head").dictionary_encode()  # one for each role
            known = _ids(path, heads.dictionary.to_pylist())
            head = [known[i] for i in heads.indices.to_pylist()]
            body = _ids(path, batch.column("body").to_pylist())
            ids = [a + b + tail for a, b in zip(head, body, strict=True)]
            loss = batch.column("is_loss").to_pylist()
            first = [len(a) if own else 0 for a, own in zip(head, loss, strict=True)]
            last = [len(a) + len(b) if own else 0 for a, b, own in zip(head, body, loss, strict=True)]
            names = ["owner", "depth", "node"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in names), pa.array(ids, pa.list_(pa.int32())), pa.array([len(x) for x in ids], pa.int64()), pa.array(first, pa.int32()), pa.array(last, pa.int32())],
                names=[*names, "ids", "n_tokens", "loss_start", "loss_end"],
            )

    return run


def _ranked(df: DataFrame, keys: list[str], name: str, size: Column | None = None) -> DataFrame:
    """``df`` range-sorted by ``keys`` with a running sum of ``size`` before each row (the row's number without it).

    Sums of partitions come to the driver, one number each; within a partition they run on.
    """
    sort = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("p", F.spark_partition_id()), name)
    n = F.lit(1).cast("long") if size is None else size
    totals = {r["p"]: r["n"] for r in sort.groupBy("p").agg(F.sum(n).alias("n")).collect()}
    before, starts = 0, []
    for p in sorted(totals):
        starts.append((p, before))
        before += totals[p]
    table = F.broadcast(df.sparkSession.createDataFrame(starts or [(0, 0)], "p int, before long"))
    here = F.coalesce(F.sum(n).over(Window.partitionBy("p").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return sort.join(table, "p").withColumn(name, F.col("before") + here).drop("p", "before")


def format_conversations(conversations: DataFrame, tokenizer: str, loss_role: str = "assistant") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, paths, members) of the prefix tree of all conversations.

    nodes: owner, depth, node, ids, n_tokens, loss_start, loss_end (token range under the loss
    mask in the node), start (in the stream), position (id of the first token) and ancestors (merged
    stream intervals that its tokens attend to besides themselves); ordered by start they are the
    stream.  paths: the nodes of each distinct conversation (leaf, depth, node).  members: conv_id
    and leaf of each conversation, copies included.

    Turns are ordered by turn, role and text; repeated rows are turns of their own.  Null role and
    text are empty; a null turn comes first; rows with a null conv_id are one conversation.  An
    empty text is a node with an empty body.  Further columns are ignored; an empty table gives three
    empty tables.
    """
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = turns.withColumn("depth", F.row_number().over(order))
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    hashes = [F.bit_xor(F.xxhash64(F.lit(seed), "depth", "role", "text")).over(so_far) for seed in (11, 12)]
    node = F.concat(*(F.lpad(F.hex(h), 16, "0") for h in hashes))
    turns = stored(turns.withColumn("node", node), "turns")
    members = turns.groupBy("conv_id").agg(F.max_by("node", "depth").alias("leaf"), F.count("*").alias("n"))
    # One conversation for all copies; equal leaves have equal paths.
    one = members.groupBy("leaf").agg(F.min(F.coalesce("conv_id", F.lit(-(2**63)))).alias("one"))
    key = F.coalesce("conv_id", F.lit(-(2**63))).alias("one")
    kept = turns.select(key, "depth", "node").join(one, "one")
    path = kept.groupBy("leaf").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("depth", "node"))), lambda x: F.substring(x.node, 1, 16)), "").alias("path"))
    ranks = stored(_ranked(path, ["path", "leaf"], "rank").select("leaf", "rank"), "ranks")
    paths = stored(kept.join(ranks, "leaf").select("leaf", "rank", "one", "depth", "node"), "paths")
    # A table of its own: a join on the aggregate's partitioning couldn't split a turn that many share.
    owners = stored(paths.groupBy("node").agg(F.min("rank").alias("owner")), "owners")
    owned = stored(paths.join(owners, "node"), "owned")
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY))
    # Texts and token ids, most of all bytes, are shuffled once each, when their nodes are known.
    written = owned.where("rank = owner").select("one", "depth", "node", "owner").join(turns.select(key, "depth", "node", "role", "text"), ["one", "depth", "node"])
    texts = written.select("owner", "depth", "node", head.alias("head"), escape(F.col("text")).alias("body"), (F.col("role") == loss_role).alias("is_loss"))
    tokens = texts.mapInArrow(_encode(tokenizer), "owner long, depth int, node string, ids array<int>, n_tokens long, loss_start int, loss_end int")
    tokens = stored(tokens, "tokens")  # the range sort below reads its input twice
    placed = stored(_ranked(tokens.select("owner", "depth", "node", "n_tokens"), ["owner", "depth"], "start", F.col("n_tokens")), "stream")
    # Ancestors of one owner are next to each other in the stream: an interval for each owner on the path.
    steps = owned.select("rank", "depth", "node", "owner").join(placed.select("node", "start", "n_tokens"), "node")
    before = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("rank").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = steps.withColumn("position", before).where("rank = owner").select("node", "position")
    spans = steps.groupBy("rank", "owner").agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("n_tokens")).alias("end"))
    above = spans.where("rank <> owner").groupBy("rank").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("above"))
    mine = spans.where("rank = owner").select("rank", F.col("start").alias("own_start"))
    attend = mine.join(above, "rank", "left").withColumnRenamed("rank", "owner")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    nodes = placed.join(own, "node").join(attend, "owner")
    chain = F.when(F.col("start") > F.col("own_start"), F.array(F.struct(F.col("own_start").alias("start"), F.col("start").alias("end")))).otherwise(none)
    nodes = nodes.withColumn("ancestors", F.concat(F.coalesce("above", none), chain)).drop("above", "own_start")
    nodes = nodes.join(tokens.select("node", "ids", "loss_start", "loss_end"), "node")
    return nodes, paths.select("leaf", "depth", "node"), members


@cache
def _spoken(path: str) -> pa.Array:
    """The bytes of each token of the vocabulary, by its id; a token that isn't written in byte-level characters stands for itself."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = dict(zip(map(chr, shown), shown, strict=True)) | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
    vocabulary = _tokenizer(path).get_vocab()
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    return pa.array(out, pa.binary())


def _read(path: str):
    """Each node's turns, loss text and length from its tokens: decoded, taken apart by the template and unescaped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = lambda b: b.decode("utf-8", "replace")
        for batch in batches:
            column = batch.column("ids")
            upto = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            tokens = _spoken(path).take(column.flatten())
            before = np.concatenate([[0], np.cumsum(pc.binary_length(tokens).to_numpy(zero_copy_only=False))])  # bytes
            bodies = pc.binary_join(pa.ListArray.from_arrays(pa.array(upto, pa.int32()), tokens), b"").to_pylist()
            begin, end = (before[upto[:-1] + batch.column(k).to_numpy()] - before[upto[:-1]] for k in ("loss_start", "loss_end"))
            said, n, loss, chars = [], [], [], []
            for body, a, z in zip(bodies, begin.tolist(), end.tolist(), strict=True):
                whole = decode(body)
                turns = [part.removesuffix(END).partition(BODY) for part in whole.split(TURN)[1:]]
                said.append("".join(f"{unescaped(role)}\n{unescaped(text)}\n" for role, _, text in turns))
                n.append(len(turns))
                loss.append(unescaped(decode(body[a:z])))
                chars.append(len(whole))
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(n, pa.int64()), pa.array(said, pa.string()), pa.array(loss, pa.string()), pa.array(chars, pa.int64())], names=["node", "n", "said", "loss", "chars"])

    return run


def read_back(nodes: DataFrame, paths: DataFrame, members: DataFrame, tokenizer: str) -> DataFrame:
    """Each conversation's turns and loss text, as digests, from the written tokens; every node is decoded once."""
    read = nodes.select("node", "ids", "loss_start", "loss_end").mapInArrow(_read(tokenizer), "node string, n long, said string, loss string, chars long")
    steps = paths.join(stored(read, "read"), "node")
    whole = steps.groupBy("leaf").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.array_sort(F.collect_list(F.struct("depth", "said", "loss"))).alias("steps"))
    turns, loss = (F.array_join(F.transform("steps", lambda x: x[k]), "") for k in ("said", "loss"))
    digests = whole.select("leaf", "n_turns", F.sha2(turns, 256).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
    return members.select("conv_id", "leaf").join(stored(digests, "digests"), "leaf").drop("leaf")
