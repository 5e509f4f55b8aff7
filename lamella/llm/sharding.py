"""A uniform distributed shuffle into shards of exact size, by a hypergeometric communication matrix.

How many rows of each input partition go to each shard is drawn exactly (the counts of a uniform
permutation); each partition permutes its own destinations; rows are exchanged and permuted again
inside the shard, by random lots: their leading bits are a block, so that no task holds a shard, and the
blocks' counts tell where each begins.  Partitions draw their own row of the matrix: they walk a binary
tree over the partitions' sizes with a seed for each node, so a task holds the shards' counts, and the
driver one row count for each partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .storage import fresh, stored

#: Rows of one block, on average: what a task permutes at once.
BLOCK_ROWS = 1000
#: numpy draws hypergeometric counts up to this population.
_NUMPY_LIMIT = 10**9 - 1


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Sizes that differ by one row at most."""
    return rows // shards + (np.arange(shards) < rows % shards)


def _one_count(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """A hypergeometric count by inversion around its mode, for populations beyond numpy's limit."""
    total = good + bad
    low, high = max(0, draws - bad), min(good, draws)
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    spread = (draws * (good / total) * (bad / total) * ((total - draws) / max(total - 1, 1))) ** 0.5
    reach = int(40 * spread) + 40
    x = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    ratio = np.log((good - x[:-1]) * (draws - x[:-1])) - np.log((x[:-1] + 1) * (bad - draws + x[:-1] + 1))
    log_p = np.concatenate([[0.0], np.cumsum(ratio)])
    p = np.cumsum(np.exp(log_p - log_p.max()))
    return int(x[np.searchsorted(p, rng.random() * p[-1], "right").clip(0, len(x) - 1)])


def draw_counts(rng: np.random.Generator, left: np.ndarray, draws: int) -> np.ndarray:
    """How many of ``draws`` rows, taken without replacement, come from each of the kinds in ``left``."""
    if left.sum() <= _NUMPY_LIMIT:
        return rng.multivariate_hypergeometric(left, draws, method="marginals")
    out, total = np.zeros_like(left), int(left.sum())
    for i, n in enumerate(left[:-1]):
        out[i] = _one_count(rng, int(n), total - int(n), draws) if draws and n and total > n else min(draws, int(n))
        total, draws = total - int(n), draws - int(out[i])
    out[-1] = draws
    return out


def matrix_row(partition: int, ends: np.ndarray, shards: np.ndarray, seed: int) -> np.ndarray:
    """Row ``partition`` of the communication matrix; ``ends`` are running sums of the partitions' row counts."""
    low, high, left = 0, len(ends), shards
    while high - low > 1:
        mid = (low + high) // 2
        start = int(ends[low - 1]) if low else 0
        first = draw_counts(np.random.default_rng([seed, low, high]), left, int(ends[mid - 1]) - start)
        if partition < mid:
            high, left = mid, first
        else:
            low, left = mid, left - first
    return left


def shuffle_into_shards(
    docs: DataFrame, shards: int, seed: int = 17, block_rows: int = BLOCK_ROWS, shard: str = "shard", slot: str = "slot"
) -> DataFrame:
    """All rows and columns of ``docs`` with a shard and a slot (gapless from 0 in each shard).

    Every permutation of the rows over all (shard, slot) places is equally likely, and shards'
    row counts differ by one at most.  Rows are counted as they are: nulls, empty texts and
    repeated rows each take a place.  An empty table gives no row.  ``docs`` must be read the
    same way twice (a table or a checkpoint): a partition whose row count has changed since it was
    counted fails the job rather than give a wrong shuffle.  Columns named as the added ones are
    replaced.
    """
    docs = docs.drop(shard, slot)
    p, block, r = fresh(docs, "source_partition", "block", "lot")
    counted = docs.select(F.spark_partition_id().alias(p)).groupBy(p).count().collect()
    n = max((row[0] for row in counted), default=-1) + 1
    sizes = np.zeros(max(n, 1), np.int64)
    for row in counted:
        sizes[row[0]] = row[1]
    ends = np.cumsum(sizes)
    of = shard_sizes(int(ends[-1]), shards)
    bits = max(0, int(-(-int(of[0]) // block_rows) - 1).bit_length())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        me, at, goes = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            if goes is None:
                if me >= len(sizes):
                    raise RuntimeError("the input has other partitions than when it was counted")
                rng = np.random.default_rng([seed, 1, me])
                goes = rng.permutation(np.repeat(np.arange(shards, dtype=np.int32), matrix_row(me, ends, of, seed)))
                lots = rng.integers(0, 1 << 63, len(goes), dtype=np.int64)
            mine, lot = goes[at : at + batch.num_rows], lots[at : at + batch.num_rows]
            at += batch.num_rows
            if len(mine) < batch.num_rows:
                raise RuntimeError("the input has more rows than when it was counted")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(mine), pa.array(lot >> (63 - bits)), pa.array(lot)], names=[*batch.schema.names, shard, block, r])
        if goes is not None and at != len(goes):
            raise RuntimeError("the input has fewer rows than when it was counted")

    def dealt(rows: DataFrame) -> DataFrame:
        added = [T.StructField(shard, T.IntegerType()), T.StructField(block, T.LongType()), T.StructField(r, T.LongType())]
        return rows.mapInArrow(deal, T.StructType([*rows.schema.fields, *added]))

    # The same draws without the rows' columns: a block begins after those before it in its shard.
    counts = dealt(docs.select(F.spark_partition_id().alias(p))).groupBy(shard, block).count()
    before = F.coalesce(F.sum("count").over(Window.partitionBy(shard).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = stored(counts.select(shard, block, before.alias(p)), "blocks")
    place = F.row_number().over(Window.partitionBy(shard, block).orderBy(r)) - 1
    return dealt(docs).join(begins, [shard, block]).withColumn(slot, F.col(p) + place).select(*docs.columns, shard, slot)
