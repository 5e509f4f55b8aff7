"""Running sums within keys of any size: a range sort, sums inside its partitions, and what earlier partitions hold.

A key with very many rows spans several partitions, so no task gets it whole.  Only one row for each
partition reaches the driver: its first key, its last key and the sums of the last one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .storage import stored


def _inside(key: str, values: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        me, place = TaskContext.get().partitionId(), 0
        last, so_far = None, np.zeros(len(values), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            k = batch.column(key).to_numpy(zero_copy_only=False)
            first = np.append(True, k[1:] != k[:-1])
            sums = []
            for i, v in enumerate(values):
                x = batch.column(v).to_numpy(zero_copy_only=False).astype(np.int64)
                upto = np.cumsum(x)
                before = (upto - x)[first]
                if last is not None and last == k[0]:
                    before[0] -= so_far[i]
                upto = upto - before[np.cumsum(first) - 1]
                so_far[i] = upto[-1]
                sums.append(pa.array(upto))
            last = k[-1]
            numbers = [pa.array(np.full(n, me, np.int32)), pa.array(np.arange(place, place + n))]
            place += n
            yield pa.RecordBatch.from_arrays([*batch.columns, *sums, *numbers], names=[*batch.schema.names, *(f"{v}_upto" for v in values), "in_part", "in_place"])

    return run


def running_sums(df: DataFrame, key: str, order: list[str], values: list[str], by: list[str | Column] | None = None, keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``<value>_upto``, the running sum of each long column of ``values`` within ``key`` (a long, not null) in ``order``.

    ``by`` are the columns that rows are dealt to partitions by (``order`` without it): they must sort as ``order`` does.
    ``keep`` are the columns of the result besides key and sums (all without it), so that those that only sort don't go on.
    Rows that are equal in ``order`` follow each other in any order.
    """
    sort = df.repartitionByRange(key, *(order if by is None else by)).sortWithinPartitions(key, *order)
    sort = sort.select(*dict.fromkeys([key, *values, *(keep if keep is not None else df.columns)]))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sort.schema)
    names = [f"{v}_upto" for v in values]
    table = stored(sort.mapInArrow(_inside(key, values), ", ".join([kinds, *(f"{n} long" for n in names), "in_part int", "in_place long"])), "running")
    ends = table.groupBy("in_part").agg(F.min_by(key, "in_place").alias("first"), F.max_by(key, "in_place").alias("last"), F.max_by(F.array(*names), "in_place").alias("sums"))
    carried, now, total = [], None, [0] * len(values)
    for r in sorted(ends.collect(), key=lambda r: r["in_part"]):  # a row for each partition
        held = total if now is not None and r["first"] == now else [0] * len(values)
        if any(held):
            carried.append((r["in_part"], r["first"], *held))
        now, total = r["last"], [a + b for a, b in zip(held, r["sums"], strict=True)] if r["first"] == r["last"] else list(r["sums"])
    more = df.sparkSession.createDataFrame(carried, "in_part int, held_key long, " + ", ".join(f"held_{n} long" for n in names))
    out = table.join(F.broadcast(more), (table["in_part"] == more["in_part"]) & (table[key] == more["held_key"]), "left")
    return out.select(*(table[c] for c in sort.columns), *((table[n] + F.coalesce(more[f"held_{n}"], F.lit(0))).alias(n) for n in names))
