"""Packing of whole documents into sequences by patterns of few lengths.

Only the histogram of lengths, which the sequence length bounds, comes to the driver.  There the
patterns of a few length classes that fill a sequence exactly get repeat counts by non-negative least
squares, rounded, as far as the histogram goes; what is left over goes best fit, longest first, into further
sequences, in lots of equal lengths.  The plan says for each place in the order
of lengths which sequence and offset it has, so the lengths alone are range-sorted, numbered and placed by look-up.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .packing import _tokenizer
from .running import running_sums
from .storage import stored
from .wordhash import slices

LENGTH = 4096
#: Classes of length that patterns are made of, and the most documents of a pattern.
CLASSES, FEW = 128, 4


def patterns(classes: int, few: int) -> list[tuple[int, ...]]:
    """All ways to write ``classes`` as a falling sum of at most ``few`` numbers, or of more that are equal but for a smaller last one."""
    out = []

    def grow(head: tuple[int, ...], left: int, most: int) -> None:
        if not left:
            out.append(head)
        elif len(head) < few:
            for k in range(min(left, most), 0, -1):
                if k * (few - len(head)) < left:
                    break  # the rest can't be reached any more
                grow((*head, k), left - k, k)

    grow((), classes, classes)
    for c in range(1, classes):
        many, rest = divmod(classes, c)
        out += [(c,) * many + (rest,) * (rest > 0)] * (many + (rest > 0) > few)
    return out


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by an active set (Lawson and Hanson)."""
    x, free, useless = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool), np.zeros(a.shape[1], bool)
    tolerance = 1e-10 * np.abs(a.T @ b).max(initial=0)
    for _ in range(10 * a.shape[0]):
        slope = a.T @ (b - a @ x)
        slope[free | useless] = -np.inf
        j = int(slope.argmax())
        if slope[j] <= tolerance:
            break
        free[j] = True
        while free.any():
            own = np.flatnonzero(free)
            s = np.linalg.lstsq(a[:, own], b, rcond=None)[0]
            low = s <= 0
            if not low.any():
                x[own] = s
                break
            step = (x[own[low]] / (x[own[low]] - s[low] + 1e-300)).min()
            x[own] += step * (s - x[own])
            gone = own[low & (x[own] <= 1e-12 * x.max())]
            x[gone], free[gone] = 0, False
        useless[:] = False
        useless[j] = not free[j]  # rounding made it a descent; another one has to come first
    return x


def fitted(histogram: dict[int, int], length: int, classes: int = CLASSES, few: int = FEW) -> list[tuple[list[tuple[int, int]], int]]:
    """Lots of equal sequences ([(length, how many)], repeats) from the patterns' rounded repeat counts.

    A pattern's documents are the longest that are left of their classes, but for the last one: that is the longest
    of all that still fits.  A pattern ends when one of its classes has no more.
    """
    unit = -(-length // classes)
    classes = length // unit
    have = np.zeros(classes, np.int64)
    for n, many in histogram.items():
        have[-(-n // unit) - 1] += many
    rows = patterns(classes, few)
    a = np.zeros((classes, len(rows)))
    for j, parts in enumerate(rows):
        np.add.at(a[:, j], [c - 1 for c in parts], 1)
    weight = np.arange(1, classes + 1) / classes  # a long document that is left over costs more
    x = nonnegative_least_squares(a * weight[:, None], have * weight)
    left, there = dict(histogram), sorted(histogram)
    lots = []

    def longest(upto: int, above: int, taken: dict[int, int]) -> int | None:
        """The longest length of above + 1 to upto that is left beside what is taken."""
        for at in range(bisect_right(there, upto) - 1, -1, -1):
            if there[at] <= above:
                return None
            if left[there[at]] > taken.get(there[at], 0):
                return there[at]
        return None

    for k in sorted(np.flatnonzero(x), key=lambda k: rows[k], reverse=True):
        repeats, parts = round(x[k]), rows[k]
        while repeats > 0:
            taken: dict[int, int] = {}
            for c in parts[:-1]:
                n = longest(c * unit, (c - 1) * unit, taken)
                if n is None:
                    break
                taken[n] = taken.get(n, 0) + 1
            else:
                n = longest(length - sum(n * m for n, m in taken.items()), 0, taken)
                if n is not None:
                    taken[n] = taken.get(n, 0) + 1
                    times = min(repeats, *(left[n] // m for n, m in taken.items()))
                    for n, m in taken.items():
                        left[n] -= m * times
                        if not left[n]:
                            there.pop(bisect_left(there, n))
                    lots.append((sorted(taken.items(), reverse=True), times))
                    repeats -= times
                    continue
            break
    return lots


def best_fit(lots: list[tuple[list[tuple[int, int]], int]], histogram: dict[int, int], length: int) -> list[tuple[list[tuple[int, int]], int]]:
    """The lots with all lengths of the histogram added: longest first, each into the sequence of least room that it fits.

    Sequences of one room are a lot.  Equal lengths fill one sequence after the other, as they would one by one.
    """
    rooms: list[int] = []
    open_: dict[int, list[tuple[list[tuple[int, int]], int]]] = defaultdict(list)

    def put(held: list[tuple[int, int]], count: int) -> None:
        if count:
            room = length - sum(n * m for n, m in held)
            if not open_[room]:
                insort(rooms, room)
            open_[room].append((held, count))

    for held, count in lots:
        put(held, count)
    for n in sorted(histogram, reverse=True):
        left = histogram[n]
        while left:
            at = bisect_left(rooms, n)
            room = rooms[at] if at < len(rooms) else length
            if at < len(rooms):
                held, count = open_[room].pop()
                if not open_[room]:
                    rooms.pop(at)
            else:
                held, count = [], -(-left // (length // n))
            each = room // n
            full, rest = divmod(min(left, each * count), each)
            put([*held, (n, each)], full)
            put([*held, (n, rest)] if rest else held, int(rest > 0))
            put(held, count - full - int(rest > 0))
            left -= full * each + rest
    return [lot for room in sorted(open_) for lot in open_[room]]


def plan(histogram: dict[int, int], length: int = LENGTH) -> tuple[np.ndarray, int]:
    """(intervals, sequences): rows (first place, first sequence, how many of the length in a sequence, offset, length).

    Places count all pieces in the order of their lengths; intervals are in the order of places and cover all.
    """
    # What a pattern couldn't fill to the last token is packed anew: a gap may fit nothing that is left.
    lots = [lot for lot in fitted(histogram, length) if sum(n * m for n, m in lot[0]) == length]
    rest = dict(histogram)
    for held, count in lots:
        for n, m in held:
            rest[n] -= m * count
    lots = best_fit(lots, {n: c for n, c in rest.items() if c}, length)
    at, place = 0, {}
    for n in sorted(histogram):
        place[n] = at
        at += histogram[n]
    out, sequence = [], 0
    for held, count in lots:
        offset = 0
        for n, m in held:
            out.append((place[n], sequence, m, offset, n))
            place[n] += m * count
            offset += n * m
        sequence += count
    return np.array(sorted(out), np.int64).reshape(-1, 5), sequence


def _pieces(path: str, end: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for whole in batches:
            for texts in slices(whole.column("text")):
                of, columns = [], [[] for _ in range(6)]
                for i, own in enumerate(_tokenizer(path).encode(texts)):
                    ids = np.append(own, np.uint32(end)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), length)):
                        part = ids[start : start + length]
                        wide = bool(part.max() >= 65536)
                        of.append(texts.first + i)
                        for column, v in zip(columns, (piece, start, len(part), zlib.crc32(part.tobytes()), wide, press.compress((part if wide else part.astype(np.uint16)).tobytes())), strict=True):
                            column.append(v)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
                yield pa.RecordBatch.from_arrays([whole.column("doc_id").take(pa.array(of, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["doc_id", "piece", "start", "length", "ids_crc32", "wide", "packed"])

    return run


def _placed(intervals: np.ndarray):
    """The sequence and offset of each row by its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("one_upto").to_numpy() - 1
            first, sequence, many, offset, length = intervals[np.searchsorted(intervals[:, 0], place, "right") - 1].T
            each, nth = np.divmod(place - first, np.maximum(many, 1))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(sequence + each), pa.array(offset + nth * length)], names=["row", "sequence_id", "offset"])

    return run


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _unpacked(packed: pd.Series, wide: pd.Series) -> pd.Series:
    import zstandard

    press = zstandard.ZstdDecompressor()
    return pd.Series([np.frombuffer(press.decompress(p), np.uint32 if w else np.uint16).astype(np.int32) for p, w in zip(packed, wide, strict=True)])


def pack_patterns(docs: DataFrame, tokenizer: str, end: int = 1, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Whole documents in as few sequences of at most ``length`` tokens as patterns and best fit reach, with their ids.

    A document is its tokens and then ``end``; null and empty texts are ``end`` alone.  Only documents that are longer are
    cut, into pieces of ``length`` tokens and a rest.  A piece has doc_id, piece, start (ids of its document before it),
    length, ids_crc32, sequence_id, offset (in the sequence, without gaps) and ids.  Pieces of one length are
    exchangeable; ties among them follow the stored rows.  Repeated rows and null ids of any type are documents like any other.
    An empty table gives no piece; further columns are ignored.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    pieces = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    tokens = stored(source.mapInArrow(_pieces(tokenizer, end, length), pieces + ", wide boolean, packed binary").withColumn("row", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["n"] for r in tokens.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``length`` rows
    intervals, _ = plan(histogram, length)
    keyed = tokens.select("length", "row", F.lit(0).cast("long").alias("all"), F.lit(1).cast("long").alias("one"))
    numbered = running_sums(keyed, "all", ["length", "row"], ["one"], keep=["row"])
    places = numbered.mapInArrow(_placed(intervals), "row long, sequence_id long, offset long")
    # The ids join last, as a column of their own: who doesn't read them doesn't move them.
    return tokens.join(places, "row").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", _unpacked("packed", "wide").alias("ids"))
