"""Product codes of integer vectors: equal parts, a codebook for each, exact assignments.

A task screens its rows against a codebook by one float32 matrix product, whose rounding error is bounded
for any order of summation.  Every entry whose interval reaches below the best one's upper end is
evaluated again in 64-bit integers, and ties go to the lower index.  A round of learning is one pass over the
stored rows: tasks add up their parts by entry, and only the codebooks' size comes to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .storage import stored

#: Half the distance between 1 and the next float32, and of float64.
UNIT, FINE = 2.0**-24, 2.0**-53


def scaled_exactly(vector: str, by: int) -> Column:
    """``floor(by * x)`` of each component, ``by`` a power of two, so that the product is exact."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * by))


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of paired rows: int64 where they fit, else Python's integers."""
    reach = max(int(np.abs(x).max(initial=0)), 0) + max(int(np.abs(c).max(initial=0)), 0)
    if reach * reach * max(x.shape[1], 1) >= 2**62:
        x, c = x.astype(object), c.astype(object)
    step = x - c
    return (step * step).sum(axis=1)


def screened(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Which entries (rows of c) can be the nearest to each row of x, by intervals around a float32 product.

    With p terms the product's error is at most g |x| |c|, g = (p + 2) u / (1 - (p + 2) u), however the terms are added
    and with both factors rounded to float32.  An interval that isn't finite reaches everything.
    """
    p = x.shape[1]
    with np.errstate(all="ignore"):
        dot = (x.astype(np.float32) @ c.astype(np.float32).T).astype(np.float64)
        norm = lambda m: np.sqrt((m.astype(np.float64) ** 2).sum(axis=1)) * (1 + (p + 4) * FINE)
        square = np.array([float(sum(int(v) * int(v) for v in row)) for row in c])
        g = (p + 2) * UNIT / (1 - (p + 2) * UNIT)
        error = 2 * g * (1 + 8 * FINE) * norm(x)[:, None] * norm(c)[None, :] + 8 * FINE * (square[None, :] + 2 * np.abs(dot))
        score = square[None, :] - 2 * dot
        low, high = score - error, score + error
        bad = ~np.isfinite(low) | ~np.isfinite(high)
        low[bad], high[bad] = -np.inf, np.inf
        return low <= high.min(axis=1)[:, None]


def nearest_entries(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The index of the nearest row of c for each row of x, the lower one on ties."""
    able = screened(x, c)
    best = able.argmax(axis=1)
    again = np.flatnonzero(able.sum(axis=1) > 1)
    if len(again):
        row, entry = np.nonzero(able[again])
        exact = _distances(x[again[row]], c[entry])
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        least = np.minimum.reduceat(exact, first)
        hit = np.flatnonzero(exact == least[row])  # in the order of entries
        best[again[row[hit[::-1]]]] = entry[hit[::-1]]  # the first one is written last
    return best


def _rows(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dim).astype(np.int64)


def _sums(books: np.ndarray, dim: int):
    """Each task's sums of parts by (part, entry, place) and their number."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, entries, width), object), np.zeros((parts, entries), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows(batch, dim)
            whole = np.int64 if int(np.abs(x).max(initial=0)) * len(x) < 2**62 else object
            for part in range(parts):
                own = x[:, part * width : (part + 1) * width]
                code = nearest_entries(own, books[part])
                order = np.argsort(code, kind="stable")
                used, first = np.unique(code[order], return_index=True)
                total[part, used] += np.add.reduceat(own[order].astype(whole), first, axis=0).astype(object)
                count[part] += np.bincount(code, minlength=entries)
        part, entry = np.nonzero(count)
        at = np.tile(np.arange(width), len(part))
        part, entry = np.repeat(part, width), np.repeat(entry, width)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c.astype(np.int32)) for c in (part, entry, at)), pa.array([int(v) for v in total[part, entry, at]], pa.int64()), pa.array(count[part, entry])], names=["part", "entry", "at", "total", "n"]
        )

    return run


def _coded(books: np.ndarray, dim: int):
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch, dim)
            codes, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), object)
            for part in range(parts):
                own = x[:, part * width : (part + 1) * width]
                codes[:, part] = nearest_entries(own, books[part])
                error += _distances(own, books[part][codes[:, part]]).astype(object)
            text = codes.tobytes().hex()
            text = [text[i * 2 * parts : (i + 1) * 2 * parts] for i in range(len(x))]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()), pa.array(error.tolist(), pa.int64())], names=["vec_id", "label", "code", "error"])

    return run


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, list[list[list[int]]]]:
    """(codes, codebooks) of integer vectors: (vec_id, label, code, error, label_error), and by part and entry the components.

    Vectors must have one length that ``parts`` divides; others raise a ValueError.  Null vectors and null
    components take no part; null ids and labels are kept, and null labels are one label.  Codebooks begin as the parts of
    the rows of smallest vec_id (nulls last; equal ids in the order of their vectors), as many as there are if fewer than
    ``entries`` (at most 256).  Repeated rows count each.  An empty table gives no codes and no codebooks.  Sums beyond 64 bits
    raise an error.  Further columns are ignored.
    """
    if not 0 < entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    clean = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<long>").alias("x"))
    rows = stored(clean.where("x is not null and not exists(x, v -> v is null)"), "vectors")
    low, high = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if low != high or (low or 0) % parts:
        raise ValueError(f"vectors have lengths of {low} to {high}: one length is needed, and one that {parts} divides")
    dim, kinds = low or 0, {f.name: f.dataType.simpleString() for f in rows.schema}
    start = [r["x"] for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()]
    width = dim // parts
    books = np.array(start, np.int64).reshape(len(start), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds if start and dim else 0):
        sums = rows.mapInArrow(_sums(books, dim), "part int, entry int, at int, total long, n long")
        for r in sums.groupBy("part", "entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():  # of the codebooks' size
            books[r["part"], r["entry"], r["at"]] = r["total"] // r["n"]
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    codes = stored((rows if start else rows.limit(0)).mapInArrow(_coded(books, dim), schema), "codes")
    # A table of its own, so that a label with very many rows can be split where it is joined.
    by_label = stored(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "of")
    out = codes.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "label", "code", "error", "label_error")
    return out, books.tolist()


def digest(codebooks: list[list[list[int]]]) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(v) for part in codebooks for entry in part for v in entry).encode()).hexdigest()
