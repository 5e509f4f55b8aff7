"""Exact removal of long repeated byte strings with a logarithmic family of sparse suffix arrays.

Suffixes are sampled by minimizers: every window of ``length`` bytes has one, the leftmost k-mer
of least hash in it, so equal windows have equal sampled suffixes at equal offsets.  The windows
of one sampled suffix are neighbours; the bytes that they cover are its stretch.

A batch's suffix array holds its sampled suffixes in the order of their text (eight bytes as they
are, the rest of their reach by fingerprints), equal stretches as one run with its number and a place.
Each window reaches 116 bytes to the right of its suffix or 85 to the left (for 200 bytes), so
two suffixes can share a window only if they agree that far on one side: a new batch is merge-scanned
for such agreement against itself and all levels of the family.  Then levels of equal size merge.
Both are joins of tables kept in buckets; only a new batch is shuffled.

What the scans find is settled in two ways.  Runs with two places repeat as a whole.  The windows
of stretches that agree in part with others get a dense suffix array in text order in the task of
their k-mer, where neighbours with a common prefix of ``length`` bytes are repeats; k-mers with more
stretches than a task should hold compare fingerprints of their windows as rows instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .storage import bucketed, drop, release, stored
from .wordhash import Hasher, Texts, mix, slices

LENGTH = 200
KMER = 32
BATCHES = 4
#: Stretches of one k-mer that a task sorts; stretches of a bucket of k-mers; windows sorted at once.
HOT, BUCKET, WINDOWS = 1024, 2048, 1 << 16
_SALT = np.uint64(0xD6E8FEB86659FD93)
_RUN = ["head", "fwd", "back", "ext"]
_PLACE = ["u", "v", "place"]
_MARKS = "u long, v long, mark long"


def reach(length: int) -> tuple[int, int, int]:
    """k-mer size, and how far any window reaches from its suffix: so many bytes to the right, or else so many to the left."""
    kmer = min(KMER, length)
    half = (length - kmer) // 2
    return kmer, length - half, half + 1


def sampled(texts: Texts, length: int = LENGTH) -> dict[str, np.ndarray]:
    """The sampled suffixes of each row: row, lo (its first window), p (from there to the suffix), n (windows), head, fwd, back, ext.

    head holds the first eight bytes, as a number that sorts like the text (of a shorter k-mer: 0).  fwd and back are fingerprints of the reach to each side, 0 where no window of the stretch reaches so
    far; ext is the fingerprint of the whole stretch.
    """
    data, size = texts.data, len(texts.data)
    kmer, right, left = reach(length)
    if not (np.diff(texts.offsets) >= length).any():
        return {k: np.zeros(0, np.int64) for k in ("row", "lo", "p", "n", *_RUN)}
    hasher = Hasher(data)
    at = np.arange(size - kmer + 1)
    low = (hasher.of(at, at + kmer) & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    span, width = length - kmer + 1, 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    chosen = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)  # of the window that starts here
    inside = np.zeros(size + 1, np.int8)
    first, last = texts.offsets[:-1], texts.offsets[1:] - length
    long = last >= first
    inside[first[long]] += 1
    np.add.at(inside, last[long] + 1, -1)
    valid = np.cumsum(inside[:size], dtype=np.int8)[: len(chosen)] > 0
    change = np.ones(len(chosen), bool)
    change[1:] = (chosen[1:] != chosen[:-1]) | ~valid[:-1]
    change[first[long]] = True
    start = np.flatnonzero(valid & change)
    stop = np.append(np.flatnonzero(change | ~valid), len(chosen))
    stop = stop[np.searchsorted(stop, start, "right")]
    p = chosen[start]
    row = np.searchsorted(texts.offsets, start, "right") - 1
    ext = mix(hasher.of(start, stop - 1 + length) + (p - start).astype(np.uint64) * _SALT)
    far = p - (stop - 1) <= length - right  # some window begins so near that it reaches ``right`` bytes on
    fwd = np.where(far, mix(hasher.of(p, np.where(far, p + right, p))), 0)
    deep = p - start >= left
    back = np.where(deep, mix(hasher.of(np.where(deep, p - left, p), p + kmer) + _SALT), 0)
    head = np.zeros(len(p), np.uint64)
    for k in range(8 if kmer >= 8 else 0):
        head = head << np.uint64(8) | data[p + k]
    head ^= np.uint64(1 << 63)
    signed = {k: v.view(np.int64) for k, v in zip(_RUN, (head, fwd, back, ext), strict=True)}
    return {"row": row, "lo": start - texts.offsets[row], "p": p - start, "n": stop - start} | signed


def _suffixes(length: int, *columns: str):
    """(u, v, place) and the asked columns of every sampled suffix; place holds the first window, the distance to the suffix and the windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column("text")):
                s = sampled(texts, length)
                own = batch.select(["u", "v"]).slice(texts.first, len(texts)).take(pa.array(s["row"]))
                place = pa.array((s["lo"] << 32) | (s["p"] << 16) | s["n"])
                yield pa.RecordBatch.from_arrays([*own.columns, place, *(pa.array(s[c]) for c in columns)], names=[*_PLACE, *columns])

    return run


class SuffixLevels:
    """The index family: suffix arrays of runs (head, fwd, back, ext, n, u, v, place) in text order, with sizes in powers of two of a batch.

    A run is a stretch, known by (head, ext), with its number and one of its places.  ``keys`` holds for each level
    the reaches (key, a, z) of its runs to either side, with the least and largest ext, in tables that the next scan merges.
    ``found`` are tables of the keys that the scans have seen with two different stretches.  Levels and reaches are kept
    in buckets, so that a batch is shuffled as it comes in and scans and merges join what lies there.
    """

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []
        self.keys: list[list[DataFrame]] = []
        self.found: list[DataFrame] = []

    @staticmethod
    def _keys(runs: DataFrame) -> DataFrame:
        return runs.select("head", F.explode(F.array("fwd", "back")).alias("key"), "ext").where("key <> 0")

    @classmethod
    def _reaches(cls, runs: DataFrame) -> DataFrame:
        return cls._keys(runs).groupBy("key").agg(F.min("ext").alias("a"), F.max("ext").alias("z"))

    @staticmethod
    def _met(new: DataFrame, level: DataFrame) -> DataFrame:
        """The keys of two tables of reaches that have different stretches."""
        return new.join(level.withColumnsRenamed({"a": "b", "z": "y"}), "key").where("least(a, b) <> greatest(z, y)").select("key")

    @staticmethod
    def _merged_reaches(a: DataFrame, b: DataFrame) -> DataFrame:
        both = a.alias("a").join(b.alias("b"), "key", "full")
        return both.select("key", F.least("a.a", "b.a").alias("a"), F.greatest("a.z", "b.z").alias("z"))

    @staticmethod
    def _run(rows: DataFrame) -> DataFrame:
        runs = rows.groupBy("head", "ext").agg(F.count("*").alias("n"), F.max("fwd").alias("fwd"), F.max("back").alias("back"), *(F.first(c).alias(c) for c in _PLACE))
        return runs.select(*_RUN, "n", *_PLACE)

    @staticmethod
    def _merged_runs(a: DataFrame, b: DataFrame) -> DataFrame:
        one = lambda c: F.coalesce(f"a.{c}", f"b.{c}").alias(c)
        n = (F.coalesce("a.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))).alias("n")
        return a.alias("a").join(b.alias("b"), ["head", "ext"], "full").select("head", one("fwd"), one("back"), "ext", n, *map(one, _PLACE))

    @staticmethod
    def _level(runs: DataFrame) -> DataFrame:
        return bucketed(runs, "level", ["head", "ext"], _RUN)

    def scan(self, new: DataFrame) -> None:
        """Merge-scan the reaches of a batch against themselves and each level for stretches that differ, but agree as far as a window reaches on a side."""
        found = new.where("a <> z").select("key")
        for parts in self.keys:
            while len(parts) > 1:
                b, a = parts.pop(), parts.pop()
                parts.append(bucketed(self._merged_reaches(a, b), "level-keys", ["key"], ["key"]))
                drop(a, b)
            found = found.unionByName(self._met(new, parts[0]))
        self.found.append(stored(found, "found"))

    def merge(self) -> None:
        """Make one level of the last two."""
        (more, b), (size, a) = self.levels.pop(), self.levels.pop()
        self.levels.append((size + more, self._level(self._merged_runs(a, b))))
        drop(a, b)
        last = self.keys.pop()
        self.keys[-1] += last

    def insert(self, suffixes: DataFrame) -> None:
        """Add a batch of sampled suffixes (head, fwd, back, ext, u, v, place); each is rewritten log(batches) times."""
        new = self._level(self._run(suffixes))
        keys = bucketed(self._reaches(new), "level-keys", ["key"], ["key"])
        self.scan(keys)
        self.levels.append((1, new))
        self.keys.append([keys])
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            self.merge()

    def runs(self) -> DataFrame:
        """The runs of all levels, each once."""
        while len(self.levels) > 1:
            self.merge()
        return self.levels[0][1]

    def matches(self) -> DataFrame:
        """The runs that agree with another one on a side of a suffix."""
        found = self.found[0]
        for more in self.found[1:]:
            found = found.unionByName(more)
        # Tables of their own: joins on an aggregate's partitioning couldn't split a key that fills a third of all rows.
        shared = stored(found.distinct(), "shared-keys")
        some = stored(self._keys(self.runs()).join(shared, "key", "left_semi").select("head", "ext").distinct(), "shared-runs")
        matches = stored(self.runs().join(some, ["head", "ext"], "left_semi"), "matches")
        drop(shared, some)
        return matches

    def close(self) -> None:
        drop(*self.found, *(level for _, level in self.levels), *(k for parts in self.keys for k in parts))


def _bodies(length: int):
    """The bytes of each asked stretch, with the hash of its k-mer."""
    kmer = reach(length)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                asked = batch.column("asked")
                row = np.repeat(np.arange(len(batch)), asked.value_lengths().to_numpy())
                flat = asked.flatten()
                place = flat.field("place").to_numpy()
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                lo, p, n = place >> 32, (place >> 16) & 0xFFFF, place & 0xFFFF
                body = [texts[r][a : a + k - 1 + length] for r, a, k in zip(row.tolist(), lo.tolist(), n.tolist(), strict=True)]
                ends = np.cumsum([0, *map(len, body)])
                at = ends[:-1] + p
                key = Hasher(np.frombuffer(b"".join(body), np.uint8)).of(at, at + kmer).view(np.int64)
                own = batch.select(["u", "v"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*own.columns, flat.field("place"), flat.field("full"), pa.array(key), pa.array(body, pa.binary())], names=["u", "v", "place", "full", "kmer", "body"])

    return run


def _windows(batch: pa.RecordBatch | pa.Table, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bodies one after the other, and row and start there of each of their windows."""
    body = batch.column("body")
    body = body.combine_chunks() if isinstance(body, pa.ChunkedArray) else body
    data = np.frombuffer(b"".join(body.to_pylist()), np.uint8)
    n = batch.column("place").to_numpy() & 0xFFFF
    row = np.repeat(np.arange(len(n)), n)
    begin = np.concatenate([[0], np.cumsum(n - 1 + length)[:-1]])
    return data, row, np.arange(len(row)) + np.repeat(begin - np.cumsum(n) + n, n)


def _dense(length: int):
    """Marks of the repeated windows in a bucket of k-mers: a dense suffix array of each k-mer's stretches, compared with its neighbours."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("kmer").combine_chunks()
        kmer, place = table.column("kmer").to_numpy(), table.column("place").to_numpy()
        full = table.column("full").to_numpy()
        done = np.concatenate([[0], np.cumsum(place & 0xFFFF)])
        cuts = np.append(np.flatnonzero(np.diff(kmer)) + 1, len(kmer))
        rows, marks, a = [], [], 0
        while a < len(kmer):
            z = cuts[max(np.searchsorted(done[cuts], done[a] + WINDOWS, "right") - 1, np.searchsorted(cuts, a, "right"))]
            data, row, start = _windows(table.slice(a, z - a), length)
            text = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, length)[start]).view(f"V{length}").ravel().view(f"S{length}")
            order = np.argsort(text, kind="stable")
            near = text[order]
            same = near[1:] == near[:-1]
            again = np.zeros(len(order), bool)
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            again &= ~full[a + row]
            at = np.flatnonzero(again)
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])
            begin = at[new]
            run_of = np.diff(np.append(np.flatnonzero(new), len(at)))
            local = begin - (done[a + row[begin]] - done[a])
            rows.append(a + row[begin])
            marks.append((((place[a + row[begin]] >> 32) + local) << 32) | run_of)
            a = z
        own = table.select(["u", "v"]).take(pa.array(np.concatenate(rows)))
        return own.append_column("mark", pa.array(np.concatenate(marks)))

    return run


def _window_rows(length: int):
    """Fingerprint and mark of each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 1024):
                batch = whole.slice(first, 1024)
                data, row, start = _windows(batch, length)
                h = Hasher(data).of(start, start + length)
                place = batch.column("place").to_numpy()[row]
                local = np.arange(len(row)) - np.searchsorted(row, row)
                own = batch.select(["u", "v", "full"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array((((place >> 32) + local) << 32) | 1), pa.array(h.view(np.int64))], names=["u", "v", "full", "mark", "h"])

    return run


def _partial(docs: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """Marks of single windows: those of stretches that agree in part with others."""
    asked = runs.groupBy(F.col("u").alias("i"), F.col("v").alias("j")).agg(F.collect_list(F.struct("place", (F.col("n") > 1).alias("full"))).alias("asked"))
    texts = docs.join(asked, (F.col("u") == F.col("i")) & (F.col("v") == F.col("j"))).select("u", "v", "text", "asked")
    bodies = stored(texts.mapInArrow(_bodies(length), "u long, v long, place long, full boolean, kmer long, body binary"), "stretches")
    release(docs.sparkSession)
    hot = stored(bodies.groupBy("kmer").count().where(F.col("count") > HOT).select("kmer"), "hot-kmers")
    buckets = max(1, -(-bodies.count() // BUCKET))
    cold = bodies.join(hot, "kmer", "left_anti").withColumn("bucket", F.pmod("kmer", F.lit(buckets)))
    cold = cold.groupBy("bucket").applyInArrow(_dense(length), _MARKS)
    windows = bodies.join(hot, "kmer", "left_semi").select("u", "v", "place", "full", "body")
    windows = stored(windows.mapInArrow(_window_rows(length), "u long, v long, full boolean, mark long, h long"), "windows")
    again = stored(windows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated-windows")
    marks = stored(cold.unionByName(windows.where("not full").join(again, "h", "left_semi").select("u", "v", "mark")), "partial-marks")
    drop(bodies, hot, windows, again)
    return marks


def repeated_windows(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES, index: SuffixLevels | None = None) -> DataFrame:
    """(u, v, marks) of documents (u, v, text) with windows that occur elsewhere too; a mark holds the first of some neighbours and their number."""
    spark, index = docs.sparkSession, index or SuffixLevels()
    for b in range(batches):
        batch = docs.where(F.pmod("u", F.lit(batches)) == b) if batches > 1 else docs
        index.insert(batch.mapInArrow(_suffixes(length, *_RUN), "u long, v long, place long, head long, fwd long, back long, ext long"))
        release(spark)
    matches = index.matches()
    full = stored(index.runs().where("n > 1").select("head", "ext").distinct(), "full")
    index.close()
    release(spark)
    places = docs.mapInArrow(_suffixes(length, "head", "ext"), "u long, v long, place long, head long, ext long")
    whole = places.join(full, ["head", "ext"], "left_semi").select("u", "v", F.expr("place - (place & 4294967295) + (place & 65535)").alias("mark"))
    marks = whole.unionByName(_partial(docs, matches, length))
    marks = stored(marks.groupBy("u", "v").agg(F.collect_set("mark").alias("marks")), "marks")
    release(spark)
    drop(matches, full)
    return marks


def _cut(text: str, length: int, row: str, marks: str, spans: str, kept: str, characters: bool):
    """Each row with the spans that its marks cover and the bytes that remain."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(row)
            column = rows.field(text)
            for texts in slices(column):
                gone, left = [], []
                for i, mark in enumerate(batch.column(marks).slice(texts.first, len(texts)).to_pylist()):
                    body = texts.data[texts.offsets[i] : texts.offsets[i + 1]]
                    if not mark:
                        gone.append([])
                        left.append(body.tobytes())
                        continue
                    m = np.sort(np.array(mark, np.int64))
                    a, z = m >> 32, (m >> 32) + (m & 0xFFFF) - 1 + length
                    z = np.maximum.accumulate(z)
                    new = np.append(True, a[1:] > z[:-1])
                    a, z = a[new], z[np.append(np.flatnonzero(new)[1:] - 1, len(z) - 1)]
                    if characters:
                        inner = np.append((body & 0xC0) == 0x80, False)  # bytes of a character after its first
                        while (more := inner[a]).any():
                            a = a - more
                        while (more := inner[z]).any():
                            z = z + more
                    gone.append([{"start": int(x), "end": int(y)} for x, y in zip(a, z, strict=True)])
                    left.append(b"".join(body[x:y].tobytes() for x, y in zip([0, *z.tolist()], [*a.tolist(), len(body)], strict=True)))
                yield pa.RecordBatch.from_arrays([rows.slice(texts.first, len(texts)), pa.array(gone, kind), pa.array(left, pa.binary())], names=[row, spans, kept])

    return run


def _row_key(doc_id: str, text: str) -> tuple[Column, Column]:
    """Two hashes of a row's id and text: together they tell rows apart, whatever the id's type."""
    return F.xxhash64(F.col(doc_id), F.col(text)), F.xxhash64(F.col(text), F.lit(9), F.col(doc_id))


def remove_repeats(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES, doc_id: str = "doc_id", text: str = "text", characters: bool = False) -> DataFrame:
    """All rows and columns of ``docs`` with ``spans`` (removed byte ranges, maximal) and ``kept`` (remaining bytes).

    A byte goes if a string of ``length`` bytes covering it starts anywhere else too, in the same
    document or another, overlaps included; strings are judged on the input.  Null and empty
    texts, and texts shorter than ``length``, lose nothing; a null keeps empty bytes.  Repeated rows
    repeat each other, so long ones vanish altogether.  Ids may have any type that can be hashed; a null
    id is a value like any other.  Columns named as the added ones are replaced; an empty table gives no row.
    With ``characters`` spans are widened to whole characters, so that what is kept is text.
    """
    docs = docs.drop("spans", "kept")
    u, v = _row_key(doc_id, text)
    slim = docs.where(F.octet_length(F.col(text)) >= length).select(u.alias("u"), v.alias("v"), F.col(text).alias("text"))
    marks = repeated_windows(slim, length, batches)
    keyed = docs.select(u.alias("u"), v.alias("v"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    joined = keyed.join(marks.withColumnsRenamed({"u": "i", "v": "j"}), (F.col("u") == F.col("i")) & (F.col("v") == F.col("j")), "left")
    spans = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("spans", spans), T.StructField("kept", T.BinaryType())])
    return joined.select("row", "marks").mapInArrow(_cut(text, length, "row", "marks", "spans", "kept", characters), schema).select("row.*", "spans", "kept")
