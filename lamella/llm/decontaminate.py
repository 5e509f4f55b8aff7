"""Benchmark decontamination with an FM-index for each training shard.

A shard is a run of whole documents.  Its words are numbered by hash order, its suffix array is
built by prefix doubling (documents end with a sentinel of their own, so nothing crosses them), and the
Burrows-Wheeler transform is kept in a wavelet matrix.  Windows of the benchmark are searched
backwards, all at once, by rank; rows of the surviving intervals walk back to a sampled suffix
position; hit words of overlapping occurrences merge into spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .storage import drop, fresh, stored
from .wordhash import Texts, Words, slices, words

WINDOW = 10
SAMPLE = 8
#: Windows and their items that are broadcast at once; a larger benchmark takes more passes.
PORTION = 400_000


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``s``; its last symbol, and every document's end, is unique."""
    rank = s.astype(np.int64)
    n = len(s)
    sa = np.argsort(rank, kind="stable")
    step = 1
    r = rank[sa]
    new = np.concatenate([[True], r[1:] != r[:-1]])
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while not new.all():
        # Only suffixes that still tie are sorted again: rank is the first place of their group.
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        at = sa[tied]
        after = at + step
        key = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(rank[at] * np.int64(n + 1) + key, kind="stable")
        at = at[order]
        sa[tied] = at
        g, k = rank[at], key[order]
        first = np.concatenate([[True], (g[1:] != g[:-1]) | (k[1:] != k[:-1])])
        new[tied] = first
        rank[at] = np.maximum.accumulate(np.where(first, tied, 0))
        step *= 2
    return sa


class FMIndex:
    """Counts and places of phrases in a sequence of numbers; symbol numbers are below ``symbols``."""

    def __init__(self, s: np.ndarray, symbols: int, sample: int = SAMPLE):
        sa = suffix_array(s)
        self.n = len(s)
        bwt = s[sa - 1]
        self.below = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=symbols))])
        self.bits = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        level = bwt
        for b in range(self.bits - 1, -1, -1):
            bit = (level >> b) & 1
            ones = np.zeros(self.n + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(self.n - int(ones[-1]))
            one = bit.astype(bool)
            level = np.concatenate([level[~one], level[one]])
        marked = sa % sample == 0
        self.marks = np.concatenate([[0], np.cumsum(marked)]).astype(np.int32)
        self.places = sa[marked]

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol is among the first ``i`` of the transform."""
        start = np.zeros_like(i)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            a, b = ones[start], ones[i]
            start, i = np.where(bit, zeros + a, start - a), np.where(bit, zeros + b, i - b)
        return i - start

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of phrases, given as rows that end in the last column; negative symbols never occur."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        width = phrases.shape[1]
        for k in range(width):
            go = np.flatnonzero((high > low) & (lengths > k))
            if not len(go):
                break
            c = phrases[go, width - 1 - k]
            high[go[c < 0]] = low[go[c < 0]]
            go, c = go[c >= 0], c[c >= 0]
            low[go], high[go] = self.below[c] + self.rank(c, low[go]), self.below[c] + self.rank(c, high[go])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by walking back to sampled ones."""
        out, step, row, who = np.zeros(len(rows), np.int64), 0, rows.copy(), np.arange(len(rows))
        while len(who):
            at = self.marks[row]
            here = self.marks[row + 1] > at
            out[who[here]] = self.places[at[here]] + step
            row, who = row[~here], who[~here]
            if len(who):
                i, symbol = row, np.zeros_like(row)
                start = np.zeros_like(row)
                for ones, zeros in zip(self.ones, self.zeros, strict=True):
                    bit = ones[i + 1] > ones[i]
                    symbol = symbol * 2 + bit
                    start = np.where(bit, zeros + ones[start], start - ones[start])
                    i = np.where(bit, zeros + ones[i], i - ones[i])
                row = self.below[symbol] + (i - start)
            step += 1
        return out


def _item_windows(size: int):
    """(window, item) of each item: its words' hashes one after the other; a null id stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item").to_pylist()
            for texts in slices(batch.column("text")):
                w = words(texts)
                h = w.hashes
                cut, item = [], []
                for i in range(len(texts)):
                    own = h[w.rows[i] : w.rows[i + 1]]
                    n = max(len(own) - size, 0) + 1 if len(own) else 0
                    cut += [own[k : k + size].tobytes() for k in range(n)]
                    item += [ids[texts.first + i]] * n
                yield pa.RecordBatch.from_arrays([pa.array(cut, pa.binary()), pa.array(item, pa.string())], names=["window", "item"])

    return run


def benchmark_windows(benchmark: DataFrame, size: int, item_id: str, item_text: str) -> DataFrame:
    """(window, items): the distinct windows of all items, with the sorted ids of those that have it."""
    told = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text"))
    cut = told.mapInArrow(_item_windows(size), "window binary, item string")
    return cut.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _phrases(portion: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """Windows as rows of word hashes (right-aligned), their lengths, and the items of each."""
    found = portion.column("window").to_pylist()
    lengths = np.array([len(k) // 8 for k in found], np.int64)
    rows = np.zeros((len(found), size), np.uint64)
    for i, k in enumerate(found):
        rows[i, size - lengths[i] :] = np.frombuffer(k, np.uint64)
    return rows, lengths, portion.column("items").to_pylist()


def _hits(phrases: np.ndarray, lengths: np.ndarray, w) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, row, word) of every occurrence in the shard ``w``; word counts from the shard's first."""
    docs, n = len(w.rows) - 1, len(w.starts)
    vocabulary, number = np.unique(w.hashes, return_inverse=True)
    s = np.empty(n + docs, np.int64)
    s[np.arange(n) + np.repeat(np.arange(docs), np.diff(w.rows))] = number + docs
    s[w.rows[1:] + np.arange(docs)] = np.arange(docs)
    index = FMIndex(s, docs + len(vocabulary))
    place = np.searchsorted(vocabulary, phrases)
    known = (place < len(vocabulary)) & (vocabulary[np.minimum(place, len(vocabulary) - 1)] == phrases)
    low, high = index.search(np.where(known, place + docs, -1), lengths)
    some = np.flatnonzero(high > low)
    count = (high - low)[some]
    rows = np.repeat(low[some] - np.cumsum(count) + count, count) + np.arange(count.sum())
    at = index.locate(rows)
    doc = np.searchsorted(w.rows[1:] + np.arange(docs), at, "right")
    return np.repeat(some, count), doc, at - doc


def _search(texts: Texts, w: Words, phrases: np.ndarray, lengths: np.ndarray, items: list[list[str]]) -> tuple[np.ndarray, list[set[str]]]:
    """Which words of the shard are hit, and the items that each text has."""
    hit, of = np.zeros(len(w.starts) + 1, np.int64), [set() for _ in range(len(texts))]
    if len(w.starts) and len(phrases):
        which, doc, at = _hits(phrases, lengths, w)
        np.add.at(hit, at, 1)
        np.add.at(hit, at + lengths[which], -1)
        for p, d in set(zip(which.tolist(), doc.tolist(), strict=True)):
            of[d].update(items[p])
    return np.cumsum(hit[:-1]) > 0, of


def _ranges(inside: np.ndarray) -> np.ndarray:
    """First and end of each run of true."""
    return np.flatnonzero(np.diff(np.concatenate([[0], inside, [0]]))).reshape(-1, 2)


_RANGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _judged(rows: pa.RecordBatch, names: list[str], texts: Texts, w: Words, inside: np.ndarray, of: list) -> pa.RecordBatch:
    """``rows`` with n_words, n_hit, items and spans."""
    before = np.concatenate([[0], np.cumsum(inside)])
    spans: list[list[dict[str, int]]] = [[] for _ in range(len(texts))]
    n_hit = np.diff(before[w.rows])
    for d in np.flatnonzero(n_hit):
        a = w.rows[d]
        spans[d] = [{"start": int(w.starts[a + p] - texts.offsets[d]), "end": int(w.ends[a + q - 1] - texts.offsets[d])} for p, q in _ranges(inside[a : w.rows[d + 1]])]
    added = [pa.array(np.diff(w.rows)), pa.array(n_hit), pa.array([sorted(x) for x in of], pa.list_(pa.string())), pa.array(spans, _RANGES)]
    return pa.RecordBatch.from_arrays([*rows.columns, *added], names=names)


def _scan(found, size: int, text: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = _phrases(found.value, size)
        for batch in batches:
            for texts in slices(batch.column(text)):
                w = words(texts)
                yield _judged(batch.slice(texts.first, len(texts)), names, texts, w, *_search(texts, w, *phrases))

    return run


def _partly(found, size: int):
    """Word ranges and items of the texts that hold windows of a portion."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = _phrases(found.value, size)
        for batch in batches:
            for texts in slices(batch.column("text")):
                w = words(texts)
                inside, of = _search(texts, w, *phrases)
                some = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(inside)])[w.rows]))
                ranges = [[{"start": int(p), "end": int(q)} for p, q in _ranges(inside[w.rows[d] : w.rows[d + 1]])] for d in some]
                own = batch.select(["u", "v"]).slice(texts.first, len(texts)).take(pa.array(some))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array([sorted(of[d]) for d in some], pa.list_(pa.string())), pa.array(ranges, _RANGES)], names=["u", "v", "items", "ranges"])

    return run


def _joined(text: str, items: str, ranges: str, names: list[str]):
    """What the portions have found, as one answer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(text)):
                w, rows = words(texts), batch.slice(texts.first, len(texts))
                edge = np.zeros(len(w.starts) + 1, np.int64)
                for first, own in zip(w.rows[:-1], rows.column(ranges).to_pylist(), strict=True):
                    for r in own or ():
                        edge[first + r["start"]] += 1
                        edge[first + r["end"]] -= 1
                of = [x or [] for x in rows.column(items).to_pylist()]
                kept = rows.select([n for n in rows.schema.names if n not in (items, ranges)])
                yield _judged(kept, names, texts, w, np.cumsum(edge[:-1]) > 0, of)

    return run


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_hit, items and spans (byte ranges of hit words, merged) of benchmark windows.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is
    one window.  A null or empty text has no words and no hits; so has every text if the
    benchmark is empty.  Repeated rows are each judged.  Items with a null id make hits and spans,
    but aren't in items; equal items count each.  Columns of ``docs`` named as the added ones are
    replaced; the others stay.  The distinct windows are a table made by a job; the tasks get it as
    a broadcast while it has at most ``PORTION`` windows and items.  A larger one is dealt out to portions, each
    broadcast alone and searched in a job of its own; what these find is joined by the texts' hashes.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_words", "n_hit", "items", "spans")
    long, ranges = T.LongType(), T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    added = [T.StructField("n_words", long), T.StructField("n_hit", long), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", ranges)]
    schema = T.StructType([*docs.schema.fields, *added])
    table = stored(benchmark_windows(benchmark, window, item_id, item_text), "windows")
    portions = max(1, -(-(table.agg(F.sum(F.size("items") + 1)).first()[0] or 0) // PORTION))
    part = lambda k: spark.sparkContext.broadcast(table.where(F.pmod(F.xxhash64("window"), F.lit(portions)) == k).toArrow())
    if portions == 1:
        return docs.mapInArrow(_scan(part(0), window, text, schema.names), schema)
    u, v = F.xxhash64(F.col(text)), F.xxhash64(F.lit(1), F.col(text))
    distinct = docs.select(u.alias("u"), v.alias("v"), F.col(text).alias("text"))
    found = None
    for k in range(portions):
        windows = part(k)
        one = stored(distinct.mapInArrow(_partly(windows, window), "u long, v long, items array<string>, ranges array<struct<start:int,end:int>>"), "portion")
        windows.unpersist()
        found = one if found is None else found.unionByName(one)
    a, b, i, r = fresh(docs, "text_u", "text_v", "found_items", "found_ranges")
    gather = lambda c: F.array_distinct(F.flatten(F.collect_set(c)))
    found = stored(found.groupBy(F.col("u").alias(a), F.col("v").alias(b)).agg(gather("items").alias(i), gather("ranges").alias(r)), "found")
    drop(table)
    both = docs.join(found, (u == F.col(a)) & (v == F.col(b)), "left").drop(a, b)
    return both.mapInArrow(_joined(text, i, r, schema.names), schema)


def remove_spans(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with the byte ranges in ``spans`` cut out of the texts; rows without spans are left as they are."""
    body = F.col(text).cast("binary")
    ends = F.concat(F.array(F.lit(0)), F.col(f"{spans}.end"))
    starts = F.concat(F.col(f"{spans}.start"), F.array(F.octet_length(text)))
    between = F.transform(F.arrays_zip(ends.alias("a"), starts.alias("b")), lambda x: F.substring(body, x.a + 1, x.b - x.a))
    kept = F.aggregate(between, F.lit(b""), lambda out, x: F.concat(out, x)).cast("string")
    return docs.withColumn(text, F.when(F.size(spans) > 0, kept).otherwise(F.col(text)))


def remove_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the benchmark's windows: their words are cut, and again where a cut brings words together to a new window.

    Only the texts that were cut are judged again; each round takes words from them, so the rounds end, with no word hit.
    Other texts, null and empty ones too, are left as they are.  Columns named as those of :func:`find_benchmark` go; repeated
    rows are each cut; an empty table gives no row.
    """
    todo, clean = docs.drop("n_words", "n_hit", "items", "spans"), None
    columns = todo.columns
    while True:
        found = stored(find_benchmark(todo, benchmark, window, text, item_id, item_text), "judged")
        free = found.where("n_hit = 0").select(*columns)
        clean = free if clean is None else clean.unionByName(free)
        hit = found.where("n_hit > 0")
        if hit.isEmpty():
            return clean
        todo = remove_spans(hit, text).select(*columns)
