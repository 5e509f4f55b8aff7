"""Packing along a Hilbert curve: similar documents become neighbours in a sequence.

Each document's token counts are hashed and projected to a few dimensions by random signs; its
place on the Hilbert curve through them orders the corpus by one range sort; neighbours along
the curve are laid end to end and cut into sequences of exactly the given length.  Only the
last sequence of each sorted partition is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .storage import stored
from .wordhash import Hasher, Texts, slices

LENGTH = 2048
DIMENSIONS = 4
BITS = 15
FEATURES = 1024
#: Distinct pieces of text whose ids a worker remembers.
REMEMBERED = 1_000_000

_BLANK, _LETTER, _DIGIT, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[32, 10]] = _BLANK
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes that a text of plain Latin letters, digits and marks doesn't have: controls, apostrophes
#: (contractions), lead bytes of marks and of letters beyond U+024F.
_ODD = np.zeros(256, bool)
_ODD[:32] = _ODD[39] = _ODD[127] = _ODD[0xC2] = _ODD[0xCA:] = True
_ODD[10] = False


class PieceTokenizer:
    """Ids of texts by a tokenizer that splits letters, single digits and other marks before its merges.

    Texts of plain Latin letters are split so here, and the ids of each distinct piece, asked
    from the tokenizer once, are remembered by its hash.  All other texts go to the tokenizer whole,
    and so does every text if a probe shows that the tokenizer doesn't split so.
    """

    PROBE = "The Quick brown fox's, 2024 über-größte Éa don't (a1b22) x_y! \n\n Ab  cd  "

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self._forget()
        self.splits = True
        probes = [self.PROBE.replace("'", ""), *self.PROBE.replace("'", "").split()]
        got = self.encode(next(slices(pa.array(probes))))
        self.splits = all(g.tolist() == self.tokenizer.encode(p, add_special_tokens=False).ids for g, p in zip(got, probes, strict=True))

    def _forget(self) -> None:
        self.hashes, self.first, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        """Encode many pieces as one text; offsets tell whose each token is."""
        encoded = self.tokenizer.encode(" ".join(pieces), add_special_tokens=False)
        starts = np.cumsum([0, *(len(c) + 1 for c in pieces[:-1])])
        ids = np.array(encoded.ids, np.uint32)
        at = np.searchsorted(starts, np.fromiter((o[0] for o in encoded.offsets), np.int64, len(ids)), "right") - 1
        count = np.bincount(at, minlength=len(pieces))
        first = np.cumsum(count) - count + len(self.ids)
        self.ids = np.concatenate([self.ids, ids])
        order = np.argsort(merged := np.concatenate([self.hashes, hashes]), kind="stable")
        self.hashes, self.first, self.count = merged[order], np.concatenate([self.first, first])[order], np.concatenate([self.count, count])[order]

    def encode(self, texts: Texts) -> list[np.ndarray]:
        if len(self.hashes) > REMEMBERED:
            self._forget()
        data, kind = _LOWER[texts.data], _KIND[texts.data]
        odd = _ODD[texts.data]
        if len(data) > 1:  # multiplication and division signs, capital I with a dot
            pair = data[:-1].astype(np.uint16) << 8 | data[1:]
            odd[:-1] |= (pair == 0xC397) | (pair == 0xC3B7) | (pair == 0xC4B0)
        filled = np.flatnonzero(np.diff(texts.offsets))
        plain = np.ones(len(texts), bool)
        if len(filled):
            plain[filled] = self.splits & ~np.logical_or.reduceat(odd, texts.offsets[:-1][filled])
        cut = np.ones(len(data) + 1, bool)
        cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        cut[texts.offsets] = True
        start = np.flatnonzero(cut[:-1])
        end = np.append(start[1:], len(data))
        row = np.searchsorted(texts.offsets, start, "right") - 1
        keep = (kind[start] != _BLANK) & plain[row]
        start, end, row = start[keep], end[keep], row[keep]
        h = Hasher(data).of(start, end)
        distinct, one, place = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, distinct)
        new = np.flatnonzero((at == len(self.hashes)) | (self.hashes[np.minimum(at, max(len(self.hashes) - 1, 0))] != distinct) if len(self.hashes) else np.ones(len(distinct), bool))
        if len(new):
            body = data.tobytes()
            self._learn(distinct[new], [body[start[k] : end[k]].decode() for k in one[new]])
            at = np.searchsorted(self.hashes, distinct)
        n = self.count[at][place]
        ids = self.ids[np.repeat(self.first[at][place] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        upto = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(row, np.arange(len(texts) + 1))]
        out = [ids[upto[i] : upto[i + 1]] for i in range(len(texts))]
        rest = np.flatnonzero(~plain)
        if len(rest):
            body = [texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes().decode() for i in rest]
            for i, e in zip(rest, self.tokenizer.encode_batch_fast(body, add_special_tokens=False), strict=True):
                out[i] = np.array(e.ids, np.uint32)
        return out


@cache
def _tokenizer(path: str) -> PieceTokenizer:
    return PieceTokenizer(path)


def hilbert_key(x: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of each row of unsigned coordinates below ``2**bits`` (transpose form, most significant bit first)."""
    x = x.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def document_keys(ids: list[np.ndarray]) -> np.ndarray:
    """Curve keys of documents: signed sums of their hashed token counts, scaled by the counts' norm."""
    signs = np.random.default_rng(10).integers(0, 2, (FEATURES, DIMENSIONS)) * 2.0 - 1
    out = np.zeros((len(ids), DIMENSIONS))
    for i, own in enumerate(ids):
        counts = np.bincount((own.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(22), minlength=FEATURES)
        out[i] = counts @ signs / max(np.sqrt((counts.astype(float) ** 2).sum()), 1.0)
    unit = 1 / (1 + np.exp(-1.702 * out))  # near the normal distribution's, so that cells fill evenly
    return hilbert_key(np.minimum((unit * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))


def _tokenized(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for whole in batches:
            for texts in slices(whole.column("text")):
                batch = whole.slice(texts.first, len(texts))
                ids = [np.append(own, np.uint32(end)) for own in _tokenizer(path).encode(texts)]
                packed = [press.compress(x.astype(np.uint16).tobytes() if x.max() < 65536 else x.tobytes()) for x in ids]
                wide = [bool(x.max() >= 65536) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(document_keys(ids)), pa.array(wide), pa.array(packed, pa.binary())], names=["doc_id", "key", "wide", "ids"]
                )

    return run


def _packed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdDecompressor()
        me, sequence, used = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            rows = []
            for doc, wide, packed in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "wide", "ids")), strict=True):
                ids = np.frombuffer(press.decompress(packed), np.uint32 if wide else np.uint16).astype("<u4")
                start = 0
                while start < len(ids):
                    n = min(len(ids) - start, length - used)
                    rows.append((doc, start, n, zlib.crc32(ids[start : start + n].tobytes()), len(ids), (me << 36) + sequence, used, ids[start : start + n].view(np.int32)))
                    start, used = start + n, used + n
                    if used == length:
                        sequence, used = sequence + 1, 0
            if rows:
                columns = list(zip(*rows, strict=True))
                parts = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in columns[7]])]).astype(np.int32)), pa.array(np.concatenate(columns[7])))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:7]), parts], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    return run


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, end: int = 1, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of all documents in sequences of ``length`` tokens, with their ids.

    A document is its tokens and then ``end``; null and empty texts are ``end`` alone.  A piece has
    doc_id, start (ids of its document before it), length, ids_crc32, doc_tokens, sequence_id,
    offset (in the sequence) and ids.  A sequence is full, but for the last one of each sorted
    partition.  Ties on the curve are ordered by doc_id and spread over partitions with it; repeated
    rows and null doc_ids are documents like any other.  An empty table gives no piece; further
    columns are ignored.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    tokens = stored(source.mapInArrow(_tokenized(tokenizer, end), "doc_id long, key long, wide boolean, ids binary"), "tokens")
    lot = F.xxhash64("doc_id", "ids")
    ordered = tokens.withColumn("lot", lot).repartitionByRange("key", "doc_id", "lot").sortWithinPartitions("key", "doc_id", "lot")
    return ordered.select("doc_id", "wide", "ids").mapInArrow(_packed(length), PIECES + ", ids array<int>")
