"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text, size=5):
    w = words(text)
    return frozenset(tuple(w[i : i + size]) for i in range(max(len(w) - size, 0) + 1)) if w else frozenset()


def decontaminated(docs, items, window=10):
    wanted = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            wanted[tuple(w[i : i + window])].add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in wanted}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in wanted:
                    hit.update(range(i, i + n))
                    found |= wanted[k]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def linked(docs, threshold=0.8):
    """(doc_id, class_id, n_links) with every pair compared that shares a shingle."""
    sets = [shingles(t) for _, t in docs]
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    shared = Counter()
    for rows in by.values():
        for a in range(len(rows)):
            for b in range(a + 1, len(rows)):
                shared[rows[a], rows[b]] += 1
    pairs = [(a, b) for (a, b), n in shared.items() if n / (len(sets[a]) + len(sets[b]) - n) >= threshold]
    bare = defaultdict(list)
    for i, (_, t) in enumerate(docs):
        if t and not sets[i]:
            bare[t].append(i)
    pairs += [(r[a], r[b]) for r in bare.values() for a in range(len(r)) for b in range(a + 1, len(r))]
    root, links = list(range(len(docs))), Counter()

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        links[a] += 1
        links[b] += 1
        root[find(a)] = find(b)
    least = {}
    for i, (doc, _) in enumerate(docs):
        r = find(i)
        least[r] = min(least.get(r, doc), doc)
    return [(doc, least[find(i)], links[i]) for i, (doc, _) in enumerate(docs)]


def without_repeats(docs, length=200):
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(docs, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((doc, len(t), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out


def conversations(rows, control=()):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns.sort()
        said = "".join(t for _, r, t in turns if r == "assistant")
        out.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest()))
    return out


def check_shards(rows, docs, shards=16):
    """rows: (doc_id, size, crc, law, shard, slot, grown) for docs: (doc_id, text)."""
    want = sorted((d or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs)
    assert sorted((r[0] or 0, r[1], r[2]) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r[4]].append(r[5])
        assert r[3] == "rows" and 0 <= r[4] < shards
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def check_packing(pieces, docs, encode, length=2048):
    """pieces: (doc_id, start, length, crc, doc_tokens, sequence, offset); doc ids differ."""
    import numpy as np

    ids = {d: np.array([*encode(t or ""), 1], "<u4") for d, t in docs}
    covered, sequences = defaultdict(list), defaultdict(list)
    for d, start, n, crc, total, seq, offset in pieces:
        assert n > 0 and total == len(ids[d]) and zlib.crc32(ids[d][start : start + n].tobytes()) == crc
        covered[d].append((start, n))
        sequences[seq].append((offset, n))
    assert covered.keys() == ids.keys()
    for d, parts in covered.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == len(ids[d])
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return sum(len(x) for x in ids.values()) / (len(sequences) * length) if sequences else 1.0
