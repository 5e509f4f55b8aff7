"""Operators 11 to 13 and their running sums against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lamella.llm import entry, pattern_packing as pat, prefix_trie as trie, vector_codes as vec
from lamella.llm.running import running_sums

SMALL = "/root/testdata/sf0.001"
TURNS = "one string, conv_id long, turn long, role string, text string, said long, place string, digest string, owner string"


def plain_trie(rows, group=100, most=6):
    """Nodes of the rebuilt conversations of (conv_id, turn, role, text) rows, as tuples."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    told = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in told.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - int(np.fmod(c, group))
        built[c] = told.get(base, [])[:h] + turns[h:]
    members = defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own_ in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(own_) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, own_ in members.items():
        ends = ",".join(str(c) for c in sorted(own_) if len(built[c]) == len(p))
        out.append((min(own_), len(p), min(members[p[:-1]]) if p else None, len(own_), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def trie_rows(spark, rows):
    df = spark.createDataFrame([("x", *r, 1, "p", "d", "o") for r in rows], TURNS)
    nodes = trie.prefix_trie(*trie.grafted(trie.numbered_turns(df)))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return [tuple(r) for r in nodes.select(*columns).collect()]


def order(rows):
    return sorted(rows, key=str)


def test_trie(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SMALL}/conversations.parquet").select(["conv_id", "turn", "role", "text"]).to_pylist()]
    assert order(trie_rows(spark, rows)) == order(plain_trie(rows))


def test_trie_of_odd_rows(spark):
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 40), *range(95, 110), -1, -250, 1 << 40]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, rng.choice([t, None, 3]), rng.choice(["user", None, "", "a\0b"]), rng.choice(["hi", "Hé", None, "", "ok" * 9])))
    rows += rows[:25]  # repeated rows
    rows += [(None, 1, "user", "nobody's"), (7, 99, "user", "long " * 40_000)]
    assert order(trie_rows(spark, rows)) == order(plain_trie(rows))
    assert trie_rows(spark, []) == []


def test_trie_of_long_and_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "SEGMENT", 8)
    long = [("user", f"turn {i}") for i in range(60)]
    rows = []
    for c in range(400, 460):
        cut = 60 if c % 3 else c - 400  # two thirds are equal, the others leave at a turn of their own
        rows += [(c, i, *x) for i, x in enumerate(long[:cut] + ([("user", f"own {c}")] if cut < 60 else []))]
    assert order(trie_rows(spark, rows)) == order(plain_trie(rows))


def test_chains_stay_below_the_turns(spark):
    """A long conversation and one that leaves it late: rows of chains and the chains above them, not pairs of nodes."""
    rows = [(0, i, "user", str(i)) for i in range(3000)] + [(100, i, "user", str(i) if i < 2990 else "other") for i in range(3000)]
    got = {(r[0], r[1]): r for r in trie_rows(spark, rows)}
    assert len(got) == 3001 + 10 and got[0, 2990][4] == 2 and got[0, 1][5] == 2 and got[0, 3000][5] == 1


def test_running_sums(spark):
    rng = random.Random(2)
    rows = [(rng.choice([0, 0, 0, 1, 2, 5]), i, rng.randint(0, 9)) for i in range(5000)]
    out = running_sums(spark.createDataFrame(rows, "k long, o long, v long").repartition(7), "k", ["o"], ["v"]).collect()
    sums, want = Counter(), {}
    for k, o, v in sorted(rows):
        sums[k] += v
        want[k, o] = sums[k]
    assert {(r["k"], r["o"]): r["v_upto"] for r in out} == want and len(out) == 5000
    assert running_sums(spark.createDataFrame([], "k long, o long, v long"), "k", ["o"], ["v"]).count() == 0


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error) rows and codebooks of (vec_id, label, integers)."""
    kept = sorted((r for r in rows if r[2] is not None and None not in r[2]), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(kept[0][2]) // parts
    cut = [[r[2][p * width : (p + 1) * width] for p in range(parts)] for r in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda x, book: min(range(len(book)), key=lambda k: (square(x, book[k]), k))
    for _ in range(rounds):
        for p in range(parts):
            lots = defaultdict(list)
            for c in cut:
                lots[near(c[p], books[p])].append(c[p])
            for k, own in lots.items():
                books[p][k] = [sum(v) // len(own) for v in zip(*own, strict=True)]
    codes = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(square(c[p], books[p][k]) for p, k in enumerate(code)) for c, code in zip(cut, codes, strict=True)]
    by = Counter()
    for r, e in zip(kept, errors, strict=True):
        by[r[1]] += e
    return [(r[0], "".join(f"{k:02x}" for k in code), e, by[r[1]]) for r, code, e in zip(kept, codes, errors, strict=True)], books


VECTORS = "code string, vec_id long, label int, embedding array<long>, x int, error string, of int, part int"


def coded(spark, rows, **more):
    df = spark.createDataFrame([("c", *r, 1, "e", 2, 3) for r in rows], VECTORS)
    out, books = vec.compress(df.repartition(3), **more)
    return [tuple(r) for r in out.select("vec_id", "code", "error", "label_error").collect()], books


@pytest.mark.parametrize("scale", [3, 5000, 1 << 27])
def test_codes(spark, scale):
    rng = random.Random(scale)
    rows = [(i, rng.choice([0, 0, 1, None]), [rng.randint(-scale, scale) for _ in range(16)]) for i in range(120)]
    rows += [(None, 1, rows[3][2]), (5, 1, rows[4][2]), rows[7], rows[7], (200, 0, None), (201, 0, [1, None] * 8), (202, None, [0] * 16)]
    got, books = coded(spark, rows)
    want, plain = plain_codes(rows)
    assert order(got) == order(want) and books == plain


def test_codes_of_few_rows(spark):
    assert coded(spark, []) == ([], [[]] * 8)
    rows = [(3, 1, [1] * 8), (1, 1, [5] * 8), (2, None, [5] * 8)]
    got, books = coded(spark, rows)
    want, plain = plain_codes(rows)
    assert order(got) == order(want) and books == plain
    got, _ = coded(spark, [(1, 1, []), (2, 1, [])])
    assert order(got) == [(1, "00" * 8, 0, 0), (2, "00" * 8, 0, 0)]
    for bad in ([(1, 1, [1] * 8), (2, 1, [1] * 16)], [(1, 1, [1] * 9)]):
        with pytest.raises(ValueError, match="length"):
            coded(spark, bad)


def test_screening_never_loses_the_nearest():
    rng = np.random.default_rng(1)
    for scale in (2, 1000, 1 << 13, 1 << 24, 1 << 29, 1 << 40):
        c = rng.integers(-scale, scale + 1, (16, 8))
        c[9] = c[2]  # a tie of entries
        x = np.concatenate([rng.integers(-scale, scale + 1, (300, 8)), c, (c[[3]] + c[[4]]) // 2, np.repeat(c, 3, 0) + rng.integers(-1, 2, (48, 8))])
        exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(row, entry_, strict=True)) for entry_ in c] for row in x]
        able = vec.screened(x, c)
        for k, row in enumerate(exact):
            assert all(able[k, i] for i, d in enumerate(row) if d == min(row))
        assert vec.nearest_entries(x, c).tolist() == [row.index(min(row)) for row in exact]
    few = vec.screened(rng.integers(-2000, 2000, (1000, 8)), rng.integers(-2000, 2000, (16, 8)))
    assert few.sum() < 1100  # the intervals are narrow enough to leave little to do again


def test_patterns():
    rows = pat.patterns(12, 3)
    few = [tuple(n for n in (a, b, 12 - a - b) if n) for a in range(13) for b in range(13) if a >= b >= 12 - a - b >= 0]
    more = [(3,) * 4, (2,) * 6, (1,) * 12]
    assert sorted(rows) == sorted(few + more) and (5, 5, 2) in rows


def test_least_squares():
    rng = np.random.default_rng(4)
    for _ in range(30):
        a, b = rng.random((8, 20)), rng.normal(size=8)
        x = pat.nonnegative_least_squares(a, b)
        slope = a.T @ (b - a @ x)
        assert (x >= 0).all() and slope.max() < 1e-8 and np.abs(slope[x > 0]).max(initial=0) < 1e-8
    assert not pat.nonnegative_least_squares(rng.random((4, 9)), -np.ones(4)).any()
    assert not pat.nonnegative_least_squares(rng.random((4, 9)), np.zeros(4)).any()


@pytest.mark.parametrize("kind", ["flat", "short", "long", "hot", "one", "none"])
def test_plan(kind):
    rng = random.Random(7)
    lengths = {
        "flat": [rng.randint(1, 512) for _ in range(3000)], "short": [rng.randint(1, 40) for _ in range(3000)], "long": [rng.randint(300, 512) for _ in range(500)],
        "hot": [100] * 2000 + [rng.randint(1, 512) for _ in range(1000)], "one": [512] * 5 + [7], "none": [],
    }[kind]
    histogram = Counter(lengths)
    intervals, sequences = pat.plan(histogram, 512)
    used, at = defaultdict(list), 0
    ordered = sorted(lengths)
    for i, (first, sequence, many, offset, n) in enumerate(intervals.tolist()):
        end = intervals[i + 1][0] if i + 1 < len(intervals) else len(lengths)
        assert first == at
        for place in range(first, end):
            assert ordered[place] == n
            used[sequence + (place - first) // many].append((offset + (place - first) % many * n, n))
        at = end
    assert at == len(lengths) and len(used) == sequences
    for spans in used.values():
        place = 0
        for offset, n in sorted(spans):
            assert offset == place
            place += n
        assert place <= 512
    least = max(-(-sum(lengths) // 512), sum(n > 256 for n in lengths))
    assert sequences <= least * 1.03 + 1
    if kind == "flat":
        lots = pat.fitted(histogram, 512)
        assert sum(count for held, count in lots if sum(n * m for n, m in held) == 512) > 0.5 * sequences and all(sum(n * m for n, m in held) <= 512 for held, _ in lots)


def test_pack_patterns(spark):
    from tokenizers import Tokenizer

    path = entry.tokenizer_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SMALL}/documents.parquet").to_pylist()]
    docs += [(None, None), (None, ""), (5, "again"), (5, "again"), (900, "word " * 30_000), (901, "Ünï <|endoftext|> 日本")]
    df = spark.createDataFrame([("l", d, t, 1, 2, "p") for d, t in docs], "length string, doc_id long, text string, piece int, row int, packed string")
    out = pat.pack_patterns(df, path).collect()
    pieces, rows = Counter(), defaultdict(list)
    for d, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for k, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            pieces[d, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])) for r in out) == pieces
    for r in out:
        rows[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in rows.values():
        place = 0
        for offset, n in sorted(spans):
            assert offset == place
            place += n
        assert place <= 4096
    assert len(rows) <= -(-sum(k[3] * n for k, n in pieces.items()) // 4096) + 1
    text_ids = pat.pack_patterns(df.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")), path)
    assert text_ids.schema["doc_id"].dataType.simpleString() == "string" and text_ids.count() == len(out)
    assert pat.pack_patterns(df.limit(0), path).count() == 0
