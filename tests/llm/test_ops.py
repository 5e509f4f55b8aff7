"""Operators against plain versions: a small driver table, and a messy one with every odd case."""

import math
import random
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute

from lamella.llm import chat_format as chat, decontaminate as dec, entry, jaccard_join as jac, packing as pac, sharding as sha, suffix_dedup as suf, topk_search as top, toxicity as tox, url_filter as url
from lamella.llm.components import connected_components
from lamella.llm.quality import quality_training, score_quality

SMALL = "/root/testdata/sf0.001"
CLASHING = "row string, text string, doc_id long, key long, n long, kmer string, spans string, shard string, part int, u string, c string, toxic int"


def table(name):
    return pq.read_table(f"{SMALL}/{name}.parquet").to_pylist()


def messy_rows():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 9)))
    passage = " ".join(word() for _ in range(90))
    long = " ".join(word() for _ in range(60_000))
    near = passage.split()
    near[40] = "changed"
    texts = ["", "   \n", "?!", "?!", "a b", "A B", "one", passage, passage, " ".join(near), passage + " and more " + word(), "x" * 450, "é" * 300, long, "ü" + passage, "Und " * 200, word() + " " + passage[:260]]
    texts += [" ".join(word() for _ in range(rng.randint(1, 150))) for _ in range(30)]
    return [(i, t) for i, t in enumerate(texts)] + [(100, None), (101, None), (5, "A B"), (5, "A B")]


@pytest.fixture(scope="module")
def messy(spark):
    rows = messy_rows()
    df = spark.createDataFrame([("r", t, d, 1, 2, "k", "s", "h", 3, "u", "c", 1) for d, t in rows], CLASHING)
    return rows, df


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], CLASHING)


def same(df, want, *columns):
    got = sorted(str(tuple(r[c] for c in columns)) for r in df.collect())
    assert got == sorted(map(str, want))


@pytest.mark.parametrize("name", list(entry.SQL))
def test_equals_sql(spark, name):
    sql = duckdb.connect()
    for f in Path(SMALL).glob("*.parquet"):
        sql.sql(f"create view {f.stem} as select * from '{f}'")
    want, df = sql.sql(entry.SQL[name]), entry.QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == sorted(want.columns)
    same(df, want.fetchall(), *want.columns)


def test_repeats(spark, messy, empty):
    rows, df = messy
    out = suf.remove_repeats(df)
    assert out.schema["row"].dataType.simpleString() == "string"
    n = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    digest = out.select("doc_id", n.alias("a"), (n - F.octet_length("kept")).alias("b"), F.size("spans").alias("s"), F.sha2("kept", 256).alias("h"))
    same(digest, brute.without_repeats(rows), "doc_id", "a", "b", "s", "h")
    assert suf.remove_repeats(empty).count() == 0


def test_repeats_do_not_depend_on_batches(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    one, five = (suf.remove_repeats(docs, batches=b).select("doc_id", F.sha2("kept", 256).alias("h")) for b in (1, 5))
    assert one.exceptAll(five).count() == 0


def test_repeats_fuzz(spark):
    rng = random.Random(5)
    base = "".join(rng.choice("abcd ") for _ in range(3000))
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            a = rng.randrange(len(base) - 400)
            parts.append(base[a : a + rng.randint(150, 320)] if rng.random() < 0.6 else "".join(rng.choice("wxyz ") for _ in range(rng.randint(0, 150))))
        texts.append("".join(parts))
    rows = list(enumerate(texts))
    out = suf.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    n = F.octet_length("text").cast("long")
    same(out.select("doc_id", n.alias("a"), (n - F.octet_length("kept")).alias("b"), F.size("spans").alias("s"), F.sha2("kept", 256).alias("h")), brute.without_repeats(rows), "doc_id", "a", "b", "s", "h")


def suffix_rows(spark, texts):
    slim = spark.createDataFrame(list(enumerate(texts)), "u long, text string").withColumn("v", F.lit(0).cast("long"))
    return slim.mapInArrow(suf._suffixes(200, *suf._RUN), "u long, v long, place long, head long, fwd long, back long, ext long")


def test_levels_merge_geometrically(spark):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    index, shared = suf.SuffixLevels(), text(260)
    for b in range(7):
        index.insert(suffix_rows(spark, [text(500), text(300) + shared if b in (1, 5) else text(400)]))
    assert [size for size, _ in index.levels] == [4, 2, 1]
    for _, level in index.levels:  # suffixes in the order of their text, in each part
        for part in level.select("head").rdd.glom().collect():
            heads = [(r.head + (1 << 63)).to_bytes(8, "big").decode() for r in part]
            assert heads == sorted(heads)
    found = index.matches().collect()
    assert len(found) >= 2 and len({r.head for r in found}) <= 10  # the passage of batches 1 and 5, by then in other levels


def test_levels_merge_within_the_query(spark, monkeypatch):
    index = suf.SuffixLevels()
    monkeypatch.setattr(suf, "SuffixLevels", lambda: index)
    monkeypatch.setattr(suf, "_partial", lambda docs, runs, length: spark.createDataFrame([], suf._MARKS))
    seen, plain = [], index.insert
    monkeypatch.setattr(index, "insert", lambda s: (plain(s), seen.append([n for n, _ in index.levels])))
    suf.remove_repeats(spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert seen == [[1], [2], [2, 1], [4]]


def test_levels_are_scanned_and_merged_where_they_lie(spark):
    """Joins of levels and of their reaches shuffle nothing, and a merged level has each run once, with the number of its places."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    index, same_text, shared = suf.SuffixLevels(), text(400), text(260)
    batches = [[same_text, text(100) + shared], [same_text, same_text, shared + text(100)]]
    tables = []
    for texts in batches:
        runs = index._level(index._run(suffix_rows(spark, texts)))
        tables.append((runs, suf.bucketed(index._reaches(runs), "level-keys", ["key"], ["key"])))
    (a, x), (b, y) = tables
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joins = index._merged_runs(a, b), index._merged_reaches(x, y), index._met(x, y)
        for df in joins:
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        every = suffix_rows(spark, sum(batches, []))
        same(joins[0].select("head", "ext", "n"), [tuple(r) for r in every.groupBy("head", "ext").count().collect()], "head", "ext", "n")
        same(joins[1].select("key"), [tuple(r) for r in index._keys(every).select("key").distinct().collect()], "key")
        assert joins[2].count() > 0  # of the passage that both batches share
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    paths = [t.stored_at for t in (a, x, b, y)]
    suf.drop(a, x, b, y)
    assert not any(spark.catalog.tableExists(t.stored_as) or Path(p.removeprefix("file:")).exists() for t, p in zip((a, x, b, y), paths, strict=True))


def test_repeats_of_odd_rows_in_any_number_of_batches(spark):
    """Null ids and texts, repeated rows and ids, short and empty texts, one text in many rows; levels of other sizes than powers of two."""
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    hot, rows = text(450), [(None, None), (1, None), (2, ""), (3, text(199)), (3, text(300))]
    rows += [(i, hot) for i in range(10, 30)] + [(None, hot[:250]), (40, text(260)), (40, text(260))] + [(i, text(150) + hot[100:350] + text(90)) for i in range(50, 70)]
    rows += [rows[-1], rows[6], (None, None)]
    n = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    for batches in (1, 3):
        out = suf.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), batches=batches)
        same(out.select("doc_id", n.alias("a"), (n - F.octet_length("kept")).alias("b"), F.size("spans").alias("s"), F.sha2("kept", 256).alias("h")), brute.without_repeats(rows), "doc_id", "a", "b", "s", "h")


@pytest.mark.parametrize("hot", [1024, 2])
def test_repeats_of_edges(spark, monkeypatch, hot):
    """A common passage in unique text: its edges are stretches that agree in part; with few allowed in a task, as rows."""
    monkeypatch.setattr(suf, "HOT", hot)
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdefghijk ") for _ in range(n))
    passage = text(700)
    rows = [(i, text(rng.randint(0, 300)) + passage[rng.randint(0, 40) : 700 - rng.randint(0, 300)] + text(rng.randint(0, 300))) for i in range(40)]
    out = suf.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    n = F.octet_length("text").cast("long")
    same(out.select("doc_id", n.alias("a"), (n - F.octet_length("kept")).alias("b"), F.size("spans").alias("s"), F.sha2("kept", 256).alias("h")), brute.without_repeats(rows), "doc_id", "a", "b", "s", "h")


def test_repeats_with_odd_names_and_ids(spark):
    df = spark.createDataFrame([("a", "x" * 300, 1, 2), (None, "y" * 100, 3, 4), ("b", None, 5, 6)], "doc_id string, text string, `my col` int, `u.v` int")
    out = suf.remove_repeats(df)
    assert out.columns == ["doc_id", "text", "my col", "u.v", "spans", "kept"]
    assert {(r.doc_id, r["my col"], r["u.v"], bytes(r.kept)) for r in out.collect()} == {("a", 1, 2, b""), (None, 3, 4, b"y" * 100), ("b", 5, 6, b"")}


def test_near_duplicates(spark, messy, empty):
    rows, df = messy
    out = jac.near_duplicates(df)
    same(out, [(d, c, n) for d, c, n in brute.linked(rows)], "doc_id", "class_id", "n_links")
    assert jac.near_duplicates(empty).count() == 0


def test_near_duplicates_small_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in table("documents")]
    same(entry.op8_jaccard_join(spark, SMALL), brute.linked(rows), "doc_id", "class_id", "n_links")


@pytest.mark.parametrize(("limit", "value"), [("BLOCK", 8), ("BLOCK_SHINGLES", 700)])
def test_large_nodes_are_verified_in_parts(spark, monkeypatch, limit, value):
    monkeypatch.setattr(jac, limit, value)
    base = [f"w{i}" for i in range(120)]
    rows = [(k, " ".join(base[:k] + [f"new{k}"] + base[k + 1 :])) for k in range(40)]
    same(jac.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), brute.linked(rows), "doc_id", "class_id", "n_links")


def test_every_class_has_the_recall():
    depth = jac.prefix_depth()
    assert jac.recall(0.8, depth) >= jac.TARGET_RECALL > jac.recall(0.8, depth + 1)
    few, many = jac.trees_needed(depth), jac.trees_needed(2 * depth)
    assert few <= jac.TREES and jac.recall(0.8, depth, few) >= jac.TARGET_RECALL > jac.recall(0.8, depth, few - 1)
    assert jac.recall(0.8, 2 * depth, many) >= jac.TARGET_RECALL > jac.recall(0.8, 2 * depth, many - 1)


def similar_pairs(n, boilerplate=0):
    """Pairs of texts with a similarity just above 0.8, each with the same words in front."""
    rng, rows = random.Random(11), []
    front = " ".join(f"front{i}" for i in range(boilerplate))
    for k in range(n):
        own = [f"w{rng.randrange(10**6)}" for _ in range(120)]
        other = own.copy()
        for at in range(10, 120, 12 if boilerplate else 55):
            other[at] = "x"
        rows += [(2 * k, f"{front} {' '.join(own)}"), (2 * k + 1, f"{front} {' '.join(other)}")]
    return rows


@pytest.mark.parametrize("boilerplate", [0, 400])
def test_recall_just_above_the_threshold(spark, monkeypatch, boilerplate):
    """800 pairs near 0.83; with nodes of more than 16 classes counted as crowded, boilerplate sends all to long prefixes."""
    asked, plain = [], jac._long_prefixes
    monkeypatch.setattr(jac, "_long_prefixes", lambda *a: asked.append(a) or plain(*a))
    monkeypatch.setattr(jac, "BLOCK", 16 if boilerplate else 1024)
    rows = similar_pairs(800, boilerplate)
    a, b = (brute.shingles(t) for _, t in rows[:2])
    assert 0.8 <= len(a & b) / len(a | b) < 0.85
    got = {r.doc_id: r.n_links for r in jac.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got.values()) <= {0, 1} and sum(got.values()) >= 0.99 * 1600 and asked == ([(trees, 8)] if (trees := jac.trees_needed(8)) and boilerplate else [])
    print("linked", sum(got.values()), "of 1600")


def test_recall_on_the_larger_table(spark):
    docs = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()
    same(entry.op8_jaccard_join(spark, "/root/testdata/sf0.01"), brute.linked([(r["doc_id"], r["text"]) for r in docs]), "doc_id", "class_id", "n_links")


def test_near_duplicates_of_text_ids(spark):
    rows = [("b", "one two three four five six"), ("a", "One two three four five six!"), (None, None), ("c", "")]
    out = jac.near_duplicates(spark.createDataFrame(rows, "doc_id string, text string"))
    assert {(r.doc_id, r.class_id, r.n_links) for r in out.collect()} == {("a", "a", 1), ("b", "a", 1), (None, None, 0), ("c", "c", 0)}


def test_decontamination(spark, messy, empty):
    rows, df = messy
    items = [(7, " ".join((rows[7][1] or "").split()[20:40])), (8, "a b"), (9, None), (10, ""), (11, "one"), (70, "Und und UND und und und und und und und und")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, spans string")
    out = dec.find_benchmark(df, bench)
    digest = out.select("doc_id", "n_words", "n_hit", F.size("items").alias("k"), F.sha2(F.array_join("items", ","), 256).alias("h"), (F.col("n_hit") > 0).alias("bad"))
    same(digest, brute.decontaminated(rows, items), "doc_id", "n_words", "n_hit", "k", "h", "bad")
    assert dec.find_benchmark(empty, bench).count() == 0
    assert dec.find_benchmark(df, bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    for r in dec.remove_spans(out).join(out.select("doc_id", F.col("text").alias("was"), "spans").where("doc_id <> 5").withColumnRenamed("spans", "cut"), "doc_id").collect():
        body, at = (r.was or "").encode(), 0
        kept = b""
        for x in r.cut:
            kept, at = kept + body[at : x.start], x.end
        assert (r.text or "").encode() == kept + body[at:]
    clean = dec.find_benchmark(dec.remove_spans(out).select("doc_id", "text"), bench)
    assert clean.where("n_hit > 0").count() <= out.where("n_hit > 0").count()


def test_items_without_an_id_are_hits(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"before {passage} after"), (2, "clean text")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, passage), (3, "other words here")], "item_id long, text string")
    out = dec.find_benchmark(docs, bench)
    assert sorted((r.doc_id, r.n_hit, r["items"]) for r in out.collect()) == [(1, 30, []), (2, 0, [])]
    assert dec.remove_spans(out).where("doc_id = 1").first().text == "before  after"


def test_decontamination_in_portions(spark, monkeypatch):
    docs, bench = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    whole = dec.find_benchmark(docs, bench).select("doc_id", "n_hit", "items", "spans").toPandas()
    monkeypatch.setattr(dec, "PORTION", 700)
    parts = dec.find_benchmark(docs, bench).select("doc_id", "n_hit", "items", "spans").toPandas()
    assert [str(r) for r in whole.sort_values("doc_id").values.tolist()] == [str(r) for r in parts.sort_values("doc_id").values.tolist()]


def test_fm_index_against_search():
    import numpy as np

    rng = np.random.default_rng(1)
    s = np.append(rng.integers(1, 5, 400), 0)
    index = dec.FMIndex(s, 5)
    for n in (1, 2, 5, 9):
        phrase = s[30 : 30 + n]
        low, high = index.search(phrase[None, :], np.array([n]))
        want = [i for i in range(len(s) - n + 1) if (s[i : i + n] == phrase).all()]
        assert sorted(index.locate(np.arange(low[0], high[0]))) == want


def test_sharding(spark, messy, empty):
    rows, df = messy
    out = sha.shuffle_into_shards(df.repartition(5), 4, block_rows=7)
    got = [(r.doc_id, len((r.text or "").encode()) + 1, __import__("zlib").crc32((r.text or "").encode()), "rows", r.shard, r.slot, None) for r in out.collect()]
    brute.check_shards(got, rows, 4)
    assert sha.shuffle_into_shards(empty, 4).count() == 0


def test_shuffle_is_uniform(spark):
    df = spark.range(8, numPartitions=3)
    first = Counter(sha.shuffle_into_shards(df, 2, seed=s, block_rows=2).where("shard = 0 and slot = 0").first().id for s in range(120))
    assert max(first.values()) <= 32 and len(first) == 8


def test_texts_and_token_ids_are_joined_late(spark, monkeypatch):
    """Tables of nodes carry neither texts nor ids; odd blanks, null ids, turns, roles and texts included."""
    rng = random.Random(21)
    words = ["the", "don't", "é中", "a\u00a0\u00a0b", "x\u180e", "\x1c ", "  two", "\n\n", "tab\t", "1٣²", "<|end|>\n", "[INST]", "\\", "😀", "\u200b", "\u3000 "]
    text = lambda: " ".join(rng.choice(words) for _ in range(40))
    shared = text()
    rows = [(i if i else None, j, rng.choice(("user", "assistant", None)), shared if j < 2 else rng.choice((text(), None, ""))) for i in range(12) for j in range(4)]
    rows += [(3, None, "user", text()), (4, 1, "user", shared), (4, 1, "user", shared)]
    kept, plain = {}, chat.stored
    monkeypatch.setattr(chat, "stored", lambda df, name: (kept.__setitem__(name, df.columns), plain(df, name))[1])
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    path = entry.tokenizer_path("byte_bpe_50k.json")
    nodes, paths, members = chat.format_conversations(df, path)
    same(chat.read_back(nodes, paths, members, path), brute.conversations(rows), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert [n for n, c in kept.items() if "text" in c] == ["turns"] and [n for n, c in kept.items() if "ids" in c] == ["tokens"]


def test_heads_are_encoded_once_for_each_role():
    import pyarrow as pa

    path, seen = entry.tokenizer_path("byte_bpe_50k.json"), []
    plain = chat._ids
    columns = {"owner": [0] * 2500, "depth": [1] * 2500, "node": ["n"] * 2500, "head": [f"{chat.TURN}{i % 2}{chat.BODY}" for i in range(2500)], "body": [f"é {i}" for i in range(2499)] + [""], "is_loss": [i % 3 == 0 for i in range(2500)]}
    with pytest.MonkeyPatch.context() as m:
        m.setattr(chat, "_ids", lambda path, texts: (seen.extend(texts), plain(path, texts))[1])
        (out,) = chat._encode(path)(iter([pa.RecordBatch.from_pydict(columns)]))
    assert sorted(seen) == sorted([chat.END, *set(columns["head"]), *columns["body"]])
    one = lambda x: chat._tokenizer(path).encode(x, add_special_tokens=False).ids
    for h, b, own, r in zip(columns["head"], columns["body"], columns["is_loss"], out.to_pylist(), strict=True):
        assert r["ids"] == one(h) + one(b) + one(chat.END) and r["n_tokens"] == len(r["ids"])
        assert (r["loss_start"], r["loss_end"]) == ((len(one(h)), len(one(h) + one(b))) if own else (0, 0))


def test_tokens_are_decoded_as_by_the_tokenizer():
    """Any ids, also those that cut a character."""
    from tokenizers import decoders

    path, rng = entry.tokenizer_path("byte_bpe_50k.json"), random.Random(22)
    names, spoken = {i: t for t, i in chat._tokenizer(path).get_vocab().items()}, chat._spoken(path).to_pylist()
    for _ in range(20_000):
        ids = [rng.choice((rng.randrange(256), rng.randrange(len(spoken)))) for _ in range(rng.randint(0, 6))]
        assert b"".join(spoken[i] for i in ids).decode("utf-8", "replace") == decoders.ByteLevel().decode([names[i] for i in ids])


def test_hypergeometric_inversion_agrees_with_numpy():
    import numpy as np

    rng = np.random.default_rng(2)
    own = [sha._one_count(rng, 50, 70, 30) for _ in range(4000)]
    assert abs(np.mean(own) - 12.5) < 0.2 and abs(np.var(own) - 30 * 50 / 120 * 70 / 120 * 90 / 119) < 0.6


def test_packing(spark, empty):
    from tokenizers import Tokenizer

    path = entry.tokenizer_path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    rows = [(i, x) for i, (_, x) in enumerate(messy_rows())] + [(900, "İI ΑΣ don't <|endoftext|> 12²"), (901, "日本語 Ünïcode, a1b2;c")]
    df = spark.createDataFrame([("r", x, i, 1, 2, "k", "s", "h", 3, "u", "c", 1) for i, x in rows], CLASHING)
    pieces = [tuple(r)[:7] for r in pac.pack(df, path).collect()]
    assert brute.check_packing(pieces, rows, lambda x: t.encode(x, add_special_tokens=False).ids) > 0.5
    assert pac.pack(empty, path).count() == 0


def test_hilbert_neighbours():
    import numpy as np

    grid = np.array([(a, b) for a in range(16) for b in range(16)])
    order = grid[np.argsort(pac.hilbert_key(grid, 4))]
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_conversations(spark):
    rows = [(1, 0, "user", "hi <|end|>\n [INST] \\ |"), (1, 1, "assistant", "a\\b <|turn|>"), (2, 0, "user", "hi <|end|>\n [INST] \\ |"), (2, 1, "assistant", None), (2, 2, "user", ""), (3, 0, "user", "hi <|end|>\n [INST] \\ |"),
            (4, 0, None, "x"), (4, None, "assistant", "y"), (4, 1, "assistant", "z"), (4, 1, "assistant", "z"), (None, 0, "assistant", "null id"), (5, 0, "user", "hi <|end|>\n [INST] \\ |"), (5, 1, "assistant", "a\\b <|turn|>")]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, node string, rank int")
    path = entry.tokenizer_path("byte_bpe_50k.json")
    nodes, paths, members = chat.format_conversations(df, path)
    same(chat.read_back(nodes, paths, members, path), brute.conversations(rows), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    written = nodes.orderBy("start").collect()
    at = 0
    for n in written:  # the stream has no gap, parents come first and attention covers the ancestors
        assert n.start == at and sum(a.end - a.start for a in n.ancestors) == n.position and all(a.end <= n.start for a in n.ancestors)
        at += n.n_tokens
    assert len(written) == nodes.select("node").distinct().count() == 9  # 4 of the shared beginning, 4 of conversation 4, 1 without an id
    none = chat.read_back(*chat.format_conversations(df.limit(0), path), path)
    assert none.count() == 0


def test_top_k(spark):
    rng = random.Random(9)
    rows = [(i, [float(rng.randint(-3, 3)) / 8 for _ in range(6)]) for i in range(300)] + [(i, [0.25] * 6) for i in range(300, 420)]
    odd = [(500, None), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (502, [math.nan] * 6), (503, [math.inf] * 6), (None, [1.0] * 6), (7, rows[7][1])]
    df = spark.createDataFrame([(i, x, 1) for i, x in rows + odd], "vec_id long, embedding array<float>, rank int")
    v = df.where(top.usable("embedding")).select("vec_id", top.scaled("embedding").alias("embedding"))
    got = top.top_k(v, v.where("vec_id % 20 = 0"), 20)
    ints = {i: [math.floor(64 * c) for c in x] for i, x in rows}
    want = []
    for q in (i for i in ints if i % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(ints[q], x, strict=True)), i) for i, x in [*ints.items(), (7, ints[7])] if i != q)[:20]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    same(got, want, "query_id", "rank", "vec_id", "score")
    assert top.top_k(v.limit(0), v.limit(0)).count() == 0


def test_top_k_of_repeated_rows(spark):
    v = spark.createDataFrame([(0, [5]), (1, [5]), (1, [5]), (2, [1])], "vec_id long, embedding array<int>")
    got = [(r.rank, r.vec_id, r.score) for r in top.top_k(v, v.where("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(1, 1, 25), (2, 1, 25), (3, 2, 5)]


def test_top_k_over_many_shards(spark, monkeypatch):
    """Clusters far apart in many small shards, a third of the rows equal, queries beyond the rows."""
    for name, value in (("SHARD_ROWS", 40), ("BLOCK_QUERIES", 16), ("BOXES", 8), ("BLOCKS", 2)):
        monkeypatch.setattr(top, name, value)
    rng = random.Random(12)
    rows = [(i, [rng.choice((-400, 400)) + rng.randint(-9, 9) for _ in range(3)]) for i in range(600)] + [(i, [300, -300, 300]) for i in range(600, 900)]
    rows += [(2000 + i, [i, 1]) for i in range(30)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<int>")
    q = [(i, x) for i, x in rows if i % 20 == 0] + [(5000, [-3, 2, 9]), (5001, [1, 1, 1, 1])]
    asked = spark.createDataFrame(q, "vec_id long, embedding array<int>")
    want = []
    for i, x in q:
        best = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), j) for j, y in rows if j != i and len(y) == len(x))[:20]
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    same(top.top_k(v, asked), want, "query_id", "rank", "vec_id", "score")


def test_tree_prunes():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.integers(-50, 50, (2000, 3))
    tree = top.build_tree(np.arange(2000), x, 32)
    for n, (a, z) in enumerate(tree["span"]):
        assert (tree["x"][a:z].min(axis=0) == tree["low"][n]).all() and (tree["x"][a:z].max(axis=0) == tree["high"][n]).all()


def test_search_compares_a_leaf_with_many_queries_at_once(monkeypatch):
    """Equal to all products, with floors, ties, own ids, repeated ids, few rows and numbers beyond exact floating point; leaves meet queries in blocks."""
    import numpy as np

    rng = np.random.default_rng(3)
    met, plain = [], top._improve
    monkeypatch.setattr(top, "_improve", lambda *a: (met.append(len(a[3])), plain(*a))[1])
    for rows, most, k, big in ((3000, 40, 20, 1), (900, 2, 20, 1), (10, 9, 20, 1), (700, 9, 5, 2**27), (1200, 0, 3, 1)):
        x, ids = rng.integers(-most, most + 1, (rows, 5)) * big, rng.permutation(rows)
        ids[: rows // 50] = ids[-1]
        q, own = np.concatenate([x[:300], rng.integers(-most, most + 1, (100, 5)) * big]), np.concatenate([ids[:300], np.full(100, 10**9)])
        score = q.astype(object) @ x.T.astype(object)
        floor = np.array([-(2**62) if i % 3 else sorted(r)[len(r) // 2] for i, r in enumerate(score)])
        met.clear()
        found = top.search(top.build_tree(ids, x, 32), q, own, floor, k)
        for i, (s, n) in enumerate(found):
            best = sorted((-v, int(j)) for v, j in zip(score[i], ids, strict=True) if j != own[i] and v >= floor[i])[:k]
            assert [(-int(a), int(b)) for a, b in zip(s, n, strict=True)] == best
        if rows == 3000:
            assert max(met) > 20 and len(met) < len(q) * 10  # 400 queries, 128 leaves: not a product for each query and leaf
    assert [len(s) for s, _ in top.search(top.build_tree(ids, x, 32), q[:0], own[:0], floor[:0], 3)] == []


def test_top_k_makes_the_vectors_once(spark):
    """Counts, the sample and the placing read a table; the vectors as they come in are worked out once for it."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = spark.createDataFrame([(i % 90, [i % 7, i % 5, -i]) for i in range(100)] + [(None, [1, 1, 1]), (5, None), (6, [1, None, 2]), (7, [])], "vec_id long, embedding array<int>")
    out = top.top_k(rows.mapInArrow(count, rows.schema), rows.where("vec_id = 3"), 4)
    assert out.count() == 4 and made.value == 104


def test_urls(spark):
    pages = [(1, "https://a.net/x", '<link rel="canonical" href="https://b.net/y">'), (2, "HTTP://B.net/y#f", ""), (3, "https://c.net/z", "<meta http-equiv='refresh' content='0; url=http://www.example.org/es/1'>"), (4, None, None),
             (5, "no scheme", ""), (6, "http://x.org/en/1", ""), (7, "https://c.net/w", '<link href="/z" rel=canonical>'), (8, "http://ok.org/q", "<link rel=canonical href=http://sub.example.org/en/12>"), (9, "http://ok.org/q", "")]
    df = spark.createDataFrame([(*p, "old") for p in pages], "page_id long, url string, html string, verdict string")
    links = url.page_links(df).unionByName(spark.createDataFrame([("https://b.net/y", "http://sub.example.org/en/12"), (None, "x")], "src string, dst string"))
    out = {r.page_id: (r.rule, r.verdict) for r in url.filter_urls(df, entry.RULES, links).collect()}
    assert out[3] == (None, "block") and out[7] == (None, "block")  # aliases of a blocked page
    assert out[6] == ("org/", "allow") and out[8] == ("org/", "allow")
    assert out[1] == out[2] == (None, "allow")  # their component holds an allowed page: allow goes first
    assert out[4] == out[5] == (None, "allow")
    many = [("block", f"h{i}.net", "/") for i in range(600)] + entry.RULES
    assert {r.page_id: r.rule for r in url.filter_urls(df, many).collect()} == {k: v[0] for k, v in out.items()}
    assert url.filter_urls(df.limit(0), entry.RULES, url.page_links(df.limit(0))).count() == 0
    linked = {r.page_id: (r.rule, r.verdict) for r in url.filter_urls(df, many, links).collect()}
    assert linked == out


@pytest.mark.parametrize("more", [0, 600])
def test_urls_keep_columns_and_ties(spark, more):
    rules = [("block", f"h{i}.net", "/") for i in range(more)] + [("block", "bc.org", "/xy"), ("block", "a.bc.org", "/")]
    df = spark.createDataFrame([(1, "http://a.bc.org/xyz", "x", 7, "y")], "page_id long, url string, h string, p int, host_key string")
    (r,) = url.filter_urls(df, rules, spark.createDataFrame([("http://q.net/", "http://r.net/")], "src string, dst string")).collect()
    assert (r.rule, r.verdict, r.h, r.p, r.host_key) == ("a.bc.org/", "block", "x", 7, "y")


def test_links_without_dots_and_with_a_base(spark):
    pages = [("http://a.net/b/c/d", "<link rel=canonical href='../x/./y?q=..'>"), ("http://a.net/b/c", "<base href='/m/n/'><link rel=canonical href='../o'>"), ("http://a.net/b", "<link rel=canonical href='/..'>"), (None, "<link rel=canonical href=/x>")]
    got = {r.src: r.dst for r in url.page_links(spark.createDataFrame(pages, "url string, html string")).collect()}
    assert got == {"http://a.net/b/c/d": "http://a.net/b/x/y?q=..", "http://a.net/b/c": "http://a.net/m/o", "http://a.net/b": "http://a.net/"}


def test_components(spark):
    e = [(i, i + 1) for i in range(1, 60)] + [(100, 100), (None, 3), (200, 201), (201, 200), (200, 202)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(e, "a long, b long"), "a", "b").collect()}
    assert got == {i: 1 for i in range(1, 61)} | {200: 200, 201: 200, 202: 200}


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = entry.op3_toxicity(spark, folder).join(labels, "doc_id").where("held_out").toPandas()
    assert ((out.predicted == out.toxic).mean()) > 0.9 and out.score.between(0, 1).all()
    assert out[out.toxic == 1].score.mean() > out[out.toxic == 0].score.mean() + 0.3


def test_toxicity_odd_tables(spark, messy, empty):
    _, df = messy
    labels = spark.createDataFrame([(None, 1), (3, None), (4, 0)], "doc_id long, toxic int")
    assert tox.score_toxicity(df, tox.training_rows(labels)).count() == df.count()
    assert tox.score_toxicity(empty, tox.training_rows(labels)).count() == 0


def test_toxicity_features_by_hand(spark):
    """Each feature of odd and plain texts, counted word by word."""
    import re

    import numpy as np
    import pyarrow as pa

    texts = ["", "You are an IDIOT and you know it!!", "clean words only", "1d10t y0u", "sooo b@d, your trash your TRASH", "İ ünï CODE", "x" * 5000]
    lexicon = {0: tox._hashes_of(["clean"]), **{n: np.zeros(0, np.uint64) for n in tox.PREFIXES}}
    (t,) = tox.slices(pa.array(texts))
    got = tox.features(t, lexicon, tox._hashes_of(tox.INSULTS), tox._hashes_of(tox.ADDRESS))
    for text, row in zip(texts, got, strict=True):
        w, f = brute.words(text), dict(zip(tox.FEATURES, row, strict=True))
        bad = [i for i, x in enumerate(w) if x in tox.INSULTS or x == "clean"]
        you = [i for i, x in enumerate(w) if x in tox.ADDRESS]
        n, letters = max(len(w), 1), max(len(re.findall("[A-Za-z]", text)), 1)
        want = {
            "stated": sum(x in tox.INSULTS for x in w) / n, "learned": w.count("clean") / n, "kinds": len({w[i] for i in bad}), "address": len(you) / n,
            "near": max((1 / (1 + min(abs(i - j) for j in you)) for i in bad), default=0) if you else 0, "capitals": len(re.findall("[A-Z]", text)) / letters,
            "cries": len(re.findall("[!?]", text)) / max(len(text.encode()), 1), "marks": len(re.findall(r"[!-/:-@\[-`{-~]", text)) / max(len(text.encode()), 1),
            "mixed": sum(bool(re.search(r"\d", x) and re.search("[a-z]", x)) for x in w) / n, "n_words": math.log1p(len(w)),
        }
        assert {k: round(float(f[k]), 9) for k in want} == {k: round(float(v), 9) for k, v in want.items()}, text


def test_quality_posteriors_by_hand(spark):
    """Posteriors and scores from the evidence, group by group."""
    rows = entry.op2_quality(spark, SMALL).collect()
    hosts, paths = {}, {}
    for r in rows:
        for groups, key in ((hosts, r.host), (paths, (r.host, r.path))):
            n, s = groups.get(key, (0, 0.0))
            groups[key] = (n + 1, s + r.evidence)
    total, mean = len(rows), sum(r.evidence for r in rows) / len(rows)

    def weight(groups):
        n, q = sum(a for a, _ in groups), sum(s * s / a for a, s in groups)
        within = mean * (1 - mean)
        between = (q - n * mean**2 - (len(groups) - 1) * within) / (n - sum(a * a for a, _ in groups) / n)
        return 1000.0 if between <= 0 else min(1000.0, max(1.0, within / between - 1))

    strong, near = weight(list(hosts.values())), weight(list(paths.values()))
    logit = lambda p: math.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
    for r in rows:
        (hn, hs), (pn, ps) = hosts[r.host], paths[r.host, r.path]
        host = (strong * mean + hs - r.evidence) / (strong + hn - 1)
        path = (near * host + ps - r.evidence) / (near + pn - 1)
        score = 1 / (1 + math.exp(-(logit(r.evidence) + logit(path) - logit(mean))))
        assert abs(r.host_posterior - host) < 1e-6 and abs(r.path_posterior - path) < 1e-6 and abs(r.score - score) < 1e-6
    assert total == len(table("documents"))


def test_quality(spark, messy, empty):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = entry.op2_quality(spark, folder).join(labels, "doc_id").toPandas()
    assert (out.keep == (out.quality == 1)).mean() > 0.95
    _, df = messy
    none = labels.limit(0)
    assert score_quality(df, quality_training(none), "row", "key").count() == df.count()
    assert score_quality(empty, quality_training(none), "row", "key").count() == 0
