"""The pipeline's stages on the small tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipe
from lamella.llm.decontaminate import find_benchmark

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in pipe.STAGES:
        stage(spark, out[-1], SMALL).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return out


def test_all_but_the_last_return_documents(stages):
    assert [s.columns == pipe.COLUMNS for s in stages] == [True] * 5 + [False]


def test_near_copies_leave_one_of_each_group(spark, stages):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).resolve().parent))
    import brute

    before, after = ([(r.doc_id, r.text) for r in s.collect()] for s in stages[1:3])
    assert {d for d, _ in after} == {c for _, c, _ in brute.linked(before)}


def test_later_stages_keep_rows(stages):
    assert stages[2].count() == stages[3].count() == stages[4].count()
    assert stages[5].select("doc_id").distinct().count() == stages[4].count()
    assert stages[3].where(F.char_length("text") != F.col("n_chars")).count() == 0


def test_no_benchmark_text_stays(spark, stages):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert find_benchmark(stages[3], bench).where("n_hit > 0").count() > 0
    assert find_benchmark(stages[4], bench).where("n_hit > 0").count() == 0


def test_windows_that_a_cut_brings_together_go_too(spark, tmp_path):
    passage = [f"w{i}" for i in range(10)]
    spark.createDataFrame([(1, " ".join(passage))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    nested = passage[:5] + passage + passage[5:]
    texts = [" ".join(["before", *passage[:2], *nested, *passage[2:], "after"]), "w0 w1 stays", None]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], COLUMN_TYPES)
    out = pipe.benchmark(spark, docs, str(tmp_path))
    assert sorted(((r.doc_id, r.text.split() if r.text else None) for r in out.collect())) == [(0, ["before", "after"]), (1, ["w0", "w1", "stays"]), (2, None)]


def test_a_cut_takes_whole_characters_and_no_others(spark):
    """The passage begins and ends inside characters of two and four bytes; a replacement character of the text stays."""
    passage = "".join(chr(0x1F600 + i % 40) + chr(0xE0 + i % 23) for i in range(50))
    docs = spark.createDataFrame([(1, "keep \ufffd this é" + passage + "end", "en", "s", 1), (2, "other \U0001f9ff" + passage + "rest", "en", "s", 1), (3, "\ufffd", "en", "s", 1)], COLUMN_TYPES)
    got = {r.doc_id: (r.text, r.n_chars) for r in pipe.repeats(spark, docs, SMALL).collect()}
    assert got[1][0].startswith("keep \ufffd this ") and got[1][0].endswith("end") and passage[1:-1] not in got[1][0]
    assert got[2][0].startswith("other ") and got[2][0].endswith("rest") and got[3][0] == "\ufffd"
    assert all(len(t) == n for t, n in got.values())


def test_an_empty_table_passes(spark):
    docs = spark.createDataFrame([], COLUMN_TYPES)
    for _, stage in pipe.STAGES:
        assert stage(spark, docs, SMALL).count() == 0


def test_odd_rows_pass(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "a b c", "en", "s", 5), (2, "other words", "en", "s", 11)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in pipe.STAGES[:4]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == pipe.COLUMNS
    assert docs.where("doc_id = 2").count() == 2
    assert pipe.packing(spark, docs, SMALL).count() >= 3


COLUMN_TYPES = "doc_id long, text string, lang string, source string, n_chars long"


def test_near_copies_by_id_and_text(spark):
    words = [f"w{i}" for i in range(100)]
    text, near = " ".join(words), " ".join(words[:50] + ["new"] + words[51:])
    other, third = " ".join(f"x{i}" for i in range(60)), " ".join(f"y{i}" for i in range(60))
    rows = [(1, text), (None, near), (2, near), (2, other), (3, third), (3, third + " end"), (None, "alone here"), (None, "alone here"), (None, "twice"), (None, "Twice")]
    out = pipe.near_copies(spark, spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], COLUMN_TYPES), SMALL)
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert [x for x in got if x[1].split()[0].lower() not in ("y0", "twice")] == sorted([(1, text), (2, other), (None, "alone here")], key=str)
    assert len([x for x in got if x[0] == 3]) == 1 and len([x for x in got if x[1].lower() == "twice"]) == 1


def test_toxic_rows_by_id_and_text(spark, monkeypatch):
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in ((None, "bad a"), (None, "good b"), (4, "bad c"), (4, "good d"), (5, "good a"))], COLUMN_TYPES)
    real = pipe.score_toxicity

    def scored(*args, **more):
        out = real(*args, **more)
        bad = docs.where("text like 'bad%'").select(F.xxhash64("text").alias("th")).withColumn("bad", F.lit(1.0))
        return out.join(bad, "th", "left").withColumn("score", F.coalesce("bad", F.lit(0.0)))

    monkeypatch.setattr(pipe, "score_toxicity", scored)
    assert sorted((r.text for r in pipe.toxicity(spark, docs, SMALL).collect())) == ["good a", "good b", "good d"]


def test_sequences_can_be_read(stages):
    import zlib

    import numpy as np

    rows = stages[5].collect()
    assert rows and all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
