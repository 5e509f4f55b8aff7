"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of a stated and of a learned lexicon, nearness of its words
to second-person words, capitals, punctuation and obfuscation rates.  The learned lexicon holds
words and word beginnings that are far likelier in toxic documents; it is learned on one half of
a bounded sample of labelled rows, trees on most of the other half, calibration on the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .storage import stored
from .wordhash import Texts, first_of, slices, words

#: Most labelled rows that are learned from, both halves together.
SAMPLE_ROWS = 40_000
#: Most entries of the learned lexicon.
LEXICON = 4000
#: Lengths in bytes of the word beginnings looked at.
PREFIXES = (4, 5, 6, 7, 8)
TREES, DEPTH = 30, 4
#: Least rows of each class that calibration is fitted on.
CALIBRATION_ROWS = 5

# Words of insult and words of address.
INSULTS = "idiot moron stupid clown loser trash scum worthless pathetic disgusting dumb imbecile fool garbage jerk filth".split()
ADDRESS = "you your yours u ur yourself thou du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos usted ustedes tus ti".split()

FEATURES = ("stated", "learned", "learned_log", "kinds", "address", "near", "capitals", "shouted", "marks", "cries", "mixed", "masked", "drawn", "n_words")


def _hashes_of(terms: list[str]) -> np.ndarray:
    return np.unique(words(next(slices(pa.array([" ".join(terms)])))).hashes)


def _isin(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(h), bool)
    return table[np.minimum(np.searchsorted(table, h), len(table) - 1)] == h


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of toxic and other documents of each word and word beginning, for each slice."""
    for batch in batches:
        for texts in slices(batch.column("text")):
            w = words(texts)
            row = np.repeat(np.arange(len(texts)), np.diff(w.rows))
            toxic = batch.column("toxic").to_numpy()[texts.first : texts.first + len(texts)] > 0
            for size, h in ((0, w.hashes), *((n, w.prefix(n)) for n in PREFIXES)):
                some = h != 0
                one = np.flatnonzero(some)[first_of(row[some], h[some])]
                gram, place = np.unique(h[one], return_inverse=True)
                bad = np.bincount(place, toxic[row[one]], len(gram)).astype(np.int64)
                every = np.bincount(place, minlength=len(gram))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(gram), size, np.int32)), pa.array(gram.view(np.int64)), pa.array(bad), pa.array(every - bad)], names=["size", "gram", "bad", "good"])


def learn_lexicon(sample: DataFrame) -> dict[int, np.ndarray]:
    """Sorted hashes of the grams, by length (0: whole words), that speak most for a toxic document.

    Counts cover the whole (bounded) sample; at most ``LEXICON`` entries come to the driver.
    """
    n = sample.agg(F.sum("toxic"), F.count("*")).first()
    bad, good = (n[0] or 0), n[1] - (n[0] or 0)
    counted = sample.select("text", "toxic").mapInArrow(_grams, "size int, gram long, bad long, good long").groupBy("size", "gram").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.log(((F.col("bad") + 0.1) / (bad + 1.0)) / ((F.col("good") + 0.1) / (good + 1.0)))
    best = counted.where(f"bad >= {max(3, bad // 1000)}").withColumn("odds", odds).where("odds > 2.5").orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "size", "gram").limit(LEXICON).collect()
    return {size: np.array(sorted(r["gram"] & 0xFFFFFFFFFFFFFFFF for r in best if r["size"] == size), np.uint64) for size in (0, *PREFIXES)}


def features(texts: Texts, lexicon: dict[int, np.ndarray], insults: np.ndarray, address: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` for each text; all are 0 for an empty one."""
    w, n = words(texts), len(texts)
    h, at = w.hashes, np.arange(len(w.starts))
    row = np.repeat(np.arange(n), np.diff(w.rows))
    stated = _isin(h, insults)
    learned = _isin(h, lexicon[0])
    for size in PREFIXES:
        learned |= _isin(w.prefix(size), lexicon[size]) if len(lexicon[size]) else False
    called = _isin(h, address)
    count = lambda mask: np.bincount(row[mask], minlength=n).astype(float)
    n_words = np.diff(w.rows).astype(float)
    per_word, n_bytes = np.maximum(n_words, 1), np.maximum(np.diff(texts.offsets), 1).astype(float)
    bad = np.flatnonzero(stated | learned)
    near = np.zeros(n)
    you = at[called]
    if len(bad) and len(you):
        for side in (np.searchsorted(you, bad) - 1, np.searchsorted(you, bad)):
            ok = (side >= 0) & (side < len(you))
            mate = you[np.clip(side, 0, len(you) - 1)]
            ok &= row[mate] == row[bad]
            np.maximum.at(near, row[bad[ok]], 1 / (1 + np.abs(mate[ok] - bad[ok])))
    kinds = np.zeros(n)
    if len(bad):
        kinds = np.bincount(row[bad][first_of(row[bad], h[bad])], minlength=n).astype(float)
    raw = texts.data
    upper, lower = (raw >= 65) & (raw <= 90), (raw >= 97) & (raw <= 122)
    digit, mark = (raw >= 48) & (raw <= 57), (raw > 32) & (raw < 127) & ~((raw >= 48) & (raw <= 57)) & ~((raw >= 65) & (raw <= 90)) & ~((raw >= 97) & (raw <= 122))
    by_text = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[texts.offsets]).astype(float)
    sums = {k: np.concatenate([[0], np.cumsum(m)]) for k, m in (("upper", upper), ("digit", digit), ("lower", lower))}
    in_word = {k: s[w.ends] - s[w.starts] for k, s in sums.items()}
    size = w.ends - w.starts
    same = np.zeros(len(raw), bool)
    same[2:] = (w.data[2:] == w.data[1:-1]) & (w.data[1:-1] == w.data[:-2]) & (upper | lower)[2:]
    mask = np.zeros(len(raw), bool)
    if len(raw) > 2:
        letter = upper | lower
        mask[1:-1] = letter[:-2] & letter[2:] & np.isin(raw[1:-1], np.frombuffer(b"*@$#!+_.", np.uint8))
    letters = np.maximum(by_text(upper | lower), 1)
    n_learned = count(learned)
    return np.column_stack(
        [
            count(stated) / per_word, n_learned / per_word, np.log1p(n_learned), kinds, count(called) / per_word, near,
            by_text(upper) / letters, count((in_word["upper"] == size) & (size > 2)) / per_word, by_text(mark) / n_bytes,
            by_text((raw == 33) | (raw == 63)) / n_bytes, count((in_word["digit"] > 0) & (in_word["lower"] + in_word["upper"] > 0)) / per_word,
            by_text(mask) / per_word, by_text(same) / per_word, np.log1p(n_words),
        ]
    )


def _measured(lexicon: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        insults, address = _hashes_of(INSULTS), _hashes_of(ADDRESS)
        for batch in batches:
            for texts in slices(batch.column("text")):
                x = features(texts, lexicon, insults, address)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * len(FEATURES)), pa.array(x.ravel()))
                rows = batch.slice(texts.first, len(texts))
                yield pa.RecordBatch.from_arrays([*(rows.column(k) for k in rows.schema.names if k != "text"), lists], names=[*(k for k in rows.schema.names if k != "text"), "x"])

    return run


def fold(doc_id: str = "doc_id"):
    """crc32 of the id's digits, modulo 4."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)).cast("int")


def training_rows(labels: DataFrame, doc_id: str = "doc_id", label: str = "toxic", held_out: int = 2, most: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``most`` labelled ids outside the held-out fold, in the order of a hash: (doc_id, toxic, part 0-7)."""
    kept = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & (fold(doc_id) != held_out))
    one = kept.groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(F.max((F.col(label) > 0).cast("int")).alias("toxic"))
    h = F.xxhash64("doc_id", F.lit("toxicity"))
    return one.orderBy(h, "doc_id").limit(most).withColumn("part", F.pmod(h, F.lit(8)).cast("int"))


def score_toxicity(docs: DataFrame, training: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = SAMPLE_ROWS, text_hash: bool = False) -> DataFrame:
    """(doc_id, score) for each row of ``docs``, with ``text_hash`` also th, the text's xxhash64; ``training`` is (doc_id, toxic, part) of at most ``most`` rows.

    Null and empty texts have features of 0 and are scored too.  A null doc_id has a score, but no
    label can be joined to it.  Repeated rows have equal scores.  If the training rows that are
    among the documents have fewer than two classes, every score is the share of toxic ones (0 if
    there are none).  Calibration takes five rows of each class in part 7 (of some 80 labelled rows, that is);
    with fewer it would be noise, and scores are the trees' own probabilities.  An empty table gives no row.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    sample = stored(training.limit(most), "training")  # of bounded size, so it can be broadcast
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    lexicon = learn_lexicon(source.join(F.broadcast(sample.where("part < 4")), "doc_id"))
    own = ["doc_id", "th"] if text_hash else ["doc_id"]
    hashed = source.select("doc_id", *([F.xxhash64("text").alias("th")] if text_hash else []), "text")
    measured = stored(hashed.mapInArrow(_measured(lexicon), ", ".join(f"{c} long" for c in own) + ", x array<double>"), "features")
    fit = measured.join(F.broadcast(sample), "doc_id").select(F.col("toxic").cast("double").alias("toxic"), "part", array_to_vector("x").alias("x"))
    seen = {(r["p"], r["toxic"]): r["n"] for r in fit.groupBy(F.when(F.col("part") < 4, 0).when(F.col("part") < 7, 1).otherwise(2).alias("p"), "toxic").agg(F.count("*").alias("n")).collect()}
    if not ((1, 0.0) in seen and (1, 1.0) in seen):
        n = sum(seen.values())
        return measured.select(*own, F.lit(sum(v for (_, t), v in seen.items() if t) / n if n else 0.0).alias("score"))
    trees = GBTClassifier(featuresCol="x", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, minInstancesPerNode=5, seed=3)
    model = trees.fit(fit.where("part between 4 and 6"))
    raw = vector_to_array("probability")[1]
    enough = min(seen.get((2, 0.0), 0), seen.get((2, 1.0), 0)) >= CALIBRATION_ROWS
    scored = model.transform(measured.withColumn("x", array_to_vector("x"))).select(*own, raw.alias("raw"))
    if not enough:
        return scored.select(*own, F.col("raw").alias("score"))
    known = model.transform(fit.where("part = 7")).select("toxic", raw.alias("raw"))
    curve = IsotonicRegression(featuresCol="raw", labelCol="toxic", predictionCol="level").fit(known)
    # The raw score orders documents of one level.
    return curve.transform(scored).select(*own, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("level") * 0.999 + F.col("raw") * 0.001)).alias("score"))
