"""Quality classifier with hierarchical empirical Bayes.

A classifier of dense text features gives each document a probability of being good.  Their sums by
host and by path, from grouped aggregation, become posteriors: a path shrinks toward its host and
a host toward the corpus, as strongly as the spread between groups says, so sparse sites stay
near the global prior.  A document's score joins its own evidence with its path's posterior,
from which its own share is taken out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .storage import drop, stored
from .toxicity import training_rows
from .wordhash import Texts, first_of, slices, words

SAMPLE_ROWS = 20_000
#: Bounds of a prior's weight in documents.
WEIGHT = (1.0, 1000.0)


def features(texts: Texts) -> np.ndarray:
    """Rates of marks, capitals, digits, cells and repeats, word lengths and distinct words; 0 for empty texts."""
    w, n, raw = words(texts), len(texts), texts.data
    row = np.repeat(np.arange(n), np.diff(w.rows))
    n_words, n_bytes = np.maximum(np.diff(w.rows), 1).astype(float), np.maximum(np.diff(texts.offsets), 1).astype(float)
    by_text = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[texts.offsets]) / n_bytes
    upper, lower = (raw >= 65) & (raw <= 90), (raw >= 97) & (raw <= 122)
    wide = raw >= 128
    plain = upper | lower | wide | ((raw >= 48) & (raw <= 57)) | np.isin(raw, np.frombuffer(b" .,\n", np.uint8))
    h = w.hashes
    distinct = np.zeros(n)
    again = np.zeros(n)
    if len(h):
        distinct = np.bincount(row[first_of(row, h)], minlength=n)
        again = np.bincount(row[1:][(h[1:] == h[:-1]) & (row[1:] == row[:-1])], minlength=n)
    length = np.bincount(row, w.ends - w.starts, n) / n_words
    cells = by_text((raw == 124) | (raw == 9))
    return np.column_stack([by_text(~plain), by_text(upper), by_text((raw >= 48) & (raw <= 57)), by_text((raw == 33) | (raw == 63)), cells, by_text(raw == 10), again / n_words, distinct / n_words, length, np.log1p(n_words)])


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in slices(batch.column("text")):
            x = features(texts)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            rows = batch.slice(texts.first, len(texts))
            yield pa.RecordBatch.from_arrays([*(rows.column(k) for k in ("doc_id", "host", "path")), lists], names=["doc_id", "host", "path", "x"])


def _logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(p / (1 - p))


def prior_weight(groups: DataFrame, total: str, n: str) -> float:
    """Weight of the prior in documents, from the spread of the groups' means beyond chance (method of moments)."""
    g = groups.agg(F.sum(n).alias("n"), F.sum(total).alias("s"), F.sum(F.col(total) * F.col(total) / F.col(n)).alias("q"), F.count("*").alias("k"), F.sum(F.col(n).cast("double") * F.col(n)).alias("n2")).first()
    if not g["n"] or g["k"] < 2:
        return WEIGHT[1]
    mean = g["s"] / g["n"]
    within = mean * (1 - mean)
    between = (g["q"] - g["n"] * mean**2 - (g["k"] - 1) * within) / max(g["n"] - g["n2"] / g["n"], 1e-9)
    return WEIGHT[1] if between <= 0 else min(WEIGHT[1], max(WEIGHT[0], within / between - 1))


def score_quality(docs: DataFrame, training: DataFrame, host: str, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, host, path, evidence, host_posterior, path_posterior, score, keep) for each row of ``docs``.

    ``training`` is (doc_id, toxic, part) as from ``training_rows``, where ``toxic`` is 1 for a good document.
    Null hosts and paths are groups of their own.  Null and empty texts have features of 0.  Repeated
    rows each count as evidence.  With fewer than two classes among the training rows, the evidence is
    the share of good ones (0.5 without any).  An empty table gives no row.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    sample = stored(training, "quality-training")
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"), F.col(text).alias("text"))
    measured = stored(source.mapInArrow(_measured, "doc_id long, host string, path string, x array<double>"), "quality-features")
    fit = measured.join(F.broadcast(sample), "doc_id").select(F.col("toxic").cast("double").alias("good"), array_to_vector("x").alias("x"))
    seen = {r["good"]: r["n"] for r in fit.groupBy("good").agg(F.count("*").alias("n")).collect()}
    if len(seen) == 2:
        model = GBTClassifier(featuresCol="x", labelCol="good", maxIter=15, maxDepth=4, stepSize=0.3, minInstancesPerNode=3, seed=2).fit(fit)
        told = model.transform(measured.withColumn("x", array_to_vector("x"))).withColumn("evidence", vector_to_array("probability")[1])
    else:
        told = measured.withColumn("evidence", F.lit(float(next(iter(seen), 0.5))))
    told = stored(told.select("doc_id", F.coalesce("host", F.lit("\0")).alias("host"), F.coalesce("path", F.lit("\0")).alias("path"), "evidence"), "evidence")
    # Tables of their own: joins on an aggregate's partitioning couldn't split a host with a third of all paths or documents.
    paths = stored(told.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("evidence").alias("s")), "paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s")), "hosts")
    g = hosts.agg(F.sum("host_s"), F.sum("host_n")).first()
    mean = g[0] / g[1] if g[1] else 0.5
    strong, near = prior_weight(hosts, "host_s", "host_n"), prior_weight(paths, "s", "n")
    sites = stored(paths.join(hosts, "host"), "sites")
    drop(paths, hosts)
    own = F.col("evidence")
    host_posterior = (strong * mean + F.col("host_s") - own) / (strong + F.col("host_n") - 1)
    path_posterior = (near * host_posterior + F.col("s") - own) / (near + F.col("n") - 1)
    out = told.join(sites, ["host", "path"]).withColumns({"host_posterior": host_posterior, "path_posterior": path_posterior})
    score = 1 / (1 + F.exp(-(_logit(own) + _logit(F.col("path_posterior")) - _logit(F.lit(mean)))))
    back = lambda c: F.when(F.col(c) != "\0", F.col(c)).alias(c)
    return out.withColumn("score", score).select("doc_id", back("host"), back("path"), "evidence", "host_posterior", "path_posterior", "score", (F.col("score") >= 0.5).alias("keep"))


def quality_training(labels: DataFrame, most: int = SAMPLE_ROWS) -> DataFrame:
    """Labelled rows of a bounded sample for :func:`score_quality`."""
    return training_rows(labels, label="quality", held_out=2, most=most)
