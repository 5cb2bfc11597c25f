"""Quality classifier: hierarchical empirical Bayes over hosts and paths.

A logistic model over byte and word statistics gives each document its own evidence. Labels (and,
with a small weight, the evidence of unlabelled documents) are added up by path and host; hosts shrink toward the global rate
and paths toward their host, by prior strengths that the method of moments estimates from the
sites themselves. A document's score joins its own evidence with its path's posterior, its own
share taken out. Sites are added up before they meet documents; a hot host is an ordinary row of a small table.

Defined results: a null or empty text counts as one without words; a null host or path is a site of its own;
without labels the score is 0.5 and everything is kept; labels that repeat a document are averaged;
each row yields one row; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import _learn, _text
from quire.llm._shared import materialize, small_batches

#: Labelled rows of each label in training, about; what an unlabelled document weighs against a labelled one.
EACH, SOFT = 2000, 0.05
#: Sites up to which their table is broadcast to the documents (about 80 bytes each).
BROADCAST_SITES = 200_000


def statistics(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Features of each text: shares of byte classes, word lengths, distinct words, line lengths, repeated lines."""
    n = len(at) - 1
    owner_first = at[:-1]
    size = np.diff(at).astype(float)
    classes = np.zeros(256, np.uint8)
    classes[65:91], classes[97:123], classes[48:58], classes[128:] = 1, 2, 3, 4
    classes[[9, 10, 11, 12, 13, 32]] = 5
    for c in b"#$%&*|<>{}[]@~^=_+\\/!":
        classes[c] = 6
    kinds = classes[data] if len(data) else np.zeros(0, np.uint8)
    full = size > 0
    shares = np.zeros((n, 7))
    for k in range(7):
        if full.any():
            shares[full, k] = np.add.reduceat(kinds == k, owner_first[full], dtype=np.int64)
    shares /= np.maximum(size, 1)[:, None]
    hashes, first = _text.words(data, at)
    words = np.diff(first).astype(float)
    owner = np.repeat(np.arange(n), np.diff(first))
    distinct = np.bincount((np.unique(owner.astype(np.uint64) << np.uint64(44) | hashes >> np.uint64(20)) >> np.uint64(44)).astype(np.int64), minlength=n)
    line = np.ones(256, bool)
    line[10] = False
    starts, ends = _text.word_spans(data, at, line)
    line_owner = np.searchsorted(at, starts, side="right") - 1
    lines = np.bincount(line_owner, minlength=n).astype(float)
    keys = line_owner.astype(np.uint64) << np.uint64(44) | _text.span_hashes(data, starts, ends) >> np.uint64(20)
    distinct_lines = np.bincount((np.unique(keys) >> np.uint64(44)).astype(np.int64), minlength=n)
    return np.column_stack((
        np.log1p(size), np.log1p(words), np.minimum(size / np.maximum(words, 1), 60) / 10, shares[:, 0], shares[:, 1], shares[:, 2], shares[:, 3], shares[:, 4], shares[:, 5], shares[:, 6], np.sqrt(shares[:, 6]), np.sqrt(shares[:, 1]),
        distinct / np.maximum(words, 1), np.log1p(size / np.maximum(lines, 1)), distinct_lines / np.maximum(lines, 1),
    ))


class Evidence:
    """A logistic model over standardised statistics and their squares."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weights: np.ndarray):
        self.fitted = len(y) > 0 and 0 < y.sum() < len(y)
        if self.fitted:
            self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
            self.weights = _learn.fit_logistic(self._expand(x), y, 1e-3, weights)

    def _expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack((z, z * z))

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), 0.5)
        return np.clip(_learn.sigmoid(self._expand(x) @ self.weights[:-1] + self.weights[-1]), 1e-4, 1 - 1e-4)


def train(docs: DataFrame, known: DataFrame, id_col: str, text_col: str, each: int = EACH) -> Evidence:
    """known: key, label (0 or 1), a row a document. The sample has a bounded size and is broadcast."""
    chosen = _learn.sample_keys(known.select("key", F.col("label").cast("int").alias("label")), "key", "label", each)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.blocks(batches, "text"):
            x = statistics(*_text.buffers(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["label", "x"])

    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "key").select("label", "text").mapInArrow(_text.lean(extract), "label int, x array<double>").collect()
    rows = sorted((r["label"], tuple(r["x"])) for r in rows)
    y = np.array([float(r[0]) for r in rows])
    counts = {r["label"]: r["count"] for r in known.groupBy(F.col("label").cast("int").alias("label")).count().collect()}
    weights = np.array([counts[int(v)] / max(1, (y == v).sum()) for v in y])  # the labels' shares in all labelled rows
    return Evidence(np.array([r[1] for r in rows]), y, weights / weights.mean() if len(y) else weights)


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.log(p / (1 - p))


def _strength(rates: DataFrame, mean: float) -> float:
    """Prior strength of Beta priors around ``mean`` by the method of moments; rates: n, k by site."""
    n, k = F.col("n"), F.col("k")
    sums = rates.where("n > 0").agg(F.sum(n).alias("n"), F.count("*").alias("sites"), F.sum(n * (k / n - mean) ** 2).alias("spread"), F.sum(n * n).alias("nn")).first()
    if not sums["sites"] or sums["sites"] < 2 or not 0 < mean < 1:
        return 10.0
    within = mean * (1 - mean)
    room = sums["n"] - sums["nn"] / sums["n"]
    between = (sums["spread"] - (sums["sites"] - 1) * within) / max(room, 1e-9)
    return float(min(1000.0, max(1.0, within / max(between, 1e-6) - 1)))


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.5, each: int = EACH) -> DataFrame:
    """Id, host, path, evidence (the classifier's), host_rate, path_rate (posteriors without the document), quality_score and keep."""
    small_batches(docs.sparkSession)
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("key")).agg((F.avg(label_col) >= 0.5).cast("double").alias("label"))
    shipped = docs.sparkSession.sparkContext.broadcast(train(docs, known, id_col, text_col, each))
    chosen = docs.select(F.col(id_col).alias("id"), F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.coalesce(path.cast("string"), F.lit("")).alias("path"), F.col(text_col).alias("text"))
    schema = T.StructType([*chosen.schema.fields[:3], T.StructField("evidence", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.blocks(batches, "text"):
            p = shipped.value.predict(statistics(*_text.buffers(b.column(3))))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(p)], names=schema.names)

    # evidence is rounded, so that sums do not depend on the order in which they are added
    rows = chosen.mapInArrow(_text.lean(run), schema).withColumn("evidence", F.round("evidence", 6))
    rows = rows.join(known, F.col("id") == F.col("key"), "left").select("id", "host", "path", "evidence", "label", F.when(F.col("label").isNull(), F.lit(SOFT)).otherwise(F.lit(1.0)).alias("w"))
    rows = materialize(rows.withColumn("own", F.col("w") * F.coalesce("label", "evidence")), "evidence")
    paths = materialize(rows.groupBy("host", "path").agg(F.sum("w").alias("n"), F.sum("own").alias("k"), F.sum(F.col("label").isNotNull().cast("long")).alias("labelled")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = paths.agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum("labelled").alias("labelled"), F.count("*").alias("sites")).first()
    mean = (total["k"] + 1) / (total["n"] + 2) if total["n"] else 0.5
    strong_host, strong_path = _strength(hosts, mean), _strength(paths, mean)
    sites = paths.select("host", "path", F.col("n").alias("n_path"), F.col("k").alias("k_path")).join(hosts.select("host", F.col("n").alias("n_host"), F.col("k").alias("k_host")), "host")
    if (total["sites"] or 0) <= BROADCAST_SITES:
        sites = F.broadcast(sites)
    out = rows.join(sites, ["host", "path"])
    host_rate = (F.col("k_host") - F.col("own") + strong_host * mean) / (F.col("n_host") - F.col("w") + strong_host)
    out = out.withColumn("host_rate", host_rate)
    out = out.withColumn("path_rate", (F.col("k_path") - F.col("own") + strong_path * F.col("host_rate")) / (F.col("n_path") - F.col("w") + strong_path))
    score = 1 / (1 + F.exp(-(_logit(F.col("evidence")) + _logit(F.col("path_rate")) - _logit(F.lit(mean)))))
    score = score if total["labelled"] else F.lit(0.5)
    return out.select(F.col("id").alias(id_col), "host", "path", "evidence", "host_rate", "path_rate", score.alias("quality_score"), (score >= threshold).alias("keep"))
