"""Toxicity: a classifier chain of linear models over hashed words.

Categories are predicted one after another. The model of a category is logistic, over hashed
words and word beginnings that its labels select, and over the probabilities of the categories before it. Later
models are trained with out-of-fold predictions of the earlier ones, so they see the errors that they will meet.

Where labels name categories (``categories``: columns of 0 and 1), those are the chain's, in their order, and the label itself is the
last. Where there is the one label alone, the categories are learnt: the labelled texts' telling words are grouped by the texts in which
they occur together (spherical k-means over the words' rows, started at the most telling ones), and a positive text is of
the category whose words it holds most.

Training takes a bounded sample of labelled rows (``each`` a label); every whole text is scored.

Defined results: a null or empty text has no features and gets the intercepts' probabilities, as
does one without letters; it is never called toxic. Each row yields one row, repeated rows included; labels that repeat a
document are averaged. Without labels every probability is 0 and nothing is toxic. Extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import _learn, _shared, _text

#: Labelled rows of each label that training takes at most, about.
EACH = 3000
FOLDS = 5
#: Categories that are learnt where labels have none, and passes of the grouping.
LEARNT, PASSES = 3, 20
#: Words selected for a model at most, and how far (in standard deviations) their rates must differ.
SELECTED, DEVIATIONS = 600, 4.0


class Sample:
    """Distinct buckets of each text, one text after another."""

    def __init__(self, bags: list[np.ndarray]):
        self.bags = bags
        self.rows = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
        self.buckets = np.concatenate(bags) if bags else np.zeros(0, np.int64)

    def dense(self, chosen: np.ndarray) -> np.ndarray:
        place = np.full(_learn.WORD_BUCKETS, -1)
        place[chosen] = np.arange(len(chosen))
        at = place[self.buckets]
        out = np.zeros((len(self.bags), len(chosen)))
        out[self.rows[at >= 0], at[at >= 0]] = 1
        return out


def select(sample: Sample, y: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Buckets whose rates among positives and negatives of the given rows differ most clearly."""
    inside = rows[sample.rows]
    positive = np.bincount(sample.buckets[inside & (y[sample.rows] > 0)], minlength=_learn.WORD_BUCKETS)
    every = np.bincount(sample.buckets[inside], minlength=_learn.WORD_BUCKETS)
    n, n_pos = int(rows.sum()), int((rows & (y > 0)).sum())
    if not n_pos or n_pos == n:
        return np.zeros(0, np.int64)
    rate = every / n
    spread = np.sqrt(np.maximum(rate * (1 - rate), 1e-12) * (1 / n_pos + 1 / (n - n_pos)))
    z = np.where(every >= 3, (positive / n_pos - (every - positive) / (n - n_pos)) / spread, 0)
    best = np.argsort(-np.abs(z), kind="stable")[:SELECTED]
    return np.sort(best[np.abs(z[best]) >= DEVIATIONS])


class Chain:
    """Fitted models, in order: for each category its buckets, their weights, the weights of the earlier
    categories' probabilities, and the intercept; and the threshold of the last."""

    def __init__(self, names: list[str]):
        self.names, self.models, self.threshold = names, [], 2.0

    def fit(self, sample: Sample, labels: dict[str, np.ndarray], weights: np.ndarray | None = None) -> Chain:
        n = len(sample.bags)
        everything = np.ones(n, bool)
        fold = np.arange(n) % FOLDS
        earlier = np.zeros((n, 0))
        for name in self.names:
            y = labels[name].astype(float)
            out_of_fold = np.full(n, y.mean() if n else 0.0)
            for f in range(FOLDS):
                rows = fold != f
                chosen = select(sample, y, rows)
                x = np.hstack((sample.dense(chosen), earlier))
                if rows.any() and (~rows).any():
                    w = _learn.fit_logistic(x[rows], y[rows])
                    out_of_fold[~rows] = _learn.sigmoid(x[~rows] @ w[:-1] + w[-1])
            chosen = select(sample, y, everything)
            w = _learn.fit_logistic(np.hstack((sample.dense(chosen), earlier)), y)
            self.models.append((chosen, w[: len(chosen)], w[len(chosen) : -1], float(w[-1])))
            earlier = np.hstack((earlier, out_of_fold[:, None]))
        # the threshold with the best F1 out of fold
        p, y = earlier[:, -1], labels[self.names[-1]] > 0
        best = (-1.0, 0.5)
        for t in np.linspace(0.05, 0.95, 91):
            said = p >= t
            f1 = 2 * (said & y).sum() / max(1, said.sum() + y.sum())
            best = max(best, (float(f1), float(-abs(t - 0.5))))
        self.threshold = next((float(t) for t in sorted(np.linspace(0.05, 0.95, 91), key=lambda t: abs(t - 0.5)) if 2 * ((p >= t) & y).sum() / max(1, (p >= t).sum() + y.sum()) >= best[0] - 1e-12), 0.5)
        return self

    def predict(self, rows: np.ndarray, buckets: np.ndarray, n: int) -> np.ndarray:
        """Probabilities (n, categories) of texts given as (text, bucket) pairs."""
        p = np.zeros((n, len(self.names)))
        for k, (chosen, weights, before, intercept) in enumerate(self.models):
            table = np.zeros(_learn.WORD_BUCKETS)
            table[chosen] = weights
            p[:, k] = _learn.sigmoid(np.bincount(rows, table[buckets], n) + intercept + p[:, :k] @ before)
        return p


def learnt_categories(sample: Sample, positive: np.ndarray, count: int = LEARNT) -> np.ndarray:
    """For each text the category (0 to count - 1) whose telling words it holds most; -1 for negative texts and those with none."""
    chosen = select(sample, positive.astype(float), np.ones(len(sample.bags), bool))
    of = np.full(len(sample.bags), -1)
    held = sample.dense(chosen)[positive]
    more = held.mean(0) > sample.dense(chosen)[~positive].mean(0) if len(held) and (~positive).any() else np.zeros(len(chosen), bool)
    held = held[:, more]
    if held.shape[1] < count:
        return np.where(positive, 0, -1) if len(held) else of
    words = held.T / np.maximum(np.linalg.norm(held, axis=0), 1e-9)[:, None]  # a word is the texts that hold it
    starts = [int(held.sum(0).argmax())]
    while len(starts) < count:  # each next one the word least like those before
        starts.append(int((words @ words[starts].T).max(1).argmin()))
    centres = words[starts]
    for _ in range(PASSES):
        group = (words @ centres.T).argmax(1)
        sums = np.stack([words[group == k].sum(0) if (group == k).any() else centres[k] for k in range(count)])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1), 1e-9)[:, None]
    votes = held @ np.eye(count)[group]
    of[np.flatnonzero(positive)] = np.where(votes.any(1), votes.argmax(1), -1)
    return of


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", each: int = EACH, categories: list[str] | None = None) -> Chain:
    """Fit the chain on a sample of about ``each`` rows a label; the sample's ids are few and are broadcast."""
    _shared.small_batches(docs.sparkSession)
    categories = categories or []
    rate = lambda c: (F.coalesce(F.avg(c), F.lit(0.0)) >= 0.5).cast("int")
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("key")).agg(rate(label_col).alias("label"), *[rate(c).alias(f"c{j}") for j, c in enumerate(categories)])
    chosen = _learn.sample_keys(known, "key", "label", each)
    given = [f"c{j}" for j in range(len(categories))]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.blocks(batches, "text"):
            rows, buckets = _learn.word_features(*_text.buffers(b.column(b.num_columns - 1)))
            cuts = np.searchsorted(rows, np.arange(b.num_rows + 1))
            bags = [buckets[x:y].astype(np.int32).tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(bags, pa.binary())], names=["key", "label", *given, "bag"])

    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "key").select(F.col("key").cast("string").alias("key"), "label", *given, "text")
    rows = sorted(texts.mapInArrow(_text.lean(extract), f"key string, label int, {''.join(f'{c} int, ' for c in given)}bag binary").collect(), key=lambda r: (r["key"], r["label"], bytes(r["bag"])))
    names = [*(categories or [f"kind_{k + 1}" for k in range(LEARNT)]), label_col]
    chain = Chain(names)
    if not rows:
        return chain
    positive = np.array([r["label"] for r in rows]) > 0
    sample = Sample([np.frombuffer(bytes(r["bag"]), np.int32).astype(np.int64) for r in rows])
    if categories:
        targets = {name: np.array([r[c] for r in rows]) > 0 for name, c in zip(categories, given, strict=True)}
    else:
        of = learnt_categories(sample, positive)
        targets = {name: of == k for k, name in enumerate(names[:-1])}
    chain.fit(sample, targets | {label_col: positive})
    del rows, sample
    _text.give_back()
    return chain


def predict(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Id, ``keep`` columns, a probability p_<category> for each category, and toxic (boolean) of every whole text."""
    keep = [c for c in keep or [] if c not in (id_col, text_col)]
    chosen = docs.select(id_col, text_col, *keep)
    schema = T.StructType([chosen.schema[id_col], *[chosen.schema[c] for c in keep], *[T.StructField(f"p_{c}", T.DoubleType()) for c in chain.names], T.StructField("toxic", T.BooleanType())])
    shipped = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.blocks(batches, text_col):
            n = b.num_rows
            rows, buckets = _learn.word_features(*_text.buffers(b.column(1)))
            p = shipped.value.predict(rows, buckets, n) if shipped.value.models else np.zeros((n, len(chain.names)))
            toxic = (p[:, -1] >= shipped.value.threshold) & (np.bincount(rows, minlength=n) > 0)
            yield pa.RecordBatch.from_arrays([b.column(0), *[b.column(2 + j) for j in range(len(keep))], *[pa.array(p[:, k]) for k in range(p.shape[1])], pa.array(toxic)], names=schema.names)

    return chosen.mapInArrow(_text.lean(run), schema)
