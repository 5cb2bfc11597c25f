"""Language ID: averaged hashed subword embeddings with a linear softmax.

A text is the average of its subwords' embeddings: the n-grams of 1 to 4 characters of its words, with
their bounds, in lower case, hashed to BUCKETS rows. Embeddings and softmax are trained together by stochastic
gradient descent in numpy on a bounded sample of labelled rows (``each`` a language). A part of the
sample is kept back: on it the softmax's temperature is fitted, so that the score is a calibrated probability, and
the rejection threshold is set so that all but one in a thousand of its rightly predicted texts pass.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected;
without training rows every text is. Each row yields one row, repeated rows included; texts of any length
count whole. Only text and language are learned from; extra columns are not read.
"""

from __future__ import annotations

import sys
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import _learn, _shared, _text

BUCKETS, DIMENSIONS = 1 << 16, 16
#: Labelled rows of each language that training takes, about; the share kept back; passes over the rest.
EACH, BACK, EPOCHS, BATCH, RATE = 1000, 0.25, 6, 32, 0.4
#: Bytes of text whose n-grams are held at once.
PIECE = 1 << 20
_ODD = _text.mix(np.arange(300, 304, dtype=np.uint64)) | np.uint64(1)
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(sys.maxunicode + 1)]))
    return _LETTER[0]


def has_letter(text: str) -> bool:
    return text.isascii() and any(c.isalpha() for c in text[:256]) or any(unicodedata.category(c)[0] == "L" for c in text)


def subwords(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of all subwords, n-gram length by n-gram length, piece by piece.

    A longer text goes in pieces that share three characters: an n-gram counts in the piece in which it begins, and
    word bounds stand at the text's own ends only, so the n-grams are those of the whole text.
    """
    points, owners, size = [], [], 0
    for i, text in enumerate(texts):
        low = f" {text.lower()} "
        for a in range(0, len(low), PIECE):
            points.append(np.frombuffer(low[a : a + PIECE + 3].encode("utf-32-le", "replace"), np.uint32))
            owners.append((i, len(points[-1]), min(PIECE, len(low) - a)))
            size += len(points[-1])
            if size > PIECE:
                yield from _ngrams(points, owners)
                points, owners, size = [], [], 0
    if points:
        yield from _ngrams(points, owners)


def _ngrams(points: list[np.ndarray], owners: list[tuple[int, int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """owners: text, characters, and how many of them an n-gram may begin with."""
    point = np.concatenate(points)
    owner = np.repeat([o for o, _, _ in owners], [n for _, n, _ in owners])
    begins = np.concatenate([np.arange(n) < own for _, n, own in owners])
    letter = _letters()[point]
    point = np.where(letter, point, 0).astype(np.uint64)
    inner = letter  # all characters but the first and the last are letters
    for n in range(1, 5):
        m = len(point) - n + 1
        if m <= 0:
            return
        with np.errstate(over="ignore"):
            value = np.full(m, n, np.uint64)
            for j in range(n):
                value += point[j : j + m] * _ODD[j]
            value *= np.uint64(0x9E3779B97F4A7C15)
        if n == 1:
            good = letter
        elif n == 2:
            good = letter[:m] | letter[1:]
        else:
            good = inner[1 : 1 + m].copy()
            for j in range(2, n - 1):
                good &= inner[j : j + m]
        good = good & begins[:m]
        yield owner[:m][good], (value[good] >> np.uint64(48)).astype(np.int64)


class Model:
    """Languages, one logit column each for every bucket, temperature and threshold."""

    def __init__(self, languages: list[str]):
        self.languages = languages
        self.table = np.zeros((BUCKETS, max(1, len(languages))), np.float32)
        self.bias = np.zeros(max(1, len(languages)))
        self.temperature, self.threshold = 1.0, 0.0

    def logits(self, texts: list[str]) -> np.ndarray:
        total, count = np.zeros((len(texts), self.table.shape[1])), np.zeros(len(texts))
        for owner, bucket in subwords(texts):
            if len(owner):
                first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                total[owner[first]] += np.add.reduceat(self.table[bucket], first, axis=0)
                count += np.bincount(owner, minlength=len(texts))
        return total / np.maximum(count, 1)[:, None] + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def bag(text: str) -> bytes:
    """Distinct buckets of a text and their counts, compressed; empty without any."""
    counts = np.zeros(BUCKETS, np.int64)
    for _, bucket in subwords([text]):
        counts += np.bincount(bucket, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    kind = np.min_scalar_type(counts.max())
    planes = at.astype(np.uint16).view(np.uint8).reshape(-1, 2).T.tobytes()  # high bytes apart, as they hardly change
    return kind.char.encode() + zlib.compress(planes + counts[at].astype(kind).tobytes(), 6) if len(at) else b""


def opened(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and shares of a bag."""
    kind, raw = np.dtype(packed[:1].decode()), np.frombuffer(zlib.decompress(packed[1:]), np.uint8)
    n = len(raw) // (2 + kind.itemsize)
    counts = raw[2 * n :].view(kind).astype(float)
    return np.ascontiguousarray(raw[: 2 * n].reshape(2, n).T).view(np.uint16)[:, 0].astype(np.int32), (counts / counts.sum()).astype(np.float32)


def fit(bags: list[bytes], labels: list[str], seed: int = 7) -> Model:
    """Train on bags of buckets; a fixed share is kept back for calibration."""
    model = Model(sorted(set(labels)))
    if not bags:
        return model
    rng = np.random.default_rng(seed)
    y = np.searchsorted(model.languages, labels)
    order = rng.permutation(len(bags))
    n_back = int(len(bags) * BACK) if len(bags) >= 8 else 0
    back, rest = order[:n_back], order[n_back:]
    embedding = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    output = np.zeros((DIMENSIONS, len(model.languages)), np.float32)
    bias = np.zeros(len(model.languages), np.float32)
    e2, o2, b2 = np.full(BUCKETS, 1e-8, np.float32), np.full_like(output, 1e-8), np.full_like(bias, 1e-8)  # AdaGrad sums
    target = np.eye(len(model.languages), dtype=np.float32)
    for _ in range(EPOCHS):
        rng.shuffle(rest)
        for a in range(0, len(rest), BATCH):
            rows = rest[a : a + BATCH]
            own = [opened(bags[i]) for i in rows]
            used, place = np.unique(np.concatenate([at for at, _ in own]), return_inverse=True)
            x = np.zeros((len(rows), len(used)), np.float32)
            x[np.repeat(np.arange(len(rows)), [len(at) for at, _ in own]), place] = np.concatenate([share for _, share in own])
            hidden = x @ embedding[used]
            z = hidden @ output + bias
            z = np.exp(z - z.max(1, keepdims=True))
            error = (z / z.sum(1, keepdims=True) - target[y[rows]]) / len(rows)
            to_output, to_bias, to_used = hidden.T @ error, error.sum(0), x.T @ (error @ output.T)
            o2 += to_output**2
            b2 += to_bias**2
            e2[used] += (to_used**2).mean(1)
            output -= RATE * to_output / np.sqrt(o2)
            bias -= RATE * to_bias / np.sqrt(b2)
            embedding[used] -= RATE * to_used / np.sqrt(e2[used])[:, None]
    model.table, model.bias = embedding @ output, bias.astype(float)
    if len(back):
        logits = np.stack([(model.table[at] * share[:, None]).sum(0) for at, share in (opened(bags[i]) for i in back)]) + model.bias
        losses = []
        for t in np.geomspace(0.1, 20, 60):
            model.temperature = float(t)
            losses.append((-np.log(np.maximum(model.probabilities(logits)[np.arange(len(back)), y[back]], 1e-12)).mean(), float(t)))
        model.temperature = min(losses)[1]
        p = model.probabilities(logits)
        right = p.argmax(1) == y[back]
        if right.any():
            model.threshold = float(min(0.5, np.quantile(p.max(1)[right], 0.001)))
    return model


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", key_col: str = "doc_id", each: int = EACH) -> Model:
    """Learn from about ``each`` rows of every language of docs; the key only draws the sample."""
    _shared.small_batches(docs.sparkSession)
    chosen = _learn.sample_keys(docs.select(F.col(key_col).alias("key"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("text is not null"), "key", "lang", each)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([bag(t) for t in b.column(1).to_pylist()], pa.binary())], names=["lang", "bag"])

    found: dict[str, list[bytes]] = {}
    for r in chosen.select("lang", "text").mapInArrow(_text.lean(extract), "lang string, bag binary").collect():
        if r["bag"]:
            found.setdefault(r["lang"], []).append(bytes(r["bag"]))
    _shared.give_back(docs.sparkSession)
    order = lambda packed: tuple(column.tobytes() for column in opened(packed))
    rows = [(lang, packed) for lang in sorted(found) for packed in sorted(found.pop(lang), key=order)]
    model = fit([packed for _, packed in rows], [lang for lang, _ in rows])
    del rows
    _text.give_back()
    return model


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (the text may be one), lang_pred, score and rejected of every whole text."""
    keep = keep or []
    chosen = docs.select(F.col(text_col).alias("_quire_text"), *[c for c in keep if c != text_col])
    schema = T.StructType([*[docs.select(c).schema[0] for c in keep], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for b in _text.blocks(batches, "_quire_text"):
            texts = [t or "" for t in b.column(0).to_pylist()]
            p = m.probabilities(m.logits(texts))
            und = np.array([not m.languages or not has_letter(t) for t in texts], bool)
            best = p.argmax(1)
            score = np.where(und, 0.0, p[np.arange(len(texts)), best])
            said = ["und" if u else m.languages[k] for u, k in zip(und.tolist(), best.tolist(), strict=True)]
            kept = [b.column(0) if c == text_col else b.column(b.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(said, pa.string()), pa.array(score), pa.array(und | (score < m.threshold))], names=schema.names)

    return chosen.mapInArrow(_text.lean(run), schema)


def reject(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents, all columns kept whatever their names, without those that the model rejects."""
    plain = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    found = predict(plain, model, f"_c{docs.columns.index(text_col)}", keep=plain.columns)
    return found.where(~F.col("rejected")).select(*plain.columns).toDF(*docs.columns)


def in_fold(key: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the key's text, modulo ``folds``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds
