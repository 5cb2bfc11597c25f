"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph (a non-blank line; A-Z in lower case, words joined by one space) is hashed to a wide vector
and a document's fingerprint is the sum of its paragraphs' vectors, each lane modulo a power of two.
So order does not matter, and a paragraph is inserted or deleted by adding or subtracting its
vector (``add``, ``subtract``), without the rest of the text.

The vector has two parts. WIDE lanes modulo 2^64 are hashed from the whole paragraph: equal sums
mean equal multisets of paragraphs. SIGNED lanes modulo 2^32 are hashed from the paragraph's word
triples, each adding +1 or -1 to one lane: their inner products estimate how much two documents
share, with a standard deviation of about 1/sqrt(SIGNED).

Defined results: a null text counts as empty; the fingerprint of no paragraphs is all zero and is
alike (1.0) to itself only. In ``with_next`` rows are taken by descending id, a null id last, rows
of one id by their text; each row yields one row; the only row is its own next; extra columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import _shared, _text

WIDE, SIGNED, WIDTH = 8, 256, 3
#: Documents that one range of ``with_next`` is meant to hold, and the most ranges (beyond, they hold more and are sorted on disk).
RANGE_ROWS, MOST_RANGES = 1000, 20_000
_LANE = _text.mix(np.arange(900, 900 + WIDE, dtype=np.uint64))
_LINE = np.ones(256, bool)
_LINE[[10, 13]] = False


def vectors(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The WIDE (uint64) and SIGNED (int64, taken modulo 2^32) lanes of each text of a block."""
    n = len(at) - 1
    starts, ends = _text.word_spans(data, at, _text.BLANK_SPLIT)
    hashes = _text.span_hashes(data, starts, ends)
    begins, _ = _text.word_spans(data, at, _LINE)
    paragraph = np.searchsorted(begins, starts, side="right") - 1  # of each word
    text = np.searchsorted(at, starts, side="right") - 1
    wide = np.zeros((n, WIDE), np.uint64)
    signed = np.zeros((n, SIGNED))
    if not len(hashes):
        return wide, signed.astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (paragraph[1:] != paragraph[:-1]) | (text[1:] != text[:-1]))))
    place = np.arange(len(hashes)) - np.repeat(new, np.diff(np.concatenate((new, [len(hashes)]))))
    with np.errstate(over="ignore"):
        whole = _text.mix(np.add.reduceat(_text.mix(hashes + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), new))
        owner = text[new]
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        for lane in range(WIDE):
            wide[owner[first], lane] = np.add.reduceat(_text.mix(whole ^ _LANE[lane]), first)
    last = place + WIDTH > np.repeat(np.diff(np.concatenate((new, [len(hashes)]))), np.diff(np.concatenate((new, [len(hashes)]))))
    padded = np.concatenate((hashes, np.zeros(WIDTH - 1, np.uint64)))
    triple = _text.sequence_hash([padded[j : j + len(hashes)] for j in range(WIDTH)])
    triple = np.where(last, hashes, triple)  # the last words of a paragraph stand alone
    lane = text * SIGNED + (triple % np.uint64(SIGNED)).astype(np.int64)
    signed = np.bincount(lane, np.where(triple >> np.uint64(63), 1.0, -1.0), n * SIGNED).reshape(n, SIGNED)
    return wide, signed.astype(np.int64)


def render(wide: np.ndarray, signed: np.ndarray) -> list[str]:
    """Fingerprints as lowercase hex, lane after lane, the most significant digit first."""
    a, b = wide.astype(">u8"), (signed & 0xFFFFFFFF).astype(">u4")
    return [a[i].tobytes().hex() + b[i].tobytes().hex() for i in range(len(a))]


def parse(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = bytes.fromhex(fingerprint)
    return np.frombuffer(raw, ">u8", WIDE).astype(np.uint64), np.frombuffer(raw, ">i4", SIGNED, 8 * WIDE).astype(np.int64)


def fingerprint(text: str | None) -> str:
    """Of one text."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return render(*vectors(raw, np.array([0, len(raw)])))[0]


def add(a: str, b: str) -> str:
    """The fingerprint of both documents' paragraphs together."""
    (aw, as_), (bw, bs) = parse(a), parse(b)
    with np.errstate(over="ignore"):
        return render((aw + bw)[None], (as_ + bs)[None])[0]


def subtract(a: str, b: str) -> str:
    """The fingerprint after b's paragraphs have left a."""
    (aw, as_), (bw, bs) = parse(a), parse(b)
    with np.errstate(over="ignore"):
        return render((aw - bw)[None], (as_ - bs)[None])[0]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Row by row, the cosine of the signed lanes cut to 0..1; equal wide lanes are 1, an empty document is 0 to others."""
    x, y = a[1].astype(float), b[1].astype(float)
    norm = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    out = np.clip((x * y).sum(1) / np.where(norm > 0, norm, 1), 0, 1)
    return np.where((a[0] == b[0]).all(1), 1.0, out)


def _block(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raws = [t.encode() for t in texts]
    at = np.concatenate(([0], np.cumsum([len(r) for r in raws]))).astype(np.int64)
    return np.frombuffer(b"".join(raws), np.uint8), at


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Id, ``keep`` columns and the fingerprint of every whole text."""
    keep = [c for c in keep or [] if c not in (id_col, text_col)]
    chosen = docs.select(id_col, text_col, *keep)
    schema = T.StructType([chosen.schema[id_col], *[chosen.schema[c] for c in keep], T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.blocks(batches, text_col):
            found = render(*vectors(*_text.buffers(b.column(1))))
            yield pa.RecordBatch.from_arrays([b.column(0), *[b.column(2 + j) for j in range(len(keep))], pa.array(found, pa.string())], names=schema.names)

    return chosen.mapInArrow(_text.lean(run), schema)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_rows: int = RANGE_ROWS) -> DataFrame:
    """Fingerprint each text, its edited text (its last third replaced by the beginning of the next document) and compare.

    Documents go to ranges of ids, cut at quantiles of the ids; the first document of a range also
    goes, as a guest, to the range before, whose last document it follows. So the texts are
    shuffled once, and only the few cuts pass the driver.
    """
    _shared.small_batches(docs.sparkSession)
    least = -(1 << 63)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(least)).alias("k"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = docs.count()
    parts = min(max(1, -(-total // range_rows)), MOST_RANGES)
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, next_doc_id long"
    ids = rows.select("k")
    cuts = sorted(set(ids.agg(F.percentile_approx("k", [i / parts for i in range(1, parts)], 10 * parts)).first()[0])) if parts > 1 else []
    at = np.array(cuts, np.int64)  # range r holds ids in (cuts[r-1], cuts[r]]
    spread = ids.mapInArrow(lambda batches: _heads(batches, at), "r int, head long")
    heads = dict(spread.groupBy("r").agg(F.max("head")).collect())  # one row a range
    # the ranges that have rows, by descending ids: each one's first document follows the one before
    full = sorted(heads, reverse=True)
    before = {full[i]: full[i - 1] for i in range(len(full))}  # the first range's first document follows the last range's last

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = np.array([heads.get(r, 0) for r in range(len(at) + 1)], np.int64)
        for b in batches:
            k = b.column(0).to_numpy()
            r = np.searchsorted(at, k, side="left")
            guests = np.flatnonzero(k == tops[r])
            own = pa.RecordBatch.from_arrays([pa.array(r, pa.int32()), pa.array(np.zeros(len(k), bool)), *b.columns], names=["r", "guest", "k", "doc_id", "text"])
            yield own
            if len(guests):
                extra = b.take(pa.array(guests))
                yield pa.RecordBatch.from_arrays([pa.array([before[x] for x in r[guests].tolist()], pa.int32()), pa.array(np.ones(len(guests), bool)), *extra.columns], names=["r", "guest", "k", "doc_id", "text"])

    dealt = rows.mapInArrow(_text.lean(deal), "r int, guest boolean, k long, doc_id long, text string")
    ordered = dealt.repartition(max(1, len(full)), "r").sortWithinPartitions("r", "guest", F.desc("k"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int | None, str]] = []  # (range, id, text): the last row waits for its next
        done: set[int] = set()
        pairs: list[tuple[int | None, str, int | None, str]] = []
        size = 0
        for b in _text.blocks(batches, "text"):
            for r, guest, doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                if held and held[-1][0] == r and r not in done:
                    pairs.append((held[-1][1], held[-1][2], doc, text))
                    size += 2 * len(text)
                    held.clear()
                if guest:
                    done.add(r)  # of several rows with the head's id the first by text counts
                else:
                    held[:] = [(r, doc, text)]
            if size > _text.BLOCK_BYTES:
                yield _compare(pairs)
                pairs, size = [], 0
        if pairs:
            yield _compare(pairs)

    return ordered.mapInArrow(_text.lean(run), schema)


def _heads(batches: Iterator[pa.RecordBatch], cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The largest id of each range within each batch."""
    for b in batches:
        k = np.sort(b.column(0).to_numpy())
        r = np.searchsorted(cuts, k, side="left")
        if len(k):
            last = np.flatnonzero(np.concatenate((r[1:] != r[:-1], [True])))
            yield pa.RecordBatch.from_arrays([pa.array(r[last], pa.int32()), pa.array(k[last], pa.int64())], names=["r", "head"])


def _compare(pairs: list[tuple[int | None, str, int | None, str]]) -> pa.RecordBatch:
    edited = []
    for _, text, _, following in pairs:
        cut = len(text) // 3
        edited.append(text[: len(text) - cut] + following[:cut])
    own = vectors(*_block([p[1] for p in pairs]))
    changed = vectors(*_block(edited))
    # most next documents are in the block themselves, one place on
    where = {id(p[1]): i for i, p in enumerate(pairs)}
    away = [i for i, p in enumerate(pairs) if id(p[3]) not in where]
    other = vectors(*_block([pairs[i][3] for i in away]))
    place = np.array([where.get(id(p[3]), 0) for p in pairs])
    near = tuple(x[place] for x in own)
    for lanes, found in zip(near, other, strict=True):
        lanes[away] = found
    columns = [
        pa.array([p[0] for p in pairs], pa.int64()), pa.array([len(p[1]) for p in pairs], pa.int64()), pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
        pa.array(render(*own), pa.string()), pa.array(render(*changed), pa.string()), pa.array(likeness(own, changed), pa.float64()), pa.array(likeness(own, near), pa.float64()), pa.array([p[2] for p in pairs], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "next_doc_id"])
