"""Language-model scoring: an interpolated modified Kneser-Ney n-gram model of any order from 2 on.

Counting runs in the engine. Words are counted first and numbered by their place in the sorted
word table. Then tasks count the n-grams of their own texts as sequences of word numbers, packed counts are
dealt by hash, and reducers write sorted hash arrays to the shared folder, order by order: an
order's distinct n-grams, without their first word, are the continuation counts of the next lower
one. N-grams go by the hash of their context, so a context's statistics are complete in one place; those of
contexts that consist of hot words are spread by the whole n-gram's hash, and their partial statistics
are added up in the next exchange. Scoring maps the arrays into memory and looks a block's sorted
distinct words, contexts and n-grams up, shard after shard; no worker holds the model.

What is counted grows with the corpus: all training texts, whole, nothing pruned. Words are 64-bit hashes.

Defined results: A-Z count as a-z; words are runs without blanks; each text ends with one end
token, which counts; order - 1 begin marks stand before each text and are no tokens; a null or empty text is one end
token. A context that training does not know leaves the probability to the next lower order. Without training texts every
probability is 1. Each row yields one row, repeated rows included; a null training flag counts
as false; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import _files, _shared, _text

_U = np.uint64
END = _U(0xE0D0E0D0E0D0E0D1)
#: Word numbers: 0 is no known word, 1 the mark before a text; words begin at 2.
UNKNOWN, BEGIN, FIRST = 0, 1, 2
#: Words of the longest n-grams, unless the caller names another number.
ORDER = 3
#: Entries that a task counts before it passes them on.
HELD = 1 << 22
#: Bytes of text that are scored at once: each shard is searched once for all of them.
SCORED_BYTES = 8 << 20
#: Tasks here make many arrays of some MB.
HEAP = 32 << 20
#: What is left of an n-gram's bytes in an exchange, measured at order 3.
PACKED = 0.375
#: Values that most n-grams and contexts have: one occurrence; one n-gram, which occurs once.
ONCE, ONE_NEXT = [1], [1, 1, 0, 0]
_STATS = "kind string, shard int, data binary"
_BEGIN_MIXED = _text.mix(np.array([BEGIN], np.uint64))[0]


def tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all tokens, the ends of texts among them, and where each text begins in them (one more at the end)."""
    hashes, first = _text.words(data, at)
    return np.insert(hashes, first[1:], END), first + np.arange(len(first))


def sequences(numbers: np.ndarray, begins: np.ndarray, order: int, mark: int = BEGIN) -> list[np.ndarray]:
    """Every token's word number after those of the order - 1 words before it; ``mark`` stands before a text."""
    out = [numbers]
    for back in range(1, order):
        before = np.empty_like(numbers)
        before[back:] = numbers[:-back]
        for place in range(back):  # a text has one token at least
            first = begins[:-1] + place
            before[first[first < begins[1:]]] = mark
        out.insert(0, before)
    return out


def sequence_hash(columns: list[np.ndarray]) -> np.ndarray:
    return _text.sequence_hash([_text.mix(c.astype(_U)) for c in columns])


def _gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches put together up to ``limit`` bytes."""
    held, size = [], 0
    for b in batches:
        if held and size + b.nbytes > limit:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
        held.append(b)
        size += b.nbytes
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, their summed counts, and a position of each."""
    by = np.argsort(keys)
    keys = keys[by]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[by], first) if len(first) else counts[:0], by[first]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, a position of each, and each key's place among them. (numpy's own takes a stable sort, twice as slow.)"""
    by = np.argsort(keys)
    ordered = keys[by]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    back = np.empty(len(keys), np.int64)
    back[by] = np.cumsum(fresh) - 1
    return ordered[fresh], by[fresh], back


def _encoded(columns: list[np.ndarray]) -> bytes:
    """The columns, the first of which ascends, compressed: its steps, then each column's first bytes together, second bytes
    together and so on, as high bytes are mostly zero. The size before compression stands in front."""
    columns = [np.diff(columns[0], prepend=columns[0].dtype.type(0)), *columns[1:]]
    raw = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _decoded(batches: Iterator[pa.RecordBatch], kinds: list[str]) -> list[np.ndarray]:
    """The columns of all rows of ``_encoded`` in a partition."""
    sizes = [np.dtype(k).itemsize for k in kinds]
    parts: list[list[np.ndarray]] = [[np.zeros(0, k)] for k in kinds]
    for b in batches:
        for blob in b.column(1):
            data = blob.as_buffer()
            size = int.from_bytes(data[:8], "little")
            raw, at = pa.decompress(data.slice(8), size, "zstd"), 0
            n = size // sum(sizes)
            for j, (kind, width) in enumerate(zip(kinds, sizes, strict=True)):
                planes = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
                found = np.ascontiguousarray(planes.T).view(kind).ravel()
                parts[j].append(found if j else np.cumsum(found, dtype=kind))
                at += n * width
    return [np.concatenate(p) for p in parts]


def _row(kind: str, shard: int, data: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([shard], pa.int32()), pa.array([data.tobytes()], pa.binary())], names=["kind", "shard", "data"])


def _tagged(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([kind] * b.num_rows), *b.columns], names=["kind", "shard", "data"])


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how many entries occur 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = counts[:4]
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    found = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.0), k - 0.01) for k, d in enumerate(found, 1))


class Model:
    """Where the arrays are, and the few numbers that all workers need."""

    def __init__(self, uri: str, order: int, word_shards: int, shards: int, n_tokens: int, n_words: int):
        self.uri, self.order, self.word_shards, self.shards, self.n_tokens, self.n_words = uri, order, word_shards, shards, n_tokens, n_words
        #: The number of the first word of each shard of the word table.
        self.offsets = np.zeros(word_shards, np.int64)
        #: Sorted numbers of the words whose contexts would fill a shard.
        self.hot = np.zeros(0, np.int64)
        self.discounts: dict[int, tuple[float, float, float]] = {}
        self.types, self.lower_gamma = 0, 1.0

    @property
    def kind(self) -> str:
        return "u4" if self.n_words < (1 << 32) - FIRST else "u8"

    def number(self, words: _files.Table, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (0 if unknown) and counts of sorted distinct words."""
        shard = _files.range_shard(hashes, self.word_shards)
        count, place = words.get(hashes, shard, places=True)
        return np.where(place > 0, self.offsets[shard] + place - 1 + FIRST, UNKNOWN).astype(self.kind), count

    def is_hot(self, context: list[np.ndarray]) -> np.ndarray:
        """Contexts of hot words only; an n-gram that is frequent consists of words that are."""
        rows = np.arange(len(context[0]))
        for column in context:  # the next words of those only whose words so far are hot
            own = column[rows].astype(np.int64)
            rows = rows[self.hot[np.minimum(np.searchsorted(self.hot, own), len(self.hot) - 1)] == own]
        out = np.zeros(len(context[0]), bool)
        out[rows] = True
        return out

    def shard(self, gram: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """The shard of each n-gram, the hash of its context, and whether that is hot. Single words have no context."""
        if len(columns) == 1:
            return _files.range_shard(gram, self.shards), gram, None
        context, hot = sequence_hash(columns[:-1]), self.is_hot(columns[:-1])
        return self.dealt(gram, context, hot), context, hot

    def dealt(self, gram: np.ndarray, context: np.ndarray, hot: np.ndarray) -> np.ndarray:
        return _files.range_shard(np.where(hot, gram, context), self.shards)

    def close(self, counts: dict[int, np.ndarray]) -> None:
        """Discounts from each order's numbers of entries that occur 1, 2, 3 and 4 times, and of all."""
        self.discounts = {k: discounts(c.tolist()) for k, c in counts.items()}
        one, two, _, _, every = counts[1].tolist()
        self.types = int(counts[2][4])
        spare = sum(d * m for d, m in zip(self.discounts[1], (one, two, every - one - two), strict=True))
        self.lower_gamma = spare / self.types if self.types else 1.0


def _count_words(spark: SparkSession, texts: DataFrame, text_col: str, uri: str, order: int) -> Model:
    size = texts.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    shards = _shared.reducers(spark, float(size))

    def passed(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, counts, _ = _summed(*(np.concatenate(c) for c in zip(*held, strict=True)))
        return _shared.packed(_files.range_shard(keys, shards), [keys, counts.astype(np.uint32)], shards)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in _text.blocks(batches, text_col):
            own, _ = tokens(*_text.buffers(b.column(0)))
            held.append(_summed(own, np.ones(len(own), np.int64))[:2])
            size += len(held[-1][0])
            if size > HELD:
                yield from passed(held)
                held, size = [], 0
        if held:
            yield from passed(held)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = _shared.unpacked(batches, ["u8", "u4"])
        keys, counts, _ = _summed(keys, counts.astype(np.int64))
        at = _files.range_shard(keys, shards)
        for s in np.unique(at).tolist():
            k, c = keys[at == s], counts[at == s]
            _files.write_arrays(f"{uri}/words/{s:06d}", [k, _files.narrow(c)])
            hot = np.flatnonzero(c * 16 >= c.sum())  # at most 16 a shard
            yield _row("words", s, np.concatenate(([len(k), c.sum()], hot, c[hot])))

    rows = _shared.exchange(texts.mapInArrow(_text.lean(count, HEAP), "shard int, data binary"), shards, write, _STATS, HEAP).collect()  # one row a shard
    stats = {r["shard"]: np.frombuffer(bytes(r["data"]), np.int64) for r in rows}
    n_tokens = sum(int(s[1]) for s in stats.values())
    width = (4 * order + 4) * PACKED
    model = Model(uri, order, shards, _shared.reducers(spark, float(n_tokens * width)), n_tokens, sum(int(s[0]) for s in stats.values()))
    hot = [BEGIN]
    for s in sorted(stats):
        half = (len(stats[s]) - 2) // 2
        model.offsets[s + 1 :] += int(stats[s][0])
        hot += [int(model.offsets[s] + FIRST + place) for place, c in zip(stats[s][2 : 2 + half], stats[s][2 + half :], strict=True) if c * 16 * model.shards >= n_tokens]
    model.hot = np.unique(np.array(hot, np.int64))
    return model


def _reduce(model: Model, level: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Write the n-grams of ``level`` words, the contexts that are complete, and the hot contexts of the level above; pass the next level on."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, list[pa.RecordBatch]] = {"grams": [], "hot": []}
        for b in batches:
            kinds = np.array(b.column(0).to_pylist())
            for kind in np.unique(kinds).tolist():
                part = b.filter(pa.array(kinds == kind))
                if kind in kept:
                    kept[kind].append(part.select(["kind", "data"]))
                else:  # statistics pass through
                    yield part
        if kept["hot"]:
            context, *partial = _shared.unpacked(iter(kept["hot"]), ["u8", "i8", "i8", "i8", "i8"])
            by = np.argsort(context)
            start = np.flatnonzero(np.concatenate(([True], context[by][1:] != context[by][:-1])))
            _write_contexts(f"{model.uri}/hot{level + 1}", context[by][start], [np.add.reduceat(x[by], start) for x in partial], model.shards)
        *columns, counts = _decoded(iter(kept["grams"]), [model.kind] * level + ["u4"])
        kept.clear()
        gram, counts, at = _summed(sequence_hash(columns), counts.astype(np.int64))
        columns = [c[at] for c in columns]
        shard, context, hot = model.shard(gram, columns)
        for s in np.unique(shard).tolist():
            own = shard == s
            c = counts[own]
            _files.write_sparse(f"{model.uri}/grams{level}/{s:06d}", gram[own], [c], ONCE)
            yield _row(f"stats{level}", s, np.array([*[int((c == i).sum()) for i in (1, 2, 3, 4)], len(c)], np.int64))
        if level == 1:
            return
        by = np.argsort(context)
        start = np.flatnonzero(np.concatenate(([True], context[by][1:] != context[by][:-1]))) if len(by) else by
        if len(start):
            c = counts[by]
            sums = [np.add.reduceat(x, start, dtype=np.int64) for x in (c, c == 1, c == 2, c > 2)]
            context, hot = context[by][start], hot[by][start]
            _write_contexts(f"{model.uri}/contexts{level}", context[~hot], [x[~hot] for x in sums], model.shards)
            if hot.any():
                yield from _tagged(_shared.packed(_files.range_shard(context[hot], model.shards), [context[hot], *[x[hot] for x in sums]], model.shards), "hot")
        yield from _passed(model, columns[1:], np.ones(len(gram), np.int64))

    return write


def _write_contexts(uri: str, context: np.ndarray, sums: list[np.ndarray], shards: int) -> None:
    at = _files.range_shard(context, shards)
    for s in np.unique(at).tolist():
        _files.write_sparse(f"{uri}/{s:06d}", context[at == s], [x[at == s] for x in sums], ONE_NEXT)


def _passed(model: Model, columns: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """N-grams and counts, added up and packed for the exchange."""
    gram, counts, at = _summed(sequence_hash(columns), counts)
    columns = [c[at] for c in columns]
    shard, _, _ = model.shard(gram, columns)
    by = np.argsort(shard.astype(_U) << _U(32) | columns[0].astype(np.uint32))  # ascending first words in each shard
    shard, counts, columns = shard[by], counts[by], [c[by] for c in columns]
    return _tagged(_shared.packed(shard, [*columns, counts.astype(np.uint32)], model.shards, _encoded), "grams")


def train(docs: DataFrame, text_col: str = "text", order: int = ORDER) -> Model:
    """Count all texts of docs and write the model."""
    if order < 2:
        raise ValueError("the order is 2 or more")
    spark = docs.sparkSession
    _shared.small_batches(spark)
    texts = docs.select(text_col)
    uri = _shared.new_path(spark, "ngrams")
    model = _count_words(spark, texts, text_col, uri, order)

    def passed(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        return _passed(model, columns, np.ones(len(columns[0]), np.int64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _files.Table(f"{uri}/words", model.word_shards, 1)
        held, size = [], 0
        for b in _text.blocks(batches, text_col):
            own, begins = tokens(*_text.buffers(b.column(0)))
            distinct, _, where = _distinct(own)
            held.append(sequences(model.number(words, distinct)[0][where], begins, order))
            size += len(own)
            if size > HELD:  # few n-grams occur twice in a block, so they are added up here only
                yield from passed(held)
                held, size = [], 0
        if held:
            yield from passed(held)

    rows = texts.mapInArrow(_text.lean(count, HEAP), _STATS)
    for level in range(order, 0, -1):
        rows = _shared.exchange(rows, model.shards, _reduce(model, level), _STATS, HEAP)
    counts = {k: np.zeros(5, np.int64) for k in range(1, order + 1)}
    for r in rows.collect():  # one row of five numbers a shard and level
        counts[int(r["kind"].removeprefix("stats"))] += np.frombuffer(bytes(r["data"]), np.int64)
    model.close(counts)
    return model


_TABLES: dict[str, dict[str, _files.Table | _files.Sparse]] = {}


def _tables(model: Model) -> dict[str, _files.Table | _files.Sparse]:
    if model.uri not in _TABLES:
        _TABLES.clear()
        found = {"words": _files.Table(f"{model.uri}/words", model.word_shards, 1)}
        for k in range(1, model.order + 1):
            found[f"grams{k}"] = _files.Sparse(f"{model.uri}/grams{k}", model.shards, ONCE)
            for name in ("contexts", "hot") if k > 1 else ():
                found[f"{name}{k}"] = _files.Sparse(f"{model.uri}/{name}{k}", model.shards, ONE_NEXT)
        _TABLES[model.uri] = found
    return _TABLES[model.uri]


def _score_block(model: Model, tables: dict[str, _files.Table | _files.Sparse], data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    own, begins = tokens(data, at)
    distinct, _, where = _distinct(own)
    number, count = model.number(tables["words"], distinct)
    base = np.log10((count + 0.5) / (model.n_tokens + 0.5 * (model.n_words + 1)))[where]
    # one text more, of a begin mark only: its n-grams of marks are the contexts of first tokens
    number, spot, ends = np.append(number, number.dtype.type(BEGIN)), np.append(where, len(number)), np.append(begins, begins[-1] + 1)
    mixed, hot = _text.mix(number.astype(_U)), model.is_hot([number])
    columns, hot_word = sequences(mixed[spot], ends, model.order, _BEGIN_MIXED), hot[spot]
    # the n-grams of a level in the order of their hashes, and which one ends at each token: it is the next token's context
    context = _text.sequence_hash([mixed])
    by = np.argsort(context)
    context, hot = context[by], hot[by]
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    of = rank[spot]
    (continued,) = tables["grams1"].get(context, _files.range_shard(context, model.shards))
    discount = np.array([0.0, *model.discounts[1]])
    lower = np.maximum(continued - discount[np.minimum(continued, 3)], 0) / max(model.types, 1) + model.lower_gamma / (model.n_words + 1)
    p = lower[of]
    for k in range(2, model.order + 1):
        before = sequences(of, ends, 2, of[-1])[0]
        at_context = _files.range_shard(context, model.shards)
        total, *several = tables[f"contexts{k}"].get(context, at_context)
        rows = np.flatnonzero(hot)
        for column, values in zip((total, *several), tables[f"hot{k}"].get(context[rows], at_context[rows]), strict=True):
            column[rows] = values
        known = total > 0
        part = np.where(known, 1 / np.maximum(total, 1), 0.0)
        share = np.where(known, sum(d * x for d, x in zip(model.discounts[k], several, strict=True)) * part, 1.0)  # of the lower order: all without a known context
        gram, last = _text.sequence_hash(columns[model.order - k :]), before
        if k < model.order:  # each distinct n-gram is looked up once; the longest hardly occur twice in a block
            gram, first, of = _distinct(gram)
            last = before[first]
        (seen,) = tables[f"grams{k}"].get(gram, model.dealt(gram, context[last], hot[last]))
        discount = np.array([0.0, *model.discounts[k]])
        upper = np.maximum(seen - discount[np.minimum(seen, 3)], 0) * part[last]
        if k < model.order:
            upper, context, hot = upper[of], gram, hot[last] & hot_word[first]
        p = upper + share[before] * p
    p = p[:-1]
    sums = lambda x: np.add.reduceat(x, begins[:-1])  # noqa: E731  every text has its end token
    return np.diff(begins), sums((count > 0).astype(np.int64)[where]), sums(base), sums(np.log10(p))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Id, ``keep`` columns, n_tokens, n_known, train_tokens, base_score, score, perplexity of every whole text."""
    keep = [c for c in keep or [] if c not in (id_col, text_col)]
    chosen = docs.select(id_col, text_col, *keep)
    numbers = [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")] + [T.StructField(c, T.DoubleType()) for c in ("base_score", "score", "perplexity")]
    schema = T.StructType([chosen.schema[id_col], *[chosen.schema[c] for c in keep], *numbers])
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        tables = _tables(m)
        for b in _text.blocks(_gathered(batches, SCORED_BYTES), text_col, SCORED_BYTES):
            n, known, base, logp = _score_block(m, tables, *_text.buffers(b.column(1)))
            found = [pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(np.full(len(n), m.n_tokens), pa.int64()), pa.array(base), pa.array(logp), pa.array(10 ** np.minimum(-logp / n, 300))]
            yield pa.RecordBatch.from_arrays([b.column(0), *[b.column(2 + j) for j in range(len(keep))], *found], names=schema.names)

    return chosen.mapInArrow(_text.lean(run, HEAP), schema)


def train_and_score(docs: DataFrame, is_training: Column, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, order: int = ORDER) -> DataFrame:
    """Learn from the rows for which ``is_training`` holds, score all rows."""
    return score(docs, train(docs.where(F.coalesce(is_training, F.lit(False))), text_col, order), id_col, text_col, keep)
