"""Benchmark decontamination: one Aho-Corasick automaton over the windows of the test items.

Texts and items are normalised alike: A-Z in lower case, words are runs of letters, digits and
non-ASCII bytes, everything else separates. A window is ``width`` consecutive words of an item;
an item of fewer words, but not none, is one window. The letters of the automaton are the words of the items, so a window
is ``width`` nodes at most however long its words are; each text is scanned once, and every hit is carried
back to offsets in the original text.

The items are gathered on the driver in blocks of at most ``nodes`` nodes, so that what a worker builds is bounded (about 130
bytes a node) however large the benchmark grows; with several blocks each text is scanned once a block, only rows with hits are
merged, and texts move once.

Defined results: a null or empty text has no words and no hits; null item texts have no windows, a null item id is the empty one;
every row yields one row, repeated rows included; several items may share a window; an empty
benchmark hits nothing; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import _shared, _text

#: Nodes of one automaton at most: words of its windows, counted once for each window.
NODES = 1 << 20
_KEPT = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_RUN = re.compile(rb"[^ ]+")
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normalise(text: str | None) -> bytes:
    """Same length as the text's UTF-8 bytes; what is not of a word is a space."""
    return (text or "").encode().translate(_KEPT)


def windows_of(text: str | None, width: int) -> list[str]:
    """The windows of one item, each as words joined and enclosed by spaces (a byte is a character)."""
    found = [w.decode("latin-1") for w in normalise(text).split()]
    if not found:
        return []
    return [" " + " ".join(found[i : i + width]) + " " for i in range(max(1, len(found) - width + 1))]


class Windows:
    """The words of the items, numbered from 1, and an automaton over all windows; a window's value is its number of words and the items that have it."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        owners: dict[tuple[int, ...], list[str]] = {}
        self.numbers: dict[bytes, int] = {}
        for item, text in items:
            found = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in normalise(text).split())
            for i in range(max(1, len(found) - width + 1) if found else 0):
                owners.setdefault(found[i : i + width], []).append(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, of in owners.items():
            self.automaton.add_word(window, (len(window), sorted(set(of))))
        if owners:
            self.automaton.make_automaton()


def scan(text: str | None, windows: Windows) -> tuple[int, list[tuple[int, int]], list[str]]:
    """The number of words, the merged spans of hit words (first, one past the last), and the items."""
    number = windows.numbers.get
    found = tuple([number(w, 0) for w in normalise(text).split()])
    spans: list[list[int]] = []
    items: set[str] = set()
    for at, (size, owners) in windows.automaton.iter(found) if found and windows.numbers else ():
        first, last = at + 1 - size, at + 1
        while spans and spans[-1][0] > first:  # a longer window that ends here begins earlier
            last = max(last, spans.pop()[1])
        if spans and first <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], last)
        else:
            spans.append([first, last])
        items.update(owners)
    return len(found), [(a, b) for a, b in spans], sorted(items)


def offsets(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words as offsets of characters in the original text."""
    raw = text.encode()
    runs = [m.span() for m in _RUN.finditer(raw.translate(_KEPT))]
    out, at, chars = [], 0, 0
    for a, b in spans:
        first, last = runs[a][0], runs[b - 1][1]
        chars += len(raw[at:first].decode())
        begin = chars
        chars += len(raw[first:last].decode())
        at = last
        out.append((begin, chars))
    return out


_ROW = "_quire_row"


def find_hits(docs: DataFrame, benchmark: DataFrame, width: int = 8, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep: list[str] | None = None, with_offsets: bool = True, nodes: int = NODES) -> DataFrame:
    """One row a document: id, ``keep`` columns, n_words, n_hit, spans (of words), items, and char_spans with ``with_offsets``."""
    spark = docs.sparkSession
    _shared.small_batches(spark)
    items = benchmark.where(F.col(item_text_col).isNotNull()).select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).alias("item_text"))
    weight = items.agg(F.sum(F.regexp_count("item_text", F.lit(WORD)) * F.lit(width))).first()[0] or 0
    count = int(-(-weight // nodes)) or 1
    keep = [c for c in keep or [] if c != id_col]
    chosen = docs.select(id_col, text_col, *[c for c in keep if c != text_col])
    if count > 1:  # a row's parts meet again by its number
        chosen = _shared.materialize(chosen.withColumn(_ROW, F.monotonically_increasing_id()), "numbered")
    span = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))
    found_fields = [T.StructField("n_words", T.LongType()), T.StructField("spans", span), T.StructField("items", T.ArrayType(T.StringType())), *[T.StructField("char_spans", span)] * with_offsets]
    pairs = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def block(number: int, carried: list[str]) -> DataFrame:
        own = items.where(F.pmod(F.xxhash64("item", "item_text"), F.lit(count)) == number) if count > 1 else items
        shipped = spark.sparkContext.broadcast(sorted((r[0], r[1]) for r in own.collect()))  # the items of about ``nodes`` nodes
        names = [*carried, *[f.name for f in found_fields]]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            windows = Windows(shipped.value, width)  # for this task alone
            for b in _text.blocks(batches, text_col):
                texts = b.column(b.schema.get_field_index(text_col)).to_pylist()
                found = [scan(t, windows) for t in texts]
                columns = [*[b.column(b.schema.get_field_index(c)) for c in carried], pa.array([f[0] for f in found], pa.int64()), _spans([f[1] for f in found], pairs), pa.array([f[2] for f in found], pa.list_(pa.string()))]
                if with_offsets:
                    columns.append(_spans([offsets(t, f[1]) if f[1] else [] for t, f in zip(texts, found, strict=True)], pairs))
                yield pa.RecordBatch.from_arrays(columns, names=names)

        return chosen.mapInArrow(_text.lean(run), T.StructType([*[chosen.schema[c] for c in carried], *found_fields]))

    if count == 1:
        out = block(0, [id_col, *keep])
    else:
        parts = block(0, [_ROW])
        hits = parts.where(F.size("items") > 0)
        for number in range(1, count):
            hits = hits.unionByName(block(number, [_ROW]).where(F.size("items") > 0))
        merged = [merge_spans(F.flatten(F.collect_list(c))).alias(c) for c in ["spans", *["char_spans"] * with_offsets]]
        hits = hits.groupBy(_ROW).agg(*merged, F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        found = parts.select(_ROW, "n_words").join(hits, _ROW, "left").select(_ROW, "n_words", *[F.coalesce(f.name, F.array().cast(f.dataType)).alias(f.name) for f in found_fields[1:]])
        out = chosen.select(_ROW, id_col, *keep).join(found, _ROW)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return out.select(id_col, *keep, "n_words", hit.alias("n_hit"), "spans", "items", *["char_spans"] * with_offsets)


def _spans(rows: list[list[tuple[int, int]]], kind: pa.DataType) -> pa.Array:
    flat = np.array([x for r in rows for x in r], np.int64).reshape(-1, 2)
    at = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], fields=list(kind.value_type)))


def merge_spans(spans):
    """Overlapping or touching spans of an array become one."""
    empty = F.expr("cast(array() as array<struct<first:bigint,last:bigint>>)")

    def step(done, span):
        tail = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(tail["first"].alias("first"), F.greatest(tail["last"], span["last"]).alias("last"))))
        return F.when(F.size(done) == 0, F.array(span)).when(span["first"] <= tail["last"], joined).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), empty, step)


def cut(text: str, spans: str):
    """The text of a column without its spans of characters, a space in the place of each."""
    before, after = f"CASE WHEN i = 0 THEN 0 ELSE {spans}[i - 1].last END", f"CASE WHEN i = size({spans}) THEN length({text}) ELSE {spans}[i].first END"
    return F.expr(f"array_join(transform(sequence(0, size({spans})), i -> substring({text}, cast({before} + 1 as int), cast(({after}) - ({before}) as int))), ' ')")


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 8, min_items: int = 2, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The documents, all columns kept whatever their names, without those in which windows of ``min_items`` items or more occur. From the others every window that occurs is cut out and the length renewed."""
    plain = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    name = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    own, text = name[id_col], name[text_col]
    found = find_hits(plain, benchmark, width, own, text, keep=[c for c in plain.columns if c != own])
    hit = F.size("char_spans") > 0
    out = found.where(F.size("items") < min_items).withColumn("_clean", F.when(hit, cut(text, "char_spans")).otherwise(F.col(text)))
    fresh = {text: F.col("_clean")}
    if length_col in name:
        length = name[length_col]
        fresh[length] = F.when(hit, F.length("_clean").cast(docs.schema[length_col].dataType)).otherwise(F.col(length))
    return out.select(*[fresh.get(c, F.col(c)).alias(c) for c in plain.columns]).toDF(*docs.columns)


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
