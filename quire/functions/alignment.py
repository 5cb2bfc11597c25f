"""Edit distances, edit operations between two texts, and what is counted from them.

An alignment of least cost is not unique; here, going back from the ends, a match or replacement
is preferred, then a deletion, then an insertion. ``S + D + I`` and ``D - I`` do not depend on that.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPS = T.ArrayType(T.StructType().add("op", T.StringType()).add("src", T.IntegerType()).add("dst", T.IntegerType()))


def edit_distance(a: Sequence, b: Sequence, most: int | None = None) -> int:
    """Least number of unit-cost edits between two texts, or two lists of words; ``most``: the cost of some alignment, if one is known.

    Symbols that one side has more often than the other are edits in any case; where an alignment costs no more, it is the best. Else a band as wide
    as the known alignment, or an eighth, is searched: its best alignment is the best of all if it costs no more than the band is wide, and if not, a
    band of that cost holds the best one.
    """
    if a == b:
        return 0
    start, shared = 0, min(len(a), len(b))
    while start < shared and a[start] == b[start]:
        start += 1
    end = 0
    while end < shared - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = sorted((a[start : len(a) - end], b[start : len(b) - end]), key=len)
    if not a:
        return len(b)
    least = (Counter(b) - Counter(a)).total()
    if len(a) == len(b):
        places = sum(map(operator.ne, a, b))
        most = places if most is None else min(most, places)
    elif least == len(b) - len(a):
        rest = iter(b)
        if all(c in rest for c in a):
            return least
    if most == least:
        return least
    band = max(len(b) // 8 if most is None else most, len(b) - len(a), 64)
    found = _banded(a, b, band)
    return found if found <= max(band, least) else _banded(a, b, found)


def _banded(a: Sequence, b: Sequence, band: int) -> int:
    """Cost of the best alignment near the diagonal; a is not longer than b, and band not smaller than their difference.

    Myers' bit vectors: a column of the table is two integers, of the rows where it rises and where it falls. Columns go in blocks of ``step``, each
    with the rows that are within the band of one of its columns; above these a row rises with every column, below them every row rises.
    """
    step = max(64, band // 4)
    known, places, base, end = set(a), {}, 0, 0
    rise = fall = low = high = above = 0
    for j in range(0, len(a), step):
        block = a[j : j + step]
        first, last = max(0, j - band), min(len(b), j + step + band)
        if first > low:
            gone = (1 << first - low) - 1
            above += (rise & gone).bit_count() - (fall & gone).bit_count()
            rise, fall = rise >> first - low, fall >> first - low
        rise |= (1 << last - first) - (1 << high - first)
        low, high = first, last
        if high > end:  # where in b a symbol stands, for some blocks to come
            places, base, end = {}, low, min(len(b), low + max(4 * (high - low), 1 << 13))
            for i, c in enumerate(b[base:end]):
                if c in known:
                    places[c] = places.get(c, 0) | 1 << i
        mask = (1 << high - low) - 1
        at = {c: places.get(c, 0) >> low - base & mask for c in set(block)}
        for c in block:
            x = at[c] | fall
            same = (((x & rise) + rise ^ rise) | x) & mask
            right = (fall | mask ^ (rise | same)) << 1 | 1
            fall, rise = right & same, ((rise & same) << 1 | mask ^ ((right | same) & mask)) & mask
        above += len(block)
    return above + rise.bit_count() - fall.bit_count()


@F.pandas_udf(T.LongType())
def distance(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Edits between two columns, of texts or of arrays of words, in Arrow batches; null with either side null."""
    for a, b in pairs:
        yield pd.Series([None if x is None or y is None else edit_distance(x if isinstance(x, str) else list(x), y if isinstance(y, str) else list(y)) for x, y in zip(a, b, strict=True)], dtype="Int64")


@F.pandas_udf(T.StructType().add("strict", T.LongType()).add("content", T.LongType()))
def distances(rows: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Edits between strict and between content forms of texts; where the last two are null, the forms are the same.

    Where the content forms have a space for each line feed and no other change, an alignment of the strict forms costs no more on them.
    """
    for batch in rows:
        out = []
        for a, b, x, y in zip(*batch, strict=True):
            strict = edit_distance(a, b)
            if x is None:
                out.append((strict, strict))
            else:
                alike = x == a.replace("\n", " ") and y == b.replace("\n", " ")
                out.append((strict, edit_distance(x, y, strict if alike else None)))
        yield pd.DataFrame(out, columns=["strict", "content"])


def edit_operations(a: str, b: str) -> list[tuple[str, int, int]]:
    """(operation, position in a, position in b) in order, matches left out."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    x, y = a[start : len(a) - end], b[start : len(b) - end]
    codes = np.array([ord(c) for c in y], np.int64)
    rows = [np.arange(len(y) + 1)]
    steps = np.arange(len(y) + 1)
    for i, c in enumerate(x, 1):
        before = rows[-1]
        row = np.empty(len(y) + 1, np.int64)
        row[0] = i
        row[1:] = np.minimum(before[:-1] + (codes != ord(c)), before[1:] + 1)
        rows.append(np.minimum.accumulate(row - steps) + steps)  # insertions run along the row
    i, j, out = len(x), len(y), []
    while i or j:
        if i and j and rows[i][j] == rows[i - 1][j - 1] + (x[i - 1] != y[j - 1]):
            i, j = i - 1, j - 1
            if x[i] != y[j]:
                out.append(("replace", start + i, start + j))
        elif i and rows[i][j] == rows[i - 1][j] + 1:
            i -= 1
            out.append(("delete", start + i, start + j))
        else:
            j -= 1
            out.append(("insert", start + i, start + j))
    return out[::-1]


@F.pandas_udf(OPS)
def edit_ops(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """The operations of every pair, in Arrow batches; null with either text null."""
    for a, b in pairs:
        yield pd.Series([None if x is None or y is None else [{"op": o, "src": s, "dst": d} for o, s, d in edit_operations(x, y)] for x, y in zip(a, b, strict=True)])


def count_op(ops: Column, op: str) -> Column:
    return F.size(F.filter(ops, lambda o: o["op"] == op))


def merged_boundaries(ops: Column, gt: Column) -> Column:
    """Spaces of the truth that were deleted."""
    return F.size(F.filter(ops, lambda o: (o["op"] == "delete") & (F.substring(gt, o["src"] + 1, F.lit(1)) == " ")))


def split_boundaries(ops: Column, pred: Column) -> Column:
    """Spaces that were inserted."""
    return F.size(F.filter(ops, lambda o: (o["op"] == "insert") & (F.substring(pred, o["dst"] + 1, F.lit(1)) == " ")))


def glyph_hits(ops: Column, gt: Column, glyph: str) -> Column:
    """Places of a glyph in the truth that no replacement or deletion touches."""
    lost = F.size(F.filter(ops, lambda o: (o["op"] != "insert") & (F.substring(gt, o["src"] + 1, F.lit(1)) == glyph)))
    return F.length(gt) - F.length(F.replace(gt, F.lit(glyph), F.lit(""))) - lost


def diagonal_counts(glyphs: str) -> Callable[[Column, Column], Column]:
    """Function of truth and prediction: for every glyph how often it stands in each and how often in both at one place, in Arrow batches; null where a
    text is. For texts of one length whose best alignment is the diagonal."""
    many = len(glyphs)

    def count(a: str | None, b: str | None, number: np.ndarray) -> list[dict]:
        x, y = (None if t is None else np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in (a, b))
        n = 0 if x is None or y is None else min(len(x), len(y))
        both = None if x is None or y is None else x[:n][x[:n] == y[:n]]
        sums = [[None] * many if v is None else np.bincount(number[v], minlength=many).tolist() for v in (x, y, both)]
        return [{"gt": g, "pred": p, "correct": c} for g, p, c, _ in zip(*sums, glyphs)]

    @F.pandas_udf(T.ArrayType(T.StructType().add("gt", T.LongType()).add("pred", T.LongType()).add("correct", T.LongType())))
    def counts(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        number = np.full(0x110000, many, np.uint8)  # of the glyph that a code point is; the last one is for all others
        number[[ord(g) for g in glyphs]] = range(many)
        for a, b in pairs:
            yield pd.Series([count(x, y, number) for x, y in zip(a, b, strict=True)])

    return counts
