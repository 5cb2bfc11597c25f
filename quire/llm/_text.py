"""Vectorised text kernels that the operators of this subpackage share.

Everything here works on one block of texts at a time: the UTF-8 bytes of the block in one array
and the offsets of its texts. Memory is bounded by the block (``blocks``) and by SEGMENT, not by a
partition. Hashes are 64 bits wide and do not depend on how texts are dealt to blocks.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one block holds (a longer text is a block of its own).
BLOCK_BYTES = 2 << 20
#: Bytes hashed at once; a block is cut where a word ends.
SEGMENT = 1 << 19

U = np.uint64
_K = 0x9E3779B97F4A7C15
_INV = pow(_K, -1, 1 << 64)

#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of a word for ``[^\x20\x09-\x0D]+``.
BLANK_SPLIT = np.ones(256, bool)
BLANK_SPLIT[[9, 10, 11, 12, 13, 32]] = False


_M_TRIM, _M_MMAP = -1, -3  # fixed values: mallopt's parameters in glibc


def lean(run: Callable, heap: int = 1 << 20) -> Callable:
    """A task's function for mapInArrow that gives memory back: blocks beyond ``heap`` bytes (32 MB at most) go to the system when they
    are freed, and at the end of the task everything that is free does. Spark keeps a worker after its task, beside those of the
    next stage. A task that makes many arrays of a few MB is faster with a larger ``heap``: the system hands out each page anew."""

    @functools.wraps(run)
    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        libc = ctypes.CDLL(None)
        if hasattr(libc, "mallopt"):
            libc.mallopt(_M_MMAP, heap)
            libc.mallopt(_M_TRIM, 4 * heap)
            pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            give_back()

    return bounded


def give_back() -> None:
    """Return what is free to the system; the driver does so after it has fitted a model."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), element by element."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(_K)) | U(1)
_BYTE_LOW = _BYTE[LOWER]


def _powers(base: int) -> np.ndarray:
    out = np.full(SEGMENT + 1, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_POWERS: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        _POWERS.extend((_powers(_K), _powers(_INV)))
    if n <= SEGMENT:
        return _POWERS[0], _POWERS[1]
    wide = []
    for base in (_K, _INV):  # one word longer than SEGMENT
        p = np.full(n + 1, base, np.uint64)
        p[0] = 1
        with np.errstate(over="ignore"):
            wide.append(np.multiply.accumulate(p))
    return wide[0], wide[1]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` bytes of text each (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = buffers(batch.column(batch.schema.get_field_index(text)))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def word_spans(data: np.ndarray, at: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions of the words' starts and ends; a word does not cross texts."""
    inside = np.zeros(len(data) + 1, bool)
    np.take(is_word, data, out=inside[:-1])
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    cuts = at[:-1][at[:-1] < len(data)]
    begins[cuts] = inside[cuts]
    ends = inside[:-1].copy()
    ends &= ~inside[1:]
    cuts = at[1:][(at[1:] > 0)] - 1
    ends[cuts] |= inside[cuts]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A hash of each span of bytes (A-Z counts as a-z if ``lower``)."""
    table = _BYTE_LOW if lower else _BYTE
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = max(int(np.searchsorted(ends, base + SEGMENT, side="right")), first + 1)
        part = data[base : int(ends[last - 1])]
        up, down = _tables(len(part))
        with np.errstate(over="ignore"):
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(table[part] * up[: len(part)], out=sums[1:])
            s, e = starts[first:last] - base, ends[first:last] - base
            out[first:last] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        first = last
    return out


def words(data: np.ndarray, at: np.ndarray, is_word: np.ndarray = BLANK_SPLIT) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the block, and where each text's words begin in them (one more at the end)."""
    starts, ends = word_spans(data, at, is_word)
    return span_hashes(data, starts, ends), np.searchsorted(starts, at)


_ORDER = mix(np.arange(100, 164, dtype=np.uint64)) | U(1)


def sequence_hash(parts: list[np.ndarray]) -> np.ndarray:
    """A hash of the sequence that the arrays hold side by side; its length counts."""
    with np.errstate(over="ignore"):
        total = np.full(len(parts[0]), len(parts), np.uint64)
        for j, part in enumerate(parts):
            total += part * _ORDER[j]
        return mix(total)


def shingle_sets(hashes: np.ndarray, first: np.ndarray, width: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingles of ``width`` words; fewer words are one shingle, none is none."""
    if len(hashes) >= width:
        rolled = sequence_hash([hashes[j : len(hashes) - width + 1 + j] for j in range(width)])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            s = np.sort(rolled[a : b - width + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            out.append(sequence_hash([hashes[a + j : a + j + 1] for j in range(b - a)]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
