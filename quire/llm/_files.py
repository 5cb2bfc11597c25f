"""Files of sorted arrays in the shared folder: written whole or not at all, and memory-mapped."""

from __future__ import annotations

import mmap
import os
import sys
import tempfile
import uuid

import numpy as np
from pyarrow import fs

from quire.llm import _text

#: Shards of a table that stay mapped; the usual limit of a process is 65,530 mappings.
MAPPED = 3072
#: Since Python 3.13 a mapping can do without a descriptor of its own.
_UNTRACKED = {"trackfd": False} if sys.version_info >= (3, 13) else {}


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


def write_arrays(uri: str, arrays: list[np.ndarray]) -> None:
    """One file for each array, named uri.0, uri.1, ...; a file takes its name when it is complete, so a task may run twice."""
    for j, array in enumerate(arrays):
        system, path = _open(f"{uri}.{j}")
        system.create_dir(os.path.dirname(path), recursive=True)
        draft = f"{path}.{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as out:
            out.write(np.dtype(array.dtype).str.encode().ljust(8) + np.ascontiguousarray(array).tobytes())
        system.move(draft, path)


def map_array(uri: str, j: int) -> np.ndarray | None:
    """A file of ``write_arrays``, memory-mapped; None where there is none. What is not on a mounted
    file system is copied to a local file first, which goes as soon as it is mapped."""
    system, path = _open(f"{uri}.{j}")
    if system.get_file_info(path).type == fs.FileType.NotFound:
        return None
    if isinstance(system, fs.LocalFileSystem):
        return _map(path)
    with tempfile.NamedTemporaryFile() as local, system.open_input_stream(path) as source:
        while part := source.read(1 << 24):
            local.write(part)
        local.flush()
        return _map(local.name)


def _map(path: str) -> np.ndarray:
    with open(path, "rb") as f:
        kind = np.dtype(f.read(8).decode().strip())
        if os.path.getsize(path) == 8:
            return np.zeros(0, kind)
        # not np.memmap: each of those holds one of the process's descriptors, and slices of them are dear
        return np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, **_UNTRACKED), kind, offset=8)


class Table:
    """Sorted keys and values in shards; ``get`` looks sorted keys up shard by shard."""

    def __init__(self, uri: str, shards: int, values: int):
        self.uri, self.shards, self.values = uri, shards, values
        self.open: dict[int, list[np.ndarray] | None] = {}

    def _shard(self, s: int) -> list[np.ndarray] | None:
        if s not in self.open:
            if len(self.open) > MAPPED:
                self.open.clear()
            keys = map_array(f"{self.uri}/{s:06d}", 0)
            self.open[s] = None if keys is None else [keys, *[map_array(f"{self.uri}/{s:06d}", j) for j in range(1, self.values + 1)]]
        return self.open[s]

    def get(self, keys: np.ndarray, shard: np.ndarray, places: bool = False) -> list[np.ndarray]:
        """The values of each key, 0 where it is absent; with ``places`` also its place in the shard, from 1."""
        out = [np.zeros(len(keys), np.int64) for _ in range(self.values + places)]
        by = np.lexsort((keys, shard))
        cuts = np.flatnonzero(np.concatenate(([True], shard[by][1:] != shard[by][:-1]))).tolist() if len(by) else []
        for a, b in zip(cuts, [*cuts[1:], len(by)], strict=False):
            rows = by[a:b]
            found = self._shard(int(shard[rows[0]]))
            if not found or not len(found[0]):
                continue
            at = np.minimum(np.searchsorted(found[0], keys[rows]), len(found[0]) - 1)
            hit = found[0][at] == keys[rows]
            for column, values in zip(out, found[1:], strict=False):
                column[rows[hit]] = values[at[hit]]
            if places:
                out[-1][rows[hit]] = at[hit] + 1
        return out


def write_sparse(uri: str, keys: np.ndarray, columns: list[np.ndarray], usual: list[int]) -> None:
    """One file for ``Sparse``: entries whose values are the usual ones as keys alone, the others with their values."""
    rare = np.zeros(len(keys), bool)
    for c, u in zip(columns, usual, strict=True):
        rare |= c != u
    head, parts = [], []
    for own in (~rare, rare):
        bits = max(1, (int(own.sum()) // 8).bit_length())
        spots = _spots(_text.mix(keys[own]), bits)
        by = np.argsort(spots)
        spots = spots[by]
        head += [len(spots), bits]
        parts += [np.searchsorted(spots >> _LOW, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.uint32), np.append(spots & _MASK, _U0).astype(np.uint32)]
    values = [narrow(c[rare][by]) for c in columns]
    head += [v.itemsize for v in values]
    write_arrays(uri, [np.concatenate([np.ascontiguousarray(x).view(np.uint8) for x in (np.array(head, np.int64), *parts, *values)])])


_LOW, _MASK, _U0 = np.uint64(32), np.uint64((1 << 32) - 1), np.uint64(0)


def _spots(mixed: np.ndarray, bits: int) -> np.ndarray:
    """The first bits of the mixed key, which are a bucket, and 32 more, which are kept: a false hit is one lookup in 5 * 10^8."""
    return mixed >> np.uint64(32 - bits)


class Sparse:
    """Sorted hash arrays in shards, of about 4.7 bytes an entry with the usual values; ``get`` looks keys up shard by shard."""

    def __init__(self, uri: str, shards: int, usual: list[int]):
        self.uri, self.shards, self.usual = uri, shards, usual
        self.open: dict[int, tuple | None] = {}

    def _shard(self, s: int) -> tuple | None:
        if s not in self.open:
            if len(self.open) > MAPPED:
                self.open.clear()
            data = map_array(f"{self.uri}/{s:06d}", 0)
            self.open[s] = None if data is None else self._parts(data)
        return self.open[s]

    def _parts(self, data: np.ndarray) -> tuple:
        head = data[: 8 * (4 + len(self.usual))].view(np.int64).tolist()
        at = 8 * len(head)

        def take(count: int, size: int) -> np.ndarray:
            nonlocal at
            at += count * size
            return data[at - count * size : at].view(f"u{size}")

        keys = [(bits, take((1 << bits) + 1, 4), take(n + 1, 4)) for n, bits in (head[:2], head[2:4])]
        return keys, [take(head[2], size) for size in head[4:]]

    def get(self, keys: np.ndarray, shard: np.ndarray) -> list[np.ndarray]:
        """The values of each key, 0 where it is absent."""
        if not len(keys):
            return [np.zeros(0, np.int64) for _ in self.usual]
        by = None if (shard[1:] >= shard[:-1]).all() else np.argsort(shard.astype(np.uint16) if self.shards <= 1 << 16 else shard, kind="stable")
        mixed, ordered = _text.mix(keys), shard
        if by is not None:
            mixed, ordered = mixed[by], shard[by]
        found = [np.zeros(len(keys), np.int64) for _ in self.usual]  # shard after shard, so that each shard's are one slice
        cuts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(keys)], strict=True):
            parts = self._shard(int(ordered[a]))
            if not parts:
                continue
            (often, rare), values = parts
            _, hit = _find(*often, mixed[a:b])
            for column, u in zip(found, self.usual, strict=True):
                if u:
                    np.multiply(hit, u, out=column[a:b])
            rows = (~hit).nonzero()[0]
            rows += a
            at, hit = _find(*rare, mixed[rows])
            rows, at = rows[hit], at[hit]
            for column, v in zip(found, values, strict=True):
                column[rows] = v[at]
        if by is None:
            return found
        out = [np.empty(len(keys), np.int64) for _ in self.usual]
        for column, own in zip(out, found, strict=True):
            column[by] = own
        return out


def _find(bits: int, starts: np.ndarray, kept: np.ndarray, mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key would stand, and whether it is there: a binary search inside each key's bucket, by halved steps. One number
    too many is kept at the end."""
    spots = _spots(mixed, bits)
    wanted = spots.astype(np.uint32)  # the low bits
    spots >>= _LOW
    bucket = spots.view(np.int64)
    last = starts[bucket].astype(np.int64)
    end = starts[1:][bucket].astype(np.int64)
    step = (1 << int((end - last).max(initial=0)).bit_length()) >> 1
    last -= 1  # the last place known to hold less
    while step:
        ahead = last + step
        less = kept.take(ahead, mode="clip") < wanted
        less &= ahead < end
        last = np.where(less, ahead, last)
        step >>= 1
    last += 1
    hit = kept[last] == wanted
    hit &= last < end
    return last, hit


class Lists:
    """Sorted keys in shards that are ranges of the key; each key has a list of numbers (arrays: keys, ends, numbers)."""

    def __init__(self, uri: str, shards: int):
        self.uri, self.shards = uri, shards
        self.open: dict[int, list[np.ndarray] | None] = {}

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of sorted keys: which are there, the lengths of the lists of those, and the lists one after another."""
        there = np.zeros(len(keys), bool)
        sizes, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        shard = range_shard(keys, self.shards)
        cuts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))).tolist() if len(keys) else []
        for a, b in zip(cuts, [*cuts[1:], len(keys)], strict=False):
            s = int(shard[a])
            if s not in self.open:
                found = map_array(f"{self.uri}/{s:06d}", 0)
                self.open[s] = None if found is None else [found, map_array(f"{self.uri}/{s:06d}", 1), map_array(f"{self.uri}/{s:06d}", 2)]
            arrays = self.open[s]
            if arrays is None or not len(arrays[0]):
                continue
            at = np.minimum(np.searchsorted(arrays[0], keys[a:b]), len(arrays[0]) - 1)
            hit = arrays[0][at] == keys[a:b]
            there[a:b] = hit
            last = arrays[1][at[hit]].astype(np.int64)
            first = np.where(at[hit] > 0, arrays[1][at[hit] - 1].astype(np.int64), 0)
            sizes.append(last - first)
            numbers.append(arrays[2][spread(first, last - first)].astype(np.int32))
        return there, np.concatenate(sizes), np.concatenate(numbers)


def spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each run, run after run."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(first - (ends - sizes), sizes) + np.arange(total)


def range_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards that are ranges of the hash."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def narrow(counts: np.ndarray) -> np.ndarray:
    """The counts in the narrowest unsigned type that holds them."""
    return counts.astype(np.min_scalar_type(int(counts.max()) if len(counts) else 0))
