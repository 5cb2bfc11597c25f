"""Byte-level BPE: encoding by corpus-level merge replay, and decoding.

1. Tasks cut their texts into units and send every distinct unit on, dealt by hash: each distinct unit of the corpus
   arrives at one task, however often it occurs and however many texts hold it.
2. There the pieces of the units are laid side by side in one array of token ids. An inverted index leads from a
   token pair to the word positions at which it stands. The merges are replayed in rank order, each at all positions of its
   pairs at once, and only the touched neighbours get new entries. The result is written as sorted hash arrays
   to the shared folder: the corpus' vocabulary, encoded once.
3. Tasks cut their texts again, look the distinct units of a block up in the mapped arrays and put the token ids
   together. Texts are not shuffled, and no worker holds the vocabulary.

Units whose 64-bit hashes collide are left out of the arrays; what is not found there is replayed where it stands.

A pattern splits text into pieces. For a pattern of BLANK_CUT, which never joins a blank to what stands before it nor a line
break to what follows, units are runs cut before a space and around a line break, and are split into pieces where they are
replayed; texts with other blanks or runs of blanks, and all texts under other patterns, are split in step 1.

Defined results: a null text counts as empty and has no tokens; a null row id stays null; each
row yields one row, repeated rows included; an empty table yields an empty result; texts of any
length are encoded whole. Columns other than the id, the text and those to keep are not read. Null ids decode to
nothing; an id that the vocabulary lacks decodes to the replacement character, or fails with ``strict``.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import _files, _shared, _text

NONE = 1 << 30
#: Bytes of text in one block, and of pieces that are replayed together.
BLOCK_BYTES, REPLAY_BYTES = 2 << 20, 2 << 20
#: Hashes of units that a task remembers to have sent, 8 bytes each; beyond that it forgets them and may send some again.
SENT = 1 << 19
#: Units that are split into pieces and replayed at a time.
UNITS = 1 << 17
# Fixed value: the pattern whose matches never cross the cuts of units.
BLANK_CUT = {r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"}
#: Runs of blanks, blanks other than space and line feed, and the mark between units: such texts are split by the pattern.
ODD = "  | \n|\n |\n\n|[\x00\t\x0b\x0c\r\x1c\x1d\x1e\x1f" + "".join(chr(c) for c in range(0x80, 0x3001) if chr(c).isspace()) + "]"
REPLACEMENT = b"\xef\xbf\xbd"


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one line a token, its bytes in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Bpe:
    """A vocabulary of ranks and the pattern that splits text."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern, self.blank_cut = ranks, regex.compile(pattern), pattern in BLANK_CUT
        names: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            names[rank] = token
        self.tokens = pa.array(names, pa.large_binary())
        self.byte_rank = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.pair_keys = np.concatenate((np.array(keys, np.int64)[order], [np.iinfo(np.int64).max]))
        self.pair_ranks = np.concatenate((np.array(values, np.int64)[order], [NONE])).astype(np.int32)
        self.decimal = pa.array(list(map(str, range(len(names)))), pa.large_string())

    def _pair_rank(self, pair: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.pair_keys, pair)
        return np.where(self.pair_keys[at] == pair, self.pair_ranks[at], NONE)

    def _one(self, word: bytes) -> list[int]:
        """One word by itself: the pair of least rank first, the leftmost of several."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
            least = min(ranks)
            if least == NONE:
                break
            at = ranks.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def replay_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(counts, ids) of the words' tokens (no word is empty), all merges replayed in rank order over all words."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        first = np.concatenate(([0], np.cumsum(sizes)))
        n = int(first[-1])
        token = self.byte_rank[np.frombuffer(b"".join(words), np.uint8)]
        after = np.arange(1, n + 1, dtype=np.int32)
        after[first[1:] - 1] = -1
        before = np.arange(-1, n - 1, dtype=np.int32)
        before[first[:-1]] = -1
        rank = np.full(n, NONE, np.int32)  # of the pair that begins at a position
        index: dict[int, list[np.ndarray]] = {}  # the inverted index: token pair -> word positions
        pairs_of: dict[int, list[int]] = {}  # rank -> the pairs that it merges
        heap: list[int] = []

        def enter(at: np.ndarray, pair: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(pair, kind="stable")
            at, pair, ranks = at[order], pair[order], ranks[order]
            cuts = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
            for p, r, positions in zip(pair[cuts].tolist(), ranks[cuts].tolist(), np.split(at, cuts[1:]), strict=True):
                if p in index:
                    index[p].append(positions)
                    continue
                index[p] = [positions]
                if r in pairs_of:
                    pairs_of[r].append(p)
                else:
                    pairs_of[r] = [p]
                    heapq.heappush(heap, r)

        inner = np.flatnonzero(after >= 0).astype(np.int32)
        pair = token[inner].astype(np.int64) << 32 | token[inner + 1]
        rank[inner] = self._pair_rank(pair)
        some = rank[inner] < NONE
        if some.any():
            enter(inner[some], pair[some], rank[inner[some]])
        odd: set[int] = set()
        while heap:
            r = heapq.heappop(heap)
            parts = [positions for p in pairs_of.pop(r) for positions in index.pop(p)]
            at = parts[0] if len(parts) == 1 else np.sort(np.concatenate(parts))
            at = at[rank[at] == r]  # others were touched by a merge since
            if len(at) > 1:
                if len(parts) > 1:
                    at = at[np.concatenate(([True], at[1:] != at[:-1]))]
                chained = np.concatenate(([False], after[at[:-1]] == at[1:]))
                if chained.any():  # overlapping: the leftmost of each run first, then every other one
                    here = np.arange(len(at))
                    at = at[(here - np.maximum.accumulate(np.where(chained, 0, here))) % 2 == 0]
            if not len(at):
                continue
            right = after[at]
            token[at] = r
            rank[right] = NONE
            token[right] = -1
            beyond = after[right]
            after[at] = beyond
            some = beyond >= 0
            before[beyond[some]] = at[some]
            left = before[at]
            touched = np.concatenate((at, left[left >= 0]))
            follows = after[touched]
            has = follows >= 0
            rank[touched] = NONE
            touched, follows = touched[has], follows[has]
            pair = token[touched].astype(np.int64) << 32 | token[follows]
            new = self._pair_rank(pair)
            rank[touched] = new
            late = new < r  # a lower rank appears late: such a word is done by itself
            if late.any():
                odd.update((np.searchsorted(first, touched[late], side="right") - 1).tolist())
            some = (new < NONE) & (new > r)
            if some.any():
                enter(touched[some], pair[some], new[some])
        kept = token >= 0
        counts = np.add.reduceat(kept, first[:-1], dtype=np.int64)
        ids = token[kept]
        if odd:
            lists = np.split(ids, np.cumsum(counts)[:-1])
            for w in odd:
                lists[w] = np.array(self._one(words[w]), np.int32)
            counts, ids = np.array([len(x) for x in lists], np.int64), np.concatenate(lists)
        return counts, ids

    def replay(self, words: list[bytes]) -> list[str]:
        """Token ids of each word in decimals, joined by a space."""
        counts, ids = self.replay_ids(words)
        return [" ".join(map(str, x.tolist())) for x in np.split(ids, np.cumsum(counts)[:-1])] if words else []

    def encode_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(counts, ids) of the tokens of each unit: split into pieces, distinct pieces replayed together."""
        find, ranks = self.pattern.findall, self.ranks
        number: dict[str, int] = {}  # distinct pieces
        which: list[int] = []
        sizes: list[int] = []
        for unit in units.to_pylist():
            # a run of letters with at most one space before it is one piece
            pieces = (unit,) if self.blank_cut and (unit[1:] if unit[:1] == " " else unit).isalpha() else find(unit)
            sizes.append(len(pieces))
            which.extend([number.setdefault(p, len(number)) for p in pieces])
        counts, lists, raws, size = [], [], [], 0
        for raw in map(str.encode, number):
            raws.append(raw)
            size += len(raw)
            if size > REPLAY_BYTES:
                part = self._whole_or_replayed(raws)
                counts.append(part[0])
                lists.append(part[1])
                raws, size = [], 0
        part = self._whole_or_replayed(raws)
        counts, ids = np.concatenate([*counts, part[0]]), np.concatenate([*lists, part[1]])
        ends = np.cumsum(counts)
        at = np.array(which, np.int64)
        per_piece = counts[at] if len(at) else np.zeros(0, np.int64)
        flat = ids[_files.spread((ends - counts)[at], per_piece)] if len(at) else ids[:0]
        bounds = np.concatenate(([0], np.cumsum(per_piece)))
        return np.diff(bounds[np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)]), flat

    def _whole_or_replayed(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces that are tokens themselves need no replay."""
        known = np.array([self.ranks.get(raw, -1) for raw in raws], np.int32)
        counts, ids = self.replay_ids([raw for raw, k in zip(raws, known.tolist(), strict=True) if k < 0])
        every = np.ones(len(raws), np.int64)
        every[known < 0] = counts
        out = np.empty(int(every.sum()), np.int32)
        first = np.cumsum(every) - every
        out[first[known >= 0]] = known[known >= 0]
        out[_files.spread(first[known < 0], counts)] = ids
        return every, out

    def cut(self, texts: pa.Array) -> pa.Array:
        """A list of units of each text (large strings without nulls); an empty unit may occur and has no tokens."""
        if not self.blank_cut:
            return pa.array([self.pattern.findall(t) for t in texts.to_pylist()], pa.list_(pa.large_string()))
        odd = pc.match_substring_regex(texts, ODD)
        marked = pc.replace_substring(pc.replace_substring(pc.filter(texts, pc.invert(odd)), " ", "\0 "), "\n", "\0\n\0")
        plain = pc.split_pattern(marked, "\0")
        flags = odd.to_numpy(zero_copy_only=False)
        if not flags.any():
            return plain
        split = pa.array([self.pattern.findall(t) for t in pc.filter(texts, odd).to_pylist()], plain.type)
        place = np.empty(len(flags), np.int64)
        place[np.flatnonzero(~flags)] = np.arange(len(plain))
        place[np.flatnonzero(flags)] = len(plain) + np.arange(len(split))
        return pa.concat_arrays([plain, split]).take(pa.array(place))

    def distinct_units(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The distinct units of a block, the number of each unit in them, and where each text's units begin (one more at the end)."""
        units = self.cut(texts)
        coded = units.flatten().dictionary_encode()
        at = np.concatenate(([0], np.cumsum(pc.list_value_length(units).to_numpy(zero_copy_only=False)))).astype(np.int64)
        return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), at

    def encode_block(self, texts: pa.Array, store: _files.Lists | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(counts, ids) of the texts' tokens; units are looked up in the store, what it lacks is replayed here."""
        units, which, at = self.distinct_units(texts)
        if store is None:
            counts, ids = self.encode_units(units)
        else:
            hashes = unit_hashes(units)
            by = np.argsort(hashes, kind="stable")
            there, found, numbers = store.get(hashes[by])
            rest, own = by[~there], by[there]
            more, other = self.encode_units(units.take(pa.array(rest)))
            counts = np.zeros(len(units), np.int64)
            counts[own], counts[rest] = found, more
            first = np.cumsum(counts) - counts
            ids = np.empty(int(counts.sum()), np.int32)
            ids[_files.spread(first[own], found)] = numbers
            ids[_files.spread(first[rest], more)] = other
        first, per_unit = np.cumsum(counts) - counts, counts[which]
        bounds = np.concatenate(([0], np.cumsum(per_unit)))
        return np.diff(bounds[at]), ids[_files.spread(first[which], per_unit)]

    def _lists(self, counts: np.ndarray, ids: np.ndarray, names: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), names.take(pa.array(ids)))

    def decimals(self, counts: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The ids of each text in decimals, joined by a space."""
        return pc.binary_join(self._lists(counts, ids, self.decimal), pa.scalar(" ", pa.large_string()))

    def bytes_of(self, counts: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The bytes that the ids of each text stand for."""
        return pc.binary_join(self._lists(counts, ids, self.tokens), pa.scalar(b"", pa.large_binary()))

    def encode_texts(self, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        """The decimal ids of each text and the bytes they decode to, without an engine."""
        counts, ids = self.encode_block(pa.array(texts, pa.large_string()))
        return zip(self.decimals(counts, ids).to_pylist(), self.bytes_of(counts, ids).to_pylist(), strict=True)


def unit_hashes(units: pa.Array) -> np.ndarray:
    data, at = _text.buffers(units)
    return _text.span_hashes(data, at[:-1], at[1:], lower=False)


def _texts(column: pa.Array) -> pa.Array:
    return pc.fill_null(column.cast(pa.large_string()), pa.scalar("", pa.large_string()))


def _hex(values: pa.Array) -> pa.Array:
    raw, at = _text.buffers(values)
    view = memoryview(raw)
    return pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.string())


def vocabulary(docs: DataFrame, shipped, text_col: str) -> tuple[str, int]:
    """Encode every distinct unit of the corpus once; (folder, shards) of the sorted arrays: hashes, ends of the lists, ids."""
    spark = docs.sparkSession
    uri = _shared.new_path(spark, "vocabulary")
    shards = _shared.reducers(spark, _shared.plan_bytes(docs, text_col) / 8)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, sent = shipped.value, np.zeros(0, np.uint64)
        for b in _text.blocks(batches, text_col, BLOCK_BYTES):
            units, _, _ = bpe.distinct_units(_texts(b.column(0)))
            hashes = unit_hashes(units)
            new = np.flatnonzero(~np.isin(hashes, sent))
            if not len(new):
                continue
            sent = np.union1d(sent if len(sent) < SENT else sent[:0], hashes[new])
            shard = _files.range_shard(hashes[new], shards)
            by = np.argsort(shard, kind="stable")
            shard, own = shard[by], units.take(pa.array(new[by]))
            raw, at = _text.buffers(own)
            starts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))
            names = _shared.deal_keys(shards)[shard[starts]]
            rows = [(raw[at[x] : at[y]].tobytes(), np.diff(at[x : y + 1]).astype(np.uint32).tobytes()) for x, y in zip(starts.tolist(), [*starts[1:].tolist(), len(shard)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())], names=["shard", "data", "sizes"])

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [pa.array([], pa.large_string())], 0
        for b in batches:
            for data, sizes in zip(b.column(1), b.column(2), strict=True):
                at = np.concatenate(([0], np.cumsum(np.frombuffer(sizes.as_buffer(), np.uint32).astype(np.int64))))
                raw = data.as_buffer()
                parts.append(pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), raw))
                held += raw.size
            if held > 4 * _shared.REDUCER_BYTES:
                parts, held = [pa.concat_arrays(parts).unique()], 0
        units = pa.concat_arrays(parts).unique()
        hashes = unit_hashes(units)
        by = np.argsort(hashes, kind="stable")
        hashes = hashes[by]
        alone = np.ones(len(by), bool)  # colliding hashes stay out
        alone[1:] &= hashes[1:] != hashes[:-1]
        alone[:-1] &= hashes[1:] != hashes[:-1]
        hashes, units = hashes[alone], units.take(pa.array(by[alone]))
        parts = [shipped.value.encode_units(units.slice(a, UNITS)) for a in range(0, max(1, len(units)), UNITS)]
        counts, ids = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        ends = np.cumsum(counts)
        shard = _files.range_shard(hashes, shards)
        for s in np.unique(shard).tolist():
            a, b = np.searchsorted(shard, [s, s + 1]).tolist()
            low = int(ends[a - 1]) if a else 0
            own = ids[low : int(ends[b - 1])]
            _files.write_arrays(f"{uri}/{s:06d}", [hashes[a:b], (ends[a:b] - low).astype(np.uint32), _files.narrow(own)])
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([b - a], pa.int64())], names=["shard", "units"])

    sent = docs.select(text_col).mapInArrow(_text.lean(send), "shard int, data binary, sizes binary")
    _shared.exchange(sent, shards, replay, "shard int, units long").agg(F.sum("units")).collect()  # one row
    return uri, shards


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, with_ids: bool = True, with_decoded: bool = True) -> DataFrame:
    """Encode every text, then decode its ids.

    Returns id, ``keep`` columns, n_tokens, ids_sha256, decoded_sha256, the ids
    themselves (array of int) and the decoded text's bytes, unless declined. The rank file is read
    on the driver and broadcast: its size does not depend on the data.
    """
    _shared.small_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(Bpe(read_ranks(ranks_path), pattern))
    keep = [c for c in keep or [] if c not in (id_col, text_col)]
    chosen = docs.select(id_col, text_col, *keep)
    schema = T.StructType([chosen.schema[id_col], *[chosen.schema[c] for c in keep], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    if with_decoded:
        schema = schema.add("decoded", T.BinaryType())
    store = vocabulary(docs, shipped, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, lists = shipped.value, _files.Lists(*store)
        for b in _text.blocks(batches, text_col, BLOCK_BYTES):
            counts, ids = bpe.encode_block(_texts(b.column(1)), lists)
            decoded = bpe.bytes_of(counts, ids)
            out = [b.column(0), *[b.column(2 + j) for j in range(len(keep))], pa.array(counts, pa.int64()), _hex(bpe.decimals(counts, ids)), _hex(decoded)]
            if with_ids:
                out.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(ids, pa.int32())))
            if with_decoded:
                out.append(decoded.cast(pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return chosen.mapInArrow(_text.lean(run), schema)


def decode(tokens: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded", strict: bool = False) -> DataFrame:
    """Replace an array of ids by the bytes it stands for; a null array counts as empty."""
    names = read_ranks(ranks_path)
    table = tokens.sparkSession.sparkContext.broadcast({rank: token for token, rank in names.items()})
    kept = [c for c in tokens.columns if c not in (ids_col, out_col)]
    chosen = tokens.select(*kept, F.col(ids_col).alias(ids_col))
    schema = T.StructType([*[chosen.schema[c] for c in kept], T.StructField(out_col, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_of = table.value
        for b in batches:
            lists = b.column(len(kept)).to_pylist()
            if strict and (unknown := {i for ids in lists for i in ids or [] if i is not None and i not in token_of}):
                raise ValueError(f"ids that the vocabulary lacks: {sorted(unknown)[:20]}")
            decoded = [b"".join([token_of.get(i, REPLACEMENT) for i in ids or [] if i is not None]) for ids in lists]
            yield pa.RecordBatch.from_arrays([*[b.column(j) for j in range(len(kept))], pa.array(decoded, pa.binary())], names=schema.names)

    return chosen.mapInArrow(_text.lean(run), schema)
