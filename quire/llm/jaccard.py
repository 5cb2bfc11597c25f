"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures, then exact intersection.

1. Each text becomes the set of its word n-grams (64-bit hashes); texts with the same set are one
   class (key: a hash of the set, and its size).
2. A table of hashed n-gram counts over all texts orders n-grams from rare to frequent. Two sets
   at or above the threshold share an n-gram among the first ``n - ceil(t n) + 1`` of each in any
   common order, so classes meet at these n-grams only, and a passage that many texts share
   stands last in the order.
3. A meeting is cut into tiles: its sets fall into bands of size, of which only equal and adjacent ones can hold links, and a
   band into blocks; a tile is a pair of blocks, and a pair of sets is in one tile only. In a tile bitmap
   signatures are compared: a bit of the difference of two signatures takes at least one n-gram of the difference of the
   sets, so the bit count bounds the overlap from above. What passes joins the same cluster: clusters
   are unions of true components.
4. Clusters are cut into tiles in the same way. There bitmaps are compared first and then sorted arrays exactly, for
   every pair of the tile. A tile returns each set's number of linked documents and a spanning forest of its links: every link
   is found and counted, but copies and pairs are not spelt out.
5. The links' connected components, with the smallest document id of each.

Sets meet by n-gram hash, meetings and clusters beyond TILE sets are split, copies are one class. Intermediate tables are written
to the shared folder.

Defined results: a null or empty text, or one without words, has n_shingles 0, no links and its own
doc_id as component; texts with fewer words than ``width`` have one shingle, the whole sequence;
each row is a document of its own: rows that repeat a doc_id each get a row, and their texts are not
joined by the id; rows with a null doc_id are returned and link like others, and give no component its id; a component of
such rows alone has a null id. Ids are whole numbers (an id that is none fails the cast). Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import _shared, _text
from quire.llm.components import connected

#: Sets per step when signatures are compared.
_STEP = 512
#: Sets of a meeting or cluster that stay in one tile, and about the sets of a block beyond that.
TILE = 1024
#: Tables of n-gram counts that one reducer adds up.
FAN = 256
_U = np.uint64


def prefix_length(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """N-grams of a set of n, in the common order, of which any set at the threshold shares one."""
    return n - (percent * n + 99) // 100 + 1


def signature_words(n: int) -> int:
    """64-bit words of a signature: a power of two, about two bits an n-gram, 2 at least and 1024 at most."""
    return 1 << min(10, max(1, (max(2 * n, 1) - 1).bit_length() - 6))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Parities of the n-grams by hashed bit."""
    words = signature_words(len(shingles))
    bits = np.bincount(((shingles >> _U(20)) % _U(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.uint64)


def set_key(shingles: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        total = _text.mix(shingles ^ _U(0x5DEECE66D)).sum(dtype=np.uint64)
        return int(_text.mix(np.array([total + _U(len(shingles)) * _U(0x9E3779B97F4A7C15)], np.uint64)).view(np.int64)[0])


def classes(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, set_key (null for the empty set) and signature of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.blocks(batches, text_col):
            sets = _text.shingle_sets(*_text.words(*_text.buffers(b.column(1))), width)
            columns = [b.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()), pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set_key", "signature"])

    return docs.select(id_col, text_col).mapInArrow(_text.lean(run), "doc_id long, n_shingles long, set_key long, signature binary")


def rarity(docs: DataFrame, total: int, width: int, text_col: str) -> tuple[int, bytes]:
    """Hashed counts of all texts' n-grams: bits of the hash, and a byte for each bucket on a log scale.

    About 16 n-grams share a bucket, with 2^14 to 2^23 buckets, so the table has at most 8 MB. It only orders n-grams.
    """
    bits = int(min(23, max(14, (max(total, 1) // 16).bit_length())))
    shards = 64
    each = (1 << bits) // shards

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits, np.int32)
        some = False
        for b in _text.blocks(batches, text_col):
            sets = _text.shingle_sets(*_text.words(*_text.buffers(b.column(0))), width)
            found = np.concatenate(sets) if sets else np.zeros(0, _U)
            some |= bool(len(found))
            bucket, times = np.unique((found >> _U(64 - bits)).astype(np.int64), return_counts=True)
            table[bucket] += times.astype(np.int32)
        if some:
            low, group = np.minimum(table, 255).astype(np.uint8), TaskContext.get().partitionId() % groups
            yield pa.RecordBatch.from_arrays([pa.array([s * groups + group for s in range(shards)], pa.int32()), pa.array([low[s * each : (s + 1) * each].tobytes() for s in range(shards)], pa.binary())], ["shard", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for s, blob in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                found = np.frombuffer(blob.as_buffer(), np.uint8 if len(blob.as_buffer()) == each else np.int64)
                sums[s] = sums[s] + found if s in sums else found.astype(np.int64)
        for s, found in sums.items():
            out = np.minimum(255, np.round(8 * np.log2(1 + found))).astype(np.uint8) if last else found
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([out.tobytes()], pa.binary())], ["shard", "data"])

    # tasks' tables are added up in groups of about FAN, then the groups, so that no reducer reads a row of every task
    groups = at_first = max(1, int(_shared.plan_bytes(docs, text_col) / (128 << 20) / FAN))
    summed = docs.select(text_col).mapInArrow(_text.lean(count), "shard int, data binary")
    while True:
        last = at_first == 1
        summed = _shared.exchange(summed, min(shards * at_first, 4096), add, "shard int, data binary")
        if last:
            break
        before, at_first = at_first, max(1, at_first // FAN)
        summed = summed.select(((F.col("shard") / before).cast("int") * at_first + F.col("shard") % before % at_first).cast("int").alias("shard"), "data")
    table = np.zeros(1 << bits, np.uint8)
    for s, blob in summed.collect():  # 64 rows, 8 MB at most
        table[s * each : (s + 1) * each] = np.frombuffer(bytes(blob), np.uint8)
    return bits, table.tobytes()


def meetings(docs: DataFrame, total: int, width: int, percent: int, text_col: str) -> DataFrame:
    """Rows (meeting, set_key, n): the classes, two at least, that share an n-gram among their first ones."""
    spark = docs.sparkSession
    bits, table = rarity(docs, total, width, text_col)
    order = spark.sparkContext.broadcast(table)
    share = (100 - percent) / 100 + 0.01
    reducers = _shared.reducers(spark, total * share * 20)
    shards = reducers

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.frombuffer(order.value, np.uint8)
        grams: list[np.ndarray] = []
        keys: list[int] = []
        sizes: list[int] = []
        seen: set[int] = set()
        held = 0
        for b in _text.blocks(batches, text_col):
            for s in _text.shingle_sets(*_text.words(*_text.buffers(b.column(0))), width):
                if not len(s) or (key := set_key(s)) in seen:
                    continue
                seen.add(key)
                rare = np.argsort(rank[(s >> _U(64 - bits)).astype(np.int64)], kind="stable")  # s is sorted: ties go by hash
                grams.append(s[rare[: int(prefix_length(len(s), percent))]])
                keys.append(key)
                sizes.append(len(s))
                held += len(grams[-1])
            if held > 1 << 20:
                yield from _entries(grams, keys, sizes, shards)
                grams, keys, sizes, held = [], [], [], 0
                if len(seen) > 1 << 20:
                    seen.clear()
        if grams:
            yield from _entries(grams, keys, sizes, shards)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, key, n = _shared.unpacked(batches, ["u8", "i8", "i4"])
        if not len(gram):
            return
        by = np.lexsort((key, n, gram))
        gram, key, n = gram[by], key[by], n[by]
        new = np.concatenate(([True], (gram[1:] != gram[:-1]) | (key[1:] != key[:-1]) | (n[1:] != n[:-1])))
        gram, key, n = gram[new], key[new], n[new].astype(np.int64)
        # a run: classes of one n-gram in which each size reaches the next one's band
        starts = np.concatenate(([True], (gram[1:] != gram[:-1]) | (100 * n[:-1] < percent * n[1:])))
        first = np.flatnonzero(starts)
        count = np.diff(np.concatenate((first, [len(gram)])))
        with np.errstate(over="ignore"):  # runs with the same members are one meeting
            members = np.add.reduceat(_text.mix(key.view(np.uint64)), first)
        _, once = np.unique(members, return_index=True)
        once = once[count[once] > 1]
        for part in np.array_split(once, max(1, len(once) // 20000)):
            if len(part):
                rows = np.concatenate([np.arange(first[r], first[r] + count[r]) for r in part.tolist()])
                ids = np.repeat(members[part], count[part]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(key[rows]), pa.array(n[rows])], names=["meeting", "set_key", "n"])

    return _shared.exchange(docs.select(text_col).mapInArrow(_text.lean(enter), "shard int, data binary"), reducers, meet, "meeting long, set_key long, n long")


def _entries(grams: list[np.ndarray], keys: list[int], sizes: list[int], shards: int) -> Iterator[pa.RecordBatch]:
    lengths = [len(g) for g in grams]
    gram = np.concatenate(grams)
    shard = (_text.mix(gram) % _U(shards)).astype(np.int32)
    return _shared.packed(shard, [gram, np.repeat(np.array(keys, np.int64), lengths), np.repeat(np.array(sizes, np.int32), lengths)], shards)


def _fold(matrix: np.ndarray) -> np.ndarray:
    half = matrix.shape[1] // 2
    return matrix[:, :half] ^ matrix[:, half:]


def links(n: np.ndarray, signatures: list[np.ndarray], percent: int, sides: np.ndarray | None = None, sets: list[np.ndarray] | None = None, weights: np.ndarray | None = None) -> tuple[list[tuple[int, int]], np.ndarray]:
    """(pairs that span the links, weight of all linked partners) of sets sorted by size n, by position.

    A pair is a link if the signatures leave room for it and, with ``sets``, if the exact intersection says so. With ``sides`` only
    pairs of different sides count. Without ``weights`` nothing is added up, and pairs that are connected already are passed over.
    """
    m = len(n)
    widths = np.array([len(s) for s in signatures])
    same: dict[int, np.ndarray] = {}
    begin: dict[int, int] = {}
    for w in np.unique(widths).tolist():
        where = np.flatnonzero(widths == w)  # one range, as width grows with size
        begin[w], same[w] = int(where[0]), np.stack([signatures[j] for j in where.tolist()])
    part = np.arange(m)
    linked = np.zeros(m, np.int64)
    out: list[tuple[int, int]] = []
    reach = np.searchsorted(n * percent, n * 100, side="right")  # sizes in the band of each
    for i in range(m):
        hits = []
        for w in (int(widths[i]), 2 * int(widths[i])):
            if w not in same:
                continue
            low, high = max(i + 1, begin[w]), min(int(reach[i]), begin[w] + len(same[w]))
            for a in range(low, high, _STEP):
                js = np.arange(a, min(a + _STEP, high))
                if weights is None:
                    js = js[part[js] != part[i]]
                if sides is not None:
                    js = js[sides[js] != sides[i]]
                if not len(js):
                    continue
                rows = same[w][js - begin[w]]
                if w != widths[i]:
                    rows = _fold(rows)
                differ = np.bitwise_count(rows ^ signatures[i]).sum(1, dtype=np.int64)
                hits.append(js[differ * (100 + percent) <= (100 - percent) * (n[js] + n[i])])
        js = np.concatenate(hits) if hits else np.zeros(0, np.int64)
        if len(js) and sets is not None:
            js = js[_overlaps(sets[i], [sets[j] for j in js.tolist()], percent)]
        if weights is not None and len(js):
            linked[i] += weights[js].sum()
            linked[js] += weights[i]
        apart = js[part[js] != part[i]]
        if len(apart):
            _, once = np.unique(part[apart], return_index=True)  # one link to each part suffices
            out.extend((i, j) for j in apart[once].tolist())
            part[np.isin(part, part[apart])] = part[i]
    return out, linked


def _overlaps(one: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sorted arrays are at the threshold with ``one``, exactly."""
    lengths = np.array([len(s) for s in others])
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    shared = np.add.reduceat(one[at] == flat, np.concatenate(([0], np.cumsum(lengths)[:-1])), dtype=np.int64)
    return 100 * shared >= percent * (len(one) + lengths - shared)


def tiles(rows: DataFrame, group: str, percent: int, name: str) -> DataFrame:
    """rows (group, set_key, n, ...) with tile and side, once for each tile of the set: -1 within a block, else 0 or 1.

    Groups of up to TILE sets are one tile. Larger ones fall into bands of size, of which the next can hold links, and each band into
    blocks by hash. The sizes of large groups are a table of their own, so that the joins stay plain and skew in them can be split.
    """
    ratio = math.log(100 / percent) * 1.001 if percent < 100 else 1e-6
    large = _shared.materialize(rows.groupBy(group).agg(F.count("*").alias("_m")).where(F.col("_m") > TILE).select(group), f"{name}-large")
    none = rows.withColumn("tile", F.col(group)).withColumn("side", F.lit(-1))
    count = large.count()
    if not count:
        return none
    few = (lambda df: F.broadcast(df)) if count <= BROADCAST_GROUPS else (lambda df: df)
    banded = rows.join(few(large), group).withColumn("_band", F.floor(F.log(F.col("n").cast("double")) / ratio))
    blocks = _shared.materialize(banded.groupBy(group, "_band").agg(F.ceil(F.count("*") / TILE).cast("int").alias("_own")), f"{name}-bands")
    beside = lambda by, c: blocks.select(group, (F.col("_band") + by).alias("_band"), F.col("_own").alias(c))
    bands = _shared.materialize(blocks.join(beside(-1, "_next"), [group, "_band"], "left").join(beside(1, "_last"), [group, "_band"], "left").na.fill(0, ["_next", "_last"]), f"{name}-beside")
    few = (lambda df: F.broadcast(df)) if bands.count() <= BROADCAST_GROUPS else (lambda df: df)
    at = banded.join(few(bands), [group, "_band"]).withColumn("_block", F.pmod(F.xxhash64("set_key"), F.col("_own")).cast("int"))
    one = lambda c, tile, side: f"transform(filter(sequence(0, {c}), o -> o < {c}), o -> named_struct('tile', xxhash64({group}, {tile}), 'side', {side}))"
    within = one("_own", "_band, 0, least(_block, o), greatest(_block, o)", "CASE WHEN o = _block THEN -1 WHEN _block < o THEN 0 ELSE 1 END")
    both = one("_next", "_band, 1, _block, o", "0"), one("_last", "_band - 1, 1, o, _block", "1")
    cut = at.select(*rows.columns, F.explode(F.expr(f"concat({within}, {both[0]}, {both[1]})")).alias("_t")).select(*rows.columns, "_t.tile", "_t.side")
    return none.join(few(large), group, "left_anti").select(*rows.columns, "tile", "side").unionByName(cut)


def candidates(met: DataFrame, sets: DataFrame, percent: int, rows: int) -> DataFrame:
    """Edges (a, b) between classes that meet and whose signatures leave room for a link; per tile a spanning forest."""
    reducers = _shared.reducers(met.sparkSession, rows * 150)
    shards = reducers
    signed = tiles(met, "meeting", percent, "meetings").join(sets.select("set_key", "signature"), "set_key").select("tile", "set_key", "n", F.col("side").cast("long").alias("side"), "signature")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _shared.deal_keys(shards)
        for b in batches:
            tile = b.column(0).to_numpy()
            shard = (_text.mix(tile.view(np.uint64)) % _U(shards)).astype(np.int32)
            by = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(np.concatenate(([True], shard[by][1:] != shard[by][:-1]))) if len(by) else []
            for rows_of in np.split(by, cuts[1:]) if len(by) else []:
                t = b.take(pa.array(rows_of))
                head = b"".join(t.column(j).to_numpy().tobytes() for j in range(4))
                yield pa.RecordBatch.from_arrays([pa.array([int(names[shard[rows_of[0]]])], pa.int32()), pa.array([head], pa.binary()), pa.array([b"".join(t.column(4).to_pylist())], pa.binary())], names=["shard", "head", "sigs"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, sigs = [], []
        for b in batches:
            for head, blob in zip(b.column(1), b.column(2), strict=True):
                raw = np.frombuffer(head.as_buffer(), np.int64).reshape(4, -1)
                heads.append(raw)
                flat, at = np.frombuffer(blob.as_buffer(), np.uint64), 0
                for size in raw[2].tolist():
                    w = signature_words(size)
                    sigs.append(flat[at : at + w])
                    at += w
        if not heads:
            return
        tile, key, n, side = np.concatenate(heads, axis=1)
        by = np.lexsort((key, n, tile))
        tile, key, n, side = tile[by], key[by], n[by], side[by]
        first = np.flatnonzero(np.concatenate(([True], tile[1:] != tile[:-1])))
        a: list[int] = []
        b_: list[int] = []
        for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(by)], strict=True):
            rows_of = np.arange(lo, hi)
            if hi - lo > 1:  # several reducers may have found the same meeting
                rows_of = rows_of[np.concatenate(([True], key[lo + 1 : hi] != key[lo : hi - 1]))]
            for i, j in links(n[rows_of], [sigs[x] for x in by[rows_of].tolist()], percent, None if side[lo] < 0 else side[rows_of])[0]:
                a.append(int(key[rows_of[i]]))
                b_.append(int(key[rows_of[j]]))
        if a:
            flat = np.unique(np.sort(np.array([a, b_], np.int64), axis=0), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(flat[0]), pa.array(flat[1])], names=["a", "b"])

    return _shared.exchange(signed.mapInArrow(_text.lean(pack), "shard int, head binary, sigs binary"), reducers, compare, "a long, b long")


_LINKS = "a long, b long, linked long"


def tile_links(docs: DataFrame, members: DataFrame, width: int, percent: int, id_col: str, text_col: str, reducers: int) -> DataFrame:
    """Exact links of the tiles: rows (a, b, null) that span them, and (a, null, linked) with the documents linked to a set within a tile; members: doc_id, set_key, rows, tiles."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.blocks(batches, "text"):
            sets = _text.shingle_sets(*_text.words(*_text.buffers(b.column(0))), width)
            out: list[list] = [[], [], [], [], []]
            for s, key, rows, of in zip(sets, *(b.column(j).to_pylist() for j in (1, 2, 3)), strict=True):
                if not len(s) or set_key(s) != key:
                    continue  # another text of the same doc_id
                data = s.tobytes()
                for t in of:
                    for column, value in zip(out, (t["tile"], t["side"], key, rows, data), strict=True):
                        column.append(value)
            for a in range(0, len(out[0]), 256):
                yield pa.RecordBatch.from_arrays([pa.array(c[a : a + 256], kind) for c, kind in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["tile", "side", "set_key", "rows", "data"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        for b in batches:
            for tile, side, key, rows, data in zip(*(b.column(j).to_pylist() for j in range(4)), b.column(4), strict=True):
                if tile != now and held:
                    yield from compare(held)
                    held = {}
                now = tile
                held[key] = (side, rows, np.frombuffer(data.as_py(), np.uint64))
        if held:
            yield from compare(held)

    def compare(held: dict[int, tuple[int, int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        rows = sorted(((len(s), key, side, n, s) for key, (side, n, s) in held.items()), key=lambda x: x[:2])
        sides = np.array([r[2] for r in rows])
        found, linked = links(np.array([r[0] for r in rows], np.int64), [signature(r[4]) for r in rows], percent, None if sides[0] < 0 else sides, [r[4] for r in rows], np.array([r[3] for r in rows], np.int64))
        some = np.flatnonzero(linked).tolist()
        a, b = [rows[i][1] for i, _ in found] + [rows[i][1] for i in some], [rows[j][1] for _, j in found] + [None] * len(some)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([None] * len(found) + linked[some].tolist(), pa.int64())], names=["a", "b", "linked"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    chosen = texts.join(members, F.coalesce(texts["doc_id"], F.lit(NO_ID)) == members["d"]).select("text", "set_key", "rows", "tiles")
    dealt = chosen.mapInArrow(_text.lean(deal), "tile long, side int, set_key long, rows long, data binary")
    return dealt.repartition(reducers, "tile").sortWithinPartitions("tile").mapInArrow(_text.lean(link), _LINKS)


#: Members of clusters, 32 bytes each, up to which they are broadcast to the texts instead of joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Rows of the tables of large groups, 30 bytes each, up to which they are broadcast.
BROADCAST_GROUPS = 200_000
#: Stands for a missing id; it is greater than any other.
NO_ID = (1 << 63) - 1


def linked_classes(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): doc_id, n_shingles, set_key of every row; set_key, rows, n_links of one of its documents, and the
    component's first class: root_id (its least doc_id, NO_ID without one) and root_key."""
    spark = docs.sparkSession
    _shared.small_batches(spark)
    found = _shared.materialize(classes(docs, width, id_col, text_col), "classes")
    totals = found.agg(F.sum("n_shingles").alias("grams"), F.count("*").alias("rows")).first()
    total = int(totals["grams"] or 0)
    least = F.min(F.coalesce("doc_id", F.lit(NO_ID)))
    sets = _shared.materialize(found.where("set_key is not null").groupBy("set_key").agg(least.alias("d"), F.count("*").alias("rows"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature")), "sets")
    met = _shared.materialize(meetings(docs, total, width, percent, text_col), "meetings")
    rough = connected(candidates(met, sets, percent, met.count()))
    clusters = _shared.materialize(rough.select(F.col("v").alias("set_key"), "root").join(sets.select("set_key", "n", "d", "rows"), "set_key"), "clusters")
    dealt = tiles(clusters, "root", percent, "clusters").groupBy("set_key", "d", "rows").agg(F.collect_list(F.struct("tile", "side")).alias("tiles"))
    members = _shared.materialize(dealt, "members")
    size = members.agg(F.count("*"), F.sum(F.size("tiles"))).first()
    reducers = _shared.reducers(spark, 8 * (size[1] or 0) * total / max(1, totals["rows"]))
    links_ = _shared.materialize(tile_links(docs, F.broadcast(members) if (size[1] or 0) <= BROADCAST_ROWS else members, width, percent, id_col, text_col, reducers), "links")
    vertex = sets.select("set_key", F.struct("d", F.col("set_key").alias("k")).alias("x"))
    # the vertices are (least doc_id, key), so that a component's root names its least document and no join on roots is needed
    edges = links_.where("b is not null").select(F.col("a").alias("set_key"), "b").join(vertex.withColumnRenamed("x", "a"), "set_key").select("a", F.col("b").alias("set_key")).join(vertex.withColumnRenamed("x", "b"), "set_key").select("a", "b")
    linked = connected(edges).select(F.col("v.k").alias("set_key"), F.col("root.d").alias("root_id"), F.col("root.k").alias("root_key"))
    counts = links_.where("linked is not null").groupBy(F.col("a").alias("set_key")).agg(F.sum("linked").alias("linked"))
    known = sets.select("set_key", "rows", "d").join(linked, "set_key", "left").join(counts, "set_key", "left")
    return found, known.select("set_key", "rows", (F.col("rows") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("root_id", "d").alias("root_id"), F.coalesce("root_key", "set_key").alias("root_key"))


def near_components(docs: DataFrame, width: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row of docs: doc_id, n_shingles, component_id (smallest doc_id that links reach, itself included) and n_links, the number of other documents it links with."""
    if not 50 <= percent <= 100 or width < 1:
        raise ValueError("the threshold is 50 to 100 percent, as signatures are compared at one or two widths")
    found, known = linked_classes(docs, width, percent, id_col, text_col)
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.nullif("root_id", F.lit(NO_ID)))
    return found.select("doc_id", "n_shingles", "set_key").join(known, "set_key", "left").select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


#: Ids to drop, 8 bytes each, up to which they are broadcast to the documents.
BROADCAST_IDS = 2_000_000


def with_set_keys(docs: DataFrame, width: int, text_col: str, name: str) -> DataFrame:
    """The rows with the key of their set (null for the empty one) as the last column."""
    names, place = [*docs.columns, name], docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.blocks(batches, text_col):
            sets = _text.shingle_sets(*_text.words(*_text.buffers(b.column(place))), width)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())], names=names)

    return docs.mapInArrow(_text.lean(run), T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def drop_near_copies(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns kept whatever their names: of each component one row stays, the one with the smallest id.

    Decisions are by row: of rows that repeat an id with different texts each stays or goes by its own text, and of
    several with one set the first by text stays. Rows without an id stay only where no row of their component has one. Rows without
    words stay, but for repetitions of both id and text.
    """
    if not 50 <= percent <= 100 or width < 1:
        raise ValueError("the threshold is 50 to 100 percent, as signatures are compared at one or two widths")
    names = [f"_c{i}" for i in range(len(docs.columns))]
    own, text = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    plain = docs.toDF(*names)
    found, known = linked_classes(plain, width, percent, own, text)
    known = _shared.materialize(known, "decisions")
    decided = found.select("doc_id", "set_key").join(known.select("set_key", "root_id"), "set_key", "left")
    gone = _shared.materialize(decided.where("doc_id <> root_id").select(F.col("doc_id").alias(own)).distinct(), "gone")
    several = _shared.materialize(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(own)), "several")
    few = lambda df: F.broadcast(df) if df.count() <= BROADCAST_IDS else df
    if several.isEmpty() and found.where("doc_id is null").isEmpty():
        return plain.join(few(gone), own, "left_anti").select(*names).toDF(*docs.columns)
    once = plain.where(F.col(own).isNotNull()).join(few(several), own, "left_anti").join(few(gone), own, "left_anti").select(*names)
    odd = plain.where(F.col(own).isNull()).unionByName(plain.join(few(several), own, "left_semi").select(*names))
    keyed = with_set_keys(odd, width, text, "_set").join(known.select(F.col("set_key").alias("_set"), "root_id", "root_key"), "_set", "left")
    first = keyed.where("_set is null").unionByName(keyed.where((F.col("_set") == F.col("root_key")) & (F.coalesce(F.col(own).cast("long"), F.lit(NO_ID)) == F.col("root_id"))))
    one = Window.partitionBy(own, F.coalesce(F.col("_set").cast("string"), F.sha2(F.coalesce(text, F.lit("")), 256))).orderBy(text)
    kept = first.withColumn("_n", F.row_number().over(one)).where("_n = 1").select(*names)
    return once.unionByName(kept).toDF(*docs.columns)
