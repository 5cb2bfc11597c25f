"""Tables in the folder that driver and executors share, and packed exchanges."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import _text

#: Bytes that one reducer of a packed exchange is meant to hold.
REDUCER_BYTES = 16 << 20
#: Bytes of one Arrow batch between the JVM and Python, and the setting with its default.
BATCH_BYTES, BATCH_KEY, BATCH_DEFAULT = "4m", "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only where none is set and the master is local."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quire-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/quire/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: this cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    give_back(spark)
    return spark.read.schema(df.schema).parquet(path)


def give_back(spark: SparkSession) -> bool:
    """Have the driver's JVM return to the system what its compilers have freed, and what the allocator else keeps for good. False
    where the JVM has no such command (HotSpot on Linux has it from 17.0.9 on); nothing else depends on it."""
    jvm = spark.sparkContext._jvm
    kind = jvm.java.lang.Class.forName
    try:
        name = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        types = spark.sparkContext._gateway.new_array(jvm.java.lang.Class, 4)
        for k, of in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            types[k] = kind(of)
        given = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
        given[0], given[1] = name, "systemTrimNativeHeap"
        kind("javax.management.MBeanServer").getMethod("invoke", types).invoke(server, given)  # the server's own class is closed to reflection
    except Py4JError:
        return False
    return True


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by 4 MB unless the session has a limit of its own: each side of a Python task holds several copies of one."""
    if spark.conf.get(BATCH_KEY, BATCH_DEFAULT) == BATCH_DEFAULT:
        spark.conf.set(BATCH_KEY, BATCH_BYTES)


def plan_bytes(df: DataFrame, text_col: str) -> float:
    """What the optimizer takes for the size of df (file sizes, for a scan), which only sizes exchanges; where it knows nothing, the bytes of the texts."""
    known = float(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return known if known < 2.0**56 else float(df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0)


def reducers(spark: SparkSession, total_bytes: float) -> int:
    """Reducers for so many bytes: at least the session's shuffle partitions' share, growing with the input."""
    least = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), 64))
    return int(max(least, -(-total_bytes // REDUCER_BYTES)))


def deal_keys(count: int) -> np.ndarray:
    """For each of ``count`` partitions an integer that Spark's hash partitioning sends there, so that packed shards are
    dealt one a task. (Murmur3 of one integer with seed 42, as the engine has it.)"""
    found = np.full(count, -1, np.int64)
    low = 0
    while (found < 0).any():
        x = np.arange(low, low + 4 * count + 16, dtype=np.int64)
        h = _murmur3(x.astype(np.uint32)).astype(np.int64) % count
        fresh = found[h] < 0
        found[h[fresh][::-1]] = x[fresh][::-1]
        low += len(x)
    return found.astype(np.int32)


def _murmur3(x: np.ndarray) -> np.ndarray:
    turn = lambda v, n: v << np.uint32(n) | v >> np.uint32(32 - n)
    with np.errstate(over="ignore"):
        h = np.uint32(42) ^ turn(x * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
        h = turn(h, 13) * np.uint32(5) + np.uint32(0xE6546B64) ^ np.uint32(4)
        h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
        h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
        return (h ^ h >> np.uint32(16)).view(np.int32)


def _joined(columns: list[np.ndarray]) -> bytes:
    return b"".join(c.tobytes() for c in columns)


def packed(shard: np.ndarray, columns: list[np.ndarray], shards: int, encode: Callable[[list[np.ndarray]], bytes] = _joined) -> Iterator[pa.RecordBatch]:
    """Rows (shard, data): all entries of a shard in one binary value, column after column unless ``encode`` writes them
    otherwise, in the order given. The shard is named by its deal key."""
    order = np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")  # short numbers are sorted by digits
    sorted_shard = shard[order]
    starts = np.flatnonzero(np.concatenate(([True], sorted_shard[1:] != sorted_shard[:-1]))) if len(order) else np.zeros(0, np.int64)
    names = deal_keys(shards)[sorted_shard[starts]].tolist()
    columns = [c[order] for c in columns]
    ids, blobs, size = [], [], 0
    for name, a, b in zip(names, starts.tolist(), [*starts[1:].tolist(), len(order)], strict=False):
        ids.append(name)
        blobs.append(encode([c[a:b] for c in columns]))
        size += len(blobs[-1])
        if size > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "data"])
            ids, blobs, size = [], [], 0
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "data"])


def unpacked(batches: Iterator[pa.RecordBatch], kinds: list[str]) -> list[np.ndarray]:
    """The columns of all packed rows of a partition."""
    width = sum(np.dtype(k).itemsize for k in kinds)
    parts: list[list[np.ndarray]] = [[np.zeros(0, k)] for k in kinds]
    for batch in batches:
        for blob in batch.column(1):
            raw = blob.as_buffer()
            n, at = raw.size // width, 0
            for j, k in enumerate(kinds):
                parts[j].append(np.frombuffer(raw, k, n, at))
                at += n * np.dtype(k).itemsize
    return [np.concatenate(p) for p in parts]


def exchange(rows: DataFrame, count: int, reduce: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, heap: int = 1 << 20) -> DataFrame:
    """Deal packed rows by shard to ``count`` tasks and run ``reduce`` in each."""
    return rows.repartition(count, F.col("shard")).mapInArrow(_text.lean(reduce, heap), schema)
