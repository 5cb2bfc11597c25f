"""Coverage, resume, batches and sets: anti joins, duplicates, gaps, slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.store import materialize


def missing(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    return expected.join(actual.select(*keys).distinct(), keys, "left_anti")


def layer_coverage(expected: DataFrame, layers: DataFrame, key: str = "page_id", layer: str = "engine", names: DataFrame | None = None) -> DataFrame:
    """By layer: expected, available, missing, extra. expected: key; layers: layer, key; names: the layers to report (few).

    Each layer's distinct keys are matched once against the expected keys, and only counted.
    """
    expected = expected.select(key).distinct()
    have = layers.select(layer, key).distinct().join(expected.withColumn("_in", F.lit(True)), key, "left")
    counts = have.groupBy(layer).agg(F.count("_in").alias("available"), F.sum(F.col("_in").isNull().cast("long")).alias("extra"))
    total = expected.agg(F.count("*").alias("expected"))
    names = (layers.select(layer).distinct() if names is None else names).crossJoin(total)  # one row
    out = names.join(counts, layer, "left")
    available = F.coalesce("available", F.lit(0))
    return out.select(layer, "expected", available.alias("available"), (F.col("expected") - available).alias("missing"), F.coalesce("extra", F.lit(0)).alias("extra"))


def missing_by_layer(expected: DataFrame, layers: DataFrame, names: DataFrame, key: str = "page_id", layer: str = "engine") -> DataFrame:
    """(layer, key) of every expected key that a layer lacks; names are the layers, a short list."""
    return missing(expected.select(key).distinct().crossJoin(names.select(layer)), layers, [layer, key])


def preview(rows: DataFrame, group: str, key: str, most: int = 20) -> DataFrame:
    """The first ``most`` keys of each group in their order, as an array: what a report shows of a long list."""
    first = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(group).orderBy(key))).where(F.col("_rn") <= most)
    return first.groupBy(group).agg(F.sort_array(F.collect_list(key)).alias("first"))


def with_layers(pages: DataFrame, layers: DataFrame, names: list[str], value: str = "text", key: str = "page_id", layer: str = "engine") -> tuple[DataFrame, DataFrame]:
    """(pages with one column a layer, violations): every page needs every layer, and the pages that lack one are violations (rule, key, detail)."""
    wide = layers.where(F.col(layer).isin(names)).groupBy(key).pivot(layer, names).agg(F.max(F.struct(F.col(value).alias("v"))))
    j = pages.join(wide, key, "left")
    lacks = F.filter(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in names]), lambda x: x.isNotNull())
    bad = j.select(F.lit("missing-layer").alias("rule"), F.col(key).cast("string").alias("key"), F.explode(lacks).alias("detail"))
    return j.where(F.size(lacks) == 0).withColumns({n: F.col(f"{n}.v") for n in names}), bad


def pending(inputs: DataFrame, outputs: DataFrame, keys: list[str]) -> DataFrame:
    """Inputs without an output: what a resumed run still has to do."""
    return missing(inputs, outputs, keys)


def with_flag(df: DataFrame, members: DataFrame, key: str, flag: str) -> DataFrame:
    """A boolean column: the key is among the members' keys."""
    marked = members.select(F.col(key)).distinct().withColumn(flag, F.lit(True))
    return df.join(marked, key, "left").withColumn(flag, F.col(flag).isNotNull())


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys on one side only: key, side (only_first or only_second)."""
    x = a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti").withColumn("side", F.lit("only_first"))
    y = b.select(key).distinct().join(a.select(key).distinct(), key, "left_anti").withColumn("side", F.lit("only_second"))
    return x.unionByName(y)


def numbered(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """1-based positions in a global order, without putting all rows in one task: rows are sorted in ranges, and each range
    begins after the sizes of those before it."""
    ranged = df.sort(*order).withColumn("_range", F.spark_partition_id())
    ranged = ranged.withColumn("_within", F.monotonically_increasing_id() - F.shiftleft(F.col("_range").cast("long"), 33))
    ranged = materialize(ranged, "numbered")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))  # one row a range
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_range", "_before")
    return ranged.join(F.broadcast(before), "_range").withColumn(name, F.col("_within") + F.col("_before") + 1).drop("_range", "_within", "_before")


def batches(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """Adds position and batch (1-based) of chunks of ``size`` rows."""
    return numbered(df, order).withColumn("batch", F.ceil(F.col("position") / size).cast("long"))


def batch_slice(df: DataFrame, start: int, count: int, total: int, position: str = "position") -> DataFrame:
    """Rows start to start + count - 1; the start must be within 1..total, a short tail is allowed."""
    if not 1 <= start <= total or count < 1:
        raise ValueError(f"a slice begins within 1..{total} and holds at least one row")
    return df.where(F.col(position).between(start, start + count - 1))


def batch_integrity(references: DataFrame, pages: DataFrame, key: str = "id", compared: tuple[str, ...] = ("physical_index", "status")) -> DataFrame:
    """Violations (rule, key, detail) of batches' references against the page records; orphans only if there is a batch."""
    at = pages.select(key, *[F.col(c).alias(f"_p_{c}") for c in compared]).withColumn("_there", F.lit(True))
    joined = references.join(at, key, "left")
    row = lambda df, rule, detail: df.select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"), detail.cast("string").alias("detail"))
    out = row(joined.where("_there is null"), "missing-page", F.lit(""))
    for c in compared:
        out = out.unionByName(row(joined.where(F.col("_there") & ~F.col(c).eqNullSafe(F.col(f"_p_{c}"))), c, F.col(c)))
    out = out.unionByName(row(duplicates(references, [key]), "several-batches", F.col("n")))
    orphans = pages.join(references.select(key).distinct(), key, "left_anti")
    some = references.limit(1).select(F.lit(1).alias("_some"))
    return out.unionByName(row(orphans.crossJoin(F.broadcast(some)), "orphan", F.lit("")))  # one row or none


def sequence_gaps(df: DataFrame, group: list[str], index: str, start: int = 1) -> DataFrame:
    """Groups whose indexes are not exactly start, start + 1, ...: n, least, greatest, distinct."""
    g = df.groupBy(*group).agg(F.count("*").alias("n"), F.min(index).alias("least"), F.max(index).alias("greatest"), F.count_distinct(index).alias("distinct_n"))
    return g.where((F.col("least") != start) | (F.col("greatest") != F.col("n") + start - 1) | (F.col("distinct_n") != F.col("n")))


def same_sequence(a: DataFrame, b: DataFrame, position: str, value: str) -> DataFrame:
    """Positions at which two ordered lists differ, or that one lacks."""
    x = a.select(position, F.col(value).alias("first"))
    y = b.select(position, F.col(value).alias("second"))
    return x.join(y, position, "full_outer").where(~F.col("first").eqNullSafe(F.col("second")))


def run_accounting(inputs: DataFrame, before: DataFrame, written: DataFrame, keys: list[str]) -> DataFrame:
    """One row: expected, resumed, written, available and missing outputs of a run."""
    mark = lambda df, c: df.select(*keys).distinct().withColumn(c, F.lit(1))
    rows = inputs.select(*keys).distinct().join(mark(before, "b"), keys, "left").join(mark(written, "w"), keys, "left")
    return rows.agg(F.count("*").alias("expected"), F.count("b").alias("resumed"), F.count(F.when(F.col("b").isNull(), F.col("w"))).alias("written"), F.count(F.coalesce("b", "w")).alias("available"), F.sum((F.coalesce("b", "w").isNull()).cast("long")).alias("missing"))
