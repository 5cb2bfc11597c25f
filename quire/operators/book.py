"""The book: text pages joined with their sources and figures, gates, payload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import coverage

EDITIONS = {"diplomatic": "diplomatic_text", "normalized": "normalized_text"}


def edition_text(pages: DataFrame, edition: str) -> DataFrame:
    """The edition's layer as text."""
    if edition not in EDITIONS:
        raise ValueError(f"editions are {', '.join(EDITIONS)}")
    return pages.withColumn("text", F.col(EDITIONS[edition]))


def joined_sources(texts: DataFrame, sources: DataFrame) -> DataFrame:
    """Text pages with their source's index, hash, size; what disagrees is marked in problem."""
    s = sources.select("id", F.col("physical_index").alias("_pi"), F.col("sha256").alias("_sha"), "width", "height", "printed_page")
    j = texts.join(s, "id", "left")
    problem = F.when(F.col("_sha").isNull() & F.col("_pi").isNull(), "no-source").when(~F.col("physical_index").eqNullSafe(F.col("_pi")), "physical-index").when(~F.col("source_sha256").eqNullSafe(F.col("_sha")), "source-hash")
    return j.withColumn("problem", problem).drop("_pi", "_sha")


def nested(parents: DataFrame, children: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """Each parent with its children as an ordered array (empty where it has none)."""
    fields = [c for c in children.columns if c != key and c not in order]
    grouped = children.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*order, *fields))).alias(name))
    empty = F.expr("array()").cast(grouped.schema[name].dataType)
    return parents.join(grouped, key, "left").withColumn(name, F.coalesce(name, empty))


def figure_rows(figures: DataFrame) -> DataFrame:
    """Figures with the columns of their order: y (1e9 where unknown), asset index (0), label as text."""
    return figures.withColumn("_y", F.coalesce(F.col("asset_bbox")[1].cast("double"), F.lit(1e9))).withColumn("_i", F.coalesce(F.col("asset_index").try_cast("int"), F.lit(0))).withColumn("_l", F.coalesce("label", F.lit("")))


def batch_records(pages: DataFrame, names: list[str], start: int, count: int, order: str = "physical_index") -> DataFrame:
    """The manifest rows of an editorial batch: pages (with ``path`` and a column for each OCR layer, see coverage.with_layers)
    from the start-th on, each with the places of its files in the archive."""
    fields = ["id", "physical_index", "source_pdf_sheet", "spread_side", "printed_page", "sha256", "extraction_method", "held_out_benchmark_v1"]
    rows = coverage.numbered(pages, [order])
    total = pages.count()
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    files = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.concat(F.lit(f"ocr/{n}/"), F.col("id"), F.lit(".txt")) for n in names]))
    return coverage.batch_slice(rows, start, count, total).select(*[c for c in fields if c in pages.columns], F.concat(F.lit("pages/"), "id", suffix).alias("page_file"), files.alias("ocr")).orderBy(order)


def book_pages(texts: DataFrame, sources: DataFrame, figures: DataFrame, edition: str) -> DataFrame:
    """The pages of a book; figures: page_id, kind, label, id, file, sha256, asset_bbox, asset_index."""
    pages = joined_sources(edition_text(texts, edition), sources)
    rows = figure_rows(figures).withColumnRenamed("id", "figure_id").withColumnRenamed("page_id", "id")
    out = nested(pages, rows, "id", ["_y", "_i", "_l"], "figures")
    return out.select("id", "physical_index", "page_type", "status", "text", "figures", "notes", F.struct("width", "height", "printed_page").alias("source_geometry"), F.struct("source_sha256", "editorial_batch").alias("provenance"), "problem")
