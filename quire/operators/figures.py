"""Figures: precedence of sources, placement, compositions, final set."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import geometry as G
from quire.functions import text as X


def natural_order(df: DataFrame, label: str = "label") -> DataFrame:
    """By number, then without before with bis."""
    return df.orderBy(X.label_number(F.col(label)), X.label_bis(F.col(label)))


def universe(df_session, last: int = 156, bis: tuple[int, ...] = (28, 87)) -> DataFrame:
    """All labels: 1 to last, and those with bis."""
    plain = df_session.range(1, last + 1).select(F.col("id").cast("string").alias("label"))
    return plain.unionByName(df_session.createDataFrame([(f"{n}bis",) for n in bis], "label string")) if bis else plain


def by_precedence(logical: DataFrame, direct: DataFrame, manual: DataFrame, label: str = "label", page: str = "page_id") -> tuple[DataFrame, DataFrame]:
    """(figures, errors). Logical first; direct ones of pages that no logical one owns; manual ones replace either silently.

    A label that logical and direct sources give twice is an error row (label, n), and is kept once in neither.
    """
    own = [c for c in logical.columns]
    rest = direct.join(logical.select(page).distinct(), page, "left_anti").select(*own)
    base = logical.withColumn("source_category", F.lit("logical")).unionByName(rest.withColumn("source_category", F.lit("direct")))
    errors = base.groupBy(label).agg(F.count("*").alias("n")).where("n > 1")
    ranked = base.join(errors.select(label), label, "left_anti").withColumn("_p", F.lit(1)).unionByName(manual.select(*own).withColumn("source_category", F.lit("manual")).withColumn("_p", F.lit(0)))
    first = Window.partitionBy(label).orderBy("_p", *own)
    return ranked.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn", "_p"), errors


def zip_by_position(left: DataFrame, right: DataFrame, page: str, left_order: list[str], right_order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The n-th row of a page's left side with the n-th of its right side, and the pages whose counts differ."""
    a = left.withColumn("position", F.row_number().over(Window.partitionBy(page).orderBy(*left_order)))
    b = right.withColumn("position", F.row_number().over(Window.partitionBy(page).orderBy(*right_order)))
    counts = a.groupBy(page).agg(F.count("*").alias("n_left")).join(b.groupBy(page).agg(F.count("*").alias("n_right")), page, "full_outer").na.fill(0, ["n_left", "n_right"])
    return a.join(b, [page, "position"]), counts.where("n_left <> n_right")


def restored_labels(regression: DataFrame, manual: DataFrame) -> DataFrame:
    """Labels of weak regression cases (case, label) and of restored manual assets (label, restored)."""
    weak = regression.where(F.col("case").startswith("weak-")).select("label")
    return weak.unionByName(manual.where("restored").select("label")).distinct()


def with_classes(figures: DataFrame, restored: DataFrame) -> DataFrame:
    """Adds classes: automatic or manual, and restored."""
    marked = figures.join(restored.select("label").distinct().withColumn("_r", F.lit(True)), "label", "left")
    kind = F.when(F.col("source_category") == "manual", "manual").otherwise("automatic")
    return marked.withColumn("classes", F.filter(F.array(kind, F.when(F.col("_r"), "restored")), lambda c: c.isNotNull())).drop("_r")


def class_counts(figures: DataFrame) -> DataFrame:
    """A figure counts in each of its classes."""
    return figures.select(F.explode("classes").alias("class")).groupBy("class").agg(F.count("*").alias("n"))


def placements(figures: DataFrame, logical: DataFrame, manual: DataFrame, overrides: DataFrame) -> DataFrame:
    """Each figure with page_id, page_bbox, evidence and whether it needs review.

    figures: label, id, source_category, kind, page_id, bbox. logical: figure_labels, page_id, union_bbox. manual: label, id,
    page_id, base_bbox, trim_x, trim_y (nullable). overrides: label, page_id, asset_bbox. An override wins; then a figure's own category decides.
    """
    lo = logical.select(F.explode("figure_labels").alias("label"), F.col("page_id").alias("l_page"), F.col("union_bbox").alias("l_box"))
    key = F.coalesce("label", "id")
    ma = manual.select(key.alias("_key"), F.col("page_id").alias("m_page"), G.shift(F.col("base_bbox"), F.coalesce("trim_x", F.lit(0)), F.coalesce("trim_y", F.lit(0))).alias("m_box"))
    ov = overrides.select("label", F.col("page_id").alias("o_page"), F.col("asset_bbox").alias("o_box"))
    j = figures.withColumn("_key", key).join(lo, "label", "left").join(ma, "_key", "left").join(ov, "label", "left")
    category = F.col("source_category")

    def pick(o: str, lg: str, m: str, own: str):
        return F.when(F.col("o_page").isNotNull(), F.col(o)).when(category == "logical", F.col(lg)).when(category == "manual", F.coalesce(F.col(m), F.col(own))).otherwise(F.col(own))

    evidence = F.when(F.col("o_page").isNotNull(), "override").when(category == "logical", "composition").when((category == "manual") & F.col("m_page").isNotNull(), "manual-asset").otherwise("detected")
    out = j.withColumn("placed_page", pick("o_page", "l_page", "m_page", "page_id")).withColumn("placed_box", pick("o_box", "l_box", "m_box", "bbox")).withColumn("evidence", evidence)
    return out.withColumn("requires_visual_placement_review", F.col("placed_box").isNull() | F.col("placed_page").isNull()).drop("_key", "l_page", "l_box", "m_page", "m_box", "o_page", "o_box")


def union_box(df: DataFrame, keys: list[str], box: str = "bbox") -> DataFrame:
    b = F.col(box)
    return df.groupBy(*keys).agg(F.struct(F.min(b["x1"]).alias("x1"), F.min(b["y1"]).alias("y1"), F.max(b["x2"]).alias("x2"), F.max(b["y2"]).alias("y2")).alias("union_bbox"), F.count("*").alias("parts"))


def part_offsets(parts: DataFrame, key: str = "id", box: str = "bbox", padding: int = 0) -> DataFrame:
    """Each part with its composition's union box and its offset in it."""
    unions = union_box(parts, [key], box).select(key, "union_bbox")
    return parts.join(unions, key).withColumn("offset_x", F.col(f"{box}.x1") - F.col("union_bbox.x1") + padding).withColumn("offset_y", F.col(f"{box}.y1") - F.col("union_bbox.y1") + padding)


def overlapping_pairs(boxes: DataFrame, keys: list[str], ident: str, box: str = "bbox", cell: int = 512) -> DataFrame:
    """Pairs (a, b) of one key whose boxes strictly overlap.

    Boxes go to the cells they cover and meet only there; a pair is kept in the cell of its overlap's corner, so it appears once and no distinct is needed.
    """
    b = F.col(box)
    span = lambda lo, hi: F.sequence(F.floor(lo / cell), F.floor((hi - 1) / cell))
    cells = boxes.where(G.is_valid(b) | ((b["x2"] > b["x1"]) & (b["y2"] > b["y1"]))).select(*keys, F.col(ident).alias("_id"), b.alias("_b"), F.explode(span(b["x1"], b["x2"])).alias("_cx"), F.col(f"{box}.y1").alias("_y1"), F.col(f"{box}.y2").alias("_y2"))
    cells = cells.withColumn("_cy", F.explode(span(F.col("_y1"), F.col("_y2")))).drop("_y1", "_y2")
    other = cells.select(*keys, "_cx", "_cy", F.col("_id").alias("_id2"), F.col("_b").alias("_b2"))
    pairs = cells.join(other, [*keys, "_cx", "_cy"]).where("_id < _id2").where(G.overlaps(F.col("_b"), F.col("_b2")))
    corner = (F.floor(F.greatest("_b.x1", "_b2.x1") / cell) == F.col("_cx")) & (F.floor(F.greatest("_b.y1", "_b2.y1") / cell) == F.col("_cy"))
    return pairs.where(corner).select(*keys, F.col("_id").alias("a"), F.col("_id2").alias("b"))


def composition_violations(parts: DataFrame) -> DataFrame:
    """(rule, key, detail) of composition parts: id, part, page_id, asset_index, clip (nullable box), asset (box, null where missing), output."""
    row = lambda df, rule, detail: df.select(F.lit(rule).alias("rule"), F.col("id").cast("string").alias("key"), detail.cast("string").alias("detail"))
    window = F.coalesce("clip", "asset")
    out = row(parts.where("asset is null"), "asset-missing", F.col("asset_index"))
    out = out.unionByName(row(parts.where(F.col("clip").isNotNull() & ~G.inside(F.col("clip"), F.col("asset"))), "clip-outside-asset", F.col("asset_index")))
    out = out.unionByName(row(parts.select("id", "output").distinct().groupBy("output").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n > 1"), "output-twice", F.col("output")))
    out = out.unionByName(row(parts.where(~X.safe_path(F.col("output"))), "unsafe-path", F.col("output")))
    out = out.unionByName(row(parts.where(F.trim(F.coalesce(F.col("id").cast("string"), F.lit(""))) == ""), "missing-id", F.col("output")))
    clashes = overlapping_pairs(parts.where("asset is not null").withColumn("_w", window), ["id", "page_id", "asset_index"], "part", "_w")
    return out.unionByName(row(clashes, "overlapping-windows", F.concat_ws("-", "a", "b")))


def specification_violations(entries: DataFrame) -> DataFrame:
    """(rule, key, detail) of composition entries before their parts are read: id, page_id, layout (null: source-coordinates), asset_indices
    and parts (arrays, of which exactly one must be given and hold something)."""
    c = F.col
    given = lambda name: F.coalesce(F.size(name) > 0, F.lit(False))
    rules = [("missing-id", F.trim(F.coalesce("id", F.lit(""))) == "", F.lit("")), ("layout", F.coalesce("layout", F.lit("source-coordinates")) != "source-coordinates", c("layout")),
             ("unsafe-page", (F.trim(F.coalesce("page_id", F.lit(""))) == "") | c("page_id").contains("/") | c("page_id").isin(".", ".."), c("page_id")),
             ("indices-xor-parts", given("asset_indices") == given("parts"), F.lit("")), ("index-twice", given("asset_indices") & (F.size(F.array_distinct("asset_indices")) < F.size("asset_indices")), F.array_join(c("asset_indices").cast("array<string>"), ","))]
    found = F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(rule).alias("rule"), F.coalesce("id", F.lit("")).alias("key"), F.coalesce(detail, F.lit("")).alias("detail"))) for rule, bad, detail in rules])
    rows = entries.select(F.explode(F.filter(found, lambda x: x.isNotNull())).alias("v")).select("v.*")
    twice = entries.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("id-twice").alias("rule"), F.coalesce("id", F.lit("")).alias("key"), c("n").cast("string").alias("detail"))
    return rows.unionByName(twice)


def census_equality(figures: DataFrame, expected: dict[str, int]) -> DataFrame:
    """By section: n, distinct files, the number expected, and whether all agree."""
    want = F.element_at(F.create_map(*[F.lit(x) for k, n in expected.items() for x in (k, n)]), F.col("section"))
    got = figures.groupBy("section").agg(F.count("*").alias("n"), F.count_distinct("file").alias("files"))
    return got.withColumn("expected", want.cast("long")).withColumn("equal", (F.col("n") == F.col("expected")) & (F.col("files") == F.col("n")))
