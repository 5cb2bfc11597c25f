"""Figure census: geometry of detected assets, triage flags and scores, review categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import geometry as G
from quire.functions import text as X


def asset_geometry(assets: DataFrame, box: str = "bbox", width: str = "width", height: str = "height") -> DataFrame:
    b, w, h = F.col(box), F.col(width), F.col(height)
    return assets.withColumn("bbox_area_fraction", G.area_fraction(b, w, h)).withColumn("aspect_ratio_long_over_short", G.aspect(b)).withColumn("touches_page_edge_1pct", G.touches_edge(b, w, h))


def triage_rules(n: Column, captions: Column, page_class: Column, page_type: Column, atlas: Column, edge_risk: Column, notes: Column) -> list[tuple[str, Column, Column]]:
    """(flag, condition, score) in the order of evaluation. Null conditions count as false.

    Fixed values: flag names, limits and weights.
    """
    cap = lambda most, x: F.least(F.lit(most), x)
    plain = ~atlas
    noted = lambda p: F.coalesce(F.exists(notes, lambda t: t.rlike(f"(?iu){p}")), F.lit(False))
    return [
        ("DOMAIN_UNSUPPORTED", page_class != "normal-text-candidate", F.lit(8)),
        ("TITLE_TYPOGRAPHY_FALSE_POSITIVE_RISK", page_type.isin("title", "half-title", "cover-title") & (n > 0), cap(10, 3 + n)),
        ("COVER_MIXED_CONTENT_REVIEW", (page_type == "cover") & (n > 0), F.lit(4)),
        ("ATLAS_MULTI_DIAGRAM", atlas, F.lit(0)),
        ("CAPTIONED_FIGURE_MISSED", plain & (captions > 0) & (n == 0), F.lit(12)),
        ("ASSET_COUNT_GT_CAPTION_INDEX", plain & (captions > 0) & (n > captions), cap(10, 2 + 2 * (n - captions))),
        ("ASSET_COUNT_LT_CAPTION_INDEX", plain & (captions > 0) & (n > 0) & (n < captions), cap(10, 4 + 2 * (captions - n))),
        ("UNCAPTIONED_ASSETS_REVIEW", plain & (captions == 0) & (n > 0) & (page_type == "body"), cap(8, 2 + n)),
        ("EDGE_RULE_ARTIFACT_RISK", edge_risk > 0, cap(8, 2 + 2 * edge_risk)),
        ("EXTREME_ASSET_COUNT", n >= 5, F.lit(4)),
        ("HIGH_ASSET_COUNT", (n >= 3) & (n < 5), F.lit(2)),
        ("PROVENANCE_MARK_FALSE_POSITIVE_RISK", (n > 0) & noted("штамп"), F.lit(6)),
        ("RESTORE_BLEED_THROUGH_REFERENCE", noted("просвеч|просвет|bleed"), F.lit(2)),
    ]


def triage(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds flags (in order) and review_score."""
    rules = triage_rules(**columns)
    flags = F.filter(F.array(*[F.when(c, F.lit(name)) for name, c, _ in rules]), lambda f: f.isNotNull())
    score = sum((F.when(c, s).otherwise(0) for _, c, s in rules[1:]), F.when(rules[0][1], rules[0][2]).otherwise(0))
    return df.withColumn("flags", flags).withColumn("review_score", score.cast("long"))


def edge_risk(assets: Column) -> Column:
    """How many assets touch the edge, are long (8 and more) and thin (8 % of the page and less)."""
    risky = lambda a: a["touches_page_edge_1pct"] & (a["aspect_ratio_long_over_short"] >= 8) & (a["bbox_area_fraction"] <= 0.08)
    return F.size(F.filter(assets, risky))


def census(probe: DataFrame, texts: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
    """Probe rows (id, physical_index, page_class, assets) with their texts (id, page_type, text, notes); metrics (id, page_class, assets) go before the probe's own."""
    out = probe.join(texts.select("id", "page_type", "text", "notes"), "id", "left")
    if metrics is not None:
        own = metrics.select("id", F.col("page_class").alias("_class"), F.col("assets").alias("_assets"))
        out = out.join(own, "id", "left").withColumn("page_class", F.coalesce("_class", "page_class")).withColumn("assets", F.coalesce("_assets", "assets")).drop("_class", "_assets")
    text, notes = F.coalesce("text", F.lit("")), F.coalesce("notes", F.expr("cast(array() as array<string>)"))
    out = out.withColumn("caption_figure_numbers", X.caption_numbers(text)).withColumn("mentioned_figure_numbers", X.mention_numbers(text))
    out = out.withColumn("atlas_evidence", X.atlas_evidence(text, notes)).withColumn("detected_asset_count", F.coalesce(F.size("assets"), F.lit(0)))
    c = F.col
    return triage(out, n=c("detected_asset_count"), captions=F.size("caption_figure_numbers"), page_class=F.coalesce("page_class", F.lit("")), page_type=F.coalesce("page_type", F.lit("")), atlas=c("atlas_evidence"), edge_risk=edge_risk(F.coalesce("assets", F.expr("array()").cast(out.schema["assets"].dataType))), notes=notes)


def flag_frequency(df: DataFrame, flags: str = "flags") -> DataFrame:
    return df.select(F.explode(flags).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


def ranked(df: DataFrame, order: str = "physical_index", top: int | None = None) -> DataFrame:
    """By falling score, then rising order; with ``top`` the first rows only."""
    out = df.orderBy(F.desc("review_score"), F.asc(order))
    return out.limit(top) if top else out


def asset_histogram(df: DataFrame, count: str = "detected_asset_count") -> DataFrame:
    return df.groupBy(count).agg(F.count("*").alias("pages"))


def page_totals(df: DataFrame) -> DataFrame:
    has = lambda c: F.count_if(F.size(c) > 0)
    return df.agg(F.count("*").alias("pages"), F.count_if(F.col("detected_asset_count") > 0).alias("with_assets"), has("caption_figure_numbers").alias("with_captions"), F.count_if("atlas_evidence").alias("atlas"))


def review_category(key: Column, page: Column, removed: Column, paratext: Column, atlas: Column, numbered: Column) -> Column:
    """The first that applies: explicit_remove, paratext, atlas, numbered, removed. The flags come from joined policies."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return F.when(yes(removed), "explicit_remove").when(yes(paratext), "paratext").when(yes(atlas), "atlas").when(yes(numbered), "numbered").otherwise("removed")


def numbered_page(captions: Column, notes: Column) -> Column:
    """Captions exist, or a note speaks of a signed figure."""
    word = F.coalesce(F.exists(notes, lambda t: t.rlike(r"(?iuU)подпис\w*.{0,120}фиг|фиг.{0,120}подпис")), F.lit(False))
    return (F.size(captions) > 0) | word


def review_mode(figures: Column) -> dict[str, Column]:
    """Which pages each review shows: all, those with figures, those with manual, restored or doubtful ones."""
    doubtful = F.exists(figures, lambda f: F.coalesce(F.arrays_overlap(f["classes"], F.array(F.lit("manual"), F.lit("restored"))), F.lit(False)) | F.coalesce(f["requires_visual_placement_review"], F.lit(False)))
    return {"all": F.lit(True), "figures": F.size(figures) > 0, "doubtful": F.coalesce(doubtful, F.lit(False))}


def page_class(dark: Column, std: Column, near_white: Column) -> Column:
    """Of a page's pixels: mostly dark, blank or ordinary."""
    return F.when(dark > 0.75, "unsupported-dark-fulltone").when((std < 4) & (near_white > 0.98), "unsupported-near-blank").otherwise("normal-text-candidate")
