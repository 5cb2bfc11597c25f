"""Render flow: text blocks with figures between them, HTML of pages, facsimile pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as X

FIGURE_ORDER = ("y", "asset_index", "label")


def insertion_index(blocks: Column, y1: Column, y2: Column, page_height: Column, label: Column) -> Column:
    """Before which block (0-based) a figure goes.

    By the middle of its box, as a share of the page, rounded half to even; else before a block that is its caption
    alone, after one that mentions it; else at the end.
    """
    n = F.size(blocks)
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (y1 + y2) / 2.0 / page_height))
    by_place = F.least(n, F.greatest(F.lit(0), F.bround(share * n).cast("int")))
    quoted = F.concat(F.lit(r"\Q"), label, F.lit(r"\E"))
    mention = F.concat(F.lit(r"(?iu)(?:\(|\b)"), quoted, F.lit(r"\s*фиг"))
    alone = F.concat(F.lit(r"(?iu)^\s*"), quoted, F.lit(r"\s*фиг\.?\s*$"))
    first = F.array_position(F.transform(blocks, lambda b: F.rlike(b, mention)), True).cast("int")  # 1-based, 0 if none
    by_label = F.when(first > 0, F.when(F.rlike(F.get(blocks, first - 1), alone), first - 1).otherwise(F.least(n, first)))
    return F.when(n == 0, 0).when(y1.isNotNull() & y2.isNotNull() & (page_height > 0), by_place).otherwise(F.coalesce(F.when(F.coalesce(label, F.lit("")) != "", by_label), n))


def page_flow(pages: DataFrame, figures: DataFrame, page: str = "page_id", text: str = "text") -> DataFrame:
    """Rows (page, seq, kind, content) of a page's blocks and figures in reading order.

    figures: page, label, asset_index, y1, y2, file; pages: page, text, height. Figures before one block go by (y, index, label), nulls of y last.
    """
    blocks = pages.select(page, "height", X.text_blocks(F.coalesce(F.col(text), F.lit(""))).alias("_blocks"))
    texts = blocks.select(page, F.posexplode("_blocks").alias("k", "content")).select(page, "k", F.lit(1).alias("o"), F.lit(0.0).alias("y"), F.lit(0).alias("i"), F.lit("").alias("l"), F.lit("text").alias("kind"), "content")
    placed = figures.join(blocks, page).select(page, insertion_index(F.col("_blocks"), F.col("y1"), F.col("y2"), F.col("height"), F.col("label")).alias("k"), F.lit(0).alias("o"), F.coalesce(F.col("y1").cast("double"), F.lit(1e9)).alias("y"), F.coalesce("asset_index", F.lit(0)).alias("i"), F.coalesce("label", F.lit("")).alias("l"), F.lit("figure").alias("kind"), F.col("file").alias("content"))
    items = F.sort_array(F.collect_list(F.struct("k", "o", "y", "i", "l", "kind", "content")))
    return texts.unionByName(placed).groupBy(page).agg(items.alias("_items")).select(page, F.posexplode("_items").alias("seq", "x")).select(page, "seq", "x.kind", "x.content")


def html_page(flow: DataFrame, page: str = "page_id") -> DataFrame:
    """(page, html): a section with paragraphs (line feeds as breaks) and images."""
    text = F.concat(F.lit("<p>"), F.replace(X.html_escape(F.col("content")), F.lit("\n"), F.lit("<br/>")), F.lit("</p>"))
    image = F.concat(F.lit('<img src="'), X.html_escape(F.col("content")), F.lit('"/>'))
    rows = flow.select(page, "seq", F.when(F.col("kind") == "text", text).otherwise(image).alias("h"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "h"))), lambda x: x["h"]), "\n")
    return rows.groupBy(page).agg(F.concat(F.lit('<section id="'), X.safe_id(F.col(page).cast("string")), F.lit('">\n'), body, F.lit("\n</section>")).alias("html"))


def html_text(html: Column) -> Column:
    """The text of an HTML page: comments, head, navigation, scripts, styles and tags go, the known escapes are undone, blanks are joined."""
    t = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    for tag in ("head", "nav", "script", "style"):
        t = F.regexp_replace(t, rf"(?is)<{tag}\b.*?</{tag}>", " ")
    return X.content_normalize(X.html_unescape(F.regexp_replace(t, r"(?s)<[^>]*>", " ")))


def epub_path(path: Column) -> Column:
    return F.regexp_replace(path, "^figures/", "images/")


def with_facsimiles(pages: DataFrame, policy: DataFrame, key: str = "id") -> DataFrame:
    """Adds facsimile (boolean) and text, which is hidden on facsimile pages."""
    marked = policy.select(key).distinct().withColumn("_f", F.lit(True))
    return pages.join(marked, key, "left").withColumn("facsimile", F.col("_f").isNotNull()).withColumn("text", F.when(F.col("facsimile"), F.lit("")).otherwise(F.col("text"))).drop("_f")


def facsimile_flow(flow: DataFrame, policy: DataFrame, edition: str, page: str = "page_id") -> DataFrame:
    """A page flow as an edition shows facsimile pages (policy: page, file). html and epub: the image first, then all else hidden;
    fb2: the image, and the page's own figures go; pdf: the image alone stands for the page. Adds hidden (boolean)."""
    if edition not in ("html", "epub", "fb2", "pdf"):
        raise ValueError(f"no such edition: {edition}")
    marked = policy.select(page, "file").dropDuplicates([page])
    image = marked.select(page, F.lit(-1).alias("seq"), F.lit("facsimile").alias("kind"), F.col("file").alias("content"), F.lit(False).alias("hidden"))
    own = flow.join(marked.select(page, F.lit(True).alias("_f")), page, "left")
    shown = {"html": F.lit(True), "epub": F.lit(True), "fb2": F.col("_f").isNull() | (F.col("kind") != "figure"), "pdf": F.col("_f").isNull()}[edition]
    hidden = F.col("_f").isNotNull() if edition in ("html", "epub") else F.lit(False)
    return own.where(shown).select(page, "seq", "kind", "content", hidden.alias("hidden")).unionByName(image)


def atlas_pages(pages: DataFrame, width: float = 720.0, height: float = 489.6) -> DataFrame:
    """Page sizes of the fixed layout: plates are landscape; adds out_width, out_height and coverage of the plate."""
    plate = F.col("is_atlas")
    scale = F.least(F.lit(width) / F.col("width"), F.lit(height) / F.col("height"))
    covered = F.col("width") * scale * F.col("height") * scale / (width * height)
    return pages.withColumn("out_width", F.when(plate, F.lit(width)).otherwise(F.lit(height))).withColumn("out_height", F.when(plate, F.lit(height)).otherwise(F.lit(width))).withColumn("coverage", F.when(plate, covered))


def wrap(words: list[str], widths: dict[str, float], limit: float, space: float) -> list[str]:
    """Greedy lines by character widths (the missing count 1.0); a word wider than the line fails."""
    lines, line, used = [], [], 0.0
    for word in words:
        size = sum(widths.get(c, 1.0) for c in word)
        if size > limit:
            raise ValueError(f"a word is wider than the line: {word[:40]}")
        if line and used + space + size > limit:
            lines.append(" ".join(line))
            line, used = [], 0.0
        used += size + (space if line else 0.0)
        line.append(word)
    return [*lines, " ".join(line)] if line else lines


def first_fit(sizes: list[float], fits) -> float | None:
    """The first size that fits, as font sizes are tried from large to small."""
    return next((s for s in sizes if fits(s)), None)
