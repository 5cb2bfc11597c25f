"""Components of a page: neighbours, text scores, scale, growth of regions from seeds.

Neighbours meet through grid cells (equi-joins), never through a cross join. Shortest paths are relaxed
round by round over all pages at once; the greedy grouping of a page's regions depends on its order and
runs per page in Arrow groups, as a page's regions are few.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import geometry as G
from quire.functions.store import materialize

# Limits and weights of the page model. H is the height of capitals, S the stroke's width.
SCALE = {"dust": 0.0035, "least_dust": 4, "tall": 0.05, "wide": 0.07, "area": 3, "candidates": 30, "low": 0.65, "high": 1.55, "support": 0.22, "band": 20, "percentile": 0.97}
BASELINE = {"text": 0.55, "tall": 1.6, "wide": 2.5, "enough": 30, "least": 20, "smallest": 1e-6, "score": 3.5, "percentile": 0.995, "above": 0.5, "most_text": 0.72}
SEED_SIZE = {"extent": 2.2, "area": 7.0, "tall": 1.7}
SUPPORT = {"extent": 1.8, "area": 4.5, "score": 3.5, "core_text": 0.58, "strong_text": 0.48, "glyph_low": 0.5, "glyph_high": 1.5, "glyph_wide": 1.55, "glyph_area": 2.8, "glyph_text": 0.48, "kept_text": 0.42}
#: A pair of regions is one figure if a row holds: area ratio at most, gap at most (in H), then axis overlap at least or close edges at least.
GROUPING = ((0.3, 1.35, 0.08, 1), (1.0, 0.35, 0.18, 2), (1.0, 0.75, math.inf, 3))

#: Components a task of the neighbour join gets, about; partitions up to which the engine deals rows out without holding them.
TASK_COMPONENTS, UNSORTED = 1 << 15, 200


def meet(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join of tables that grow with the components: by sorting, never by a broadcast, whatever the optimizer takes their sizes for."""
    return left.join(right.hint("merge"), keys, how)


def with_box(components: DataFrame) -> DataFrame:
    return components.withColumn("box", G.box(F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("h")))


def neighbours(components: DataFrame, max_gap: float, page: str = "page_id", label: str = "label") -> DataFrame:
    """Pairs a < b of one page whose boxes are at most max_gap apart: gap, dx, dy and overlap ratios.

    A box covers the cells of its own area; the other one those of its area widened by max_gap. Long boxes cover many cells, so no pair is lost.
    """
    cell = max(int(math.ceil(2 * max_gap)), 8)
    # the optimizer takes cells for as few as components and would broadcast them; tasks get components by number, so that their memory does not grow
    tasks = max(components.sparkSession.sparkContext.defaultParallelism, components.count() // TASK_COMPONENTS + 1)
    boxed = components.select(page, label, F.col("x").alias("x1"), F.col("y").alias("y1"), (F.col("x") + F.col("w")).alias("x2"), (F.col("y") + F.col("h")).alias("y2"))
    boxed = boxed.repartition(min(tasks, UNSORTED), page, label)
    span = lambda lo, hi: F.sequence(F.floor(lo / cell), F.floor(hi / cell))

    def cells(pad: float, name: str) -> DataFrame:
        c, corners = F.col, [F.col(k).alias(f"{name}_{k}") for k in ("x1", "y1", "x2", "y2")]
        out = boxed.withColumn("cx", F.explode(span(c("x1") - pad, c("x2") + pad))).withColumn("cy", F.explode(span(c("y1") - pad, c("y2") + pad)))
        return out.select(page, "cx", "cy", c(label).alias(name), *corners).repartition(tasks, page, "cx", "cy")

    a, b = (G.box(*[F.col(f"{name}_{k}") for k in ("x1", "y1", "x2", "y2")]) for name in ("a", "b"))
    # both boxes cover the cell of the corner of a and the widened b, so a pair is kept there and appears once
    corner = (F.floor(F.greatest(F.col("a_x1"), F.col("b_x1") - max_gap) / cell) == F.col("cx")) & (F.floor(F.greatest(F.col("a_y1"), F.col("b_y1") - max_gap) / cell) == F.col("cy"))
    pairs = meet(cells(0, "a"), cells(max_gap, "b"), [page, "cx", "cy"]).where("a < b").where(corner)
    out = pairs.select(page, "a", "b", G.gap(a, b).alias("gap"), G.gap_x(a, b).cast("double").alias("dx"), G.gap_y(a, b).cast("double").alias("dy"), G.overlap_ratio(a["x1"], a["x2"], b["x1"], b["x2"]).alias("x_overlap_ratio"), G.overlap_ratio(a["y1"], a["y2"], b["y1"], b["y2"]).alias("y_overlap_ratio"))
    return out.where(F.col("gap") <= max_gap)


def line_support(components: DataFrame, page: str = "page_id", band: int = 64) -> DataFrame:
    """Adds line_support: how far a component has others of its height beside it, left and right."""
    rows = components.select(page, "label", "cx", "cy", "h")
    reach = F.greatest(F.lit(2.0), 0.5 * F.col("h"))
    left = rows.withColumn("row", F.explode(F.sequence(F.floor((F.col("cy") - reach) / band), F.floor((F.col("cy") + reach) / band))))
    other = rows.select(page, F.col("label").alias("l2"), F.col("cx").alias("cx2"), F.col("cy").alias("cy2"), F.col("h").alias("h2"), F.floor(F.col("cy") / band).alias("row"))
    dx = F.col("cx2") - F.col("cx")
    near = (F.abs(F.col("cy2") - F.col("cy")) <= reach) & (F.abs(F.col("h2") - F.col("h")) <= F.greatest(F.lit(2.0), 0.45 * F.col("h"))) & (F.abs(dx) <= 6 * F.col("h"))
    counts = meet(left, other, [page, "row"]).where((F.col("label") != F.col("l2")) & near).groupBy(page, "label").agg(F.count_if(dx < 0).alias("_l"), F.count_if(dx >= 0).alias("_r"))
    most, least = F.greatest("_l", "_r"), F.least("_l", "_r")
    score = F.least(F.lit(1.0), 0.65 * F.least(F.lit(1.0), most / 3) + 0.35 * F.least(F.lit(1.0), least / 2))
    return meet(components.drop("line_support"), counts, [page, "label"], "left").na.fill(0, ["_l", "_r"]).withColumn("line_support", score).drop("_l", "_r")


def text_scores(components: DataFrame, scale: DataFrame, page: str = "page_id") -> DataFrame:
    """Adds text_score in 0..1; scale: page, cap_height. Large components get 0."""
    rows = components.drop("text_score").join(scale.select(page, "cap_height"), page)
    small = (F.col("h") <= 1.9 * F.col("cap_height")) & (F.col("w") <= 3 * F.col("cap_height")) & (F.col("area") <= 5 * F.col("cap_height") * F.col("cap_height"))
    size = F.greatest(F.lit(6.0), 2 * F.col("cap_height"))
    own = rows.where(small).select(page, "label", "cx", "cy", "h", "w", "area", "cap_height", F.explode(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda i: F.floor(F.col("cy") / size) + i)).alias("row"))
    other = rows.where(small).select(page, F.col("label").alias("l2"), F.col("cx").alias("cx2"), F.col("cy").alias("cy2"), F.col("h").alias("h2"), F.floor(F.col("cy") / size).alias("row"))
    dx, dy = F.col("cx2") - F.col("cx"), F.abs(F.col("cy2") - F.col("cy"))
    aligned = (dy <= 0.55 * F.col("cap_height")) & (F.abs(F.col("h2") - F.col("h")) <= 0.8 * F.col("cap_height"))
    met = meet(own, other, [page, "row"]).where((F.col("label") != F.col("l2")) & (F.abs(dx) <= 8 * F.col("cap_height")))
    counts = met.groupBy(page, "label").agg(F.count_if(aligned & (dx < 0)).alias("_l"), F.count_if(aligned & (dx >= 0)).alias("_r"), F.count_if((dy <= 0.45 * F.col("cap_height")) & (dx < 0)).alias("_ll"), F.count_if((dy <= 0.45 * F.col("cap_height")) & (dx >= 0)).alias("_lr"), F.count_if(aligned).alias("_n"))
    one = lambda x: F.least(F.lit(1.0), x)
    tall, wide = F.col("h") / F.col("cap_height"), F.col("w") / F.col("cap_height")
    shape = F.when(tall.between(0.35, 1.45) & (wide <= 2.2), 1.0).when(tall.between(0.22, 1.7) & (wide <= 2.8), 0.55).otherwise(0.1)
    score = 0.28 * one(F.least("_l", "_r") / 2) + 0.30 * one(F.greatest("_l", "_r") / 3) + 0.17 * one(F.greatest("_ll", "_lr") / 4) + 0.10 * one(F.col("_n") / 5) + 0.15 * shape
    out = meet(rows, counts, [page, "label"], "left").na.fill(0, ["_l", "_r", "_ll", "_lr", "_n"])
    return out.withColumn("text_score", F.when(small, F.greatest(F.lit(0.0), one(score))).otherwise(0.0)).drop("_l", "_r", "_ll", "_lr", "_n", "cap_height")


def height_mode(components: DataFrame, keys: list[str], height: str = "h", support: str | None = "line_support", least: int = 4, page_height: str | None = None) -> DataFrame:
    """The mode of a weighted, smoothed histogram of heights by key: weights 1 + 3 support, taps 1 2 3 2 1 over 9, zeros
    beyond the ends, the smallest height of several, from ``least`` on, or from 0.35 % of ``page_height`` (a column) where that is more."""
    weight = 1 + 3 * F.coalesce(F.col(support), F.lit(0)) if support else F.lit(1)
    floor = F.greatest(F.lit(least), F.bround(F.max(page_height) * SCALE["dust"]).cast("int")) if page_height else F.max(F.lit(least))
    rows = components.where(F.col(height).isNotNull())
    sums = rows.groupBy(*keys, F.col(height).alias("h")).agg(F.sum(weight).alias("w"), floor.alias("_least"))
    taps = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(t).alias("t")) for d, t in ((-2, 1), (-1, 2), (0, 3), (1, 2), (2, 1))])
    spread = sums.select(*keys, "h", "w", "_least", F.explode(taps).alias("k")).select(*keys, (F.col("h") + F.col("k.d")).alias("h"), (F.col("w") * F.col("k.t")).alias("w"), "_least")
    smooth = spread.groupBy(*keys, "h").agg((F.sum("w") / 9).alias("smooth"), F.max("_least").alias("_least")).where(F.col("h") >= F.col("_least"))
    best = Window.partitionBy(*keys).orderBy(F.desc("smooth"), "h")
    return smooth.withColumn("_rn", F.row_number().over(best)).where("_rn = 1").select(*keys, F.col("h").alias("mode"), "smooth")


def scale_candidates(components: DataFrame, pages: DataFrame, page: str = "page_id") -> DataFrame:
    """Components that may be letters, with the size of their page; pages: page, width, height."""
    rows = components.join(pages.select(page, F.col("width").alias("page_width"), F.col("height").alias("page_height")), page)
    dust = F.greatest(F.lit(SCALE["least_dust"]), F.bround(F.col("page_height") * SCALE["dust"]).cast("int"))
    return rows.where((F.col("h") >= dust) & (F.col("h") <= SCALE["tall"] * F.col("page_height")) & (F.col("w") <= SCALE["wide"] * F.col("page_width")) & (F.col("area") >= SCALE["area"]))


def page_scale(components: DataFrame, pages: DataFrame, page: str = "page_id") -> DataFrame:
    """By page: cap_height (97th percentile of the heights around the mode), mode, candidates, band, problem (null, or too few candidates)."""
    found = line_support(scale_candidates(components, pages, page), page)
    modes = height_mode(found, [page], page_height="page_height").select(page, "mode")
    around = found.join(modes, page).where((F.col("h") >= SCALE["low"] * F.col("mode")) & (F.col("h") <= SCALE["high"] * F.col("mode")))
    held = F.col("line_support") >= SCALE["support"]
    heights = lambda c: F.percentile(F.when(c, F.col("h")), F.lit(SCALE["percentile"]))
    bands = around.groupBy(page, "mode").agg(F.count_if(held).alias("_n"), F.count("*").alias("_all"), heights(held).alias("_strict"), heights(F.lit(True)).alias("_loose"))
    strict = F.col("_n") >= SCALE["band"]
    counts = found.groupBy(page).agg(F.count("*").alias("candidates"))
    out = pages.select(page).join(counts, page, "left").join(bands, page, "left")
    few = F.coalesce("candidates", F.lit(0)) < SCALE["candidates"]
    return out.select(page, F.when(~few, F.when(strict, F.col("_strict")).otherwise(F.col("_loose"))).alias("cap_height"), F.when(~few, F.col("mode")).alias("mode"), F.coalesce("candidates", F.lit(0)).alias("candidates"), F.when(strict, F.col("_n")).otherwise(F.col("_all")).alias("band"), F.when(few, F.lit("few-candidates")).alias("problem"))


def robust_z(df: DataFrame, keys: list[str], feature: str, baseline: str | None = None, floor: float = 0.15) -> DataFrame:
    """Adds z: (x - median) / max(floor, 1.4826 MAD) by key; with ``baseline`` the statistics come from its rows only. Medians are exact."""
    base = df.where(baseline) if baseline else df
    middle = base.groupBy(*keys).agg(F.percentile(feature, F.lit(0.5)).alias("_m"))
    mad = base.join(middle, keys).groupBy(*keys).agg(F.percentile(F.abs(F.col(feature) - F.col("_m")), F.lit(0.5)).alias("_d"))
    stats = middle.join(mad, keys)
    return df.join(stats, keys, "left").withColumn("z", (F.col(feature) - F.col("_m")) / F.greatest(F.lit(floor), 1.4826 * F.col("_d"))).drop("_m", "_d")


def seeds(components: DataFrame, scale: DataFrame, page: str = "page_id") -> DataFrame:
    """Adds seed_score, is_seed and seed_problem (null, or few-baseline: the page has no model and no seed); scale: page, cap_height, stroke.

    The baseline is a page's text-like components, or where these are fewer than 30 all of their size.
    """
    rows = components.drop("seed_score").join(scale.select(page, "cap_height", "stroke"), page)
    size, H, S = F.greatest("w", "h"), F.col("cap_height"), F.col("stroke")
    log = lambda x: F.log(F.greatest(x, F.lit(BASELINE["smallest"])))
    features = {"f1": log(F.col("h") / H), "f2": log(size / H), "f3": log(F.col("area") / (H * S))}
    low = F.col("h") <= BASELINE["tall"] * H
    rows = rows.withColumns(features).withColumn("_text", (F.col("text_score") >= BASELINE["text"]) & low & (F.col("w") <= BASELINE["wide"] * H)).withColumn("_size", low & (size <= BASELINE["wide"] * H))
    counts = rows.groupBy(page).agg(F.count_if("_text").alias("_nt"), F.count_if("_size").alias("_ns"))
    enough = F.col("_nt") >= BASELINE["enough"]
    rows = rows.join(counts, page).withColumn("_base", F.when(enough, F.col("_text")).otherwise(F.col("_size"))).withColumn("seed_problem", F.when(~enough & (F.col("_ns") < BASELINE["least"]), F.lit("few-baseline")))
    for f in features:
        rows = robust_z(rows, [page], f, "_base").withColumnRenamed("z", f"z_{f}")
    rows = rows.withColumn("seed_score", F.when(F.col("seed_problem").isNull(), F.greatest("z_f1", "z_f2", "z_f3")))
    limit = rows.where("_base").groupBy(page).agg(F.greatest(F.lit(BASELINE["score"]), F.percentile("seed_score", F.lit(BASELINE["percentile"])) + BASELINE["above"]).alias("_t"))
    large = (size >= SEED_SIZE["extent"] * H) | (F.col("area") >= SEED_SIZE["area"] * H * S) | (F.col("h") >= SEED_SIZE["tall"] * H)
    out = rows.join(limit, page, "left").withColumn("is_seed", F.coalesce((F.col("seed_score") >= F.col("_t")) & (F.col("text_score") < BASELINE["most_text"]) & large, F.lit(False)))
    return out.drop("_base", "_text", "_size", "_nt", "_ns", "_t", "f1", "f2", "f3", "z_f1", "z_f2", "z_f3", "cap_height", "stroke")


def both_ways(edges: DataFrame, page: str = "page_id") -> DataFrame:
    """Every edge from a to b and from b to a, as src and dst; the edges are computed once."""
    way = lambda src, dst: F.struct(F.col(src).alias("src"), F.col(dst).alias("dst"))
    rest = [c for c in edges.columns if c not in (page, "a", "b")]
    return edges.withColumn("_way", F.explode(F.array(way("a", "b"), way("b", "a")))).select(page, "_way.*", *rest)


def directed_costs(edges: DataFrame, components: DataFrame, scale: DataFrame, text_penalty: float = 5.0, page: str = "page_id") -> DataFrame:
    """Both directions of every edge with the cost of stepping to ``dst``: geometry, the target's text score, a charge for specks."""
    both = both_ways(edges, page)
    target = components.select(page, F.col("label").alias("dst"), "area", "w", "h", "text_score")
    j = meet(both, target, [page, "dst"]).join(scale.select(page, "cap_height", "stroke"), page)
    axis = F.least(F.lit(1.0), F.greatest("x_overlap_ratio", "y_overlap_ratio"))
    geometry = F.col("gap") / F.greatest("stroke", F.lit(1.0)) * F.when((F.col("dx") == 0) | (F.col("dy") == 0), 0.62).otherwise(1.0) * (1 - 0.3 * axis)
    speck = F.when((F.col("area") < 0.35 * F.col("cap_height") * F.col("stroke")) & (F.greatest("w", "h") < 1.2 * F.col("cap_height")), 1.25).otherwise(0.0)
    return j.select(page, "src", "dst", (0.38 * geometry + text_penalty * F.col("text_score") + speck).alias("cost"))


def grow(costs: DataFrame, sources: DataFrame, budget: float, page: str = "page_id", tolerance: float = 1e-9, most_rounds: int = 200) -> DataFrame:
    """For every component within the budget of a source: dist and owner. Of equal distances the smaller owner wins.

    Rounds of relaxation: only components whose value changed send it on; each round is written to the shared folder.
    """
    costs = materialize(costs.select(page, "src", "dst", "cost"), "costs")  # every round joins them
    best = materialize(sources.select(page, F.col("label").alias("node"), F.lit(0.0).alias("dist"), F.col("label").alias("owner")), "grow")
    front = best
    for _ in range(most_rounds):
        sent = meet(front.withColumnRenamed("node", "src"), costs, [page, "src"]).select(page, F.col("dst").alias("node"), (F.col("dist") + F.col("cost")).alias("dist"), "owner").where(F.col("dist") <= budget)
        # distances within the tolerance are one: they are compared on a grid of it
        key = F.struct(F.round(F.col("dist") / tolerance).alias("g"), "owner", "dist")
        merged = best.unionByName(sent).groupBy(page, "node").agg(F.min(key).alias("k")).select(page, "node", F.col("k.dist").alias("dist"), F.col("k.owner").alias("owner"))
        old = best.select(page, "node", F.col("dist").alias("_d"), F.col("owner").alias("_o"))
        now = materialize(meet(merged, old, [page, "node"], "left").withColumn("_new", F.col("_d").isNull() | (F.abs(F.col("dist") - F.col("_d")) > tolerance) | (F.col("owner") != F.col("_o"))).drop("_d", "_o"), "grow")
        best, front = now.drop("_new"), now.where("_new").drop("_new")
        if front.isEmpty():
            return best
    raise RuntimeError("growth did not settle")


def region_stats(owned: DataFrame, components: DataFrame, page: str = "page_id") -> DataFrame:
    """By owner: box, area, extent and the share of text in it."""
    j = meet(owned.select(page, F.col("node").alias("label"), "owner"), with_box(components), [page, "label"])
    out = j.groupBy(page, "owner").agg(F.min("box.x1").alias("x1"), F.min("box.y1").alias("y1"), F.max("box.x2").alias("x2"), F.max("box.y2").alias("y2"), F.sum("area").alias("area"), (F.sum(F.col("area") * F.col("text_score")) / F.greatest(F.lit(1), F.sum("area"))).alias("text_area_fraction"), F.array_sort(F.collect_list("label")).alias("labels"))
    return out.withColumn("extent", F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))


def region_links(owned: DataFrame, edges: DataFrame, regions: DataFrame, scale: DataFrame, page: str = "page_id") -> DataFrame:
    """Pairs of regions joined by edges: least gap, best axis overlap, close edges (0.75 H and less), area ratio."""
    of = owned.select(page, F.col("node").alias("a"), F.col("owner").alias("ra"))
    ob = owned.select(page, F.col("node").alias("b"), F.col("owner").alias("rb"))
    j = meet(meet(edges, of, [page, "a"]), ob, [page, "b"]).where("ra <> rb").join(scale.select(page, "cap_height"), page)
    axis = F.greatest("x_overlap_ratio", "y_overlap_ratio")
    pairs = j.groupBy(page, F.least("ra", "rb").alias("r1"), F.greatest("ra", "rb").alias("r2"), "cap_height").agg(F.min("gap").alias("gap"), F.max(axis).alias("axis"), F.count_if(F.col("gap") <= 0.75 * F.col("cap_height")).alias("close"))
    one, two = (regions.select(page, F.col("owner").alias(r), F.col("area").alias(f"area_{r}")) for r in ("r1", "r2"))
    out = meet(meet(pairs, one, [page, "r1"]), two, [page, "r2"])
    return out.withColumn("area_ratio", F.least("area_r1", "area_r2") / F.greatest(F.lit(1), F.greatest("area_r1", "area_r2"))).drop("area_r1", "area_r2")


def may_group(H: float, gap: float, axis: float, close: int, area_ratio: float) -> bool:
    """Whether the edges between two regions make them one figure; regions whose boxes merely overlap have no edge and an infinite gap."""
    return any(area_ratio <= most_ratio and gap <= most_gap * H and (axis >= least_axis or close >= least_close) for most_ratio, most_gap, least_axis, least_close in GROUPING)


def agglomerate(links: DataFrame, regions: DataFrame, page: str = "page_id") -> DataFrame:
    """(page, owner, family): regions merged greedily, best score first, until nothing may merge.

    After a merge the pair's evidence is joined: least gap, best axis, summed close edges, summed areas. Order matters, so this is
    not connected components; a page's regions are one Arrow group.
    """

    def merge(key: tuple, nodes: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        family = {r: r for r in nodes["owner"]}
        areas = dict(zip(nodes["owner"], nodes["area"], strict=True))
        evidence = {(r.r1, r.r2): (r.gap, r.axis, r.close) for r in pairs.itertuples()}
        H = float(pairs["cap_height"].iloc[0]) if len(pairs) else 1.0
        while True:
            ready = []
            for (a, b), (gap, axis, close) in evidence.items():
                ratio = min(areas[a], areas[b]) / max(1, max(areas[a], areas[b]))
                if may_group(H, gap, axis, close, ratio):
                    ready.append((gap / max(H, 1) - 0.1 * close, a, b))
            if not ready:
                break
            _, a, b = min(ready)
            areas[a] += areas.pop(b)
            family = {r: a if f == b else f for r, f in family.items()}
            joined: dict = {}
            for (p, q), (gap, axis, close) in evidence.items():
                p, q = sorted((a if p == b else p, a if q == b else q))
                if p != q:
                    g, x, c = joined.get((p, q), (math.inf, 0.0, 0))
                    joined[p, q] = (min(g, gap), max(x, axis), c + close)
            evidence = joined
        return pd.DataFrame({page: [key[0]] * len(family), "owner": list(family), "family": list(family.values())})

    kind = dict(regions.dtypes)
    return regions.select(page, "owner", "area").groupBy(page).cogroup(links.groupBy(page)).applyInPandas(merge, f"{page} {kind[page]}, owner {kind['owner']}, family {kind['owner']}")


def accepted(regions: DataFrame, scale: DataFrame, pages: DataFrame, page: str = "page_id") -> DataFrame:
    """Regions that are no edge columns, slivers, text or specks, numbered from the top; scale: page, cap_height; pages: page, width, height."""
    j = regions.join(scale.select(page, "cap_height"), page).join(pages.select(page, "width", "height"), page)
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    short, long = F.least(w, h), F.greatest(w, h)
    edge = (F.col("x1") <= 2) | (F.col("y1") <= 2) | (F.col("x2") >= F.col("width") - 2) | (F.col("y2") >= F.col("height") - 2)
    H = F.col("cap_height")
    bad = (edge & (short <= 3 * H) & (long >= 8 * H)) | (edge & (short <= 0.22 * H) & (long >= 4 * H)) | (F.col("text_area_fraction") >= 0.52) | ~((F.col("area") >= 2.5 * H * H) | (long >= 5 * H))
    order = Window.partitionBy(page).orderBy("y1", "x1", "owner")
    return j.where(~bad).withColumn("asset_index", F.row_number().over(order)).drop("cap_height", "width", "height")


def support_costs(edges: DataFrame, components: DataFrame, scale: DataFrame, text_penalty: float = 5.8, page: str = "page_id") -> DataFrame:
    """Costs of the second growth, from core components to what may be drawn with them."""
    both = both_ways(edges, page)
    j = meet(both, components.select(page, F.col("label").alias("dst"), "area", "w", "h", "text_score"), [page, "dst"]).join(scale.select(page, "cap_height", "stroke"), page)
    axis = F.least(F.lit(1.0), F.greatest("x_overlap_ratio", "y_overlap_ratio"))
    speck = F.when((F.col("area") < 0.25 * F.col("cap_height") * F.col("stroke")) & (F.greatest("w", "h") < F.col("cap_height")), 0.6).otherwise(0.0)
    return j.select(page, "src", "dst", (0.42 * F.col("gap") / F.greatest("stroke", F.lit(1.0)) * (1 - 0.35 * axis) + text_penalty * F.col("text_score") + speck).alias("cost"))


def core(components: DataFrame, members: DataFrame, scale: DataFrame, page: str = "page_id") -> DataFrame:
    """(page, owner, label): components of each region from which its support grows: its seeds, large members with little
    text, high scores with less; where there is none the seed with the highest score. members: page, owner, label."""
    j = meet(members.select(page, "owner", "label"), components, [page, "label"]).join(scale.select(page, "cap_height", "stroke"), page)
    strong = (F.col("seed_score") >= SUPPORT["score"]) & (F.col("text_score") <= SUPPORT["strong_text"])
    j = j.withColumn("_core", F.coalesce(F.col("is_seed") | (_large() & (F.col("text_score") <= SUPPORT["core_text"])) | strong, F.lit(False)))
    rank = Window.partitionBy(page, "owner").orderBy(F.desc("_core"), F.desc_nulls_last("seed_score"), "label")
    return j.withColumn("_rn", F.row_number().over(rank)).where("_core OR _rn = 1").select(page, "owner", "label")


def _large() -> Column:
    return (F.greatest("w", "h") >= SUPPORT["extent"] * F.col("cap_height")) | (F.col("area") >= SUPPORT["area"] * F.col("cap_height") * F.col("stroke"))


def support(components: DataFrame, edges: DataFrame, members: DataFrame, scale: DataFrame, budget: float = 4.6, text_penalty: float = 5.8, page: str = "page_id") -> DataFrame:
    """(page, owner, label, dist, is_core, verdict): what each region's support reaches within the budget, along edges between its own members.

    The verdict is keep, rejected-text (a letter beside the drawing) or passed (neither): core, large and strong components
    and those with little text are kept.
    """
    region = F.concat_ws("\x1f", F.col(page).cast("string"), F.col("owner").cast("string"))
    own = members.select(page, "owner", "label", region.alias("_region"))
    costs = support_costs(edges, components, scale, text_penalty, page)
    within = meet(meet(costs, own.select(page, F.col("label").alias("src"), "_region"), [page, "src"]), own.select(page, F.col("label").alias("dst"), F.col("_region").alias("_r2")), [page, "dst"]).where("_region = _r2").select("_region", "src", "dst", "cost")
    start = materialize(core(components, members, scale, page), "core")
    reached = grow(within, start.select(region.alias("_region"), "label"), budget, "_region").select("_region", F.col("node").alias("label"), "dist")
    j = meet(meet(own, reached, ["_region", "label"]), components.select(page, "label", "w", "h", "area", "text_score", "seed_score"), [page, "label"]).join(scale.select(page, "cap_height", "stroke"), page)
    j = meet(j, start.withColumn("_c", F.lit(True)), [page, "owner", "label"], "left").withColumn("is_core", F.col("_c").isNotNull())
    H, strong = F.col("cap_height"), F.coalesce(F.col("seed_score") >= SUPPORT["score"], F.lit(False))
    letter = F.col("h").between(SUPPORT["glyph_low"] * H, SUPPORT["glyph_high"] * H) & (F.col("w") <= SUPPORT["glyph_wide"] * H) & (F.col("area") <= SUPPORT["glyph_area"] * H * H) & (F.col("text_score") >= SUPPORT["glyph_text"])
    verdict = F.when(~F.col("is_core") & letter & ~strong, "rejected-text").when(F.col("is_core") | (F.col("text_score") <= SUPPORT["kept_text"]) | _large() | strong, "keep").otherwise("passed")
    return j.select(page, "owner", "label", "dist", "is_core", verdict.alias("verdict"))
