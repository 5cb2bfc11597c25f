"""Queries of page layout: boxes, text rows, regions and their support, each beside its DuckDB SQL.

Parts are components: a hundred a page, spread over 700 by 700 pixels. Scores are multiples of 1/16, so that sums are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import geometry as G
from quire.operators import graph
from quire.plans.registry import query, table

_C = """c AS (SELECT p_partkey // 100 AS page_id, CAST(p_partkey AS INT) AS label, CAST(p_partkey * 37 % 700 AS INT) AS x, CAST(p_partkey * 91 % 700 AS INT) AS y, CAST(5 + p_size % 20 AS INT) AS w, CAST(5 + p_size * 7 % 30 AS INT) AS h,
CAST((5 + p_size % 20) * (5 + p_size * 7 % 30) AS INT) AS area, p_partkey * 37 % 700 + (5 + p_size % 20) / 2.0 AS cx, p_partkey * 91 % 700 + (5 + p_size * 7 % 30) / 2.0 AS cy, (p_size % 16) / 16.0 AS text_score, (p_size % 9) / 2.0 AS seed_score, p_size = 17 AS is_seed FROM part)"""
_N = f"""{_C}, n AS (SELECT page_id, a.label AS a, b.label AS b, sqrt(CAST(pow(greatest(0, a.x - b.x - b.w, b.x - a.x - a.w), 2) + pow(greatest(0, a.y - b.y - b.h, b.y - a.y - a.h), 2) AS DOUBLE)) AS gap, greatest(0, a.x - b.x - b.w, b.x - a.x - a.w) AS dx, greatest(0, a.y - b.y - b.h, b.y - a.y - a.h) AS dy,
greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) / least(a.w, b.w) AS xr, greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) / least(a.h, b.h) AS yr FROM c a JOIN c b USING (page_id) WHERE a.label < b.label),
e AS (SELECT * FROM n WHERE dx * dx + dy * dy <= 1600), d AS (SELECT page_id, a AS src, b AS dst, gap, dx, dy, xr, yr FROM e UNION ALL SELECT page_id, b, a, gap, dx, dy, xr, yr FROM e)"""
H, S = 20.0, 3.0


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k, size = F.col, F.col("p_partkey"), F.col("p_size")
    rows = table(spark, sf_dir, "part").select(F.floor(k / 100).alias("page_id"), k.cast("int").alias("label"), (k * 37 % 700).cast("int").alias("x"), (k * 91 % 700).cast("int").alias("y"), (5 + size % 20).cast("int").alias("w"), (5 + size * 7 % 30).cast("int").alias("h"), ((size % 16) / 16.0).alias("text_score"), ((size % 9) / 2.0).alias("seed_score"), (size == 17).alias("is_seed"))
    return rows.withColumn("area", c("w") * c("h")).withColumn("cx", c("x") + c("w") / 2.0).withColumn("cy", c("y") + c("h") / 2.0)


def _scale(parts: DataFrame) -> DataFrame:
    return parts.select("page_id").distinct().select("page_id", F.lit(H).alias("cap_height"), F.lit(S).alias("stroke"))


_MET = f"""{_C}, s AS (SELECT * FROM c WHERE h <= 38 AND w <= 60 AND area <= 2000), m AS (SELECT a.page_id, a.label, b.cx - a.cx AS dx, abs(b.cy - a.cy) AS dy, abs(b.h - a.h) <= 16 AS alike FROM s a JOIN s b ON a.page_id = b.page_id AND a.label <> b.label WHERE abs(b.cx - a.cx) <= 160),
k AS (SELECT page_id, label, count(*) FILTER (dy <= 11 AND alike AND dx < 0) AS l, count(*) FILTER (dy <= 11 AND alike AND dx >= 0) AS r, count(*) FILTER (dy <= 9 AND dx < 0) AS ll, count(*) FILTER (dy <= 9 AND dx >= 0) AS lr, count(*) FILTER (dy <= 11 AND alike) AS n FROM m GROUP BY page_id, label)"""


@query(f"""WITH {_MET}, v AS (SELECT c.label, c.h <= 38 AND c.w <= 60 AND c.area <= 2000 AS small, coalesce(l, 0) AS l, coalesce(r, 0) AS r, coalesce(ll, 0) AS ll, coalesce(lr, 0) AS lr, coalesce(n, 0) AS n,
CASE WHEN h / 20.0 BETWEEN 0.35 AND 1.45 AND w / 20.0 <= 2.2 THEN 1.0 WHEN h / 20.0 BETWEEN 0.22 AND 1.7 AND w / 20.0 <= 2.8 THEN 0.55 ELSE 0.1 END AS shape FROM c LEFT JOIN k USING (page_id, label))
SELECT label, CASE WHEN small THEN round(least(1.0, 0.28 * least(1.0, least(l, r) / 2) + 0.30 * least(1.0, greatest(l, r) / 3) + 0.17 * least(1.0, greatest(ll, lr) / 4) + 0.10 * least(1.0, n / 5) + 0.15 * shape), 6) ELSE 0.0 END AS text_score FROM v""")
def text_rows(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    return graph.text_scores(parts, _scale(parts)).select("label", F.round("text_score", 6).alias("text_score"))


@query(f"""WITH {_C}, m AS (SELECT a.page_id, a.label, b.cx - a.cx AS dx FROM c a JOIN c b ON a.page_id = b.page_id AND a.label <> b.label WHERE abs(b.cy - a.cy) <= greatest(2.0, 0.5 * a.h) AND abs(b.h - a.h) <= greatest(2.0, 0.45 * a.h) AND abs(b.cx - a.cx) <= 6 * a.h),
k AS (SELECT page_id, label, count(*) FILTER (dx < 0) AS l, count(*) FILTER (dx >= 0) AS r FROM m GROUP BY ALL)
SELECT label, round(least(1.0, 0.65 * least(1.0, greatest(coalesce(l, 0), coalesce(r, 0)) / 3) + 0.35 * least(1.0, least(coalesce(l, 0), coalesce(r, 0)) / 2)), 6) AS line_support FROM c LEFT JOIN k USING (page_id, label)""")
def line_rows(spark, sf_dir):
    return graph.line_support(_parts(spark, sf_dir)).select("label", F.round("line_support", 6).alias("line_support"))


@query(f"""WITH {_N} SELECT d.page_id, src, dst, round(0.38 * (gap / 3.0 * CASE WHEN dx = 0 OR dy = 0 THEN 0.62 ELSE 1.0 END * (1 - 0.3 * least(1.0, greatest(xr, yr)))) + 5.0 * text_score + CASE WHEN area < 21.0 AND greatest(w, h) < 24 THEN 1.25 ELSE 0.0 END, 6) AS cost
FROM d JOIN c ON c.page_id = d.page_id AND c.label = dst""")
def growth_costs(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    costs = graph.directed_costs(graph.neighbours(parts, 40), parts, _scale(parts))
    return costs.select("page_id", "src", "dst", F.round("cost", 6).alias("cost"))


_REGIONS = "o AS (SELECT page_id, label, label // 10 * 10 AS owner FROM c)"


def _owned(parts: DataFrame) -> DataFrame:
    return parts.select("page_id", F.col("label").alias("node"), (F.floor(F.col("label") / 10) * 10).cast("int").alias("owner"))


@query(f"""WITH {_C}, {_REGIONS} SELECT page_id, owner, min(x) AS x1, min(y) AS y1, max(x + w) AS x2, max(y + h) AS y2, CAST(sum(area) AS BIGINT) AS area, sum(area * text_score) / greatest(1, sum(area)) AS text_area_fraction, string_agg(CAST(label AS VARCHAR), ',' ORDER BY label) AS labels,
CAST(greatest(max(x + w) - min(x), max(y + h) - min(y)) AS BIGINT) AS extent FROM c JOIN o USING (page_id, label) GROUP BY page_id, owner""")
def region_table(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    out = graph.region_stats(_owned(parts), parts)
    return out.withColumn("labels", F.array_join(F.col("labels").cast("array<string>"), ",")).withColumn("extent", F.col("extent").cast("long"))


@query(f"""WITH {_N}, {_REGIONS}, g AS (SELECT page_id, owner, sum(area) AS area FROM c JOIN o USING (page_id, label) GROUP BY ALL),
p AS (SELECT e.page_id, least(p.owner, q.owner) AS r1, greatest(p.owner, q.owner) AS r2, min(gap) AS gap, max(greatest(xr, yr)) AS axis, count(*) FILTER (gap <= 15) AS close FROM e JOIN o p ON p.page_id = e.page_id AND p.label = e.a JOIN o q ON q.page_id = e.page_id AND q.label = e.b WHERE p.owner <> q.owner GROUP BY ALL)
SELECT p.page_id, r1, r2, round(gap, 6) AS gap, axis, close, least(x.area, y.area) / greatest(1, greatest(x.area, y.area)) AS area_ratio FROM p JOIN g x ON x.page_id = p.page_id AND x.owner = r1 JOIN g y ON y.page_id = p.page_id AND y.owner = r2""")
def region_evidence(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    owned = _owned(parts)
    out = graph.region_links(owned, graph.neighbours(parts, 40), graph.region_stats(owned, parts), _scale(parts))
    return out.drop("cap_height").withColumn("gap", F.round("gap", 6))


@query(f"""WITH {_C}, {_REGIONS}, r AS (SELECT page_id, owner, min(x) AS x1, min(y) AS y1, max(x + w) AS x2, max(y + h) AS y2, sum(area) AS area, sum(area * text_score) / greatest(1, sum(area)) AS t FROM c JOIN o USING (page_id, label) GROUP BY page_id, owner),
k AS (SELECT *, x1 <= 2 OR y1 <= 2 OR x2 >= 718 OR y2 >= 718 AS edge, least(x2 - x1, y2 - y1) AS short, greatest(x2 - x1, y2 - y1) AS long FROM r)
SELECT page_id, owner, CAST(row_number() OVER (PARTITION BY page_id ORDER BY y1, x1, owner) AS INT) AS asset_index FROM k WHERE NOT ((edge AND short <= 60 AND long >= 160) OR (edge AND short <= 4.4 AND long >= 80) OR t >= 0.52 OR NOT (area >= 1000 OR long >= 100))""")
def accepted_regions(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    pages = parts.select("page_id").distinct().select("page_id", F.lit(720).alias("width"), F.lit(720).alias("height"))
    return graph.accepted(graph.region_stats(_owned(parts), parts), _scale(parts), pages).select("page_id", "owner", "asset_index")


_CORE = f"""{_REGIONS}, z AS (SELECT page_id, owner, label, is_seed OR ((greatest(w, h) >= 36 OR area >= 270) AND text_score <= 0.58) OR (seed_score >= 3.5 AND text_score <= 0.48) AS core, seed_score FROM c JOIN o USING (page_id, label)),
q AS (SELECT *, row_number() OVER (PARTITION BY page_id, owner ORDER BY core DESC, seed_score DESC, label) AS rn FROM z), k AS (SELECT page_id, owner, label FROM q WHERE core OR rn = 1)"""


@query(f"WITH {_C}, {_CORE} SELECT page_id, owner, label FROM k")
def core_components(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    return graph.core(parts, _owned(parts).withColumnRenamed("node", "label"), _scale(parts))


@query(f"""WITH RECURSIVE {_N}, {_CORE}, t AS (SELECT d.page_id, p.owner, src, dst, 0.42 * gap / 3.0 * (1 - 0.35 * least(1.0, greatest(xr, yr))) + 5.8 * text_score + CASE WHEN area < 15 AND greatest(w, h) < 20 THEN 0.6 ELSE 0.0 END AS cost
FROM d JOIN o p ON p.page_id = d.page_id AND p.label = src JOIN o q ON q.page_id = d.page_id AND q.label = dst AND q.owner = p.owner JOIN c ON c.page_id = d.page_id AND c.label = dst),
g(page_id, owner, node, dist) AS (SELECT page_id, owner, label, 0.0::DOUBLE FROM k UNION SELECT g.page_id, g.owner, t.dst, g.dist + t.cost FROM g JOIN t ON t.page_id = g.page_id AND t.src = g.node WHERE g.dist + t.cost <= 4.6),
r AS (SELECT page_id, owner, node AS label, min(dist) AS dist FROM g GROUP BY ALL), v AS (SELECT r.*, k.label IS NOT NULL AS is_core, c.*, greatest(w, h) >= 36 OR area >= 270 AS large, seed_score >= 3.5 AS strong FROM r JOIN c ON c.page_id = r.page_id AND c.label = r.label LEFT JOIN k ON k.page_id = r.page_id AND k.owner = r.owner AND k.label = r.label)
SELECT page_id, owner, label, round(dist, 6) AS dist, is_core, CASE WHEN NOT is_core AND h BETWEEN 10 AND 30 AND w <= 31 AND area <= 1120 AND text_score >= 0.48 AND NOT strong THEN 'rejected-text' WHEN is_core OR text_score <= 0.42 OR large OR strong THEN 'keep' ELSE 'passed' END AS verdict FROM v""".replace("c.*, greatest", "c.w, c.h, c.area, c.text_score, c.seed_score, greatest"))
def region_support(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    out = graph.support(parts, graph.neighbours(parts, 40), _owned(parts).withColumnRenamed("node", "label"), _scale(parts))
    return out.withColumn("dist", F.round("dist", 6))


@query(f"""WITH {_C}, s AS (SELECT label, x, y, w, h, least((595.0 - 40.0) / 700, (842.0 - 40.0) / 900) AS k FROM c) SELECT label, round((595.0 - 700 * k) / 2 + x * k, 6) AS x1, round((842.0 - 900 * k) / 2 + (900 - (y + h)) * k, 6) AS y1, x >= 0 AND y >= 0 AND x + w <= 600 AND y + h <= 650 AS inside,
CAST(round_even(x / 700.0 * 333, 0) AS INT) AS crop_x, CAST(round_even((y + h) / 900.0 * 555, 0) AS INT) AS crop_y FROM s""")
def page_mapping(spark, sf_dir):
    c = F.col
    b = G.box(c("x"), c("y"), c("x") + c("w"), c("y") + c("h"))
    points = G.to_points(b, F.lit(700), F.lit(900), 595.0, 842.0, 20.0)
    cut = G.crop(G.box(c("x") / 700.0, c("y") / 900.0, (c("x") + c("w")) / 700.0, (c("y") + c("h")) / 900.0), F.lit(333), F.lit(555))
    return _parts(spark, sf_dir).select("label", F.round(points["x1"], 6).alias("x1"), F.round(points["y1"], 6).alias("y1"), G.in_page(b, F.lit(600), F.lit(650)).alias("inside"), cut["x1"].alias("crop_x"), cut["y2"].alias("crop_y"))
