"""Queries of books, layers, editions, sinks and validation, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import book, census, coverage, figures, flow, score, validate
from quire.plans.registry import query, table
from quire.sources import sinks


@query("SELECT doc_id, sha256(upper(source)) AS sha, 'normalized' AS edition FROM documents UNION ALL SELECT doc_id, sha256(text), 'diplomatic' FROM documents")
def edition_layers(spark, sf_dir):
    pages = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("diplomatic_text"), F.upper("source").alias("normalized_text"))
    one = lambda e: book.edition_text(pages, e).select("doc_id", F.sha2("text", 256).alias("sha"), F.lit(e).alias("edition"))
    return one("normalized").unionByName(one("diplomatic"))


def _texts_and_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d, c = table(spark, sf_dir, "documents"), F.col
    texts = d.select(c("doc_id").cast("string").alias("id"), c("n_chars").alias("physical_index"), F.sha2("text", 256).alias("source_sha256"), "source", "lang", "text")
    there = d.where("source <> 'src3'").select(c("doc_id").cast("string").alias("id"), F.when(c("source") == "src4", c("n_chars") + 1).otherwise(c("n_chars")).alias("physical_index"), F.when(c("source") == "src5", "?").otherwise(F.sha2("text", 256)).alias("sha256"), F.lit(750).alias("width"), F.lit(1200).alias("height"), F.lit(1).alias("printed_page"))
    return texts, there


@query("SELECT CAST(doc_id AS VARCHAR) AS id, CASE source WHEN 'src3' THEN 'no-source' WHEN 'src4' THEN 'physical-index' WHEN 'src5' THEN 'source-hash' END AS problem FROM documents")
def source_join(spark, sf_dir):
    return book.joined_sources(*_texts_and_sources(spark, sf_dir)).select("id", "problem")


_THREE = """l AS (SELECT 'quality' AS engine, doc_id, CAST(quality AS VARCHAR) AS v FROM labels UNION ALL SELECT 'toxic', doc_id, CAST(toxic AS VARCHAR) FROM labels WHERE quality = 1 UNION ALL SELECT 'page', page_id, url FROM pages),
w AS (SELECT d.doc_id, max(v) FILTER (engine = 'quality') AS quality, max(v) FILTER (engine = 'toxic') AS toxic, max(v) FILTER (engine = 'page') AS page FROM documents d LEFT JOIN l USING (doc_id) GROUP BY d.doc_id)"""


def _three_layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    labels = table(spark, sf_dir, "labels")
    one = lambda df, name, key, v: df.select(F.lit(name).alias("engine"), F.col(key).alias("doc_id"), F.col(v).cast("string").alias("text"))
    layers = one(labels, "quality", "doc_id", "quality").unionByName(one(labels.where("quality = 1"), "toxic", "doc_id", "toxic")).unionByName(one(table(spark, sf_dir, "pages"), "page", "page_id", "url"))
    return coverage.with_layers(table(spark, sf_dir, "documents").select("doc_id"), layers, ["quality", "toxic", "page"], key="doc_id")


@query(f"WITH {_THREE} SELECT * FROM w WHERE quality IS NOT NULL AND toxic IS NOT NULL AND page IS NOT NULL")
def layers_joined(spark, sf_dir):
    return _three_layers(spark, sf_dir)[0]


@query(f"WITH {_THREE} SELECT 'missing-layer' AS rule, CAST(doc_id AS VARCHAR) AS key, detail FROM (SELECT doc_id, unnest(list_filter([CASE WHEN quality IS NULL THEN 'quality' END, CASE WHEN toxic IS NULL THEN 'toxic' END, CASE WHEN page IS NULL THEN 'page' END], lambda x: x IS NOT NULL)) AS detail FROM w)")
def layers_lacking(spark, sf_dir):
    return _three_layers(spark, sf_dir)[1]


@query(f"WITH {_THREE}, m AS (SELECT 'page' AS engine, doc_id FROM w WHERE page IS NULL UNION ALL SELECT 'quality', doc_id FROM w WHERE quality IS NULL UNION ALL SELECT 'toxic', doc_id FROM w WHERE toxic IS NULL), r AS (SELECT *, row_number() OVER (PARTITION BY engine ORDER BY doc_id) AS rn FROM m) SELECT engine, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS first FROM r WHERE rn <= 20 GROUP BY engine")
def missing_preview(spark, sf_dir):
    """The report's first twenty of each layer: the limit is the feature."""
    lacking = _three_layers(spark, sf_dir)[1].select(F.col("detail").alias("engine"), F.col("key").cast("long").alias("doc_id"))
    return coverage.preview(lacking, "engine", "doc_id").select("engine", F.array_join(F.col("first").cast("array<string>"), ",").alias("first"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS page_id FROM orders WHERE o_orderkey NOT IN (SELECT doc_id FROM documents)")
def unknown_pages(spark, sf_dir):
    """Pages of figures that the book lacks."""
    named = lambda df, c: df.select(F.col(c).cast("string").alias("page_id"))
    return coverage.missing(named(table(spark, sf_dir, "orders"), "o_orderkey"), named(table(spark, sf_dir, "documents"), "doc_id"), ["page_id"])


# --- census

_CENSUS_TEXT = "concat(CASE WHEN p_size % 5 = 0 THEN 'Таб. IV' || chr(10) ELSE '' END, CASE WHEN p_size > 30 THEN concat(p_size, ' ФИГ.', chr(10)) ELSE '' END, p_name, ' ', p_size, ' фиг.')"


@query(f"""WITH p AS (SELECT *, {_CENSUS_TEXT} AS t, CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE p_size % 4 END AS n FROM part)
SELECT count(*) AS pages, count(*) FILTER (n > 0) AS with_assets, count(*) FILTER (p_size > 30) AS with_captions, count(*) FILTER (p_size % 5 = 0 OR p_type = 'PROMO') AS atlas FROM p""")
def census_totals(spark, sf_dir):
    part, c = table(spark, sf_dir, "part"), F.col
    asset = "transform(filter(sequence(0, {0}), i -> i > 0), i -> named_struct('asset_index', i, 'bbox_area_fraction', 0.01D, 'aspect_ratio_long_over_short', 2D, 'touches_page_edge_1pct', false))"
    probe = part.select(c("p_partkey").alias("id"), c("p_partkey").alias("physical_index"), F.lit("normal-text-candidate").alias("page_class"), F.expr(asset.format("p_size % 4")).alias("assets"))
    texts = part.select(c("p_partkey").alias("id"), F.lit("body").alias("page_type"), F.expr(_CENSUS_TEXT).alias("text"), F.array(F.when(c("p_type") == "PROMO", "Лист чертежей").otherwise("x")).alias("notes"))
    metrics = part.where("p_partkey % 7 = 0").select(c("p_partkey").alias("id"), F.lit("normal-text-candidate").alias("page_class"), F.expr(asset.format("0")).alias("assets"))
    return census.page_totals(census.census(probe, texts, metrics))


@query("SELECT CAST(n AS BIGINT) AS detected_asset_count, count(*) AS pages FROM (SELECT p_size % 6 AS n FROM part) GROUP BY n")
def asset_histogram(spark, sf_dir):
    return census.asset_histogram(table(spark, sf_dir, "part").select((F.col("p_size") % 6).cast("long").alias("detected_asset_count")))


@query("""SELECT p_partkey, p_size > 40 OR p_type = 'PROMO' AS numbered, CASE WHEN p_size / 50.0 > 0.75 THEN 'unsupported-dark-fulltone' WHEN p_retailprice < 1000 AND p_size < 10 THEN 'unsupported-near-blank' ELSE 'normal-text-candidate' END AS class,
contains(p_name, 'ring') OR p_size = 9 AS failed FROM part""")
def page_predicates(spark, sf_dir):
    c = F.col
    captions, notes = F.when(c("p_size") > 40, F.array(c("p_size"))).otherwise(F.expr("cast(array() as array<int>)")), F.array(F.when(c("p_type") == "PROMO", "Подпись под фигурой").otherwise("фигура"))
    dark = F.when(c("p_size") / 50.0 > 0.75, 0.8).otherwise(0.1)
    blank = (c("p_retailprice") < 1000) & (c("p_size") < 10)
    stdout = F.when(F.contains("p_name", F.lit("ring")), F.concat(F.lit("x "), F.lit("Failed processing"), F.lit(" y")))
    stderr = F.when(c("p_size") == 9, "Traceback (most recent call last)")
    return table(spark, sf_dir, "part").select("p_partkey", census.numbered_page(captions, notes).alias("numbered"), census.page_class(dark, F.when(blank, 1.0).otherwise(9.0), F.when(blank, 0.99).otherwise(0.5)).alias("class"), score.internal_error(stdout, stderr).alias("failed"))


@query("""WITH o AS (SELECT l_orderkey, count(*) AS n, bool_or(l_returnflag = 'R') AS manual, bool_or(l_linestatus = 'F' AND l_linenumber = 7) AS review FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, true AS every, n IS NOT NULL AS figures, coalesce(manual OR review, false) AS doubtful FROM orders LEFT JOIN o ON l_orderkey = o_orderkey""")
def review_modes(spark, sf_dir):
    c = F.col
    figs = table(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("o_orderkey"), c("l_linenumber").alias("n"), F.array(F.when(c("l_returnflag") == "R", "manual").otherwise("automatic")).alias("classes"), ((c("l_linestatus") == "F") & (c("l_linenumber") == 7)).alias("requires_visual_placement_review"))
    pages = book.nested(table(spark, sf_dir, "orders").select("o_orderkey"), figs, "o_orderkey", ["n"], "figures")
    modes = census.review_mode(c("figures"))
    return pages.select("o_orderkey", modes["all"].alias("every"), modes["figures"].alias("figures"), modes["doubtful"].alias("doubtful"))


# --- figures

_RESTORED = "SELECT CAST(p_partkey AS VARCHAR) AS label FROM part WHERE p_brand = 'Brand#3' OR (p_size = 11 AND p_partkey % 2 = 0)"


def _restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, label = table(spark, sf_dir, "part"), F.col("p_partkey").cast("string").alias("label")
    cases = part.select(F.when(F.col("p_brand") == "Brand#3", F.lit("weak-line")).otherwise("strong").alias("case"), label)
    return figures.restored_labels(cases, part.select(label, ((F.col("p_size") == 11) & (F.col("p_partkey") % 2 == 0)).alias("restored")))


@query(_RESTORED)
def restored_labels(spark, sf_dir):
    return _restored(spark, sf_dir)


@query(f"WITH r AS ({_RESTORED}) SELECT class, count(*) AS n FROM (SELECT CASE WHEN p_type = 'PROMO' THEN 'manual' ELSE 'automatic' END AS class FROM part UNION ALL SELECT 'restored' FROM r) GROUP BY class")
def class_counts(spark, sf_dir):
    figs = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("label"), F.when(F.col("p_type") == "PROMO", "manual").otherwise("direct").alias("source_category"))
    return figures.class_counts(figures.with_classes(figs, _restored(spark, sf_dir)))


_ZIP = """a AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS position FROM lineitem), b AS (SELECT o_orderkey AS l_orderkey, n AS label, row_number() OVER (PARTITION BY o_orderkey ORDER BY n) AS position FROM (SELECT o_orderkey, unnest(range(1, 1 + CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 5 ELSE 1 END)) AS n FROM orders))"""


def _zipped(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    crops = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    most = F.when(F.col("o_orderstatus") == "F", 3).when(F.col("o_orderstatus") == "O", 5).otherwise(1)
    labels = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.explode(F.sequence(F.lit(1).cast("long"), most.cast("long"))).alias("label"))
    return figures.zip_by_position(crops, labels, "l_orderkey", ["l_linenumber", "l_partkey"], ["label"])


@query(f"WITH {_ZIP} SELECT l_orderkey, l_partkey, label FROM a JOIN b USING (l_orderkey, position)")
def zipped_labels(spark, sf_dir):
    return _zipped(spark, sf_dir)[0].select("l_orderkey", "l_partkey", "label")


@query(f"WITH {_ZIP}, x AS (SELECT l_orderkey, count(*) AS n FROM a GROUP BY 1), y AS (SELECT l_orderkey, count(*) AS n FROM b GROUP BY 1) SELECT coalesce(x.l_orderkey, y.l_orderkey) AS l_orderkey, coalesce(x.n, 0) AS n_left, coalesce(y.n, 0) AS n_right FROM x FULL JOIN y ON x.l_orderkey = y.l_orderkey WHERE coalesce(x.n, 0) <> coalesce(y.n, 0)")
def zip_mismatches(spark, sf_dir):
    return _zipped(spark, sf_dir)[1]


@query("""WITH e AS (SELECT CASE WHEN p_size = 1 THEN '' WHEN p_size = 2 THEN 'twice' ELSE CAST(p_partkey AS VARCHAR) END AS id, CASE WHEN p_size = 3 THEN 'a/b' ELSE p_brand END AS page, CASE WHEN p_size = 4 THEN 'grid' END AS layout, CASE WHEN p_size % 2 = 0 THEN [p_size, CASE WHEN p_size = 6 THEN 6 ELSE 0 END] END AS ind, CASE WHEN p_size % 3 = 0 THEN [1] END AS parts FROM part)
SELECT 'missing-id' AS rule, id AS key, '' AS detail FROM e WHERE id = '' UNION ALL SELECT 'layout', id, layout FROM e WHERE layout IS NOT NULL UNION ALL SELECT 'unsafe-page', id, page FROM e WHERE page = 'a/b'
UNION ALL SELECT 'indices-xor-parts', id, '' FROM e WHERE (ind IS NULL) = (parts IS NULL) UNION ALL SELECT 'index-twice', id, array_to_string(ind, ',') FROM e WHERE ind[1] = ind[2] UNION ALL SELECT 'id-twice', id, CAST(count(*) AS VARCHAR) FROM e GROUP BY id HAVING count(*) > 1""")
def composition_specification(spark, sf_dir):
    c, size = F.col, F.col("p_size")
    entries = table(spark, sf_dir, "part").select(F.when(size == 1, "").when(size == 2, "twice").otherwise(c("p_partkey").cast("string")).alias("id"), F.when(size == 3, "a/b").otherwise(c("p_brand")).alias("page_id"), F.when(size == 4, "grid").alias("layout"), F.when(size % 2 == 0, F.array(size, F.when(size == 6, 6).otherwise(0))).alias("asset_indices"), F.when(size % 3 == 0, F.array(F.lit(1))).alias("parts"))
    return figures.specification_violations(entries)


@query("""WITH p AS (SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_suppkey % 60 AS INT) AS x, CAST(l_quantity AS INT) AS w, l_tax > 0.07 AS lost, l_returnflag AS f FROM lineitem),
c AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, x, w) AS n FROM p)
SELECT 'asset-missing' AS rule, CAST(l_orderkey AS VARCHAR) AS key, CAST(l_linenumber AS VARCHAR) AS detail FROM c WHERE lost UNION ALL SELECT 'clip-outside-asset', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR) FROM c WHERE NOT lost AND f = 'A' AND w > 40
UNION ALL SELECT 'unsafe-path', CAST(l_orderkey AS VARCHAR), concat('../', l_orderkey, '.png') FROM c WHERE f = 'R' UNION ALL SELECT 'output-twice', CAST(min(l_orderkey) AS VARCHAR), 'n.png' FROM (SELECT DISTINCT l_orderkey FROM c WHERE f = 'N') HAVING count(*) > 1""")
def composition_rules(spark, sf_dir):
    c = F.col
    x, w = (c("l_suppkey") % 60).cast("int"), c("l_quantity").cast("int")
    box = lambda x1, x2: F.struct(x1.alias("x1"), F.lit(0).alias("y1"), x2.alias("x2"), F.lit(9).alias("y2"))
    output = F.when(c("l_returnflag") == "R", F.concat(F.lit("../"), "l_orderkey", F.lit(".png"))).when(c("l_returnflag") == "N", "n.png").otherwise(F.concat("l_orderkey", F.lit(".png")))
    parts = table(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("id"), c("l_linenumber").alias("part"), F.lit("p").alias("page_id"), c("l_linenumber").alias("asset_index"), F.when(c("l_returnflag") == "A", box(x, x + w)).alias("clip"), F.when(~(c("l_tax") > 0.07), box(x, x + 40 + F.when(w > 40, 0).otherwise(40))).alias("asset"), output.alias("output"))
    return figures.composition_violations(parts).where("rule <> 'overlapping-windows'")


# --- validation

@query("""SELECT rule, CAST(key AS VARCHAR) AS key, detail FROM (SELECT 'no-page' AS rule, l.doc_id AS key, '' AS detail FROM labels l WHERE doc_id NOT IN (SELECT page_id FROM pages)
UNION ALL SELECT 'physical-index', doc_id, CAST(quality AS VARCHAR) FROM labels JOIN pages ON page_id = doc_id WHERE quality <> 1 UNION ALL SELECT 'page-type', doc_id, CAST(toxic AS VARCHAR) FROM labels JOIN pages ON page_id = doc_id WHERE toxic <> 0)""")
def frontmatter_check(spark, sf_dir):
    c = F.col
    policy = table(spark, sf_dir, "labels").select(c("doc_id").alias("id"), c("quality").alias("physical_index"), c("toxic").cast("string").alias("page_type"))
    return validate.frontmatter(policy, table(spark, sf_dir, "pages").select(c("page_id").alias("id"), F.lit(1).alias("physical_index"), F.lit("0").alias("page_type")))


@query("""WITH b AS (SELECT o_custkey, count(*) AS n, any_value(o_custkey % 5) AS r FROM orders GROUP BY o_custkey), refs AS (SELECT o_orderkey AS id, o_custkey % 9 AS pi, o_orderstatus AS st FROM orders),
pages AS (SELECT l_orderkey AS id, l_orderkey % 9 AS pi, 'F' AS st FROM lineitem GROUP BY l_orderkey), j AS (SELECT r.*, p.id AS pid, p.pi AS ppi, p.st AS pst FROM refs r LEFT JOIN pages p USING (id))
SELECT rule, count(*) AS n FROM (SELECT 'batch-schema' AS rule FROM b WHERE r = 1 UNION ALL SELECT 'completed-pages' FROM b WHERE r = 2 UNION ALL SELECT 'missing-page' FROM j WHERE pid IS NULL UNION ALL SELECT 'physical_index' FROM j WHERE pid IS NOT NULL AND pi <> ppi
UNION ALL SELECT 'status' FROM j WHERE pid IS NOT NULL AND st <> pst UNION ALL SELECT 'orphan' FROM pages WHERE id NOT IN (SELECT id FROM refs)) GROUP BY rule""")
def batch_file_rules(spark, sf_dir):
    c = F.col
    ref = F.struct(c("o_orderkey").cast("string").alias("id"), (c("o_custkey") % 9).cast("int").alias("physical_index"), c("o_orderstatus").alias("status"), F.concat(F.lit("corpus/text/pages/"), "o_orderkey", F.lit(".json")).alias("path"))
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(ref).alias("pages"))
    batches = rows.select(F.concat(F.lit("batch-"), "o_custkey").alias("file_name"), F.when(c("o_custkey") % 5 == 1, "v0").otherwise("v1").alias("schema"), (F.size("pages") + F.when(c("o_custkey") % 5 == 2, 1).otherwise(0)).alias("completed_pages"), "pages")
    pages = table(spark, sf_dir, "lineitem").select(c("l_orderkey").cast("string").alias("id"), (c("l_orderkey") % 9).cast("int").alias("physical_index"), F.lit("F").alias("status")).distinct()
    return validate.summary(validate.batch_files(batches, pages, "v1"))


@query("""WITH b AS (SELECT conv_id AS id, count(*) AS figs, min(turn) AS pi, bool_or(role = 'user' AND turn = 4) AS odd FROM conversations GROUP BY conv_id)
SELECT 'not-verified' AS rule, CAST(id AS VARCHAR) AS key, 'draft' AS detail FROM b WHERE odd UNION ALL SELECT 'figure-count', 'book', CAST(sum(figs) AS VARCHAR) FROM b UNION ALL SELECT 'page-sequence', 'book', CAST(count(DISTINCT pi) AS VARCHAR) FROM b UNION ALL SELECT 'edition-version', 'book', 'normalized 2.0.0'
UNION ALL SELECT 'asset-count', 'book', CAST(count(*) AS VARCHAR) FROM documents UNION ALL SELECT 'supplementary', CAST(doc_id AS VARCHAR), '' FROM documents WHERE doc_id NOT IN (SELECT conv_id * 100 + turn FROM conversations)""")
def book_gates(spark, sf_dir):
    conv, c = table(spark, sf_dir, "conversations"), F.col
    pages = conv.groupBy(c("conv_id").alias("id")).agg(F.collect_list(F.struct((c("conv_id") * 100 + c("turn")).alias("file"))).alias("figures"), F.min("turn").alias("physical_index"), F.bool_or((c("role") == "user") & (c("turn") == 4)).alias("odd"))
    pages = pages.withColumn("status", F.when(c("odd"), "draft").otherwise("verified")).withColumn("problem", F.lit(None).cast("string"))
    n = conv.select("conv_id").distinct().count()
    assets = table(spark, sf_dir, "documents").select(c("doc_id").alias("file"))
    return validate.release_gates(pages, n, -1, release=("normalized", "2.0.0"), versions={"normalized": "1.0.0"}, assets=assets)


@query("""SELECT 'coverage' AS rule, CAST(p_partkey AS VARCHAR) AS key, CAST(p_size / 50.0 AS VARCHAR) AS detail FROM part WHERE p_size / 50.0 < 0.995 UNION ALL SELECT 'aspect', CAST(p_partkey AS VARCHAR), CAST(1.5 AS VARCHAR) FROM part WHERE p_type = 'PROMO'
UNION ALL SELECT 'figure-count', 'edition', CAST(sum(p_size) AS VARCHAR) FROM part""")
def facsimile_gates(spark, sf_dir):
    c = F.col
    pages = table(spark, sf_dir, "part").select(c("p_partkey").alias("id"), (c("p_size") / 50.0).alias("coverage"), F.lit(1.5).alias("aspect"), F.when(c("p_type") == "PROMO", 1.51).otherwise(1.501).alias("source_aspect"), c("p_size").alias("figures"))
    return validate.facsimile_edition(pages, 168, 1, 6)


_PLATES = "SELECT p_partkey, p_size >= 40 AS plate, CAST(600 + p_size AS INT) AS w, CAST(400 + p_size % 7 AS INT) AS h FROM part"


def _plates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return flow.atlas_pages(table(spark, sf_dir, "part").select(c("p_partkey").alias("id"), (c("p_size") >= 40).alias("is_atlas"), (600 + c("p_size")).alias("width"), (400 + c("p_size") % 7).alias("height")))


@query(f"WITH p AS ({_PLATES}), s AS (SELECT *, least(720.0 / w, 489.6 / h) AS k FROM p) SELECT p_partkey AS id, CAST(CASE WHEN plate THEN 720.0 ELSE 489.6 END AS DOUBLE) AS out_width, CASE WHEN plate THEN round(w * k * h * k / (720.0 * 489.6), 9) END AS coverage FROM s")
def atlas_layout(spark, sf_dir):
    return _plates(spark, sf_dir).select("id", F.col("out_width"), F.round("coverage", 9).alias("coverage"))


@query(f"WITH p AS ({_PLATES}), s AS (SELECT *, least(720.0 / w, 489.6 / h) AS k FROM p) SELECT rule, count(*) AS n FROM (SELECT 'coverage' AS rule FROM s WHERE plate AND w * k * h * k / (720.0 * 489.6) < 0.98 UNION ALL SELECT 'landscape-count' FROM (SELECT count(*) AS n FROM p WHERE plate) WHERE n <> 6) GROUP BY rule")
def landscape_gates(spark, sf_dir):
    return validate.summary(validate.landscape_pages(_plates(spark, sf_dir), 6))


@query(r"SELECT CAST(doc_id AS VARCHAR) AS id, CAST(len(regexp_extract_all(t, '([А-Яа-яЁё])[ъЪ]([^А-Яа-яЁё]|$)')) AS BIGINT) AS found FROM (SELECT doc_id, replace(text, ' le ', ' домъ ') AS t FROM documents) WHERE regexp_matches(t, '[А-Яа-яЁё][ъЪ]([^А-Яа-яЁё]|$)')")
def sign_repairs(spark, sf_dir):
    pages = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.replace("text", F.lit(" le "), F.lit(" домъ ")).alias("normalized_text"))
    return validate.repair(pages)


# --- flow, editions, sinks, strings

@query(r"""SELECT doc_id, sha256(concat('<section id="', doc_id, '">', chr(10), string_agg(concat('<p>', replace(replace(replace(replace(replace(replace(b, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;'), chr(10), '<br/>'), '</p>'), chr(10) ORDER BY k), chr(10), '</section>')) AS sha
FROM (SELECT doc_id, unnest(bs) AS b, generate_subscripts(bs, 1) AS k FROM (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(text, '^\n+|\n+$', '', 'g'), '\n\s*\n'), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g')) <> '') AS bs FROM documents)) GROUP BY doc_id""")
def html_sections(spark, sf_dir):
    pages = table(spark, sf_dir, "documents").select("doc_id", "text", F.lit(1000).alias("height"))
    none = spark.createDataFrame([], "doc_id long, label string, asset_index int, y1 int, y2 int, file string")
    return flow.html_page(flow.page_flow(pages, none, "doc_id"), "doc_id").select("doc_id", F.sha2("html", 256).alias("sha"))


_SHOWN = """f AS (SELECT conv_id, turn AS seq, CASE role WHEN 'user' THEN 'figure' ELSE 'text' END AS kind, sha256(text) AS content FROM conversations), p AS (SELECT page_id AS conv_id, url FROM pages)"""


@query(f"""WITH {_SHOWN}, x AS (SELECT f.*, p.conv_id IS NOT NULL AS m FROM f LEFT JOIN p USING (conv_id)), i AS (SELECT conv_id, -1 AS seq, 'facsimile' AS kind, url AS content, false AS hidden FROM p)
SELECT 'html' AS edition, conv_id, seq, kind, content, m AS hidden FROM x UNION ALL SELECT 'html', * FROM i UNION ALL SELECT 'fb2', conv_id, seq, kind, content, false FROM x WHERE NOT (m AND kind = 'figure') UNION ALL SELECT 'fb2', * FROM i
UNION ALL SELECT 'pdf', conv_id, seq, kind, content, false FROM x WHERE NOT m UNION ALL SELECT 'pdf', * FROM i""")
def facsimile_flows(spark, sf_dir):
    c = F.col
    rows = table(spark, sf_dir, "conversations").select("conv_id", c("turn").alias("seq"), F.when(c("role") == "user", "figure").otherwise("text").alias("kind"), F.sha2("text", 256).alias("content"))
    policy = table(spark, sf_dir, "pages").select(c("page_id").alias("conv_id"), c("url").alias("file"))
    out = [flow.facsimile_flow(rows, policy, e, "conv_id").withColumn("edition", F.lit(e)) for e in ("html", "fb2", "pdf")]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("SELECT doc_id, sha256(CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN '' ELSE text END) AS sha, doc_id IN (SELECT doc_id FROM labels) AS facsimile FROM documents")
def facsimile_pages(spark, sf_dir):
    out = flow.with_facsimiles(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), "doc_id")
    return out.select("doc_id", F.sha2("text", 256).alias("sha"), "facsimile")


@query("SELECT concat('pages/', page_id, '.html') AS path, concat(sha256(html), '  pages/', page_id, '.html') AS line FROM pages")
def checksum_lines(spark, sf_dir):
    files = table(spark, sf_dir, "pages").select(F.concat(F.lit("pages/"), "page_id", F.lit(".html")).alias("path"), F.col("html").cast("binary").alias("content"))
    return sinks.sha256sums(files)


@query("SELECT conv_id, string_agg(CAST(turn AS VARCHAR), ';' ORDER BY turn) AS turns, CAST(bool_or(turn > 5) AS INT) AS long FROM conversations GROUP BY conv_id")
def flat_arrays(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"), F.bool_or(F.col("turn") > 5).alias("long"))
    return sinks.flat_columns(rows)


@query("SELECT doc_id, sha256(nfc_normalize(replace(replace(text, 'é', concat('e', chr(769))), 'ê', concat('e', chr(770))))) AS sha FROM documents")
def nfc_pages(spark, sf_dir):
    apart = F.replace(F.replace("text", F.lit("é"), F.lit("é")), F.lit("ê"), F.lit("ê"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(X.nfc(apart), 256).alias("sha"))


_PATH = "concat(CASE WHEN p_size > 45 THEN '/' WHEN p_size > 40 THEN '../' ELSE 'figures/' END, 'sheet-', lpad(CAST(p_size AS VARCHAR), 3, '0'), CASE WHEN p_type = 'PROMO' THEN '-middle' ELSE '-left' END, CASE WHEN p_size < 5 THEN '.jpg' ELSE '.PNG' END)"


@query(rf"""SELECT p_partkey, CASE WHEN p_type <> 'PROMO' THEN concat('sheet-', lpad(CAST(p_size AS VARCHAR), 3, '0'), '-left') END AS page_id, p_size BETWEEN 5 AND 40 AS safe, regexp_replace({_PATH}, '^figures/', 'images/') AS image, right(p_name, 5) AS tail,
concat('figs-', lpad(CAST(p_size AS VARCHAR), 3, '0'), '-', lpad(CAST(p_size + 1 AS VARCHAR), 3, '0'), 'bis') AS hint, regexp_replace(p_name || '&"', '[^A-Za-z0-9_-]+', '-', 'g') AS ident FROM part""")
def path_functions(spark, sf_dir):
    path, c = F.expr(_PATH.replace("VARCHAR", "string")), F.col
    hint = X.label_hint(F.array(c("p_size").cast("string"), F.concat((c("p_size") + 1).cast("string"), F.lit("bis"))))
    return table(spark, sf_dir, "part").select("p_partkey", X.page_id(path).alias("page_id"), X.safe_path(path).alias("safe"), flow.epub_path(path).alias("image"), X.tail(c("p_name"), 5).alias("tail"), hint.alias("hint"), X.safe_id(F.concat("p_name", F.lit('&"'))).alias("ident"))
