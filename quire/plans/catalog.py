"""Every operator as a query over the driver's tables, and its DuckDB SQL.

The tables hold no scanned book, so each operator meets a column of like shape: documents are
reviewed pages, a translation of them is an engine's prediction, parts and line items make labels and boxes. All
queries read their tables whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import geometry as G
from quire.functions import text as X
from quire.functions.store import spread
from quire.operators import book, census, coverage, figures, flow, graph, score, validate
from quire.plans import editions, layout  # noqa: F401  they register their queries
from quire.plans.registry import QUERIES, SQL, query
from quire.plans.registry import table as _t
from quire.sources import readers

def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# --- scoring: whole pages are the turns of conversations, of several lines, characters other than ASCII folded to "~" (DuckDB's
# distance counts bytes); the third turn's truth is pending, the sixth's uncertain, the second's has no status

_STATUS = "CASE turn WHEN 1 THEN NULL WHEN 2 THEN 'pending' WHEN 5 THEN 'excluded-uncertain' ELSE 'reviewed' END"
_PAGES = f"""
pages AS (SELECT conv_id, turn, regexp_replace(text, '[^\\x00-\\x7F]', '~', 'g') AS gt FROM conversations WHERE text IS NOT NULL AND coalesce({_STATUS}, '') NOT IN ('pending', 'excluded-uncertain')),
preds AS (SELECT conv_id, turn, 'alpha' AS engine, gt, translate(gt, 'el', 'ci') AS pred FROM pages
          UNION ALL SELECT conv_id, turn, 'beta', gt, replace(gt, ', ', ',') FROM pages
          UNION ALL SELECT conv_id, turn, 'gamma', gt, translate(replace(gt, 'th', 't'), 'o', '0') FROM pages),
norm AS (SELECT *, trim(regexp_replace(gt, '(?m)[ \\t]+$', '', 'g'), concat(' ', chr(9), chr(10))) AS ts, trim(regexp_replace(pred, '(?m)[ \\t]+$', '', 'g'), concat(' ', chr(9), chr(10))) AS ps FROM preds),
scored AS (SELECT conv_id, turn, engine, length(ts) AS gs, length(regexp_replace(ts, '\\s+', ' ', 'g')) AS gc,
                  levenshtein(ts, ps) AS ds, levenshtein(regexp_replace(ts, '\\s+', ' ', 'g'), regexp_replace(ps, '\\s+', ' ', 'g')) AS dc FROM norm)
""".replace("\\\\", "\\")


def _engines(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Pages (keys, gt) with the predictions of three simulated engines."""
    engine = lambda name, pred: F.struct(F.lit(name).alias("engine"), pred.alias("pred"))
    engines = F.array(engine("alpha", F.translate("gt", "el", "ci")), engine("beta", F.replace("gt", F.lit(", "), F.lit(","))), engine("gamma", F.translate(F.replace("gt", F.lit("th"), F.lit("t")), "o", "0")))
    return pages.select(*keys, "gt", F.explode(engines).alias("e")).select(*keys, "gt", "e.engine", "e.pred")


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spread(_t(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), 1 << 18).where(score.eligible(F.col("text"), F.expr(_STATUS)))
    return _engines(turns.select("conv_id", "turn", F.regexp_replace("text", r"[^\x00-\x7F]", "~").alias("gt")), ["conv_id", "turn"])


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.score_text(_predictions(spark, sf_dir), with_words=False)


_SUMMARY = f"""WITH {_PAGES}, s AS (SELECT engine, count(*) AS pages, CAST(sum(gs) AS BIGINT) AS gt_chars_strict, CAST(sum(gc) AS BIGINT) AS gt_chars_content,
CAST(sum(ds) AS BIGINT) AS strict_edit_distance, CAST(sum(dc) AS BIGINT) AS content_edit_distance FROM scored GROUP BY engine),
r AS (SELECT *, strict_edit_distance / greatest(1, gt_chars_strict) AS cer_strict, content_edit_distance / greatest(1, gt_chars_content) AS cer_content FROM s)"""


@query(f"{_SUMMARY} SELECT * FROM r")
def ocr_engine_summary(spark, sf_dir):
    return score.summary(_scored(spark, sf_dir), ["engine"])


@query(f"{_SUMMARY} SELECT engine, cer_content FROM r ORDER BY cer_content, engine LIMIT 1")
def best_config(spark, sf_dir):
    return score.best(score.summary(_scored(spark, sf_dir), ["engine"]), "cer_content", ["engine"]).select("engine", "cer_content")


@query(f"""WITH {_PAGES} SELECT conv_id, engine, count(*) AS pages, CAST(sum(gs) AS BIGINT) AS gt_chars_strict, CAST(sum(gc) AS BIGINT) AS gt_chars_content,
CAST(sum(ds) AS BIGINT) AS strict_edit_distance, CAST(sum(dc) AS BIGINT) AS content_edit_distance, sum(ds) / greatest(1, sum(gs)) AS cer_strict, sum(dc) / greatest(1, sum(gc)) AS cer_content FROM scored GROUP BY conv_id, engine""")
def ocr_score_pages(spark, sf_dir):
    return score.summary(_scored(spark, sf_dir), ["conv_id", "engine"])


@query()
def ocr_word_errors(spark, sf_dir):
    """Words by code points in the engine; SQL has no distance of lists."""
    return score.summary(score.score_text(_predictions(spark, sf_dir)), ["engine"]).select("engine", "gt_words", "word_edit_distance", "wer_content")


_NAMES = "SELECT p_partkey, p_name AS gt, replace(replace(p_name, 'a', ''), 'e', 'ee') AS pred FROM part"


@query(f"WITH n AS ({_NAMES}) SELECT p_partkey, CAST(levenshtein(gt, pred) AS BIGINT) AS edits, CAST(length(gt) - length(pred) AS BIGINT) AS balance FROM n")
def edit_operation_invariants(spark, sf_dir):
    names = _t(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("gt"), F.replace(F.replace("p_name", F.lit("a"), F.lit("")), F.lit("e"), F.lit("ee")).alias("pred"))
    ops = score.with_operations(names, "gt", "pred")
    return ops.select("p_partkey", (F.col("substitutions") + F.col("deletions") + F.col("insertions")).alias("edits"), (F.col("deletions") - F.col("insertions")).alias("balance"))


@query(f"WITH {_PAGES} SELECT engine, count(DISTINCT concat(conv_id, '/', turn)) AS scored_samples FROM scored GROUP BY engine")
def scored_samples(spark, sf_dir):
    scored = _predictions(spark, sf_dir).select("engine", F.concat_ws("/", "conv_id", "turn").alias("sample"))
    return score.scored_samples(scored, ["engine"], "sample")


_FAMILIES = {"e": "eE", "t": "tT", "a": "aA", "o": "oO"}
_FAMILY_SQL = " ".join(f"WHEN glyph IN ({', '.join(repr(g) for g in gs)}) THEN '{f}'" for f, gs in _FAMILIES.items())


@query(f"""WITH p AS (SELECT string_split(text, '') AS g, string_split(regexp_replace(translate(text, 'T', '#'), 'e([aeiou])', '^\\1', 'g'), '') AS p FROM documents),
c AS (SELECT unnest(g) AS g, unnest(p) AS p FROM p), glyphs AS (SELECT unnest({[g for gs in _FAMILIES.values() for g in gs]}) AS glyph),
n AS (SELECT glyph, CASE {_FAMILY_SQL} END AS family, count(*) FILTER (g = glyph) AS gt, count(*) FILTER (g = glyph AND p = glyph) AS correct, count(*) FILTER (p = glyph) - count(*) FILTER (g = glyph AND p = glyph) AS fp FROM c, glyphs WHERE g IN (SELECT glyph FROM glyphs) OR p IN (SELECT glyph FROM glyphs) GROUP BY glyph)
SELECT family, CAST(sum(gt) AS BIGINT) AS gt, CAST(sum(correct) AS BIGINT) AS correct, CAST(sum(fp) AS BIGINT) AS false_positives, sum(correct) / nullif(sum(gt), 0) AS recall FROM n GROUP BY family""")
def glyph_family_recall(spark, sf_dir):
    """Whole documents. The engine's only errors put characters that no glyph is, one for one, so the diagonal is the best alignment."""
    pages = _t(spark, sf_dir, "documents").select(F.col("text").alias("gt"), F.regexp_replace(F.translate("text", "T", "#"), "e([aeiou])", "^$1").alias("pred"))
    counts = score.glyph_counts(pages, [], [g for gs in _FAMILIES.values() for g in gs], "gt", "pred")
    return score.family_recall(counts, _FAMILIES, [])


@query("""SELECT status, count(*) AS n FROM (SELECT CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'engine-error' WHEN l_discount > 0.09 THEN 'pipeline-error' WHEN l_tax < 0.01 THEN 'serialization-missing'
WHEN l_quantity < 10 THEN 'unscored-no-gt' ELSE 'scored' END AS status FROM lineitem) GROUP BY status""")
def run_status_counts(spark, sf_dir):
    c = F.col
    status = score.run_status((c("l_returnflag") == "R") & (c("l_linestatus") == "F"), c("l_discount") > 0.09, ~(c("l_tax") < 0.01), ~(c("l_quantity") < 10))
    return score.status_counts(_t(spark, sf_dir, "lineitem").select(status.alias("status")), "status")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def status_counts(spark, sf_dir):
    return score.status_counts(_t(spark, sf_dir, "events"), "event_type")


# --- text

@query(r"""SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '(?m)[^\S\n]+$', '', 'g'), concat(' ', chr(9), chr(10), chr(13)))) AS sha FROM documents""")
def text_strict_normalize(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.sha2(X.strict_normalize(F.col("text")), 256).alias("sha"))


@query(r"SELECT doc_id, sha256(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS sha FROM documents")
def text_content_normalize(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.sha2(X.content_normalize(F.col("text")), 256).alias("sha"))


@query(r"""SELECT doc_id, CAST(len(regexp_extract_all(text, '([a-z])[sd]([^a-z]|$)')) AS BIGINT) AS found, sha256(regexp_replace(text, '([a-z])[sd]([^a-z]|$)', '\1\2', 'g')) AS sha FROM documents""")
def word_final_repair(spark, sf_dir):
    t = F.col("text")
    return _t(spark, sf_dir, "documents").select("doc_id", X.count_final_sign(t, "a-z", "sd").cast("long").alias("found"), F.sha2(X.repair_final_sign(t, "a-z", "sd"), 256).alias("sha"))


@query("""SELECT doc_id, array_to_string(list_sort(list_filter(['A', 'Q', 'X', 'Z', 'j', 'k', 'q', 'z'], lambda g: contains(text, g))), '') AS glyphs FROM documents""")
def glyph_presence(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.array_join(X.glyphs_present(F.col("text"), "AQXZjkqz"), "").alias("glyphs"))


@query(r"""SELECT doc_id, length(text) AS chars, len(regexp_extract_all(text, '\S')) AS non_blank, len(regexp_extract_all(text, '\p{L}')) AS letters, len(regexp_extract_all(text, chr(65533))) AS replacements, len(regexp_extract_all(text, '\n')) AS line_feeds FROM documents""")
def source_preflight(spark, sf_dir):
    return readers.text_statistics(_t(spark, sf_dir, "documents"), "doc_id", "text")


_CAPTIONS = "concat_ws(chr(10), p_name, concat('  ', p_size, ' FIG.'), concat('see ', p_size + 1, ' fig.'), concat(p_size + 1, ' fig.'), concat(p_size, ' Fig. '))"


@query(rf"""WITH t AS (SELECT p_partkey, {_CAPTIONS} AS t FROM part), n AS (SELECT p_partkey, list_transform(regexp_extract_all(t, '(?mi)^\s*(\d+)\s+FIG\.\s*$', 1), lambda x: CAST(x AS INT)) AS a FROM t)
SELECT p_partkey, array_to_string(list_filter(a, lambda x, i: list_position(a, x) = i), ',') AS numbers FROM n""")
def caption_numbers(spark, sf_dir):
    t = F.expr(_CAPTIONS)
    return _t(spark, sf_dir, "part").select("p_partkey", F.array_join(X.caption_numbers(t, "FIG").cast("array<string>"), ",").alias("numbers"))


@query(r"""WITH n AS (SELECT doc_id, list_transform(regexp_extract_all(text, '(?i)(\d+)\s*\.example\.', 1), lambda x: CAST(x AS INT)) AS a FROM documents)
SELECT doc_id, array_to_string(list_filter(a, lambda x, i: list_position(a, x) = i), ',') AS numbers FROM n""")
def mention_counts(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.array_join(X.mention_numbers(F.col("text"), r"\.example").cast("array<string>"), ",").alias("numbers"))


@query("""SELECT label, CAST(n AS INT) AS number, CAST(b AS INT) AS bis, concat(lpad(n, 3, '0'), CASE WHEN b = 1 THEN 'bis' ELSE '' END) AS fixed, row_number() OVER (ORDER BY CAST(n AS INT), b) AS position
FROM (SELECT DISTINCT concat(regexp_extract(p_brand, '(\\d+)', 1), CASE WHEN p_size > 25 THEN 'bis' ELSE '' END) AS label, regexp_extract(p_brand, '(\\d+)', 1) AS n, CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS b FROM part)""".replace("\\\\", "\\"))
def label_natural_order(spark, sf_dir):
    label = F.concat(F.regexp_extract("p_brand", r"(\d+)", 1), F.when(F.col("p_size") > 25, "bis").otherwise(""))
    rows = _t(spark, sf_dir, "part").select(label.alias("label")).distinct().select("label", X.label_number(F.col("label")).alias("number"), X.label_bis(F.col("label")).alias("bis"), X.label_text(F.col("label")).alias("fixed"))
    return coverage.numbered(rows, ["number", "bis"])


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), n AS (SELECT doc_id, line, len(regexp_extract_all(line, '\p{L}')) AS a, len(regexp_extract_all(line, '\p{Lu}')) AS u FROM l)
SELECT doc_id, count(*) AS lines, count(*) FILTER (a > 0 AND length(line) <= 95 AND u / greatest(a, 1) > 0.82) AS headings FROM n GROUP BY doc_id""")
def heading_lines(spark, sf_dir):
    lines = _t(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(X.is_heading(F.col("line"))).alias("headings"))


_TAGS = "regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g')"
for _tag in ("head", "nav", "script", "style"):
    _TAGS = rf"regexp_replace({_TAGS}, '(?is)<{_tag}\b.*?</{_tag}>', ' ', 'g')"
_UNESCAPED = f"regexp_replace({_TAGS}, '(?s)<[^>]*>', ' ', 'g')"
for _a, _b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&amp;", "&")):
    _UNESCAPED = f"replace({_UNESCAPED}, '{_a}', '{_b}')"


@query(rf"WITH t AS (SELECT page_id, trim(regexp_replace({_UNESCAPED}, '\s+', ' ', 'g')) AS t FROM pages) SELECT page_id, length(t) AS chars, sha256(t) AS sha FROM t")
def html_page_text(spark, sf_dir):
    text = flow.html_text(F.col("html"))
    return _t(spark, sf_dir, "pages").select("page_id", text.alias("t")).select("page_id", F.length("t").cast("long").alias("chars"), F.sha2("t", 256).alias("sha"))


@query("SELECT doc_id, sha256(text) AS sha FROM documents")
def sha_manifest(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha")).orderBy("doc_id")


# --- coverage, batches, sequences, sets

_LAYERS = "SELECT 'labels' AS engine, doc_id AS page_id FROM labels UNION ALL SELECT 'good', doc_id FROM labels WHERE quality = 1 UNION ALL SELECT 'conversations', conv_id FROM conversations UNION ALL SELECT 'pages', page_id FROM pages UNION ALL SELECT 'parts', p_partkey FROM part"


def _layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _t(spark, sf_dir, "labels")
    one = lambda df, name, key: df.select(F.lit(name).alias("engine"), F.col(key).alias("page_id"))
    out = one(labels, "labels", "doc_id").unionByName(one(labels.where("quality = 1"), "good", "doc_id")).unionByName(one(_t(spark, sf_dir, "conversations"), "conversations", "conv_id"))
    return out.unionByName(one(_t(spark, sf_dir, "pages"), "pages", "page_id")).unionByName(one(_t(spark, sf_dir, "part"), "parts", "p_partkey"))


@query(f"""WITH l AS (SELECT DISTINCT * FROM ({_LAYERS})), x AS (SELECT DISTINCT doc_id FROM documents)
SELECT engine, (SELECT count(*) FROM x) AS expected, count(doc_id) AS available, (SELECT count(*) FROM x) - count(doc_id) AS missing, count(*) - count(doc_id) AS extra FROM l LEFT JOIN x ON page_id = doc_id GROUP BY engine""")
def layer_coverage(spark, sf_dir):
    return coverage.layer_coverage(_t(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id")), _layers(spark, sf_dir))


@query(f"""WITH l AS ({_LAYERS}), e AS (SELECT DISTINCT engine FROM l), m AS (SELECT engine, doc_id FROM documents, e EXCEPT SELECT engine, page_id FROM l) SELECT engine, doc_id AS page_id FROM m""")
def layer_missing(spark, sf_dir):
    layers = _layers(spark, sf_dir)
    return coverage.missing_by_layer(_t(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id")), layers, layers.select("engine").distinct())


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_pending(spark, sf_dir):
    return coverage.pending(_t(spark, sf_dir, "documents").select("doc_id"), _t(spark, sf_dir, "labels"), ["doc_id"])


@query("SELECT count(*) AS expected, count(*) FILTER (b) AS resumed, count(*) FILTER (w AND NOT b) AS written, count(*) FILTER (b OR w) AS available, CAST(count(*) FILTER (NOT b AND NOT w) AS BIGINT) AS missing FROM (SELECT doc_id IN (SELECT doc_id FROM labels) AS b, doc_id IN (SELECT page_id FROM pages) AS w FROM documents)")
def run_accounting(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"))
    return coverage.run_accounting(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"), pages, ["doc_id"])


@query("SELECT doc_id, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS held_out FROM documents")
def held_out_flag(spark, sf_dir):
    return coverage.with_flag(_t(spark, sf_dir, "documents").select("doc_id"), _t(spark, sf_dir, "labels").where("toxic = 1"), "doc_id", "held_out")


@query("""SELECT batch, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id, CAST(sum(n_chars) AS BIGINT) AS chars FROM (SELECT doc_id, n_chars, (row_number() OVER (ORDER BY doc_id) + 19) // 20 AS batch FROM documents) GROUP BY batch""")
def editorial_batches(spark, sf_dir):
    rows = coverage.batches(_t(spark, sf_dir, "documents").select("doc_id", "n_chars"), ["doc_id"], 20)
    return rows.groupBy("batch").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.sum("n_chars").alias("chars"))


@query("""SELECT doc_id, position FROM (SELECT doc_id, row_number() OVER (ORDER BY n_chars, doc_id) AS position FROM documents) WHERE position BETWEEN 41 AND 60""")
def batch_slice(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return coverage.batch_slice(coverage.numbered(docs, ["n_chars", "doc_id"]), 41, 20, docs.count()).select("doc_id", "position")


@query("""WITH refs AS (SELECT doc_id AS id, n_chars AS pi, lang AS st FROM documents UNION ALL SELECT doc_id, 0, 'en' FROM labels WHERE toxic = 1),
pages AS (SELECT doc_id AS id, n_chars AS pi, CASE WHEN source = 'src3' THEN 'draft' ELSE lang END AS st FROM documents WHERE lang <> 'es' UNION ALL SELECT -1 - p_partkey, 0, 'en' FROM part),
j AS (SELECT r.id, r.pi, r.st, p.id AS pid, p.pi AS ppi, p.st AS pst FROM refs r LEFT JOIN pages p USING (id))
SELECT 'missing-page' AS rule, CAST(id AS VARCHAR) AS key, '' AS detail FROM j WHERE pid IS NULL
UNION ALL SELECT 'physical_index', CAST(id AS VARCHAR), CAST(pi AS VARCHAR) FROM j WHERE pid IS NOT NULL AND pi <> ppi
UNION ALL SELECT 'status', CAST(id AS VARCHAR), st FROM j WHERE pid IS NOT NULL AND st <> pst
UNION ALL SELECT 'several-batches', CAST(id AS VARCHAR), CAST(count(*) AS VARCHAR) FROM refs GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'orphan', CAST(id AS VARCHAR), '' FROM pages WHERE id NOT IN (SELECT id FROM refs)""")
def batch_integrity(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    refs = docs.select(F.col("doc_id").alias("id"), F.col("n_chars").alias("physical_index"), F.col("lang").alias("status"))
    refs = refs.unionByName(_t(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("physical_index"), F.lit("en").alias("status")))
    pages = docs.where("lang <> 'es'").select(F.col("doc_id").alias("id"), F.col("n_chars").alias("physical_index"), F.when(F.col("source") == "src3", "draft").otherwise(F.col("lang")).alias("status"))
    pages = pages.unionByName(_t(spark, sf_dir, "part").select((-1 - F.col("p_partkey")).alias("id"), F.lit(0).cast("long").alias("physical_index"), F.lit("en").alias("status")))
    return coverage.batch_integrity(refs, pages)


@query("""SELECT l_orderkey, count(*) AS n, min(l_linenumber) AS least, max(l_linenumber) AS greatest, count(DISTINCT l_linenumber) AS distinct_n FROM lineitem GROUP BY l_orderkey HAVING min(l_linenumber) <> 1 OR max(l_linenumber) <> count(*) OR count(DISTINCT l_linenumber) <> count(*)""")
def page_sequence_check(spark, sf_dir):
    return coverage.sequence_gaps(_t(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber", 1)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return coverage.duplicates(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT doc_id, 'only_first' AS side FROM (SELECT doc_id FROM documents EXCEPT SELECT page_id FROM pages) UNION ALL SELECT page_id, 'only_second' FROM (SELECT page_id FROM pages EXCEPT SELECT doc_id FROM documents)""")
def label_difference(spark, sf_dir):
    return coverage.difference(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id")), "doc_id")


@query("""WITH a AS (SELECT conv_id, turn, role FROM conversations), b AS (SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN 'other' ELSE role END AS role FROM conversations WHERE conv_id % 7 <> 3)
SELECT concat(coalesce(a.conv_id, b.conv_id), '/', coalesce(a.turn, b.turn)) AS position, a.role AS first, b.role AS second FROM a FULL JOIN b ON a.conv_id = b.conv_id AND a.turn = b.turn WHERE a.role IS DISTINCT FROM b.role""")
def sequence_equality(spark, sf_dir):
    conv = _t(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat_ws("/", "conv_id", "turn").alias("position"), "role")
    other = conv.where("conv_id % 7 <> 3").withColumn("role", F.when(F.col("turn") % 5 == 4, "other").otherwise(F.col("role")))
    return coverage.same_sequence(conv, other, "position", "role")


# --- book and editions

@query("""WITH c AS (SELECT o_custkey AS id, list_sort(list({'k': l_orderkey, 'n': l_linenumber, 'f': l_returnflag}) FILTER (l_orderkey IS NOT NULL)) AS a FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey)
SELECT id, coalesce(len(a), 0) AS figures, sha256(coalesce(array_to_string(list_transform(a, lambda x: concat(CAST(x.k AS VARCHAR), '-', CAST(x.n AS VARCHAR), ':', x.f)), ','), '')) AS sha FROM c""")
def book_payload(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    parents = orders.select(F.col("o_custkey").alias("id")).distinct()
    children = orders.join(_t(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("id"), "l_orderkey", "l_linenumber", "l_returnflag")
    pages = book.nested(parents, children, "id", ["l_orderkey", "l_linenumber"], "figures")
    one = lambda f: F.concat(f["l_orderkey"].cast("string"), F.lit("-"), f["l_linenumber"].cast("string"), F.lit(":"), f["l_returnflag"])
    return pages.select("id", F.size("figures").cast("long").alias("figures"), F.sha2(F.array_join(F.transform("figures", one), ","), 256).alias("sha"))


@query("""SELECT conv_id, count(*) AS pages, sha256(concat(string_agg(text, concat(chr(10), chr(12), chr(10)) ORDER BY turn), chr(10))) AS sha, true AS equal FROM conversations GROUP BY conv_id""")
def txt_roundtrip(spark, sf_dir):
    from quire.sources import sinks

    conv = _t(spark, sf_dir, "conversations")
    joined = sinks.joined_text(conv, "turn", "text", ["conv_id"])
    again = joined.select("conv_id", "text", F.split(F.regexp_replace("text", r"\n\z", ""), "\n\f\n").alias("pages"))
    truth = conv.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]).alias("own"))
    return again.join(truth, "conv_id").select("conv_id", F.size("pages").cast("long").alias("pages"), F.sha2("text", 256).alias("sha"), (F.col("pages") == F.col("own")).alias("equal"))


_EDITION = """b AS (SELECT doc_id AS id, n_chars AS o, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents),
e AS (SELECT doc_id AS id, CASE WHEN source = 'src5' THEN 0 ELSE n_chars END AS o, trim(regexp_replace(CASE WHEN lang = 'fr' THEN replace(text, 'le', 'la') ELSE text END, '\\s+', ' ', 'g')) AS t FROM documents WHERE source <> 'src2' UNION ALL SELECT -1 - p_partkey, 1, p_name FROM part)"""


@query(f"""WITH {_EDITION}, j AS (SELECT coalesce(b.id, e.id) AS id, b.id AS bi, e.id AS ei, b.o AS bo, e.o AS eo, b.t AS bt, e.t AS et FROM b FULL JOIN e USING (id))
SELECT 'missing-page' AS rule, CAST(id AS VARCHAR) AS key, '' AS detail FROM j WHERE ei IS NULL UNION ALL SELECT 'extra-page', CAST(id AS VARCHAR), '' FROM j WHERE bi IS NULL
UNION ALL SELECT 'order', CAST(id AS VARCHAR), CAST(eo AS VARCHAR) FROM j WHERE bo <> eo UNION ALL SELECT 'text', CAST(id AS VARCHAR), sha256(et) FROM j WHERE bt <> et""")
def edition_equivalence(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    truth = docs.select(F.col("doc_id").alias("id"), F.col("n_chars").alias("physical_index"), "text")
    changed = docs.where("source <> 'src2'").select(F.col("doc_id").alias("id"), F.when(F.col("source") == "src5", F.lit(0)).otherwise(F.col("n_chars")).cast("long").alias("physical_index"), F.when(F.col("lang") == "fr", F.replace("text", F.lit("le"), F.lit("la"))).otherwise(F.col("text")).alias("text"))
    extra = _t(spark, sf_dir, "part").select((-1 - F.col("p_partkey")).alias("id"), F.lit(1).cast("long").alias("physical_index"), F.col("p_name").alias("text"))
    return validate.equivalent(truth, changed.unionByName(extra))


_VALID = """SELECT rule, count(*) AS n FROM (
SELECT 'status' AS rule FROM p WHERE st NOT IN ('draft', 'reviewed', 'verified') UNION ALL SELECT 'not-in-manifest' FROM p WHERE id % 11 = 5 UNION ALL SELECT 'physical-index' FROM p WHERE id % 11 <> 5 AND src = 'src7'
UNION ALL SELECT 'source-hash' FROM p WHERE id % 11 <> 5 AND src = 'src9' UNION ALL SELECT 'layers' FROM p WHERE src = 'src1' UNION ALL SELECT 'file-name' FROM p WHERE id % 13 = 1
UNION ALL SELECT 'notes' FROM p WHERE id % 17 = 2 UNION ALL SELECT 'schema' FROM p WHERE id % 19 = 3) GROUP BY rule"""


@query("WITH p AS (SELECT doc_id AS id, source AS src, CASE WHEN lang = 'de' THEN 'final' ELSE 'verified' END AS st FROM documents) " + _VALID)
def text_page_violations(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    i, source = F.col("doc_id"), F.col("source")
    pages = d.select(i.cast("string").alias("id"), i.cast("int").alias("physical_index"), F.when(F.col("lang") == "de", "final").otherwise("verified").alias("status"), F.sha2("text", 256).alias("source_sha256"), F.when(source != "src1", F.col("text")).alias("diplomatic_text"), F.col("text").alias("normalized_text"), F.when(i % 17 != 2, F.array(F.lit("note"))).alias("notes"), F.when(i % 19 == 3, "v0").otherwise("v1").alias("schema"), F.concat(F.when(i % 13 == 1, "other").otherwise(i.cast("string")), F.lit(".json")).alias("file_name"))
    sources = d.where("doc_id % 11 <> 5").select(i.cast("string").alias("id"), F.when(source == "src7", F.lit(-1)).otherwise(i.cast("int")).alias("physical_index"), F.when(source == "src9", F.lit("?")).otherwise(F.sha2("text", 256)).alias("sha256"))
    return validate.summary(validate.text_pages(pages, sources, "v1"))


@query("""SELECT section, count(*) AS n, count(DISTINCT p_name) AS files, CASE section WHEN 'numbered' THEN 158 WHEN 'atlas' THEN 6 ELSE 4 END AS expected, count(*) = CASE section WHEN 'numbered' THEN 158 WHEN 'atlas' THEN 6 ELSE 4 END AND count(DISTINCT p_name) = count(*) AS equal
FROM (SELECT p_name, CASE WHEN p_size <= 40 THEN 'numbered' WHEN p_size <= 45 THEN 'atlas' ELSE 'paratext' END AS section FROM part) GROUP BY section""")
def release_census(spark, sf_dir):
    section = F.when(F.col("p_size") <= 40, "numbered").when(F.col("p_size") <= 45, "atlas").otherwise("paratext")
    return figures.census_equality(_t(spark, sf_dir, "part").select(F.col("p_name").alias("file"), section.alias("section")), {"numbered": 158, "atlas": 6, "paratext": 4})


# --- census

def _census(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id", "left")
    c = F.col
    feeds = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    d = d.withColumn("n", (feeds % 7).cast("int")).withColumn("c", (2 * F.coalesce("quality", F.lit(0)))).withColumn("class", F.when(F.coalesce("toxic", F.lit(0)) == 1, "unsupported-near-blank").otherwise("normal-text-candidate"))
    d = d.withColumn("type", F.when(c("lang") == "en", "body").when(c("lang") == "fr", "title").when(c("lang") == "de", "cover").otherwise("half-title")).withColumn("notes", F.array(F.when(c("source") == "src7", "Bleed").otherwise("plain")))
    return census.triage(d, n=c("n"), captions=c("c"), page_class=c("class"), page_type=c("type"), atlas=F.contains("text", F.lit(" | ")), edge_risk=F.least(F.lit(4), F.length("text") - F.length(F.replace("text", F.lit("!"), F.lit("")))), notes=c("notes")).withColumn("physical_index", c("doc_id"))


_TRIAGE = """d AS (SELECT doc_id, source, (length(text) - length(replace(text, chr(10), ''))) % 7 AS n, 2 * coalesce(quality, 0) AS c, coalesce(toxic, 0) = 1 AS odd,
CASE lang WHEN 'en' THEN 'body' WHEN 'fr' THEN 'title' WHEN 'de' THEN 'cover' ELSE 'half-title' END AS type, contains(text, ' | ') AS atlas, least(4, length(text) - length(replace(text, '!', ''))) AS k FROM documents LEFT JOIN labels USING (doc_id)),
f AS (SELECT doc_id, list_filter([CASE WHEN odd THEN {'f': 'DOMAIN_UNSUPPORTED', 's': 8} END, CASE WHEN type IN ('title', 'half-title') AND n > 0 THEN {'f': 'TITLE_TYPOGRAPHY_FALSE_POSITIVE_RISK', 's': least(10, 3 + n)} END,
CASE WHEN type = 'cover' AND n > 0 THEN {'f': 'COVER_MIXED_CONTENT_REVIEW', 's': 4} END, CASE WHEN atlas THEN {'f': 'ATLAS_MULTI_DIAGRAM', 's': 0} END, CASE WHEN NOT atlas AND c > 0 AND n = 0 THEN {'f': 'CAPTIONED_FIGURE_MISSED', 's': 12} END,
CASE WHEN NOT atlas AND c > 0 AND n > c THEN {'f': 'ASSET_COUNT_GT_CAPTION_INDEX', 's': least(10, 2 + 2 * (n - c))} END, CASE WHEN NOT atlas AND c > 0 AND n > 0 AND n < c THEN {'f': 'ASSET_COUNT_LT_CAPTION_INDEX', 's': least(10, 4 + 2 * (c - n))} END,
CASE WHEN NOT atlas AND c = 0 AND n > 0 AND type = 'body' THEN {'f': 'UNCAPTIONED_ASSETS_REVIEW', 's': least(8, 2 + n)} END, CASE WHEN k > 0 THEN {'f': 'EDGE_RULE_ARTIFACT_RISK', 's': least(8, 2 + 2 * k)} END,
CASE WHEN n >= 5 THEN {'f': 'EXTREME_ASSET_COUNT', 's': 4} END, CASE WHEN n >= 3 AND n < 5 THEN {'f': 'HIGH_ASSET_COUNT', 's': 2} END, CASE WHEN source = 'src7' THEN {'f': 'RESTORE_BLEED_THROUGH_REFERENCE', 's': 2} END], lambda x: x IS NOT NULL) AS fs FROM d),
t AS (SELECT doc_id, array_to_string(list_transform(fs, lambda x: x.f), ',') AS flags, CAST(coalesce(list_sum(list_transform(fs, lambda x: x.s)), 0) AS BIGINT) AS review_score, fs FROM f)"""


@query(f"WITH {_TRIAGE} SELECT doc_id, flags, review_score FROM t")
def census_triage(spark, sf_dir):
    return _census(spark, sf_dir).select("doc_id", F.array_join("flags", ",").alias("flags"), "review_score")


@query(f"WITH {_TRIAGE} SELECT doc_id, review_score FROM t ORDER BY review_score DESC, doc_id LIMIT 20")
def triage_top(spark, sf_dir):
    """The report's twenty pages to look at first: the limit is the feature."""
    return census.ranked(_census(spark, sf_dir), top=20).select("doc_id", "review_score")


@query(f"WITH {_TRIAGE}, x AS (SELECT unnest(fs).f AS flag FROM t) SELECT flag, count(*) AS n FROM x GROUP BY flag")
def flag_frequency(spark, sf_dir):
    return census.flag_frequency(_census(spark, sf_dir))


@query("""SELECT category, count(*) AS n FROM (SELECT CASE WHEN p_size = 7 THEN 'explicit_remove' WHEN p_brand = 'Brand#1' THEN 'paratext' WHEN p_type IN (SELECT p_type FROM part WHERE p_partkey = 1) THEN 'atlas' WHEN p_size > 30 THEN 'numbered' ELSE 'removed' END AS category FROM part) GROUP BY category""")
def review_categories(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    policies = part.where("p_partkey = 1").select("p_type").distinct().withColumn("atlas", F.lit(True))
    c = F.col
    rows = part.join(policies, "p_type", "left")
    category = census.review_category(c("p_partkey"), c("p_partkey"), c("p_size") == 7, c("p_brand") == "Brand#1", c("atlas"), c("p_size") > 30)
    return score.status_counts(rows.select(category.alias("category")), "category")


# --- figures and geometry

#: All parts, dealt to the three sources; some direct labels repeat a logical one, some manual ones replace one.
_PART_VIEWS = """lo AS (SELECT CAST(p_partkey AS VARCHAR) AS label, concat(CASE WHEN p_size >= 40 THEN 'P' ELSE 'L' END, p_partkey // 3) AS page_id, p_name AS file FROM part WHERE p_partkey % 3 = 1),
di AS (SELECT CAST(CASE WHEN p_size < 10 THEN p_partkey - 1 ELSE p_partkey END AS VARCHAR) AS label, concat('P', p_partkey // 3) AS page_id, p_name AS file FROM part WHERE p_partkey % 3 = 2 AND concat('P', p_partkey // 3) NOT IN (SELECT page_id FROM lo)),
ma AS (SELECT CAST(CASE WHEN p_size < 20 THEN p_partkey + 1 ELSE p_partkey END AS VARCHAR) AS label, concat('M', p_partkey // 3) AS page_id, p_name AS file FROM part WHERE p_partkey % 3 = 0), base AS (SELECT *, 'logical' AS c FROM lo UNION ALL SELECT *, 'direct' FROM di),
err AS (SELECT label, count(*) AS n FROM base GROUP BY label HAVING count(*) > 1), allr AS (SELECT *, 1 AS p FROM base WHERE label NOT IN (SELECT label FROM err) UNION ALL SELECT *, 'manual', 0 FROM ma)"""


def _precedence(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = _t(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    view = lambda of, label, page: part.where(k % 3 == of).select(label.cast("string").alias("label"), F.concat(page, F.floor(k / 3).cast("string")).alias("page_id"), F.col("p_name").alias("file"))
    logical = view(1, k, F.when(size >= 40, "P").otherwise("L"))
    return figures.by_precedence(logical, view(2, F.when(size < 10, k - 1).otherwise(k), F.lit("P")), view(0, F.when(size < 20, k + 1).otherwise(k), F.lit("M")))


@query(f"WITH {_PART_VIEWS} SELECT label, page_id, file, c AS source_category FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY p, label, page_id, file) AS rn FROM allr) WHERE rn = 1")
def source_precedence(spark, sf_dir):
    return _precedence(spark, sf_dir)[0]


@query(f"WITH {_PART_VIEWS} SELECT label, n FROM err")
def source_conflicts(spark, sf_dir):
    return _precedence(spark, sf_dir)[1]


@query("""WITH f AS (SELECT CAST(p_partkey AS VARCHAR) AS label, CASE p_partkey % 3 WHEN 0 THEN 'logical' WHEN 1 THEN 'manual' ELSE 'direct' END AS cat, p_brand AS page, p_size AS x FROM part)
SELECT label, cat AS source_category, CASE WHEN CAST(label AS INT) % 50 = 0 THEN 'override-page' WHEN cat = 'logical' THEN CASE WHEN x > 10 THEN concat('L', page) END WHEN cat = 'manual' AND x > 20 THEN concat('M', page) ELSE page END AS placed_page,
CASE WHEN CAST(label AS INT) % 50 = 0 THEN 1 WHEN cat = 'logical' THEN CASE WHEN x > 10 THEN x END WHEN cat = 'manual' AND x > 20 THEN x + 3 ELSE x + 100 END AS x1,
CASE WHEN CAST(label AS INT) % 50 = 0 THEN 'override' WHEN cat = 'logical' THEN 'composition' WHEN cat = 'manual' AND x > 20 THEN 'manual-asset' ELSE 'detected' END AS evidence, cat = 'logical' AND x <= 10 AND CAST(label AS INT) % 50 <> 0 AS review FROM f""")
def placement_resolution(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    c = F.col
    label, none = c("p_partkey").cast("string"), F.lit(None).cast("string")
    at = lambda x: G.box(x, x, x + 10, x + 10)
    category = F.when(c("p_partkey") % 3 == 0, "logical").when(c("p_partkey") % 3 == 1, "manual").otherwise("direct")
    figs = part.select(label.alias("label"), none.alias("id"), category.alias("source_category"), F.lit("figure").alias("kind"), c("p_brand").alias("page_id"), at(c("p_size") + 100).alias("bbox"))
    logical = part.where("p_partkey % 3 = 0 AND p_size > 10").select(F.array(label).alias("figure_labels"), F.concat(F.lit("L"), "p_brand").alias("page_id"), at(c("p_size")).alias("union_bbox"))
    manual = part.where("p_partkey % 3 = 1 AND p_size > 20").select(label.alias("label"), none.alias("id"), F.concat(F.lit("M"), "p_brand").alias("page_id"), at(c("p_size")).alias("base_bbox"), F.lit(3).alias("trim_x"), F.lit(None).cast("int").alias("trim_y"))
    overrides = part.where("p_partkey % 50 = 0").select(label.alias("label"), F.lit("override-page").alias("page_id"), at(F.lit(1)).alias("asset_bbox"))
    out = figures.placements(figs, logical, manual, overrides)
    return out.select("label", "source_category", "placed_page", F.col("placed_box.x1").alias("x1"), "evidence", F.col("requires_visual_placement_review").alias("review"))


_BOXES = "SELECT l_orderkey, l_linenumber, CAST(l_partkey % 400 AS INT) AS x1, CAST(l_suppkey % 400 AS INT) AS y1, CAST(l_partkey % 400 + l_quantity AS INT) AS x2, CAST(l_suppkey % 400 + 10 + 9 * l_linenumber AS INT) AS y2 FROM lineitem"


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    x, y = (c("l_partkey") % 400).cast("int"), (c("l_suppkey") % 400).cast("int")
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", G.box(x, y, (c("l_partkey") % 400 + c("l_quantity")).cast("int"), (y + 10 + 9 * c("l_linenumber")).cast("int")).alias("bbox"))


@query(f"WITH b AS ({_BOXES}) SELECT l_orderkey, p.l_linenumber AS a, q.l_linenumber AS b FROM b p JOIN b q USING (l_orderkey) WHERE p.l_linenumber < q.l_linenumber AND greatest(p.x1, q.x1) < least(p.x2, q.x2) AND greatest(p.y1, q.y1) < least(p.y2, q.y2)")
def bbox_overlap_pairs(spark, sf_dir):
    return figures.overlapping_pairs(_boxes(spark, sf_dir), ["l_orderkey"], "l_linenumber")


@query(f"WITH b AS ({_BOXES}) SELECT l_orderkey, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2, count(*) AS parts FROM b GROUP BY l_orderkey")
def bbox_union(spark, sf_dir):
    return figures.union_box(_boxes(spark, sf_dir), ["l_orderkey"]).select("l_orderkey", "union_bbox.*", "parts")


@query(f"""WITH b AS ({_BOXES}), u AS (SELECT l_orderkey, min(x1) AS ux, min(y1) AS uy FROM b GROUP BY l_orderkey) SELECT l_orderkey, l_linenumber, x1 - ux + 2 AS offset_x, y1 - uy + 2 AS offset_y FROM b JOIN u USING (l_orderkey)""")
def composition_offsets(spark, sf_dir):
    return figures.part_offsets(_boxes(spark, sf_dir), "l_orderkey", "bbox", 2).select("l_orderkey", "l_linenumber", "offset_x", "offset_y")


@query(f"""WITH b AS ({_BOXES}) SELECT l_orderkey, l_linenumber, round_even((x2 - x1) * (y2 - y1) / 360000, 6) AS area_fraction, round_even(greatest(x2 - x1, y2 - y1) / greatest(1, least(x2 - x1, y2 - y1)), 3) AS aspect, x1 <= 6 OR y1 <= 6 OR x2 >= 594 OR y2 >= 594 AS edge FROM b""")
def asset_geometry(spark, sf_dir):
    rows = _boxes(spark, sf_dir).withColumn("width", F.lit(600)).withColumn("height", F.lit(600))
    return census.asset_geometry(rows).select("l_orderkey", "l_linenumber", F.col("bbox_area_fraction").alias("area_fraction"), F.col("aspect_ratio_long_over_short").alias("aspect"), F.col("touches_page_edge_1pct").alias("edge"))


_COMPONENTS = "SELECT p_partkey // 100 AS page_id, CAST(p_partkey AS INT) AS label, CAST(p_partkey * 37 % 700 AS INT) AS x, CAST(p_partkey * 91 % 700 AS INT) AS y, CAST(5 + p_size % 20 AS INT) AS w, CAST(5 + p_size * 7 % 30 AS INT) AS h FROM part"


def _components(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    k = c("p_partkey")
    rows = _t(spark, sf_dir, "part").select(F.floor(k / 100).alias("page_id"), k.cast("int").alias("label"), (k * 37 % 700).cast("int").alias("x"), (k * 91 % 700).cast("int").alias("y"), (5 + c("p_size") % 20).cast("int").alias("w"), (5 + c("p_size") * 7 % 30).cast("int").alias("h"))
    return rows.withColumn("area", c("w") * c("h")).withColumn("cx", c("x") + c("w") / 2.0).withColumn("cy", c("y") + c("h") / 2.0)


_NEIGHBOURS = f"""c AS ({_COMPONENTS}), n AS (SELECT page_id, a.label AS a, b.label AS b, greatest(0, a.x - b.x - b.w, b.x - a.x - a.w) AS dx, greatest(0, a.y - b.y - b.h, b.y - a.y - a.h) AS dy,
greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) / least(a.w, b.w) AS xr, greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) / least(a.h, b.h) AS yr FROM c a JOIN c b USING (page_id) WHERE a.label < b.label)"""


@query(f"WITH {_NEIGHBOURS} SELECT page_id, a, b, CAST(dx AS DOUBLE) AS dx, CAST(dy AS DOUBLE) AS dy, xr AS x_overlap_ratio, yr AS y_overlap_ratio FROM n WHERE dx * dx + dy * dy <= 1600")
def neighbor_graph(spark, sf_dir):
    return graph.neighbours(_components(spark, sf_dir), 40).drop("gap")


@query(f"""WITH RECURSIVE {_NEIGHBOURS}, e AS (SELECT page_id, a, b, dx + dy AS cost FROM n WHERE dx * dx + dy * dy <= 1600 UNION ALL SELECT page_id, b, a, dx + dy FROM n WHERE dx * dx + dy * dy <= 1600),
r(page_id, node, dist, owner) AS (SELECT page_id, label, 0, label FROM c WHERE label % 10 = 0 UNION SELECT r.page_id, e.b, r.dist + e.cost, r.owner FROM r JOIN e ON e.page_id = r.page_id AND e.a = r.node WHERE r.dist + e.cost <= 60)
SELECT page_id, node, CAST(min(dist) AS DOUBLE) AS dist, arg_min(owner, dist * 1000000 + owner) AS owner FROM r GROUP BY page_id, node""")
def seed_growth(spark, sf_dir):
    parts = _components(spark, sf_dir)
    edges = graph.neighbours(parts, 40)
    costs = graph.both_ways(edges).select("page_id", "src", "dst", (F.col("dx") + F.col("dy")).alias("cost"))
    return graph.grow(costs, parts.where("label % 10 = 0"), 60.0)


@query("""WITH m AS (SELECT l_suppkey, median(l_extendedprice) AS m FROM lineitem GROUP BY l_suppkey), d AS (SELECT l_suppkey, any_value(m) AS m, median(abs(l_extendedprice - m)) AS d FROM lineitem JOIN m USING (l_suppkey) GROUP BY l_suppkey)
SELECT l_suppkey, count(*) AS n, count(*) FILTER ((l_extendedprice - m) / greatest(0.15, 1.4826 * d) > 1.5) AS outliers FROM lineitem JOIN d USING (l_suppkey) GROUP BY l_suppkey""")
def robust_outliers(spark, sf_dir):
    """A page's components are a group of bounded size; here the lines of a supplier are."""
    rows = graph.robust_z(_t(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice"), ["l_suppkey"], "l_extendedprice")
    return rows.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.count_if(F.col("z") > 1.5).alias("outliers"))


@query("""WITH h AS (SELECT p_brand, p_size AS h, count(*) AS w FROM part GROUP BY ALL), t AS (SELECT unnest([-2, -1, 0, 1, 2]) AS d, unnest([1, 2, 3, 2, 1]) AS t), s AS (SELECT p_brand, hd AS h, sum(w * t) / 9 AS smooth FROM (SELECT p_brand, h + d AS hd, w, t FROM h, t) WHERE hd >= 4 GROUP BY p_brand, hd)
SELECT p_brand, h AS mode, smooth FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY smooth DESC, h) AS rn FROM s) WHERE rn = 1""")
def height_mode(spark, sf_dir):
    return graph.height_mode(_t(spark, sf_dir, "part"), ["p_brand"], "p_size", None)


# --- flow

@query(r"""WITH b AS (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(replace(text, chr(10), concat(chr(10), chr(10))), '^\n+|\n+$', '', 'g'), '\n\s*\n'), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g')) <> '') AS bs FROM documents),
t AS (SELECT doc_id, generate_subscripts(bs, 1) - 1 AS k, 1 AS o, 0 AS y, 'text' AS kind, unnest(bs) AS content FROM b),
f AS (SELECT doc_id, least(len(bs), greatest(0, CAST(round_even(least(1, (200 * quality + 37 * toxic + 100) / 1000) * len(bs), 0) AS INT))) AS k, 0 AS o, 100 * quality AS y, 'figure' AS kind, concat('figures/', CAST(doc_id AS VARCHAR), '.png') AS content FROM labels JOIN b USING (doc_id))
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k, o, y) - 1 AS seq, kind, sha256(content) AS sha FROM (SELECT * FROM t UNION ALL SELECT * FROM f)""")
def page_flow(spark, sf_dir):
    pages = _t(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"), F.lit(1000).alias("height"))
    c = F.col
    figs = _t(spark, sf_dir, "labels").select("doc_id", F.lit(None).cast("string").alias("label"), F.lit(1).alias("asset_index"), (100 * c("quality")).alias("y1"), (300 * c("quality") + 74 * c("toxic") + 200).alias("y2"), F.concat(F.lit("figures/"), c("doc_id").cast("string"), F.lit(".png")).alias("file"))
    return flow.page_flow(pages, figs, "doc_id").select("doc_id", F.col("seq").cast("long").alias("seq"), "kind", F.sha2("content", 256).alias("sha"))


@query("""WITH b AS (SELECT l_orderkey, CAST(l_partkey % 500 AS DOUBLE) AS a, CAST(l_partkey % 500 AS DOUBLE) + l_quantity AS b FROM lineitem), u AS (SELECT * FROM b UNION ALL SELECT DISTINCT l_orderkey, 604.0, 604.0 FROM lineitem),
p AS (SELECT l_orderkey, greatest(0.0, coalesce(max(b + 4) OVER (PARTITION BY l_orderkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS low, least(600.0, a - 4) AS high FROM u)
SELECT l_orderkey, count(*) FILTER (high - low >= 54) AS pieces, coalesce(max(high - low) FILTER (high - low >= 54), 0.0) AS widest FROM p GROUP BY l_orderkey""")
def free_intervals(spark, sf_dir):
    a = (F.col("l_partkey") % 500).cast("double")
    blockers = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(a.alias("a"), (a + F.col("l_quantity")).alias("b"))).alias("b"))
    pieces = blockers.select("l_orderkey", G.free_intervals(F.lit(0.0), F.lit(600.0), F.col("b")).alias("p"))
    best = G.widest(F.col("p"))
    return pieces.select("l_orderkey", F.size("p").cast("long").alias("pieces"), F.coalesce(best["b"] - best["a"], F.lit(0.0)).alias("widest"))


