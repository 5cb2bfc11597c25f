"""Operators on small cases: figures, graph, images, sources, sinks, validation."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import book, census, coverage, figures, flow, graph, images, score, validate
from quire.sources import readers, sinks


def test_sources(spark, tmp_path):
    for engine, page, text in (("rus", "sheet-001-left", "x"), ("rus", "sheet-001-right", ""), ("orus", "sheet-001-left", "y\nz")):
        (tmp_path / "ocr" / engine).mkdir(parents=True, exist_ok=True)
        (tmp_path / "ocr" / engine / f"{page}.txt").write_text(text)
    rows = {(r["engine"], r["page_id"]): r["text"] for r in readers.ocr_pages(spark, f"file://{tmp_path}/ocr").collect()}
    assert rows == {("rus", "sheet-001-left"): "x", ("rus", "sheet-001-right"): "", ("orus", "sheet-001-left"): "y\nz"}
    (tmp_path / "m.json").write_text(json.dumps({"schema": "s", "records": [{"id": "a", "physical_index": 1, "other": 2}, {"id": "b"}]}))
    assert [(r["id"], r["physical_index"]) for r in readers.records(spark, f"file://{tmp_path}/m.json", "source_pages").orderBy("id").collect()] == [("a", 1), ("b", None)]
    assert readers.benchmark_ids(spark, f"file://{tmp_path}/none.json").count() == 0
    listed = spark.createDataFrame([("p", [{"asset_index": None, "v": 5}, {"asset_index": 9, "v": 6}])], "page string, assets array<struct<asset_index:int,v:int>>")
    assert [tuple(r) for r in readers.with_positions(listed, "assets").orderBy("v").collect()] == [("p", 1, 5), ("p", 9, 6)]
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08\x00\x10\x00\x20\x03abc"
    assert tuple(spark.createDataFrame([(jpeg,)], "c binary").select(readers.jpeg_size("c").alias("s")).first()["s"]) == (32, 16)
    assert spark.range(1).select(readers.pdf_pages(F.lit("Title: x\nPages:          300\n")).alias("n")).first()["n"] == 300


def test_sinks(spark):
    pages = spark.createDataFrame([(2, "b"), (1, "a"), (3, "")], "physical_index int, text string")
    assert sinks.joined_text(pages).first()["text"] == "a\n\f\nb\n\f\n\n"
    epub = sinks.epub_edition("T", "id", [("p1", "<p>a &amp; b</p>"), ("p2", "<p>c</p>")], {"images/x.png": b"1"})
    assert epub == sinks.epub_edition("T", "id", [("p1", "<p>a &amp; b</p>"), ("p2", "<p>c</p>")], {"images/x.png": b"1"})
    assert [(i, " ".join(t.split())[2:]) for i, t in sinks.epub_pages(epub)] == [("p1", "a & b"), ("p2", "c")]
    assert epub[30:38] == b"mimetype"
    assert list(sinks.fb2_pages(sinks.fb2_edition("T", [("s1", ["a", "b"], ["i.png"])], {"i.png": b"x"}))) == [("s1", "a\nb")]
    assert sinks.archive([("b", b"2"), ("a", b"1")]) == sinks.archive([("a", b"1"), ("b", b"2")])
    flat = sinks.flat_columns(spark.createDataFrame([([1, 2], True)], "a array<int>, b boolean")).first()
    assert tuple(flat) == ("1;2", 1)
    assert json.loads(sinks.manifest({"schema": "s"}, pages.orderBy("physical_index")))["records"][0] == {"physical_index": 1, "text": "a"}


def test_scores(spark):
    runs = spark.createDataFrame([("a", "кот идет", "котидет", 1.0), ("a", "", "x", 2.0), ("b", "дом", "дом", 3.0)], "engine string, gt string, pred string, seconds double")
    scored = score.with_operations(score.score_text(runs, nfc=True))
    s = {r["engine"]: r for r in score.summary(scored, ["engine"], 600).collect()}
    assert (s["a"]["content_edit_distance"], s["a"]["gt_chars_content"], s["a"]["cer_content"]) == (2, 8, 2 / 8)
    assert (s["a"]["merged_word_boundaries"], s["a"]["insertions"], s["a"]["word_edit_distance"]) == (1, 1, 3)
    assert s["b"]["projected_minutes"] == 30.0
    glyphs = score.glyph_counts(scored, ["engine"], ["о", "д"], "gt_content", "pred_content", "edit_ops")
    assert {(r["engine"], r["glyph"]): (r["gt"], r["correct"]) for r in glyphs.where("gt > 0").collect()} == {("a", "о"): (1, 1), ("a", "д"): (1, 1), ("b", "о"): (1, 1), ("b", "д"): (1, 1)}
    none = score.family_recall(glyphs, {"o": "о", "z": "д"}, ["engine"]).where("engine = 'a'")
    assert all(0 <= r["recall"] <= 1 for r in none.collect() if r["recall"] is not None)


def test_coverage(spark):
    df = spark.createDataFrame([(i,) for i in (5, 3, 9, 1)], "x int")
    assert [(r["x"], r["position"]) for r in coverage.numbered(df, ["x"]).orderBy("x").collect()] == [(1, 1), (3, 2), (5, 3), (9, 4)]
    with pytest.raises(ValueError):
        coverage.batch_slice(df, 5, 1, 4, "x")
    refs = spark.createDataFrame([], "id string, physical_index int, status string")
    pages = spark.createDataFrame([("a", 1, "x")], "id string, physical_index int, status string")
    assert coverage.batch_integrity(refs, pages).count() == 0  # no batch, no orphan


def components(spark, rows):
    df = spark.createDataFrame([("p", i, *r) for i, r in enumerate(rows, 1)], "page_id string, label int, x int, y int, w int, h int")
    return df.withColumn("area", F.col("w") * F.col("h")).withColumn("cx", F.col("x") + F.col("w") / 2.0).withColumn("cy", F.col("y") + F.col("h") / 2.0)


def test_neighbours_keep_long_boxes(spark):
    found = graph.neighbours(components(spark, [(10, 10, 300, 5), (312, 12, 3, 3), (400, 400, 5, 5)]), 5).collect()
    assert [(r["a"], r["b"], r["gap"]) for r in found] == [(1, 2, 2.0)]


def test_growth_prefers_smaller_owner(spark):
    costs = spark.createDataFrame([("p", a, b, c) for a, b, c in ((1, 2, 1.0), (3, 2, 1.0), (2, 4, 1.0), (4, 5, 9.0))], "page_id string, src int, dst int, cost double")
    sources = spark.createDataFrame([("p", 3), ("p", 1)], "page_id string, label int")
    assert {r["node"]: (r["dist"], r["owner"]) for r in graph.grow(costs, sources, 5.0).collect()} == {1: (0.0, 1), 3: (0.0, 3), 2: (1.0, 1), 4: (2.0, 1)}


def test_overlap_alone_does_not_group(spark):
    regions = spark.createDataFrame([("p", 1, 100), ("p", 2, 100), ("p", 3, 10)], "page_id string, owner int, area int")
    none = spark.createDataFrame([], "page_id string, r1 int, r2 int, cap_height double, gap double, axis double, close long, area_ratio double")
    assert {r["owner"]: r["family"] for r in graph.agglomerate(none, regions).collect()} == {1: 1, 2: 2, 3: 3}
    near = spark.createDataFrame([("p", 1, 3, 10.0, 5.0, 0.5, 1, 0.1)], none.schema)
    assert {r["owner"]: r["family"] for r in graph.agglomerate(near, regions).collect()} == {1: 1, 2: 2, 3: 1}


def test_page_scores(spark):
    row = [(20 + 14 * i, 100 + 60 * r, 9, 10) for r in range(2) for i in range(12)] + [(20, 300, 200, 150)]  # a page of fewer than 20 letters has no model
    parts = components(spark, row)
    scale = spark.createDataFrame([("p", 10.0, 2.0)], "page_id string, cap_height double, stroke double")
    scored = graph.text_scores(graph.line_support(parts), scale)
    by = {r["label"]: r for r in scored.collect()}
    assert by[6]["text_score"] > 0.8 and by[25]["text_score"] == 0.0 and by[6]["line_support"] > 0.9
    seeded = {r["label"]: r["is_seed"] for r in graph.seeds(scored, scale).collect()}
    assert seeded[25] and not any(v for k, v in seeded.items() if k != 25)


def test_figures(spark):
    kind = "label string, page_id string, file string"
    logical, direct, manual = (spark.createDataFrame(rows, kind) for rows in ([("1", "a", "l1"), ("2", "b", "l2")], [("3", "a", "d3"), ("4", "c", "d4"), ("2", "d", "d2")], [("4", "z", "m4")]))
    kept, errors = figures.by_precedence(logical, direct, manual)
    assert {r["label"]: r["file"] for r in kept.collect()} == {"1": "l1", "4": "m4"}
    assert [tuple(r) for r in errors.collect()] == [("2", 2)]
    assert figures.universe(spark).count() == 158
    assert [r["label"] for r in figures.natural_order(spark.createDataFrame([("10",), ("9bis",), ("9",)], "label string")).collect()] == ["9", "9bis", "10"]
    zipped, odd = figures.zip_by_position(spark.createDataFrame([("a", 2), ("a", 1), ("b", 1)], "page string, l int"), spark.createDataFrame([("a", "x"), ("a", "y")], "page string, r string"), "page", ["l"], ["r"])
    assert [(r["l"], r["r"]) for r in zipped.orderBy("l").collect()] == [(1, "x"), (2, "y")]
    assert [tuple(r) for r in odd.collect()] == [("b", 1, 0)]


def test_compositions(spark):
    box = "struct<x1:int,y1:int,x2:int,y2:int>"
    kind = f"id string, part int, page_id string, asset_index int, clip {box}, asset {box}, output string"
    good = spark.createDataFrame([("c", 1, "p", 1, None, (5, 7, 9, 10), "c.png"), ("c", 2, "p", 2, None, (6, 13, 9, 15), "c.png")], kind)
    assert figures.composition_violations(good).count() == 0
    offsets = figures.part_offsets(good.withColumnRenamed("asset", "bbox"), "id").orderBy("part").collect()
    assert [(r["offset_x"], r["offset_y"], tuple(r["union_bbox"])) for r in offsets] == [(0, 0, (5, 7, 9, 15)), (1, 6, (5, 7, 9, 15))]
    bad = spark.createDataFrame([("d", 1, "p", 1, (0, 0, 5, 5), (0, 0, 9, 9), "../x.png"), ("d", 2, "p", 1, (4, 4, 8, 8), (0, 0, 9, 9), "../x.png"), ("e", 3, "p", 2, (0, 0, 20, 5), (0, 0, 9, 9), "e.png")], kind)
    assert {r["rule"] for r in figures.composition_violations(bad).collect()} == {"unsafe-path", "overlapping-windows", "clip-outside-asset"}


def test_images(spark):
    mask = np.zeros((12, 20), bool)
    mask[1:4, 1:4] = mask[4, 4] = True  # touching by a corner
    mask[8:10, 10:18] = True
    labels, n = images.label(mask)
    assert n == 2
    assert [r[:6] for r in images.component_rows(labels, n)] == [(1, 1, 1, 4, 4, 10), (2, 10, 8, 8, 2, 16)]
    red = np.zeros((2, 2, 4), np.uint8)
    red[..., 2] = 255
    red[0, 0, 3] = 255
    out = images.compose([(red, 1, 1)], 4, 4)
    assert out[1, 1].tolist() == [0, 0, 255, 255] and out[2, 2].tolist() == [255, 255, 255, 255]
    assert images.rgba_problem(red) == "transparent-not-white" and images.rgba_problem(out) is None
    with pytest.raises(ValueError):
        images.compose([(red, 3, 3)], 4, 4)
    page = np.full((60, 80, 1), 250, np.uint8)
    page[20:40, 30:34] = 10
    frame = spark.createDataFrame([("o", 60, 80, 1, 0, bytearray(page.tobytes()))], "origin string, height int, width int, nChannels int, mode int, data binary")
    assert [tuple(r)[2:6] for r in images.components(frame).collect()] == [(30, 20, 4, 20)]
    assert images.statistics(frame).first()["near_white_fraction"] > 0.9
    halves = {r["side"]: r["width"] for r in readers.split_spread(spark.createDataFrame([("o", 2, 5, 1, 0, bytearray(range(10)))], frame.schema)).collect()}
    assert halves == {"left": 2, "right": 3}
    assert images.presets(frame).count() == len(images.PRESETS) == 6


def test_validation(spark):
    texts = spark.createDataFrame([("a", 1, "verified", "body", "h1", "b", "текст", "текст домъ", ["n"], "s", "a.json"), ("b", 2, "verified", "body", "h2", "b", "x", "вѣра", None, "s", "c.json")], "id string, physical_index int, status string, page_type string, source_sha256 string, editorial_batch string, diplomatic_text string, normalized_text string, notes array<string>, schema string, file_name string")
    sources = spark.createDataFrame([("a", 1, "h1", 750, 1200, 5), ("b", 3, "h2", 750, 1200, 6)], "id string, physical_index int, sha256 string, width int, height int, printed_page int")
    found = {(r["rule"], r["key"]) for r in validate.text_pages(texts, sources, "s").collect()}
    assert found == {("final-hard-sign", "a"), ("file-name", "b"), ("physical-index", "b"), ("notes", "b"), ("prereform-glyph", "b")}
    figs = spark.createDataFrame([("a", "figure", "2", None, "f2", "h", [0, 50, 9, 60], 1), ("a", "figure", "1", None, "f1", "h", [0, 5, 9, 20], 2)], "page_id string, kind string, label string, id string, file string, sha256 string, asset_bbox array<int>, asset_index int")
    pages = book.book_pages(texts, sources, figs, "normalized")
    assert [[f["file"] for f in r["figures"]] for r in pages.orderBy("id").collect()] == [["f1", "f2"], []]
    assert {r["rule"] for r in validate.release_gates(pages, 2, 3).collect()} == {"page-problem", "figure-count"}
    with pytest.raises(validate.ViolationError):
        validate.require(validate.release_gates(pages, 2, 3))
    assert validate.repair(texts).collect()[0]["found"] == 1
    assert validate.repair(texts, write=True).orderBy("id").first()["normalized_text"] == "текст дом"


def test_figures_of_editions_and_releases(spark):
    kind = "id string, physical_index int, text string, status string, problem string, figures array<struct<file string, sha256 string>>"
    page = lambda i, *figs: (str(i), i, "t", "verified", None, list(figs) or None)
    a, b, x = ("a", "1"), ("b", "2"), ("x", "3")
    one = spark.createDataFrame([page(1, a, b), page(2, a, b), page(3, a, b), page(4), page(5, a), page(6, a)], kind)
    two = spark.createDataFrame([page(1, a, b), page(2, b, a), page(3, a), page(4, x), page(5, ("a", "9"))], kind)
    got = {(r["rule"], r["key"]) for r in validate.equivalent(one, two, figures="figures").collect()}
    assert got == {("figure-order", "2"), ("figure-inventory", "3"), ("figure-inventory", "4"), ("figure-hash", "5"), ("missing-page", "6")}
    assert {(r["rule"], r["key"]) for r in validate.equivalent(one, two).collect()} == {("missing-page", "6")}
    assets, versions = spark.createDataFrame([("a",), ("b",), ("x",)], "file string"), {"diplomatic": "1.0.0"}
    rules = lambda **more: {(r["rule"], r["key"]) for r in validate.release_gates(one, 6, 8, versions=versions, **more).collect()}
    assert rules(release=("diplomatic", "1.0.0")) == set()
    assert rules(release=("diplomatic", "1.1.0")) == rules(release=("other", "1.0.0")) == {("edition-version", "book")}
    assert rules(assets=assets) == {("supplementary", "x"), ("asset-count", "book")}


def test_flow_and_html(spark):
    pages = spark.createDataFrame([("a", "one\n\ntwo <b>", 100)], "page_id string, text string, height int")
    figs = spark.createDataFrame([("a", "1", 1, 40, 60, "figures/1.png")], "page_id string, label string, asset_index int, y1 int, y2 int, file string")
    rows = flow.page_flow(pages, figs)
    assert [(r["kind"], r["content"]) for r in rows.orderBy("seq").collect()] == [("text", "one"), ("figure", "figures/1.png"), ("text", "two <b>")]
    html = flow.html_page(rows)
    assert html.select(flow.html_text(F.col("html")).alias("t")).first()["t"] == "one two <b>"
    hidden = flow.with_facsimiles(pages.withColumnRenamed("page_id", "id"), spark.createDataFrame([("a",)], "id string"))
    assert hidden.first()["text"] == "" and hidden.first()["facsimile"]


def test_census(spark):
    asset = "struct<asset_index:int,bbox_area_fraction:double,aspect_ratio_long_over_short:double,touches_page_edge_1pct:boolean>"
    probe = spark.createDataFrame([("a", 1, "normal-text-candidate", [(1, 0.01, 9.0, True)]), ("b", 2, "normal-text-candidate", None)], f"id string, physical_index int, page_class string, assets array<{asset}>")
    texts = spark.createDataFrame([("a", "body", "слово", ["штамп"]), ("b", "body", "147 ФИГ.", None)], "id string, page_type string, text string, notes array<string>")
    rows = {r["id"]: (r["flags"], r["review_score"]) for r in census.census(probe, texts).collect()}
    assert rows["a"] == (["UNCAPTIONED_ASSETS_REVIEW", "EDGE_RULE_ARTIFACT_RISK", "PROVENANCE_MARK_FALSE_POSITIVE_RISK"], 3 + 4 + 6)
    assert rows["b"] == (["CAPTIONED_FIGURE_MISSED"], 12)


def test_masks():
    ring = np.zeros((80, 80), bool)
    ring[10:70, 10:14] = ring[10:70, 66:70] = ring[10:14, 10:70] = ring[66:70, 10:70] = True
    gap = ring.copy()
    gap[10:14, 38:42] = False
    hard, alpha, scale = images.territory(gap, 4.0)
    assert scale is not None and hard[40, 40] and alpha[40, 40] == 255 and alpha[0, 0] == 0
    u = ring.copy()
    u[10:14, 18:62] = False  # an open U stays open
    hard, _, scale = images.territory(u, 4.0)
    assert scale is None and not hard[40, 40]
    away = images.distance_to(ring)
    assert away[40, 40] == 26 and away[0, 10] == 10
    page = np.full((80, 100), 250, np.uint8)
    page[40:42, 10:40], page[40:42, 40:70], page[10:20, 80:90] = 20, 180, 180
    strong = page == 20
    found = images.recover_weak(page, np.full_like(page, 250), strong, (0, 0, 100, 80), 2.0, threshold=0.2)
    assert found[41, 60] and not found[15, 85]
    labels, _ = images.label(page < 240)
    boxes = {r[0]: r[3:6] for r in images.component_rows(labels, labels.max())}
    core = {int(labels[41, 20])}
    kept, gone = images.prune_isolated(page < 240, labels, core, boxes, 10.0)
    assert gone == [int(labels[15, 85])] and not kept[15, 85] and kept[41, 20]
    rgba = images.sticker(page, np.full_like(page, 250), images.largest_cluster(images.without_small(page < 240, 5), 3))
    cut, box = images.trim(rgba)
    assert images.rgba_problem(rgba) is None and box[1] > 25 and cut.shape[2] == 4
    assert not images.erase(page < 240, (0, 0, 100, 80), [(80, 10, 90, 20)])[15, 85]


def test_resumed_runs(spark):
    from quire.functions.store import materialize
    from quire.operators import run

    inputs = spark.createDataFrame([("m", f"s{i}", f"p{i}") for i in range(6)] + [("bad", "s0", "p")], "model string, sample_id string, path string")
    before = spark.createDataFrame([("m", "s0", "old", 1.0)], "model string, sample_id string, prediction string, seconds double")

    def call(model, pages):
        if model == "bad":
            raise run.LoadError("no such model")
        if len(pages) > 1 and any(s == "s3" for s, _ in pages):
            return {s: p for s, p in pages if s != "s3"}  # lost within a batch, found alone
        return dict(pages)

    done, incidents, account = run.run_resumed(inputs.coalesce(1), before, call, materialize)
    assert {(r["model"], r["sample_id"]): r["prediction"] for r in done.collect()} == {("m", "s0"): "old"} | {("m", f"s{i}"): f"p{i}" for i in range(1, 6)}
    assert {(r["model"], r["sample_id"]): r["incident"] for r in incidents.collect()} == {("m", "s3"): "no output", ("bad", "s0"): "no such model"}
    assert tuple(account.first()) == (7, 1, 5, 6, 1)


def test_scoring_is_spread_over_tasks(spark):
    """Pages of a file of one split are scored by several tasks, all of them."""
    from quire.plans import catalog
    from tests.conftest import SF

    for name in ("ocr_engine_summary", "ocr_score_pages", "ocr_word_errors", "best_config"):
        plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "RoundRobinPartitioning" in plan and "ArrowEvalPython" in plan and "levenshtein" not in plan, name


def test_strict_and_content_distances(spark):
    """Blanks count in the strict form only; where both forms are the same, so are the distances."""
    rows = [(1, "one  two\nthree", "one two\nthree"), (2, "one two\nthree", "one two three"), (3, "one\ntwo\nthrew", "one\ntvo\nthre"), (4, "one two", "one tvo"), (5, None, "abc")]
    out = {r["k"]: r for r in score.score_text(spark.createDataFrame(rows, "k int, gt string, pred string")).collect()}
    assert {k: (r["strict_edit_distance"], r["content_edit_distance"], r["word_edit_distance"]) for k, r in out.items()} == {1: (1, 0, 0), 2: (1, 0, 0), 3: (2, 2, 2), 4: (1, 1, 1), 5: (3, 3, 1)}


@pytest.mark.parametrize("name, small", [("neighbor_graph", 0), ("growth_costs", 1), ("region_evidence", 1), ("region_support", 1), ("seed_growth", 0)])
def test_components_are_never_broadcast(spark, name, small):
    """Joins of components and edges sort, however small the optimizer takes them; only the scale of a page may be broadcast."""
    from quire.plans import catalog
    from tests.conftest import SF

    seen = []
    keep = graph.materialize
    graph.materialize = lambda df, table: seen.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df, table)
    try:
        seen.append(catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString())
    finally:
        graph.materialize = keep
    initial = [p.split("== Initial Plan ==")[-1] for p in seen]
    assert all(p.count("BroadcastHashJoin") + p.count("BroadcastNestedLoopJoin") <= small for p in initial) and any("SortMergeJoin" in p for p in initial)
    assert name == "seed_growth" or "SortMergeJoin" in initial[-1]


def test_every_edge_goes_both_ways(spark):
    edges = spark.createDataFrame([(1, 5, 7, 2.0), (1, 5, 6, 3.0)], "page_id int, a int, b int, gap double")
    assert sorted(tuple(r) for r in graph.both_ways(edges).collect()) == [(1, 5, 6, 3.0), (1, 5, 7, 2.0), (1, 6, 5, 3.0), (1, 7, 5, 2.0)]


def test_glyphs_on_the_diagonal_in_one_pass(spark):
    """Counts of all glyphs from one look at each text, by code points; a null side has no counts."""
    rows = [(1, "tote\U0001f600e", "t#te\U0001f600c"), (2, "toe", "to"), (3, None, "e"), (4, "e", None), (5, "", "")]
    counts = score.glyph_counts(spark.createDataFrame(rows, "k int, gt string, pred string"), ["k"], ["e", "t", "\U0001f600"], "gt", "pred")
    assert "zip_with" not in counts._jdf.queryExecution().executedPlan().toString()
    found = {(r["k"], r["glyph"]): (r["gt"], r["pred"], r["correct"]) for r in counts.collect()}
    assert [found[1, g] for g in ("e", "t", "\U0001f600")] == [(2, 1, 1), (2, 2, 2), (1, 1, 1)]
    assert [found[k, "e"] for k in (2, 3, 4, 5)] == [(1, 0, 0), (None, 1, None), (1, None, None), (0, 0, 0)]
