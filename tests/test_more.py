"""Operators that no query reaches, on small cases."""

from __future__ import annotations

import hashlib
import json
import math
import random
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.functions.store import materialize
from quire.operators import book, census, coverage, figures, flow, graph, images, run, score
from quire.sources import readers, sinks
from tests.test_operators import components


def test_json_scans(spark, tmp_path):
    for name, body in (("b.json", {"id": "b", "physical_index": 2}), ("a.json", {"id": "a", "physical_index": 1, "unknown": 5})):
        (tmp_path / name).write_text(json.dumps(body))
    rows = readers.json_objects(spark, f"file://{tmp_path}", "text_pages").orderBy("file_name").collect()
    assert [(r["file_name"], r["id"], r["physical_index"], r["status"]) for r in rows] == [("a.json", "a", 1, None), ("b.json", "b", 2, None)]
    (tmp_path / "c.json").write_text("[1, 2")
    with pytest.raises(Exception):  # noqa: B017  the engine's own error
        readers.json_objects(spark, f"file://{tmp_path}/c.json", "text_pages").collect()


def test_spreads_and_pairs(spark):
    sizes = spark.createDataFrame([(1, 0, 750, 1200), (1, 1, 750, 1200), (2, 0, 750, 1200), (3, 0, 750, 1200), (3, 1, 750, 1201)], "sheet int, index int, width int, height int")
    assert {r["sheet"]: r["accepted"] for r in readers.embedded_pair(sizes).collect()} == {1: True, 2: False, 3: False}


def test_images_are_read_back(spark, tmp_path):
    page = np.full((30, 40, 3), 250, np.uint8)
    page[10:20, 5:9] = (10, 20, 200)
    (tmp_path / "p.png").write_bytes(images.png_bytes(page))
    row = readers.images(spark, f"file://{tmp_path}").first()
    assert (row["height"], row["width"]) == (30, 40)
    assert np.frombuffer(row["data"], np.uint8).reshape(30, 40, -1)[12, 6, :3].tolist() == [200, 20, 10]  # the engine has blue first
    assert images.png_bytes(page) == images.png_bytes(page)


def test_reports_and_files(spark, tmp_path):
    counts = spark.createDataFrame([("a", 2)], "k string, n int")
    assert sinks.markdown_report("T", {"by k": counts}, counts) == "# T\n\n## by k\n\n- a: 2\n\n| k | n |\n|---|---|\n| a | 2 |\n"
    assert "<title>A &amp; B</title>" in sinks.html_edition("A & B", ["<p>x</p>"])
    book_ = sinks.epub_edition('T & "u"', "i<d", [('p"1', "<p>x</p>")], {'images/a"b.png': b"1"})
    assert [i for i, _ in sinks.epub_pages(book_)] == ['p"1']
    sinks.write_csv(spark.createDataFrame([([1, 2], True)], "a array<int>, b boolean").coalesce(1), f"file://{tmp_path}/csv")
    assert [tuple(r) for r in spark.read.option("header", True).csv(f"file://{tmp_path}/csv").collect()] == [("1;2", "1")]
    sums = sinks.sha256sums(spark.createDataFrame([("b", b"2"), ("a", b"1"), ("SHA256SUMS", b"x")], "path string, content binary")).collect()
    assert [r["line"] for r in sums] == [f"{hashlib.sha256(b'1').hexdigest()}  a", f"{hashlib.sha256(b'2').hexdigest()}  b"]
    assert sinks.sealed([("a", b"1")], {"a": hashlib.sha256(b"1").hexdigest(), "b": "0"}) == ["b"]
    (tmp_path / "x").write_text("1")
    assert sinks.place_file(str(tmp_path / "x"), str(tmp_path / "d" / "y")) == "hardlink" and (tmp_path / "d" / "y").read_text() == "1"
    with pytest.raises(OSError):
        sinks.place_file(str(tmp_path / "none"), str(tmp_path / "d" / "z"))


def test_editorial_batch(spark):
    pages = spark.createDataFrame([(f"p{i}", i, f"in/p{i}.JPG") for i in range(1, 6)], "id string, physical_index int, path string")
    layers = spark.createDataFrame([(e, f"p{i}", f"{e}{i}") for e in ("rus", "orus") for i in range(1, 6) if (e, i) != ("orus", 4)], "engine string, id string, text string")
    whole, lacking = coverage.with_layers(pages, layers, ["rus", "orus"], key="id")
    assert [tuple(r) for r in lacking.collect()] == [("missing-layer", "p4", "orus")]
    assert whole.orderBy("id").first()["orus"] == "orus1"
    rows = book.batch_records(whole, ["rus", "orus"], 2, 2)
    assert [(r["id"], r["page_file"], r["ocr"]["rus"]) for r in rows.collect()] == [("p2", "pages/p2.jpg", "ocr/rus/p2.txt"), ("p3", "pages/p3.jpg", "ocr/rus/p3.txt")]
    packed = sinks.batch_archive("b", {"schema": "s"}, rows, [("pages/p2.jpg", b"x")], "note")
    assert packed == sinks.batch_archive("b", {"schema": "s"}, rows, [("pages/p2.jpg", b"x")], "note")
    with pytest.raises(ValueError):
        book.batch_records(whole, ["rus"], 9, 1)


def test_runs_of_models_and_stages(spark):
    inputs = spark.createDataFrame([(m, f"s{i}", "p", "gray") for m in ("good", "bad") for i in range(3)], "model string, sample_id string, path string, preset string")
    calls = spark.sparkContext.accumulator(0)

    def call(model, pages):
        calls.add(1)
        if model == "bad":
            raise run.LoadError("no such model")
        return dict(pages)

    rest, failed = run.working_models(inputs, call, materialize)
    assert {r["model"] for r in rest.collect()} == {"good"} and [tuple(r) for r in failed.collect()] == [("bad", "no such model")] and calls.value == 2
    assert run.only(inputs, "sample_id", ["s1"]).count() == 2 and run.only(inputs, "sample_id", None).count() == 6
    assert run.with_preset(inputs, "gray").count() == 6
    with pytest.raises(ValueError):
        run.with_preset(inputs, "otsu")
    last, log = run.chain(inputs, [("first", lambda d: d.where("model = 'good'")), ("second", lambda d: d.limit(1))], materialize)
    assert last.count() == 1 and [(x["stage"], x["rows"]) for x in log] == [("first", 3), ("second", 1)]
    with pytest.raises(RuntimeError, match="stage broken"):
        run.chain(inputs, [("broken", lambda d: d.select("none"))], materialize)


def test_word_distance_of_many_words(spark):
    """More distinct words than code points below the surrogates."""
    a = " ".join(f"w{i}" for i in range(60_000))
    b = a.replace("w59999", "x").replace("w5 ", "")
    row = spark.createDataFrame([(a, b)], "a string, b string").select(X.word_distance(X.words(F.col("a")), X.words(F.col("b"))).alias("d")).first()
    assert row["d"] == 2


def page_of_rows(n_rows=6, per_row=12, h=20):
    rng = random.Random(5)
    return [(40 + 24 * i, 100 + 60 * r, 14 + rng.randint(-2, 2), h + rng.choice((0, 0, 0, 1, -1, 2))) for r in range(n_rows) for i in range(per_row)]


def test_page_scale(spark):
    boxes = page_of_rows() + [(300, 600, 300, 260), (500, 90, 2, 2)]
    parts = components(spark, boxes)
    pages = spark.createDataFrame([("p", 800, 1200), ("q", 800, 1200)], "page_id string, width int, height int")
    got = {r["page_id"]: r for r in graph.page_scale(parts, pages).collect()}
    heights = [b[3] for b in boxes[:-2]]
    assert got["q"]["problem"] == "few-candidates" and got["q"]["cap_height"] is None
    assert got["p"]["problem"] is None and got["p"]["candidates"] == len(heights) and got["p"]["mode"] == 20
    assert math.isclose(got["p"]["cap_height"], np.percentile(heights, 97))


def test_seeds_without_text_baseline(spark):
    scale = spark.createDataFrame([("p", 20.0, 3.0)], "page_id string, cap_height double, stroke double")
    plain = components(spark, page_of_rows(2, 12) + [(300, 600, 300, 260)]).withColumn("text_score", F.lit(0.0))
    got = {r["label"]: r for r in graph.seeds(plain, scale).collect()}  # the baseline of size: 24 components
    assert got[25]["is_seed"] and got[1]["seed_problem"] is None and not got[1]["is_seed"]
    few = graph.seeds(components(spark, page_of_rows(1, 12)).withColumn("text_score", F.lit(0.9)), scale).collect()
    assert {r["seed_problem"] for r in few} == {"few-baseline"} and not any(r["is_seed"] for r in few)


def drawn_page():
    """Rows of letters, and two drawings: a ring with a spot in it and a bar."""
    page = np.full((600, 500), 245, np.uint8)
    for r in range(4):
        for i in range(16):
            page[40 + 40 * r : 54 + 40 * r, 30 + 26 * i : 34 + 26 * i] = 15
            page[40 + 40 * r : 43 + 40 * r, 30 + 26 * i : 42 + 26 * i] = 15
    yy, xx = np.mgrid[:600, :500]
    away = np.hypot(yy - 340, xx - 130)
    page[(away > 74) & (away < 80)] = 15
    page[335:345, 125:135] = 15
    page[470:560, 330:336] = page[470:476, 330:440] = page[554:560, 330:440] = page[470:560, 434:440] = 15
    return page


def test_images_to_figures(spark):
    """From pixels to accepted regions, their support and published stickers: two figures, no letters."""
    page = drawn_page()
    frame = spark.createDataFrame([("p", *page.shape, 1, 0, bytearray(page.tobytes()))], "origin string, height int, width int, nChannels int, mode int, data binary")
    pages = spark.createDataFrame([("p", 500, 600)], "page_id string, width int, height int")
    parts = materialize(images.components(frame), "components")
    scale = materialize(graph.page_scale(parts, pages), "scale")
    scored = materialize(graph.text_scores(graph.line_support(parts), scale), "scored")
    strokes = images.stroke_widths(frame, scored, scale)
    scale = materialize(scale.join(strokes, "page_id"), "scale")
    row = scale.first()
    assert 10 <= row["cap_height"] <= 18 and 2 <= row["stroke"] <= 8
    seeded = materialize(graph.seeds(scored, scale), "seeds")
    edges = materialize(graph.neighbours(seeded, 2.2 * row["cap_height"]), "edges")
    owned = materialize(graph.grow(graph.directed_costs(edges, seeded, scale), seeded.where("is_seed"), 6.0), "owned")
    regions = graph.region_stats(owned, seeded)
    found = graph.accepted(regions, scale, pages).orderBy("asset_index").collect()
    assert len(found) == 2 and [r["asset_index"] for r in found] == [1, 2]
    assert found[0]["x1"] <= 52 and found[0]["x2"] >= 208 and found[1]["x1"] <= 331 and found[1]["y2"] >= 559
    members = owned.select("page_id", "owner", F.col("node").alias("label"))
    support = graph.support(seeded, edges, members, scale).collect()
    assert {r["owner"] for r in support if r["verdict"] == "keep"} == {r["owner"] for r in found}
    cut = images.stickers(frame).collect()
    assert len(cut) == 1 and cut[0]["png"][:4] == b"\x89PNG"


def test_compositions_of_pixels(spark):
    red = np.zeros((2, 3, 4), np.uint8)
    red[..., 0] = red[..., 3] = 255
    data = red.tobytes()
    sha = hashlib.sha256(data).hexdigest()
    kind = "id string, part int, offset_x int, offset_y int, height int, width int, data binary, sha256 string, union_width int, union_height int"
    rows = [("a", 1, 0, 0, 2, 3, bytearray(data), sha, 6, 4), ("a", 2, 3, 2, 2, 3, bytearray(data), sha, 6, 4), ("b", 1, 0, 0, 2, 3, bytearray(data), "0", 3, 2), ("c", 1, 2, 0, 2, 3, bytearray(data), sha, 3, 2)]
    got = {r["id"]: r for r in images.composed(spark.createDataFrame(rows, kind), padding=1).collect()}
    assert (got["a"]["width"], got["a"]["height"], got["a"]["problem"]) == (8, 6, None) and got["a"]["sha256"] == hashlib.sha256(got["a"]["png"]).hexdigest()
    assert got["b"]["problem"] == "hash of part 1" and got["b"]["png"] is None
    assert got["c"]["problem"] is None or "leaves its canvas" in got["c"]["problem"]
    clear = spark.createDataFrame([("x", 2, 3, 4, 24, bytearray(bytes(24))), ("y", 2, 3, 4, 24, bytearray(data))], "origin string, height int, width int, nChannels int, mode int, data binary")
    assert [tuple(r) for r in images.asset_problems(clear).collect()] == [("x", "fully-transparent")]


def test_presets_of_a_page():
    page = drawn_page()[..., None]
    made = images.variants(np.repeat(page, 3, axis=2))
    assert list(made) == list(images.PRESETS)
    assert made["raw-gray"].shape == (600, 500) and made["local-gray-150"].shape == (900, 750)
    assert set(np.unique(made["otsu-150"])) == set(np.unique(made["adaptive-150"])) == {0, 255}
    assert (made["otsu-150"] == 0).mean() < 0.25 and made["local-gray"][300, 400] > made["local-gray"][41, 31]
    ramp = np.tile(np.arange(0, 200, 2, dtype=np.uint8), (20, 1))
    assert abs(int(images.cubic(ramp, 1.5)[15, 75]) - int(ramp[10, 50])) <= 2
    sheet = images.contact_sheet([page[..., 0]] * 3, 2, 50, 60)
    assert sheet.shape == (2 * 64 + 4, 2 * 54 + 4)


def test_grouping_rules():
    may = graph.may_group
    assert not may(10, math.inf, 1.0, 9, 0.1)  # overlapping boxes without an edge
    assert may(10, 13.5, 0.08, 0, 0.3) and may(10, 13.5, 0.0, 1, 0.3) and not may(10, 13.6, 0.5, 5, 0.3) and not may(10, 13.0, 0.5, 2, 0.31)
    assert may(10, 3.5, 0.18, 0, 1.0) and may(10, 3.5, 0.0, 2, 1.0) and not may(10, 3.6, 0.17, 2, 1.0)
    assert may(10, 7.5, 0.0, 3, 1.0) and not may(10, 7.5, 0.9, 2, 1.0)


def test_figures_in_order(spark):
    figs = spark.createDataFrame([("p", "10", [0, 50, 9, 60], "2"), ("p", "9", [0, 50, 9, 60], "2"), ("p", "1", None, None), ("p", "2", [0, 5, 9, 9], "x")], "page_id string, label string, asset_bbox array<int>, asset_index string")
    ordered = book.figure_rows(figs).orderBy("_y", "_i", "_l").collect()
    assert [r["label"] for r in ordered] == ["2", "10", "9", "1"]  # labels as text, unknown places last
    assert census.ranked(spark.createDataFrame([(1, 5), (2, 9), (0, 5)], "physical_index int, review_score int")).first()["physical_index"] == 2
    assert figures.universe(spark, 3, (2,)).count() == 4
    with pytest.raises(ValueError):
        flow.facsimile_flow(spark.createDataFrame([], "page_id string, seq int, kind string, content string"), spark.createDataFrame([], "page_id string, file string"), "odt")


def test_scores_take_eligible_pages(spark):
    rows = spark.createDataFrame([("a", None), ("b", "pending"), ("c", "excluded-uncertain"), ("d", "draft"), (None, "reviewed")], "gt string, status string")
    assert [r["gt"] for r in rows.where(score.eligible(F.col("gt"), F.col("status"))).collect()] == ["a", "d"]


def test_zip_is_reproducible():
    one = sinks.epub_edition("T", "id", [("p", "<p>x</p>")], {})
    with zipfile.ZipFile(__import__("io").BytesIO(one)) as z:
        assert {i.date_time for i in z.infolist()} == {sinks.EPOCH}
