"""Text, alignment and geometry functions against plain Python."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions import alignment
from quire.functions import geometry as G
from quire.functions import text as X
from quire.operators import flow


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abc é", max_size=12), st.text("abc é", max_size=12))
def test_edit_operations_are_an_optimal_script(a, b):
    ops = alignment.edit_operations(a, b)
    assert len(ops) == distance(a, b)
    n = {k: sum(o == k for o, _, _ in ops) for k in ("replace", "delete", "insert")}
    assert n["delete"] - n["insert"] == len(a) - len(b)
    out, at = [], 0
    for op, i, j in ops:
        out.append(a[at:i])
        at = i
        if op != "insert":
            at += 1
        if op != "delete":
            out.append(b[j])
    assert "".join(out) + a[at:] == b


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


def test_word_distance(spark):
    rng = random.Random(3)
    pairs = [(" ".join(rng.choices("ab cd ef gh ij kl".split(), k=rng.randint(0, 9))), " ".join(rng.choices("ab cd ef gh ij kl".split(), k=rng.randint(0, 9)))) for _ in range(200)]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", X.word_distance(X.words(F.col("a")), X.words(F.col("b"))).alias("d")).collect()
    assert all(r["d"] == distance(r["a"].split(), r["b"].split()) for r in rows)


def test_normalization_follows_unicode_blanks(spark):
    raw = "  a  \r\nb  \rc\t\n\n"
    assert one(spark, X.strict_normalize(F.lit(raw))) == "\n".join(x.rstrip() for x in raw.replace("\r\n", "\n").replace("\r", "\n").split("\n")).strip()
    assert one(spark, X.content_normalize(F.lit(raw))) == " ".join(raw.split())
    twice = one(spark, X.strict_normalize(X.strict_normalize(F.lit(raw))))
    assert twice == one(spark, X.strict_normalize(F.lit(raw)))
    assert one(spark, X.nfc(F.lit("й"))) == "й"


def test_russian_patterns(spark):
    assert one(spark, X.repair_final_sign(F.lit("домъ, столъ объект съѣлъ"))) == "дом, стол объект сѣл"
    assert one(spark, X.count_final_sign(F.lit("домъ столъ"))) == 2
    assert one(spark, X.glyphs_present(F.lit("вѣра іюль"))) == ["ѣ", "і"] or set(one(spark, X.glyphs_present(F.lit("вѣра іюль")))) == {"ѣ", "і"}
    assert one(spark, X.caption_numbers(F.lit("485\n\n147 ФИГ.\n 12  фиг.\n147 ФИГ."))) == [147, 12]
    assert one(spark, X.mention_numbers(F.lit("см. 5 фиг. и 7фиг. и 5 ФИГ."))) == [5, 7]
    assert one(spark, X.atlas_evidence(F.lit("Таб. I."), F.array().cast("array<string>")))
    assert one(spark, X.atlas_evidence(F.lit("x"), F.array(F.lit("Лист  чертежей"))))
    assert one(spark, X.label_text(F.lit("28bis"))) == "028bis"
    assert one(spark, X.label_hint(F.array(F.lit("35"), F.lit("36")))) == "figs-035-036"
    assert one(spark, X.page_id(F.lit("a/sheet-052-left.json"))) == "sheet-052-left"
    assert one(spark, X.page_id(F.lit("other"))) is None
    assert one(spark, X.is_heading(F.lit("ГЛАВА I"))) and not one(spark, X.is_heading(F.lit("глава")))
    assert one(spark, X.text_blocks(F.lit("\na\nb\n \n\n  \nc\n"))) == ["a\nb", "c"]
    assert one(spark, X.html_unescape(X.html_escape(F.lit("<a & 'b'>")))) == "<a & 'b'>"


def test_geometry(spark):
    box = lambda *v: G.box(*[F.lit(x) for x in v])
    assert one(spark, G.gap(box(0, 0, 10, 10), box(13, 14, 20, 20))) == 5.0
    assert one(spark, G.gap(box(13, 14, 20, 20), box(0, 0, 10, 10))) == 5.0
    assert not one(spark, G.overlaps(box(0, 0, 10, 10), box(10, 0, 20, 10)))
    blockers = F.array(*[F.struct(F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b")) for a, b in ((100, 120), (110, 300), (500, 520))])
    found = one(spark, G.free_intervals(F.lit(0.0), F.lit(600.0), blockers))
    assert [tuple(x) for x in found] == [(0.0, 96.0), (304.0, 496.0), (524.0, 600.0)]
    assert tuple(one(spark, G.widest(G.free_intervals(F.lit(0.0), F.lit(600.0), blockers)))) == (304.0, 496.0)


def test_insertion_index(spark):
    blocks = F.array(*[F.lit(x) for x in ("one", "see 12 фиг. here", "13 фиг.", "end")])
    none = F.lit(None).cast("int")
    at = lambda label, y1=none, y2=none: one(spark, flow.insertion_index(blocks, y1, y2, F.lit(1000), F.lit(label)))
    assert (at("12"), at("13"), at("99")) == (2, 2, 4)
    assert at("12", F.lit(0), F.lit(250)) == 0  # half of a block: to even
    assert at("12", F.lit(500), F.lit(750)) == 2
    assert flow.wrap("aa bb cc".split(), {}, 5.0, 1.0) == ["aa bb", "cc"]
    assert flow.first_fit([10.0, 9.5, 9.0], lambda s: s < 9.6) == 9.5


@settings(max_examples=300, deadline=None)
@given(st.text("abc é\U0001f600", max_size=14), st.text("abc é\U0001f600", max_size=14))
def test_edit_distance(a, b):
    least = distance(a, b)
    assert alignment.edit_distance(a, b) == alignment.edit_distance(list(a), list(b)) == least
    assert alignment.edit_distance(a, b, least) == alignment.edit_distance(a, b, len(a) + len(b)) == least


def test_edit_distance_in_bands():
    """Texts of many blocks of the band, near ones and such that no narrow band holds their best alignment."""
    rng = random.Random(5)
    for share, cut in ((0.01, 0), (0.1, 0), (0.5, 0), (0.05, 150), (0.02, 400)):
        a = "".join(rng.choices("abcdefgh", k=700))
        b = "".join(rng.choice(("", "x" + c, "y", "a")) if rng.random() < share else c for c in a)
        b = b[cut:] + b[:cut]
        least = distance(a, b)
        assert alignment.edit_distance(a, b) == alignment.edit_distance(b, a) == alignment.edit_distance(list(a), list(b)) == least
        shorter, longer = sorted((a, b), key=len)
        assert all(least <= alignment._banded(shorter, longer, k) for k in (64, 100)) and alignment._banded(shorter, longer, max(least, 64)) == least


def test_char_distance_of_columns(spark):
    pairs = [("kitten", "sitting"), ("", "abc"), ("é\U0001f600", "e\U0001f600"), (None, "a"), ("a", None), ("same", "same")]
    rows = spark.createDataFrame(pairs, "a string, b string").select(X.char_distance(F.col("a"), F.col("b")).alias("d")).collect()
    assert [r["d"] for r in rows] == [3, 3, 1, None, None, 0]
