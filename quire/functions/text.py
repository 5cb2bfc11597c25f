"""Text functions on columns: normalization, distances, pattern extraction, blocks. All built-in unless said."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import alignment

# Glyphs of the pre-reform alphabet and their families.
PREREFORM = "ѣѢіІѳѲѵѴ"
FAMILIES = {"yat": "ѣѢ", "decimal_i": "іІ", "fita": "ѳѲ", "izhitsa": "ѵѴ", "hard_sign": "ъЪ"}
LETTERS = "А-Яа-яЁё"


def strict_normalize(c: Column) -> Column:
    """Line ends become line feeds, lines lose trailing blanks, the whole is trimmed; blanks are Unicode's."""
    c = F.regexp_replace(c, "\r\n?", "\n")
    c = F.regexp_replace(c, r"(?Um)[\s&&[^\n]]+$", "")
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def content_normalize(c: Column) -> Column:
    """Runs of Unicode blanks become one space, the ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def words(c: Column) -> Column:
    """The words of a text; an empty text has none."""
    return F.filter(F.split(content_normalize(c), " "), lambda w: w != "")


def char_distance(a: Column, b: Column) -> Column:
    """Unit-cost edits between two texts, by code points (Arrow)."""
    return alignment.distance(a, b)


def word_distance(a: Column, b: Column) -> Column:
    """Unit-cost edits between two arrays of words (Arrow)."""
    return alignment.distance(a, b)


def error_rate(distance: Column, size: Column) -> Column:
    return distance / F.greatest(F.lit(1), size)


@F.pandas_udf(T.StringType())
def nfc(texts: pd.Series) -> pd.Series:
    """Unicode normal form C (the engine has none of its own)."""
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def final_sign_pattern(letters: str = LETTERS, sign: str = "ъЪ") -> str:
    return f"([{letters}])[{sign}](?![{letters}])"


def has_final_sign(c: Column, letters: str = LETTERS, sign: str = "ъЪ") -> Column:
    return c.rlike(final_sign_pattern(letters, sign))


def repair_final_sign(c: Column, letters: str = LETTERS, sign: str = "ъЪ") -> Column:
    return F.regexp_replace(c, final_sign_pattern(letters, sign), "$1")


def count_final_sign(c: Column, letters: str = LETTERS, sign: str = "ъЪ") -> Column:
    return F.regexp_count(c, F.lit(final_sign_pattern(letters, sign)))


def glyphs_present(c: Column, glyphs: str = PREREFORM) -> Column:
    """Which of the glyphs occur, sorted."""
    return F.array_sort(F.array_intersect(F.split(c, ""), F.array(*[F.lit(g) for g in glyphs])))


def count_of(c: Column, glyph: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(glyph), F.lit("")))


def caption_numbers(c: Column, word: str = "ФИГ") -> Column:
    """Distinct numbers of caption lines, in order of first appearance."""
    return _numbers(F.regexp_extract_all(c, F.lit(rf"(?miu)^\s*(\d+)\s+{word}\.\s*$"), F.lit(1)))


def mention_numbers(c: Column, word: str = "фиг") -> Column:
    return _numbers(F.regexp_extract_all(c, F.lit(rf"(?iu)(\d+)\s*{word}\."), F.lit(1)))


def _numbers(found: Column) -> Column:
    return F.filter(F.array_distinct(F.transform(found, lambda x: x.try_cast("int"))), lambda x: x.isNotNull())


def atlas_evidence(text: Column, notes: Column) -> Column:
    """The text begins like a plate, or a note speaks of one."""
    plate = text.rlike(r"(?U)^\s*Таб(л)?\.?\s*[IVXLC0-9]+")
    return F.coalesce(plate, F.lit(False)) | F.coalesce(F.exists(notes, lambda n: n.rlike(r"(?iu)лист\s+чертеж|таблиц")), F.lit(False))


def page_id(c: Column) -> Column:
    """The page identifier within a path, null if there is none."""
    return F.nullif(F.regexp_extract(c, r"(sheet-\d{3}-(?:left|right))", 1), F.lit(""))


def label_number(c: Column) -> Column:
    return F.regexp_extract(c, r"^(\d+)(bis)?$", 1).try_cast("int")


def label_bis(c: Column) -> Column:
    return (F.regexp_extract(c, r"^(\d+)(bis)?$", 2) == "bis").cast("int")


def label_text(c: Column) -> Column:
    """A label in fixed width: 28bis is 028bis."""
    return F.when(label_number(c).isNotNull(), F.concat(F.lpad(label_number(c).cast("string"), 3, "0"), F.regexp_extract(c, r"^(\d+)(bis)?$", 2)))


def label_hint(labels: Column) -> Column:
    """figs-035-036 of an array of labels."""
    return F.when(F.size(labels) > 0, F.concat(F.when(F.size(labels) == 1, F.lit("fig-")).otherwise(F.lit("figs-")), F.array_join(F.transform(labels, label_text), "-")))


def text_blocks(c: Column) -> Column:
    """Paragraphs between blank lines, blank ones dropped."""
    stripped = F.regexp_replace(c, r"^\n+|\n+$", "")
    return F.filter(F.split(stripped, r"\n\s*\n"), lambda b: F.trim(F.regexp_replace(b, r"\s+", " ")) != "")


def is_heading(c: Column, longest: int = 95, share: float = 0.82) -> Column:
    letters = F.regexp_count(c, F.lit(r"\p{L}"))
    upper = F.regexp_count(c, F.lit(r"\p{Lu}"))
    return (letters > 0) & (F.length(c) <= longest) & (upper / F.greatest(letters, F.lit(1)) > share)


def html_escape(c: Column) -> Column:
    # The five HTML escapes, the ampersand first.
    pairs = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)


def html_unescape(c: Column) -> Column:
    pairs = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&amp;", "&"))
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)


def safe_id(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Za-z0-9_-]+", "-")


def tail(c: Column, n: int = 3000) -> Column:
    return F.right(c, F.lit(n))


def safe_path(c: Column, suffix: str = ".png") -> Column:
    """Relative, without parent steps, with the given suffix."""
    return ~c.startswith("/") & ~F.array_contains(F.split(c, "/"), "..") & F.lower(c).endswith(suffix)


def has_any(c: Column, markers: list[str]) -> Column:
    """Whether a log holds one of the markers."""
    return reduce(lambda x, m: x | F.contains(c, F.lit(m)), markers, F.lit(False))
