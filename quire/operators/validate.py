"""Validation: every rule is a DataFrame of violations (rule, key, detail); the caller fails fast or collects.

A rule reads what it needs; rules over one table are evaluated in one pass (``row_rules``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import coverage

STATUSES = ("draft", "reviewed", "verified")


class ViolationError(ValueError):
    """Raised by ``require`` with the first violations."""


def row_rules(df: DataFrame, key: Column, rules: dict[str, tuple[Column, Column | None]]) -> DataFrame:
    """All rules in one pass: {rule: (condition of the violation, detail)}; a null condition is none."""
    found = [F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(rule).alias("rule"), key.cast("string").alias("key"), (F.lit("") if detail is None else F.coalesce(detail.cast("string"), F.lit(""))).alias("detail"))) for rule, (bad, detail) in rules.items()]
    return df.select(F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("v")).select("v.*")


def union(*violations: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, violations)


def require(violations: DataFrame, shown: int = 20) -> None:
    """Fail if there is any violation."""
    rows = violations.limit(shown).collect()
    if rows:
        raise ViolationError("; ".join(f"{r['rule']}: {r['key']} {r['detail']}".strip() for r in rows))


def summary(violations: DataFrame) -> DataFrame:
    return violations.groupBy("rule").agg(F.count("*").alias("n"))


def text_pages(pages: DataFrame, sources: DataFrame, schema: str) -> DataFrame:
    """The twelve rules of text pages; pages have file_name (stem.json). A duplicate id is one violation and its pages still count."""
    s = sources.select(F.col("id"), F.col("physical_index").alias("_pi"), F.col("sha256").alias("_sha"), F.lit(True).alias("_in"))
    j = pages.join(s, "id", "left")
    c = F.col
    stem = F.regexp_replace("file_name", r"\.json$", "")
    rules = {
        "missing-id": (F.coalesce("id", F.lit("")) == "", c("file_name")),
        "file-name": (c("id").isNotNull() & (stem != c("id")), c("file_name")),
        "schema": (~c("schema").eqNullSafe(F.lit(schema)), c("schema")),
        "status": (~F.coalesce("status", F.lit("")).isin(*STATUSES), c("status")),
        "not-in-manifest": (c("id").isNotNull() & c("_in").isNull(), None),
        "physical-index": (c("_in") & ~c("physical_index").eqNullSafe(c("_pi")), c("physical_index")),
        "source-hash": (c("_in") & ~c("source_sha256").eqNullSafe(c("_sha")), None),
        "layers": (c("diplomatic_text").isNull() | c("normalized_text").isNull(), None),
        "prereform-glyph": (F.size(X.glyphs_present(c("normalized_text"))) > 0, F.array_join(X.glyphs_present(c("normalized_text")), "")),
        "final-hard-sign": (X.has_final_sign(c("normalized_text")), X.count_final_sign(c("normalized_text"))),
        "notes": (c("notes").isNull(), None),
    }
    twice = coverage.duplicates(pages.where("id is not null"), ["id"]).select(F.lit("duplicate-id").alias("rule"), c("id").alias("key"), c("n").cast("string").alias("detail"))
    return union(row_rules(j, F.coalesce("id", "file_name"), rules), twice)


def batch_files(batches: DataFrame, pages: DataFrame, schema: str) -> DataFrame:
    """The nine rules of editorial batches: file_name, schema, completed_pages, pages (array of references)."""
    heads = row_rules(batches, F.col("file_name"), {
        "batch-schema": (~F.col("schema").eqNullSafe(F.lit(schema)), F.col("schema")),
        "batch-pages": (F.col("pages").isNull(), None),
        "completed-pages": (F.col("pages").isNotNull() & ~F.col("completed_pages").eqNullSafe(F.size("pages")), F.col("completed_pages")),
    })
    refs = batches.select(F.explode("pages").alias("p")).select("p.*")
    named = pages.withColumn("path", F.concat(F.lit("corpus/text/pages/"), "id", F.lit(".json")))
    return union(heads, coverage.batch_integrity(refs, named, "id", ("physical_index", "status", "path")))


def release_gates(book: DataFrame, expected_pages: int, expected_figures: int, release: tuple[str, str] | None = None, versions: dict[str, str] | None = None, assets: DataFrame | None = None) -> DataFrame:
    """Gates of a book: number of pages and linked figures, verified statuses, no problem of a page, indexes 1..N. With ``release`` (edition, version): the version that ``versions`` has for the edition. With ``assets`` (file): their number, and none that no page links (supplementary)."""
    c = F.col
    pages = row_rules(book, c("id"), {"not-verified": (~c("status").eqNullSafe(F.lit("verified")), c("status")), "page-problem": (c("problem").isNotNull(), c("problem"))})
    totals = book.agg(F.count("*").alias("pages"), F.coalesce(F.sum(F.size("figures")), F.lit(0)).alias("figures"), F.min("physical_index").alias("least"), F.max("physical_index").alias("most"), F.count_distinct("physical_index").alias("distinct_n"))
    more = []
    if release is not None:
        wrong = (versions or {}).get(release[0]) != release[1]
        more.append(row_rules(totals, F.lit("book"), {"edition-version": (F.lit(wrong), F.lit(" ".join(release)))}))
    if assets is not None:
        linked = book.select(F.explode("figures.file").alias("file"))
        more += [row_rules(assets.join(linked, "file", "left_anti"), c("file"), {"supplementary": (F.lit(True), None)}), row_rules(assets.agg(F.count("*").alias("n")), F.lit("book"), {"asset-count": (c("n") != expected_figures, c("n"))})]
    return union(pages, *more, row_rules(totals, F.lit("book"), {
        "page-count": (c("pages") != expected_pages, c("pages")), "figure-count": (c("figures") != expected_figures, c("figures")),
        "page-sequence": ((c("least") != 1) | (c("most") != c("pages")) | (c("distinct_n") != c("pages")), c("distinct_n")),
    }))


def equivalent(book: DataFrame, edition: DataFrame, key: str = "id", text: str = "text", order: str = "physical_index", figures: str | None = None) -> DataFrame:
    """Violations of an edition re-read: pages missing or extra, another order, another text after normalization. With ``figures`` (a column of arrays of file, sha256): other files, another order of the same files, another hash of a file."""
    part = lambda df, of: df.select(key, F.col(order).alias(f"_o{of}"), X.content_normalize(F.coalesce(F.col(text), F.lit(""))).alias(f"_t{of}"), *([F.expr(f"transform(coalesce({figures}, array()), x -> struct(x.file, x.sha256))").alias(f"_f{of}")] if figures else []))
    j = part(book, "a").join(part(edition, "b"), key, "full_outer")
    c = F.col
    rules = {"missing-page": (c("_ob").isNull() & c("_tb").isNull(), None), "extra-page": (c("_oa").isNull() & c("_ta").isNull(), None), "order": (c("_oa") != c("_ob"), c("_ob")), "text": (c("_ta") != c("_tb"), F.sha2("_tb", 256))}
    if figures:
        same = F.array_sort("_fa.file") == F.array_sort("_fb.file")
        other = F.expr("filter(_fb, y -> exists(_fa, x -> x.file <=> y.file) AND NOT exists(_fa, x -> x.file <=> y.file AND x.sha256 <=> y.sha256))")
        rules |= {"figure-inventory": (~same, F.array_join("_fb.file", " ")), "figure-order": (same & (c("_fa.file") != c("_fb.file")), F.array_join("_fb.file", " ")), "figure-hash": (F.size(other) > 0, F.array_join(other["file"], " "))}
    return row_rules(j, c(key), rules)


def facsimile_edition(pages: DataFrame, total_figures: int, substituted: int, facsimiles: int) -> DataFrame:
    """Gates of facsimile editions: pages: id, coverage (covered share), aspect, source_aspect, figures (number)."""
    c = F.col
    rows = row_rules(pages, c("id"), {"coverage": (c("coverage") < 0.995, c("coverage")), "aspect": (F.abs(c("aspect") - c("source_aspect")) > 0.002, c("aspect"))})
    total = pages.agg(F.sum("figures").alias("n"))
    return union(rows, row_rules(total, F.lit("edition"), {"figure-count": (c("n") != total_figures - substituted + facsimiles, c("n"))}))


def landscape_pages(pages: DataFrame, expected: int, least: float = 0.98) -> DataFrame:
    """Gates of the fixed layout: number of landscape pages and how much of each its plate covers."""
    c = F.col
    wide = pages.where("out_width > out_height")
    return union(row_rules(wide, c("id"), {"coverage": (c("coverage") < least, c("coverage"))}), row_rules(wide.agg(F.count("*").alias("n")), F.lit("layout"), {"landscape-count": (c("n") != expected, c("n"))}))


def frontmatter(policy: DataFrame, book: DataFrame) -> DataFrame:
    """Violations of a facsimile policy against the book's pages."""
    b = book.select("id", F.col("physical_index").alias("_pi"), F.col("page_type").alias("_pt"), F.lit(True).alias("_in"))
    c = F.col
    return row_rules(policy.join(b, "id", "left"), c("id"), {"no-page": (c("_in").isNull(), None), "physical-index": (c("_in") & ~c("physical_index").eqNullSafe(c("_pi")), c("physical_index")), "page-type": (c("_in") & ~c("page_type").eqNullSafe(c("_pt")), c("page_type"))})


def repair(pages: DataFrame, text: str = "normalized_text", write: bool = False) -> DataFrame:
    """Check mode: (id, found) of pages with word-final signs; write mode: all pages, repaired."""
    found = X.count_final_sign(F.col(text))
    if write:
        return pages.withColumn(text, X.repair_final_sign(F.col(text)))
    return pages.select("id", found.cast("long").alias("found")).where("found > 0")
