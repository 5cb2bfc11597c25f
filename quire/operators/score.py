"""Scoring of OCR predictions against reviewed texts, and its summaries: always ratios of sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import alignment
from quire.functions import text as X
from quire.functions.store import small_batches

# What an engine writes to its log when an input fails; the second list is for whole-book runs.
ERROR_MARKERS = ["ERROR     Failed processing", "ERROR    Failed processing", "Failed processing", "Expected all tensors to be on the same device", "Traceback (most recent call last)"]
RUN_MARKERS = ["Failed processing", " ERROR "]
CONFIG = ["engine", "model", "psm", "preset"]


def eligible(gt: Column, status: Column) -> Column:
    """A text exists, and its status is neither pending nor excluded-uncertain; a null status counts."""
    return gt.isNotNull() & ~F.coalesce(status, F.lit("")).isin("pending", "excluded-uncertain")


def run_status(engine_failed: Column, pipeline_failed: Column, output_exists: Column, is_eligible: Column) -> Column:
    """The first that applies: engine-error, pipeline-error, serialization-missing, unscored-no-gt, scored."""
    return (
        F.when(F.coalesce(engine_failed, F.lit(False)), "engine-error")
        .when(F.coalesce(pipeline_failed, F.lit(False)), "pipeline-error")
        .when(~F.coalesce(output_exists, F.lit(False)), "serialization-missing")
        .when(~F.coalesce(is_eligible, F.lit(False)), "unscored-no-gt")
        .otherwise("scored")
    )


def internal_error(stdout: Column, stderr: Column, markers: list[str] | None = None) -> Column:
    log = F.concat(F.coalesce(stdout, F.lit("")), F.lit("\n"), F.coalesce(stderr, F.lit("")))
    return X.has_any(log, ERROR_MARKERS if markers is None else markers)


def score_text(df: DataFrame, gt: str = "gt", pred: str = "pred", with_words: bool = True, nfc: bool = False) -> DataFrame:
    """Adds sizes, distances and error rates. All distances are computed in Arrow batches; nfc normalises both sides first."""
    side = lambda c: F.coalesce(X.nfc(F.col(c)) if nfc else F.col(c), F.lit(""))
    small_batches(df.sparkSession)
    out = df.withColumn("gt_strict", X.strict_normalize(side(gt))).withColumn("pred_strict", X.strict_normalize(side(pred)))
    out = out.withColumn("gt_content", X.content_normalize(F.col("gt_strict"))).withColumn("pred_content", X.content_normalize(F.col("pred_strict")))
    out = out.withColumn("gt_chars_strict", F.length("gt_strict").cast("long")).withColumn("gt_chars_content", F.length("gt_content").cast("long"))
    same = (F.col("gt_content") == F.col("gt_strict")) & (F.col("pred_content") == F.col("pred_strict"))
    out = out.withColumn("_d", alignment.distances("gt_strict", "pred_strict", F.when(~same, F.col("gt_content")), F.when(~same, F.col("pred_content"))))
    out = out.withColumn("strict_edit_distance", F.col("_d.strict")).withColumn("content_edit_distance", F.col("_d.content")).drop("_d")
    if with_words:
        out = out.withColumn("_gw", X.words(F.col("gt_content"))).withColumn("_pw", X.words(F.col("pred_content")))
        out = out.withColumn("gt_words", F.size("_gw").cast("long")).withColumn("word_edit_distance", X.word_distance(F.col("_gw"), F.col("_pw"))).drop("_gw", "_pw")
        out = out.withColumn("wer_content", X.error_rate(F.col("word_edit_distance"), F.col("gt_words")))
    out = out.withColumn("cer_strict", X.error_rate(F.col("strict_edit_distance"), F.col("gt_chars_strict"))).withColumn("cer_content", X.error_rate(F.col("content_edit_distance"), F.col("gt_chars_content")))
    return out.drop("gt_strict", "pred_strict")


def with_operations(df: DataFrame, gt: str = "gt_content", pred: str = "pred_content") -> DataFrame:
    """Adds substitutions, deletions, insertions, merged and split word bounds from one alignment (Arrow)."""
    out = df.withColumn("_ops", alignment.edit_ops(F.col(gt), F.col(pred)))
    ops = F.col("_ops")
    for name, op in (("substitutions", "replace"), ("deletions", "delete"), ("insertions", "insert")):
        out = out.withColumn(name, alignment.count_op(ops, op).cast("long"))
    out = out.withColumn("merged_word_boundaries", alignment.merged_boundaries(ops, F.col(gt)).cast("long"))
    return out.withColumn("split_word_boundaries", alignment.split_boundaries(ops, F.col(pred)).cast("long")).withColumnRenamed("_ops", "edit_ops")


def glyph_counts(df: DataFrame, keys: list[str], glyphs: list[str], gt: str, pred: str, ops: str | None = None) -> DataFrame:
    """Long form: keys, glyph, gt, pred, correct. Without operations the texts must align along the diagonal."""
    if not ops:
        small_batches(df.sparkSession)
        rows = df.select(*keys, alignment.diagonal_counts("".join(glyphs))(F.col(gt), F.col(pred)).alias("_c")).select(*keys, F.posexplode("_c").alias("_i", "_c"))
        return rows.select(*keys, F.get(F.array(*[F.lit(g) for g in glyphs]), F.col("_i")).alias("glyph"), "_c.*")
    one = lambda g: F.struct(F.lit(g).alias("glyph"), X.count_of(F.col(gt), g).cast("long").alias("gt"), X.count_of(F.col(pred), g).cast("long").alias("pred"), alignment.glyph_hits(F.col(ops), F.col(gt), g).cast("long").alias("correct"))
    return df.select(*keys, F.explode(F.array(*[one(g) for g in glyphs])).alias("g")).select(*keys, "g.*")


def family_recall(counts: DataFrame, families: dict[str, str], keys: list[str]) -> DataFrame:
    """By keys and glyph family: sums, recall (null without truth), false positives (per row, never below 0)."""
    of = {g: f for f, glyphs in families.items() for g in glyphs}
    pairs = [F.lit(x) for g, f in of.items() for x in (g, f)]
    rows = counts.withColumn("family", F.element_at(F.create_map(*pairs), F.col("glyph")))
    sums = rows.groupBy(*keys, "family").agg(F.sum("gt").alias("gt"), F.sum("correct").alias("correct"), F.sum(F.greatest(F.lit(0), F.col("pred") - F.col("correct"))).alias("false_positives"))
    return sums.withColumn("recall", F.when(F.col("gt") > 0, F.col("correct") / F.col("gt")))


def summary(scored: DataFrame, keys: list[str], pages: int | None = None) -> DataFrame:
    """By configuration: sums, and rates as ratios of the sums. With seconds: per page, and the projection to ``pages``."""
    has = lambda c: c in scored.columns
    sums = ["gt_chars_strict", "gt_chars_content", "gt_words", "strict_edit_distance", "content_edit_distance", "word_edit_distance", "substitutions", "deletions", "insertions", "merged_word_boundaries", "split_word_boundaries"]
    out = scored.groupBy(*keys).agg(F.count("*").alias("pages"), *[F.sum(c).alias(c) for c in sums if has(c)], *([F.sum("seconds").alias("seconds_total")] if has("seconds") else []))
    for rate, d, n in (("cer_strict", "strict_edit_distance", "gt_chars_strict"), ("cer_content", "content_edit_distance", "gt_chars_content"), ("wer_content", "word_edit_distance", "gt_words")):
        if has(d):
            out = out.withColumn(rate, X.error_rate(F.col(d), F.col(n)))
    if has("seconds"):
        out = out.withColumn("seconds_per_page", F.col("seconds_total") / F.greatest(F.lit(1), F.col("pages")))
        if pages:
            out = out.withColumn("projected_minutes", F.col("seconds_per_page") * pages / 60)
    return out


def scored_samples(scored: DataFrame, keys: list[str], sample: str) -> DataFrame:
    """How many different samples have a score, by keys."""
    return scored.groupBy(*keys).agg(F.count_distinct(sample).alias("scored_samples"))


def best(df: DataFrame, by: str, ties: list[str], within: list[str] | None = None) -> DataFrame:
    """The row with the least value, the first in the order of ``ties`` of several. Without ``within`` it is a top 1, not a window over everything."""
    if not within:
        return df.orderBy(by, *ties).limit(1)
    w = Window.partitionBy(*within).orderBy(by, *ties)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def status_counts(df: DataFrame, status: str) -> DataFrame:
    return df.groupBy(status).agg(F.count("*").alias("n"))
