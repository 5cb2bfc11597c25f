"""Scans: JSON objects and directories, OCR text with empty pages kept, images, PDF reports."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.schemas import SCHEMAS

IMAGE_SUFFIXES = ("png", "jpg", "jpeg", "tif", "tiff")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]


def json_objects(spark: SparkSession, path: str | list[str], entity: str) -> DataFrame:
    """One row a JSON file of a declared shape, with file_name; what is no object fails the read."""
    schema = T.StructType.fromDDL(SCHEMAS[entity]) if entity in SCHEMAS else T.StructType.fromDDL(entity)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path).withColumn("file_name", F.col("_metadata.file_name"))


def records(spark: SparkSession, path: str | list[str], entity: str, field: str = "records") -> DataFrame:
    """The objects in an array of a header object, one row each."""
    wrapped = T.StructType().add("schema", T.StringType()).add(field, T.ArrayType(T.StructType.fromDDL(SCHEMAS[entity])))
    rows = spark.read.schema(wrapped).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return rows.select(F.explode(field).alias("r")).select("r.*")


def with_positions(df: DataFrame, array: str, index: str = "asset_index") -> DataFrame:
    """One row an element; a missing index is the 1-based position."""
    rest = [c for c in df.columns if c != array]
    rows = df.select(*rest, F.posexplode(array).alias("_pos", "_e"))
    fields = [f.name for f in df.schema[array].dataType.elementType.fields if f.name != index]
    return rows.select(*rest, F.coalesce(F.col(f"_e.{index}"), F.col("_pos") + 1).alias(index), *[F.col(f"_e.{f}").alias(f) for f in fields])


def listed_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Paths and sizes under a folder, empty files too (content scans drop those). The listing is Hadoop's, on the driver."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}")) or []
    return spark.createDataFrame([(s.getPath().toString(), s.getLen()) for s in found if s.isFile()], "path string, size long")


def ocr_pages(spark: SparkSession, root: str) -> DataFrame:
    """(engine, page_id, text) from {root}/{engine}/{page_id}.txt; an empty file is an empty text."""
    name = lambda c: (F.regexp_extract(c, r"([^/]+)/[^/]+$", 1).alias("engine"), F.regexp_extract(c, r"([^/]+)\.txt$", 1).alias("page_id"))
    there = listed_files(spark, root, "*/*.txt").select(*name(F.col("path")))
    texts = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt").select(*name(F.col("_metadata.file_path")), F.col("value").alias("text"))
    return there.join(texts, ["engine", "page_id"], "left").select("engine", "page_id", F.coalesce("text", F.lit("")).alias("text"))


def images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images of the five suffixes; a file that does not decode fails the read."""
    glob = "*.{" + ",".join(IMAGE_SUFFIXES) + "}"
    return spark.read.format("image").option("dropInvalid", False).option("pathGlobFilter", glob).load(path).select("image.*")


@F.pandas_udf(T.StructType().add("width", T.IntegerType()).add("height", T.IntegerType()))
def jpeg_size(content: pd.Series) -> pd.DataFrame:
    """Width and height from the first frame header of a JPEG; null where there is none."""
    # Frame headers are C0 to CF without C4, C8 and CC; D0 to D9 and 01 stand alone.
    frames = set(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}
    out = []
    for raw in content:
        size, at = (None, None), 2
        while raw and raw[:2] == b"\xff\xd8" and at + 9 <= len(raw) and raw[at] == 0xFF:
            kind = raw[at + 1]
            if kind == 0xFF:
                at += 1
            elif kind in frames:
                size = (int.from_bytes(raw[at + 7 : at + 9], "big"), int.from_bytes(raw[at + 5 : at + 7], "big"))
                break
            elif kind == 0x01 or 0xD0 <= kind <= 0xD9:
                at += 2
            else:
                at += 2 + int.from_bytes(raw[at + 2 : at + 4], "big")
        out.append(size)
    return pd.DataFrame(out, columns=["width", "height"])


def pdf_pages(report: Column) -> Column:
    """The page count in a PDF report's text."""
    return F.nullif(F.regexp_extract(report, r"(?m)^Pages:\s+(\d+)\s*$", 1), F.lit("")).try_cast("int")


def embedded_pair(sizes: DataFrame) -> DataFrame:
    """Sheets whose extracted images are exactly two of 750 by 1200 (sheet, index, width, height): sheet, accepted."""
    fits = ((F.col("width") == 750) & (F.col("height") == 1200)).cast("int")
    return sizes.groupBy("sheet").agg(((F.count("*") == 2) & (F.sum(fits) == 2)).alias("accepted"))


def split_spread(spreads: DataFrame) -> DataFrame:
    """Decoded spreads (origin, height, width, nChannels, mode, data) cut at the middle; of an odd width the left half gets the smaller part."""

    def cut(frames):
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                pixels = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.nChannels)
                middle = r.width // 2
                for side, part in (("left", pixels[:, :middle]), ("right", pixels[:, middle:])):
                    rows.append((r.origin, side, r.height, part.shape[1], r.nChannels, r.mode, np.ascontiguousarray(part).tobytes()))
            yield pd.DataFrame(rows, columns=["origin", "side", "height", "width", "nChannels", "mode", "data"])

    return spreads.mapInPandas(cut, "origin string, side string, height int, width int, nChannels int, mode int, data binary")


def text_statistics(df: DataFrame, key: str, text: str) -> DataFrame:
    """Characters, non-blank characters, letters, replacement characters and lines of each text."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = lambda p: F.regexp_count(t, F.lit(p)).cast("long")
    return df.select(key, F.length(t).cast("long").alias("chars"), n(r"(?U)\S").alias("non_blank"), n(r"\p{L}").alias("letters"), n("�").alias("replacements"), n("\n").alias("line_feeds"))


def benchmark_ids(spark: SparkSession, path: str | None) -> DataFrame:
    """Ids of the held-out samples; a missing file is no ids."""
    if path is None or not listed_files(spark, path.rpartition("/")[0], path.rpartition("/")[2]).take(1):
        return spark.createDataFrame([], "id string")
    return records(spark, path, "benchmark_samples").select("id").distinct()
