"""Scans that know where each row came from."""

from __future__ import annotations

import os
import warnings
from collections.abc import Iterable
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.jsontext import valid_line
from tessera.operators.judge import text_kernel


def list_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> list[str]:
    """Sorted paths of the folder's files that match, by Hadoop's listing, on any file system."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder if urlparse(folder).scheme else os.path.abspath(folder), pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(_plain(s.getPath().toString()) for s in found or ())


def _plain(uri: str) -> str:
    """Local paths without scheme and escapes; others as they are."""
    parts = urlparse(uri)
    return unquote(parts.path) if parts.scheme == "file" else uri


def slice_files(files: list[str], start: int = 0, end: int | None = None) -> list[str]:
    """Files start to end (exclusive); a negative end counts from the back."""
    return files[max(0, start) : len(files) if end is None else min(end, len(files))]


def source_file() -> Column:
    """The row's file as list_files() names it. Only % and a scheme of local files are undone."""
    path = F.col("_metadata.file_path")
    return F.when(path.startswith("file:"), F.url_decode(F.regexp_replace(F.regexp_replace(path, r"^file:(//)?", ""), r"\+", "%2B"))).otherwise(path)


def split_dirs(spark: SparkSession, root: str, splits: Iterable[str]) -> list[str]:
    """Parquet files of the splits' folders; a missing folder has none."""
    return [f for s in splits for f in list_files(spark, f"{root.rstrip('/')}/{s}", "*.parquet")]


def estimate_rows(spark: SparkSession, files: list[str]) -> int | None:
    """Rows in the files: of Parquet from the footers (a count reads no column), of JSON lines the line count;
    None if a file can't be read."""
    parquet = [f for f in files if f.endswith(".parquet")]
    lines = [f for f in files if f.endswith(".jsonl")]
    try:
        return (spark.read.parquet(*parquet).count() if parquet else 0) + (spark.read.text(lines).count() if lines else 0)
    except Exception:  # a broken file makes the figure unknown, whatever Spark calls its fault
        return None


def scan_parquet(spark: SparkSession, files: list[str], skip_broken: bool = False) -> DataFrame:
    """Rows with source_file and source_row (physical, from 0). Files whose schemas differ are joined by name."""
    if skip_broken:
        reader = spark.read.option("ignoreCorruptFiles", "true")
    else:
        reader = spark.read
    df = reader.option("mergeSchema", "true").parquet(*files)
    return df.select("*", source_file().alias("source_file"), F.col("_metadata.row_index").alias("source_row"))


def scan_jsonl(spark: SparkSession, files: list[str], schema: T.StructType | None = None) -> DataFrame:
    """Valid rows of JSON-lines files with source_file and source_row (over valid lines, from 0).

    Rows are numbered after lines that are blank or no JSON are gone: within each split of a file, plus the
    lines of the splits before it, so one large file is no one task's work. Without a schema one is inferred
    over all files.
    """
    lines = spark.read.text(files).select(
        "value", source_file().alias("source_file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("order")
    )
    valid = lines.where(text_kernel(valid_line, "boolean")("value"))
    # A row for each split.
    before = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = valid.groupBy("source_file", "block").agg(F.count(F.lit(1)).alias("n"))
    bases = counts.select("source_file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("source_file", "block").orderBy("order")
    numbered = valid.withColumn("number", F.row_number().over(within) - 1).join(bases, ["source_file", "block"])
    rows = numbered.select("value", "source_file", (F.col("base") + F.col("number")).cast("long").alias("source_row"))
    if schema is None:
        schema = spark.read.option("mode", "DROPMALFORMED").json(files).schema
    return rows.select(F.from_json("value", schema).alias("row"), "source_file", "source_row").select("row.*", "source_file", "source_row")


def scan(spark: SparkSession, files: list[str], skip_broken: bool = False) -> DataFrame:
    """Rows of Parquet and JSON-lines files; files of other kinds are left out, with a warning."""
    from tessera.operators.schema import union_all

    other = [f for f in files if not f.endswith((".parquet", ".jsonl"))]
    if other:
        warnings.warn(f"{len(other)} files are neither .parquet nor .jsonl and are left out, as {other[0]}", stacklevel=2)
    parquet = [f for f in files if f.endswith(".parquet")]
    lines = [f for f in files if f.endswith(".jsonl")]
    frames = ([scan_parquet(spark, parquet, skip_broken)] if parquet else []) + ([scan_jsonl(spark, lines)] if lines else [])
    if not frames:
        return spark.createDataFrame([], "source_file string, source_row bigint")
    return union_all(frames)
