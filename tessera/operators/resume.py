"""What earlier runs have done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.schema import KEY
from tessera.sources.sinks import has_files, index_path, read_records


def parse_index(lines: DataFrame) -> DataFrame:
    """Keys of index lines (column value): three fields parted by tabs, or a JSON object. Blank lines are no
    keys; any other line that isn't one has a null source_row."""
    text = F.trim("value")
    parts = F.split(F.trim("value"), "\t")
    old = F.from_json(text, "source_file string, source_row bigint, rollout_index bigint")
    is_json = text.startswith("{")
    keys = lines.where(text != "").select(
        F.when(is_json, old["source_file"]).otherwise(parts[0]).alias("source_file"),
        F.when(is_json, F.when(old["source_file"].isNotNull(), old["source_row"])).when(F.size(parts) == 3, F.try_element_at(parts, F.lit(2)).try_cast("long")).alias("source_row"),
        F.when(is_json, F.coalesce(old["rollout_index"], F.lit(0))).when(F.size(parts) == 3, F.try_element_at(parts, F.lit(3)).try_cast("long")).alias("rollout_index"),
    )
    return keys.withColumn("source_row", F.when(F.col("rollout_index").isNotNull(), F.col("source_row")))


def read_index(spark: SparkSession, output_dir: str, files: list[str] | None = None) -> DataFrame | None:
    """Completed keys, of these files only if given; None if there is no index or a line of it is broken."""
    path = index_path(output_dir)
    if not has_files(spark, path):
        return None
    keys = parse_index(spark.read.option("recursiveFileLookup", "true").text(path))
    if not keys.where("source_row is null").isEmpty():
        return None
    return of_files(keys, files).distinct()


def of_files(keys: DataFrame, files: list[str] | None) -> DataFrame:
    """Keys of the given files, by a semi-join: the list can be long."""
    if files is None:
        return keys
    wanted = keys.sparkSession.createDataFrame([(f,) for f in files], "source_file string")
    return keys.join(wanted, "source_file", "left_semi")


def completed(spark: SparkSession, output_dir: str, files: list[str] | None = None) -> DataFrame:
    """Completed keys from the index, or from the stored records where the index is missing or broken."""
    keys = read_index(spark, output_dir, files)
    if keys is not None:
        return keys
    return of_files(read_records(spark, output_dir, "all", KEY).select("source_file", "source_row", F.coalesce("rollout_index", F.lit(0)).cast("long").alias("rollout_index")), files).distinct()


def progress(spark: SparkSession, output_dir: str) -> dict[str, int]:
    """Distinct keys written, correct and cut off by length."""
    records = read_records(spark, output_dir, "all", [*KEY, "generation_finish_reason", "is_correct"])
    key = F.struct(*KEY)
    row = records.agg(
        F.countDistinct(key).alias("written"),
        F.countDistinct(F.when(F.col("is_correct").eqNullSafe(True), key)).alias("correct"),
        F.countDistinct(F.when(F.col("generation_finish_reason") == "length", key)).alias("overlong"),
    ).first()
    return row.asDict()


def rebuild_index(spark: SparkSession, output_dir: str) -> int:
    """Write the index anew from the stored records; the number of keys."""
    keys = read_records(spark, output_dir, "all", KEY).select(F.translate("source_file", "\t", " ").alias("source_file"), "source_row", F.coalesce("rollout_index", F.lit(0)).alias("rollout_index")).distinct()
    keys.write.mode("overwrite").option("sep", "\t").option("quote", "").csv(index_path(output_dir))
    return spark.read.option("recursiveFileLookup", "true").text(index_path(output_dir)).count()


def failed(spark: SparkSession, path: str) -> DataFrame | None:
    """Keys on the failure record; lines that hold none are passed over."""
    if not has_files(spark, path):
        return None
    rows = spark.read.schema("source_file string, source_row bigint, rollout_index bigint, reason string").json(path)
    return rows.where("source_file is not null and source_row is not null").select("source_file", "source_row", F.coalesce("rollout_index", F.lit(0)).alias("rollout_index")).distinct()


def next_index(names: DataFrame, pattern: str = r"segment_(\d+)") -> int:
    """One more than the largest number in column name; 0 without any."""
    top = names.agg(F.max(F.regexp_extract("name", pattern, 1).try_cast("long"))).first()[0]
    return 0 if top is None else top + 1

