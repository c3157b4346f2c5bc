"""Sinks: streams of records, the completed index, failures and summaries.

Records are appended in batches. A batch is a folder batch=<name> in each stream's segments and in the index,
and counts from the moment its name stands among the committed ones. Its folders are overwritten by a second
attempt under the same name, so a run that stops anywhere in between neither doubles nor loses a record.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from typing import Any
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.schema import FAILURE, RECORD, conform

STREAMS = ("all", "correct")
#: Batches whose name starts so are put in place whole, by a rename.
_WHOLE = "whole-"


def stream_path(output_dir: str, stream: str, kind: str) -> str:
    """Folder of a stream's segments or shards."""
    return f"{output_dir.rstrip('/')}/{stream}/{kind}"


def index_path(output_dir: str) -> str:
    return f"{output_dir.rstrip('/')}/.resume/completed_index"


def _hadoop(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """(file system, path) of a path on any file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def has_files(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def listed(spark: SparkSession, path: str) -> list[tuple[str, str, bool, int]]:
    """(path, name, is a folder, bytes) of what stands in a folder, hidden files left out, by name."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return []
    found = [(s.getPath().toString(), s.getPath().getName(), s.isDirectory(), s.getLen()) for s in fs.listStatus(p)]
    return sorted((f for f in found if not f[1].startswith(("_", "."))), key=lambda f: f[1])


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced at once where the file system can rename."""
    fs, p = _hadoop(spark, path)
    fs.mkdirs(p.getParent())
    _, new = _hadoop(spark, f"{path}.{uuid.uuid4().hex}.new")
    out = fs.create(new, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    fs.delete(p, False)
    fs.rename(new, p)


def scratch(spark: SparkSession) -> str:
    """The folder driver and executors share: spark.checkpoint.dir, or the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return (base or f"{spark.conf.get('spark.sql.warehouse.dir')}/.tessera").rstrip("/")


def retried(times: int, write: Callable[[], None], sleep: Callable[[float], None] = time.sleep) -> None:
    """write(), up to ``times`` times, for writes that a second attempt overwrites."""
    for attempt in range(1, max(1, times) + 1):
        try:
            return write()
        except (PySparkException, Py4JJavaError):
            if attempt >= times:
                raise
            sleep(min(5 * attempt, 15))


def committed(spark: SparkSession, output_dir: str) -> set[str]:
    return {name for _, name, _, _ in listed(spark, f"{output_dir.rstrip('/')}/.resume/batches")}


def append_records(records: DataFrame, output_dir: str, segment_bytes: int = 4 << 20, batch: str | None = None, retries: int = 1) -> None:
    """Append records to the stream of all and the correct ones to theirs, then their keys to the index, as one batch.

    records must be read from files, not recomputed: both streams and the index then agree. Files hold about
    segment_bytes of JSON, compressed: most of a record are names of keys.
    """
    spark, name = records.sparkSession, batch or uuid.uuid4().hex
    if name in committed(spark, output_dir):
        return
    records = conform(records, RECORD)
    per_file = max(1, segment_bytes // 4096)
    for stream, rows in (("all", records), ("correct", records.where(F.col("is_correct").eqNullSafe(True)))):
        _segments(rows, f"{stream_path(output_dir, stream, 'segments')}/batch={name}", per_file, retries)
    keys = records.select(F.translate("source_file", "\t", " ").alias("source_file"), "source_row", F.coalesce("rollout_index", F.lit(0)).alias("rollout_index"))
    retried(retries, lambda: keys.write.mode("overwrite").option("sep", "\t").option("quote", "").csv(f"{index_path(output_dir)}/batch={name}"))
    put_text(spark, f"{output_dir.rstrip('/')}/.resume/batches/{name}", "")


def _segments(rows: DataFrame, path: str, per_file: int, retries: int = 1) -> None:
    retried(retries, lambda: rows.write.mode("overwrite").option("maxRecordsPerFile", per_file).option("ignoreNullFields", "false").option("compression", "gzip").json(path))


def replace_records(records: DataFrame, output_dir: str, stream: str = "all", segment_bytes: int = 4 << 20) -> None:
    """Put records in the place of all that a stream holds. They must not be read from that stream itself. What
    is there goes only when the new records are whole; finish_replace() ends what a stopped run left half done."""
    spark, new = records.sparkSession, f"{output_dir.rstrip('/')}/{stream}/.new"
    delete(spark, new)
    _segments(conform(records, RECORD), f"{new}/batch={_WHOLE}{uuid.uuid4().hex}", max(1, segment_bytes // 4096))
    finish_replace(spark, output_dir, stream)


def finish_replace(spark: SparkSession, output_dir: str, stream: str) -> None:
    root = f"{output_dir.rstrip('/')}/{stream}"
    whole = [path for path, _, folder, _ in listed(spark, f"{root}/.new") if folder and has_files(spark, f"{path}/_SUCCESS")]
    if whole:
        for old in ("segments", "shards", ".merged"):
            delete(spark, f"{root}/{old}")
        fs, new = _hadoop(spark, f"{root}/.new")
        fs.rename(new, _hadoop(spark, f"{root}/segments")[1])
    delete(spark, f"{root}/.new")


def append_failures(failures: DataFrame, path: str) -> None:
    conform(failures, FAILURE).write.mode("append").json(path)


def segment_roots(spark: SparkSession, output_dir: str, stream: str) -> list[tuple[str, bool]]:
    """(path, is a folder) of a stream's committed batches and of segment files that stand by themselves."""
    known = committed(spark, output_dir)
    roots = []
    for path, name, folder, _ in listed(spark, stream_path(output_dir, stream, "segments")):
        batch = name.removeprefix("batch=")
        if not folder or batch.startswith(_WHOLE) or batch in known:
            roots.append((path, folder))
    return roots


def segment_files(spark: SparkSession, output_dir: str, stream: str) -> list[tuple[str, str, int]]:
    """(path, name, bytes) of a stream's segments, by name."""
    files = []
    for path, folder in segment_roots(spark, output_dir, stream):
        if folder:
            files += [(p, n, size) for p, n, is_folder, size in listed(spark, path) if not is_folder]
        else:
            files.append((path, path.rsplit("/", 1)[-1], _hadoop(spark, path)[0].getFileStatus(_hadoop(spark, path)[1]).getLen()))
    return sorted(files, key=lambda f: f[1])


def read_segments(spark: SparkSession, output_dir: str, stream: str = "all", columns: list[str] | None = None) -> DataFrame:
    """Records in a stream's segments, only the columns asked for, with the name of each one's segment."""
    wanted = RECORD if columns is None else type(RECORD)([f for f in RECORD.fields if f.name in columns])
    roots = [path for path, _ in segment_roots(spark, output_dir, stream)]
    if not roots:
        return spark.createDataFrame([], type(RECORD)([*wanted.fields]).add("segment", "string"))
    rows = spark.read.schema(wanted).option("recursiveFileLookup", "true").json(roots)
    return rows.withColumn("segment", F.col("_metadata.file_name"))


def read_records(spark: SparkSession, output_dir: str, stream: str = "all", columns: list[str] | None = None) -> DataFrame:
    """Records of a stream: its shards and those segments that are in none, only the columns asked for."""
    from tessera.streaming.compact import manifest_path, read_manifest

    wanted = RECORD if columns is None else type(RECORD)([f for f in RECORD.fields if f.name in columns])
    shards = stream_path(output_dir, stream, "shards")
    rows = read_segments(spark, output_dir, stream, columns)
    if has_files(spark, manifest_path(output_dir, stream)):
        rows = rows.join(read_manifest(spark, output_dir, stream).select("segment"), "segment", "left_anti")
    rows = rows.drop("segment")
    if has_files(spark, shards):
        rows = conform(spark.read.option("mergeSchema", "true").parquet(shards), wanted).unionByName(rows)
    return rows


def write_summary(summary: dict[str, Any], path: str | None = None, spark: SparkSession | None = None) -> str:
    """Sorted JSON of a summary, and a file of it put in place at once: on any file system if a session is given."""
    text = json.dumps(summary, ensure_ascii=False, indent=2, sort_keys=True, default=str)
    if path and spark is not None:
        put_text(spark, path, text + "\n")
    elif path:
        import os

        if urlparse(path).scheme:
            raise ValueError(f"a session is needed to write {path}")
        os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
        with open(f"{path}.new", "w", encoding="utf-8") as f:
            f.write(text + "\n")
        os.replace(f"{path}.new", path)
    return text
