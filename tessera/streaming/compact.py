"""Incremental compaction of segments into shards.

A manifest names every segment that is in a shard, with its size, rows, token counts and batch. Segments
not in it are packed whole, in order of their names, into shards of about the target size. The shard is
written first and the manifest entry last; shards of a batch that never reached the manifest are removed
before the next run, so a crash between the two neither loses nor doubles a record.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.schema import RECORD
from tessera.operators.stats import TOKEN_FIELDS, merge_token_sums, token_sums

_MANIFEST = "segment string, bytes long, records long, batch string, shard long, " + ", ".join(f"{f}_{k} long" for k in ("count", "sum") for f in TOKEN_FIELDS)


def pack_sizes(sizes: Iterable[int], target: int) -> list[int]:
    """Shard numbers of segments in order: a new shard where the open one, if it holds anything, would grow past the target."""
    out, shard, held, any_ = [], 0, 0, False
    for size in sizes:
        if any_ and held + size > target:
            shard, held = shard + 1, 0
        held, any_ = held + size, True
        out.append(shard)
    return out


def pack_segments(segments: DataFrame, target: int) -> DataFrame:
    """segments (name, bytes; a list short enough for one row) with the shard each goes to, as one fold in the JVM."""
    names = segments.agg(F.sort_array(F.collect_list(F.struct("name", "bytes"))).alias("all"))
    fold = f"""aggregate(all, named_struct('held', cast(-1 as bigint), 'shard', 0, 'out', cast(array() as array<int>)),
        (a, x) -> if(a.held >= 0 and a.held + x.bytes > {int(target)},
            named_struct('held', x.bytes, 'shard', a.shard + 1, 'out', concat(a.out, array(a.shard + 1))),
            named_struct('held', greatest(a.held, 0L) + x.bytes, 'shard', a.shard, 'out', concat(a.out, array(a.shard)))), a -> a.out)"""
    return names.select(F.explode(F.arrays_zip("all", F.expr(fold).alias("shard"))).alias("z")).select("z.all.name", "z.all.bytes", "z.shard")


def manifest_path(output_dir: str, stream: str) -> str:
    return f"{output_dir.rstrip('/')}/{stream}/.merged"


def read_manifest(spark: SparkSession, output_dir: str, stream: str) -> DataFrame:
    from tessera.sources.sinks import has_files

    path = manifest_path(output_dir, stream)
    return spark.read.schema(_MANIFEST).parquet(path) if has_files(spark, path) else spark.createDataFrame([], _MANIFEST)


def _figures(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(segment, records, bytes of text and token figures) of segment files. A blank line is no record."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_name").alias("segment"), "value").where("trim(value) <> ''")
    tokens = {f: F.get_json_object("value", f"$.{f}").try_cast("long") for f in TOKEN_FIELDS}
    return lines.groupBy("segment").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.octet_length("value") + 1).alias("text_bytes"),
        *[F.count(v).alias(f"{f}_count") for f, v in tokens.items()],
        *[F.coalesce(F.sum(v), F.lit(0)).alias(f"{f}_sum") for f, v in tokens.items()],
    )


def new_segments(spark: SparkSession, output_dir: str, stream: str) -> list[tuple[str, str, int]]:
    """(path, name, bytes) of committed segments that no shard holds yet, by name: from the file system's listing,
    less the manifest's names. No segment is opened."""
    from tessera.sources.sinks import segment_files

    every = segment_files(spark, output_dir, stream)
    if not every:
        return []
    names = spark.createDataFrame(every, "path string, segment string, bytes long")
    left = names.join(read_manifest(spark, output_dir, stream).select("segment"), "segment", "left_anti")
    return [(r["path"], r["segment"], r["bytes"]) for r in left.orderBy("segment").collect()]


def _drop_unlisted(spark: SparkSession, shards: str, batches: set[str]) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shards)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        for status in fs.listStatus(path):
            name = status.getPath().getName()
            if name.startswith("batch=") and name.removeprefix("batch=") not in batches:
                fs.delete(status.getPath(), True)


def compact(spark: SparkSession, output_dir: str, stream: str = "correct", target_bytes: int = 200 << 20) -> dict:
    """Pack the stream's new segments into shards; the summary. A second run without new segments adds nothing."""
    from tessera.sources.sinks import has_files, stream_path

    source, shards = stream_path(output_dir, stream, "segments"), stream_path(output_dir, stream, "shards")
    if not has_files(spark, source):
        raise FileNotFoundError(f"no segments at {source}")
    known = read_manifest(spark, output_dir, stream)
    _drop_unlisted(spark, shards, {r[0] for r in known.select("batch").distinct().collect()})
    found = new_segments(spark, output_dir, stream)
    paths = [path for path, _, _ in found]
    figures = {r["segment"]: r.asDict() for r in _figures(spark, paths).collect()} if found else {}
    blank = {"records": 0} | {f"{f}_{k}": 0 for f in TOKEN_FIELDS for k in ("count", "sum")}
    new = [blank | figures.get(name, {}) | {"segment": name, "bytes": size} for _, name, size in found]
    for r in new:  # shards are measured by the text in them, compressed or not
        text_bytes = r.pop("text_bytes", 0)
        if r["segment"].endswith(".gz"):
            r["bytes"] = text_bytes
    if new:
        batch = uuid.uuid4().hex
        numbers = pack_sizes([r["bytes"] for r in new], target_bytes)
        entries = [{**r, "batch": batch, "shard": n} for r, n in zip(new, numbers)]
        chosen = spark.createDataFrame(entries, _MANIFEST)
        rows = spark.read.schema(RECORD).json(paths).withColumn("segment", F.col("_metadata.file_name"))
        placed = rows.join(chosen.select("segment", "shard"), "segment").drop("segment")
        # One task and one file a shard.
        placed.repartition(numbers[-1] + 1, "shard").write.partitionBy("shard").parquet(f"{shards}/batch={batch}")
        chosen.coalesce(1).write.mode("append").parquet(manifest_path(output_dir, stream))
    after = read_manifest(spark, output_dir, stream)
    row = merge_token_sums(after.select("records", *[f"{f}_{k}" for k in ("count", "sum") for f in TOKEN_FIELDS])).first().asDict()
    sums, counts = ({f: row[f"{f}_{k}"] or 0 for f in TOKEN_FIELDS} for k in ("sum", "count"))
    return {
        "stream": stream,
        "merged_segments_this_run": len(new),
        "merged_records_this_run": sum(r["records"] for r in new),
        "shards_written_this_run": len({n for n in pack_sizes([r["bytes"] for r in new], target_bytes)}),
        "merged_segments_total": after.count(),
        "total_records": row["records"] or 0,
        "token_sums": sums,
        "token_counts": counts,
        "average_tokens": {f: round(sums[f] / counts[f], 4) if counts[f] else None for f in TOKEN_FIELDS},
    }


def compact_stream(spark: SparkSession, output_dir: str, stream: str, checkpoint: str, max_files: int = 1000):
    """The same as a file stream: what has come since the last run, once, then it stops. Await the query."""
    from tessera.sources.sinks import stream_path

    rows = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", "true").json(stream_path(output_dir, stream, "segments"))
    target = stream_path(output_dir, stream, "stream_shards")

    def merge(batch: DataFrame, number: int) -> None:
        # A batch that is run again after a crash overwrites its own folder.
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")
        token_sums(batch).write.mode("overwrite").json(f"{target}/.sums/batch={number}")

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
