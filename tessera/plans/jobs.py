"""Offline jobs over stored records and datasets: judge again, rebuild, evaluate, prepare tests, look tests up."""

from __future__ import annotations

import json
import uuid
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import examples
from tessera.operators import judge as judging
from tessera.operators import resume, stats
from tessera.operators.judge import VERDICT, text_kernel
from tessera.operators.schema import KEY
from tessera.operators.tasks import trimmed
from tessera.sources import scan, sinks

# Columns an evaluation reads where they are, and datasets whose tests can be looked up.
EVALUATED = ("id", "input", "output", "solution", "input_output", "evaluation_sample", "public_test_cases", "private_test_cases", "metadata", "prompt", "test", "entry_point", "test_list", "test_list_2")
LOOKED_UP = {"apps": ("question", "input_output"), "taco": ("question", "input_output")}
_VERDICT = [f.name for f in VERDICT.fields]
SAMPLES = 20


def changed(old: str = "old", new: str = "new"):
    """Whether any of type, backend, status and verdict differ; nulls are values."""
    same = F.lit(True)
    for c in ("judge_type", "judge_backend", "judge_status", "is_correct"):
        same = same & F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}"))
    return ~same


def source_rows(records: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """Records with the given columns of the rows they came from, by file and row number."""
    found = rows.select("source_file", "source_row", F.struct(*columns).alias("source"))
    return records.join(found, ["source_file", "source_row"], "left")


def rejudge(records: DataFrame, rows: DataFrame, suspicious_only: bool = False, label: str | None = None, seconds: float | None = None) -> DataFrame:
    """Records with structs old and new of their verdicts and changed. Records that are not judged again keep theirs.

    No record is dropped and nothing is cut off: a limit belongs in the report.
    """
    have = [c for c in rows.columns if c not in ("source_file", "source_row")]
    chosen = judging.is_suspicious() if suspicious_only else F.lit(True)
    marked = records.withColumn("__again", F.coalesce(chosen, F.lit(False)))
    kept = marked.where(~F.col("__again")).select(*records.columns, F.struct(*_VERDICT).alias("old"), F.struct(*_VERDICT).alias("new"))
    again = source_rows(marked.where("__again").drop("__again").withColumn("old", F.struct(*_VERDICT)), rows, have)
    flat = again.select(*[c for c in records.columns if c not in _VERDICT], "old", *[F.col(f"source.{c}").alias(f"row_{c}") for c in have])
    judged = judging.judge(flat, have, label=label, seconds=seconds, prefix="row_")  # a name may be a column of the record too
    again = judged.select(*[F.col(f"old.{c}").alias(c) if c in _VERDICT else F.col(c) for c in records.columns], "old", F.struct(*_VERDICT).alias("new"))
    return kept.unionByName(again).withColumn("changed", changed())


def change_counts(rejudged: DataFrame) -> DataFrame:
    """(judge_status, is_correct, n) of the records whose verdict changed."""
    return rejudged.where("changed").groupBy(F.col("new.judge_status").alias("judge_status"), F.col("new.is_correct").alias("is_correct")).agg(F.count(F.lit(1)).alias("n"))


def rejudge_report(rejudged: DataFrame) -> dict[str, Any]:
    counts = change_counts(rejudged).collect()
    sample = rejudged.where("changed").orderBy(*KEY).limit(SAMPLES).select(*KEY, "new.*").collect()
    return {
        "processed_records": rejudged.count(),
        "changed_records": sum(r["n"] for r in counts),
        "changed_to": {f"{r['judge_status']}/{r['is_correct']}": r["n"] for r in counts},
        "changed_examples": [r.asDict() for r in sample],
    }


def suspicious_segments(spark: SparkSession, output_dir: str, stream: str = "all") -> DataFrame:
    """(segment) of the segments that hold a suspicious record: one partial aggregate, no shuffle of records."""
    rows = sinks.read_segments(spark, output_dir, stream, ["dataset_name", "judge_type", "judge_status", "judge_detail", "messages"])
    marked = rows.groupBy("segment").agg(F.bool_or(F.coalesce(judging.is_suspicious(), F.lit(False))).alias("suspicious"))
    return marked.where("suspicious").select("segment")


def rejudge_stored(spark: SparkSession, output_dir: str, suspicious_only: bool = False, label: str | None = None, seconds: float | None = None) -> dict[str, Any]:
    """Judge stored records again by the rows they came from and put what changed in place; the report.

    The new records are written beside the old ones before these go, as shards of a stream of their own name,
    so a run that stops leaves the old ones.
    """
    records = sinks.read_records(spark, output_dir, "all")
    files = [r[0] for r in records.select("source_file").distinct().collect()]  # as many as there are input files
    found = rejudge(records, scan.scan(spark, files), suspicious_only, label, seconds)
    work = f"{output_dir.rstrip('/')}/.work/rejudged-{uuid.uuid4().hex}"
    found.write.parquet(work)
    done = spark.read.schema(found.schema).parquet(work)
    report = rejudge_report(done)
    if report["changed_records"]:
        sinks.replace_records(done.select(*[F.col(f"new.{c}").alias(c) if c in _VERDICT else F.col(c) for c in records.columns]), output_dir)
        report |= rebuild_correct(spark, output_dir)
    sinks.delete(spark, work)
    return report


def rebuild_correct(spark: SparkSession, output_dir: str) -> dict[str, int]:
    """Write the stream of correct records anew from that of all, and the index with it."""
    everything = sinks.read_records(spark, output_dir, "all")
    sinks.replace_records(everything.where(F.col("is_correct").eqNullSafe(True)), output_dir, "correct")
    counts = everything.agg(F.count(F.lit(1)).alias("scanned_records"), F.count_if(F.col("is_correct").eqNullSafe(True)).alias("written_records"), F.count_if(F.col("generation_finish_reason").eqNullSafe("length")).alias("overlong_records")).first()
    return counts.asDict() | {"index_keys": resume.rebuild_index(spark, output_dir)}


def evaluate(rows: DataFrame, label: str | None = None, seconds: float | None = None) -> DataFrame:
    """Rows of a dataset (column output as the answer) with verdicts."""
    have = [c for c in EVALUATED if c in rows.columns]
    answer = F.coalesce(F.col("output").cast("string"), F.lit("")) if "output" in have else F.lit("")
    said = rows.select("source_file", "source_row", *have, F.array(F.struct(F.lit("assistant").alias("role"), answer.alias("content"))).alias("messages"))
    return judging.judge(said, have, label=label, seconds=seconds).withColumn("has_code_fence", answer.contains("```"))


def evaluation_report(evaluated: DataFrame, limit: int = 0) -> dict[str, Any]:
    """Counts and the first samples; a limit takes the first rows by file and number."""
    some = evaluated.orderBy("source_file", "source_row").limit(limit) if limit > 0 else evaluated
    out: dict[str, Any] = {"total": some.count()}
    for name, column in (("status_counter", "judge_status"), ("judge_type_counter", "judge_type"), ("backend_counter", "judge_backend"), ("code_fence_counter", "has_code_fence")):
        out[name] = {r[0]: r[1] for r in some.groupBy(column).count().collect()}
    out["sample_records"] = [r.asDict() for r in some.orderBy("source_file", "source_row").limit(SAMPLES).select("source_file", "source_row", *_VERDICT).collect()]
    return out


def _sample_json(*texts: str | None) -> str | None:
    found = examples.sample(dict(zip(examples.TEXT_COLUMNS, texts)))
    return json.dumps({"inputs": found["inputs"], "outputs": found["outputs"], "fn_name": None}, ensure_ascii=False) if found else None


def prepare(rows: DataFrame) -> DataFrame:
    """Rows with tests from the examples in their texts. Rows without an examples heading never leave the JVM's side."""
    parse = text_kernel(_sample_json, "string")
    text = [F.col(c) if dict(rows.dtypes).get(c) == "string" else F.lit(None).cast("string") for c in examples.TEXT_COLUMNS]
    heading = F.lit(False)
    for t in text:
        heading = heading | F.coalesce(t.rlike(r"(?i)(example|sample)"), F.lit(False))
    found = F.when(heading, parse(*(F.when(heading, t) for t in text)))
    return with_tests(rows.withColumn("__found", found), "__found", F.lit("prompt_examples"), "prompt_examples_v1", "parsed", F.size(F.from_json("__found", "inputs array<string>")["inputs"])).drop("__found")


def with_tests(rows: DataFrame, tests: str, source, parser: str, good: str, count) -> DataFrame:
    """rows with input_output from column tests and the four columns about it."""
    has = F.coalesce(F.col(tests), F.lit("")) != ""
    return rows.withColumns(
        {
            "input_output": F.coalesce(F.col(tests), F.lit("")),
            "generated_test_source": F.when(has, source).otherwise(""),
            "generated_test_parser": F.lit(parser),
            "generated_test_count": F.when(has, count).otherwise(0).cast("long"),
            "generated_test_status": F.when(has, good).otherwise("missing"),
        }
    )


def prepare_rollup(prepared: DataFrame) -> DataFrame:
    """Rows, parsed rows and examples by source_file, and over all in the row whose source_file is null."""
    good = F.col("generated_test_status") == "parsed"
    out = prepared.rollup("source_file").agg(F.count(F.lit(1)).alias("rows"), F.count_if(good).alias("parsed_rows"), F.coalesce(F.sum(F.when(good, F.col("generated_test_count"))), F.lit(0)).alias("total_examples"))
    rate = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return out.withColumns({"parse_rate": rate("parsed_rows", "rows"), "avg_examples_per_parsed_row": rate("total_examples", "parsed_rows")})


def prepare_files(spark: SparkSession, input_root: str, output_root: str, splits: list[str], overwrite: bool = False) -> dict[str, Any]:
    """Prepare the splits' files, one folder a split; a split that is there already is left alone unless told to."""
    reports = []
    for split in splits:
        files, target = scan.split_dirs(spark, input_root, [split]), f"{output_root.rstrip('/')}/{split}"
        if not files or (sinks.has_files(spark, target) and not overwrite):
            continue
        prepare(scan.scan_parquet(spark, files)).write.mode("overwrite").parquet(target)
        reports += [r.asDict() | {"split": split} for r in prepare_rollup(spark.read.parquet(target)).where("source_file is not null").collect()]
    total = {k: sum(r[k] for r in reports) for k in ("rows", "parsed_rows", "total_examples")}
    rate = lambda a, b: total[a] / total[b] if total[b] else 0.0
    return total | {"files_processed": len(reports), "parse_rate": rate("parsed_rows", "rows"), "avg_examples_per_parsed_row": rate("total_examples", "parsed_rows"), "files": reports}


def hydrate(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """rows (dataset, split, index, input, input_output) with question and tests of the dataset they came from.

    lookup: dataset, split, index (from 0), question, tests. The split that a row names is the one looked up.
    """
    wanted = F.lower("dataset").isin(*LOOKED_UP) & F.trim(F.col("index").cast("string")).rlike(r"^\d+$")
    keyed = rows.withColumns(
        {
            "__dataset": F.when(wanted, F.lower("dataset")),
            "__split": F.when(F.coalesce("split", F.lit("")) != "", F.col("split")).otherwise("train"),
            "__index": F.when(wanted, F.trim(F.col("index").cast("string")).try_cast("long")),
        }
    )
    found = lookup.select(F.lower("dataset").alias("__dataset"), F.col("split").alias("__split"), F.col("index").cast("long").alias("__index"), F.col("question").alias("__question"), F.coalesce(F.col("tests").cast("string"), F.lit("")).alias("__tests"))
    joined = keyed.join(found, ["__dataset", "__split", "__index"], "left")
    eligible = F.col("__dataset").isNotNull()
    tests = F.when(eligible, F.coalesce("__tests", F.lit(""))).otherwise(F.coalesce("input_output", F.lit("")))
    good = eligible & (F.coalesce("__tests", F.lit("")) != "")
    out = joined.withColumns(
        {
            "input": F.when(trimmed(F.col("__question")).isNotNull(), F.col("__question")).otherwise(F.col("input")),
            "input_output": tests,
            "generated_test_source": F.when(eligible, F.concat("__dataset", F.lit("_source_dataset"))).otherwise(""),
            "generated_test_parser": F.lit("source_dataset_v1"),
            "generated_test_count": F.when(good, 1).otherwise(0).cast("long"),
            "generated_test_status": F.when(good, "hydrated").otherwise("missing"),
        }
    )
    return out.drop("__dataset", "__split", "__index", "__question", "__tests")


def load_lookup(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(dataset, split, index, question, tests) of datasets stored as Parquet, one folder or file a split: paths maps
    "dataset/split" to it. Rows are numbered over the split's files in order of their names, as the index counts them.
    """
    frames = []
    for name, path in paths.items():
        dataset, _, split = name.partition("/")
        question, tests = LOOKED_UP[dataset.lower()]
        files = scan.list_files(spark, path, "*.parquet") or [path]
        rows = scan.scan_parquet(spark, files)
        counts = {r["source_file"]: r["n"] for r in rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("n")).collect()}
        at, bases = 0, []
        for f in files:
            bases.append((f, at))
            at += counts.get(f, 0)
        known = F.broadcast(spark.createDataFrame(bases, "source_file string, base long"))  # a row a file of the split
        column = lambda c: F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string")  # noqa: B023, E731
        frames.append(rows.join(known, "source_file").select(F.lit(dataset).alias("dataset"), F.lit(split or "train").alias("split"), (F.col("base") + F.col("source_row")).alias("index"), column(question).alias("question"), column(tests).alias("tests")))
    if not frames:
        return spark.createDataFrame([], "dataset string, split string, index long, question string, tests string")
    return reduce(DataFrame.unionByName, frames)


def hydrate_files(spark: SparkSession, input_root: str, output_root: str, splits: list[str], lookup: DataFrame, overwrite: bool = False) -> dict[str, Any]:
    """Hydrate the splits' files, one folder a split; a split that is there already is left alone unless told to."""
    rows = hydrated = done = 0
    for split in splits:
        files, target = scan.split_dirs(spark, input_root, [split]), f"{output_root.rstrip('/')}/{split}"
        if not files or (sinks.has_files(spark, target) and not overwrite):
            continue
        hydrate(spark.read.option("mergeSchema", "true").parquet(*files), lookup).write.mode("overwrite").parquet(target)
        row = hydrate_rate(spark.read.parquet(target)).first()
        rows, hydrated, done = rows + row["rows"], hydrated + row["hydrated"], done + 1
    return {"splits_processed": done, "rows": rows, "hydrated": hydrated, "hydrate_rate": hydrated / rows if rows else 0.0}


def evaluate_files(spark: SparkSession, input_dir: str, pattern: str = "*.parquet", limit: int = 0, label: str | None = None, seconds: float | None = None) -> dict[str, Any]:
    """The evaluation report of a folder's files. The verdicts are written once, as each figure reads them."""
    rows = scan.scan(spark, scan.list_files(spark, input_dir, pattern))
    if limit > 0:
        rows = rows.orderBy("source_file", "source_row").limit(limit)
    found = evaluate(rows, label, seconds)
    path = f"{sinks.scratch(spark)}/evaluated-{uuid.uuid4().hex}"
    found.write.parquet(path)
    try:
        return evaluation_report(spark.read.schema(found.schema).parquet(path))
    finally:
        sinks.delete(spark, path)


def hydrate_rate(hydrated: DataFrame) -> DataFrame:
    """One row: rows, hydrated and their ratio."""
    row = hydrated.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("generated_test_status") == "hydrated").alias("hydrated"))
    return row.withColumn("hydrate_rate", F.coalesce(F.try_divide(F.col("hydrated").cast("double"), F.col("rows")), F.lit(0.0)))


def report(spark: SparkSession, output_dir: str, stream: str = "all") -> dict[str, Any]:
    """The summary of a stream, from the few columns that it needs."""
    columns = ["judge_type", "judge_backend", "judge_status", "generation_finish_reason", "is_correct", "judge_detail"]
    return stats.summary(sinks.read_records(spark, output_dir, stream, columns))


def token_report(spark: SparkSession, output_dir: str, stream: str = "correct", only_correct: bool = False) -> dict[str, Any]:
    return {"output_dir": output_dir, "stream": stream} | stats.average_tokens(sinks.read_records(spark, output_dir, stream, [*stats.TOKEN_FIELDS, "is_correct"]), only_correct)
