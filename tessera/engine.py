"""A run from files to judged records: scan, tasks, generation, verdicts, streams.

A run goes through its files in groups of active_files, and through a group in rounds; a round ends with the
commit of its answers as one batch. What the client has answered is on disk before anything else reads it, in
the output's work folder, and stays there until its batch is committed: the next run judges and commits what
an earlier one left, whatever stopped it, before it asks for anything.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import Settings
from tessera.operators import generate, judge, records, resume, tasks
from tessera.operators.generate import ChatClient, Client
from tessera.operators.schema import KEY
from tessera.sources import scan, sinks
from tessera.streaming import compact


def _work(s: Settings) -> str:
    """The work folder of this run's range of files; runs over other ranges may be under way beside it."""
    return f"{s.output_dir.rstrip('/')}/.work/{s.range_start}_{'END' if s.range_end is None else s.range_end}"


def staged(df: DataFrame, path: str, by_task: bool = False) -> DataFrame:
    """df written under path and read back, so that no later stage repeats it. by_task: a task's rows are there
    when the task is done, though the job may stop before its end."""
    writer = df.write.mode("overwrite")
    if by_task:
        writer = writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def readable(spark: SparkSession, files: list[str]) -> tuple[list[str], list[str]]:
    """(files, broken ones): each file is only looked at by itself where the group can't be read as a whole."""
    try:
        scan.scan(spark, files)
        return files, []
    except (PySparkException, Py4JJavaError):
        pass
    good, broken = [], []
    for f in files:
        try:
            scan.scan(spark, [f])
            good.append(f)
        except (PySparkException, Py4JJavaError) as e:
            warnings.warn(f"passed over a file that can't be read: {f}: {str(e)[:200]}", stacklevel=2)
            broken.append(f)
    return good, broken


def pending_tasks(spark: SparkSession, s: Settings, files: list[str], done: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tasks still to be done, new failures of rows without a prompt) of the files; done: completed keys."""
    every, empty = tasks.make_tasks(scan.scan(spark, files), s.input_field, s.rollout_count, s.names)
    failed = resume.failed(spark, s.failure_path)
    return tasks.pending(every, resume.of_files(done, files), failed), tasks.new_failures(empty, failed)


def commit(spark: SparkSession, s: Settings, folder: str, name: str) -> int:
    """Judge the answers in a work folder and append them as the batch of that name; the number of answers.

    Any step can be repeated: failures on record aren't added again, the batch overwrites itself.
    """
    if name not in sinks.committed(spark, s.output_dir):
        generated = spark.read.parquet(folder)
        answers, failures = generate.split(generated)
        known = resume.failed(spark, s.failure_path)
        fresh = failures if known is None else failures.join(known, KEY, "left_anti")
        sinks.append_failures(staged(fresh, f"{folder}.failures"), s.failure_path)
        made = [c for c in ("messages", "finish_reason", "usage", "prompt_text", *KEY) if c in answers.columns]
        judged = judge.judge(answers, [c for c in answers.columns if c not in made], label=s.label_field, seconds=s.judge_timeout_sec, most=s.judge_concurrency)
        # Judged once: both streams and the index read the written records.
        sinks.append_records(staged(records.build(judged), f"{folder}.records"), s.output_dir, s.segment_size_mb << 20, name, s.write_retries)
    count = spark.read.parquet(folder).count()
    for path in (folder, f"{folder}.failures", f"{folder}.records"):
        sinks.delete(spark, path)
    return count


def recover(spark: SparkSession, s: Settings) -> int:
    """Commit the answers that stopped runs have left; how many there were."""
    for stream in sinks.STREAMS:
        sinks.finish_replace(spark, s.output_dir, stream)
    found = 0
    for path, name, folder, _ in sinks.listed(spark, _work(s)):
        if folder and name.startswith("answers-") and "." not in name:
            whole = any(not is_folder and n.endswith(".parquet") for _, n, is_folder, _ in sinks.listed(spark, path))
            if whole:
                found += commit(spark, s, path, name)
    sinks.delete(spark, _work(s))
    return found


def run(spark: SparkSession, s: Settings, client: Callable[[], Client] | None = None, report: Callable[[dict[str, Any]], None] | None = None, stop: Callable[[], bool] = lambda: False) -> dict[str, int]:
    """Do what is pending; a second run adds nothing.

    report gets the figures of each round; when stop() holds, the run ends after the round under way, with all
    its answers committed, and leaves the rest pending.
    """
    tell = report or (lambda _: None)
    if left := recover(spark, s):
        tell({"recovered": left})
    files = scan.slice_files(scan.list_files(spark, s.input_dir, s.file_pattern), s.range_start, s.range_end)
    # The completed keys of these files, sorted by file: a group of files reads its own part.
    done = staged(resume.completed(spark, s.output_dir, files).sort("source_file"), f"{_work(s)}/done") if files else None
    model, key, size, seconds = s.model, s.api_key, s.max_tokens, s.llm_timeout
    open_client = client or (lambda: ChatClient(model, key, size, seconds))
    alive = generate.process_alive(s.list_command) if s.list_command else None
    slots = max(1, min(spark.sparkContext.defaultParallelism, s.concurrency))
    figures = {"files": 0, "answered": 0, "failed": 0}
    width = s.active_files if s.active_files > 0 else max(1, len(files))
    for at in range(0, len(files), width):
        if stop():
            break
        group, broken = readable(spark, files[at : at + width])
        figures |= {"files": figures["files"] + len(group) + len(broken)}
        if broken:
            lost = spark.createDataFrame([(f, -1, 0, "unreadable_file") for f in broken], "source_file string, source_row long, rollout_index long, reason string")
            sinks.append_failures(tasks.new_failures(lost, resume.failed(spark, s.failure_path)), s.failure_path)
        if not group:
            continue
        todo, empty = pending_tasks(spark, s, group, done)
        sinks.append_failures(staged(empty, f"{_work(s)}/empty"), s.failure_path)
        todo = staged(todo.repartition(slots), f"{_work(s)}/todo")
        while not todo.isEmpty():
            name = f"answers-{uuid.uuid4().hex}"
            folder = f"{_work(s)}/{name}"
            interval = s.segment_flush_interval_sec if s.segment_flush_interval_sec > 0 else None
            made = staged(generate.generate(todo, open_client, s.urls, s.concurrency, alive, s.batch_size, interval), folder, by_task=True)
            row = made.agg(F.count_if(F.col("reason").isNull()).alias("answered"), F.count_if(F.col("reason").isNotNull()).alias("failed")).first()
            figures |= {k: figures[k] + row[k] for k in ("answered", "failed")}
            rest = staged(todo.join(made.select(*KEY), KEY, "left_anti").repartition(slots), f"{_work(s)}/todo-{name}") if interval else None
            commit(spark, s, folder, name)
            tell(figures | {"of_files": len(files)})
            if rest is None or stop():
                break
            todo = rest
    for stream in sinks.STREAMS:
        if sinks.has_files(spark, sinks.stream_path(s.output_dir, stream, "segments")):
            compact.compact(spark, s.output_dir, stream, s.shard_size_mb << 20)
    sinks.delete(spark, _work(s))
    return resume.progress(spark, s.output_dir) if files else {"written": 0, "correct": 0, "overlong": 0}
