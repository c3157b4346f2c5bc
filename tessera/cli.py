"""Command line: python -m tessera.cli JOB ...; JOBS names the jobs."""

from __future__ import annotations

import argparse
import json
import signal
import sys
from collections.abc import Callable
from pathlib import Path

from tessera import config

_TEXT = ("config", "config_name", "task", "manifest_dir", "input_dir", "output_dir", "failure_log", "file_pattern", "model", "api_key", "list_command", "input_field", "label_field")
_WHOLE = ("range_start", "range_end", "concurrency", "judge_concurrency", "active_files", "rollout_count", "max_tokens", "shard_size_mb", "segment_size_mb", "batch_size", "write_retries")
JOBS = ("run", "stats", "tokens", "compact", "rebuild", "rejudge", "evaluate", "prepare", "hydrate", "load")
_DECIMAL = ("judge_timeout_sec", "llm_timeout", "segment_flush_interval_sec")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera", description="Produce, judge and analyse model-generated records on Spark.")
    p.add_argument("job", nargs="?", default="run", choices=JOBS)
    for names, kind in ((_TEXT, str), (_WHOLE, int), (_DECIMAL, float)):
        for n in names:
            p.add_argument("--" + n.replace("_", "-"), type=kind, default=argparse.SUPPRESS)
    p.add_argument("--base-url", "--base-urls", dest="base_urls", nargs="+", default=argparse.SUPPRESS)
    p.add_argument("--ports", nargs="+", default=argparse.SUPPRESS)
    p.add_argument("--list-configs", action="store_true")
    p.add_argument("--stream", default="all", help="stream of the stats, tokens and compact jobs")
    p.add_argument("--only-correct", action="store_true")
    p.add_argument("--splits", nargs="*", default=["split_0", "split_1"])
    p.add_argument("--overwrite", action="store_true")
    p.add_argument("--summary", help="file for the job's summary, on any file system")
    p.add_argument("--suspicious-only", action="store_true", help="rejudge: records whose verdict rests on a doubtful test")
    p.add_argument("--limit", type=int, default=0, help="evaluate: the first rows only")
    p.add_argument("--lookup", nargs="*", default=[], metavar="DATASET/SPLIT=PATH", help="hydrate: Parquet files of the datasets to look up")
    p.add_argument("--requests", type=int, default=1000, help="load: requests to send")
    p.add_argument("--prompt-chars", type=int, default=6000, help="load: characters of a prompt")
    return p


_OWN = ("job", "stream", "only_correct", "splits", "overwrite", "summary", "suspicious_only", "limit", "lookup", "requests", "prompt_chars")


def main(argv: list[str] | None = None) -> int:
    args = vars(parser().parse_args(argv))
    own = argparse.Namespace(**{k: args.pop(k) for k in _OWN})
    if args["list_configs"]:
        for path in config.list_configs(Path(args.get("manifest_dir") or "manifest")):
            print(path, *[t["task_name"] for t in config.load_tasks(path)])
        return 0
    from pyspark.sql import SparkSession

    from tessera import engine
    from tessera.plans import jobs, loadtest
    from tessera.sources.sinks import write_summary
    from tessera.streaming import compact

    runs = config.resolve(args)
    spark = SparkSession.builder.appName("tessera").getOrCreate()
    stopping = _stop_on_signals() if own.job == "run" else (lambda: False)
    for s in runs:
        found = {
            "run": lambda s=s: engine.run(spark, s, report=_progress, stop=stopping),
            "stats": lambda s=s: jobs.report(spark, s.output_dir, own.stream),
            "tokens": lambda s=s: jobs.token_report(spark, s.output_dir, own.stream, own.only_correct),
            "compact": lambda s=s: compact.compact(spark, s.output_dir, own.stream, s.shard_size_mb << 20),
            "rebuild": lambda s=s: jobs.rebuild_correct(spark, s.output_dir),
            "rejudge": lambda s=s: jobs.rejudge_stored(spark, s.output_dir, own.suspicious_only, s.label_field, s.judge_timeout_sec),
            "evaluate": lambda s=s: jobs.evaluate_files(spark, s.input_dir, s.file_pattern, own.limit, s.label_field, s.judge_timeout_sec),
            "prepare": lambda s=s: jobs.prepare_files(spark, s.input_dir, s.output_dir, own.splits, own.overwrite),
            "hydrate": lambda s=s: jobs.hydrate_files(spark, s.input_dir, s.output_dir, own.splits, jobs.load_lookup(spark, dict(x.split("=", 1) for x in own.lookup)), own.overwrite),
            "load": lambda s=s: loadtest.run(spark, s, own.requests, own.prompt_chars),
        }[own.job]()
        print(write_summary(found, own.summary, spark))
        if stopping():
            break
    return 0


def _progress(figures: dict) -> None:
    """One line a round, for people and for what watches the process."""
    print(json.dumps(figures, sort_keys=True), file=sys.stderr, flush=True)


def _stop_on_signals() -> Callable[[], bool]:
    """Whether the process was asked to end. The first signal lets the round under way commit; the second one ends
    the process at once, and the next run takes up its answers."""
    asked: list[int] = []

    def ring(number: int, _frame: object) -> None:
        if asked:
            raise KeyboardInterrupt
        asked.append(number)

    for number in (signal.SIGINT, signal.SIGTERM):
        signal.signal(number, ring)
    return lambda: bool(asked)


if __name__ == "__main__":
    raise SystemExit(main())
