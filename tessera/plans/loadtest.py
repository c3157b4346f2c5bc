"""Load on a backend: made-up prompts, their latencies, and the figures of a run."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import PORT_RANGE, Settings, ports
from tessera.operators import stats
from tessera.operators.generate import ChatClient, Client
from tessera.sources import sinks

_DONE = "request_id long, port int, finished double, latency double, ok boolean, error string"


def prompts(spark: SparkSession, count: int, chars: int = 6000, seed: int = 0) -> DataFrame:
    """(request_id, prompt): texts of random lower-case words with exactly ``chars`` characters, the same for the same seed."""
    word = F.substring(F.sha2(F.concat_ws(":", F.lit(seed), "request_id", "k"), 256), 1, 8)
    words = spark.range(count).select(F.col("id").alias("request_id"), F.explode(F.sequence(F.lit(0), F.lit(chars // 9))).alias("k")).select("request_id", "k", F.translate(word, "0123456789", "ghijklmnop").alias("w"))
    whole = words.groupBy("request_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "w"))), lambda x: x["w"]), " ").alias("prompt"))
    return whole.select("request_id", F.rpad(F.substring("prompt", 1, chars), chars, "x").alias("prompt"))


def drive(requests: DataFrame, client: Callable[[], Client], port_list: list[int], concurrency: int = 128, template: str = "http://127.0.0.1:{port}/v1") -> DataFrame:
    """Send every request to its port in turn; (request_id, port, finished, latency, ok, error)."""
    slots = max(1, concurrency // max(1, requests.sparkSession.sparkContext.defaultParallelism))
    names = [c.split()[0] for c in _DONE.split(", ")]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import asyncio
        from concurrent.futures import ThreadPoolExecutor

        async def one(gate: Any, sender: Client, request: int, port: int, prompt: str) -> tuple:
            async with gate:
                began, error = time.time(), None
                try:
                    await sender.complete(template.format(port=port), prompt)
                except Exception as e:  # any failure is a figure of the run
                    error = f"{type(e).__name__}: {e}"
                now = time.time()
                return request, port, now, now - began, error is None, error

        async def all_of(rows: list[dict]) -> list[tuple]:
            gate, sender = asyncio.Semaphore(slots), client()
            asyncio.get_running_loop().set_default_executor(ThreadPoolExecutor(max_workers=slots))
            return await asyncio.gather(*(one(gate, sender, r["request_id"], r["port"], r["prompt"]) for r in rows))

        for batch in batches:
            done = asyncio.run(all_of(batch.to_pylist()))
            kinds = (pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(kinds)], names=names)

    return requests.withColumn("port", stats.assigned_port(F.col("request_id"), port_list)).mapInArrow(send, _DONE)


def report(done: DataFrame, window: int = 5000) -> dict[str, Any]:
    """Totals, requests a second, latencies of the last requests and counts by port, of a written run."""
    row = done.agg(F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("success"), (F.max("finished") - F.min(F.col("finished") - F.col("latency"))).alias("elapsed")).first()
    by_port = {r["port"]: (r["success"], r["failed"]) for r in stats.port_counts(done).collect()}
    figures = stats.latency_percentiles(done, window).first().asDict()
    return {
        "total": row["total"],
        "success": row["success"],
        "failed": row["total"] - row["success"],
        "elapsed": row["elapsed"] or 0.0,
        "rps": row["total"] / max(row["elapsed"] or 0.0, 1e-9) if row["total"] else 0.0,
        **{k: v for k, v in figures.items() if k != "n"},
        "port_success": {p: c[0] for p, c in by_port.items()},
        "port_failed": {p: c[1] for p, c in by_port.items()},
    }


def run(spark: SparkSession, s: Settings, requests: int, chars: int, client: Callable[[], Client] | None = None) -> dict[str, Any]:
    """Send made-up prompts to the settings' backends and report, from the written figures of all requests."""
    model, key, size, seconds = s.model, s.api_key, s.max_tokens, s.llm_timeout
    open_client = client or (lambda: ChatClient(model, key, size, seconds))
    path = f"{sinks.scratch(spark)}/load-{uuid.uuid4().hex}"
    asked = prompts(spark, requests, chars).repartition(max(1, min(spark.sparkContext.defaultParallelism, s.concurrency)))
    drive(asked, open_client, ports(s.ports or PORT_RANGE), s.concurrency).write.parquet(path)
    try:
        return report(spark.read.parquet(path))
    finally:
        sinks.delete(spark, path)
