"""Generation: prompts to messages through a client that each partition opens for itself.

The client is the slow and costly part and its answers differ from call to call. So the stage's result is
written before anything reads it: lineage ends at the files, and a lost executor repeats no committed call.
Turn speculation off for this stage.
"""

from __future__ import annotations

import asyncio
import hashlib
import ipaddress
import math
import re
import time
from collections.abc import Awaitable, Callable, Iterator
from typing import Any, Protocol
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.jsontext import canonical, usage
from tessera.operators.schema import KEY, MESSAGE_KEYS, struct

MAX_ATTEMPTS = 5
_GENERATED = struct("messages messages, finish_reason string, usage string, reason string")


class NoBackends(RuntimeError):
    """No backend is left: the job stops and leaves its tasks pending."""


class ConnectionLost(Exception):
    """The backend could not be reached."""


class RateLimited(Exception):
    pass


class BadRequest(Exception):
    pass


class Client(Protocol):
    async def complete(self, url: str, prompt: str) -> dict[str, Any]:
        """content, and maybe reasoning_content, tool_calls, tool_call_id, name, finish_reason and usage."""


def is_loopback(url: str) -> bool:
    host = urlparse(url).hostname
    if host in ("localhost", "0.0.0.0"):
        return True
    try:
        return host is not None and ipaddress.ip_address(host).is_loopback
    except ValueError:
        return False


def scaled_limit(base: int, active: int, total: int) -> int:
    """The share of the limit that the active backends carry; at least one while any is left."""
    if base <= 0 or total <= 0:
        raise ValueError("limit and number of backends must be positive")
    return min(base, max(1, math.ceil(base * active / total))) if active > 0 else 0


def listed_ports(listing: str) -> set[int]:
    """Ports of the server processes in a listing of command lines."""
    return {int(p) for p in re.findall(r"--port[=\s]+(\d+)", listing)}


def process_alive(command: str, seconds: float = 10.0) -> Callable[[str], Awaitable[bool | None]]:
    """A check of local backends by the output of a command that lists server processes: whether the address's
    port is in it; None where the command fails or the address names no port."""
    import shlex
    import subprocess

    async def alive(url: str) -> bool | None:
        port = urlparse(url).port
        try:
            done = await asyncio.to_thread(subprocess.run, shlex.split(command), capture_output=True, text=True, timeout=seconds)
        except (OSError, ValueError, subprocess.TimeoutExpired):
            return None
        return None if done.returncode or port is None else port in listed_ports(done.stdout)

    return alive


class Pool:
    """Backends and how many requests each holds; a request goes to the one with the fewest.

    alive(url) tells whether a backend that could not be reached still runs: False drops it, True and None
    (unknown) keep it. Whoever feeds the pool keeps at most capacity() requests in flight; a retry waits with
    its place still taken.
    """

    def __init__(self, urls: list[str], client: Client, limit: int, alive: Callable[[str], Awaitable[bool | None]] | None = None, sleep: Callable[[float], Awaitable[None]] = asyncio.sleep):
        if not urls:
            raise ValueError("no backends")
        self.load = dict.fromkeys(urls, 0)
        self.total, self.limit, self.client, self.alive, self.sleep = len(self.load), limit, client, alive, sleep
        self.busy = 0

    def capacity(self) -> int:
        return scaled_limit(self.limit, len(self.load), self.total)

    def _drop(self, url: str) -> None:
        self.load.pop(url, None)
        if not self.load:
            raise NoBackends("no backend is left")

    async def _attempt(self, prompt: str) -> dict[str, Any]:
        url = min(self.load, key=self.load.__getitem__, default=None)
        if url is None:
            raise NoBackends("no backend is left")
        self.load[url] += 1
        try:
            return await self.client.complete(url, prompt)
        except ConnectionLost:
            if self.alive is not None and await self.alive(url) is False:
                self._drop(url)
            raise
        finally:
            if url in self.load:
                self.load[url] -= 1

    async def generate(self, prompt: str) -> dict[str, Any] | None:
        """The messages, finish reason and usage; None for an answer without content."""
        for attempt in range(1, MAX_ATTEMPTS + 1):
            self.busy += 1
            try:
                answer = await self._attempt(prompt)
            except (ConnectionLost, RateLimited):
                if attempt == MAX_ATTEMPTS:
                    raise
                await self.sleep(min(max(2**attempt, 2), 10))
                continue
            finally:
                self.busy -= 1
            if answer.get("content") is None:
                return None
            blank = dict.fromkeys(MESSAGE_KEYS)
            said = blank | {k: answer.get(k) for k in blank if k != "role"} | {"role": "assistant"}
            if said["tool_calls"] is not None:
                said["tool_calls"] = canonical(said["tool_calls"])
            return {"messages": [blank | {"role": "user", "content": prompt}, said], "finish_reason": answer.get("finish_reason"), "usage": canonical(usage(answer.get("usage")))}
        return None


class MockClient:
    """Answers that depend on the prompt alone, for tests and dry runs."""

    def __init__(self, answer: Callable[[str], str] | None = None):
        self.answer = answer or (lambda p: f"Answer {hashlib.sha256(p.encode()).hexdigest()[:8]}.")

    async def complete(self, url: str, prompt: str) -> dict[str, Any]:
        text = self.answer(prompt)
        n, m = len(prompt.split()), len(text.split())
        return {"content": text, "finish_reason": "stop", "usage": {"prompt_tokens": n, "completion_tokens": m, "total_tokens": n + m}}


class ChatClient:
    """An OpenAI-compatible chat endpoint by HTTP, with the standard library alone. Local backends bypass proxies."""

    def __init__(self, model: str, api_key: str | None = None, max_tokens: int = 7000, timeout: float = 3600.0):
        self.model, self.api_key, self.max_tokens, self.timeout = model, api_key, max_tokens, timeout

    def body(self, prompt: str) -> dict[str, Any]:
        return {
            "model": self.model,
            "messages": [{"role": "user", "content": prompt}],
            "temperature": 0.2,
            "top_p": 0.95,
            "max_tokens": self.max_tokens,
            "chat_template_kwargs": {"enable_thinking": False},
        }

    def _post(self, url: str, prompt: str) -> dict[str, Any]:
        import json
        import urllib.error
        import urllib.request

        headers = {"Content-Type": "application/json", "Authorization": f"Bearer {self.api_key or 'EMPTY'}"}
        request = urllib.request.Request(f"{url.rstrip('/')}/chat/completions", json.dumps(self.body(prompt)).encode(), headers)
        opener = urllib.request.build_opener(*([urllib.request.ProxyHandler({})] if is_loopback(url) else []))
        try:
            with opener.open(request, timeout=self.timeout) as response:
                return json.load(response)
        except urllib.error.HTTPError as e:
            if e.code == 429:
                raise RateLimited(str(e)) from e
            raise (BadRequest if e.code == 400 else RuntimeError)(str(e)) from e
        except TimeoutError:
            raise
        except OSError as e:
            if isinstance(getattr(e, "reason", None), TimeoutError):
                raise TimeoutError(str(e)) from e
            raise ConnectionLost(str(e)) from e

    async def complete(self, url: str, prompt: str) -> dict[str, Any]:
        response = await asyncio.to_thread(self._post, url, prompt)
        choice = response["choices"][0]
        return choice["message"] | {"finish_reason": choice.get("finish_reason"), "usage": response.get("usage")}


async def _one(pool: Pool, prompt: str) -> dict[str, Any]:
    """A result, or why there is none. Only the loss of all backends is raised."""
    try:
        found = await pool.generate(prompt)
        return found or {"reason": "worker_error:RuntimeError:empty_response"}
    except NoBackends:
        raise
    except TimeoutError:
        return {"reason": "timeout_1h"}
    except BadRequest as e:
        return {"reason": f"bad_request:{e}"}
    except Exception as e:
        return {"reason": f"worker_error:{type(e).__name__}:{e}"}


def in_flight(pool: Pool, prompts: Iterator[tuple[Any, str]], seconds: float | None = None) -> Iterator[tuple[Any, dict[str, Any]]]:
    """(key, result) of each (key, prompt) as it comes, with at most the pool's capacity of requests at a time.

    Prompts are taken only as places get free, so a slow answer holds up no other one. A result keeps its place until
    it is given out, so answers that come faster than they are read don't pile up. After ``seconds`` no
    more are taken, but one at least is; those taken are still waited for. Each result costs one wake-up, whatever waits.
    """
    from concurrent.futures import ThreadPoolExecutor

    loop, finished, held = asyncio.new_event_loop(), asyncio.Queue(), set()
    loop.set_default_executor(ThreadPoolExecutor(max_workers=max(1, pool.limit)))  # a blocking client needs a thread a request
    began, more, taken, given = time.monotonic(), True, 0, 0

    async def one(key: Any, prompt: str) -> None:
        try:
            finished.put_nowait((key, await _one(pool, prompt)))
        except BaseException as e:
            finished.put_nowait((key, e))
            raise

    try:
        while True:
            while more and taken - given < pool.capacity():
                late = seconds is not None and taken > 0 and time.monotonic() - began > seconds
                following = None if late else next(prompts, None)
                if following is None:
                    more = False
                    break
                taken += 1
                task = loop.create_task(one(*following))
                held.add(task)
                task.add_done_callback(held.discard)
            if taken == given:
                return
            key, result = loop.run_until_complete(finished.get())
            given += 1
            if isinstance(result, BaseException):
                raise result
            yield key, result
    finally:
        left = list(held)
        for task in left:
            task.cancel()
        if left:
            loop.run_until_complete(asyncio.wait(left))
        loop.close()


def generate(tasks: DataFrame, client: Callable[[], Client], urls: list[str], limit: int = 64, alive: Callable[[str], Awaitable[bool | None]] | None = None, batch_size: int = 1000, seconds: float | None = None) -> DataFrame:
    """tasks (column prompt_text) with messages, finish_reason, usage and, where there is no answer, reason.

    The limit is shared out over the partitions that can run at a time. A partition has one pool, so what it
    learns of its backends holds to its end; answers come in the order they arrive, batch_size rows at a time.
    After ``seconds`` a partition asks nothing more: the tasks left have no row. Write the result before use.
    """
    slots = max(1, min(tasks.sparkSession.sparkContext.defaultParallelism, limit))
    share = max(1, limit // slots)
    schema = T.StructType([*tasks.schema.fields, *_GENERATED.fields])
    message = pa.struct([(k, pa.string()) for k in MESSAGE_KEYS])
    kinds = {"messages": pa.list_(message), "finish_reason": pa.string(), "usage": pa.string(), "reason": pa.string()}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def prompts() -> Iterator[tuple[pa.RecordBatch, str]]:
            for batch in batches:
                for k, p in enumerate(batch.column("prompt_text").to_pylist()):
                    yield batch.slice(k, 1), p

        def packed(done: list[tuple[pa.RecordBatch, dict[str, Any]]]) -> pa.RecordBatch:
            rows = pa.Table.from_batches([r for r, _ in done]).combine_chunks()
            columns = [c.combine_chunks() for c in rows.columns]
            columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
            return pa.RecordBatch.from_arrays([*columns, *(pa.array([f.get(k) for _, f in done], t) for k, t in kinds.items())], names=schema.fieldNames())

        done = []
        for row, found in in_flight(Pool(urls, client(), share, alive), prompts(), seconds):
            done.append((row, found))
            if len(done) >= batch_size:
                yield packed(done)
                done = []
        if done:
            yield packed(done)

    return tasks.mapInArrow(each, schema)


def split(generated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answers, failures) of a written generation."""
    return generated.where("reason is null").drop("reason"), generated.where("reason is not null").select(*KEY, "reason", F.unix_timestamp().cast("double").alias("time"))
