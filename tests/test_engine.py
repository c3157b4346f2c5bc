import asyncio
import hashlib
import json
import os

import pytest

from tessera import cli, config, engine
from tessera.functions.jsontext import canonical
from tessera.operators import generate, records, resume, stats, tasks
from tessera.operators.schema import KEY, RECORD, conform
from tessera.plans import jobs
from tessera.sources import scan, sinks
from tessera.streaming import compact


def lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))


# --- scans


def test_jsonl_rows_are_numbered_over_valid_lines(spark, tmp_path):
    path = f"{tmp_path}/in put/a+b%.jsonl"
    lines(path, [{"q": "a"}, "", "{bad", {"q": "b"}, "   ", '{"q": NaN}', '{"q": "c"} x', {"q": "d", "extra": 1}])
    files = scan.list_files(spark, f"{tmp_path}/in put", "*.jsonl")
    assert files == [path]
    got = sorted((r.source_row, r.q, r.extra, r.source_file) for r in scan.scan(spark, files).collect())
    assert [g[0] for g in got] == [0, 1, 2, 3] and {g[3] for g in got} == {path} and got[3][1:3] == ("d", 1)
    assert scan.estimate_rows(spark, files) == 8 and scan.estimate_rows(spark, [f"{tmp_path}/none.parquet"]) is None


def test_parquet_rows_and_drifting_schemas(spark, tmp_path):
    spark.range(5).selectExpr("id as a").coalesce(1).write.parquet(f"{tmp_path}/p1.parquet")
    spark.range(2).selectExpr("id as a", "'x' as b").coalesce(1).write.parquet(f"{tmp_path}/p2.parquet")
    rows = scan.scan(spark, [f"{tmp_path}/p1.parquet", f"{tmp_path}/p2.parquet"])
    assert sorted((r.source_row, r.a, r.b) for r in rows.where("b is null").collect()) == [(k, k, None) for k in range(5)]
    assert scan.scan(spark, [f"{tmp_path}/x.csv"]).count() == 0


def test_slices():
    files = list("abcde")
    assert scan.slice_files(files, 1, 3) == ["b", "c"] and scan.slice_files(files, -2, None) == files and scan.slice_files(files, 0, -1) == list("abcd") and scan.slice_files(files, 4, 99) == ["e"]


# --- tasks


def test_prompts_of_every_shape(spark):
    user = lambda t: {"role": "user", "content": t}
    df = spark.createDataFrame([(" a ",), ("",), (None,), ('[{"role":"user","content":"j"}]',), ("[1]",), ("[x",)], "q string")
    assert [r[0] for r in df.select(tasks.prompt(df, "q")).collect()] == ["a", None, None, "j", None, "[x"]
    df = spark.createDataFrame([([user("a"), {"role": "assistant", "content": "z"}, user(" b ")],), ([],), (None,), ([user('["n"]'), user("m")],)], "q array<struct<role:string,content:string>>")
    assert [r[0] for r in df.select(tasks.prompt(df, "q")).collect()] == ["a\n\nb", None, None, "n\n\nm"]
    df = spark.createDataFrame([(["a", " ", "b"],)], "q array<string>")
    assert df.select(tasks.prompt(df, "q")).first()[0] == "a\n\nb"
    df = spark.createDataFrame([(("user", " c "),)], "q struct<role:string,content:string>")
    assert df.select(tasks.prompt(df, "q")).first()[0] == "c"


def test_python_request():
    assert tasks.asks_for_python("OpenCode_Reasoning_split_0") and tasks.asks_for_python(None, None, "/d/OpenCodeReasoning") and not tasks.asks_for_python("math_task", None)


def test_pending_and_failures(spark):
    rows = spark.createDataFrame([("f", k, None if k == 2 else f"p{k}") for k in range(4)], "source_file string, source_row long, q string")
    todo, empty = tasks.make_tasks(rows, "q", 2, ("opencode_reasoning",))
    assert todo.count() == 6 and todo.first().prompt_text.startswith("Solve this problem using Python.")
    assert [tuple(r) for r in empty.collect()] == [("f", 2, 0, "empty_or_unsupported_input:q")]
    done = spark.createDataFrame([("f", 0, 0), ("g", 0, 1)], "source_file string, source_row long, rollout_index long")
    left = tasks.pending(todo, done, done.selectExpr("source_file", "3 as source_row", "rollout_index"))
    assert sorted((r.source_row, r.rollout_index) for r in left.collect()) == [(0, 1), (1, 0), (1, 1), (3, 1)]
    assert tasks.new_failures(empty.union(empty), empty).count() == 0 and tasks.rollouts(rows, 0).count() == 0


# --- records


def test_hash_is_that_of_canonical_json(spark):
    blank = dict.fromkeys(("role", "content", "reasoning_content", "tool_calls", "tool_call_id", "name"))
    texts = ["plain", 'quote " back \\ slash /', "ctl \x00\x01\x1f\x7f\x0b tab\t nl\n cr\r\x08\x0c", "é日本😀 ", "", None, "\\u001F", "both \x1f \\u001F \\\\u001F \x0b\x0e"]
    rows = [([blank | {"role": "user", "content": t}, blank | {"role": "assistant", "content": t, "tool_calls": '[{"a": 1}]', "reasoning_content": " "}],) for t in texts]
    from tessera.operators.schema import MESSAGES
    from pyspark.sql import types as T
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, T.StructType([T.StructField("messages", MESSAGES)]))
    got = df.select(records.dedup_hash(F.col("messages")).alias("h"), records.content_chars(F.col("messages")).alias("n"), records.has_reasoning(F.col("messages")).alias("r")).collect()
    for (messages,), g in zip(rows, got):
        parsed = [m | {"tool_calls": m["tool_calls"] and json.loads(m["tool_calls"])} for m in messages]
        assert g.h == hashlib.sha256(canonical(parsed).encode()).hexdigest(), messages
        assert g.n == 2 * len(messages[0]["content"] or "") + 1 + len('[{"a": 1}]') and g.r is False


# --- resume


def test_index_lines(spark, tmp_path):
    out = str(tmp_path)
    path = sinks.index_path(out)
    lines(f"{path}/part-0", ["/d/train-0001.parquet\t7\t2", "", "/d/train-0002.parquet\t8\t0", '{"source_file": "/d/a", "source_row": 9, "rollout_index": 1}', '{"source_file": "/d/b", "source_row": 1}'])
    keys = {tuple(r) for r in resume.read_index(spark, out).collect()}
    assert keys == {("/d/train-0001.parquet", 7, 2), ("/d/train-0002.parquet", 8, 0), ("/d/a", 9, 1), ("/d/b", 1, 0)}
    assert [tuple(r) for r in resume.read_index(spark, out, ["/d/train-0002.parquet"]).collect()] == [("/d/train-0002.parquet", 8, 0)]
    lines(f"{path}/part-1", ["not a key"])
    assert resume.read_index(spark, out) is None and resume.read_index(spark, f"{out}/none") is None


def record(k, ok, reason="stop", detail=None):
    base = dict.fromkeys(RECORD.fieldNames())
    return base | {"source_file": "/d/f", "source_row": k, "rollout_index": 0, "is_correct": ok, "generation_finish_reason": reason, "judge_backend": "math_rule" if k % 2 else None, "judge_type": "math", "judge_status": "pass" if ok else "", "prompt_tokens": 10 * k, "completion_tokens": 20 * k, "total_tokens": 30 * k, "messages": [], "judge_detail": detail, "dataset_name": "d"}


def test_streams_progress_and_rebuild(spark, tmp_path):
    out = f"{tmp_path}/out"
    rows = spark.createDataFrame([record(k, [True, False, None][k % 3], "length" if k == 3 else "stop") for k in range(9)], RECORD)
    sinks.append_records(rows, out)
    good = sinks.read_records(spark, out, "correct").select(*KEY)
    assert good.count() == 3 and good.exceptAll(sinks.read_records(spark, out, "all").select(*KEY)).count() == 0
    assert resume.progress(spark, out) == {"written": 9, "correct": 3, "overlong": 1}
    assert resume.completed(spark, out).count() == 9
    summary = jobs.rebuild_correct(spark, out)
    assert summary == {"scanned_records": 9, "written_records": 3, "overlong_records": 1, "index_keys": 9}
    assert sinks.read_records(spark, out, "correct").count() == 3


def test_compaction_runs_once_for_each_segment(spark, tmp_path):
    out = f"{tmp_path}/out"
    with pytest.raises(FileNotFoundError):
        compact.compact(spark, out)
    for k in (1, 2):
        lines(f"{out}/correct/segments/segment_{k:06d}.jsonl", [record(k, True)])
    first = compact.compact(spark, out, "correct", 1 << 20)
    assert first["merged_segments_this_run"] == 2 and first["total_records"] == 2 and first["token_sums"]["total_tokens"] == 90 and first["average_tokens"]["total_tokens"] == 45.0 and first["shards_written_this_run"] == 1
    again = compact.compact(spark, out, "correct", 1 << 20)
    assert again["merged_segments_this_run"] == again["shards_written_this_run"] == 0 and again["total_records"] == 2
    lines(f"{out}/correct/segments/segment_000003.jsonl", [record(3, True)])
    assert [name for _, name, _ in compact.new_segments(spark, out, "correct")] == ["segment_000003.jsonl"]
    # What a crash left behind is not counted.
    spark.createDataFrame([record(9, True)], RECORD).write.parquet(f"{out}/correct/shards/batch=dead/shard=0")
    third = compact.compact(spark, out, "correct", 1)
    assert third["merged_segments_total"] == 3 and third["total_records"] == 3
    assert sorted(r.source_row for r in sinks.read_records(spark, out, "correct").collect()) == [1, 2, 3]
    assert jobs.token_report(spark, out)["averages"]["prompt_tokens"] == 20.0


def test_compaction_stream_adds_nothing_twice(spark, tmp_path):
    out = f"{tmp_path}/out"
    for k in (1, 2):
        lines(f"{out}/all/segments/segment_{k:06d}.jsonl", [record(k, True)])
    for _ in range(2):
        compact.compact_stream(spark, out, "all", f"{tmp_path}/ck").awaitTermination(60)
        assert spark.read.parquet(f"{out}/all/stream_shards").count() == 2


def test_packing_never_splits_a_segment(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.integers(0, 50)), st.integers(1, 60))
    def check(sizes, target):
        shards = compact.pack_sizes(sizes, target)
        assert shards == sorted(shards) and len(shards) == len(sizes)
        for k in set(shards):
            held = [s for s, n in zip(sizes, shards) if n == k]
            assert sum(held) <= target or sum(held[:-1]) == 0
            if k:
                assert sum(s for s, n in zip(sizes, shards) if n == k - 1) + held[0] > target

    check()
    sizes = [40, 30, 40, 90, 10, 0, 95]
    df = spark.createDataFrame([(f"s{k}", v) for k, v in enumerate(sizes)], "name string, bytes long")
    assert [r.shard for r in compact.pack_segments(df, 100).orderBy("name").collect()] == compact.pack_sizes(sizes, 100)


# --- reports


def test_summary(spark):
    rows = [record(k, [True, False, None][k % 3], "length" if k < 2 else None, '{"verify_fallback_reason": "why"}' if k == 1 else None) for k in range(9)]
    got = stats.summary(spark.createDataFrame(rows, RECORD))
    assert got["total_records"] == 9 and got["correct_counts"] == {"true": 3, "false": 3, "none": 3} and got["overall_accuracy"] == 50.0
    assert got["generation_finish_reason_counts"] == {"length": 2, "none": 7} and got["judge_status_counts"] == {"pass": 3, "none": 6}
    assert got["overlong_summary"] == {"overlong_total": 2, "overlong_ratio": 22.2222, "overlong_correct": 1, "overlong_accuracy": 50.0}
    assert got["backend_accuracy"]["math_rule"] == {"correct": 1, "total": 4, "accuracy": 25.0} and got["math_verify_fallback_reasons"] == {"why": 1}
    assert got["math_backend_summary"]["math_rule_ratio"] == 100.0
    assert sum(got["judge_backend_counts"].values()) == got["total_records"]
    empty = stats.summary(spark.createDataFrame([], RECORD))
    assert empty["total_records"] == 0 and empty["overall_accuracy"] == 0.0 and empty["backend_accuracy"] == {}


def test_token_averages(spark):
    rows = spark.createDataFrame([("10", 20, 30, True), ("x", 200, None, False)], "prompt_tokens string, completion_tokens int, total_tokens int, is_correct boolean")
    got = stats.average_tokens(rows, True)
    assert got["record_count"] == 2 and got["counted_records"] == 1 and got["averages"] == {"prompt_tokens": 10.0, "completion_tokens": 20.0, "total_tokens": 30.0}
    assert stats.average_tokens(rows)["non_null_counts"] == {"prompt_tokens": 1, "completion_tokens": 2, "total_tokens": 1}
    assert stats.average_tokens(rows.where("false"))["averages"]["total_tokens"] is None


def test_latency_ranks_are_rounded_half_to_even(spark):
    df = spark.createDataFrame([(k, float(k), float(k), 1) for k in range(102)], "request_id long, finished double, latency double, port int")
    row = stats.latency_percentiles(df).first()
    assert row.p50_latency == float(round(0.5 * 101)) and row.p99_latency == float(round(0.99 * 101)) and row.n == 102
    assert stats.latency_percentiles(df, 2).first().avg_latency == 100.5 and stats.latency_percentiles(df.where("false")).first().p95_latency == 0.0


# --- jobs


def test_rejudge_keeps_every_record(spark):
    source = spark.createDataFrame([("/d/f", 0, "4", None), ("/d/f", 1, "5", "x")], "source_file string, source_row long, answer string, dataset string")
    said = [dict.fromkeys(("role", "content", "reasoning_content", "tool_calls", "tool_call_id", "name")) | {"role": "assistant", "content": "The answer is 4"}]
    rows = [record(0, None) | {"messages": said}, record(1, None) | {"messages": said, "dataset_name": "code_contests"}]
    df = spark.createDataFrame(rows, RECORD)
    got = {r.source_row: r for r in jobs.rejudge(df, source).collect()}
    assert got[0].new.is_correct is True and got[0].changed and got[1].new.is_correct is False
    some = {r.source_row: r for r in jobs.rejudge(df, source, suspicious_only=True).collect()}
    assert len(some) == 2 and not some[0].changed and some[1].changed
    report = jobs.rejudge_report(jobs.rejudge(df, source))
    assert report["processed_records"] == 2 and report["changed_records"] == 2 and report["changed_to"] == {"pass/True": 1, "wrong_answer/False": 1}


def test_prepare_and_hydrate(spark, tmp_path):
    text = "T\nExample\nInput\n1 2\nOutput\n3\nExample 2"
    rows = spark.createDataFrame([(text,), ("none",), (None,)], "input string").coalesce(1)
    rows.write.parquet(f"{tmp_path}/in/split_0")
    summary = jobs.prepare_files(spark, f"{tmp_path}/in", f"{tmp_path}/out", ["split_0", "split_1"])
    assert summary["rows"] == 3 and summary["parsed_rows"] == 1 and summary["total_examples"] == 1 and summary["files_processed"] == 1
    row = spark.read.parquet(f"{tmp_path}/out/split_0").where("generated_test_status = 'parsed'").first()
    assert json.loads(row.input_output) == {"inputs": ["1 2"], "outputs": ["3\nExample 2"], "fn_name": None} and row.generated_test_parser == "prompt_examples_v1"
    assert jobs.prepare_files(spark, f"{tmp_path}/in", f"{tmp_path}/out", ["split_0"])["files_processed"] == 0
    lookup = spark.createDataFrame([("apps", "train", 0, "Q0", "t0"), ("apps", "test", 0, "Q1", None), ("taco", "train", 2, " ", "t2")], "dataset string, split string, index long, question string, tests string")
    data = spark.createDataFrame([("APPS", "train", "0", "-", None), ("apps", "test", " 0 ", "-", None), ("taco", None, "2", "-", "old"), ("other", "train", "0", "-", "own"), ("apps", "train", "x", "-", None)], "dataset string, split string, index string, input string, input_output string")
    got = jobs.hydrate(data, lookup)
    assert [(r.input, r.input_output, r.generated_test_status, r.generated_test_source) for r in sorted(got.collect(), key=lambda r: (r["dataset"], r["index"]))] == [
        ("Q0", "t0", "hydrated", "apps_source_dataset"),
        ("Q1", "", "missing", "apps_source_dataset"),
        ("-", "", "missing", ""),
        ("-", "own", "missing", ""),
        ("-", "t2", "hydrated", "taco_source_dataset"),
    ]
    assert jobs.hydrate_rate(got).first().hydrated == 2


def test_evaluate(spark):
    rows = spark.createDataFrame([("f", 0, "The answer is 4", "4"), ("f", 1, None, "4")], "source_file string, source_row long, output string, solution string")
    report = jobs.evaluation_report(jobs.evaluate(rows))
    assert report["total"] == 2 and report["status_counter"] == {"pass": 1, "wrong_answer": 1} and report["code_fence_counter"] == {False: 2}
    assert jobs.evaluation_report(jobs.evaluate(rows), 1)["total"] == 1


# --- generation


def test_limits_and_addresses():
    assert [generate.scaled_limit(2048, a, 6) for a in (6, 3, 1, 0)] == [2048, 1024, 342, 0]
    assert config.backend_urls(None, "1597-1598", {}) == ["http://127.0.0.1:1597/v1", "http://127.0.0.1:1598/v1"]
    assert config.backend_urls("http://a/v1,http://a/v1", "1", {"TESSERA_PORTS": "1,2"}) == ["http://a/v1", "http://127.0.0.1:1/v1", "http://127.0.0.1:2/v1"]
    assert len(config.backend_urls(None, None, {})) == 8 and generate.is_loopback("http://localhost:1") and not generate.is_loopback("http://10.0.0.1")
    assert generate.listed_ports("x --port 7 --port=8") == {7, 8}
    with pytest.raises(ValueError):
        config.ports("5-4")


class Flaky:
    def __init__(self, *faults):
        self.faults, self.calls = list(faults), []

    async def complete(self, url, prompt):
        self.calls.append(url)
        if self.faults:
            fault = self.faults.pop(0)
            if fault:
                raise fault
        return {"content": "ok", "finish_reason": "stop", "usage": {"prompt_tokens": 3, "completion_tokens": 5, "total_tokens": 8}}


async def no_sleep(_):
    return None


def answer(client, urls=("u1", "u2"), limit=8, alive=None):
    pool = generate.Pool(list(urls), client, limit, alive, no_sleep)
    return pool, asyncio.run(generate._one(pool, "p"))


def test_backends_that_vanish_are_dropped():
    async def gone(url):
        return False

    async def there(url):
        return True

    pool, got = answer(Flaky(generate.ConnectionLost("x")), alive=gone)
    assert json.loads(got["usage"])["total_tokens"] == 8 and list(pool.load) == ["u2"] and pool.capacity() == 4 and pool.busy == 0
    pool, got = answer(Flaky(generate.ConnectionLost("x"), generate.RateLimited("y")), alive=there)
    assert got["messages"][1]["content"] == "ok" and len(pool.load) == 2
    with pytest.raises(generate.NoBackends):
        answer(Flaky(generate.ConnectionLost("x"), generate.ConnectionLost("x")), alive=gone)


def test_reasons_of_failures():
    assert answer(Flaky(*[generate.RateLimited("z")] * 5))[1]["reason"] == "worker_error:RateLimited:z"
    assert answer(Flaky(generate.BadRequest("b")))[1]["reason"] == "bad_request:b"
    assert answer(Flaky(TimeoutError()))[1]["reason"] == "timeout_1h"

    class Empty:
        async def complete(self, url, prompt):
            return {"content": None}

    assert answer(Empty())[1]["reason"] == "worker_error:RuntimeError:empty_response"
    assert generate.ChatClient("m").body("p")["chat_template_kwargs"] == {"enable_thinking": False}


def test_run_end_to_end_and_again(spark, tmp_path):
    spark.createDataFrame([(f"What is {k} + 1?" if k != 3 else " ", str(k + 1)) for k in range(6)], "question string, answer string").coalesce(1).write.parquet(f"{tmp_path}/in/a.parquet")
    path = next(p for p in os.listdir(f"{tmp_path}/in/a.parquet") if p.endswith(".parquet"))
    s = config.Settings(f"{tmp_path}/in/a.parquet", f"{tmp_path}/out", rollout_count=2, ports="1", label_field="answer")

    def client():
        class Sums(generate.MockClient):
            async def complete(self, url, prompt):
                if "4" in prompt:
                    raise generate.BadRequest("no")
                return await super().complete(url, prompt)

        return Sums(lambda p: "The answer is " + ("2" if "1 +" in p else "7"))

    assert engine.run(spark, s, client) == {"written": 8, "correct": 2, "overlong": 0}
    stored = sinks.read_records(spark, s.output_dir, "all")
    row = stored.where("source_row = 1 and rollout_index = 1").first()
    assert row.is_correct and row.sample_id == f"{row.dataset_name}:{tmp_path}/in/a.parquet/{path}:1:rollout_1" and row.total_tokens == row.prompt_tokens + row.completion_tokens
    assert resume.failed(spark, s.failure_path).count() == 3
    assert engine.run(spark, s, client)["written"] == 8 and sinks.read_records(spark, s.output_dir, "all").count() == 8
    assert spark.read.json(s.failure_path).count() == 3


class Counted(generate.MockClient):
    """Answers, and one line in a file for each call."""

    def __init__(self, path, wait=0.0):
        super().__init__(lambda p: "The answer is 2")
        self.path, self.wait = path, wait

    async def complete(self, url, prompt):
        with open(self.path, "a") as f:
            f.write(prompt + "\n")
        await asyncio.sleep(self.wait)
        return await super().complete(url, prompt)


def inputs(spark, folder, files, rows):
    for k in range(files):
        spark.createDataFrame([(f"What is {k}/{j} + 1?", str(j + 1)) for j in range(rows)], "question string, answer string").coalesce(1).write.parquet(f"{folder}/tmp{k}")
        name = next(p for p in os.listdir(f"{folder}/tmp{k}") if p.endswith(".parquet"))
        os.rename(f"{folder}/tmp{k}/{name}", f"{folder}/in{k}.parquet")


@pytest.mark.parametrize("place", ["judge", "all", "correct", "index", "marker"])
def test_a_run_that_stops_repeats_no_call_and_doubles_no_record(spark, tmp_path, monkeypatch, place):
    inputs(spark, tmp_path, 2, 4)
    calls = f"{tmp_path}/calls"
    s = config.Settings(str(tmp_path), f"{tmp_path}/out", file_pattern="in*.parquet", ports="1", label_field="answer", active_files=1, write_retries=1)

    class Stopped(Exception):
        pass

    def fault(original, at):
        def call(*args, **kwargs):
            seen = " ".join(str(a) for a in (*args, *kwargs.values()) if isinstance(a, str))
            if at in seen:
                raise Stopped
            return original(*args, **kwargs)

        return call

    with monkeypatch.context() as m:
        if place == "judge":
            m.setattr(engine.judge, "judge", lambda *a, **k: (_ for _ in ()).throw(Stopped()))
        elif place == "index":
            m.setattr(sinks, "index_path", lambda out: (_ for _ in ()).throw(Stopped()))
        elif place == "marker":
            m.setattr(sinks, "put_text", fault(sinks.put_text, "/batches/"))
        else:
            m.setattr(sinks, "_segments", fault(sinks._segments, f"/{place}/segments"))
        with pytest.raises(Stopped):
            engine.run(spark, s, lambda: Counted(calls))
    figures = engine.run(spark, s, lambda: Counted(calls))
    assert figures == {"written": 8, "correct": 2, "overlong": 0}
    asked = open(calls).read().split("\n")[:-1]
    assert len(asked) == len(set(asked)) == 8
    stored = sinks.read_records(spark, s.output_dir, "all").select(*KEY)
    assert stored.count() == stored.distinct().count() == 8 and sinks.read_records(spark, s.output_dir, "correct").count() == 2
    assert resume.completed(spark, s.output_dir).count() == 8 and not os.path.exists(f"{tmp_path}/out/.work/0_END")
    # The run's end has compacted both streams.
    assert compact.new_segments(spark, s.output_dir, "all") == [] and spark.read.parquet(f"{s.output_dir}/all/shards").count() == 8


def test_rounds_stop_and_go_on(spark, tmp_path):
    inputs(spark, tmp_path, 2, 6)
    calls, told = f"{tmp_path}/calls", []
    s = config.Settings(str(tmp_path), f"{tmp_path}/out", file_pattern="in*.parquet", ports="1", concurrency=1, active_files=1, segment_flush_interval_sec=0.5)
    figures = engine.run(spark, s, lambda: Counted(calls, 0.2), report=told.append, stop=lambda: len(told) >= 2)
    assert 0 < figures["written"] < 12 and len(told) == 2 and told[1]["answered"] > told[0]["answered"]
    assert engine.run(spark, s, lambda: Counted(calls, 0.2), report=told.append)["written"] == 12 and len(open(calls).readlines()) == 12


def test_a_broken_file_costs_itself_only(spark, tmp_path):
    inputs(spark, tmp_path, 2, 2)
    (tmp_path / "in9.parquet").write_bytes(b"PAR1 nothing PAR1")
    s = config.Settings(str(tmp_path), f"{tmp_path}/out", file_pattern="in*.parquet", ports="1")
    for _ in range(2):
        with pytest.warns(UserWarning, match="in9"):
            assert engine.run(spark, s, lambda: generate.MockClient())["written"] == 4
        assert [r.reason for r in spark.read.json(s.failure_path).collect()] == ["unreadable_file"]


def test_time_of_a_partition_follows_its_prompts():
    import time

    class Slow(generate.MockClient):
        async def complete(self, url, prompt):
            await asyncio.sleep(0.001)
            return await super().complete(url, prompt)

    took = []
    for n in (1000, 4000):
        began = time.time()
        got = list(generate.in_flight(generate.Pool(["u"], Slow(), 8), iter([(k, str(k)) for k in range(n)])))
        took.append(time.time() - began)
        assert sorted(k for k, _ in got) == list(range(n))
    assert took[1] < 8 * took[0] + 1

    class Threads(generate.MockClient):
        async def complete(self, url, prompt):
            await asyncio.to_thread(time.sleep, 0.2)
            return await super().complete(url, prompt)

    began = time.time()
    assert len(list(generate.in_flight(generate.Pool(["u"], Threads(), 200), iter([(k, "p") for k in range(200)])))) == 200
    assert time.time() - began < 3  # blocking calls run all at once, not as many as there are cores

    class Gone(generate.MockClient):
        async def complete(self, url, prompt):
            raise generate.ConnectionLost("x")

    async def gone(url):
        return False

    with pytest.raises(generate.NoBackends):
        list(generate.in_flight(generate.Pool(["u", "v"], Gone(), 4, gone, no_sleep), iter([(k, "p") for k in range(9)])))


def test_segments_are_compressed_and_shards_measured_by_their_text(spark, tmp_path):
    import gzip

    from pyspark.sql import functions as F

    rows = spark.range(4000).select(F.lit("/d/a.parquet").alias("source_file"), F.col("id").alias("source_row"), F.lit(0).cast("long").alias("rollout_index"), (F.col("id") % 2 == 0).alias("is_correct"), F.lit("math").alias("judge_type")).coalesce(1)
    rows.write.parquet(f"{tmp_path}/rows")
    sinks.append_records(spark.read.parquet(f"{tmp_path}/rows"), str(tmp_path), 4 << 20)
    made = jobs.rebuild_correct(spark, str(tmp_path))
    assert (made["scanned_records"], made["written_records"], made["index_keys"]) == (4000, 2000, 4000)
    texts = {}
    for stream in ("all", "correct"):
        files = sinks.segment_files(spark, str(tmp_path), stream)
        texts[stream] = [len(gzip.open(path.removeprefix("file:")).read()) for path, _, _ in files]
        assert 5 * sum(size for _, _, size in files) < sum(texts[stream])
    done = compact.compact(spark, str(tmp_path), "all", 2 * max(texts["all"]))
    assert done["total_records"] == 4000 and done["shards_written_this_run"] == len(set(compact.pack_sizes(texts["all"], 2 * max(texts["all"])))) > 1
    assert sorted(r.bytes for r in compact.read_manifest(spark, str(tmp_path), "all").collect()) == sorted(texts["all"])
    assert sinks.read_records(spark, str(tmp_path), "all").count() == 4000 and sinks.read_records(spark, str(tmp_path), "correct").count() == 2000


def test_answers_faster_than_they_are_read_do_not_pile_up():
    asked = []

    def prompts():
        for k in range(5000):
            asked.append(k)
            yield k, str(k)

    for limit in (1, 5):
        asked.clear()
        most, given = 0, []
        for key, _ in generate.in_flight(generate.Pool(["u"], generate.MockClient(), limit), prompts()):
            given.append(key)
            most = max(most, len(asked) - len(given))
        assert sorted(given) == list(range(5000)) and most <= limit


def test_verdicts_that_take_too_long(spark):
    import time

    from tessera.operators import judge

    program = "```python\nwhile True:\n    pass\n```"
    row = {"test_list": ["assert add(1, 2) == 3"]}
    began = time.time()
    kind, backend, good, status, detail = judge.guarded(row, [{"role": "assistant", "content": program}], None, 1.0)
    assert time.time() - began < 4 and (kind, backend, good, status) == ("code_mbpp", "judge_subprocess_guard_v1", None, "timeout")
    assert detail == {"reason": "judge_process_timeout", "timeout_seconds": 1.0}
    quick = [{"role": "assistant", "content": "```python\ndef add(a, b):\n    return a + b\n```"}]
    assert judge.guarded(row, quick, None, 20.0) == judge.guarded(row, quick, None, None) and judge.guarded(row, quick, None, 20.0)[2] is True
    df = spark.createDataFrame([(["assert add(1, 2) == 3"], [{"role": "assistant", "content": t}]) for t in (program, quick[0]["content"])], "test_list array<string>, messages array<struct<role:string,content:string>>")
    assert sorted(r.judge_status for r in judge.judge(df, ["test_list"], seconds=2.0).collect()) == ["pass", "timeout"]


def test_stored_records_judged_again(spark, tmp_path):
    spark.createDataFrame([("q", "4"), ("q", "5")], "question string, answer string").coalesce(1).write.parquet(f"{tmp_path}/in")
    (path,) = scan.list_files(spark, f"{tmp_path}/in")
    said = [dict.fromkeys(("role", "content", "reasoning_content", "tool_calls", "tool_call_id", "name")) | {"role": "assistant", "content": "The answer is 4"}]
    rows = [record(k, False) | {"source_file": path, "messages": said, "dataset_name": "code_contests" if k else "d"} for k in range(2)]
    out = f"{tmp_path}/out"
    sinks.append_records(spark.createDataFrame(rows[:1], RECORD), out)
    sinks.append_records(spark.createDataFrame(rows[1:], RECORD), out)
    compact.compact(spark, out, "all")
    assert jobs.suspicious_segments(spark, out).count() == 1
    report = jobs.rejudge_stored(spark, out)
    assert report["processed_records"] == 2 and report["changed_records"] == 2 and report["written_records"] == 1
    assert {r.source_row: r.is_correct for r in sinks.read_records(spark, out).collect()} == {0: True, 1: False}
    assert sinks.read_records(spark, out, "correct").count() == 1 and resume.completed(spark, out).count() == 2
    assert jobs.rejudge_stored(spark, out)["changed_records"] == 0


def test_a_replacement_is_whole_or_absent(spark, tmp_path):
    out = f"{tmp_path}/out"
    sinks.append_records(spark.createDataFrame([record(1, True)], RECORD), out)
    half = f"{out}/all/.new/batch=whole-x"
    lines(f"{half}/part-0.json", [record(2, True)])
    sinks.finish_replace(spark, out, "all")
    assert [r.source_row for r in sinks.read_records(spark, out).collect()] == [1]
    lines(f"{half}/part-0.json", [record(2, True)])
    lines(f"{half}/_SUCCESS", [])
    sinks.finish_replace(spark, out, "all")
    assert [r.source_row for r in sinks.read_records(spark, out).collect()] == [2]


def test_jobs_of_the_command_line(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    common = ["--input-dir", f"{tmp_path}/in", "--output-dir", f"{tmp_path}/out"]
    spark.createDataFrame([("apps", "train", "1", "-", "", "The answer is 4", "4")], "dataset string, split string, index string, input string, input_output string, output string, solution string").coalesce(1).write.parquet(f"{tmp_path}/in/s0")
    spark.createDataFrame([("Q0", "t0"), ("Q1", "t1")], "question string, input_output string").coalesce(1).write.parquet(f"{tmp_path}/apps")
    assert cli.main(["hydrate", *common, "--splits", "s0", "--lookup", f"apps/train={tmp_path}/apps", "--summary", f"{tmp_path}/sum.json"]) == 0
    assert json.load(open(f"{tmp_path}/sum.json")) == {"splits_processed": 1, "rows": 1, "hydrated": 1, "hydrate_rate": 1.0}
    assert spark.read.parquet(f"{tmp_path}/out/s0").first().input == "Q1"
    assert cli.main(["evaluate", "--input-dir", f"{tmp_path}/in/s0", "--output-dir", "o"]) == 0
    assert '"total": 1' in capsys.readouterr().out


# --- settings


def test_layers(tmp_path):
    (tmp_path / "m.yaml").write_text("defaults: {model: d, rollout-count: 2}\nmodel: top\nrange_end:\ntasks:\n  - {task_name: a, input_dir: /i, output_dir: /o, llm-timeout: 7200}\n  - {input_dir: /j, output_dir: /p, model: own}\n")
    a, b = config.resolve({"config_name": "m", "manifest_dir": str(tmp_path)})
    assert (a.model, a.rollout_count, a.llm_timeout, a.task_name, b.model, b.task_name) == ("top", 2, 7200, "a", "own", "m_001")
    (only,) = config.resolve({"config_name": "m.yaml", "manifest_dir": str(tmp_path), "task": "a", "model": "cli", "range_start": 3})
    assert only.model == "cli" and only.failure_path == "/o/failures/failed_tasks_3_END.jsonl"
    with pytest.raises(FileNotFoundError):
        config.resolve({"config_name": "m", "manifest_dir": str(tmp_path), "task": "zz"})
    with pytest.raises(FileNotFoundError):
        config.resolve({"config_name": "absent", "manifest_dir": str(tmp_path)})
    with pytest.raises(ValueError):
        config.expand({"tasks": 3}, "x")


def test_command_line(tmp_path, capsys):
    (tmp_path / "one.yaml").write_text("input_dir: /i\noutput_dir: /o\n")
    assert cli.main(["--list-configs", "--manifest-dir", str(tmp_path)]) == 0 and "one.yaml one" in capsys.readouterr().out
    args = vars(cli.parser().parse_args(["run", "--ports", "1-2", "3", "--llm-timeout", "5", "--input-dir", "/i", "--output-dir", "/o"]))
    assert args["ports"] == ["1-2", "3"] and args["llm_timeout"] == 5.0 and "model" not in args


def test_conform_fills_and_casts(spark):
    df = spark.createDataFrame([(1, {"b": 1})], "source_row int, judge_detail map<string,int>")
    row = conform(df, RECORD).first()
    assert row.source_row == 1 and row.judge_detail == '{"b":1}' and row.messages is None and conform(df, RECORD).schema == RECORD


# --- load


def test_load_run(spark, tmp_path):
    from tessera.plans import loadtest

    asked = loadtest.prompts(spark, 20, 100)
    assert {len(r.prompt) for r in asked.collect()} == {100} and asked.select("prompt").distinct().count() == 20

    def client():
        class Picky(generate.MockClient):
            async def complete(self, url, prompt):
                if ":7001/" in url:
                    raise generate.ConnectionLost("no")
                return await super().complete(url, prompt)

        return Picky()

    loadtest.drive(asked, client, [7000, 7001], 4).write.parquet(f"{tmp_path}/done")
    figures = loadtest.report(spark.read.parquet(f"{tmp_path}/done"))
    assert figures["total"] == 20 and figures["failed"] == 10 and figures["port_success"] == {7000: 10, 7001: 0} and figures["rps"] > 0
    assert loadtest.report(spark.read.parquet(f"{tmp_path}/done").where("false"))["rps"] == 0.0
    again = loadtest.run(spark, config.Settings("/i", "/o", ports="7000-7001", concurrency=4), 20, 100, client)
    assert again["total"] == 20 and again["port_failed"] == {7000: 0, 7001: 10}


def test_process_listing(tmp_path):
    script = tmp_path / "ls.sh"
    script.write_text("echo serve --port 7001\n")
    alive = generate.process_alive(f"sh {script}")
    assert [asyncio.run(alive(u)) for u in ("http://h:7001/v1", "http://h:7002/v1", "http://h/v1")] == [True, False, None]
    assert asyncio.run(generate.process_alive("/no/such/command")("http://h:1/v1")) is None


def test_one_large_file_is_numbered_over_its_splits(spark, tmp_path):
    lines(f"{tmp_path}/big.jsonl", [{"k": k} if k % 7 else "" for k in range(4000)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = scan.scan_jsonl(spark, [f"{tmp_path}/big.jsonl"])
        assert spark.read.text(f"{tmp_path}/big.jsonl").rdd.getNumPartitions() > 5
        assert [(r.source_row, r.k) for r in rows.orderBy("source_row").collect()] == list(enumerate(k for k in range(4000) if k % 7))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
