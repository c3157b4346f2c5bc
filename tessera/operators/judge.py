"""The judge: which check applies to a row, and its verdict on an answer.

The cascade is Python because it parses nested JSON, matches braces and runs programs; it reads Arrow
batches and adds plain columns. Text-only branches cost no process; programs run in the sandbox, one
child for each row that needs it. What a filter needs of the cascade without running anything is also
given as Columns at the end.
"""

from __future__ import annotations

import signal
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import codetext, examples, mathrules, sandbox, testcases
from tessera.functions.jsontext import canonical

VERDICT = T.StructType(
    [
        T.StructField("judge_type", T.StringType()),
        T.StructField("judge_backend", T.StringType()),
        T.StructField("is_correct", T.BooleanType()),
        T.StructField("judge_status", T.StringType()),
        T.StructField("judge_detail", T.StringType()),
    ]
)
PROGRAM_SECONDS, TEST_SECONDS = 10, 6
Verdict = tuple[str | None, str | None, bool | None, str, dict[str, Any] | None]
#: (prediction, reference) -> (usable, is_correct, detail); None where no symbolic checker is installed.
SymbolicCheck = Callable[[str, str], tuple[bool, bool | None, dict[str, Any]]]


@cache
def symbolic_check() -> SymbolicCheck | None:
    """The optional symbolic checker of mathematical answers, if its packages are there."""
    try:
        from latex2sympy2_extended import NormalizationConfig
        from math_verify import ExprExtractionConfig, LatexExtractionConfig, parse, verify
    except ImportError:
        return None

    def check(prediction: str, reference: str) -> tuple[bool, bool | None, dict[str, Any]]:
        rules = NormalizationConfig(nits=False, malformed_operators=False, basic_latex=True, equations=False, boxed="all", units=False)
        gold = parse(f"${reference}$", extraction_mode="first_match", extraction_config=[LatexExtractionConfig(normalization_config=rules), ExprExtractionConfig()])
        if not gold:
            return False, None, {"reason": "gold_parse_failed"}
        latex = LatexExtractionConfig(normalization_config=rules, boxed_match_priority=0, try_extract_without_anchor=False)
        answer = parse(prediction, extraction_mode="first_match", extraction_config=[latex])
        if not answer:
            return False, None, {"reason": "prediction_parse_failed"}
        return True, bool(verify(answer, gold)), {"prediction": str(answer), "reference": str(gold)}

    return check


def _unit_tests(row: dict[str, Any]) -> str | None:
    tests = row.get("test_list_2") or row.get("test_list")
    if isinstance(tests, list | tuple):
        tests = "\n".join(map(str, tests))
    return tests if isinstance(tests, str) and tests.strip() else None


def _by_unit_tests(row: dict, answer: str, _: str | None) -> Verdict | None:
    tests = _unit_tests(row)
    if tests is None:
        return None
    status = sandbox.run_program(f"{codetext.program(answer).rstrip()}\n{tests}", PROGRAM_SECONDS)
    return "code_mbpp", None, status == "pass", status, {"timeout_seconds": PROGRAM_SECONDS}


def _by_completion(row: dict, answer: str, _: str | None) -> Verdict | None:
    if codetext.completion_program(row, "") is None:
        return None
    program = codetext.completion_program(row, codetext.program(answer))
    status = sandbox.run_program(program, PROGRAM_SECONDS)
    return "code_humaneval", None, status == "pass", status, {"timeout_seconds": PROGRAM_SECONDS}


def _by_samples(row: dict, answer: str, _: str | None) -> Verdict | None:
    sample = testcases.sample(row)
    if not sample:
        return None
    r = sandbox.run_tests(sample, codetext.last_program(answer), TEST_SECONDS)
    return "code_livecodebench_generation", "livecodebench_v6", r["is_correct"], r["status"], r["detail"]


def _by_examples(row: dict, answer: str, _: str | None) -> Verdict | None:
    sample = examples.sample(row)
    if not sample:
        return None
    detail: dict[str, Any] = {"example_count": len(sample["inputs"]), "test_source": sample["source"]}
    reference = codetext.reference_program(row)
    if reference:  # examples that the reference itself fails are no test
        r = sandbox.run_tests(sample, reference, TEST_SECONDS)
        detail |= {"oracle_status": r["status"], "oracle_detail": r["detail"]}
        if not r["is_correct"]:
            return "code_prompt_examples", "prompt_examples_v1", None, "not_applicable", detail
    r = sandbox.run_tests(sample, codetext.last_program(answer), TEST_SECONDS)
    return "code_prompt_examples", "prompt_examples_v1", r["is_correct"], r["status"], detail | r["detail"]


def _by_caution(row: dict, _answer: str, _: str | None) -> Verdict | None:
    if codetext.is_code_task(row):
        return "code_unverified", "code_safeguard_v1", None, "not_applicable", {"reason": "code_task_without_reliable_tests"}
    return None


def _by_reference(row: dict, answer: str, label: str | None) -> Verdict | None:
    reference = codetext.reference_answer(row, label)
    if reference is None:
        return None
    check = symbolic_check()
    if check is None:
        why = {"verify_fallback_reason": "math_verify_unavailable"}
    else:
        try:
            usable, good, detail = check(answer, reference)
        except Exception as e:  # the checker's own faults lead to the rules
            why = {"verify_error": f"{type(e).__name__}:{e}"}
        else:
            if usable:
                return "math", "math_verify", good, "pass" if good else "wrong_answer", {"label_field": label} | detail
            why = {"verify_fallback_reason": detail.get("reason", "not_usable")}
    said, wanted = mathrules.answer_of(answer), mathrules.answer_of(reference)
    good = mathrules.equivalent(said, wanted)
    return "math", "math_rule", good, "pass" if good else "wrong_answer", {"prediction": said, "reference": wanted, "label_field": label} | why


#: Checks in order; the first that applies to a row decides.
CASCADE = (_by_unit_tests, _by_completion, _by_samples, _by_examples, _by_caution, _by_reference)


def verdict(row: dict[str, Any], messages: list[dict[str, Any]], label: str | None = None) -> Verdict:
    answer = codetext.answer_text(messages)
    for check in CASCADE:
        found = check(row, answer, label)
        if found is not None:
            return found
    return None, None, None, "not_applicable", None


def type_hint(row: dict[str, Any], label: str | None = None) -> str | None:
    """The judge type that applies to a row, without running anything."""
    kinds = (
        ("code_mbpp", lambda: _unit_tests(row) is not None),
        ("code_humaneval", lambda: codetext.completion_program(row, "") is not None),
        ("code_livecodebench_generation", lambda: testcases.sample(row) is not None),
        ("code_prompt_examples", lambda: examples.sample(row) is not None),
        ("code_unverified", lambda: codetext.is_code_task(row)),
        ("math", lambda: codetext.reference_answer(row, label) is not None),
    )
    return next((name for name, applies in kinds if applies()), None)


class _Late(BaseException):
    """Raised by the alarm; no check's own handler of exceptions catches it."""


@contextmanager
def _alarm(seconds: float | None) -> Iterator[None]:
    """An end to what runs inside, by the process's timer. It can only be set in a main thread, which is where
    Spark's Python workers run; elsewhere there is no limit but the sandbox's."""
    if not seconds or seconds <= 0 or threading.current_thread() is not threading.main_thread():
        yield
        return

    def ring(*_: Any) -> None:
        raise _Late

    before = signal.signal(signal.SIGALRM, ring)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def guarded(row: dict[str, Any], messages: list[dict[str, Any]], label: str | None = None, seconds: float | None = None) -> Verdict:
    """verdict(), with a failure of the judge itself and a verdict that takes longer than ``seconds`` as verdicts
    of their own. Without a limit time is bounded by the sandbox alone: its tests' limits added up."""
    try:
        with _alarm(seconds):
            return verdict(row, messages, label)
    except _Late:
        status, detail = "timeout", {"reason": "judge_process_timeout", "timeout_seconds": seconds}
    except Exception as e:
        status, detail = "failed", {"reason": "judge_process_error", "error_type": type(e).__name__, "error_message": str(e)}
    try:
        with _alarm(seconds):
            kind = type_hint(row, label)
    except (_Late, Exception):  # what made the judge fail may make the hint fail too
        kind = None
    return kind, "judge_subprocess_guard_v1", None, status, detail


def spread(df: DataFrame, most: int = 0) -> DataFrame:
    """df over all cores, or ``most`` partitions if that is given, where it comes from fewer files than that;
    costly Python follows, so the shuffle pays. Input of many files stays where it is, but for a given ``most``."""
    cores, files = df.sparkSession.sparkContext.defaultParallelism, df.inputFiles()
    wanted = min(cores, most) if most > 0 else cores
    if 0 < len(files) < wanted:
        return df.repartition(wanted)
    return df.coalesce(most) if most > 0 else df


def judge(df: DataFrame, row_columns: list[str], messages: str = "messages", label: str | None = None, seconds: float | None = None, most: int = 0, prefix: str = "") -> DataFrame:
    """df and the verdict's columns; judge_detail is canonical JSON, so figures of any shape share a column.

    seconds bounds each verdict, most the verdicts at a time (0: as many as there are cores). A row's columns
    are those named, with the prefix in df.
    """
    schema = T.StructType([*df.schema.fields, *VERDICT.fields])
    names = schema.fieldNames()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.select(list(dict.fromkeys([*(prefix + c for c in row_columns), messages]))).to_pylist()
            out = [guarded({c: r[prefix + c] for c in row_columns}, r[messages] or [], label, seconds) for r in wanted]
            out = [(*v[:4], None if v[4] is None else canonical(v[4])) for v in out]
            kinds = (pa.string(), pa.string(), pa.bool_(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([v[k] for v in out], t) for k, t in enumerate(kinds))], names=names)

    return spread(df, most).mapInArrow(each, schema)


def text_kernel(kernel: Callable[..., Any], kind: T.DataType | str) -> Callable[..., Column]:
    """A Column function of text columns from a kernel, by Arrow batches."""
    @F.pandas_udf(kind)
    def call(*columns: pd.Series) -> pd.Series:
        return pd.Series([kernel(*(None if isinstance(v, float) else v for v in row)) for row in zip(*columns)], dtype=object)

    return call


def _any_of(column: Column, signs: tuple[str, ...]) -> Column:
    low = F.lower(F.coalesce(column, F.lit("")))
    found = F.lit(False)
    for s in signs:
        found = found | low.contains(s)
    return found


def python_score(code: Column) -> Column:
    """codetext.python_score() as a Column."""
    body = F.regexp_replace(code, r"^\s+|\s+$", "")
    low = F.lower(body)
    score = F.lit(0)
    for s in codetext.PYTHON_SIGNS:
        score = score + low.contains(s).cast("int")
    for s in codetext.FOREIGN_SIGNS:
        score = score - 3 * low.contains(s).cast("int")
    lines = F.length(body) - F.length(F.replace(body, F.lit("\n"), F.lit("")))
    return score + 2 * low.contains("class solution").cast("int") + (lines >= 2).cast("int") - 5 * body.rlike(r"^[\d\s.\-]+$").cast("int")


def is_code_task(df: DataFrame) -> Column:
    """codetext.is_code_task() over the columns that df has, test columns as text."""
    has = set(df.columns)
    col = lambda c: F.col(c).cast("string") if c in has else F.lit(None).cast("string")
    tests = F.lit(False)
    for c in codetext.TEST_COLUMNS:
        if c in has:
            tests = tests | (F.length(F.coalesce(col(c), F.lit(""))) > 0)
    names = F.lower(F.concat_ws(" ", *(F.coalesce(col(c), F.lit("")) for c in codetext.DATASET_COLUMNS)))
    found = tests | _any_of(names, codetext.CODE_DATASETS)
    for c in (*codetext.SOLUTION_COLUMNS, "output"):
        found = found | _any_of(col(c), codetext.CODE_SIGNS)
    prompt = F.coalesce(*(F.when(col(c) != "", col(c)) for c in ("input", "prompt", "question")))
    return found | _any_of(prompt, codetext.CODE_PHRASES)


def reference_answer(df: DataFrame, preferred: str | None = None) -> Column:
    """codetext.reference_answer() over the columns that df has."""
    has = dict(df.dtypes)
    found = []
    for c in ([preferred] if preferred else []) + list(codetext.REFERENCE_COLUMNS):
        if c in has:
            trimmed = F.trim(F.col(c).cast("string")) if has[c] != "string" else F.regexp_replace(c, r"^\s+|\s+$", "")
            found.append(F.when(trimmed != "", trimmed))
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def is_suspicious(df_has_detail: bool = True) -> Column:
    """Records whose verdict rests on a doubtful test: columns dataset_name, judge_type, judge_status,
    judge_detail (JSON) and messages."""
    detail = F.col("judge_detail")
    expected = F.coalesce(F.get_json_object(detail, "$.expected"), F.lit("")) if df_has_detail else F.lit("")
    output = F.coalesce(F.get_json_object(detail, "$.output"), F.lit("")) if df_has_detail else F.lit("")
    first = F.coalesce(F.try_element_at(F.filter("messages", lambda m: m["role"] == "assistant"), F.lit(1))["content"], F.lit(""))
    fences = (F.length(first) - F.length(F.replace(first, F.lit("```"), F.lit("")))) / 3
    two_programs = F.lower(first).contains("```python") & (fences >= 4)
    status = F.coalesce(F.col("judge_status"), F.lit(""))
    return (
        ((F.coalesce(F.col("dataset_name"), F.lit("")) == "code_contests") & (F.coalesce(F.col("judge_type"), F.lit("")) == "math"))
        | expected.contains("Constraints")
        | expected.contains("Warning")
        | (expected.contains("Input") & expected.contains("Output"))
        | ((status == "wrong_answer") & (output == "") & two_programs)
        | ((status == "failed") & two_programs)
    )
