"""Tasks: prompts, rollouts and what is still to be done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.jsontext import prompt_text
from tessera.operators.judge import text_kernel
from tessera.operators.schema import KEY

# What asks for Python before the prompts of some tasks, and the names of those tasks.
PYTHON_REQUEST = (
    "Solve this problem using Python.\n"
    "Return a Python solution that can be executed directly.\n"
    "Use standard input and standard output.\n"
    "Put the final answer inside a ```python``` or ```Python``` code block.\n"
    "A brief explanation is okay, but make sure the final answer includes Python code.\n\n"
    "Problem:\n"
)
PYTHON_TASKS = ("opencode_reasoning", "opencodereasoning")
_BLANK = r"^\s+|\s+$"


def trimmed(column: Column) -> Column:
    """Without white space at both ends; null if nothing is left."""
    text = F.regexp_replace(column, _BLANK, "")
    return F.when(text != "", text)


def prompt(df: DataFrame, column: str) -> Column:
    """The prompt in a column of text, a message, or a list of texts or messages.

    Typed messages stay in the JVM. Of a text column only texts that start like JSON are sent to the kernel with
    their content; other rows pass its worker as a null.
    """
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    parse = text_kernel(prompt_text, "string")
    if isinstance(kind, T.StringType):
        text = trimmed(c)
        is_json = text.startswith("[") | text.startswith("{")
        return F.when(is_json, parse(F.when(is_json, text))).otherwise(text)
    if isinstance(kind, T.StructType):
        return trimmed(c["content"]) if "content" in kind.fieldNames() else F.lit(None).cast("string")
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        parts = F.filter(F.transform(c, lambda x: trimmed(x)), lambda x: x.isNotNull())
        return F.when(F.size(parts) > 0, F.array_join(parts, "\n\n"))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) and {"role", "content"} <= set(kind.elementType.fieldNames()):
        # A user's content that is itself JSON is taken apart by the kernel, from the list as JSON text.
        texts = F.transform(F.filter(c, lambda m: m["role"] == "user"), lambda m: trimmed(m["content"]))
        texts = F.filter(texts, lambda x: x.isNotNull())
        nested = F.exists(texts, lambda x: x.startswith("[") | x.startswith("{"))
        return F.when(nested, parse(F.when(nested, F.to_json(c)))).when(F.size(texts) > 0, F.array_join(texts, "\n\n"))
    return F.lit(None).cast("string")


def asks_for_python(*names: str | None) -> bool:
    """Whether a task's name, config path or folders are of a kind that must ask for Python."""
    joined = " ".join(n or "" for n in names).lower()
    return any(t in joined for t in PYTHON_TASKS)


def with_request(column: Column, *names: str | None) -> Column:
    return F.concat(F.lit(PYTHON_REQUEST), column) if asks_for_python(*names) else column


def rollouts(df: DataFrame, count: int) -> DataFrame:
    """Each row once for each rollout, numbered from 0; none for a count below 1."""
    numbers = F.sequence(F.lit(0), F.lit(count - 1)) if count > 0 else F.array().cast("array<int>")
    return df.withColumn("rollout_index", F.explode(numbers)).withColumn("rollout_index", F.col("rollout_index").cast("long"))


def make_tasks(rows: DataFrame, field: str, count: int, names: tuple[str | None, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(tasks, failures) of scanned rows: every rollout of each row with a prompt; a failure for each without."""
    text = prompt(rows, field) if field in rows.columns else F.lit(None).cast("string")
    with_prompt = rows.withColumn("prompt_text", text)
    tasks = rollouts(with_prompt.where("prompt_text is not null"), count).withColumn("prompt_text", with_request(F.col("prompt_text"), *names))
    return tasks, empty_prompts(with_prompt, field)


def empty_prompts(with_prompt: DataFrame, field: str) -> DataFrame:
    return with_prompt.where("prompt_text is null").select("source_file", "source_row", F.lit(0).cast("long").alias("rollout_index"), F.lit(f"empty_or_unsupported_input:{field}").alias("reason"))


def pending(tasks: DataFrame, completed: DataFrame | None = None, failed: DataFrame | None = None) -> DataFrame:
    """Tasks whose key is neither completed nor failed. Keys stay three columns: nothing is parsed or glued."""
    for done in (completed, failed):
        if done is not None:
            tasks = tasks.join(done.select(*KEY), KEY, "left_anti")
    return tasks


def new_failures(failures: DataFrame, known: DataFrame | None) -> DataFrame:
    """Failures not on record yet, each key once (of several rows the least by its other columns), so that a rerun adds nothing."""
    fresh = failures if known is None else failures.join(known.select(*KEY), KEY, "left_anti")
    rest = [c for c in fresh.columns if c not in KEY]
    if not rest:
        return fresh.distinct()
    return fresh.groupBy(*KEY).agg(F.min(F.struct(*rest)).alias("rest")).select(*KEY, "rest.*")

