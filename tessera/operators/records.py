"""Records: what is derived from a task, its messages and the verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.jsontext import canonical
from tessera.operators.schema import MESSAGE_KEYS, RECORD, conform
from tessera.operators.tasks import trimmed

# Keys of the metadata of rows that bring none, and columns that may name the dataset.
METADATA_KEYS = (
    "avatarUrl", "category", "custom_instruction", "hash", "id", "idx", "language", "model", "model_name", "skip_prompt_formatting", "source",
    "system_prompt", "title", "topic", "views",
)
NAME_COLUMNS = ("dataset_name", "dataset", "source_dataset")
#: Keys of a message in the order of canonical JSON.
_MESSAGE_KEYS = ("content", "name", "reasoning_content", "role", "tool_call_id", "tool_calls")


def shaped(messages: Column, fields: list[str]) -> Column:
    """Messages with the six keys; missing ones null, tool calls as JSON text."""
    return F.transform(messages, lambda m: F.struct(*[(m[k].cast("string") if k in fields else F.lit(None).cast("string")).alias(k) for k in MESSAGE_KEYS]))


def dataset_name(df: DataFrame) -> Column:
    """The first name that is not blank, else the source file's stem."""
    stem = F.regexp_replace(F.regexp_extract("source_file", r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    kinds = dict(df.dtypes)
    return F.coalesce(*(trimmed(F.col(c)) for c in NAME_COLUMNS if kinds.get(c) == "string"), stem)


def sample_id() -> Column:
    return F.concat_ws(":", "dataset_name", "source_file", F.col("source_row").cast("string"), F.concat(F.lit("rollout_"), F.col("rollout_index").cast("string")))


def content_chars(messages: Column) -> Column:
    """Code points in the messages' texts, and in their tool calls' JSON."""
    sizes = lambda m: sum((F.coalesce(F.length(m[k]), F.lit(0)) for k in ("content", "reasoning_content", "name", "tool_call_id", "tool_calls")), F.lit(0))
    return F.aggregate(messages, F.lit(0).cast("long"), lambda a, m: a + sizes(m))


def has_reasoning(messages: Column) -> Column:
    return F.exists(messages, lambda m: F.coalesce(trimmed(m["reasoning_content"]).isNotNull(), F.lit(False)))


#: Control characters whose escapes hold a letter.
_LETTERED = [n for n in range(0x20) if f"{n:04x}" != f"{n:04X}" and n not in (0x0A, 0x0C, 0x0D)]


def json_text(value: Column) -> Column:
    """A JSON string of a text as Python writes it: letters as they are, control characters in lower-case hex.

    to_json() writes those in upper case; the few texts that hold one get their escapes lowered, but not what
    looks like an escape behind a backslash of the text's own.
    """
    quoted = F.substring(F.to_json(F.struct(value.alias("s"))), 6, 2147483647)
    quoted = F.left(quoted, F.length(quoted) - 1)
    lowered = quoted
    for n in _LETTERED:
        lowered = F.regexp_replace(lowered, rf"(?<!\\)((?:\\\\)*)\\u{n:04X}", rf"$1\\u{n:04x}")
    rare = value.rlike("[" + "".join(rf"\x{n:02x}" for n in _LETTERED) + "]")
    return F.when(value.isNull(), "null").when(rare, lowered).otherwise(quoted)


def canonical_messages(messages: Column) -> Column:
    """Canonical JSON of shaped messages; tool calls are spliced in as the JSON they are."""
    one = lambda m: F.concat(
        F.lit("{"),
        *[p for k in _MESSAGE_KEYS for p in (F.lit(f'{"" if k == _MESSAGE_KEYS[0] else ", "}"{k}": '), F.coalesce(m[k], F.lit("null")) if k == "tool_calls" else json_text(m[k]))],
        F.lit("}"),
    )
    return F.concat(F.lit("["), F.array_join(F.transform(messages, one), ", "), F.lit("]"))


def dedup_hash(messages: Column) -> Column:
    return F.sha2(canonical_messages(messages), 256)


def metadata(df: DataFrame) -> Column:
    """Metadata text as it is, other metadata as JSON, of rows without any the template of null keys."""
    template = F.lit(canonical(dict.fromkeys(METADATA_KEYS)))
    if "metadata" not in df.columns:
        return template
    kind = df.schema["metadata"].dataType
    if isinstance(kind, T.StringType):
        return F.coalesce("metadata", template)
    if isinstance(kind, T.StructType | T.MapType | T.ArrayType):
        return F.coalesce(_canonical_json("metadata"), template)
    return F.coalesce(F.col("metadata").cast("string"), template)


def _canonical_json(column: str) -> Column:
    import json

    from tessera.operators.judge import text_kernel

    return text_kernel(lambda t: None if t is None else canonical(json.loads(t)), "string")(F.to_json(column, {"ignoreNullFields": "false"}))


def last_answer(messages: Column) -> Column:
    """The last assistant message's content, or no text."""
    return F.coalesce(F.try_element_at(F.filter(messages, lambda m: m["role"] == "assistant"), F.lit(-1))["content"], F.lit(""))


def build(judged: DataFrame) -> DataFrame:
    """Records of judged rows: source columns, key columns, messages, finish_reason, usage (JSON or null) and the verdict."""
    message_fields = judged.schema["messages"].dataType.elementType.fieldNames()
    df = judged.withColumn("dataset_name", dataset_name(judged)).withColumn("messages", shaped(F.col("messages"), message_fields))
    usage = F.when(~F.coalesce("usage", F.lit("{}")).isin("{}", ""), F.col("usage"))
    tokens = {k: F.get_json_object(usage, f"$.{k}").try_cast("long") for k in ("prompt_tokens", "completion_tokens", "total_tokens")}
    df = df.withColumns({"sample_id": sample_id(), "metadata": metadata(judged), "generation_finish_reason": F.col("finish_reason"), "generation_usage": usage} | tokens)
    df = df.withColumns(
        {
            "dedup_hash": dedup_hash(F.col("messages")),
            "content_chars": content_chars(F.col("messages")),
            "turn_count": F.size("messages").cast("long"),
            "has_reasoning": has_reasoning(F.col("messages")),
            "adapter_status": F.lit("success"),
            "adapter_name": F.lit("sharegpt"),
            "record_mode": F.lit("sft"),
        }
    )
    constant = {c: F.lit(None).cast("string") for c in ("text", "chosen", "rejected", "tools", "system", "adapter_error")}
    return conform(df.withColumns(constant), RECORD)
