"""JSON text and prompts: kernels for values whose shape is known only at run time."""

from __future__ import annotations

import json
from collections.abc import Iterable
from typing import Any


def canonical(value: Any) -> str:
    """Sorted keys, ", " and ": " between parts, letters beyond ASCII as they are; what JSON lacks becomes its str()."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, default=str)


def prompt_text(value: Any) -> str | None:
    """The prompt in a string, message, list of either, or JSON text of any of these; None if there is none.

    A text that decodes as JSON is what it decodes to, even if that holds no prompt. Of messages with
    roles, the user's count; parts are joined by an empty line.
    """
    if hasattr(value, "tolist"):
        value = value.tolist()
    match value:
        case str():
            text = value.strip()
            if text[:1] in ("[", "{"):
                try:
                    decoded = json.loads(text)
                except (ValueError, RecursionError):
                    return text
                return prompt_text(decoded)
            return text or None
        case dict():
            inner = value.get("content")
            return inner.strip() or None if isinstance(inner, str) else prompt_text(inner)
        case list() | tuple():
            return "\n\n".join(_parts(value)) or None
    return None


def _parts(items: Iterable[Any]) -> Iterable[str]:
    for item in items:
        if isinstance(item, str):
            text = item.strip()
        elif isinstance(item, dict) and item.get("role") == "user":
            text = prompt_text(item.get("content"))
        else:
            continue
        if text:
            yield text


def decoded(raw: Any) -> Any:
    """JSON text as its value, values as they are; None for blank or broken text."""
    if isinstance(raw, dict | list):
        return raw
    if isinstance(raw, str) and raw.strip():
        try:
            return json.loads(raw)
        except (ValueError, RecursionError):
            return None
    return None


def valid_line(line: str | None) -> bool:
    """Whether a line of a JSON-lines file holds a row: one JSON value and nothing else."""
    if line is None or not line.strip():
        return False
    try:
        json.loads(line)
    except (ValueError, RecursionError):
        return False
    return True


def usage(raw: Any) -> dict[str, Any]:
    """Usage figures as a JSON-safe dict: of a mapping all, of another object those with a value."""
    if raw is None:
        return {}
    if not isinstance(raw, dict):
        names = ("prompt_tokens", "completion_tokens", "total_tokens", "prompt_tokens_details", "completion_tokens_details")
        raw = {n: getattr(raw, n) for n in names if getattr(raw, n, None) is not None}
    return json.loads(canonical(raw))
