"""Tests attached to a row, and the comparison of outputs with what they expect."""

from __future__ import annotations

import base64
import json
import math
import zlib
from typing import Any

from tessera.functions.jsontext import decoded

# Columns with whole samples, and keys that may name the function under test.
SAMPLE_COLUMNS = ("input_output", "evaluation_sample")
FUNCTION_KEYS = ("func_name", "fn_name", "function_name", "entry_point")


def _texts(value: Any) -> list[str]:
    return ["" if v is None else str(v) for v in value] if isinstance(value, list) else []


def _packed(raw: Any) -> Any:
    """JSON behind base64 and zlib. Serialised Python objects are not unpacked: loading one runs its code."""
    if not isinstance(raw, str) or not raw.strip():
        return None
    try:
        return json.loads(zlib.decompress(base64.b64decode(raw, validate=True)))
    except (ValueError, zlib.error, RecursionError):
        return None


def _cases(raw: Any, packed: bool = False) -> list[dict]:
    value = decoded(raw)
    if value is None and packed:
        value = _packed(raw)
    return [c for c in value if isinstance(c, dict)] if isinstance(value, list) else []


def _function(metadata: Any) -> str | None:
    value = decoded(metadata)
    names = (value.get(k) for k in FUNCTION_KEYS) if isinstance(value, dict) else ()
    return next((n.strip() for n in names if isinstance(n, str) and n.strip()), None)


def sample(row: dict[str, Any]) -> dict[str, Any] | None:
    """Inputs, outputs, function name and source of a row's tests; None without usable ones."""
    for column in SAMPLE_COLUMNS:
        value = decoded(row.get(column))
        if isinstance(value, dict):
            inputs, outputs, name = _texts(value.get("inputs")), _texts(value.get("outputs")), value.get("fn_name")
            if inputs and len(inputs) == len(outputs):
                return {"inputs": inputs, "outputs": outputs, "fn_name": name if isinstance(name, str) and name.strip() else None, "source": column}
    cases = [c for c in _cases(row.get("public_test_cases")) + _cases(row.get("private_test_cases"), packed=True) if "input" in c and "output" in c]
    if not cases:
        return None
    return {
        "inputs": _texts([c["input"] for c in cases]),
        "outputs": _texts([c["output"] for c in cases]),
        "fn_name": _function(row.get("metadata")),
        "source": "public_private_test_cases",
    }


def plain(value: Any) -> Any:
    """JSON values with whole-number keys as numbers and tuples as lists."""
    if isinstance(value, dict):
        return {int(k) if isinstance(k, str) and k.lstrip("-").isdigit() else k: plain(v) for k, v in value.items()}
    return [plain(v) for v in value] if isinstance(value, list | tuple) else value


def arguments(text: str) -> list[Any]:
    """Call arguments: a JSON value for each line that is not blank."""
    return [plain(json.loads(line)) for line in text.split("\n") if line.strip()]


def same_value(actual: Any, expected: Any) -> bool:
    """Equal, or equal to the first of the expected list."""
    actual, expected = plain(actual), plain(expected)
    return actual == expected or (isinstance(expected, list) and bool(expected) and actual == expected[0])


def _whole(text: str) -> bool:
    return text.lstrip("-").isdigit()


def same_output(output: str, expected: str) -> bool:
    """Printed output against the expected text: as it is, by stripped lines, as whole numbers if all are,
    as floats, and last by the set of tokens on each line."""
    lines = output.splitlines()
    wanted = expected.strip()
    if "\n".join(lines).strip() == wanted or "\n".join(map(str.strip, lines)).strip() == wanted:
        return True
    got, want = ([s for s in map(str.strip, x) if s] for x in (lines, expected.split("\n")))
    if got == want:
        return True
    if got and want:
        if all(_whole(g) and _whole(w) for g, w in zip(got, want)):
            return False
        try:
            if len(got) == len(want) and all(math.isclose(g, w, rel_tol=1e-9, abs_tol=1e-9) for g, w in zip([float(x) for x in got], [float(x) for x in want])):
                return True
        except ValueError:
            pass
    return bool(got) and [set(g.split()) for g in got] == [set(w.split()) for w in want]


def shortened(text: str, length: int = 300) -> str:
    """A long text's two halves around a mark."""
    half = max(1, length // 2)
    return text if len(text) <= length else f"{text[:half]}...(truncated)...{text[-half:]}"
