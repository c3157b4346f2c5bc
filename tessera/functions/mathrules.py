"""Rules that tell whether two short mathematical answers are the same.

The rewrites are data: each table below is applied from top to bottom, and their order is part of the
result. The functions only say when a table applies.
"""

from __future__ import annotations

import re

# Literal rewrites of a final answer, in order.
SUBSTITUTIONS = (
    ("an ", ""),
    ("a ", ""),
    (".$", "$"),
    ("\\$", ""),
    ("\\ ", ""),
    (" ", ""),
    ("mbox", "text"),
    (",\\text{and}", ","),
    ("\\text{and}", ","),
    ("\\text{m}", "\\text{}"),
    ("\\le", "<"),
)
# Expressions removed after that, in order.
REMOVED = (
    "square", "ways", "integers", "dollars", "mph", "inches", "ft", "hours", "km", "units", "\\ldots", "sue", "points",
    "feet", "minutes", "digits", "cents", "degrees", "cm", "gm", "pounds", "meters", "meals", "edges", "students",
    "childrentickets", "multiples", "\\text{s}", "\\text{.}", "\\text{\ns}", "\\text{}^2", "\\text{}^3", "\\text{\n}",
    "\\text{}", "\\mathrm{th}", "^\\circ", "^{\\circ}", "\\;", ",\\!", "{,}", '"', "\\dots", "\n", "\r", "\f",
)
# Wrappers that are replaced by what they hold.
WRAPPERS = (r"\\text\{\((.*?)\)\}", r"\\text\{(.*?)\}", r"\\textbf\{(.*?)\}", r"\\overline\{(.*?)\}", r"\\boxed\{(.*)\}")
# Where one of these occurs, its last capture is the answer.
ANSWERS = (r"finalansweris(.*)", r"answer?is:?(.*)", r"oxed\{(.*?)\}", r"\$(.*?)\$")
# Literal rewrites of an expression before and after units of text are cut off, in order.
EXPRESSION_FIRST = (("\\!", ""), ("\\ ", ""), ("\\\\", "\\"), ("tfrac", "frac"), ("dfrac", "frac"), ("\\left", ""), ("\\right", ""))
EXPRESSION_THEN = (
    ("^{\\circ}", ""), ("^\\circ", ""), ("\\$", ""), ("$", ""), ("\\text", ""), ("x\\in", ""), ("\\%", ""), ("%", ""),
    (" .", " 0."), ("{.", "{0."), ("\\cdot", ""), ("infinity", "\\infty"),
)

_WRAPPERS = tuple(re.compile(p) for p in WRAPPERS)
_ANSWERS = tuple(re.compile(p) for p in ANSWERS)
_FINAL = SUBSTITUTIONS + tuple((e, "") for e in REMOVED)
_EXPRESSION_LAST = (("+\\inity", "\\infty"), ("and", ""), ("\\mathbf", ""))
_BARE_FRACTION, _BARE_ROOT, _ROOT = re.compile(r"frac([^{])(.)"), re.compile(r"sqrt([^{])"), re.compile(r"\\sqrt(\w+)")
_UNIT, _MBOX = re.compile(r"\\text{.*?}$"), re.compile(r"\\mbox{.*?}")
_ZEROS, _LAST_ZEROS = re.compile(r"(\d+)\.0+([^\d])"), re.compile(r"(\d+)\.0+$")
_WHOLE_FRACTION = re.compile(r"(-?[1-9][0-9]*|0)/(-?[1-9][0-9]*|0)")


def _rewrite(text: str, table: tuple[tuple[str, str], ...]) -> str:
    for old, new in table:
        text = text.replace(old, new)
    return text


def boxed(text: str) -> str | None:
    r"""What the last \boxed{...} holds, braces matched; None if it is not closed or holds no braces."""
    start = text.rfind("\\boxed")
    if start < 0 or not text.startswith("{", start + 6):
        return None
    depth = 0
    for brace in re.compile("[{}]").finditer(text, start):
        depth += 1 if brace[0] == "{" else -1
        if depth == 0:
            return text[start + 7 : brace.start()]
    return None


def final_answer(text: str) -> str:
    """A final answer without units, wrappers and introductions."""
    text = _rewrite(text, _FINAL)
    for wrapper in _WRAPPERS:
        text = wrapper.sub(r"\1", text)
    for pattern in _ANSWERS:
        found = pattern.findall(text)
        text = found[-1] if found else text
    text = text.strip()
    if "rac" in text and "\\frac" not in text:
        text = text.replace("rac", "\\frac")
    text = _BARE_ROOT.sub(r"sqrt{\1}", _BARE_FRACTION.sub(r"frac{\1}{\2}", text)).replace("$", "")
    digits = text.replace(",", "")
    return digits if digits.isdigit() else text


def answer_of(text: str) -> str:
    """The answer that a solution states: boxed, or in its first sentence that announces one, or in its first sentence."""
    held = boxed(text)
    if held is not None:
        doubled = re.fullmatch(r"\{(.*)\}\n?", held)
        held = doubled[1] if doubled else held
        if held:
            return held
    sentences = text.split(".")
    announced = (s for s in sentences if "final answer" in s.lower() or "answer is" in s.lower())
    return final_answer(next(announced, sentences[0]))


def _fractions(text: str) -> str:
    r"""\frac with bare one-character parts gets braces; a \frac too short for that leaves all as it was."""
    head, *rest = text.split("\\frac")
    if any(len(r) < 2 and r != "{" for r in rest):
        return text
    braced = [r if r[0] == "{" else f"{{{r[0]}}}{r[1:]}" if r[1] == "{" else f"{{{r[0]}}}{{{r[1]}}}{r[2:]}" for r in rest]
    return "\\frac".join([head, *braced])


def expression(text: str) -> str:
    """An expression in one spelling: of fractions, roots, units, decimals and spaces."""
    text = _rewrite(str(text).strip().replace("\n", "").rstrip("."), EXPRESSION_FIRST)
    text = _UNIT.sub("", text).strip() or text
    text = _rewrite(text, EXPRESSION_THEN)
    if "\\infty" not in text:
        text = text.replace("inf", "\\infty")
    text = _rewrite(text, _EXPRESSION_LAST)
    text = _rewrite(_MBOX.sub("", text), (("'", ""), ('"', "")))
    if "i" not in text:
        text = text.replace("j", "i")
    text = _LAST_ZEROS.sub(r"\1", _ZEROS.sub(r"\1\2", text))
    if text.startswith("."):
        text = "0" + text
    left, equals, right = text.partition("=")
    if equals and "=" not in right and len(left) <= 2:
        text = right
    text = _fractions(_ROOT.sub(r"\\sqrt{\1}", text).replace(" ", ""))
    whole = _WHOLE_FRACTION.fullmatch(text)
    return rf"\frac{{{whole[1]}}}{{{whole[2]}}}" if whole else text


def equivalent(a: str | None, b: str | None) -> bool:
    """Whether two answers are the same in any of the spellings above; two missing ones are."""
    if a is None or b is None or a == b:
        return a == b
    spellings = (expression, lambda t: final_answer(expression(t)), final_answer, lambda t: t)
    return any(spell(a) == spell(b) for spell in spellings)
