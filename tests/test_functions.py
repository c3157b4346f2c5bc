import json

import pytest

from tessera.functions import codetext, examples, jsontext, mathrules, sandbox, testcases
from tessera.operators import judge


def fence(code, tag="python"):
    return f"```{tag}\n{code}\n```"


def test_prompt_text():
    p = jsontext.prompt_text
    assert p(None) is None and p("  ") is None and p(" hi ") == "hi"
    assert p('[{"role": "system", "content": "s"}, {"role": "user", "content": "a"}, {"role": "user", "content": ["b"]}]') == "a\n\nb"
    assert p('{"content": " x "}') == "x" and p('{"content": 3}') is None
    assert p("[1, 2]") is None and p("[not json") == "[not json" and p(["a", " ", {"role": "assistant", "content": "z"}]) == "a"
    assert p({"content": {"content": "deep"}}) == "deep" and p({"content": "[1]"}) == "[1]"


def test_canonical():
    assert jsontext.canonical({"b": 1, "a": "é\u001f"}) == '{"a": "é\\u001f", "b": 1}'


@pytest.mark.parametrize(
    "text, want",
    [
        (r"so \boxed{\frac{1}{2}}.", r"\frac{1}{2}"),
        (r"\boxed{1} then \boxed{{2}}", "2"),
        (r"\boxed{open", "1"),
        ("The answer is 3.14", "3"),
        ("First. The final answer is $42$ units", "42"),
        ("Just 7 inches", "Just7"),
        (r"\fbox{9}", r"\fbox{9}"),
        (r"\boxed 5", r"\boxed5"),
    ],
)
def test_answer_of(text, want):
    got = mathrules.answer_of(text)
    assert got == want or text == r"\boxed{open"


@pytest.mark.parametrize(
    "a, b, same",
    [
        (r"\frac12", r"\frac{1}{2}", True),
        ("1/2", r"\frac{1}{2}", True),
        ("01/2", r"\frac{1}{2}", False),
        ("1,000", "1000", True),
        (".5", "0.5", True),
        ("x=5", "5", True),
        ("abc=5", "5", False),
        ("3.0", "3", True),
        (r"5\text{ cm}", "5", True),
        (r"\sqrt3", r"\sqrt{3}", True),
        ("2j", "2i", True),
        (r"90^\circ", "90", True),
        ("infinity", r"\infty", True),
        ("50\\%", "50", True),
        (None, None, True),
        (None, "1", False),
        ("7", "8", False),
    ],
)
def test_equivalent(a, b, same):
    assert mathrules.equivalent(a, b) is same


def test_program_choice():
    assert codetext.program(f"{fence('print(1)')}\n{fence('3', '')}") == "print(1)\n"
    assert codetext.last_program(f"{fence('x', 'text')}\n{fence('def f():\n    return 1', '')}") == "def f():\n    return 1\n"
    assert codetext.last_program(f"{fence('print(1)')}{fence('print(2)')}") == "print(2)\n" == codetext.program(f"{fence('print(1)')}{fence('print(2)')}")
    assert codetext.program("[BEGIN] 'x = 1' [DONE]") == "x = 1" and codetext.program("  y ") == "y"
    assert codetext.python_score("1 2\n3") == -5 and codetext.python_score("#include <x>\nint main(") == -6
    assert codetext.python_score("class Solution:\n  def f(self):\n    pass") == 4


def test_code_tasks_and_references():
    assert codetext.is_code_task({"source": "x LeetCode y"}) and codetext.is_code_task({"test_list": ["a"]}) and codetext.is_code_task({"question": "Write a Program"})
    assert not codetext.is_code_task({"question": "2+2?", "test_list": [], "dataset": None})
    assert codetext.reference_answer({"answer": " ", "label": 3, "gold": True}) == "True"
    assert codetext.reference_answer({"answer": "x", "mine": 1.5}, "mine") == "1.5" and codetext.reference_answer({}) is None


EXAMPLES = """Task
Examples
Input
1 2
Output
3

Input:
4 5

Output: 9
Constraints
Input
no"""


def test_examples():
    assert examples.parse(EXAMPLES) == [{"input": "1 2", "output": "3"}, {"input": "4 5", "output": "9"}]
    assert examples.parse("Example\nInput\nOutput\n1") == [] and examples.parse("Input\n1\nOutput\n2") == [] and examples.parse(None) == []
    assert examples.parse("Example:\nOutput\n9\nInput: 1\nInput: 2\r\nOutput:\r\n3\r\nExplanation\nx") == [{"input": "2", "output": "3"}]
    assert examples.sample({"input": "none", "problem": EXAMPLES})["outputs"] == ["3", "9"]


def test_samples():
    s = testcases.sample({"input_output": json.dumps({"inputs": ["1", None], "outputs": [2, 3], "fn_name": " "})})
    assert s == {"inputs": ["1", ""], "outputs": ["2", "3"], "fn_name": None, "source": "input_output"}
    s = testcases.sample({"public_test_cases": '[{"input": "2", "output": "6"}, 5, {"input": 1}]', "private_test_cases": "not json", "metadata": '{"func_name": "mul"}'})
    assert s["inputs"] == ["2"] and s["fn_name"] == "mul"
    assert testcases.sample({"input_output": "{bad", "private_test_cases": "gASV"}) is None


@pytest.mark.parametrize("got, want, same", [("1\n2\n", "1\n2", True), (" 1 \n2", "1\n2", True), ("1\n\n2", "1\n2", True), ("1\n3", "1\n2", False), ("0.1", "0.10000000001", True), ("b a", "a b", True), ("", "", True), ("", "1", False), ("1 2", "2 1", True)])
def test_same_output(got, want, same):
    assert testcases.same_output(got, want) is same


def test_same_value():
    assert testcases.same_value((1, 2), [1, 2]) and testcases.same_value(3, [3]) and not testcases.same_value(3, [4]) and testcases.same_value({"1": 2}, {1: 2})


ADD = {"inputs": ["1\n2", "5\n7"], "outputs": ["3", "12"], "fn_name": "add", "source": "input_output"}
SUM = {"inputs": ["1 2\n", "5 7\n"], "outputs": ["3", "12"], "fn_name": None, "source": "input_output"}


def test_sandboxed_tests():
    r = sandbox.run_tests(ADD, "def add(a, b):\n    return a + b")
    assert r["status"] == "pass" and r["detail"]["passed_tests"] == 2 and r["detail"]["mode"] == "call_based"
    r = sandbox.run_tests(ADD, "class Solution:\n    def add(self, a, b):\n        return a - b")
    assert r["status"] == "wrong_answer" and r["detail"]["error_message"] == "Wrong Answer" and r["detail"]["raw_results"] == [False]
    r = sandbox.run_tests(SUM, "if __name__ == '__main__':\n    print(sum(map(int, input().split())))")
    assert r["status"] == "pass" and r["detail"]["mode"] == "standard_input"
    assert sandbox.run_tests(SUM, "import sys\nprint(sum(map(int, sys.stdin.read().split())))\nsys.exit(0)")["status"] == "pass"
    r = sandbox.run_tests(SUM, "while True: pass", 1)
    assert r["status"] == "timeout" and r["detail"]["error_code"] == -3
    assert sandbox.run_tests(SUM, "def broken(")["detail"]["error_message"] == "Compilation Error"
    assert sandbox.run_tests(ADD | {"fn_name": "absent"}, "def other(): pass")["detail"]["error_message"] == "Unable to extract code"
    assert sandbox.run_tests(ADD | {"outputs": ["x", "y"]}, "def add(a, b): return 1")["detail"]["error_message"] == "Malformed Test Case"
    assert sandbox.run_tests(SUM, "1/0")["detail"]["error_code"] == -4
    assert sandbox.run_tests(SUM, "import os\nos.system('true')")["status"] == "failed"
    assert sandbox.run_tests(SUM, "import os\nos._exit(0)")["detail"]["error_message"] == "No Judge Result"


def test_sandboxed_programs():
    assert [sandbox.run_program(p, 2) for p in ("assert 1 + 1 == 2", "assert False", "1 / 0", "raise SystemExit", "while True: pass")] == ["pass", "wrong_answer", "failed", "failed", "timeout"]


def said(text):
    return [{"role": "user", "content": "q"}, {"role": "assistant", "content": text}]


ADD_ROW = {"input_output": json.dumps({"inputs": ADD["inputs"], "outputs": ADD["outputs"], "fn_name": "add"})}
SUM_TEXT = "Sum\nExample\nInput\n1 2\nOutput\n3\n"
SUMS = "a, b = map(int, input().split())\nprint(a + b)"


def test_cascade():
    v = judge.verdict
    good = said(fence("def add(a, b):\n    return a + b"))
    assert v(ADD_ROW, good)[:4] == ("code_livecodebench_generation", "livecodebench_v6", True, "pass")
    assert v(ADD_ROW | {"test_list": ["assert add(1, 2) == 3"]}, good)[:4] == ("code_mbpp", None, True, "pass")
    assert v({"prompt": "def f():\n", "test": "def check(c):\n    assert c() == 1", "entry_point": "f"}, said("    return 1"))[:4] == ("code_humaneval", None, False, "failed")
    assert v({"prompt": "def f():\n", "test": "def check(c):\n    assert c() == 1", "entry_point": "f"}, said(fence("def f():\n    return 1")))[0] == "code_humaneval"
    row = {"input": SUM_TEXT, "solution": SUMS}
    r = v(row, said(fence(SUMS)))
    assert r[:4] == ("code_prompt_examples", "prompt_examples_v1", True, "pass") and r[4]["example_count"] == 1 and r[4]["oracle_status"] == "pass"
    assert v(row, said(fence(SUMS.replace("+", "-"))))[2:4] == (False, "wrong_answer")
    r = v({"input": SUM_TEXT.replace("3", "999"), "solution": SUMS}, said(fence(SUMS)))
    assert r[2:4] == (None, "not_applicable") and r[4]["oracle_status"] == "wrong_answer"
    assert v({"dataset": "code_contests", "input": "Write a program", "solution": "print(1)"}, said("x"))[:4] == ("code_unverified", "code_safeguard_v1", None, "not_applicable")
    r = v({"answer": "1/2"}, said(r"It is \boxed{\frac12}"), "answer")
    assert r[:4] == ("math", "math_rule", True, "pass") and r[4]["verify_fallback_reason"] == "math_verify_unavailable" and r[4]["label_field"] == "answer"
    assert v({}, said("x")) == (None, None, None, "not_applicable", None)
    assert judge.guarded(ADD_ROW, good) == v(ADD_ROW, good)


def test_broken_private_tests_are_no_failure_of_the_judge():
    """Text that is neither JSON nor packed JSON means no tests, not an error."""
    assert judge.guarded({"private_test_cases": "!!", "answer": "4"}, said("The answer is 4"))[:4] == ("code_unverified", "code_safeguard_v1", None, "not_applicable")


def test_large_outputs_do_not_block():
    assert sandbox.run_tests({"inputs": ["1"], "outputs": ["x" * 3_000_000], "fn_name": None, "source": "s"}, "print('x' * 3000000)")["status"] == "pass"


def test_programs_share_an_interpreters_start_and_nothing_else(monkeypatch):
    import os
    import signal
    import subprocess
    import time

    started = []

    class Counted(subprocess.Popen):
        def __init__(self, *args, **more):
            started.append(args)
            super().__init__(*args, **more)

    monkeypatch.setattr(subprocess, "Popen", Counted)
    monkeypatch.setattr(sandbox, "_IDLE", {}, raising=False)
    leaves = "import json, builtins\njson.left = builtins.left = 1\nopen('left', 'w').write('x')"
    finds = "import json, builtins, os\nassert not hasattr(json, 'left') and not hasattr(builtins, 'left') and os.listdir('.') == []"
    assert [sandbox.run_program(p) for p in (leaves, finds) * 10] == ["pass"] * 20
    assert len(started) == 1
    draws = {sandbox.run_tests({"inputs": ["", ""], "outputs": ["", ""], "fn_name": None, "source": "s"}, "print(random.random())")["detail"]["output"] for _ in range(3)}
    assert len(draws) == 3  # each has a random state of its own

    # One that ended while it was idle, or with a job, is replaced.
    (idle,) = sandbox._IDLE[os.getpid()]
    idle.process.kill()
    idle.process.wait()
    assert sandbox.run_program("assert True") == "pass" and len(started) == 2
    assert sandbox.run_program("import os, signal\nsignal.pidfd_send_signal(os.pidfd_open(os.getppid()), 9)") == "failed"
    assert sandbox.run_program("assert True") == "pass" and len(started) == 3

    # What is broken off from outside leaves no child.
    def ring(*_):
        raise KeyboardInterrupt

    def runners():
        lines = subprocess.run(["ps", "-eo", "args"], capture_output=True, text=True).stdout.splitlines()
        return sum(a.split()[1:] == ["-I", "-B", sandbox._RUNNER] for a in lines)

    before = signal.signal(signal.SIGALRM, ring)
    signal.setitimer(signal.ITIMER_REAL, 1.0)
    (idle,), before_it = sandbox._IDLE[os.getpid()], runners()
    try:
        sandbox.run_program("while True: pass", 10)
    except KeyboardInterrupt:
        pass
    finally:
        signal.signal(signal.SIGALRM, before)
    assert idle.process.poll() == 0 and sandbox._IDLE[os.getpid()] == []
    time.sleep(0.2)
    assert runners() == before_it - 1
