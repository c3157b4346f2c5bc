import public_tokenizers
import regex

from tessera.llm import token_counts as tc
from tests.llm.samples import documents, frame

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def plain(text, pieces):
    words = regex.findall(public_tokenizers.PATTERN, text or "")
    total, longest = 0, max(map(len, pieces))
    for w in words:
        raw = w.encode()
        best = [(0, 0)]
        for end in range(1, len(raw) + 1):
            best.append(min((best[a][0] + pieces[raw[a:end]], best[a][1] + 1) for a in range(max(0, end - longest), end) if raw[a:end] in pieces))
        total += best[-1][1]
    return len(words), total


def test_against_brute_force(spark):
    rows, pieces = documents(), tc.load_pieces(PATH)
    got = tc.count_tokens(frame(spark, rows)).collect()
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(map(tuple, got), key=key) == sorted([(r[0], *plain(r[1], pieces)) for r in rows], key=key)
    assert tc.count_tokens(frame(spark, rows).where("false")).collect() == []


def test_small_vocabulary_ties_and_shared_prefixes():
    pieces = {b"a": 5, b"b": 5, b"c": 5, b"ab": 10, b"abc": 15, b"bc": 9, b" ": 1}
    counter = tc.TrieCounter(pieces, r"\S+|\s+")
    assert counter.counts(["abc", "abcab", "ab a", "", None]) == [(1, 2), (1, 3), (3, 3), (0, 0), (0, 0)]


def test_full_memory_changes_nothing(monkeypatch):
    pieces = tc.load_pieces(PATH)
    texts = [r[1] for r in documents()]
    want = tc.TrieCounter(pieces, public_tokenizers.PATTERN).counts(texts)
    monkeypatch.setattr(tc, "MEMORY_ENTRIES", 3)
    counter = tc.TrieCounter(pieces, public_tokenizers.PATTERN)
    assert [counter.counts([t])[0] for t in texts] == want
