"""Token counts of whole texts under a unigram vocabulary, with the forward scores shared in a trie.

A text is split into pre-tokens by the vocabulary's pattern; a pre-token's tokens are the cheapest way
to cut its bytes into pieces of the vocabulary, and among equally cheap ways the one with fewer tokens.
A piece costs -log p with p by Zipf's law over the file's ranks, p(rank) ~ 1 / (rank + 1), in whole
micro-nats, so that sums are exact and ties are ties everywhere.

The forward score of a prefix (cheapest cost and its tokens) depends on the prefix alone. Distinct
pre-tokens go into a trie; each node's score is worked out once, from the nodes above it, for all the
pre-tokens that share it, and a pre-token's count is stored at its last node. A worker remembers the
terminal counts between batches; emptied when full, it changes no result.

Nulls and empty texts: no tokens. Very long texts are counted whole, in time that grows with their length.
Repeated rows keep a row each. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import id_and_text, table

#: Terminal counts remembered by a Python worker.
MEMORY_ENTRIES = 500_000


def load_pieces(path: str) -> dict[bytes, int]:
    """Costs of the pieces in a rank file (a base64 piece and its rank a line)."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    norm = math.log(sum(1 / (r + 1) for r in ranks.values()))
    return {piece: round(1e6 * (math.log(rank + 1) + norm)) for piece, rank in ranks.items()}


class TrieCounter:
    """Counts of tokens; pieces: cost of each piece, all single bytes among them."""

    def __init__(self, pieces: dict[bytes, int], pattern: str):
        import regex

        self._split = regex.compile(pattern).findall
        # The vocabulary's own trie: node -> byte -> node, and a node's cost if a piece ends there.
        self._children: list[dict[int, int]] = [{}]
        self._cost: list[int | None] = [None]
        for piece, cost in pieces.items():
            node = 0
            for byte in piece:
                node = self._children[node].setdefault(byte, len(self._children))
                if node == len(self._cost):
                    self._children.append({})
                    self._cost.append(None)
            self._cost[node] = cost
        self._counts: dict[str, int] = {}

    def _learn(self, new: Iterable[str]) -> None:
        """Count the tokens of new pre-tokens along the trie of their bytes.

        In sorted order a pre-token shares its longest known prefix with the one before it: the path to
        the last terminal is kept, cut back to the shared prefix, and only nodes below it are new.
        """
        children, costs, counts = self._children, self._cost, self._counts
        path = b""
        # For each node on the path: its forward score (cost, tokens) and the vocabulary nodes of the pieces
        # still open there, each with the score of the node where the piece began.
        scores = [(0, 0)]
        open_: list[list[tuple[int, tuple[int, int]]]] = [[(0, (0, 0))]]
        for raw, word in sorted((w.encode("utf-8", "surrogatepass"), w) for w in new):
            shared, most = 0, min(len(raw), len(path))
            while shared < most and raw[shared] == path[shared]:
                shared += 1
            del scores[shared + 1 :], open_[shared + 1 :]
            for byte in raw[shared:]:
                best, going = None, []
                for node, start in open_[-1]:
                    nxt = children[node].get(byte)
                    if nxt is not None:
                        cost = costs[nxt]
                        if cost is not None:
                            end = (start[0] + cost, start[1] + 1)
                            if best is None or end < best:
                                best = end
                        if children[nxt]:
                            going.append((nxt, start))
                going.append((0, best))
                scores.append(best)
                open_.append(going)
            path = raw
            counts[word] = scores[-1][1]

    def counts(self, texts: Iterable[str | None]) -> list[tuple[int, int]]:
        """(pre-tokens, tokens) of each text; the texts' new pre-tokens share one trie."""
        known = self._counts
        if len(known) > MEMORY_ENTRIES:
            known.clear()
        split = [self._split(text) if text else () for text in texts]
        self._learn(set().union(*split) - known.keys())
        return [(len(words), sum(map(known.__getitem__, words))) for words in split]


_COUNTERS: dict[tuple[str, str], TrieCounter] = {}


def _counter(path: str, pattern: str) -> TrieCounter:
    if (path, pattern) not in _COUNTERS:
        _COUNTERS[path, pattern] = TrieCounter(load_pieces(path), pattern)
    return _COUNTERS[path, pattern]


def count_tokens(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) for each row of docs (columns doc_id and text)."""
    import public_tokenizers

    file, split = path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(file, split)
        for batch in batches:
            pairs = []
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), 256):
                pairs += counter.counts(texts[at : at + 256])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1))], names=["doc_id", "n_pretokens", "n_tokens"])

    rows = id_and_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_pretokens long, n_tokens long")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents under the public 50k byte-level vocabulary."""
    return count_tokens(table(spark, sf_dir, "documents"))
