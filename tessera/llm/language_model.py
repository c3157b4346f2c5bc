"""Log-probabilities of whole texts by a weighted backoff automaton over words.

Model: a word trigram, each order smoothed towards the one below (Dirichlet), the lowest discounted absolutely:
  P3(w | u v) = (c(u v w) + K3 P2(w | v)) / (c(u v) + K3),   P2(w | v) = (c(v w) + K2 P1(w)) / (c(v) + K2),
  P1(w) = (c(w) - D) / N,   P1(unknown) = D V / N
over N training tokens of V kinds, D = n1 / (n1 + 2 n2) from the kinds seen once and twice. As an automaton
each known history of two, one or no words is a state. A state has an arc for every word seen after its history,
with the probability as its weight, to the state of the longest known history that ends in that word; its failure
arc leads to the state of the history without its first word, with weight K / (c(history) + K). The end of a text
is a token, and the state after it, of the end alone, is where a text starts. A text is read once, left to right:
where the state has no arc for the next word, failure arcs are followed until one has; weights are added up.

No count leaves out a document, and no table of all n-grams meets one task. Texts become chunks of about
CHUNK_TOKENS tokens with numbers for their words; each chunk asks for the corpus counts of its distinct words and
pairs, then of its triples. A pair that no other chunk has asked for is in no other chunk, so neither are the
triples that hold it: their counts are known, and only other triples are asked for. Counts are summed up in
buckets by the n-grams' hashes (a chunk names an n-gram once, so a frequent one is no hot key), the sums go back to
the chunks that asked, and a chunk is scored with the part of the automaton that its own texts can reach. Buckets
hold about BUCKET_BYTES and shuffles have as many partitions as that takes, so tasks stay as large whatever the
input. What a chunk asks of a bucket is one row, and there is none if it asks nothing, so rows never outnumber the
chunks' n-grams. N-grams of a bucket are told apart by _HASH_BITS bits of a hash, sent as differences in order.

Null and empty texts are the end token alone. A text longer than a chunk is not cut: it ends the chunk that it
joins, which is larger by that much. Repeated rows and repeated ids count and score row by row; a null id counts as
the empty text in the choice of training rows. Without training rows every probability is 1. An empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import drop_written, id_and_text, remainder, table, written

#: Tokens after which a chunk is closed.
CHUNK_TOKENS = 1_000_000
#: Bytes of requests that a bucket should hold, and of a token's requests, on average.
BUCKET_BYTES, _TOKEN_BYTES = 16 << 20, 6
#: Bits of an n-gram's hash that are sent: the low ones, as the high ones choose the bucket. One n-gram in some 400,000
#: shares them with another one of its bucket.
_HASH_BITS = 40
#: The end token among words, which hold no line feed.
_END = b"\n"
_CHUNKS = "chunk long, n_tokens long, docs binary, ids binary, words binary"
_ASKED = "bucket int, chunk long, words binary, words_n binary, pairs binary, pairs_n binary"
_COUNTED = "chunk long, docs binary, ids binary, words binary, ones binary, twos binary, asked array<struct<bucket int, triples binary, triples_n binary>>"


def _arrow(values: list, kinds: str) -> pa.RecordBatch:
    """One row of the given columns."""
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [k.split() for k in kinds.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], types[t]) for v, (_, t) in zip(values, fields, strict=True)], names=[f for f, _ in fields])


class _Numbers(dict):
    """Numbers of words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _shortened(words: np.ndarray) -> bytes:
    """The low six bytes of words' hashes: enough to tell words apart, and what most of a chunk's size depends on."""
    return words.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _lengthened(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _squeezed(ids: np.ndarray) -> bytes:
    """Word numbers, their bytes of one weight side by side, compressed: most have two bytes that matter or fewer."""
    return pa.compress(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _unsqueezed(raw: bytes, n: int) -> np.ndarray:
    data = pa.decompress(raw, decompressed_size=4 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, n).T).view("<u4").ravel().astype(np.int64)


def chunks(rows: DataFrame) -> DataFrame:
    """Chunks of rows (doc_id, trains, text): docs packs (doc_id, its null flag, trains, tokens), ids has the
    word numbers of one text after another, each ended by 0, and words the hash of each number's word."""
    limit = CHUNK_TOKENS

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        numbers, docs, ids, size = _Numbers({_END: 0}), [], [], 0
        digest = xxhash.xxh64_intdigest

        def close() -> pa.RecordBatch:
            nonlocal numbers, docs, ids, size, chunk
            packed = np.array(docs, np.int64).reshape(-1, 4).tobytes()
            words = np.fromiter((digest(w) for w in numbers), np.uint64, len(numbers))
            out = _arrow([chunk, size, packed, _squeezed(np.concatenate(ids)), _shortened(words)], _CHUNKS)
            numbers, docs, ids, size, chunk = _Numbers({_END: 0}), [], [], 0, chunk + 1
            return out

        for batch in batches:
            for doc_id, trains, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                # Of bytes, lower() takes A-Z only and split() parts at space and 9 to 13.
                words = text.lower().split() if text else []
                words.append(_END)
                ids.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                docs.append((doc_id or 0, doc_id is None, trains, len(words)))
                size += len(words)
                if size >= limit:
                    yield close()
        if docs:
            yield close()

    return rows.mapInArrow(read, _CHUNKS)


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hashes of n-grams from those of their beginnings and last words."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + ((second << np.uint64(31)) | (second >> np.uint64(33)))
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Chunk:
    """A chunk's texts and its distinct words, pairs and triples. A pair's code is (number of its first word) * V + number
    of its second, a triple's (place of its first two words among the pairs) * V + number of its last."""

    def __init__(self, docs: bytes, ids: bytes, words: bytes):
        d = np.frombuffer(docs, np.int64).reshape(-1, 4)
        self.doc_ids, self.null, self.trains, self.lengths = d[:, 0], d[:, 1].astype(bool), d[:, 2].astype(bool), d[:, 3]
        self.ids = _unsqueezed(ids, int(self.lengths.sum()))
        self.words = _lengthened(words)
        self.starts = np.cumsum(self.lengths) - self.lengths
        v, self.in_training = len(self.words), np.repeat(self.trains, self.lengths)
        before = np.concatenate([[0], self.ids[:-1]])  # each text starts in the state that the end token leads to
        #: The distinct pairs, and for each token that of the word before it and itself.
        self.pairs, self.pair = np.unique(before * v + self.ids, return_inverse=True)
        self.ones, self.twos = self._count(self.ids, v), self._count(self.pair, len(self.pairs))

    def _count(self, which: np.ndarray, n: int, of: slice | np.ndarray = slice(None)) -> np.ndarray:
        return np.bincount(which[self.in_training[of]], minlength=n)

    def with_triples(self) -> Chunk:
        v = len(self.words)
        later = np.ones(len(self.ids), bool)
        later[self.starts] = False  # a text's first word has one word before it, the end
        #: The tokens that end a triple, the distinct triples, and for each such token its triple.
        self.third = np.flatnonzero(later)
        self.triples, self.triple = np.unique(self.pair[self.third - 1] * v + self.ids[self.third], return_inverse=True)
        # The pairs that a triple begins and ends with.
        self.begin = self.triples // v
        self.inner = np.empty(len(self.triples), np.int64)
        self.inner[self.triple] = self.pair[self.third]
        self.threes = self._count(self.triple, len(self.triples), self.third)
        return self

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Of the words and the pairs."""
        v = len(self.words)
        return _mixed(self.words, self.words), _mixed(self.words[self.pairs // v], self.words[self.pairs % v] + np.uint64(1))

    def elsewhere(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of the triples that can occur in other chunks: both of their pairs do."""
        at = np.flatnonzero(shared[self.begin] & shared[self.inner])
        last = self.words[self.triples[at] % len(self.words)] ^ np.uint64(0x94D049BB133111EB)
        return at, _mixed(self.hashes()[1][self.begin[at]], last)


def _by_bucket(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds): the hashes of bucket b are hashes[order[bounds[b]:bounds[b + 1]]], by what is sent of them."""
    of = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.argsort((of << np.uint64(_HASH_BITS)) | (hashes & np.uint64((1 << _HASH_BITS) - 1)))
    return order, np.searchsorted(of[order], np.arange(buckets + 1, dtype=np.uint64))


def _packed(hashes: np.ndarray) -> bytes:
    """What is sent of hashes in order: the differences, in as many bytes each as the largest needs."""
    low = hashes & np.uint64((1 << _HASH_BITS) - 1)
    return _narrow(np.diff(low, prepend=np.uint64(0)))


def _unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(_wide(raw))


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in as many bytes each as the largest needs: 1, 2, 4 or 8, named by the first byte."""
    kind = next(k for k in ("u1", "<u2", "<u4", "<u8") if not len(counts) or counts.max() <= np.iinfo(k).max)
    return bytes((np.dtype(kind).itemsize,)) + counts.astype(kind).tobytes()


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def _told(counts: np.ndarray) -> bytes:
    """Counts, compressed: most are alike."""
    raw = _narrow(counts)
    return len(raw).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _heard(raw: bytes) -> np.ndarray:
    return _wide(pa.decompress(raw[4:], decompressed_size=int.from_bytes(raw[:4], "little"), codec="zstd", asbytes=True))


def ask(each: DataFrame, buckets: int) -> DataFrame:
    """What each chunk asks of each bucket: its words and pairs there, and how often its training texts hold them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, docs, ids, words in zip(*(batch.column(c).to_pylist() for c in ("chunk", "docs", "ids", "words")), strict=True):
                c = Chunk(docs, ids, words)
                kinds = [(h, n, *_by_bucket(h, buckets)) for h, n in zip(c.hashes(), (c.ones, c.twos), strict=True)]
                for b in np.flatnonzero(sum(np.diff(bounds) for _, _, _, bounds in kinds)).tolist():
                    row = [b, number]
                    for h, n, order, bounds in kinds:
                        mine = order[bounds[b] : bounds[b + 1]]
                        row += [_packed(h[mine]), _told(n[mine])]
                    yield _arrow(row, _ASKED)

    return each.mapInArrow(rows, _ASKED)


def totals(asked: DataFrame, kinds: tuple[str, ...], buckets: int) -> DataFrame:
    """For each row of asked (bucket, chunk, and for each kind its hashes and counts) the corpus counts of what it names,
    in its order, each doubled and one added if another chunk names it too; and in one row of each bucket the bucket's
    figures of its first kind: tokens, kinds, and those seen once and twice."""
    schema = "chunk long, bucket int, " + ", ".join(f"{k} binary" for k in kinds) + ", n long, v long, once long, twice long"

    def add(group: pa.Table) -> pa.Table:
        rows = group.to_pydict()
        back, stats = [], None
        for kind in kinds:
            keys = [_unpacked(k) for k in rows[kind]]
            counts = np.concatenate([_heard(c) for c in rows[f"{kind}_n"]])
            found, which = np.unique(np.concatenate(keys), return_inverse=True)
            sums = np.bincount(which, counts, len(found)).astype(np.int64)
            stats = stats or [int(sums.sum()), int((sums > 0).sum()), int((sums == 1).sum()), int((sums == 2).sum())]
            answer = 2 * sums + (np.bincount(which) > 1)
            of_row = np.split(answer[which], np.cumsum([len(k) for k in keys])[:-1])
            back.append(pa.array([_told(x) for x in of_row], pa.binary()))
        n = len(rows["chunk"])
        once = [pa.array([v] + [0] * (n - 1), pa.int64()) for v in stats]
        return pa.Table.from_arrays([pa.array(rows["chunk"], pa.int64()), pa.array(rows["bucket"], pa.int32()), *back, *once], names=[k.split()[0] for k in schema.split(", ")])

    return asked.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(add, schema)


def _answered(hashes: np.ndarray, buckets: int, numbers: list[int], counts: list[bytes]) -> np.ndarray:
    """Corpus counts of n-grams from the answers of the buckets, as totals() gives them."""
    order, bounds = _by_bucket(hashes, buckets)
    out = np.zeros(len(hashes), np.int64)
    for b, raw in zip(numbers, counts, strict=True):
        out[order[bounds[b] : bounds[b + 1]]] = _heard(raw)
    return out


def counted(each: DataFrame, answers: DataFrame, buckets: int, parts: int) -> DataFrame:
    """Chunks with the corpus counts of their words and pairs, and what they ask of each bucket about triples."""

    def add(_key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        row, numbers = left.to_pylist()[0], right.column("bucket").to_pylist()
        c = Chunk(row["docs"], row["ids"], row["words"]).with_triples()
        ones, twos = (_answered(h, buckets, numbers, right.column(k).to_pylist()) for h, k in zip(c.hashes(), ("words", "pairs"), strict=True))
        at, hashes = c.elsewhere(twos & 1 > 0)
        order, bounds = _by_bucket(hashes, buckets)
        asked = []
        for b in np.flatnonzero(np.diff(bounds)).tolist():
            mine = order[bounds[b] : bounds[b + 1]]
            asked.append({"bucket": b, "triples": _packed(hashes[mine]), "triples_n": _told(c.threes[at[mine]])})
        kind = pa.list_(pa.struct([("bucket", pa.int32()), ("triples", pa.binary()), ("triples_n", pa.binary())]))
        columns = [pa.array([row["chunk"]], pa.int64()), *(pa.array([v], pa.binary()) for v in (row["docs"], row["ids"], row["words"], _told(ones), _told(twos))), pa.array([asked], kind)]
        return pa.Table.from_arrays(columns, names=["chunk", "docs", "ids", "words", "ones", "twos", "asked"])

    return _with_answers(each, answers.select("chunk", "bucket", "words", "pairs"), parts).applyInArrow(add, _COUNTED)


def _with_answers(each: DataFrame, answers: DataFrame, parts: int):
    return each.repartition(parts, "chunk").groupBy("chunk").cogroup(answers.repartition(parts, "chunk").groupBy("chunk"))


class Automaton:
    """The part of the model that a chunk's texts can reach.

    States: 0 has no history, 1 + w that of word w, 1 + V + k that of pair k. Word 0 is the end of a text.
    """

    def __init__(self, c: Chunk, counts: tuple[np.ndarray, np.ndarray, np.ndarray], model: dict, smoothing: tuple[float, float]):
        ones, twos, threes = counts
        n, v, d, size = model["n"], model["v"], model["discount"], len(ones)
        k2, k3 = smoothing
        p1 = np.where(ones > 0, (ones - d) / n, d * v / n) if n else np.ones(size)
        head, last = c.pairs // size, c.pairs % size
        p2 = (twos + k2 * p1[last]) / (ones[head] + k2)
        p3 = (threes + k3 * p2[c.inner]) / (twos[c.begin] + k3)
        self.size, self.start = size, 1 if ones[0] else 0
        # Failure arcs, by state; the state without history has none.
        self.failure = np.concatenate([[0], np.zeros(size, np.int64), np.where(ones[last] > 0, 1 + last, 0)])
        self.failure_weight = np.log10(np.concatenate([[1.0], k2 / (ones + k2), k3 / (twos + k3)]))
        # Arcs: of every word from the state without history, of seen pairs from words, of seen triples from pairs.
        self.arcs = [np.ones(size, bool), twos > 0, threes > 0]
        self.weight = [np.log10(p) for p in (p1, p2, p3)]
        # An arc leads to the longest known history, which the last two words decide; after a text's end that is the end alone.
        one = np.where(ones > 0, 1 + np.arange(size), 0)
        self.target = np.where(last == 0, one[0], np.where(twos > 0, 1 + size + np.arange(len(c.pairs)), one[last]))

    def read(self, c: Chunk) -> np.ndarray:
        """The summed weight of the path of each of the chunk's texts, read from left to right.

        The state that a token is read in is the target of the arc that the token before it took. Then failure arcs
        are followed from there, for all tokens that find none of their own, until each has one.
        """
        state = np.concatenate([[self.start], self.target[c.pair[:-1]]])
        state[c.starts] = self.start
        level = np.where(state > self.size, 2, np.minimum(state, 1))
        arc = [c.ids, c.pair, np.zeros(len(c.ids), np.int64)]  # the arc that a token would take at each level
        arc[2][c.third] = c.triple
        total = np.zeros(len(state))
        for at in (2, 1):
            here = np.flatnonzero(level == at)
            has = self.arcs[at][arc[at][here]]
            taken, failed = here[has], here[~has]
            total[taken] += self.weight[at][arc[at][taken]]
            level[taken] = -1
            total[failed] += self.failure_weight[state[failed]]
            state[failed] = self.failure[state[failed]]
            level[failed] = np.minimum(state[failed], 1)
        rest = np.flatnonzero(level == 0)
        total[rest] += self.weight[0][arc[0][rest]]
        return np.add.reduceat(total, c.starts)


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def log_probabilities(docs: DataFrame, held_out_remainder: int = 1, smoothing: tuple[float, float] = (500.0, 5.0)) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of docs (columns
    doc_id and text), learning from rows whose crc32(doc_id as text) mod 5 is not held_out_remainder. smoothing:
    K2 and K3, the default by the likelihood of held-out texts that occur once at sf0.1, of five pairs of values."""
    rows = id_and_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), (remainder(F.col("doc_id")) != held_out_remainder).alias("trains"), F.col("text").cast("string").cast("binary").alias("text"))
    each = written(chunks(rows), "chunks")
    tokens, n_chunks = each.agg(F.sum("n_tokens"), F.count(F.lit(1))).first()
    buckets = max(-(-(tokens or 0) * _TOKEN_BYTES // BUCKET_BYTES), 1)
    parts = max(1, -(-n_chunks // _CHUNKS_A_TASK))
    answers = written(totals(ask(each, buckets), ("words", "pairs"), buckets), "totals")
    n, v, once, twice = (x or 0 for x in answers.agg(*[F.sum(c) for c in ("n", "v", "once", "twice")]).first())
    model = {"n": n, "v": v, "discount": once / (once + 2 * twice) if once and twice else 0.5}
    packed = json.dumps(model)
    known = written(counted(each, answers, buckets, parts), "counted")
    drop_written(each, answers)
    triples = known.select("chunk", F.explode("asked").alias("a")).select("a.bucket", "chunk", "a.triples", "a.triples_n")
    answers = totals(triples, ("triples",), buckets).select("chunk", "bucket", "triples")

    def score(_key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        model = json.loads(packed)
        row = left.to_pylist()[0]
        c = Chunk(row["docs"], row["ids"], row["words"]).with_triples()
        ones, twos = _heard(row["ones"]), _heard(row["twos"])
        at, hashes = c.elsewhere(twos & 1 > 0)
        counts = (ones >> 1, twos >> 1, c.threes.copy())
        counts[2][at] = _answered(hashes, buckets, right.column("bucket").to_pylist(), right.column("triples").to_pylist()) >> 1
        path = Automaton(c, counts, model, smoothing).read(c)
        base = np.log10((counts[0] + 0.5) / (model["n"] + 0.5 * (model["v"] + 1)))
        known, base = (np.add.reduceat(x[c.ids], c.starts) for x in ((counts[0] > 0).astype(np.int64), base))
        cols = [
            pa.array(c.doc_ids, mask=c.null),
            pa.array(~c.trains),
            pa.array(c.lengths),
            pa.array(known),
            pa.array(np.full(len(c.lengths), model["n"], np.int64)),
            pa.array(base),
            pa.array(path, pa.float64()),
        ]
        return pa.Table.from_arrays(cols, names=[k.split()[0] for k in _SCORES.split(", ")])

    return _with_answers(known.drop("asked"), answers, parts).applyInArrow(score, _SCORES)


#: Chunks that a task scores.
_CHUNKS_A_TASK = 2


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, by the model of those outside the held-out fifth."""
    return log_probabilities(table(spark, sf_dir, "documents"), 1)
