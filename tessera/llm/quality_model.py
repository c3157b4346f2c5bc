"""Quality classifier: a Bradley-Terry ranking of documents.

Labelled documents of class 1 are preferred to those of class 0. Scores are linear in a text's
features, w.x, and the chance that a beats b is the logistic function of w.(x_a - x_b); w minimises the mean
logistic loss over all preference pairs of all labelled documents outside the held-out fifth, with a small quadratic
penalty, by Newton steps. Pairs are never formed: the loss and its derivatives are sums of smooth functions of the
difference of two scores, which are read off at Chebyshev nodes (to some 1e-11), so a step is two passes over the
written features, in time in proportion to the documents, and the driver gets sums only. A document is accepted if its
score reaches the quantile of the training scores that parts the classes best there. score = sigmoid(slope * (w.x - cut) + logit(threshold)), so that the
public threshold stands at that quantile; it rises with w.x.

Features come from the whole text alone: counts of signs, capitals, repeats and lengths, then the words and
the three-byte sequences of the text, each hashed into _WORD_BUCKETS and _GRAM_BUCKETS parts and taken as roots of
their shares, so that what marks a class is learnt and not only listed. Nulls and empty texts have features and a
score; a very long text costs time in proportion. Rows of labels with a null id or a label other than 0 and 1
teach nothing; repeated label rows count once (the lower label wins), repeated documents of one id too. Without
both classes every score is 0.5. Repeated rows keep a row each; an empty table gives no rows; ties
have one score. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import id_and_text, if_few, passing, remainder, table, written

_SYMBOLS = b"#*$%&|<>"
N_COUNTS, _WORD_BUCKETS, _GRAM_BUCKETS = 12, 256, 256
N_FEATURES = N_COUNTS + _WORD_BUCKETS + _GRAM_BUCKETS
#: What shares are multiplied by: the penalty then prefers the few counts to the many shares where both tell classes apart.
_SHARE_SCALE = 0.3


def counts(raw: bytes, words: list[bytes]) -> list[float]:
    """Features counted on a text, each between about 0 and 1."""
    n = len(words)
    if not n:
        return [0.0] * (N_COUNTS - 1) + [1.0]
    size = sum(map(len, words))
    symbols = [raw.count(bytes((s,))) / size for s in _SYMBOLS]
    upper = (len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))) / size
    shouts = (raw.count(b"!") + raw.count(b"?")) / n
    same_next = sum(map(bytes.__eq__, words, words[1:])) / n
    variety = len(set(words)) / n
    lines = raw.count(b"\n") + 1
    return [
        max(symbols),
        min(1.0, sum(symbols)),
        sum(1 for s in symbols if s > 0.02) / 8,
        upper,
        min(1.0, shouts),
        same_next,
        1.0 - variety ** (1 / (1 + math.log10(n))),
        words.count(b"|") / n,
        min(1.0, abs(math.log(size / n) - 1.7)),
        min(1.0, lines / n),
        min(1.0, math.log10(n) / 5),
        0.0,  # no words
    ]


def features(text: str | None) -> np.ndarray:
    """Features of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    out = np.zeros(N_FEATURES)
    out[:N_COUNTS] = counts(raw, words)
    if words:
        kinds = Counter(words)
        at = np.fromiter(map(zlib.crc32, kinds), np.uint32, len(kinds)) % np.uint32(_WORD_BUCKETS)
        shares = np.bincount(at, np.fromiter(kinds.values(), np.float64, len(kinds)), _WORD_BUCKETS) / len(words)
        out[N_COUNTS : N_COUNTS + _WORD_BUCKETS] = _SHARE_SCALE * np.sqrt(shares)
        a = np.frombuffer(raw, np.uint8).astype(np.uint32)
        if len(a) > 2:
            grams = ((a[:-2] * np.uint32(65536) + a[1:-1] * np.uint32(256) + a[2:]) * np.uint32(2654435761)) >> np.uint32(24)
            out[N_COUNTS + _WORD_BUCKETS :] = _SHARE_SCALE * np.sqrt(np.bincount(grams, minlength=_GRAM_BUCKETS) / len(grams))
    return out


class Model(NamedTuple):
    weights: np.ndarray
    cut: float
    slope: float
    threshold: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        # Without the library's threads: a worker has one core.
        z = self.slope * (np.einsum("ij,j->i", x, self.weights) - self.cut) + math.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


#: Chebyshev nodes of a cell of scores, two wide, and what takes polynomials' values there to weights of the nodes.
_NODES = np.cos(np.pi * (np.arange(16) + 0.5) / 16)
_TO_NODES = np.linalg.inv(np.polynomial.chebyshev.chebvander(_NODES, 15))

#: By class and cell: sums over its documents.
Sums = dict[tuple[int, int], np.ndarray]


def _cells(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each score and its weights of the cell's nodes."""
    cell = np.floor((s + 1) / 2).astype(np.int64)
    return cell, np.polynomial.chebyshev.chebvander(s - 2 * cell, 15) @ _TO_NODES


def _linear(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Of a row the same number whatever rows are beside it."""
    return np.einsum("ij,j->i", x, w)


def _masses(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> Sums:
    """By class and cell: the weights of the nodes."""
    cell, at = _cells(_linear(x, w))
    return {(c, k): at[(y == c) & (cell == k)].sum(axis=0) for c, k in sorted(set(zip(y.tolist(), cell.tolist())))}


def _moments(x: np.ndarray, y: np.ndarray, w: np.ndarray, slopes: Sums) -> Sums:
    """By class and cell the features at the nodes; at (-1, 0) the gradient's sum, at (-2, 0) that of the squares in the
    Hessian. slopes: by class and cell, first and second derivatives at the nodes, over all of the other class."""
    cell, at = _cells(_linear(x, w))
    out, first, second = {}, np.zeros(len(y)), np.zeros(len(y))
    for c, k in sorted(set(zip(y.tolist(), cell.tolist()))):
        mine = (y == c) & (cell == k)
        out[c, k] = at[mine].T @ x[mine]
        first[mine], second[mine] = (at[mine] @ slopes[c, k].T).T
    out[-1, 0] = x.T @ np.where(y == 1, first, -first)
    out[-2, 0] = (x * second[:, None]).T @ x
    return out


def _all_pairs(masses: Callable[[np.ndarray], Sums], moments: Callable[[np.ndarray, Sums], Sums], width: int, penalty: float) -> np.ndarray:
    """The weights that minimise the loss over all pairs, from sums over all documents."""
    places = lambda sums, c: np.concatenate([2 * k + _NODES for _, k in sorted(q for q in sums if q[0] == c)])
    stacked = lambda sums, c: np.concatenate([sums[q] for q in sorted(sums) if q[0] == c])

    def loss(sums: Sums, w: np.ndarray) -> float:
        good, bad = stacked(sums, 1), stacked(sums, 0)
        return float(good @ np.logaddexp(0, places(sums, 0) - places(sums, 1)[:, None]) @ bad) / (good.sum() * bad.sum()) + penalty / 2 * w @ w

    w = np.zeros(width)
    sums = masses(w)
    now = loss(sums, w)
    for _ in range(60):
        good, bad = stacked(sums, 1), stacked(sums, 0)
        p = 1 / (1 + np.exp(places(sums, 1)[:, None] - places(sums, 0)))  # that the bad one wins
        curve, n = p * (1 - p), good.sum() * bad.sum()
        by_class = {1: np.stack([p @ bad, curve @ bad]), 0: np.stack([good @ p, good @ curve])}
        slopes = {q: by_class[c][:, at : at + 16] for c in (0, 1) for at, q in zip(range(0, 1 << 30, 16), sorted(q for q in sums if q[0] == c))}
        found = moments(w, slopes)
        cross = stacked(found, 1).T @ curve @ stacked(found, 0)
        step = np.linalg.solve((found[-2, 0] - cross - cross.T) / n + penalty * np.eye(width), found[-1, 0] / n - penalty * w)
        if np.abs(step).max() < 1e-6:
            w = w + step
            break
        t = 1.0
        while True:
            sums = masses(w + t * step)
            then = loss(sums, w + t * step)
            if then <= now + 1e-12 or t < 1e-6:
                break
            t /= 2
        w, now = w + t * step, then
    return np.round(w, 9)  # sums that were added in another order give the same weights


def _drawn_pairs(good: np.ndarray, bad: np.ndarray, pairs: int, penalty: float, seed: int) -> np.ndarray:
    """The weights that minimise the loss over so many drawn pairs."""
    rng = np.random.default_rng(seed)
    d = good[rng.integers(0, len(good), pairs)] - bad[rng.integers(0, len(bad), pairs)]
    w = np.zeros(d.shape[1])
    loss = lambda w: np.logaddexp(0, -d @ w).mean() + penalty / 2 * w @ w
    for _ in range(60):
        p = 1 / (1 + np.exp(d @ w))
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / pairs + penalty * np.eye(len(w)), d.T @ p / pairs - penalty * w)
        t = 1.0
        while t > 1e-6 and loss(w + t * step) > loss(w):
            t /= 2
        w = w + t * step
        if np.abs(t * step).max() < 1e-6:
            break
    return w


def fit(x: np.ndarray, y: np.ndarray, threshold: float = 0.3, pairs: int | None = None, penalty: float = 3e-3, seed: int = 0) -> Model:
    """The ranking learnt from feature rows x of labels y (0 and 1): from all pairs, or from so many drawn ones."""
    good, bad = x[y == 1], x[y == 0]
    if not len(good) or not len(bad):
        return Model(np.zeros(x.shape[1]), 0.0, 0.0, 0.5)  # accepts everything
    if pairs is None:
        w = _all_pairs(lambda w: _masses(x, y, w), lambda w, slopes: _moments(x, y, w, slopes), x.shape[1], penalty)
    else:
        w = _drawn_pairs(good, bad, pairs, penalty, seed)
    # The quantile of the training scores at which balanced accuracy is highest; between two scores, its middle.
    s = _linear(x, w)
    order = np.argsort(s, kind="stable")
    gain = np.cumsum(y[order] == 0) * len(good) - np.cumsum(y[order] == 1) * len(bad)
    k = int(np.argmax(np.where(np.append(np.diff(s[order]) > 0, True), gain, -(2**62))))
    after = s[order][min(k + 1, len(s) - 1)]
    return _model(w, (s[order][k] + after) / 2, s.std(), threshold)


def _model(w: np.ndarray, cut: float, deviation: float, threshold: float) -> Model:
    return Model(w, float(cut), float(f"{4 / max(deviation, 1e-9):.9g}"), threshold)


def examples(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """(y, x: the features' bytes) of all labelled documents outside the held-out fifth; written.

    docs: doc_id, text. Rows that repeat an id count once, those with the least features.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).alias("y")).where("y in (0, 1) and doc_id is not null")
    known = known.where(remainder(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.min("y").cast("int").alias("y"))
    rows = written(docs.join(if_few(known), "doc_id").select("doc_id", "y", "text").mapInArrow(_example_features, "doc_id long, y int, x binary"), "features")
    twice = written(rows.groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice")
    if twice.isEmpty():
        return rows.select("y", "x")
    few = if_few(twice)
    once = rows.join(few, "doc_id", "left_semi").groupBy("doc_id", "y").agg(F.min("x").alias("x")).select("y", "x")
    return written(rows.join(few, "doc_id", "left_anti").select("y", "x").unionByName(once), "examples")


def _example_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 200):
            some = batch.slice(k, 200)
            x = [features(t).tobytes() for t in some.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(x, pa.binary())], names=["doc_id", "y", "x"])


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature rows and labels, some thousands at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, 4000):
            some = batch.slice(k, 4000)
            yield np.frombuffer(b"".join(some.column(1).to_pylist()), np.float64).reshape(-1, N_FEATURES), some.column(0).to_numpy()


#: Tasks that send their sums to the driver, some megabytes each, at most.
_SUMS = 64


def _summed(rows: DataFrame, of: Callable[[np.ndarray, np.ndarray], Sums]) -> Sums:
    """Sums over all feature rows."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: Sums = {}
        for x, y in _matrices(batches):
            for q, v in of(x, y).items():
                mine[q] = mine[q] + v if q in mine else v
        keys = sorted(mine)
        yield pa.RecordBatch.from_arrays([pa.array([q[0] for q in keys], pa.int64()), pa.array([q[1] for q in keys], pa.int64()), pa.array([mine[q].tobytes() for q in keys], pa.binary()), pa.array([list(mine[q].shape) for q in keys], pa.list_(pa.int64()))], names=["c", "k", "v", "shape"])

    total: Sums = {}
    tasks = min(_SUMS, rows.sparkSession.sparkContext.defaultParallelism)
    for r in rows.coalesce(tasks).mapInArrow(each, "c long, k long, v binary, shape array<long>").collect():
        v = np.frombuffer(r.v, np.float64).reshape(r.shape)
        total[r.c, r.k] = total[r.c, r.k] + v if (r.c, r.k) in total else v
    return total


def fit_all(rows: DataFrame, threshold: float = 0.3, penalty: float = 3e-3) -> Model:
    """fit() of all pairs, where the feature rows (y, x) are a table: weights, cut and deviation of all of them."""
    n = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    if len(n) < 2:
        return Model(np.zeros(N_FEATURES), 0.0, 0.0, 0.5)
    w = _all_pairs(lambda w: _summed(rows, lambda x, y: _masses(x, y, w)), lambda w, slopes: _summed(rows, lambda x, y: _moments(x, y, w, slopes)), N_FEATURES, penalty)

    def linear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y in _matrices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(_linear(x, w)), pa.array(y.astype(np.int32))], names=["s", "y"])

    scores = written(rows.mapInArrow(linear, "s double, y int"), "scores")
    deviation = scores.agg(F.stddev_pop("s")).first()[0]
    # Gains within a range of scores, the ranges' totals before it being the same for all of them.
    gain = F.when(F.col("y") == 0, F.lit(n[1])).otherwise(F.lit(-n[0])).cast("long")
    kinds = scores.groupBy("s").agg(F.sum(gain).alias("gain")).repartitionByRange("s").withColumn("part", F.spark_partition_id())
    kinds = kinds.withColumn("sum", F.sum("gain").over(Window.partitionBy("part").orderBy("s")))
    ranges = kinds.groupBy("part").agg(F.min("s").alias("least"), F.sum("gain").alias("all"), F.max(F.struct(F.col("sum"), (-F.col("s")).alias("s"))).alias("best")).orderBy("least").collect()
    before, best = 0, None
    for r in ranges:
        if best is None or before + r.best["sum"] > best[0]:
            best = before + r.best["sum"], -r.best["s"]
        before += r["all"]
    after = scores.where(F.col("s") > best[1]).agg(F.min("s")).first()[0]
    return _model(w, (best[1] + (best[1] if after is None else after)) / 2, deviation, threshold)


def _scores(model: Model, texts: pa.Array) -> np.ndarray:
    """Scores of texts, some hundreds of them at a time as Python objects and feature rows."""
    out = [model.scores(np.array([features(t) for t in texts.slice(k, 200).to_pylist()])) for k in range(0, len(texts), 200)]
    return np.concatenate(out) if out else np.empty(0)


def train(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> Model:
    rows = id_and_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with passing([]):
        return fit_all(examples(rows, labels), threshold)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs (columns doc_id and text)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _scores(model, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= model.threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    rows = id_and_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(each, "doc_id long, score double, predicted int")
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


def accept(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs that reach the model's threshold; the same columns."""
    at = docs.columns.index(text_col)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = _scores(model, batch.column(at)) >= model.threshold
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(each, T.StructType(docs.schema.fields))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by a ranking learnt from the labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels"), 0.3))
