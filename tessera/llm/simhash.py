"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints: one bit for each of 64 positions, set if more than half of the hashes of a text's word
shingles set it. Candidates: the 64 bits are split into ``blocks`` parts; two fingerprints that differ
in at most ``distance`` bits agree on at least ``blocks - distance`` whole parts, so every choice of that
many parts is a key, and rows that share a key are compared. Within a key, a breadth-first walk over
the not yet reached fingerprints verifies the Hamming distance with numpy and emits one link for each
fingerprint reached, never all pairs: a dense group is taken in a few steps. Components come from
minimum labels with pointer jumping on written tables.

Similar texts: at a Jaccard similarity of 0.8 of their five-word shingles, fingerprints differ in about 15
percent of their bits, far more than blocks of 64 bits can bear. deduplicate() therefore works in two passes.
The first one links wide fingerprints, ``width`` words of 64 bits from as many mixes of each distinct shingle's
hash, that agree on two of six blocks of the first word, and each text to the nearest one in each of its bands
(below); most members of a dense group become one label. It only saves work: its links count only between texts that
share a band, which the second pass would link too, so neither the width of its keys nor the length of their runs
changes what is linked, and what it misses or drops is left to the second pass.

Blocks that find nearly all pairs at 0.8 would be too short to tell texts apart in a large corpus. The second
pass takes keys that do both: _BANDS keys of _BAND_ROWS min-hashes each of the shingles, of which a pair at a
similarity of 0.8 shares none once in 30,000 times, at 0.85 once in four millions. All pairs of a key's texts with
different labels are compared by size and by 128 bits of the wide fingerprints; no pair of the key is left out.
Bits only rule a pair out where it differs in more of them than four deviations beyond a similarity of 0.8, which at
0.8 happens once in 30,000 times, and are not asked for texts of fewer than _LEAST_SKETCHED shingles. The members of a
run that have such a partner then meet with their shingles, which settle all their pairs; no pairs are sent. Runs
beyond _GROUP texts are split into groups in which any two of them meet.

Exact copies have one fingerprint and meet before anything is compared. Nulls and texts without a
word have fingerprint 0 and link like any other. Very long texts are read whole, in time that grows with their
length. Repeated rows keep a row each. A component's id is the
smallest doc_id in it; a null doc_id keeps its row and takes its component's id (null if there is no
other). An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import drop_written, id_and_text, if_few, passing, table, written

#: Runs of one key up to this length are compared offset by offset, longer ones walked.
_SHORT_RUN = 8
#: Fingerprints whose distances a walk takes at a time.
_WALK = 256


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """The unsigned 64-bit SimHash of a text."""
    import xxhash

    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: lowers A-Z only, splits at space and 9-13
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        joined, ends, at = b" ".join(words), [], -1
        for n in map(len, words):
            at += n + 1
            ends.append(at)
        starts = [0, *[e + 1 for e in ends[:-1]]]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :])]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(bits), 255):  # sums of a byte each can't overflow
        counts += bits[at : at + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * counts > len(bits), bitorder="little").view("<u8")[0])


def _shingle_hashes(text: str | None, shingle: int, seed: int = 42) -> np.ndarray:
    """Hashes of a text's distinct shingles, ascending; of fewer words the whole sequence is one."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    joined, ends, at = b" ".join(words), [], -1
    for n in map(len, words):
        at += n + 1
        ends.append(at)
    starts, k = [0, *[e + 1 for e in ends[:-1]]], min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    return np.array(sorted({digest(joined[a:b], seed) for a, b in zip(starts, ends[k - 1 :])}), np.uint64)


def wide_fingerprint(text: str | None, shingle: int = 5, width: int = 8, seed: int = 42) -> list[int]:
    """width signed 64-bit words: the SimHash of a text's distinct shingles under as many hashes."""
    return _wide_of(_shingle_hashes(text, shingle, seed), width)


def _wide_of(hashes: np.ndarray, width: int) -> list[int]:
    if not len(hashes) or not width:
        return [0] * width
    counts = np.zeros((width, 64), np.int64)
    salts = (np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]
    for at in range(0, len(hashes), 255):
        x = hashes[None, at : at + 255] + salts  # the finaliser of a well-known 64-bit generator spreads each salt's sums
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        bits = np.unpackbits(x.astype("<u8").view(np.uint8).reshape(width, -1, 8), axis=2, bitorder="little")
        counts += bits.sum(axis=1, dtype=np.uint8)
    return np.packbits(2 * counts > len(hashes), axis=1, bitorder="little").view("<i8").ravel().tolist()


def with_fingerprint(docs: DataFrame, text_col: str, name: str, shingle: int = 4, seed: int = 42) -> DataFrame:
    """docs and its texts' fingerprints as signed 64-bit integers in column name."""
    from pyspark.sql import types as T

    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in batch.column(at).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps)], names=schema.fieldNames())

    return docs.mapInArrow(add, schema)


def block_masks(blocks: int, distance: int) -> list[int]:
    """For each choice of blocks - distance of the blocks: the mask of their bits, as a signed integer."""
    bounds = [64 * k // blocks for k in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(bounds, bounds[1:])]
    return [sum(c) - ((sum(c) >> 63) << 64) for c in combinations(parts, blocks - distance)]


def _walk(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (from, to) of a spanning forest over the distinct fingerprints of one key."""
    left, a, b = fps, [], []
    while len(left) > 1:
        root, left, front = left[0], left[1:], left[:1]
        while len(front) and len(left):
            some, front = front[:_WALK], front[_WALK:]
            near = np.zeros(len(left), bool)
            for f in some:
                near |= np.bitwise_count(left ^ f) <= distance
                if near.all():
                    break
            reached = left[near]
            if len(reached):
                a.append(np.full(len(reached), root, np.uint64))
                b.append(reached)
                front, left = np.concatenate([front, reached]), left[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (fps[:0], fps[:0])


def links(fingerprints: DataFrame, distance: int = 4, blocks: int = 6) -> DataFrame:
    """(a, b): links that connect all fingerprints (distinct, column fp) at most ``distance`` bits apart.

    Each link joins two members of one connected group; together they span every group.
    """
    masks = block_masks(blocks, distance)
    keyed = fingerprints.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(masks)])).alias("k"))
    keyed = keyed.select("k.choice", "k.key", "fp").repartition("choice", "key").sortWithinPartitions("choice", "key", "fp")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.empty(0, np.int64)] * 3  # the last key's rows so far

        def of(choice: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            fp = fp.view(np.uint64)
            same = (choice[1:] == choice[:-1]) & (key[1:] == key[:-1])
            starts = np.flatnonzero(np.concatenate([[True], ~same]))
            lengths = np.diff(np.append(starts, len(fp)))
            run = np.repeat(np.arange(len(starts)), lengths)
            a, b = [], []
            short = lengths[run] <= _SHORT_RUN
            for d in range(1, _SHORT_RUN):
                hit = np.flatnonzero((run[d:] == run[:-d]) & short[d:] & (np.bitwise_count(fp[d:] ^ fp[:-d]) <= distance)) if len(fp) > d else np.empty(0, np.int64)
                a.append(fp[hit])
                b.append(fp[hit + d])
            for k in np.flatnonzero(lengths > _SHORT_RUN).tolist():
                x, y = _walk(fp[starts[k] : starts[k] + lengths[k]], distance)
                a.append(x)
                b.append(y)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).view(np.int64)) for v in (a, b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [np.concatenate([h, c.to_numpy(zero_copy_only=False).astype(np.int64)]) for h, c in zip(held, batch.columns, strict=True)]
            last = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = [r[cut:] for r in rows]
            if cut:
                yield of(*(r[:cut] for r in rows))
        if len(held[0]):
            yield of(*held)

    return keyed.mapInArrow(verify, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of edges (a, b: long): label is the smallest node reachable.

    In each round every node takes the smallest of its neighbours and itself, then that one's choice, and
    the graph is contracted to the edges between different labels: a dense group is gone after a round, a
    chain shrinks by a factor. Each round is written to the shared folder, and a node with many edges meets
    them in partial aggregates only.
    """
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    each, labels = written(edges.select(*pair).where("a <> b").distinct(), "edges"), None
    while True:
        ends = each.select(F.explode(F.array("a", "b")).alias("node"), F.col("a").alias("label"))
        hooked = written(ends.groupBy("node").agg(F.min("label").alias("label")), "hooked")
        up = hooked.select(F.col("node").alias("label"), F.col("label").alias("up"))
        step = written(hooked.join(up, "label", "left").select("node", F.coalesce("up", "label").alias("label")), "step")
        old = [hooked, each]
        if labels is None:
            labels = step
        else:
            up = step.select(F.col("node").alias("label"), F.col("label").alias("up"))
            old += [step, labels]
            labels = written(labels.join(up, "label", "left").select("node", F.coalesce("up", "label").alias("label")), "labels")
        for end in ("a", "b"):
            each = each.join(step.select(F.col("node").alias(end), F.col("label").alias(f"l{end}")), end)
        each = written(each.select(F.col("la").alias("a"), F.col("lb").alias("b")).where("a <> b").select(*pair).distinct(), "edges")
        drop_written(*old)
        if each.isEmpty():
            drop_written(each)
            return labels


#: Rows that a key should have on average at most.
_ROWS_A_KEY = 4


def _blocks_for(prints: DataFrame, distance: int) -> int:
    """Blocks whose keys are long enough for the distinct fingerprints in prints (column fp): more blocks make
    longer keys and more of them, and find the same links."""
    n = prints.select("fp").distinct().count()
    blocks = distance + 2
    while 64 * (blocks - distance) // blocks < 40 and n > _ROWS_A_KEY << (64 * (blocks - distance) // blocks):
        blocks += 1
    return blocks


def classes(prints: DataFrame, distance: int = 4, blocks: int | None = None) -> DataFrame:
    """(fp, label) for the fingerprints (column fp, repeats allowed) that have a near neighbour: label
    is the smallest fingerprint of the group."""
    return components(written(links(prints.select("fp").distinct(), distance, blocks or _blocks_for(prints, distance)), "links")).select(F.col("node").alias("fp"), "label")


def near_duplicates(docs: DataFrame, distance: int = 4, blocks: int | None = None, shingle: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs (columns doc_id and text)."""
    rows = id_and_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keep: list[DataFrame] = []
    with passing(keep):
        prints = written(with_fingerprint(rows, "text", "fp", shingle, seed).select("doc_id", "fp"), "prints")
        each = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
        group = each.join(classes(prints, distance, blocks), "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
        group = written(group, "groups")
        keep += [prints, group]
    ids = group.groupBy("label").agg(F.min("least").alias("component_id"))
    by_print = group.join(ids, "label").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Blocks of a word of a wide fingerprint, two of which make a key, or three for more texts than _TEXTS_A_KEY times the
#: keys that two can be.
_WIDE_BLOCKS = [(64 * k // 6, 64 * (k + 1) // 6) for k in range(6)]
_TEXTS_A_KEY = 64
#: Differing bits of the two words compared within a key, of 128.
_SKETCH_BITS = 32
#: Runs of one key of a wide fingerprint up to this length are compared pair by pair, longer ones walked.
_SHORT_WIDE_RUN = 16


def _nearest_walk(x: np.ndarray, y: np.ndarray, label: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (from, to) of links that connect the 128-bit sketches (x, y) of one key, as far as their labels
    don't: what the front of the walk reaches is linked to the nearest one there, and brings all that share its
    label along."""
    left, a, b = np.arange(len(x)), [], []
    while len(left) > 1:
        mine = label[left] == label[left[0]]
        front, left = left[mine], left[~mine]
        while len(front) and len(left):
            some, front = front[:_WALK], front[_WALK:]
            least, by = np.full(len(left), 129, np.int64), np.zeros(len(left), np.int64)
            for f in some.tolist():
                bits = np.bitwise_count(x[left] ^ x[f]).astype(np.int64) + np.bitwise_count(y[left] ^ y[f])
                closer = bits < least
                least[closer], by[closer] = bits[closer], f
            near = least <= most
            if near.any():
                a.append(by[near])
                b.append(left[near])
                reached = np.isin(label[left], label[left[near]])
                front, left = np.concatenate([front, left[reached]]), left[~reached]
    none = np.empty(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def wide_links(prints: DataFrame, words: list[int], width: int, max_share: float) -> DataFrame:
    """(a, b, share): links between the nodes of prints (node, label: long, wide: array of 64-bit words) by keys
    of the given words, at most max_share of whose bits differ. Nodes of one label are taken to be linked already.
    The links that a key's run gives depend on the run's length and on the count of prints; where prints has the column
    bands, only those of nodes that share a band are returned, all of which band_runs() finds at any size."""

    picks = 2 if prints.count() <= _TEXTS_A_KEY << 22 else 3

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _wide_keys(batches, words, picks)

    keyed = prints.select("node", "label", "wide").mapInArrow(keys, "key long, node long, label long, x long, y long")
    keyed = keyed.repartition("key").sortWithinPartitions("key", "node")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 5

        def of(key: np.ndarray, node: np.ndarray, label: np.ndarray, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
            x, y = x.view(np.uint64), y.view(np.uint64)
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            lengths = np.diff(np.append(starts, len(key)))
            runs = np.repeat(np.arange(len(starts)), lengths)
            short = lengths[runs] <= _SHORT_WIDE_RUN
            a, b = [], []
            for d in range(1, min(_SHORT_WIDE_RUN, len(key))):  # few share most keys: each pair of them is compared
                i = np.flatnonzero((runs[d:] == runs[:-d]) & short[d:] & (label[d:] != label[:-d]))
                bits = np.bitwise_count(x[i] ^ x[i + d]).astype(np.int64) + np.bitwise_count(y[i] ^ y[i + d])
                good = i[bits <= _SKETCH_BITS]
                a.append(node[good])
                b.append(node[good + d])
            for k in np.flatnonzero(lengths > _SHORT_WIDE_RUN).tolist():
                run = slice(starts[k], starts[k] + lengths[k])
                i, j = _nearest_walk(x[run], y[run], label[run], _SKETCH_BITS)
                a.append(node[run][i])
                b.append(node[run][j])
            none = [np.empty(0, np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(none + v)) for v in (a, b)], names=["a", "b"])

        for batch in batches:
            if batch.num_rows:
                rows = [np.concatenate([h, c.to_numpy(zero_copy_only=False).astype(np.int64)]) for h, c in zip(held, batch.columns, strict=True)]
                last = np.flatnonzero(rows[0] != rows[0][-1])
                cut = int(last[-1]) + 1 if len(last) else 0
                held = [r[cut:] for r in rows]
                if cut:
                    yield of(*(r[:cut] for r in rows))
        if len(held[0]):
            yield of(*held)

    pairs = keyed.mapInArrow(walk, "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    banded = "bands" in prints.columns
    side = lambda n: prints.select(F.col("node").alias(n), F.col("wide").alias(f"w{n}"), *[F.col("bands").alias(f"k{n}")] * banded)
    differ = F.aggregate(F.zip_with("wa", "wb", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, v: t + v)
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(F.arrays_overlap("ka", "kb") if banded else F.lit(True))
    return both.select("a", "b", (differ / (64 * width)).alias("share")).where(F.col("share") <= max_share)


#: Up to this share of 512 differing bits texts are similar beyond doubt (0.8 would be six deviations off).
_SURE_SHARE = 0.05


def shingle_sets(texts: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, h): the distinct shingles' hashes, ascending, of the texts (node, text) whose nodes are wanted; written."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                some = batch.slice(at, 200)
                sets = [_shingle_hashes(t, shingle).view(np.int64) for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "h"])

    # Few texts are wanted as a rule; a broadcast of their nodes leaves the texts where they are.
    few = if_few(written(wanted, "wanted"))
    return written(texts.join(few, "node", "left_semi").select("node", "text").mapInArrow(shingles, "node long, h array<long>"), "shingles")


def similar(pairs: DataFrame, texts: DataFrame, least: float, shingle: int) -> DataFrame:
    """(a, b) of the pairs (a, b, share) whose texts (texts: node, text) have a Jaccard similarity of at least
    ``least`` by their distinct shingles; only pairs beyond _SURE_SHARE are looked at. Sets are read by Python once
    a text, and met row by row in the JVM, so no batch holds the sets of many long texts."""
    doubtful = pairs.where(F.col("share") > _SURE_SHARE).select("a", "b")
    sets = shingle_sets(texts, doubtful.select(F.explode(F.array("a", "b")).alias("node")).distinct(), shingle)
    side = lambda n: sets.select(F.col("node").alias(n), F.col("h").alias(f"h{n}"))
    both = F.size(F.array_intersect("ha", "hb"))
    checked = doubtful.join(side("a"), "a").join(side("b"), "b").where(both >= F.lit(least) * (F.size("ha") + F.size("hb") - both) - 1e-9)
    return pairs.where(F.col("share") <= _SURE_SHARE).select("a", "b").unionByName(checked.select("a", "b"))


#: Keys of a text in the second pass, and the min-hashes that make up each.
_BANDS, _BAND_ROWS = 26, 5
#: Differing bits of 128 beyond which a pair is ruled out, and the shingles from which bits are asked.
_LOOSE_BITS, _LEAST_SKETCHED = 36, 32


@lru_cache(maxsize=4)
def _mixers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(2024)
    return rng.integers(0, 2**63, (n, 1), dtype=np.uint64), rng.integers(0, 2**63, (n, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(hashes: np.ndarray, bands: int = _BANDS, rows: int = _BAND_ROWS) -> list[int]:
    """A signed 64-bit key for each band of min-hashes of a text's shingle hashes; none for a text without any."""
    if not len(hashes):
        return []
    add, odd = _mixers(bands * rows)
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        least = np.minimum(least, ((hashes[None, at : at + 2048] ^ add) * odd).min(axis=1))
    key = np.arange(bands, dtype=np.uint64)
    for k in range(rows):
        key = (key ^ least[k::rows]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64).tolist()


def _run_pairs(label: np.ndarray, size: np.ndarray, x: np.ndarray, y: np.ndarray, least: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(i, others, their differing bits): for the texts of one key, by place, those with a different label whose
    similarity can be ``least``. A pair comes once, from either side."""
    kinds, of, count = np.unique(label, return_inverse=True, return_counts=True)
    if len(kinds) < 2:
        return
    # By size, so that a text's partners are a slice; pairs within the largest label are left out from the start.
    order = np.argsort(size, kind="stable")
    of, size, x, y = of[order], size[order], x[order], y[order]
    most = int(np.argmax(count))
    large = np.flatnonzero(of == most)
    low = np.searchsorted(size, least * size - 1e-9)
    high = np.searchsorted(size, size / least + 1e-9, side="right")
    for i in np.flatnonzero(of != most).tolist():
        others = np.arange(low[i], i)  # smaller ones of any label, larger ones of the largest
        others = np.concatenate([others, large[np.searchsorted(large, i) : np.searchsorted(large, high[i])]])
        others = others[of[others] != of[i]]
        bits = np.bitwise_count(x[i] ^ x[others]).astype(np.int64) + np.bitwise_count(y[i] ^ y[others])
        good = (bits <= _LOOSE_BITS) | (np.minimum(size[i], size[others]) < _LEAST_SKETCHED)
        if good.any():
            yield int(order[i]), order[others[good]], bits[good]


#: Texts of a key that are compared in one group, and their shingles unless it is one text; a longer run is split, and
#: its parts meet two by two.
_GROUP, _GROUP_SHINGLES = 4096, 1 << 21
#: Holders of shingles that are counted at a time.
_HOLDERS = 1 << 20


def _parts(n: int, places: np.ndarray, size: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places): the places of a run of n, dealt over groups so that any two places share one. size: the
    shingles of each place."""
    of = places // _GROUP
    if size is not None and len(size):
        before = np.cumsum(size) - size
        of = np.unique(of * (int(before[-1]) // _GROUP_SHINGLES + 1) + before // _GROUP_SHINGLES, return_inverse=True)[1]
    blocks = int(of.max(initial=0)) + 1
    if blocks == 1:
        yield 0, places
        return
    for b in range(blocks):
        for c in range(b + 1, blocks):
            mine = places[(of == b) | (of == c)]
            if len(mine):
                yield b * blocks + c, mine


def band_runs(known: DataFrame, least: float, nearest: bool) -> DataFrame:
    """What shares a band, has different labels and can have a similarity of ``least``. With nearest: (a, b), at most
    one for each node and band, the nearest. Without: (key, part, node, label), the members of each key's run that have
    such a partner, every such pair in one of the key's parts at least. Neither grows with the square of a run.

    known: node, label: long, size: int (shingles), wide: array of 64-bit words, bands: array of keys.
    """
    words = F.size("wide")
    word = lambda k: F.element_at("wide", (F.lit(k) % words + 1).cast("int"))
    keyed = known.select("node", "label", "size", word(1).alias("x"), word(2).alias("y"), F.explode("bands").alias("key"))
    keyed = keyed.select("key", "node", "label", "size", "x", "y").repartition("key").sortWithinPartitions("key", "node")

    def run_rows(key: np.ndarray, node: np.ndarray, label: np.ndarray, size: np.ndarray, x: np.ndarray, y: np.ndarray) -> Iterator[list[np.ndarray]]:
        if nearest:
            for i, others, bits in _run_pairs(label, size, x, y, least):
                j = others[int(np.argmin(bits))]
                yield [np.array([min(node[i], node[j])]), np.array([max(node[i], node[j])])]
            return
        near = np.zeros(len(node), bool)
        for i, others, _ in _run_pairs(label, size, x, y, least):
            near[i] = near[others] = True
        places = np.flatnonzero(near)
        for part, mine in _parts(len(node), places, size[places]):
            if len(mine) > 1:
                yield [key[mine], np.full(len(mine), part), node[mine], label[mine]]

    names = ["a", "b"] if nearest else ["key", "part", "node", "label"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(key: np.ndarray, *rest: np.ndarray) -> Iterator[pa.RecordBatch]:
            columns = [key, *rest[:3], rest[3].view(np.uint64), rest[4].view(np.uint64)]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            ends, out = np.append(starts[1:], len(key)), []
            for k in np.flatnonzero(ends - starts > 1).tolist():
                out += run_rows(*(c[starts[k] : ends[k]] for c in columns))
                if len(out) > 10_000:
                    yield packed(out)
                    out = []
            yield packed(out)

        def packed(out: list[list[np.ndarray]]) -> pa.RecordBatch:
            none = [np.empty(0, np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(none + [o[k] for o in out]).astype(np.int64)) for k in range(len(names))], names=names)

        held = [np.empty(0, np.int64)] * 6
        for batch in batches:
            if batch.num_rows:
                rows = [np.concatenate([h, c.to_numpy(zero_copy_only=False).astype(np.int64)]) for h, c in zip(held, batch.columns, strict=True)]
                last = np.flatnonzero(rows[0] != rows[0][-1])
                cut = int(last[-1]) + 1 if len(last) else 0
                held = [r[cut:] for r in rows]
                if cut:
                    yield from of(*(r[:cut] for r in rows))
        if len(held[0]):
            yield from of(*held)

    found = keyed.mapInArrow(compare, ", ".join(f"{n} long" for n in names))
    return found.distinct() if nearest else found


def _group_links(label: np.ndarray, sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Places of links that connect the labels of a group's texts whose similarity is ``least`` or more: of all such
    pairs, those that join what no link before has joined."""
    size = np.array([len(h) for h in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    kinds, which = np.unique(flat, return_inverse=True)
    order = np.argsort(which, kind="stable")
    holders, bounds = owner[order], np.searchsorted(which[order], np.arange(len(kinds) + 1))
    starts, lengths = bounds[:-1], np.diff(bounds)
    of = np.split(which, np.cumsum(size)[:-1])
    tied = {int(v): int(v) for v in np.unique(label)}

    def root(v: int) -> int:
        while tied[v] != v:
            tied[v] = v = tied[tied[v]]
        return v

    values, count = np.unique(label, return_counts=True)
    largest, links_ = values[np.argmax(count)], []
    joined = label.copy()  # of each text, what its label has been joined to
    for i in np.flatnonzero(label != largest).tolist():
        if (joined == joined[i]).all():
            break
        n, first = lengths[of[i]], starts[of[i]]
        # The holders of each of the text's shingles, one after another, so many shingles at a time.
        both, cuts = np.zeros(len(sets), np.int64), np.cumsum(n) // _HOLDERS
        for k in np.split(np.arange(len(n)), np.flatnonzero(np.diff(cuts)) + 1):
            m = n[k]
            at = np.repeat(first[k] - np.concatenate([[0], np.cumsum(m)[:-1]]), m) + np.arange(int(m.sum()))
            both += np.bincount(holders[at], minlength=len(sets))
        near = (both >= least * (size[i] + size - both) - 1e-9) & (joined != joined[i]) & (both > 0)
        for j in np.flatnonzero(near).tolist():
            p, q = root(int(label[i])), root(int(label[j]))
            if p != q:
                tied[p] = q
                joined[(joined == joined[i]) | (joined == joined[j])] = q
                links_.append((i, j))
    return links_


def run_links(members: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(a, b): links between members (key, part, node, label) of one part whose sets (node, h) have a similarity of
    ``least`` or more; as many as connect the part's labels."""
    rows = members.join(sets, "node").select("key", "part", "node", "label", "h").repartition("key", "part").sortWithinPartitions("key", "part")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links_of(group: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
            node = np.array([g[0] for g in group], np.int64)
            found = _group_links(np.array([g[1] for g in group], np.int64), [g[2] for g in group], least) if len(group) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array(node[[p[k] for p in found]]) if found else pa.array([], pa.int64()) for k in range(2)], names=["a", "b"])

        group, at = [], None
        for batch in batches:
            h = batch.column(4)
            values, offsets = h.values.to_numpy(), h.offsets.to_numpy()
            for k, row in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)))):
                if row[:2] != at and group:
                    yield links_of(group)
                    group = []
                at = row[:2]
                group.append((row[2], row[3], values[offsets[k] : offsets[k + 1]].copy()))
        if group:
            yield links_of(group)

    return rows.mapInArrow(verify, "a long, b long").distinct()


def _wide_keys(batches: Iterator[pa.RecordBatch], of_words: list[int], picks: int) -> Iterator[pa.RecordBatch]:
    """For each node a row for each choice of ``picks`` blocks of its words, with the two words after the one they are of."""
    choices = list(combinations(range(len(_WIDE_BLOCKS)), picks))
    for batch in batches:
        if not batch.num_rows:
            continue
        node, label = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        wide = np.array(batch.column(2).to_pylist(), np.int64).view(np.uint64)
        for at in range(0, len(node), 2000):
            some, its, words = node[at : at + 2000], label[at : at + 2000], wide[at : at + 2000]
            width = words.shape[1]
            for k in of_words:
                blocks = [((words[:, k] >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)).astype(np.int64) for a, b in _WIDE_BLOCKS]
                keys = []
                for c, choice in enumerate(choices):
                    key = np.full(len(some), k * len(choices) + c, np.int64)
                    for block in choice:
                        key = (key << 11) | blocks[block]
                    keys.append(key)
                x, y = words[:, (k + 1) % width].view(np.int64), words[:, (k + 2) % width].view(np.int64)
                columns = [np.concatenate(keys), *(np.tile(v, len(keys)) for v in (some, its, x, y))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "node", "label", "x", "y"])


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4, blocks: int | None = None, shingle: int = 4, seed: int = 42, width: int = 8, max_share: float = 0.2, wide_shingle: int = 5, least: float = 0.8) -> DataFrame:
    """docs with one row of each group of near-duplicates: the one with the smallest id (nulls last),
    of repeated ids the first row written. Texts are linked by fingerprints at most ``distance`` bits apart
    and, for width > 0, by a similarity of ``least`` or more, found by wide fingerprints and bands."""
    row, prints = "__tessera_row", "__tessera_prints"
    full = _with_prints(docs, text_col, prints, shingle, wide_shingle, width, seed).withColumn(row, F.monotonically_increasing_id())
    keep: list[DataFrame] = []
    with passing(keep):
        full = written(full, "dedup")
        texts = full.select(F.col(row).alias("node"), F.col(text_col).alias("text"))
        small = full.select(F.col(row).alias("row"), F.col(id_col).alias("id"), F.col(f"{prints}.fp").alias("fp"), F.col(f"{prints}.wide").alias("wide"), F.col(f"{prints}.size").alias("size"), F.col(f"{prints}.bands").alias("bands"))
        order = F.struct(F.col("id").isNull().alias("null"), F.col("id").alias("id"), F.col("row").alias("row"))
        # A node for each distinct pair of fingerprints: exact copies meet here.
        nodes = written(small.groupBy("fp", "wide").agg(F.min("row").alias("node"), F.min(order).alias("first"), F.min_by("size", "row").alias("size"), F.min_by("bands", "row").alias("bands")), "nodes")
        of_print = nodes.groupBy("fp").agg(F.min("node").alias("of"))
        same = nodes.join(of_print, "fp").select(F.col("node").alias("a"), F.col("of").alias("b")).where("a <> b")
        close = links(nodes.select("fp").distinct(), distance, blocks or _blocks_for(nodes, distance))
        for side in ("a", "b"):
            close = close.join(of_print.select(F.col("fp").alias(side), F.col("of").alias(f"n{side}")), side)
        edges = same.unionByName(close.select(F.col("na").alias("a"), F.col("nb").alias("b")))
        if width:
            # Nodes of one wide fingerprint are one for the walk.
            of_wide = written(nodes.groupBy("wide").agg(F.min("node").alias("of"), F.min_by("size", "node").alias("size"), F.min_by("bands", "node").alias("bands")), "wide")
            twin = nodes.join(of_wide.select("wide", "of"), "wide").select(F.col("node").alias("a"), F.col("of").alias("b")).where("a <> b")
            each = of_wide.select(F.col("of").alias("node"), "size", "wide", "bands")
            edges = edges.unionByName(twin)
            alone = each.withColumn("label", F.col("node"))
            # Beside what the blocks find, each text's nearest partner in each band: groups are one label each by then.
            near = band_runs(alone, least, nearest=True).select("a", "b", F.lit(1.0).alias("share"))
            pairs = wide_links(alone, [0], width, max_share).unionByName(near).groupBy("a", "b").agg(F.min("share").alias("share"))
            edges = edges.unionByName(similar(written(pairs, "pairs"), texts, least, wide_shingle))
        labels = components(written(edges, "links"))
        if width:
            # The last round only has to link what those before have not.
            known = written(each.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "size", "wide", "bands"), "known")
            members = written(band_runs(known, least, nearest=False), "runs")
            more = run_links(members, shingle_sets(texts, members.select("node").distinct(), wide_shingle), least)
            tree = labels.select(F.col("node").alias("a"), F.col("label").alias("b")).where("a <> b")
            labels = components(written(tree.unionByName(more), "links"))
        group = nodes.join(labels, "node", "left").groupBy(F.coalesce("label", "node")).agg(F.min("first").alias("first"))
        # What goes is less than what stays, and its numbers alone are moved if they are few.
        gone = written(small.select("row").join(group.select("first.row"), "row", "left_anti").withColumnRenamed("row", row), "gone")
        keep += [full, gone]
    return full.join(if_few(gone), row, "left_anti").drop(row, prints)


def _with_prints(docs: DataFrame, text_col: str, name: str, shingle: int, wide_shingle: int, width: int, seed: int) -> DataFrame:
    """docs and a column of its texts' fingerprints, shingle counts and bands, in one pass over the texts."""
    from pyspark.sql import types as T

    at = docs.columns.index(text_col)
    long, longs = T.LongType(), T.ArrayType(T.LongType())
    kind = T.StructType([T.StructField("fp", long), T.StructField("size", T.IntegerType()), T.StructField("wide", longs), T.StructField("bands", longs)])
    schema = T.StructType([*docs.schema.fields, T.StructField(name, kind)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                some = batch.slice(k, 1000)
                texts = some.column(at).to_pylist()
                fps, sizes, wides, bands = [], [], [], []
                for t in texts:
                    fps.append(fingerprint(t, shingle, seed))
                    hashes = _shingle_hashes(t, wide_shingle, seed) if width else np.empty(0, np.uint64)
                    sizes.append(len(hashes))
                    wides.append(_wide_of(hashes, width))
                    bands.append(band_keys(hashes))
                columns = [pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(wides, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.StructArray.from_arrays(columns, names=["fp", "size", "wide", "bands"])], names=schema.fieldNames())

    return docs.mapInArrow(add, schema)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: fingerprint of 4-word shingles, linked at up to 4 differing bits."""
    return near_duplicates(table(spark, sf_dir, "documents"), 4)
