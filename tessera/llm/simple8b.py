"""Token ids in files of word-aligned Simple-8b codes.

Format of a shard file (all binary numbers little-endian):
  head, _HEAD_BYTES of ASCII, filled up with spaces: "TS8B 2", then documents, ids, block size, blocks, words,
    the shard's partition, its number there and the ids of the partition before it
  doc_ids i64[documents], null flags u8[documents], document lengths u32[documents]
  first word of each block u32[blocks], words u64[words], crc32 of all before u32, one line feed
A word's top four bits select how many values it holds and how wide they are; selector 15 is the
escape: the next word is one raw 64-bit value. Blocks of ``block size`` ids start on a word of their
own, so they decode apart from one another and are encoded side by side with numpy.

A dataset is a folder of such files. Spark's committed text writer puts them there, one shard a file: its value
is the shard's bytes, which it writes as they are, and the line feed is its own. So shards land on any file system
Spark knows, and a lost executor leaves no half-written one. They are read back as binary files; the head is
text so that native expressions read what the prefix sums need. Documents stand in ascending doc_id order, nulls
first, ties ordered by the text's hash. Texts are encoded whole, however long.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import id_and_text, partition_bases, scratch_root, table
from tessera.llm.token_ids import default_tokenizer, encoder

#: Values in a word and bits of each, by selector; fixed by the format.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = 15
_MAGIC, _HEAD_BYTES = b"TS8B 2 ", 128


def encode_blocks(values: np.ndarray, block_size: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block) of unsigned 64-bit values."""
    values = np.ascontiguousarray(values, np.uint64)
    n, n_blocks = len(values), -(-len(values) // block_size)
    # Bits of each value; 64 past a block's end, so that no selector but a fitting one can reach over it.
    pad = int(COUNTS[0])
    wide = np.full((n_blocks, block_size + pad), 64, np.uint8)
    bits = np.ones(n_blocks * block_size, np.uint8)
    small = values < (1 << 32)
    exact = np.zeros(n, np.uint8)
    exact[small] = np.frexp(values[small].astype(np.float64))[1]
    if not small.all():
        high = (values[~small] >> np.uint64(32)).astype(np.float64)
        exact[~small] = np.frexp(high)[1] + 32
    bits[:n] = np.maximum(exact, 1)
    wide[:, :block_size] = bits.reshape(n_blocks, block_size)
    flat = wide.ravel()
    if n_blocks:
        row_len = block_size + pad
        last = n - (n_blocks - 1) * block_size
        wide[-1, last:] = 64
    # Best selector from each position: the largest count whose values all fit. Window maxima by doubling.
    best = np.full(len(flat), ESCAPE, np.uint8)
    maxima, width = flat, 1
    by_width: dict[int, np.ndarray] = {1: flat}
    for count in sorted(COUNTS.tolist()):
        while width * 2 <= count:
            nxt = maxima.copy()
            np.maximum(maxima[:-width], maxima[width:], out=nxt[:-width])
            maxima, width = nxt, width * 2
            by_width[width] = maxima
        base = by_width[width]
        window = base
        if count > width:
            window = base.copy()
            shift = count - width
            np.maximum(base[:-shift], base[shift:], out=window[:-shift])
        selector = int(np.flatnonzero(COUNTS == count)[0])
        best[window <= BITS[selector]] = selector
    # One step a word, all blocks at once.
    positions = np.arange(n_blocks, dtype=np.int64) * (block_size + pad)
    ends = positions + block_size
    if n_blocks:
        ends[-1] = positions[-1] + last
    alive = np.arange(n_blocks)
    at = positions.copy()
    owner, where, picked = [], [], []
    step_of = np.concatenate([COUNTS, [0, 1]])
    while len(alive):
        s = best[at[alive]]
        owner.append(alive)
        where.append(at[alive].copy())
        picked.append(s)
        at[alive] += step_of[s]
        alive = alive[at[alive] < ends[alive]]
    if not owner:
        return np.empty(0, np.uint64), np.empty(0, np.uint32)
    owner, where, picked = np.concatenate(owner), np.concatenate(where), np.concatenate(picked)
    order = np.argsort(owner, kind="stable")
    owner, where, picked = owner[order], where[order], picked[order]
    size = np.where(picked == ESCAPE, 2, 1)
    ends_at = np.cumsum(size)
    words = np.zeros(int(ends_at[-1]), np.uint64)
    first_word = ends_at - size
    words[first_word] = picked.astype(np.uint64) << np.uint64(60)
    source = where - owner * pad  # without the padding: index into values
    for selector in range(len(COUNTS)):
        mine = np.flatnonzero(picked == selector)
        if len(mine):
            packed = np.zeros(len(mine), np.uint64)
            for k in range(int(COUNTS[selector])):
                packed |= values[source[mine] + k] << np.uint64(k * int(BITS[selector]))
            words[first_word[mine]] |= packed
    raw = np.flatnonzero(picked == ESCAPE)
    words[first_word[raw] + 1] = values[source[raw]]
    starts = np.searchsorted(owner, np.arange(n_blocks))
    return words, first_word[starts].astype(np.uint32)


def decode_blocks(words: np.ndarray, first_words: np.ndarray, n: int, block_size: int = 1024) -> np.ndarray:
    """The values; every selector is decoded for all its words at once."""
    words = np.ascontiguousarray(words, np.uint64)
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = np.concatenate([COUNTS, [0, 1]])[selectors]
    # A raw word follows its escape and is no selector; only escapes make this a walk.
    for e in np.flatnonzero(selectors == ESCAPE).tolist():
        if counts[e] == 1:
            counts[e + 1], selectors[e + 1] = 0, -1
    block = np.searchsorted(first_words.astype(np.int64), np.arange(len(words)), side="right") - 1
    before = np.cumsum(counts) - counts
    in_block = before - before[first_words.astype(np.int64)][block]
    target = block * block_size + in_block
    for selector in range(len(COUNTS)):
        mine = np.flatnonzero(selectors == selector)
        if len(mine):
            bits = int(BITS[selector])
            mask = np.uint64((1 << bits) - 1)
            for k in range(int(COUNTS[selector])):
                out[target[mine] + k] = (words[mine] >> np.uint64(k * bits)) & mask
    raw = np.flatnonzero((selectors == ESCAPE) & (counts == 1))
    out[target[raw]] = words[raw + 1]
    return out


def dump_shard(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, block_size: int = 1024, part: int = 0, shard: int = 0, before: int = 0) -> bytes:
    """The bytes of a shard file."""
    words, first = encode_blocks(ids, block_size)
    head = _MAGIC + b" ".join(b"%d" % n for n in (len(doc_ids), len(ids), block_size, len(first), len(words), part, shard, before))
    body = b"".join(
        (
            head.ljust(_HEAD_BYTES),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], "u1").tobytes(),
            np.asarray(lengths, "<u4").tobytes(),
            first.astype("<u4").tobytes(),
            words.astype("<u8").tobytes(),
        )
    )
    return body + zlib.crc32(body).to_bytes(4, "little") + b"\n"


def load_shard(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc_ids, lengths, ids) of a shard file; ValueError if it is damaged."""
    if len(payload) < _HEAD_BYTES + 5 or zlib.crc32(memoryview(payload)[:-5]) != int.from_bytes(payload[-5:-1], "little"):
        raise ValueError("damaged shard")
    if not payload.startswith(_MAGIC):
        raise ValueError("unknown shard format")
    n_docs, n_ids, block_size, n_blocks, n_words = map(int, payload[len(_MAGIC) : _HEAD_BYTES].split()[:5])
    at, parts = _HEAD_BYTES, []
    for kind, count in (("<i8", n_docs), ("u1", n_docs), ("<u4", n_docs), ("<u4", n_blocks), ("<u8", n_words)):
        parts.append(np.frombuffer(payload, kind, count, at))
        at += parts[-1].nbytes
    ids, nulls, lengths, first, words = parts
    return [None if z else i for i, z in zip(ids.tolist(), nulls.tolist(), strict=True)], lengths, decode_blocks(words, first, n_ids, block_size)


#: Chunks that a worker's encoder remembers here: more than by default, as this job runs alone and its time is short.
ENCODER_ENTRIES = 1_000_000
#: Ids after which a shard is closed; a longer document makes a shard of its own.
SHARD_IDS = 1 << 20


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, block_size: int = 1024) -> None:
    """Write the ids of docs (columns doc_id and text) as shards under path, in ascending doc_id order."""
    file = tokenizer or default_tokenizer()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, end, ids_of = TaskContext.get().partitionId(), end_id.to_bytes(4, "little"), encoder(file, ENCODER_ENTRIES).encode
        doc_ids: list[int | None] = []
        held: list[bytes] = []
        size = before = shard = 0

        def close() -> pa.RecordBatch:
            nonlocal size, before, shard
            lengths = np.array([len(x) // 4 for x in held], np.uint32)
            payload = dump_shard(doc_ids, lengths, np.frombuffer(b"".join(held), "<u4"), block_size, part, shard, before)
            before, shard, size = before + size, shard + 1, 0
            doc_ids.clear()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([payload[:-1]], pa.binary())], names=["payload"])  # the writer ends it

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                for doc_id, ids in zip(some.column(0).to_pylist(), ids_of(some.column(1).to_pylist()), strict=True):
                    doc_ids.append(doc_id)
                    held.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= SHARD_IDS:
                        yield close()
        if held:
            yield close()

    rows = id_and_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(shards, "payload binary").select(F.col("payload").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the shards under path, and with
    with_ids the ids themselves (array<int>); start counts the ids of all documents before it."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    head = F.split(F.substring("content", len(_MAGIC) + 1, _HEAD_BYTES - len(_MAGIC)).cast("string"), " ")
    shards = files.select(head[1].cast("long").alias("ids"), head[5].cast("int").alias("part"), head[7].cast("long").alias("before"), "content")
    bases = partition_bases(shards.groupBy("part").agg(F.sum("ids").alias("total")))
    kinds = [("doc_id", "long"), ("place", "long"), ("n_tokens", "long"), ("ids_crc32", "long"), *([("ids", "array<int>")] if with_ids else []), ("base", "long")]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, before, payload in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                doc_ids, lengths, ids = load_shard(payload)
                ends = np.cumsum(lengths.astype(np.int64))
                starts = ends - lengths
                ids = ids.astype("<u4")
                raw = ids.tobytes()
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                cols = [pa.array(doc_ids, pa.int64()), pa.array(starts + before), pa.array(lengths.astype(np.int64)), pa.array(crcs, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([starts[:1] * 0, ends]).astype(np.int32)), pa.array(ids.astype(np.int32))))
                cols.append(pa.array([base] * len(doc_ids), pa.int64()))
                yield pa.RecordBatch.from_arrays(cols, names=[k for k, _ in kinds])

    out = shards.join(F.broadcast(bases), "part").select("base", "before", "content").mapInArrow(decode, ", ".join(" ".join(k) for k in kinds))
    return out.select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, each ended by id 2, written in the file format and read back.

    Null and empty texts hold the end id alone; repeated and null doc_ids keep a row each; an empty
    table gives no rows; other columns are ignored.
    """
    import uuid

    path = f"{scratch_root(spark)}/tessera-ids-{uuid.uuid4().hex}"
    write_ids(table(spark, sf_dir, "documents"), path, default_tokenizer(), 2)
    return read_ids(spark, path)
