"""Packing by concatenate and cut.

Pass one encodes every document, adds the end id and writes the ids with each document's offset
inside its partition to the shared folder. The partitions' totals, summed up once more, give each
partition's base, so that base + offset is a document's place in one endless line of ids. Pass two
cuts that line every ``length`` ids; a document that crosses a cut gets one boundary record on each
side of it. Only the last sequence of all can be short, so padding is below one sequence.

Nulls, empty and very long texts: null and empty texts are the end id alone; a long text is cut over
as many sequences as it needs. Repeated rows and repeated or null doc_ids are packed row by row. An
empty table gives no pieces. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import id_and_text, partition_bases, table, written
from tessera.llm.token_ids import default_tokenizer, encoder

_TOKENS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("place", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)
_TOKENS_ARROW = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("place", pa.int64()), ("n", pa.int64()), ("ids", pa.large_binary())])
#: Documents encoded at a time in a Python worker.
_STEP = 1000


def tokens(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(part, doc_id, place, n, ids): each document's ids and end id as little-endian unsigned
    32-bit integers, and its place among the ids of its partition; one row a row of docs."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, place, end, ids_of = TaskContext.get().partitionId(), 0, end_id.to_bytes(4, "little"), encoder(tokenizer).encode
        for batch in batches:
            for at in range(0, batch.num_rows, _STEP):
                some = batch.slice(at, _STEP)
                ids = [x + end for x in ids_of(some.column(1).to_pylist())]
                n = [len(x) // 4 for x in ids]
                places = []
                for k in n:
                    places.append(place)
                    place += k
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(n), pa.int32()), some.column(0), pa.array(places, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                    names=_TOKENS_ARROW.names,
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(encode, _TOKENS)


def pack(docs: DataFrame, length: int = 1024, tokenizer: str | None = None, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of documents (columns doc_id and text) in sequences of at most ``length`` ids.

    Returns doc_id, start (ids of the document before the piece), length, doc_tokens (with the end
    id), sequence_id, offset (place in the sequence, without gaps from 0) and ids_crc32 or, with
    with_ids, also the piece's ids as little-endian unsigned 32-bit bytes.
    """
    each = written(tokens(id_and_text(docs), tokenizer or default_tokenizer(), end_id), "packing")
    bases = partition_bases(each.groupBy("part").agg(F.sum("n").alias("total")))
    placed = each.join(F.broadcast(bases), "part").withColumn("at", F.col("base") + F.col("place"))
    step = int(length)
    # Bounds of the piece in window w, in ids from the document's start.
    start, stop = f"greatest(w * {step}L - at, 0L)", f"least((w + 1) * {step}L - at, n)"
    cut = f"substring(ids, cast(4 * ({start}) as int) + 1, cast(4 * ({stop} - {start}) as int))"
    pieces = F.expr(
        f"""transform(sequence(at div {step}, (at + n - 1) div {step}), w -> struct(
            {start} as start, {stop} - {start} as length, crc32({cut}) as ids_crc32,
            w as sequence_id, at + {start} - w * {step}L as offset{f", {cut} as ids" if with_ids else ""}))"""
    )
    cols = ["doc_id", "piece.start", "piece.length", "piece.ids_crc32", F.col("n").alias("doc_tokens"), "piece.sequence_id", "piece.offset"]
    return placed.select("doc_id", "n", F.explode(pieces).alias("piece")).select(*cols, *(["piece.ids"] if with_ids else []))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 ids of the public 50k byte-level file, each document ended by id 0."""
    return pack(table(spark, sf_dir, "documents"), 1024, default_tokenizer(), 0)
