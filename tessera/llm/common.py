"""What the operators share: the shared scratch folder, written intermediates, table access."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_SCRATCH: dict[str, str] = {}

#: White space of the word rule used by most operators: space and U+0009 to U+000D.
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the session's ``spark.checkpoint.dir``. Where that is unset, a single machine (a local master, as in
    tests) takes a temporary folder; on a cluster there is no such folder to share, and the call fails.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_SCRATCH:
        _OWN_SCRATCH[app] = tempfile.mkdtemp(prefix="tessera-")
    return _OWN_SCRATCH[app]


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and lost executors
    cost only a re-read of committed files."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/tessera-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_path = path
    for open_ in _PASSING:
        open_.append(back)
    return back


_PASSING: list[list[DataFrame]] = []


@contextmanager
def passing(keep: list[DataFrame]) -> Iterator[None]:
    """Intermediates written inside are deleted at the end, but for those that are in keep by then. What fails
    leaves its folders."""
    mine: list[DataFrame] = []
    _PASSING.append(mine)
    try:
        yield
    finally:
        _PASSING.remove(mine)
    kept = {df.written_path for df in keep}
    drop_written(*(df for df in mine if df.written_path not in kept))


def drop_written(*frames: DataFrame) -> None:
    """Delete the folders behind frames made by written(), once nothing reads them any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.written_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes up to which rows that were counted are broadcast.
BROADCAST_BYTES = 64 << 20


def if_few(df: DataFrame, row_bytes: int = 48) -> DataFrame:
    """df, to be broadcast if its rows, counted here, take up to BROADCAST_BYTES in memory; else as it is."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, so that other columns can have any name."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def remainder(id_column: Column, modulus: int = 5) -> Column:
    """crc32 of the id written as text, modulo modulus; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def partition_bases(totals: DataFrame) -> DataFrame:
    """Exclusive prefix sums of (part, total), one row for each partition of a written table.

    The row count is the number of tasks that wrote the table, not the number of documents,
    so the single window here and the broadcast of its result stay small at any input size.
    """
    from pyspark.sql import Window

    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(w), F.lit(0)).cast("long").alias("base"))
