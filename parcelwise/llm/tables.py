"""Input tables and the written, chunked copies that several operators share."""

from __future__ import annotations

import ctypes
import inspect
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.scale import fresh_path

CHUNK_BYTES = 16 * 1024**2
"""Text one Python task keeps together with a dictionary of its own."""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def stored(df: DataFrame, label: str) -> DataFrame:
    """A written copy of a frame with texts, compressed more tightly than the default."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_chunks(docs: DataFrame, label: str, text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A written copy of `docs` with a column `chunk` that names the file a row lies in.

    Files hold as many rows as come to about `chunk_bytes` of text on average. Nothing is shuffled,
    and every later pass, after any loss of executors, sees the same chunks."""
    total, rows = docs.agg(F.sum(F.octet_length(text)), F.count(F.lit(1))).first()
    per_file = max(1, min(10_000, int(chunk_bytes * rows / max(1, total or 0)))) if rows else 1
    path = fresh_path(docs.sparkSession, label)
    docs.write.option("maxRecordsPerFile", per_file).option("compression", "zstd").parquet(path)
    copy = docs.sparkSession.read.schema(docs.schema).parquet(path)
    return copy.select("*", F.xxhash64(F.col("_metadata.file_path")).alias("chunk"))


def packer() -> Callable[[bytes], bytes]:
    import zstandard

    return zstandard.ZstdCompressor(level=3, write_checksum=False).compress


def unpacker() -> Callable[[bytes], bytes]:
    import zstandard

    return zstandard.ZstdDecompressor().decompress


def compressed(text: Column) -> Column:
    """zstd frames of texts, for exchanges: Spark's own codec leaves prose nearly as long as it is. Null is empty."""

    @F.arrow_udf("binary")
    def shrink(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pack = packer()
        for texts in batches:
            yield pa.array([pack(t.as_py() or b"") for t in texts.cast(pa.binary())], pa.binary())
        give_back()

    return shrink(text)


def uncompressed(frame: Column) -> Column:
    """Texts of zstd frames."""

    @F.arrow_udf("string")
    def unpack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = unpacker()
        for frames in batches:
            yield pa.array([own(f.as_py()) for f in frames], pa.binary()).cast(pa.string())
        give_back()

    return unpack(frame)


def give_back() -> None:
    """Returns freed memory to the system. Python workers wait for further tasks beside the running ones, and all of
    an executor's workers count against its memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def freeing(fn: Callable) -> Callable:
    """`fn`, which makes a table of a group or batches of batches, giving memory back after each call."""

    def batches_of(batches):
        yield from fn(batches)
        give_back()

    def grouped(first, second):
        out = fn(first, second)
        give_back()
        return out

    def keyed(key, first, second):
        out = fn(key, first, second)
        give_back()
        return out

    return (batches_of, grouped, keyed)[len(inspect.signature(fn).parameters) - 1]
