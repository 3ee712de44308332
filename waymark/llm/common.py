"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The white space that separates words: space and \t \n \v \f \r, which is what bytes.split() uses.
WHITE = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session: what the cluster's owner sized for its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; one of its own only in local mode, where none is configured."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """A copy of df in the shared checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """A copy of df as a Parquet table in the shared checkpoint folder: columns not asked for are not read, and no
    partitioning is remembered, so that joins with it shuffle both sides and Spark may split what is skewed."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_documents(df: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and text of df alone, so that other columns can't clash with those that an operator adds."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, sizes: list[int] | np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose sizes add up to `most` at most, one row at least."""
    at = total = 0
    for row, size in enumerate(sizes):
        if row > at and total + size > most:
            yield batch.slice(at, row - at)
            at, total = row, 0
        total += size
    if at < batch.num_rows:
        yield batch.slice(at)


def runs(batches: Iterator[pa.RecordBatch], most: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most `most` bytes of text each (one row at least), to bound memory."""
    for batch in batches:
        yield from slices(batch, pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), most)


def packed_runs(batches: Iterator[pa.RecordBatch], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose `packed` texts have at most `most` bytes when unpacked (one row at least)."""
    for batch in batches:
        yield from slices(batch, [0 if x is None else zstandard.frame_content_size(x) for x in batch.column("packed").to_pylist()], most)


def text_hash(text: bytes) -> int:
    """What tells the texts of rows with one doc_id apart, as a signed long."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(text)).view(np.int64))


def squeezed(docs: DataFrame) -> DataFrame:
    """docs with text compressed to `packed` (null stays null) and `text_key`, its hash, to be shuffled cheaply."""
    schema = T.StructType([f for f in docs.schema.fields if f.name != "text"]).add("packed", T.BinaryType()).add("text_key", T.LongType())
    names = [f.name for f in schema.fields[:-2]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1, write_checksum=False).compress
        for batch in runs(batches, 8 << 20):
            raw = batch.column("text").cast(pa.binary()).to_pylist()
            columns = [pa.array([None if x is None else pack(x) for x in raw], pa.binary()), pa.array([text_hash(x or b"") for x in raw], pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *columns], [*names, "packed", "text_key"])

    return docs.mapInArrow(run, schema)


def compress(text: bytes, level: int = 1) -> bytes:
    return zstandard.compress(text, level)


def unpacked(column: pa.Array) -> list[bytes | None]:
    """The texts of a `packed` column."""
    unpack = zstandard.ZstdDecompressor().decompress
    return [None if x is None else unpack(x) for x in column.to_pylist()]
