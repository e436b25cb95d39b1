"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path

ROWS_PER_BATCH = 2000        # rows of text handed to a Python worker at a time
BYTES_PER_BATCH = "16m"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def short_batches(spark: SparkSession) -> None:
    """Text rows are long: keep the batches that Python workers receive small."""
    conf = spark.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > ROWS_PER_BATCH:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_PER_BATCH)


def written(df: DataFrame, name: str, compression: str = "snappy",
            partition_by: list[str] | None = None, once: bool = False) -> DataFrame:
    """The rows as a Parquet table in the shared scratch folder, read back: computed once,
    and not again when an executor is lost. ``once``: nothing else runs the frame, so the files of
    its shuffles may go as soon as it is written."""
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    if once:
        conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path, partitionBy=partition_by)
    finally:
        if once:
            conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that the frame does not have (compared without regard to case)."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """crc32 of the id as text, modulo ``folds``, equals ``fold``; a null id never does."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))
                      == F.lit(fold), F.lit(False))


@functools.cache
def lowered_table() -> dict[int, int]:
    """str.translate table that lower-cases A-Z only."""
    return {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def utf8(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b or b"" for b in column.cast(kind).to_pylist()]


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, compressed a byte place at a time; small ones take little room."""
    values = np.ascontiguousarray(values, dtype="<u8")
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    places = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return len(values).to_bytes(8, "little") + bytes([width]) + pa.compress(
        places.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), data[8]
    places = pa.decompress(data[9:], n * width, codec="zstd", asbytes=True)
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(places, np.uint8).reshape(width, n).T
    return out.view("<i8").reshape(n)


def pieces_of(offsets: np.ndarray):
    """(start, end) of every run between consecutive offsets."""
    return zip(offsets[:-1].tolist(), offsets[1:].tolist())
