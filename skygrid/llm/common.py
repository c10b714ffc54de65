"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.session import cut_lineage, fresh_dir

__all__ = ["bound_batches", "cut_lineage", "fresh_dir", "fold", "map_batches", "row_slices", "table", "text_slices"]

# Bytes of an Arrow batch handed to Python: with whole documents in a row, the
# default of 64 MB costs several times as much in the JVM and the worker.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus, F.lit(-1))


def bound_batches(spark: SparkSession) -> None:
    """Keep this session's Arrow batches within BATCH_BYTES (a single row may be larger)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    """``fn`` over each Arrow batch of ``df`` (narrow, streaming, bounded by the batch bytes)."""
    bound_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)
    return df.mapInArrow(run, schema)


def text_slices(batch: pa.RecordBatch, column: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into row ranges of about ``max_bytes`` of text.

    A row is never cut: a single text longer than ``max_bytes`` is a range of
    its own.
    """
    return row_slices(batch, [n or 0 for n in pc.binary_length(batch.column(column)).to_pylist()], max_bytes)


def row_slices(batch: pa.RecordBatch, sizes: list[int], most: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into row ranges of about ``most`` by the rows' ``sizes``; a larger row is a range of its own."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)
