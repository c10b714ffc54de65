"""Sinks: text records, one directory per cell, and input sizing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.functions.cells import BLOCK_BYTES


def write_text(lines: DataFrame, path: str, col: str = "value") -> None:
    """One text line per row; refuses an existing path (no silent overwrite)."""
    lines.select(F.col(col).cast("string").alias("value")).write.mode("errorifexists").text(path)


def write_by_cell(assigned: DataFrame, path: str, keys=("cell_i", "cell_j"), fmt: str = "parquet",
                  within=(), arranged: bool = False) -> None:
    """One output directory per cell (``cell_i=<i>/cell_j=<j>``), or per other keys.

    Rows are exchanged on the keys so each cell is written as few files.  The
    exchange is a rebalance: adaptive execution coalesces small cells and
    splits a hot cell over several tasks (still one directory), so no single
    task writes a third of the data.  Two integer keys avoid the ``1.1`` /
    ``1.10`` merge that a single text key suffers when partition values are
    type-inferred.  For ``fmt='text'`` the frame must hold exactly one non-key
    string column.

    ``within`` names columns by which the rows of a cell are sorted, such as
    the segment of a capped cell: the number of directories stays that of the
    cells, and a filter on such a column skips files and row groups by their
    statistics.  Tasks then take ranges of (keys, within).  ``arranged`` rows,
    as :func:`skygrid.operators.grid.capacity_split` returns them, lie in
    such ranges already and are written without an exchange.
    """
    keys, order = list(keys), [*keys, *within]
    if arranged:
        assigned = assigned.sortWithinPartitions(*order)
    elif within:
        assigned = assigned.repartitionByRange(*order).sortWithinPartitions(*order)
    else:
        assigned = assigned.hint("rebalance", *keys)
    writer = assigned.write.mode("errorifexists").partitionBy(*keys)
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "text":
        writer.text(path)
    else:
        raise ValueError(f"unsupported format {fmt}")


def read_by_cell(spark: SparkSession, path: str, fmt: str = "parquet", keys=("cell_i", "cell_j")) -> DataFrame:
    """Read a per-cell layout back; the integer keys become columns.

    Filters on the keys prune whole directories.
    """
    reader = spark.read.option("basePath", path)
    df = reader.parquet(path) if fmt == "parquet" else reader.text(path)
    return df.select(*[F.col(c).cast("int").alias(c) if c in keys else F.col(c) for c in df.columns])


def input_size(spark: SparkSession, path: str) -> DataFrame:
    """Total bytes and file count below ``path`` (hidden and ``_`` files skipped).

    A distributed file listing: only paths and lengths are read, never the
    file contents.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(path).select("path", "length"))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("total_bytes"),
                     F.count(F.lit(1)).alias("n_files"))


def min_cells_from_size(size_df: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Cells needed so each holds at most one block, and the grid side."""
    cells = F.greatest(F.lit(1), F.ceil(F.col("total_bytes") / F.lit(float(block_bytes))).cast("int"))
    return (size_df.withColumn("min_cells", cells)
            .withColumn("grid_side", F.ceil(F.sqrt(F.col("min_cells").cast("double"))).cast("int")))


def min_cells_for_input(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> int:
    """The least number of cells for the files below ``path``, from their listing."""
    return int(min_cells_from_size(input_size(spark, path), block_bytes).first()["min_cells"])
