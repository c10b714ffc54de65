"""Incremental partitioning of catalogue files as they arrive.

The batch jobs derive the grid from the data's bounding box; a stream cannot
see all its data first, so the grid (zone + side) is given -- typically the
grid of the first full load, or the survey footprint.  New catalogue text
files dropped into a folder are scanned with the Source schema, assigned to
cells by the same column expressions as the batch jobs, and appended to the
per-cell layout.  Progress and state live in a checkpoint location (in the
shared folder), so a restarted or failed query resumes exactly where it left
off.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skygrid.functions.cells import DEFAULT_HALO, Grid
from skygrid.functions.coords import NULL_TOKEN, unwrap_ra, wrap_ra
from skygrid.operators.grid import assign_exclusive, assign_overlap, outside_overlap
from skygrid.operators.ranks import rank_rows
from skygrid.sources.catalogue import DELIMITER, parsed_positions, text_positions
from skygrid.sources.schema import DECL, RA, SOURCE_ID, SOURCE_SCHEMA


def read_source_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of catalogue text files (same parsing as the batch scan)."""
    reader = (spark.readStream.schema(text_positions(SOURCE_SCHEMA))
              .option("sep", DELIMITER).option("header", False).option("quote", "")
              .option("nullValue", NULL_TOKEN)
              .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
              .option("mode", "FAILFAST"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parsed_positions(reader.csv(input_dir))


def _points(stream: DataFrame, wrap: bool) -> DataFrame:
    return stream.select(SOURCE_ID, (wrap_ra(RA) if wrap else F.col(RA)).alias(RA), F.col(DECL))


def assigned_stream(stream: DataFrame, grid: Grid, overlap: bool = False,
                    halo: float = DEFAULT_HALO, wrap: bool = False) -> DataFrame:
    """Cell assignment of a streaming scan (stateless, row by row).

    Rows without a position fail the query.  RA is the wrapped one where the
    grid is (``wrap`` or ``overlap``); writers turn it back.
    """
    pts = _points(stream, wrap or overlap)
    return assign_overlap(pts, grid, halo) if overlap else assign_exclusive(pts, grid)


def start_partitioning(stream: DataFrame, grid: Grid, output_dir: str, checkpoint_dir: str,
                       overlap: bool = False, halo: float = DEFAULT_HALO, wrap: bool = False,
                       available_now: bool = True) -> StreamingQuery:
    """Append assigned rows to ``output_dir/data/batch=../cell_i=../cell_j=..`` (parquet).

    RA is written as it was read.  Points beyond the given grid: the exclusive
    grid counts them in its border cells; an overlapping cell holds only what
    lies in its widened box, so points beyond zone and halo go, whole, to
    ``output_dir/outside/batch=..`` -- no row is dropped.  Each batch is
    exchanged by cell before it is written, so a cell gets few files, and a
    batch replayed after a failure replaces its own output.
    """
    root = output_dir.rstrip("/")

    def process(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            ra = unwrap_ra(RA).alias(RA) if wrap or overlap else F.col(RA)
            rows = assigned_stream(batch, grid, overlap, halo, wrap).select(SOURCE_ID, ra, DECL, "cell_i", "cell_j")
            (rows.hint("rebalance", "cell_i", "cell_j").write.mode("overwrite").partitionBy("cell_i", "cell_j")
             .parquet(f"{root}/data/batch={batch_id}"))
            if overlap:
                _write_outside(batch, grid, halo, root, batch_id)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def _write_outside(batch: DataFrame, grid: Grid, halo: float, root: str, batch_id: int) -> None:
    outside = outside_overlap(_points(batch, True), grid, halo).select(SOURCE_ID, unwrap_ra(RA).alias(RA), DECL)
    outside.write.mode("overwrite").parquet(f"{root}/outside/batch={batch_id}")


def cell_counts(assigned: DataFrame) -> DataFrame:
    """Running rows per cell (stateful streaming aggregate, ``complete`` mode).

    State holds one count per cell, bounded by the grid.
    """
    return assigned.groupBy("cell_i", "cell_j", "cell").agg(F.count(F.lit(1)).alias("n_rows"))


def start_capped_partitioning(stream: DataFrame, grid: Grid, output_dir: str, checkpoint_dir: str,
                              cap: int, halo: float = DEFAULT_HALO,
                              available_now: bool = True) -> StreamingQuery:
    """Overlapping cells with the per-cell cap, continued across micro-batches.

    Rows fill cells in arrival order (micro-batch, then ``sourceId`` within a
    batch).  The running count of every cell lives in a small table below
    ``output_dir/_counts/batch=<id>`` (at most one row per cell); batch ``k``
    starts from the counts of the batch before it, which must be there: a
    count table that can't be read fails the batch, it never restarts at 0.
    Each batch writes ``output_dir/data/batch=<id>`` with overwrite, so a
    batch replayed after a failure replaces its own output instead of
    duplicating it.  Points beyond zone and halo go to ``output_dir/outside``.
    """
    root = output_dir.rstrip("/")
    counts_schema = "cell_i int, cell_j int, n_rows bigint"

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            # Batch ids are consecutive from 0, so only the first has no counts before it.
            prev = (spark.read.schema(counts_schema).parquet(f"{root}/_counts/batch={batch_id - 1}") if batch_id
                    else spark.createDataFrame([], counts_schema))
            assigned = assigned_stream(batch, grid, overlap=True, halo=halo).select(
                SOURCE_ID, RA, DECL, "cell_i", "cell_j")
            batch_counts = assigned.groupBy("cell_i", "cell_j").agg(F.count(F.lit(1)).alias("_new"))
            ranked = rank_rows(assigned, ["cell_i", "cell_j"], [SOURCE_ID, RA, DECL]).join(
                prev.withColumnRenamed("n_rows", "_before"), ["cell_i", "cell_j"], "left")
            rows = (ranked.withColumn("_rank", F.coalesce(F.col("_before"), F.lit(0)) + F.col("rank"))
                    .withColumn("segment", F.expr(f"CAST((_rank - 1) div {int(cap)} AS INT)"))
                    .select(SOURCE_ID, unwrap_ra(RA).alias(RA), DECL, "cell_i", "cell_j", "segment"))
            (rows.sortWithinPartitions("cell_i", "cell_j", "segment").write.mode("overwrite")     # ranked: in ranges
             .partitionBy("cell_i", "cell_j").parquet(f"{root}/data/batch={batch_id}"))
            _write_outside(batch, grid, halo, root, batch_id)
            total = F.coalesce(F.col("n_rows"), F.lit(0)) + F.coalesce(F.col("_new"), F.lit(0))
            (prev.join(batch_counts, ["cell_i", "cell_j"], "full").select("cell_i", "cell_j", total.alias("n_rows"))
             .write.mode("overwrite").parquet(f"{root}/_counts/batch={batch_id}"))
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
