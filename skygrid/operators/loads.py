"""Per-object summaries kept across loads: one table per load, merged when they are read.

A load's rows are summarised once and its summary is written below
``path/load=<name>``, about one row per object; the observations of earlier
loads aren't read again.  A load that is written a second time replaces its
own summary, so a replay counts nothing twice -- in batch, and in a stream
whose micro-batches are its loads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from skygrid.operators.summary import merge_extents, object_extent
from skygrid.sources.schema import OBJECT_ID

_COLUMNS = (OBJECT_ID, "n_sources", "last_source_id", "min_ra", "max_ra", "min_decl", "max_decl")


def write_load(sources: DataFrame, path: str, load: str) -> None:
    """Summarise the rows of one load and put the summary in place of any earlier one of that name."""
    if not load or any(c in load for c in "/=\\"):
        raise ValueError(f"not a load name: {load!r}")
    object_extent(sources).write.mode("overwrite").parquet(f"{path.rstrip('/')}/load={load}")


def merged_loads(spark: SparkSession, path: str) -> DataFrame:
    """The summary of all loads below ``path``, as :func:`object_extent` of their rows together."""
    return merge_extents(spark.read.option("basePath", path).parquet(path).select(*_COLUMNS))


def compact_loads(spark: SparkSession, path: str, into: str) -> None:
    """The merged summary as the first load of a new folder, ``into``; the old one stays as it is."""
    merged_loads(spark, path).write.mode("errorifexists").parquet(f"{into.rstrip('/')}/load=compacted")


def start_loads(stream: DataFrame, path: str, checkpoint_dir: str, name: str = "stream",
                available_now: bool = True) -> StreamingQuery:
    """Write every micro-batch of a stream of observations as a load; a replayed batch replaces itself."""
    def process(batch: DataFrame, batch_id: int) -> None:
        write_load(batch, path, f"{name}-{batch_id}")
    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
