"""Exact ranks inside groups of any size, by a sample sort.

Rows are range-partitioned on (group, order): Spark draws the splitters from a
sample of the rows themselves, so the parts are even whatever the values look
like -- dense runs, far outliers, one group with most of the rows.  Each part
is sorted and numbered where it lies; the table of rows per (part, group) then
turns the numbers into exact ranks.  The input is evaluated three times (a
count that reads no column, the sample, the shuffle) and shuffled once.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygrid.session import cut_lineage

# Rows that a task sorts and numbers, on average.
ROWS_PER_TASK = 2_000_000
_IN_PART = 33       # bits of monotonically_increasing_id that count inside a part


def _tie(rows: DataFrame, known):
    """A hash of the columns that the order doesn't name (maps have none)."""
    rest = [c for c in rows.columns if c not in known and not isinstance(rows.schema[c].dataType, T.MapType)]
    return F.xxhash64(*rest) if rest else F.lit(0).cast("bigint")


def rank_rows(rows: DataFrame, keys, order, rows_per_task: int = ROWS_PER_TASK, name: str = "rank") -> DataFrame:
    """Adds the exact 1-based ``name`` of each row inside its group ``keys`` by the columns ``order``.

    Rows that agree in ``order`` are ranked by a hash of their other columns,
    so ranks depend on the rows alone, never on how they were partitioned;
    rows that agree in every column are interchangeable, and are spread over
    parts like any others.  Null keys form a group, null order values come
    first.  Columns may have any names but ``name``.
    """
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / rows_per_task))
    packed = rows.select(F.struct(*rows.columns).alias("row"), _tie(rows, {*keys, *order}).alias("tie"),
                         F.monotonically_increasing_id().alias("nth"))
    by = [F.col("row").getField(c) for c in [*keys, *order]] + [F.col("tie"), F.col("nth")]
    placed = cut_lineage(packed.repartitionByRange(parts, *by).sortWithinPartitions(*by)
                         .select("row", F.monotonically_increasing_id().alias("at")), "ranked")
    part, inside = F.shiftright("at", _IN_PART), F.col("at").bitwiseAND((1 << _IN_PART) - 1)
    group = [F.col("row").getField(c).alias(f"key{k}") for k, c in enumerate(keys)]
    placed = placed.select("row", part.alias("part"), inside.alias("inside"), *group)
    ids = [f"key{k}" for k in range(len(keys))]
    counts = placed.groupBy("part", *ids).agg(F.min("inside").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*ids).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part and group in it: broadcast while small (by its measured size), joined by key beyond.
    shifts = cut_lineage(counts.select(
        F.col("part").alias("of"), *[F.col(c).alias(f"of_{c}") for c in ids],
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift")), "rankshifts")
    match = F.col("part") == F.col("of")
    for c in ids:
        match = match & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    return placed.join(shifts, match).select("row.*", (F.col("inside") + F.col("shift")).alias(name))
