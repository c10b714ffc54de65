"""Grid partitioning of sky positions.

* exclusive assignment: each row to one cell (left-open breakpoints);
* overlapping assignment: each row to every cell whose box, widened by a
  halo, holds it -- a theta match done as explode-candidates + exact filter,
  linear in the input (never rows x cells);
* capacity split: a full cell hands later rows to overflow twins, with a
  global deterministic order and no task holding a whole hot cell;
* RA stripes with a circular border overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.functions.cells import (
    DEFAULT_CELL_CAP, DEFAULT_HALO, OVERFLOW_SUFFIX, STRIPE_PROXIMITY, STRIPES, Grid,
    breakpoint_index, cell_bounds, cell_name, exclusive_cell_j, in_widened_cell, overlap_candidates,
    stripes_of)
from skygrid.functions.coords import log_bar
from skygrid.operators.positions import require_positions
from skygrid.operators.ranks import ROWS_PER_TASK, rank_rows
from skygrid.sources.schema import DECL, RA, SOURCE_ID

CELL_KEYS = ("cell_i", "cell_j")


def grid_cells(spark: SparkSession, grid: Grid) -> DataFrame:
    """The n x n cell table: indexes, name and box (RA from i, Decl from j)."""
    ids = spark.range(grid.n * grid.n)
    cells = ids.select((F.col("id") / F.lit(grid.n)).cast("int").alias("cell_i"),
                       (F.col("id") % F.lit(grid.n)).cast("int").alias("cell_j"))
    b = cell_bounds("cell_i", "cell_j", grid)
    return cells.select("cell_i", "cell_j", cell_name("cell_i", "cell_j").alias("cell"),
                        b["ra_lo"].alias("ra_lo"), b["ra_hi"].alias("ra_hi"),
                        b["decl_lo"].alias("decl_lo"), b["decl_hi"].alias("decl_hi"))


def exclusive_cells(spark: SparkSession, grid: Grid) -> DataFrame:
    """The cells of the exclusive assignment and their boxes: 1 to n, and 0 for the minimum edges.

    Cell ``i`` holds ``(lo, hi]`` of its axis; cell 0 is the edge itself, and
    on the minimum RA edge (``i`` = 0) ``j`` is 0 for any Decl.
    """
    z, side = grid.zone, grid.n + 1
    ids = spark.range(side * side)
    cells = ids.select((F.col("id") / F.lit(side)).cast("int").alias("cell_i"),
                       (F.col("id") % F.lit(side)).cast("int").alias("cell_j")).where("cell_i > 0 OR cell_j = 0")
    b = cell_bounds(F.col("cell_i") - 1, F.col("cell_j") - 1, grid)
    edge_i, edge_j = F.col("cell_i") == 0, F.col("cell_j") == 0

    def last(k: str, computed: Column, top: float) -> Column:
        return F.when(F.col(k) == grid.n, F.greatest(computed, F.lit(top))).otherwise(computed)
    return cells.select(
        "cell_i", "cell_j", cell_name("cell_i", "cell_j").alias("cell"),
        F.when(edge_i, F.lit(z.min_ra)).otherwise(b["ra_lo"]).alias("ra_lo"),
        F.when(edge_i, F.lit(z.min_ra)).otherwise(last("cell_i", b["ra_hi"], z.max_ra)).alias("ra_hi"),
        F.when(edge_j, F.lit(z.min_decl)).otherwise(b["decl_lo"]).alias("decl_lo"),
        F.when(edge_i, F.lit(z.max_decl)).when(edge_j, F.lit(z.min_decl))
        .otherwise(last("cell_j", b["decl_hi"], z.max_decl)).alias("decl_hi"))


def assign_exclusive(positions: DataFrame, grid: Grid, ra: str = RA, decl: str = DECL) -> DataFrame:
    """Adds ``cell_i``, ``cell_j``, ``cell``: one cell per row (narrow)."""
    z = grid.zone
    return (require_positions(positions, ra, decl)
            .withColumn("cell_i", breakpoint_index(ra, z.min_ra, z.max_ra, grid.n))
            .withColumn("cell_j", exclusive_cell_j(decl, "cell_i", grid))
            .withColumn("cell", cell_name("cell_i", "cell_j")))


def assign_overlap(positions: DataFrame, grid: Grid, halo: float = DEFAULT_HALO,
                   ra: str = RA, decl: str = DECL) -> DataFrame:
    """One row per (row, cell) with the point inside the cell's widened box.

    Candidates come from the point's own position (a few cells per axis),
    then the exact closed-box test decides; output is 1:n, nothing is lost:
    every point of the grid's zone lies in at least its own cell (points beyond
    zone and halo lie in none; :func:`outside_overlap` finds them).
    """
    ci, cj = overlap_candidates(ra, decl, grid, halo)
    return (require_positions(positions, ra, decl)
            .withColumn("cell_i", F.explode(ci))
            .withColumn("cell_j", F.explode(cj))
            .where(in_widened_cell(ra, decl, "cell_i", "cell_j", grid, halo))
            .withColumn("cell", cell_name("cell_i", "cell_j")))


def outside_overlap(positions: DataFrame, grid: Grid, halo: float = DEFAULT_HALO,
                    ra: str = RA, decl: str = DECL) -> DataFrame:
    """The rows beyond the grid's zone and halo, which no overlapping cell holds."""
    z, h, x, y = grid.zone, F.lit(halo), F.col(ra), F.col(decl)
    return require_positions(positions, ra, decl).where(
        (x < F.lit(z.min_ra) - h) | (x > F.lit(z.max_ra) + h)
        | (y < F.lit(z.min_decl) - h) | (y > F.lit(z.max_decl) + h))


def overflow_name(i, j, segment) -> Column:
    """Cell name ``i.j`` followed by one ``bis`` per overflow generation."""
    return F.concat(cell_name(i, j), F.repeat(F.lit(OVERFLOW_SUFFIX), segment))


def cell_histogram(assigned: DataFrame, keys=CELL_KEYS, name: str = "cell") -> DataFrame:
    """Rows per cell plus a log10 bar (partial aggregation before the shuffle).

    Groups on the integer keys only (fixed-width hash aggregation); the cell
    name is a function of the keys and is derived after the aggregate.
    """
    keys = list(keys)
    counted = assigned.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    label = (overflow_name("cell_i", "cell_j", F.col("segment")) if "segment" in keys
             else cell_name("cell_i", "cell_j"))
    return counted.select(*keys, label.alias(name), "n_rows", log_bar("n_rows").alias("bar"))


def capacity_split(assigned: DataFrame, cap: int = DEFAULT_CELL_CAP, order_col: str = SOURCE_ID,
                   keys=CELL_KEYS, name: str = "cell", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Cap each cell at ``cap`` rows; later rows go to overflow twins.

    Rows are taken in ``order_col`` order, equal ones by position and then by
    their other columns: the first ``cap`` keep the cell name, the next
    ``cap`` get ``name + 'bis'``, then ``'bisbis'`` and so on.  Adds ``segment`` (0 for the original cell) and rewrites ``name``.
    """
    if cap < 1:
        raise ValueError("cap must be positive")
    order = [order_col, *[c for c in (RA, DECL) if c in assigned.columns and c != order_col]]
    return (rank_rows(assigned, keys, order, rows_per_task)
            .withColumn("segment", F.expr(f"CAST((rank - 1) div {int(cap)} AS INT)")).drop("rank")
            .withColumn(name, F.concat(F.col(name), F.repeat(F.lit(OVERFLOW_SUFFIX), F.col("segment")))))


def capped_histogram(assigned: DataFrame, cap: int = DEFAULT_CELL_CAP, keys=CELL_KEYS,
                     name: str = "cell") -> DataFrame:
    """The histogram of a capacity split, by arithmetic on the cells' counts.

    A cell of ``n`` rows has ``ceil(n / cap)`` segments, all full but the
    last; no row needs a rank for that.
    """
    if cap < 1:
        raise ValueError("cap must be positive")
    counted = assigned.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    segments = F.sequence(F.lit(0), F.expr(f"CAST((_n - 1) div {int(cap)} AS INT)"))
    split = counted.select(*keys, "_n", F.explode(segments).alias("segment"))
    rows = split.withColumn("n_rows", F.least(F.lit(int(cap)).cast("bigint"),
                                              F.col("_n") - F.col("segment").cast("bigint") * int(cap)))
    return rows.select(*keys, "segment", overflow_name("cell_i", "cell_j", F.col("segment")).alias(name),
                       "n_rows", log_bar("n_rows").alias("bar"))


def assign_stripes(positions: DataFrame, ra: str = RA, stripes: int = STRIPES,
                   proximity: float = STRIPE_PROXIMITY) -> DataFrame:
    """RA stripes: each row in its stripe and, near a border, the next one too."""
    rows = require_positions(positions, ra, None)
    return (rows.withColumn("stripe", F.explode(stripes_of(ra, stripes, proximity)))
            .where(F.col("stripe").isNotNull()))
