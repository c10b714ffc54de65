"""End-to-end jobs over a catalogue frame.

Each job takes a frame with ``sourceId, objectId, ra, decl`` (a catalogue
scan or the stand-in ``sky`` view) and returns a DataFrame.  Grid jobs first
run one job that collects the bounding box (four doubles), then assign by a
narrow projection with the bounds as literals; capped and adaptive jobs also
materialise rows or counts in the shared folder while they are built.  All
positions must be finite numbers (``operators.positions``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.functions.cells import DEFAULT_CELL_CAP, DEFAULT_HALO, make_grid
from skygrid.functions.coords import format_record, unwrap_ra, wrap_ra
from skygrid.functions.htm import with_htm
from skygrid.operators import grid as grid_ops
from skygrid.operators.adaptive import adaptive_leaves, adaptive_split
from skygrid.operators.grid import (assign_exclusive, assign_overlap, assign_stripes,
                                    capacity_split, cell_histogram, grid_cells)
from skygrid.operators.neighbours import neighbour_pairs, neighbour_pairs_sphere
from skygrid.operators.positions import require_positions
from skygrid.operators.summary import zone_of
from skygrid.operators.tiles import assign_tiles
from skygrid.sources.schema import DECL, RA, SOURCE_ID

# Fixed values of the reference runs: 40 minimum cells (a 7 x 7 grid).
MIN_CELLS = 40


def positions(sources: DataFrame) -> DataFrame:
    """Only the coordinates (RA, Decl)."""
    return sources.select(F.col(RA).cast("double").alias(RA), F.col(DECL).cast("double").alias(DECL))


def wrapped(sources: DataFrame) -> DataFrame:
    """Id and coordinates with RA above 180 moved to negative values."""
    return sources.select(SOURCE_ID, wrap_ra(RA).alias(RA), F.col(DECL))


def exclusive_grid(sources: DataFrame, min_cells: int = MIN_CELLS, wrap: bool = False):
    pts = wrapped(sources) if wrap else sources.select(SOURCE_ID, RA, DECL)
    grid = make_grid(zone_of(pts), min_cells)
    return pts, grid


def overlap_grid(sources: DataFrame, min_cells: int = MIN_CELLS):
    pts = wrapped(sources)
    return pts, make_grid(zone_of(pts), min_cells)


def grid_assign(sources: DataFrame, min_cells: int = MIN_CELLS, wrap: bool = False) -> DataFrame:
    pts, grid = exclusive_grid(sources, min_cells, wrap)
    return assign_exclusive(pts, grid).select(SOURCE_ID, "cell_i", "cell_j", "cell")


def exclusive_histogram(sources: DataFrame, min_cells: int = MIN_CELLS, wrap: bool = False) -> DataFrame:
    pts, grid = exclusive_grid(sources, min_cells, wrap)
    return cell_histogram(assign_exclusive(pts, grid))


def overlap_assign(sources: DataFrame, min_cells: int = MIN_CELLS,
                   halo: float = DEFAULT_HALO) -> DataFrame:
    pts, grid = overlap_grid(sources, min_cells)
    return assign_overlap(pts, grid, halo)


def capped_overlap(sources: DataFrame, cap: int = DEFAULT_CELL_CAP, min_cells: int = MIN_CELLS,
                   halo: float = DEFAULT_HALO) -> DataFrame:
    """Overlapping cells with a global per-cell cap and overflow twins."""
    return capacity_split(overlap_assign(sources, min_cells, halo), cap)


def partition_exclusive(sources: DataFrame, min_cells: int = MIN_CELLS) -> DataFrame:
    """(cell, "ra,decl") pairs of the exclusive grid on raw RA."""
    pts, grid = exclusive_grid(sources, min_cells)
    return assign_exclusive(pts, grid).select("cell_i", "cell_j", "cell",
                                              format_record(RA, DECL).alias("record"))


def partition_overlap(sources: DataFrame, cap: int = DEFAULT_CELL_CAP, min_cells: int = MIN_CELLS,
                      halo: float = DEFAULT_HALO) -> DataFrame:
    """(cell, "ra,decl") pairs: overlapping, capped, original RA in the record."""
    return capped_overlap(sources, cap, min_cells, halo).select(
        "cell_i", "cell_j", "segment", "cell", format_record(unwrap_ra(RA), DECL).alias("record"))


def partition_stripe(sources: DataFrame) -> DataFrame:
    """(stripe, "ra,decl") pairs of the 40 RA stripes."""
    return assign_stripes(sources.select(RA, DECL)).select(
        "stripe", format_record(RA, DECL).alias("record"))


def grid_metadata(sources: DataFrame, cap: int = DEFAULT_CELL_CAP, min_cells: int = MIN_CELLS,
                  halo: float = DEFAULT_HALO) -> DataFrame:
    """Partitioning information: every cell's box, members and overflow count."""
    pts, grid = overlap_grid(sources, min_cells)
    members = (assign_overlap(pts, grid, halo).groupBy("cell_i", "cell_j")
               .agg(F.count(F.lit(1)).alias("members")))
    cells = grid_cells(sources.sparkSession, grid)
    return (cells.join(members, ["cell_i", "cell_j"], "left")   # both sides <= n*n rows
            .withColumn("members", F.coalesce(F.col("members"), F.lit(0)))
            .withColumn("segments", F.expr(f"CAST((members + {cap - 1}) div {cap} AS INT)"))
            .withColumn("grid_side", F.lit(grid.n))
            .withColumn("halo", F.lit(float(halo))))


def capped_histogram(sources: DataFrame, cap: int = DEFAULT_CELL_CAP, min_cells: int = MIN_CELLS,
                     halo: float = DEFAULT_HALO) -> DataFrame:
    """Rows per segment of the capped overlapping grid, from the cells' counts."""
    return grid_ops.capped_histogram(overlap_assign(sources, min_cells, halo), cap)


def adaptive_assign(sources: DataFrame, cap: int, min_cells: int = MIN_CELLS) -> DataFrame:
    pts, grid = overlap_grid(sources, min_cells)
    return adaptive_split(pts, grid, cap).select(SOURCE_ID, "level", "leaf_i", "leaf_j", "leaf")


def adaptive_cells(sources: DataFrame, cap: int, min_cells: int = MIN_CELLS) -> DataFrame:
    """The quad-tree's leaf table."""
    pts, grid = overlap_grid(sources, min_cells)
    return adaptive_leaves(pts, grid, cap)


def htm_assign(sources: DataFrame, level: int) -> DataFrame:
    """The triangle of the sphere that holds each position."""
    return with_htm(require_positions(sources.select(SOURCE_ID, RA, DECL)), level, RA, DECL).select(SOURCE_ID, "htm_id")


def kd_assign(sources: DataFrame, cells: int = MIN_CELLS) -> DataFrame:
    """The equal-load cell of each observation, on wrapped RA."""
    return assign_tiles(wrapped(sources), cells)


def pairs_planar(sources: DataFrame, eps: float) -> DataFrame:
    return neighbour_pairs(wrapped(sources), eps)


def pairs_sphere(sources: DataFrame, eps: float) -> DataFrame:
    return neighbour_pairs_sphere(sources.select(SOURCE_ID, RA, DECL), eps)

