"""Neighbour search inside written regions: the layout that makes later comparisons local.

A region is a cell of the overlapping grid.  Its points are written as *owned*
rows (every point is owned once, by the cell it lies in) and as *guest* rows
(by every cell whose box, widened by the halo, holds the point; its own cell
included).  The table is bucketed and sorted by the region, so the pairs
within any ``eps`` up to the halo are found by a join of the layout with
itself that moves no row: the partner of an owned point is a guest of the same
region.  A pair is met once for each of its two points, in the region that
owns it, and kept where its reference point -- the one with the smaller id --
is the owned one.

A region with more rows than ``region_rows`` becomes several: its owned rows
are dealt to them by a hash of the id, its guest rows are repeated in each.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.functions.cells import DEFAULT_HALO, Grid, in_widened_cell, overlap_candidates
from skygrid.operators.positions import require_positions
from skygrid.sources.schema import DECL, RA, SOURCE_ID

# Rows that a region holds before it is cut.
REGION_ROWS = 1_000_000
# Degrees by which boxes are widened beyond the halo, for the rounding of their edges.
_EDGE = 1e-9
_SALTS = 1 << 20


@dataclass(frozen=True)
class Regions:
    """A written layout: where it is, and what is needed to read it as a bucketed table."""
    path: str
    halo: float
    buckets: int
    table: str


def home_cell(x: str, lo: float, size: float, n: int) -> Column:
    """The cell (0 to n-1) of a coordinate; those on the upper edge or beyond belong to the last."""
    if size <= 0:
        return F.lit(0)
    return F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor((F.col(x) - F.lit(lo)) / F.lit(size)).cast("int")))


def region_rows(points: DataFrame, grid: Grid, halo: float = DEFAULT_HALO, max_rows: int = REGION_ROWS,
                id_col: str = SOURCE_ID, ra: str = RA, decl: str = DECL) -> DataFrame:
    """``(region, own, id, x, y)``: owned and guest rows of all regions; ``grid`` must cover the points."""
    z, wide = grid.zone, halo + _EDGE
    pts = require_positions(points, ra, decl).select(F.col(id_col).alias("id"), F.col(ra).alias("x"), F.col(decl).alias("y"))
    cells_i, cells_j = overlap_candidates("x", "y", grid, wide)
    guests = (pts.withColumn("i", F.explode(cells_i)).withColumn("j", F.explode(cells_j))
              .where(in_widened_cell("x", "y", "i", "j", grid, wide)))
    cell = F.col("i") * grid.n + F.col("j")
    guests = guests.select(cell.cast("bigint").alias("cell"), "id", "x", "y")
    own = pts.select((home_cell("x", z.min_ra, grid.cell_width, grid.n) * grid.n
                      + home_cell("y", z.min_decl, grid.cell_height, grid.n)).cast("bigint").alias("cell"), "id", "x", "y")
    # At most one row per cell of the grid.
    large = guests.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / max_rows).cast("int").alias("cuts")).where("cuts > 1")
    cuts = F.least(F.coalesce(F.col("cuts"), F.lit(1)), F.lit(_SALTS))
    dealt = own.join(large, "cell", "left").select(
        (F.col("cell") * _SALTS + F.pmod(F.xxhash64("id"), cuts)).alias("region"), F.lit(True).alias("own"), "id", "x", "y")
    repeated = guests.join(large, "cell", "left").withColumn("cut", F.explode(F.sequence(F.lit(0), cuts - 1))).select(
        (F.col("cell") * _SALTS + F.col("cut")).alias("region"), F.lit(False).alias("own"), "id", "x", "y")
    return dealt.unionByName(repeated)


def write_regions(points: DataFrame, grid: Grid, path: str, halo: float = DEFAULT_HALO, buckets: int | None = None,
                  max_rows: int = REGION_ROWS, id_col: str = SOURCE_ID, ra: str = RA, decl: str = DECL) -> Regions:
    """Write the layout to ``path``, one exchange by region; ``buckets`` defaults to the shuffle partitions."""
    spark = points.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"skygrid_regions_{uuid.uuid4().hex}"
    (region_rows(points, grid, halo, max_rows, id_col, ra, decl).repartition(buckets, "region")
     .write.mode("errorifexists").option("path", path).bucketBy(buckets, "region").sortBy("region").saveAsTable(table))
    return Regions(path, halo, buckets, table)


def open_regions(spark: SparkSession, regions: Regions) -> DataFrame:
    """The layout as a bucketed table, registered where this session doesn't know it yet."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {regions.table} (region BIGINT, own BOOLEAN, id BIGINT, x DOUBLE, y DOUBLE) "
              f"USING parquet CLUSTERED BY (region) SORTED BY (region) INTO {regions.buckets} BUCKETS "
              f"LOCATION '{regions.path}'")
    return spark.table(regions.table)


def region_pairs(spark: SparkSession, regions: Regions, eps: float) -> DataFrame:
    """``(id_a, id_b, separation)``: pairs closer than ``eps`` (planar), from the written regions alone.

    Inside a region, points meet by blocks four ``eps`` wide: an owned point in
    its block, a guest in every block within ``eps`` of it.  Both sides are
    read bucket by bucket; co-partitioning by the region alone is enough for a
    join on region and block (``requireAllClusterKeysForCoPartition`` off).
    """
    if not 0 < eps <= regions.halo:
        raise ValueError(f"eps must be positive and at most the halo {regions.halo} of the regions")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    layout, side = open_regions(spark, regions), 4.0 * eps
    reach = eps * (1 + 1e-9) + 1e-12        # no guest is missed by rounding; the distance decides

    def block(c: Column) -> Column:
        return F.floor(c / F.lit(side))

    own = layout.where("own").select("region", F.col("id").alias("id_a"), F.col("x").alias("ax"), F.col("y").alias("ay"),
                                     block(F.col("x")).alias("bx"), block(F.col("y")).alias("by"))
    near = [F.sequence(block(F.col(c) - reach), block(F.col(c) + reach)) for c in ("x", "y")]
    guests = (layout.where(~F.col("own")).withColumn("bx", F.explode(near[0])).withColumn("by", F.explode(near[1]))
              .select("region", "bx", "by", F.col("id").alias("id_b"), "x", "y"))
    dx, dy = F.col("x") - F.col("ax"), F.col("y") - F.col("ay")
    distance = F.sqrt(dx * dx + dy * dy)
    return (own.join(guests.hint("merge"), ["region", "bx", "by"]).where((F.col("id_a") < F.col("id_b")) & (distance < F.lit(eps)))
            .select("id_a", "id_b", distance.alias("separation")))
