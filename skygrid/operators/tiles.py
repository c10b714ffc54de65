"""Equal-load cells: a k-d tree of two cuts, placed by the data instead of by the box.

Right ascension is cut into slabs of equally many points, each slab into tiles
of equally many points along declination.  Cuts are exact order statistics of
the points (``operators.ranks``), so cells differ by at most one point within
a slab however the sky is filled -- a hot spot gets small cells, not full ones --
and a grid sized by the input's bytes has cells of about one block each.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.operators.positions import require_positions
from skygrid.operators.ranks import ROWS_PER_TASK, rank_rows
from skygrid.session import cut_lineage
from skygrid.sources.schema import DECL, RA, SOURCE_ID


def assign_tiles(positions: DataFrame, cells: int, ra: str = RA, decl: str = DECL, id_col: str = SOURCE_ID,
                 rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Adds ``slab`` and ``tile``: at least ``cells`` cells of equally many rows (fewer cells if rows are fewer).

    Points of equal coordinates are ordered by the other coordinate and by
    id, so a run of equal values may be cut: neighbouring cells then share
    the edge of their closed boxes.  Two sorts, each one shuffle of the rows.
    """
    if cells < 1:
        raise ValueError("cells must be positive")
    slabs = math.ceil(math.sqrt(cells))
    tiles = math.ceil(cells / slabs)
    packed = require_positions(positions, ra, decl).select(
        F.struct(*positions.columns).alias("row"), F.col(ra).alias("x"), F.col(decl).alias("y"), F.col(id_col).alias("id"))
    by_ra = cut_lineage(rank_rows(packed, [], ["x", "y", "id"], rows_per_task), "slabs")
    n = by_ra.count()
    slab = F.expr(f"CAST(((rank - 1) * {slabs}) div {max(n, 1)} AS INT)").alias("slab")
    by_decl = rank_rows(by_ra.select("row", "x", "y", "id", slab), ["slab"], ["y", "x", "id"], rows_per_task)
    # Rows of a slab follow from the formula that filled it: ranks r with r * slabs div n = slab.
    first = F.expr(f"(slab * {n}L + {slabs - 1}) div {slabs}")
    after = F.expr(f"((slab + 1) * {n}L + {slabs - 1}) div {slabs}")
    return by_decl.withColumn("held", after - first).select(
        "row.*", "slab", F.expr(f"CAST(((rank - 1) * {tiles}) div held AS INT)").alias("tile"))


def tile_table(assigned: DataFrame, ra: str = RA, decl: str = DECL) -> DataFrame:
    """The cells: ``slab, tile``, the box of their points and ``n_rows``."""
    return assigned.groupBy("slab", "tile").agg(
        F.min(ra).alias("ra_lo"), F.max(ra).alias("ra_hi"), F.min(decl).alias("decl_lo"), F.max(decl).alias("decl_hi"),
        F.count(F.lit(1)).alias("n_rows"))
