"""Grid geometry and cell-index expressions.

A grid is the bounding box of the data split into ``n x n`` equal cells,
``n = ceil(sqrt(min_cells))``.  All per-row work is a column expression with
the grid bounds as literals, so assignment is a narrow, codegen'd projection:
no join and no per-row Python.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the partitioning scheme.
MAX_MIN_CELLS = 26 * 26        # largest accepted minimum cell count
DEFAULT_HALO = 0.1             # border overlap, degrees, on both axes
DEFAULT_CELL_CAP = 10000       # records per cell before an overflow twin opens
OVERFLOW_SUFFIX = "bis"        # appended once per overflow generation
STRIPES = 40                   # RA stripes around the full circle
STRIPE_PROXIMITY = 1           # degrees from a stripe border that also join the neighbour
BLOCK_BYTES = 128 * 1024 * 1024  # target bytes per cell (one storage block)


@dataclass(frozen=True)
class Zone:
    min_ra: float
    max_ra: float
    min_decl: float
    max_decl: float


@dataclass(frozen=True)
class Grid:
    zone: Zone
    n: int

    @property
    def cell_width(self) -> float:
        return (self.zone.max_ra - self.zone.min_ra) / self.n

    @property
    def cell_height(self) -> float:
        return (self.zone.max_decl - self.zone.min_decl) / self.n


def grid_side(min_cells: int, ceiling: int = MAX_MIN_CELLS) -> int:
    """Cells per axis for at least ``min_cells`` cells (0 is treated as 1).

    ``ceiling`` is the largest cell count the caller allows; grids for large
    inputs raise it, nothing is clamped.
    """
    if min_cells < 0 or min_cells > ceiling:
        raise ValueError(f"min_cells must be within [0, {ceiling}], got {min_cells}; "
                         "pass a higher ceiling for a finer grid")
    return max(1, math.ceil(math.sqrt(min_cells)))


def make_grid(zone: Zone, min_cells: int, ceiling: int = MAX_MIN_CELLS) -> Grid:
    return Grid(zone, grid_side(min_cells, ceiling))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_position(x) -> Column:
    """Whether a coordinate is a finite number (false for null)."""
    x = _c(x)
    return F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))


def breakpoint_index(x, lo: float, hi: float, n: int) -> Column:
    """Number of breakpoints ``lo + k*step`` (k = 0..n, ``step = (hi-lo)/n``)
    strictly below x, clamped to ``n``.

    Cells are left-open ``(lo_k, lo_{k+1}]`` numbered from 1; index 0 holds only
    the minimum edge, and the clamp lands the maximum point in cell ``n``.
    ``ceil((x - lo) / step)`` is within one of the count; one exact comparison
    against the breakpoint values on each side settles points that lie on a
    breakpoint.  A coordinate that is null or not finite has no index (null);
    on an axis without extent every point has index 0.
    """
    x = _c(x)
    if hi <= lo:
        return F.when(is_position(x), F.lit(0))
    step = (F.lit(hi) - F.lit(lo)) / F.lit(float(n))

    def bp(k: Column) -> Column:
        return F.lit(lo) + k.cast("double") * step

    # c is within one of the count t: c = t-1 has bp(c) < x, c = t+1 has
    # bp(c-1) >= x, c = t has neither -- one adjustment settles all three.
    c = F.greatest(F.lit(0), F.least(F.lit(n + 1), F.ceil((x - F.lit(lo)) / step).cast("int")))
    up = F.when(bp(c) < x, F.lit(1)).otherwise(F.lit(0))
    down = F.when(bp(c - 1) >= x, F.lit(1)).otherwise(F.lit(0))
    return F.when(is_position(x), F.least(F.lit(n), F.greatest(F.lit(0), c + up - down)))


def exclusive_cell(ra, decl, grid: Grid) -> tuple[Column, Column]:
    """Exclusive cell ``(i, j)`` of a point.

    ``j`` is 0 whenever ``i`` is 0: on the minimum RA edge the Decl scan of
    the original nested walk never runs.
    """
    z = grid.zone
    i = breakpoint_index(ra, z.min_ra, z.max_ra, grid.n)
    return i, exclusive_cell_j(decl, i, grid)


def exclusive_cell_j(decl, i, grid: Grid) -> Column:
    """Decl index given the RA index ``i`` (a column or expression)."""
    z = grid.zone
    j = breakpoint_index(decl, z.min_decl, z.max_decl, grid.n)
    return F.when(_c(i) == 0, F.when(j.isNotNull(), F.lit(0))).when(_c(i) > 0, j)


def cell_name(i, j) -> Column:
    return F.concat(_c(i).cast("string"), F.lit("."), _c(j).cast("string"))


def cell_bounds(i, j, grid: Grid) -> dict[str, Column]:
    """Box of intended-grid cell (i, j): RA from i, Decl from j."""
    z = grid.zone
    w = F.lit(grid.cell_width)
    h = F.lit(grid.cell_height)
    i, j = _c(i), _c(j)
    return {
        "ra_lo": F.lit(z.min_ra) + i * w,
        "ra_hi": F.lit(z.min_ra) + (i + 1) * w,
        "decl_lo": F.lit(z.min_decl) + j * h,
        "decl_hi": F.lit(z.min_decl) + (j + 1) * h,
    }


# Slack, in cell widths, that absorbs rounding in the candidate bounds; the
# exact membership test decides, so slack only adds a rare extra candidate.
_CANDIDATE_SLACK = 1e-6


def _candidate_range(x: Column, lo: float, size: float, n: int, halo: float) -> Column:
    """Cell indexes whose widened span can hold x.

    ``lo + i*size - halo <= x <= lo + (i+1)*size + halo`` solves to
    ``ceil((x - halo - lo)/size) - 1 <= i <= floor((x + halo - lo)/size)``.
    """
    if size <= 0:
        return F.sequence(F.lit(0), F.lit(n - 1))
    first = F.ceil((x - F.lit(halo) - F.lit(lo)) / F.lit(size) - F.lit(_CANDIDATE_SLACK)).cast("int") - 1
    last = F.floor((x + F.lit(halo) - F.lit(lo)) / F.lit(size) + F.lit(_CANDIDATE_SLACK)).cast("int")
    first = F.greatest(F.lit(0), F.least(F.lit(n - 1), first))
    last = F.greatest(F.lit(0), F.least(F.lit(n - 1), last))
    return F.sequence(first, last)


def overlap_candidates(ra, decl, grid: Grid, halo: float) -> tuple[Column, Column]:
    """Arrays of candidate i and j for the halo membership test."""
    z = grid.zone
    return (_candidate_range(_c(ra), z.min_ra, grid.cell_width, grid.n, halo),
            _candidate_range(_c(decl), z.min_decl, grid.cell_height, grid.n, halo))


def in_widened_cell(ra, decl, i, j, grid: Grid, halo: float) -> Column:
    """Closed cell box widened by ``halo`` on all four sides holds the point."""
    b = cell_bounds(i, j, grid)
    ra, decl, hl = _c(ra), _c(decl), F.lit(halo)
    return ((ra >= b["ra_lo"] - hl) & (ra <= b["ra_hi"] + hl)
            & (decl >= b["decl_lo"] - hl) & (decl <= b["decl_hi"] + hl))


def stripe_width(stripes: int = STRIPES) -> int:
    return 360 // stripes


def stripes_of(ra, stripes: int = STRIPES, proximity: float = STRIPE_PROXIMITY) -> Column:
    """The stripes of a point: its own, and the next one where a border is near.

    Stripe ``k`` of ``stripes`` holds ``((k-1)*w, k*w]`` degrees; RA 0 itself
    lies before the first border, in stripe 0.  A point within ``proximity``
    of its stripe's lower or upper border (inclusive) also joins the stripe
    behind that border, counted around the circle.
    """
    ra = _c(ra)
    w = stripe_width(stripes)
    own = F.ceil(ra / F.lit(float(w))).cast("int")
    near_lower = ra <= ((own - 1) * F.lit(w)).cast("double") + F.lit(float(proximity))
    near_upper = ra >= (own * F.lit(w)).cast("double") - F.lit(float(proximity))
    around = lambda k: F.pmod(k - 1, F.lit(stripes)) + 1
    also = F.when(near_lower & (own > 0), around(own - 1)).when(near_upper, around(own + 1))
    outside = F.raise_error(F.lit("ra outside [0, 360] has no stripe")).cast("array<int>")
    return F.when((ra >= 0) & (ra <= F.lit(360.0)), F.array(own, also)).otherwise(outside)
