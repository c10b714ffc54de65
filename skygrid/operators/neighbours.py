"""Neighbour search: all pairs of observations closer than ``eps``.

Both variants are blocking equi-joins.  Points are keyed by the block they
fall in; each point is also emitted into the "half neighbourhood" of blocks
that could hold a partner, so every pair is produced exactly once.  The join
is a hash/sort-merge join on the block key -- never a nested loop or a cross
join -- and the exact distance test runs on the candidates only.  A block with
very many points is a skewed join key; adaptive execution splits such
partitions (``spark.sql.adaptive.skewJoin.enabled``), and blocks with more
than ``pair_budget`` candidate pairs are salted explicitly (see :func:`_salted_join`).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.functions.coords import haversine_term, haversine_threshold
from skygrid.operators.positions import require_positions
from skygrid.session import cut_lineage
from skygrid.sources.schema import DECL, RA, SOURCE_ID

# Block sides are widened by this relative margin so rounding in ``x / side``
# can never separate two points closer than eps by more than one block.
_SLACK = 1.0 + 1e-9
# More than rounding takes from a difference of two coordinates, degrees.
_ROUNDING = 1e-12
# Degrees below which blocks of the sphere get no smaller: their number stays within 64 bits.
_FINEST = 1e-6

# Planar half neighbourhood: for any block offset D other than (0, 0),
# exactly one of D and -D is listed.
_HALF = [(0, 0), (1, -1), (1, 0), (1, 1), (0, 1)]

# Candidate pairs that one join key may hold; a block with more is cut into a
# grid of salted sub-blocks.
PAIR_BUDGET = 50_000_000
# The table of such blocks (their key and two small numbers) is broadcast; the
# budget is raised until it has at most this many rows.
MAX_HOT_BROADCAST = 500_000


def _salted_join(base: DataFrame, probe: DataFrame, keys: list[str], base_id: str, probe_id: str,
                 pair_budget: int) -> DataFrame:
    """Equi-join ``base`` and ``probe`` on ``keys``, hot keys cut by their candidate pairs.

    Base and probe rows are counted per key (combined before the shuffle).  A
    key with ``b * p`` candidate pairs above the budget becomes a grid of
    ``sb x sp`` keys: a base row takes one of ``sb`` rows by a hash of its id
    and is repeated over the ``sp`` columns, a probe row the other way round.
    Every (base, probe) pair still meets exactly once, and the work of one
    key, wherever the points are, is bounded.  The join is an ordinary one on
    (keys, salts), so adaptive execution sizes it and splits what skew is left.
    It is a merge join at any size: the work is that of the pairs, and a
    broadcast would leave it to as few tasks as the input has splits.
    """
    pairs = cut_lineage(
        base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nbase"))
        .join(probe.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nprobe")), keys)
        .where(F.col("_nbase").cast("double") * F.col("_nprobe") > pair_budget), "hotblocks")
    n_hot = pairs.count()
    while n_hot > MAX_HOT_BROADCAST:
        pair_budget *= 4
        pairs = pairs.where(F.col("_nbase").cast("double") * F.col("_nprobe") > pair_budget)
        n_hot = pairs.count()
    if n_hot == 0:
        return base.join(probe.hint("merge"), keys)
    # Sub-blocks about as many rows high as wide.
    side = F.lit(float(pair_budget) ** 0.5)
    hot = F.broadcast(pairs.select(*keys, F.ceil(F.col("_nbase") / side).cast("int").alias("_sb"),
                                   F.ceil(F.col("_nprobe") / side).cast("int").alias("_sp")))

    def salted(rows: DataFrame, id_col: str, own: str, other: str, salt: str, spread: str) -> DataFrame:
        own_n, other_n = F.coalesce(own, F.lit(1)), F.coalesce(other, F.lit(1))
        return (rows.join(hot, keys, "left")
                .withColumn(salt, F.pmod(F.xxhash64(F.col(id_col)), own_n).cast("int"))
                .withColumn(spread, F.explode(F.sequence(F.lit(0), other_n - 1))).drop("_sb", "_sp"))

    return (salted(base, base_id, "_sb", "_sp", "_u", "_v")
            .join(salted(probe, probe_id, "_sp", "_sb", "_v", "_u").hint("merge"), [*keys, "_u", "_v"]).drop("_u", "_v"))


def _pair_columns(a: str, b: str) -> list[Column]:
    return [F.least(F.col(a), F.col(b)).alias("id_a"), F.greatest(F.col(a), F.col(b)).alias("id_b")]


def neighbour_pairs(points: DataFrame, eps: float, id_col: str = SOURCE_ID, ra: str = RA,
                    decl: str = DECL, with_distance: bool = True,
                    pair_budget: int = PAIR_BUDGET) -> DataFrame:
    """Pairs with planar distance ``sqrt(dra^2 + ddecl^2) < eps`` (``id_a < id_b``).

    Coordinates are treated as Cartesian; pass wrapped RA for a footprint
    across RA = 0 (see :func:`neighbour_pairs_sphere` for the true sphere).
    """
    if eps <= 0:
        raise ValueError("eps must be positive")
    # Blocks are two eps wide: a point is probed into a neighbour block only
    # when it lies within eps of that block's rectangle (a lower bound on the
    # distance to any partner there), so on average ~2.4 rows per point
    # enter the shuffle instead of 5.
    side = 2.0 * eps * _SLACK
    pts = require_positions(points, ra, decl).select(F.col(id_col).alias("_id"), F.col(ra).alias("_x"), F.col(decl).alias("_y"),
                        F.floor(F.col(ra) / F.lit(side)).alias("_bx"),
                        F.floor(F.col(decl) / F.lit(side)).alias("_by"))
    # Distances from the point to its own block's left/right and lower/upper edges.
    gaps = pts.select("*",
                      (F.col("_x") - F.col("_bx") * F.lit(side)).alias("_gl"),
                      ((F.col("_bx") + 1) * F.lit(side) - F.col("_x")).alias("_gr"),
                      (F.col("_y") - F.col("_by") * F.lit(side)).alias("_gd"),
                      ((F.col("_by") + 1) * F.lit(side) - F.col("_y")).alias("_gu"))

    def reach(dx: int, dy: int) -> Column:
        # Probe at offset D meets base points in block (own - D).
        gx = {0: F.lit(0.0), 1: F.col("_gl"), -1: F.col("_gr")}[dx]
        gy = {0: F.lit(0.0), 1: F.col("_gd"), -1: F.col("_gu")}[dy]
        return (gx * gx + gy * gy) < F.lit(eps * eps * _SLACK)

    offsets = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), reach(dx, dy).alias("ok"))
                        for dx, dy in _HALF])
    probe = (gaps.select("*", F.explode(offsets).alias("_o"))
             .where(F.col("_o.ok"))
             .select(F.col("_id").alias("_id2"), F.col("_x").alias("_x2"), F.col("_y").alias("_y2"),
                     (F.col("_bx") - F.col("_o.dx")).alias("_bx"),
                     (F.col("_by") - F.col("_o.dy")).alias("_by"),
                     ((F.col("_o.dx") == 0) & (F.col("_o.dy") == 0)).alias("_same")))
    dx = F.col("_x2") - F.col("_x")
    dy = F.col("_y2") - F.col("_y")
    dist = F.sqrt(dx * dx + dy * dy)
    joined = (_salted_join(pts, probe, ["_bx", "_by"], "_id", "_id2", pair_budget)
              .where((~F.col("_same") | (F.col("_id") < F.col("_id2"))) & (dist < F.lit(eps))))
    cols = _pair_columns("_id", "_id2")
    if with_distance:
        cols.append(dist.alias("separation"))
    return joined.select(*cols)


def _zone_alpha(zone: Column, height: float, eps: float) -> Column:
    """Largest RA difference (deg) two points within eps can have, for the
    pair of Decl zones ``zone`` and ``zone + 1``."""
    lo = zone * F.lit(height) - F.lit(90.0)
    hi = (zone + 2) * F.lit(height) - F.lit(90.0)
    dmax = F.least(F.lit(90.0), F.greatest(F.abs(lo), F.abs(hi)))
    ratio = F.lit(math.sin(math.radians(eps) / 2.0)) / F.cos(F.radians(dmax))
    return F.when((dmax >= F.lit(90.0)) | (ratio >= F.lit(1.0)), F.lit(360.0)).otherwise(
        F.degrees(F.lit(2.0) * F.asin(ratio)))


def neighbour_pairs_sphere(points: DataFrame, eps: float, id_col: str = SOURCE_ID, ra: str = RA,
                           decl: str = DECL, pair_budget: int = PAIR_BUDGET) -> DataFrame:
    """Pairs with great-circle separation ``< eps`` degrees (``id_a < id_b``).

    Decl is cut into zones of height eps.  A pair lies in one zone or in two
    adjacent ones; for each zone pair (z, z+1) the RA block width is the widest
    RA gap that pair can span at its highest |Decl|, and RA blocks wrap
    modulo 360.  Each point is a base row for its own zone pair and a probe
    for the pair below, so every pair is produced once.
    """
    if eps <= 0:
        raise ValueError("eps must be positive")
    # Zones eps tall and RA blocks at least alpha wide: a partner lies in the
    # point's own block or one next to it.  Pairs grow faster than rows, so
    # blocks are no larger: twice the side would test twice the candidates.
    # A point is probed into a block at a corner only when it lies close
    # enough to it (a lower bound on the separation from any partner there).
    reach = max(eps, _FINEST)
    height = reach * _SLACK
    ra_u = F.when(F.col(ra) < 0, F.col(ra) + F.lit(360.0)).otherwise(F.col(ra))
    pts = require_positions(points, ra, decl).select(F.col(id_col).alias("_id"), ra_u.alias("_ra"), F.col(decl).alias("_dec"),
                        F.floor((F.col(decl) + F.lit(90.0)) / F.lit(height)).alias("_z"))

    def with_blocks(df: DataFrame, zone_col: Column, tag: str) -> DataFrame:
        # Per zone pair: alpha, block count, block, and gaps to the block's
        # left/right edges -- computed once per row in a projection.
        alpha = _zone_alpha(zone_col, height, reach)
        df = df.withColumn(f"_a{tag}", alpha)
        nb = F.floor(F.lit(360.0) / (F.col(f"_a{tag}") * F.lit(_SLACK))).cast("bigint")
        df = df.withColumn(f"_nb{tag}", F.when(nb < 3, F.lit(1).cast("bigint")).otherwise(nb))
        width = F.lit(360.0) / F.col(f"_nb{tag}").cast("double")
        df = df.withColumn(f"_k{tag}", F.floor(F.col("_ra") / width))
        return (df.withColumn(f"_b{tag}", F.pmod(F.col(f"_k{tag}"), F.col(f"_nb{tag}")))
                .withColumn(f"_gl{tag}", F.col("_ra") - F.col(f"_k{tag}") * width)
                .withColumn(f"_gr{tag}", (F.col(f"_k{tag}") + 1) * width - F.col("_ra")))

    pts = with_blocks(pts, F.col("_z"), "0")
    pts = with_blocks(pts, F.col("_z") - 1, "1")
    nb0, b0, nb1, b1 = F.col("_nb0"), F.col("_b0"), F.col("_nb1"), F.col("_b1")
    near = lambda gap, bound: gap < bound * F.lit(_SLACK)
    # Zone and block in one number: rows are sorted by it alone, in linear time.
    block_key = lambda zone, b: zone * F.lit(math.ceil(360.0 / reach) + 1) + b
    threshold, square = haversine_threshold(eps), lambda c: c * c
    # 4 hav in squared degrees: a pair below ``sure`` is close, since a sine is at
    # most its angle; one above ``_far`` of its zone pair is not, since the sine of
    # half an angle x is at least x/2 * sqrt(1 - x * x / 12).  Only pairs
    # between the two need the sines themselves.
    sure = 4.0 * threshold * math.degrees(1.0) ** 2
    margin = 1e-9 + 4.0 * _ROUNDING / eps   # of rounding, relative
    widest = F.radians(F.greatest(F.col("_a0"), F.lit(eps)))
    far = F.when(widest < F.lit(1.0), F.lit(sure * (1.0 + margin)) / (F.lit(1.0) - square(widest) / F.lit(12.0))).otherwise(
        F.lit(math.inf))
    # Base rows: the point's own zone pair (z, z+1), block in that pair's width.
    base = pts.select("_id", "_ra", "_dec", F.cos(F.radians("_dec")).alias("_cos"),
                      block_key(F.col("_z"), b0).alias("_k"), (F.col("_a0") * F.lit(_SLACK) + F.lit(_ROUNDING)).alias("_alpha"),
                      far.alias("_far"))
    # Probes, all from one expansion of the point.  Same zone: its own block
    # always, the block to the left when the point is within alpha of that
    # edge.  Zone below, only within eps of this zone's lower edge: own block,
    # and a side block when the point lies in the ellipse of eps and alpha
    # around their corner.  With one RA block the side blocks are the block
    # itself; with three or more the candidates are distinct.
    to_lower = F.col("_dec") - (F.col("_z") * F.lit(height) - F.lit(90.0))
    low = near(to_lower, F.lit(reach))
    corner = lambda gap: near(square(to_lower / F.lit(reach)) + square(gap / F.col("_a1")), F.lit(1.0 + margin))
    probes = F.array(*[
        F.struct(block_key(zone, b).alias("k"), F.lit(own).alias("d0"), ok.alias("ok"))
        for zone, b, own, ok in (
            (F.col("_z"), b0, True, F.lit(True)),
            (F.col("_z"), F.pmod(b0 - 1, nb0), False, (nb0 > 1) & near(F.col("_gl0"), F.col("_a0"))),
            (F.col("_z") - 1, b1, False, low),
            (F.col("_z") - 1, F.pmod(b1 - 1, nb1), False, low & (nb1 > 1) & corner(F.col("_gl1"))),
            (F.col("_z") - 1, F.pmod(b1 + 1, nb1), False, low & (nb1 > 1) & corner(F.col("_gr1"))))])
    probe = (pts.select("_id", "_ra", "_dec", F.cos(F.radians("_dec")).alias("_cos"), F.explode(probes).alias("_o"))
             .where(F.col("_o.ok"))
             .select(F.col("_id").alias("_id2"), F.col("_ra").alias("_ra2"), F.col("_dec").alias("_dec2"),
                     F.col("_cos").alias("_cos2"),
                     F.col("_o.k").alias("_k"), F.col("_o.d0").alias("_d0")))
    # Within one block of one zone each pair meets twice: keep one orientation.
    # Candidates too far apart in one coordinate alone are left out by a
    # comparison first, then those clearly close or far by squares.
    h = haversine_term("_ra", "_dec", "_ra2", "_dec2", "_cos", "_cos2")
    gap = F.abs(F.col("_ra2") - F.col("_ra"))
    flat = (square(F.col("_dec2") - F.col("_dec"))
            + F.col("_cos") * F.col("_cos2") * square(F.least(gap, F.lit(360.0) - gap)))
    beyond = gap > F.lit(360.0) + F.col("_alpha")   # RA of more than a turn
    return (_salted_join(base, probe, ["_k"], "_id", "_id2", pair_budget)
            .where((F.abs(F.col("_dec2") - F.col("_dec")) <= F.lit(eps * _SLACK + _ROUNDING))
                   & ((gap <= F.col("_alpha")) | (gap >= F.lit(360.0) - F.col("_alpha")))
                   & ((flat < F.lit(sure * (1.0 - margin)))
                      | (((flat < F.col("_far")) | beyond) & (h < F.lit(threshold))))
                   & (~F.col("_d0") | (F.col("_id") < F.col("_id2"))))
            .select(*_pair_columns("_id", "_id2")))
