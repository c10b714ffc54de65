"""Re-divide overloaded cells: a quad-tree over the grid whose leaves obey the cap.

Each axis of a grid cell is cut ``2^MAX_LEVEL`` times finer; a point's two
indexes, their bits interleaved, are its Z-order code, and the points of a
tree node are those whose codes share a prefix: a run of the points sorted by
(cell, code).  The points are sorted and ranked once (``operators.ranks``),
and the tree follows from pairs of points ``cap`` ranks apart: the two share a
node exactly when that node holds more than ``cap`` points between them.  So
the common prefixes of all such pairs are the overfull nodes, at every depth
at once, with their intervals of ranks.

Nodes that hold more than ``cap`` points at more than one position are
divided.  Divided nodes are nested, so a point's leaf level is the number of
them whose interval covers its rank: a running sum over interval ends, taken
in segments of ``cap`` ranks, and one lookup by segment.  The input is
evaluated three times and shuffled once whatever the depth of the tree; what
follows moves codes and ranks, and tables of about rows / cap nodes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygrid.functions.cells import Grid
from skygrid.operators.positions import require_positions
from skygrid.operators.ranks import ROWS_PER_TASK, rank_rows
from skygrid.session import cut_lineage
from skygrid.sources.schema import DECL, RA

MAX_LEVEL = 30      # below it, cells are smaller than coordinates resolve
LEAF_KEYS = ("level", "leaf_i", "leaf_j")


def finest_index(x: str, lo: float, hi: float, n: int) -> Column:
    """The index of a coordinate among ``n * 2^MAX_LEVEL`` equal parts."""
    cells = n << MAX_LEVEL
    size = (hi - lo) / cells
    if size <= 0:
        return F.lit(0).cast("bigint")
    idx = F.floor((F.col(x) - F.lit(lo)) / F.lit(size)).cast("bigint")
    return F.least(F.lit(cells - 1).cast("bigint"), F.greatest(F.lit(0).cast("bigint"), idx))


def _spread(byte: int) -> int:
    """The bits of a byte with a zero between each two."""
    return sum((byte >> k & 1) << 2 * k for k in range(8))


def _spread_bits(x: Column) -> Column:
    table = F.lit([_spread(b) for b in range(256)])
    parts = [F.shiftleft(F.get(table, F.shiftright(x, 8 * k).bitwiseAND(255).cast("int")).cast("bigint"), 16 * k)
             for k in range(4)]
    return parts[0].bitwiseOR(parts[1]).bitwiseOR(parts[2]).bitwiseOR(parts[3])


def zorder(i: Column, j: Column) -> Column:
    """The Z-order code of two indexes of up to 30 bits: 60 bits, those of ``i`` first in each pair."""
    return F.shiftleft(_spread_bits(i), 1).bitwiseOR(_spread_bits(j))


def common_level(a: Column, b: Column) -> Column:
    """The deepest level at which two codes share their node."""
    differing = F.length(F.bin(a.bitwiseXOR(b)))        # '0' where they are equal
    return F.when(a == b, F.lit(MAX_LEVEL)).otherwise(
        F.expr(f"{MAX_LEVEL}") - F.shiftright(differing + 1, 1)).cast("int")


def _check(cap: int) -> None:
    if cap < 1:
        raise ValueError("cap must be positive")


def _sorted_points(positions: DataFrame, grid: Grid, ra: str, decl: str, rows_per_task: int) -> DataFrame:
    """``(row, x, y, fi, fj, cell, code, rank)``: points ranked along the Z-order curve of their cell."""
    z, low = grid.zone, F.lit((1 << MAX_LEVEL) - 1).cast("bigint")
    points = require_positions(positions, ra, decl)
    indexed = points.withColumns({"_fi": finest_index(ra, z.min_ra, z.max_ra, grid.n),
                                  "_fj": finest_index(decl, z.min_decl, z.max_decl, grid.n)})
    fi, fj = F.col("_fi"), F.col("_fj")
    coded = indexed.select(
        F.struct(*positions.columns).alias("row"), F.col(ra).alias("x"), F.col(decl).alias("y"),
        fi.alias("fi"), fj.alias("fj"),
        (F.shiftright(fi, MAX_LEVEL) * grid.n + F.shiftright(fj, MAX_LEVEL)).alias("cell"),
        zorder(fi.bitwiseAND(low), fj.bitwiseAND(low)).alias("code"))
    return rank_rows(coded, ["cell"], ["code", "x", "y"], rows_per_task)


def overfull_nodes(points: DataFrame, cap: int) -> DataFrame:
    """``(cell, level, prefix, first, last, divisible)`` of all nodes with more than ``cap`` points.

    ``points`` is ranked by :func:`_sorted_points`; ``first`` and ``last`` are
    the ranks of a node's points, ``divisible`` tells whether they have more
    than one position and may be cut further.
    """
    narrow = points.select("cell", "rank", "code", "x", "y")
    full = narrow.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cap)
    own = narrow.join(full.select("cell"), "cell", "left_semi")
    later = own.select("cell", (F.col("rank") - cap).alias("rank"), F.col("code").alias("code2"),
                       F.col("x").alias("x2"), F.col("y").alias("y2"))
    pairs = own.join(later, ["cell", "rank"]).select(
        "cell", "rank", "code", common_level(F.col("code"), F.col("code2")).alias("level"),
        ((F.col("x") != F.col("x2")) | (F.col("y") != F.col("y2"))).alias("apart"))
    ends = [F.min("first").alias("first"), F.max("last").alias("last"), F.max("apart").alias("apart")]
    deepest = pairs.select(
        "cell", "level", F.expr(f"shiftright(code, 2 * ({MAX_LEVEL} - level))").alias("prefix"),
        F.col("rank").alias("first"), (F.col("rank") + cap).alias("last"), "apart",
    ).groupBy("cell", "level", "prefix").agg(*ends)
    up = deepest.select("cell", F.explode(F.sequence(F.lit(0), F.col("level"))).alias("at"), "level", "prefix",
                        "first", "last", "apart")
    nodes = up.select("cell", F.col("at").alias("level"), F.expr("shiftright(prefix, 2 * (level - at))").alias("prefix"),
                      "first", "last", "apart").groupBy("cell", "level", "prefix").agg(*ends)
    return nodes.select("cell", "level", "prefix", "first", "last",
                        (F.col("apart") & (F.col("level") < MAX_LEVEL)).alias("divisible"))


def _level_runs(divided: DataFrame, cap: int) -> DataFrame:
    """``(cell, segment, start, stop, level)``: runs of ranks whose points have the same leaf level.

    Segments hold ``cap`` ranks; a divided node has more, so at most two of a
    level meet a segment, and a segment has a bounded number of runs.
    """
    segments = F.sequence(F.expr(f"(first - 1) div {cap}"), F.expr(f"(last - 1) div {cap}"))
    cut = divided.select("cell", "first", "last", F.explode(segments).alias("segment"))
    lo, hi = F.col("segment") * cap + 1, (F.col("segment") + 1) * cap + 1
    bounds = cut.select("cell", "segment", F.explode(F.array(
        F.struct(lo.alias("at"), F.lit(0).alias("step")),
        F.struct(F.greatest(lo, "first").alias("at"), F.lit(1).alias("step")),
        F.struct(F.least(hi, F.col("last") + 1).alias("at"), F.lit(-1).alias("step")))).alias("e"))
    steps = bounds.select("cell", "segment", "e.*").groupBy("cell", "segment", "at").agg(F.sum("step").alias("step"))
    order = Window.partitionBy("cell", "segment").orderBy("at")
    return steps.select(
        F.col("cell").alias("of"), F.col("segment").alias("of_segment"), F.col("at").alias("start"),
        F.lead("at", 1).over(order).alias("stop"),
        F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int").alias("level"))


def _leaf_name() -> Column:
    return F.concat(F.col("level").cast("string"), F.lit("/"), F.col("leaf_i").cast("string"), F.lit("."),
                    F.col("leaf_j").cast("string"))


def adaptive_split(positions: DataFrame, grid: Grid, cap: int, ra: str = RA, decl: str = DECL,
                   rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Adds ``level``, ``leaf_i``, ``leaf_j`` and ``leaf`` (``level/i.j``).

    Every leaf holds at most ``cap`` points, save one whose points all share
    one position, or can't be told apart at ``MAX_LEVEL`` (``indivisible`` in
    :func:`leaf_table`).
    """
    _check(cap)
    points = _sorted_points(positions, grid, ra, decl, rows_per_task)
    divided = cut_lineage(overfull_nodes(points, cap).where("divisible"), "nodes")
    runs = cut_lineage(_level_runs(divided, cap), "runs")
    rank = F.col("rank")
    here = ((F.col("cell") == F.col("of")) & (F.expr(f"(rank - 1) div {cap}") == F.col("of_segment"))
            & (rank >= F.col("start")) & (F.col("stop").isNull() | (rank < F.col("stop"))))
    placed = points.join(runs, here, "left").select(
        "row", F.coalesce("level", F.lit(0)).alias("level"), "fi", "fj")
    named = placed.select("row", "level", F.expr(f"shiftright(fi, {MAX_LEVEL} - level)").alias("leaf_i"),
                          F.expr(f"shiftright(fj, {MAX_LEVEL} - level)").alias("leaf_j"))
    return named.select("row.*", *LEAF_KEYS, _leaf_name().alias("leaf"))


def leaf_table(counts: DataFrame, grid: Grid, cap: int) -> DataFrame:
    """The leaves' names, boxes and ``indivisible`` from rows per leaf (``level, leaf_i, leaf_j, n_rows``)."""
    z = grid.zone
    side = F.pow(F.lit(2.0), F.col("level")) * F.lit(float(grid.n))
    width, height = F.lit(z.max_ra - z.min_ra) / side, F.lit(z.max_decl - z.min_decl) / side
    return counts.select(
        _leaf_name().alias("leaf"), *LEAF_KEYS,
        (F.lit(z.min_ra) + F.col("leaf_i") * width).alias("ra_lo"),
        (F.lit(z.min_ra) + (F.col("leaf_i") + 1) * width).alias("ra_hi"),
        (F.lit(z.min_decl) + F.col("leaf_j") * height).alias("decl_lo"),
        (F.lit(z.min_decl) + (F.col("leaf_j") + 1) * height).alias("decl_hi"),
        "n_rows", (F.col("n_rows") > cap).alias("indivisible"))


def adaptive_leaves(positions: DataFrame, grid: Grid, cap: int, ra: str = RA, decl: str = DECL) -> DataFrame:
    """The leaf table: ``leaf, level, leaf_i, leaf_j``, box, ``n_rows`` and ``indivisible``."""
    split = adaptive_split(positions.select(ra, decl), grid, cap, ra, decl)
    return leaf_table(split.groupBy(*LEAF_KEYS).agg(F.count(F.lit(1)).alias("n_rows")), grid, cap)
