"""Hierarchical triangular mesh: sky positions to nested spherical triangles.

Eight triangles, octants of the sphere, are divided in four by the midpoints
of their sides, level by level.  A triangle's id is its octant (8 to 15)
followed by two bits per level, so ids of a level are dense integers and the
id of an ancestor is a right shift.  Everything is a column expression: one
projection per level, with the corners of the current triangle as columns.

A point on a side belongs to the first of the triangles that share it, in the
order octant, child 0, 1, 2, 3; so every position, the poles and RA 0 and 360
included, has exactly one id at every level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.functions.cells import is_position

# Fixed values of the published mesh: the corners of the octahedron, and the
# corners of the octants 8 to 15 (S0 to S3, N0 to N3), counter-clockwise.
CORNERS = ((0, 0, 1), (1, 0, 0), (0, 1, 0), (-1, 0, 0), (0, -1, 0), (0, 0, -1))
OCTANTS = ((1, 5, 2), (2, 5, 3), (3, 5, 4), (4, 5, 1), (1, 0, 4), (4, 0, 3), (3, 0, 2), (2, 0, 1))

CATALOGUE_LEVEL = 20        # level of the catalogue's own index (see :func:`ancestor`)
MAX_LEVEL = 10              # triangles of about 0.1 degrees; more levels outgrow a Java method
# Bytecodes above which the JVM no longer compiles a method: longer chains of
# projections run one by one instead, three times as fast.
_METHOD_LIMIT = "8000"
_AXES = "xyz"


def _octant() -> str:
    """The number of the first octant that holds the point ``px, py, pz``."""
    return ("CASE WHEN pz <= 0 AND px >= 0 AND py >= 0 THEN 0 WHEN pz <= 0 AND px <= 0 AND py >= 0 THEN 1 "
            "WHEN pz <= 0 AND px <= 0 AND py <= 0 THEN 2 WHEN pz <= 0 THEN 3 WHEN px >= 0 AND py <= 0 THEN 4 "
            "WHEN px <= 0 AND py <= 0 THEN 5 WHEN px <= 0 AND py >= 0 THEN 6 ELSE 7 END")


def _corner(k: int, axis: int) -> str:
    """A coordinate of corner ``k`` of the octant."""
    whens = " ".join(f"WHEN {o} THEN {CORNERS[octant[k]][axis]}D" for o, octant in enumerate(OCTANTS[:-1]))
    return f"CASE octant {whens} ELSE {CORNERS[OCTANTS[-1][k]][axis]}D END AS {'uvw'[k]}{_AXES[axis]}"


def _side(a: str, b: str) -> str:
    """Whether the point lies left of the great circle from corner ``a`` to corner ``b``, or on it."""
    return (f"({a}y * {b}z - {a}z * {b}y) * px + ({a}z * {b}x - {a}x * {b}z) * py "
            f"+ ({a}x * {b}y - {a}y * {b}x) * pz >= 0")


def _divide(rows: DataFrame, keep: list[str]) -> DataFrame:
    """One level down: the child that holds the point, and its corners.

    Triangle ``u, v, w`` has the middles ``a, b, c`` of the sides opposite
    ``u``, ``v`` and ``w``; its children are ``ucb, vac, wba, abc``.
    """
    triangle = [v + axis for v in "uvw" for axis in _AXES]
    middles = [m + axis for m in "abc" for axis in _AXES]
    rows = rows.selectExpr(*keep, *triangle, *[f"{p}{axis} + {q}{axis} AS {m}{axis}"
                                               for m, p, q in ("avw", "buw", "cuv") for axis in _AXES])
    # Shortened by a power, not a division: it is never null.
    rows = rows.selectExpr(*keep, *triangle, *middles,
                           *[f"pow({m}x * {m}x + {m}y * {m}y + {m}z * {m}z, -0.5D) AS {m}n" for m in "abc"])
    rows = rows.selectExpr(*keep, *triangle, *[f"{m} * {m[0]}n AS {m}" for m in middles])
    rows = rows.selectExpr(*keep, *triangle, *middles, f"CASE WHEN {_side('c', 'b')} THEN 0 WHEN {_side('a', 'c')} THEN 1 "
                           f"WHEN {_side('b', 'a')} THEN 2 ELSE 3 END AS child")
    picked = [f"CASE child WHEN 0 THEN {s[0]}{axis} WHEN 1 THEN {s[1]}{axis} WHEN 2 THEN {s[2]}{axis} "
              f"ELSE {s[3]}{axis} END AS {v}{axis}"
              for v, s in (("u", "uvwa"), ("v", "cabb"), ("w", "bcac")) for axis in _AXES]
    return rows.selectExpr(*[c for c in keep if c != "htm"], "shiftleft(htm, 2) + child AS htm", *picked)


def with_htm(points: DataFrame, level: int, ra: str, decl: str, name: str = "htm_id") -> DataFrame:
    """``points`` with the id of the triangle of ``level`` (0 to 10) that holds each position.

    A position that is null or not finite has no id (null).
    """
    if not 0 <= level <= MAX_LEVEL:
        raise ValueError(f"level must be within 0 and {MAX_LEVEL}")
    points.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", _METHOD_LIMIT)
    placed = is_position(ra) & is_position(decl)
    rows = points.select(F.struct(*points.columns).alias("row"), placed.alias("placed"),
                         *[F.coalesce(F.when(placed, F.radians(c)), F.lit(0.0)).alias(n) for c, n in ((ra, "a"), (decl, "d"))])
    rows = rows.selectExpr("row", "placed", "cos(d) * cos(a) AS px", "cos(d) * sin(a) AS py", "sin(d) AS pz")
    rows = rows.selectExpr("row", "placed", "px", "py", "pz", f"{_octant()} AS octant")
    keep = ["row", "placed", "px", "py", "pz", "htm"]
    rows = rows.selectExpr(*keep[:-1], "CAST(octant + 8 AS BIGINT) AS htm",
                           *[_corner(k, axis) for k in range(3) for axis in range(3)])
    for _ in range(level):
        rows = _divide(rows, keep)
    # A zero that counts as non-deterministic: a filter on the id stays above
    # the levels, where it would be rewritten in terms of the position, each
    # level several times as long as the one above.
    zero = F.shiftright(F.spark_partition_id(), 31)
    return rows.select("row.*", F.when(F.col("placed"), F.col("htm") + zero).alias(name))


def ancestor(htm: Column, level: int, of: int = CATALOGUE_LEVEL) -> Column:
    """The id at ``level`` of a triangle of level ``of``."""
    return F.shiftright(htm, 2 * (of - level))
