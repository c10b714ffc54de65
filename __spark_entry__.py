"""


Catalogue queries run on the ``sky`` view derived from ``events`` (see
``skygrid.sources.catalogue.sky_from_events``); text queries run on
``documents.text``.  Queries that exercise a file sink or scan write to a
fresh folder below ``spark.checkpoint.dir`` and read it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.functions.cells import BLOCK_BYTES, make_grid
from skygrid.functions.coords import format_record, unwrap_ra
from skygrid.functions.htm import CORNERS, OCTANTS
from skygrid.operators.summary import (zone_of, bounding_zone, bounding_zone_wrapped, count_by_object,
                                       count_lines_containing, object_extent, zone_description)
from skygrid.operators.loads import merged_loads, write_load
from skygrid.operators.tiles import tile_table
from skygrid.operators.grid import assign_exclusive, assign_stripes, cell_histogram, grid_cells
from skygrid.plans import jobs
from skygrid.plans.partitioning import region_lookup, run_partitioning
from skygrid.plans.text import document_lines
from skygrid.session import fresh_dir
from skygrid.operators.regions import region_pairs, write_regions
from skygrid.sources.catalogue import (read_checked_sources, read_lines, read_sources, sky, source_lines, table,
                                       write_source_files)
from skygrid.sources.sinks import (input_size, min_cells_for_input, min_cells_from_size, read_by_cell,
                                   write_by_cell, write_text)
from skygrid.sources.schema import DECL, OBJECT_ID, RA, SOURCE_ID

SMOKE_DIR = "/root/testdata/sf0.001"

# Query parameters (fixed for the registered queries).
CAP = 100            # per-cell capacity for the capped-partition queries
ADAPTIVE_CAP = 100   # leaf capacity of the quad-tree split
SIZED_BLOCK = 1 << 16  # bytes per cell of the grid sized from the input
EPS = 0.02           # neighbour distance, degrees
HTM_LEVEL = 4        # triangles of about 6 degrees
BOX = (359.2, 0.9, -3.0, 2.5)   # RA from, to (across 0), Decl from, to


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the per-cell histogram of the 7 x 7 exclusive grid."""
    return jobs.exclusive_histogram(sky(spark, SMOKE_DIR))


# ----------------------------------------------------------------------------
# Spark queries

def _text_scan(spark, d):
    path = fresh_dir(spark, "text")
    write_text(table(spark, d, "documents").where(F.col("text").isNotNull()), path, "text")
    return read_lines(spark, path)


def _source_scan(spark, d):
    path = fresh_dir(spark, "sources")
    write_source_files(sky(spark, d), path)
    return read_sources(spark, path).select(SOURCE_ID, OBJECT_ID, RA, DECL)


def _lines_containing(spark, d):
    return count_lines_containing(document_lines(table(spark, d, "documents")))


def _sink_text(spark, d):
    path = fresh_dir(spark, "counts")
    counts = count_by_object(sky(spark, d))
    write_text(counts.select(format_record(OBJECT_ID, "n_sources").alias("value")), path)
    parts = F.split(F.col("value"), ",")
    return read_lines(spark, path).select(parts[0].cast("bigint").alias(OBJECT_ID),
                                          parts[1].cast("bigint").alias("n_sources"))


def _sink_by_cell(spark, d):
    path = fresh_dir(spark, "cells")
    pts, grid = jobs.exclusive_grid(sky(spark, d))
    write_by_cell(assign_exclusive(pts, grid).select(SOURCE_ID, RA, DECL, "cell_i", "cell_j"), path)
    return (read_by_cell(spark, path).groupBy("cell_i", "cell_j")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min(SOURCE_ID).alias("min_source_id"),
                 F.max(SOURCE_ID).alias("max_source_id"), F.min(RA).alias("min_ra"),
                 F.max(DECL).alias("max_decl")))


def _written_back(spark, rows, keys, within=()):
    path = fresh_dir(spark, "regions")
    write_by_cell(rows, path, keys=keys, within=within, arranged=bool(within))
    return (read_by_cell(spark, path, keys=keys).groupBy(*keys, *within)
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min(SOURCE_ID).alias("min_source_id"),
                 F.max(SOURCE_ID).alias("max_source_id"), F.min(RA).alias("min_ra"), F.max(DECL).alias("max_decl")))


def _sink_by_stripe(spark, d):
    return _written_back(spark, assign_stripes(sky(spark, d)).select(SOURCE_ID, RA, DECL, "stripe"), ("stripe",))


def _sink_by_capped_cell(spark, d):
    rows = jobs.capped_overlap(sky(spark, d), CAP).select(
        SOURCE_ID, unwrap_ra(RA).alias(RA), DECL, "cell_i", "cell_j", "segment")
    return _written_back(spark, rows, ("cell_i", "cell_j"), within=("segment",))


def _source_errors(spark, d):
    """A catalogue with malformed, missing, surplus and cut fields: the verdicts of every row, by its line."""
    path, e = fresh_dir(spark, "dirty"), F.col(SOURCE_ID)

    def field(c, bad):
        return F.when(bad, F.concat(F.lit("x"), F.col(c).cast("string"))).otherwise(F.col(c).cast("string")).alias(c)
    dirty = sky(spark, d).select(
        F.when(e % 11 == 4, "NULL").otherwise(field(SOURCE_ID, e % 11 == 2)).alias(SOURCE_ID),
        field(OBJECT_ID, e % 7 == 3), field(RA, e % 13 == 5), F.col(DECL).cast("string"), e.alias("line"))
    lines = source_lines(dirty, ["line"]).select(
        F.when(F.col("line") % 17 == 1, F.concat("value", F.lit(",surplus")))
        .when(F.col("line") % 17 == 2, F.substring_index("value", ",", 20)).otherwise(F.col("value")).alias("value"))
    write_text(lines, path)
    checked = read_checked_sources(spark, path)
    said = F.concat(F.col("error.field"), F.lit(" "), F.col("error.reason"))
    return (checked.select(F.col(DECL).alias(DECL), F.explode_outer("errors").alias("error"))
            .groupBy(F.coalesce(said, F.lit("good")).alias("verdict"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min(DECL).alias("min_decl"), F.max(DECL).alias("max_decl")))


def _count_good_objects(spark, d):
    """Observations per object from a catalogue with bad lines: what is counted, and what is set aside."""
    path, e = fresh_dir(spark, "dirty"), F.col(SOURCE_ID)
    dirty = sky(spark, d).select(
        SOURCE_ID, F.when(e % 9 == 4, F.concat(F.lit("x"), F.col(OBJECT_ID).cast("string")))
        .otherwise(F.col(OBJECT_ID).cast("string")).alias(OBJECT_ID), RA, DECL)
    write_text(source_lines(dirty), path)
    # The lines are read once for both: what is set aside counts under a key without an object.
    aside = F.struct(F.lit(None).cast("bigint").alias(OBJECT_ID))
    counted = read_checked_sources(spark, path).select(
        F.when(F.col("reject").isNotNull(), aside).when(F.col(OBJECT_ID).isNotNull(), F.struct(OBJECT_ID)).alias("counted"))
    return count_by_object(counted, "counted").select(f"counted.{OBJECT_ID}", "n_sources")


def _merged_loads(spark, d):
    """Three loads, the second written twice, merged from their summaries."""
    path, load = fresh_dir(spark, "loads"), F.pmod(F.col(SOURCE_ID), F.lit(3))
    for k in (0, 1, 2, 1):
        write_load(sky(spark, d).where(load == k), path, f"night-{k}")
    return merged_loads(spark, path)


def _region_lookup(spark, d):
    """A box across RA 0, from the directories of a written overlapping grid."""
    path = fresh_dir(spark, "catalogue")
    write_source_files(sky(spark, d), path)
    res = run_partitioning(spark, path, fresh_dir(spark, "grid"), mode="overlap", cap=CAP)
    return region_lookup(spark, res, *BOX)


def _region_pairs(spark, d):
    """Pairs from regions that were written, joined bucket by bucket."""
    pts, grid = jobs.overlap_grid(sky(spark, d))
    return region_pairs(spark, write_regions(pts, grid, fresh_dir(spark, "regions")), EPS)


def _source_rejects(spark, d):
    """A catalogue with a known share of bad lines, every row read back with its verdict."""
    path, e = fresh_dir(spark, "dirty"), F.col(SOURCE_ID)
    dirty = sky(spark, d).select(
        SOURCE_ID, OBJECT_ID,
        F.when(e % 10 == 3, "abc").when(e % 10 == 7, F.lit(None)).otherwise(F.col(RA).cast("string")).alias(RA),
        F.when(e % 10 == 5, "NaN").otherwise(F.col(DECL).cast("string")).alias(DECL))
    write_text(source_lines(dirty), path)
    return read_checked_sources(spark, path).select(
        SOURCE_ID, "reject", F.when(F.col("reject").isNull(), F.col(RA)).alias(RA),
        F.when(F.col("reject").isNull(), F.col(DECL)).alias(DECL))


def _grid_from_size(spark, d):
    """The grid whose cells hold at most one block of the written catalogue."""
    path = fresh_dir(spark, "catalogue")
    write_source_files(sky(spark, d), path)
    cells = min_cells_for_input(spark, path, SIZED_BLOCK)
    zone = zone_of(read_sources(spark, path).select(RA, DECL))
    return grid_cells(spark, make_grid(zone, cells, ceiling=max(cells, 1)))


def _extent_records(spark, d):
    path = fresh_dir(spark, "extent")
    ext = object_extent(sky(spark, d))
    write_text(ext.select(format_record(OBJECT_ID, "n_sources", "last_source_id", "min_ra", "max_ra",
                                        "min_decl", "max_decl").alias("value")), path)
    return read_lines(spark, path).select(F.col("value").alias("record"))


def _min_cells(spark, d):
    path = fresh_dir(spark, "catalogue")
    write_source_files(sky(spark, d), path)
    size = input_size(spark, path)
    return min_cells_from_size(size.select("total_bytes"), BLOCK_BYTES)


def _format_record(spark, d):
    return sky(spark, d).select(SOURCE_ID, format_record(RA, DECL).alias("record"))


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The sky-catalogue queries, without those of the optional ``llm`` subpackage."""
    return {
        "text_scan": _text_scan,
        "source_scan": _source_scan,
        "lines_containing": _lines_containing,
        "count_by_object": lambda s, d: count_by_object(sky(s, d)),
        "object_extent": lambda s, d: object_extent(sky(s, d)),
        "bounding_zone": lambda s, d: bounding_zone(sky(s, d)),
        "bounding_zone_wrapped": lambda s, d: bounding_zone_wrapped(sky(s, d)),
        "zone_text": lambda s, d: zone_description(bounding_zone(sky(s, d))),
        "sky_positions": lambda s, d: jobs.positions(sky(s, d)),
        "positions_wrapped": lambda s, d: jobs.wrapped(sky(s, d)),
        "positions_unwrapped": lambda s, d: jobs.wrapped(sky(s, d)).select(
            SOURCE_ID, unwrap_ra(RA).alias(RA), DECL),
        "format_record": _format_record,
        "grid_cells": lambda s, d: grid_cells(s, jobs.overlap_grid(sky(s, d))[1]),
        "grid_assign": lambda s, d: jobs.grid_assign(sky(s, d)),
        "grid_assign_wrapped": lambda s, d: jobs.grid_assign(sky(s, d), wrap=True),
        "cell_histogram": lambda s, d: jobs.exclusive_histogram(sky(s, d)),
        "grid_assign_overlap": lambda s, d: jobs.overlap_assign(sky(s, d)).select(
            SOURCE_ID, "cell_i", "cell_j", "cell"),
        "cell_capacity_split": lambda s, d: jobs.capped_overlap(sky(s, d), CAP).select(
            SOURCE_ID, "cell_i", "cell_j", "segment", "cell"),
        "capped_histogram": lambda s, d: jobs.capped_histogram(sky(s, d), CAP),
        "stripe_assign": lambda s, d: assign_stripes(sky(s, d).select(SOURCE_ID, RA)).select(
            SOURCE_ID, "stripe"),
        "partition_exclusive": lambda s, d: jobs.partition_exclusive(sky(s, d)),
        "partition_overlap": lambda s, d: jobs.partition_overlap(sky(s, d)),
        "partition_stripe": lambda s, d: jobs.partition_stripe(sky(s, d)),
        "sink_text": _sink_text,
        "sink_by_cell": _sink_by_cell,
        "sink_by_stripe": _sink_by_stripe,
        "sink_by_capped_cell": _sink_by_capped_cell,
        "source_rejects": _source_rejects,
        "extent_records": _extent_records,
        "neighbour_pairs": lambda s, d: jobs.pairs_planar(sky(s, d), EPS),
        "region_pairs": _region_pairs,
        "neighbour_pairs_sphere": lambda s, d: jobs.pairs_sphere(sky(s, d), EPS),
        "grid_metadata": lambda s, d: jobs.grid_metadata(sky(s, d), CAP),
        "min_cells": _min_cells,
        "grid_from_size": _grid_from_size,
        "adaptive_split": lambda s, d: jobs.adaptive_assign(sky(s, d), ADAPTIVE_CAP),
        "adaptive_cells": lambda s, d: jobs.adaptive_cells(sky(s, d), ADAPTIVE_CAP),
        "htm_assign": lambda s, d: jobs.htm_assign(sky(s, d), HTM_LEVEL),
        "region_lookup": _region_lookup,
        "kd_assign": lambda s, d: jobs.kd_assign(sky(s, d)).select(SOURCE_ID, "slab", "tile"),
        "kd_cells": lambda s, d: tile_table(jobs.kd_assign(sky(s, d))),
        "merged_loads": _merged_loads,
        "source_errors": _source_errors,
        "count_good_objects": _count_good_objects,
    }


# ----------------------------------------------------------------------------
# DuckDB oracle

_SKY = """sky AS (
  SELECT source_id AS "sourceId", object_id AS "objectId",
         CASE WHEN k < 2000
              THEN CAST(358 AS DOUBLE) + CAST(k AS DOUBLE) / CAST(1000 AS DOUBLE)
              ELSE CAST(k - 2000 AS DOUBLE) / CAST(1000 AS DOUBLE) END AS ra,
         CAST(m AS DOUBLE) / CAST(1000 AS DOUBLE) - CAST(7 AS DOUBLE) AS decl
  FROM (SELECT event_id AS source_id,
               CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS object_id,
               (event_id * 7919 + user_id * 37) % 4000 AS k,
               (event_id * 104729 + user_id * 13) % 14000 AS m
        FROM events) e)"""

_WRAPPED = """wrapped AS (
  SELECT "sourceId", CASE WHEN ra > CAST(180 AS DOUBLE) THEN ra - CAST(360 AS DOUBLE) ELSE ra END AS ra,
         decl FROM sky)"""

_N = 7  # grid side for 40 minimum cells
_HALO = "CAST(0.1 AS DOUBLE)"


def _jstr(x: str) -> str:
    """Java's Double.toString text for |x| >= 1e-4 (the data's range)."""
    return f"""(CASE WHEN {x} = 0 THEN '0.0'
      WHEN abs({x}) >= CAST(0.001 AS DOUBLE) THEN CAST({x} AS VARCHAR)
      ELSE (CASE WHEN {x} < 0 THEN '-' ELSE '' END)
           || substr(regexp_replace(CAST(abs({x}) AS VARCHAR), '^0\\.000', ''), 1, 1) || '.'
           || coalesce(nullif(substr(regexp_replace(CAST(abs({x}) AS VARCHAR), '^0\\.000', ''), 2), ''), '0')
           || 'E-4' END)"""


def _zone(src: str) -> str:
    return f"""z AS (SELECT min(ra) AS x0, max(ra) AS x1, min(decl) AS y0, max(decl) AS y1 FROM {src})"""


def _bp_index(x: str, lo: str, hi: str) -> str:
    """Breakpoints below x, counted in their explicit list; at most n."""
    points = ", ".join(f"{lo} + CAST({k} AS DOUBLE) * (({hi} - {lo}) / CAST({_N} AS DOUBLE))" for k in range(_N + 1))
    return f"CAST(least({_N}, len(list_filter([{points}], lambda b: b < {x}))) AS INTEGER)"


def _excl(src: str) -> str:
    """Exclusive cell assignment of ``src`` (needs CTE z)."""
    return f"""excl AS (
  SELECT p.*, ci AS cell_i,
         CASE WHEN ci = 0 THEN 0 ELSE {_bp_index('decl', 'y0', 'y1')} END AS cell_j
  FROM (SELECT s.*, z.*, {_bp_index('ra', 'x0', 'x1')} AS ci FROM {src} s, z) p)"""


def _overlap() -> str:
    """Halo membership on the wrapped positions, by full cells x points product."""
    n = f"CAST({_N} AS DOUBLE)"
    return f"""cells AS (
  SELECT CAST(a.i AS INTEGER) AS cell_i, CAST(b.j AS INTEGER) AS cell_j
  FROM range(0, {_N}) a(i), range(0, {_N}) b(j)),
ov AS (
  SELECT w."sourceId", w.ra, w.decl, c.cell_i, c.cell_j,
         CAST(c.cell_i AS VARCHAR) || '.' || CAST(c.cell_j AS VARCHAR) AS cell
  FROM wrapped w, cells c, z
  WHERE w.ra >= (x0 + CAST(c.cell_i AS DOUBLE) * ((x1 - x0) / {n})) - {_HALO}
    AND w.ra <= (x0 + CAST(c.cell_i + 1 AS DOUBLE) * ((x1 - x0) / {n})) + {_HALO}
    AND w.decl >= (y0 + CAST(c.cell_j AS DOUBLE) * ((y1 - y0) / {n})) - {_HALO}
    AND w.decl <= (y0 + CAST(c.cell_j + 1 AS DOUBLE) * ((y1 - y0) / {n})) + {_HALO})"""


def _capped(cap: int) -> str:
    return f"""capped AS (
  SELECT "sourceId", ra, decl, cell_i, cell_j, seg AS segment, cell || repeat('bis', seg) AS cell
  FROM (SELECT *, CAST((row_number() OVER (PARTITION BY cell_i, cell_j ORDER BY "sourceId") - 1)
                       // {cap} AS INTEGER) AS seg FROM ov) t)"""


def _stripes(src: str) -> str:
    """Points joined with the stripes' arcs, widened by a degree around the circle.

    RA 0 lies before the first border: in stripe 0, and near stripe 1.
    """
    return f"""arcs AS (SELECT CAST(k AS INTEGER) AS stripe, (k - 1) * 9 - 1 AS a, k * 9 + 1 AS b FROM range(1, 41) r(k)),
stripes AS (
  SELECT s.*, stripe FROM {src} s JOIN arcs
    ON s.ra BETWEEN a AND b OR s.ra - 360 BETWEEN a AND b OR (s.ra > 0 AND s.ra + 360 BETWEEN a AND b)
  UNION ALL
  SELECT s.*, 0 AS stripe FROM {src} s WHERE s.ra = 0)"""


def _lines() -> str:
    return r"""lines AS (
  SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS value
  FROM documents WHERE text IS NOT NULL)"""


def _adaptive(cap: int) -> str:
    """Each point's coarsest ancestor, of all 31 levels, that the cap (or one single position) allows."""
    top = 30
    part = lambda c, lo, hi: (f"least({(_N << top) - 1}, greatest(0, CAST(floor((w.{c} - {lo}) / "  # noqa: E731
                              f"(({hi} - {lo}) / CAST({_N << top} AS DOUBLE))) AS BIGINT)))")
    return f"""fine AS (SELECT w.*, {part('ra', 'x0', 'x1')} AS fi, {part('decl', 'y0', 'y1')} AS fj FROM wrapped w, z),
anc AS (SELECT "sourceId", ra, decl, CAST(l.level AS INTEGER) AS level,
               fi >> CAST({top} - l.level AS INTEGER) AS leaf_i, fj >> CAST({top} - l.level AS INTEGER) AS leaf_j
        FROM fine, range(0, {top + 1}) l(level)),
ac AS (SELECT level, leaf_i, leaf_j, count(*) AS n_rows, min(ra) = max(ra) AND min(decl) = max(decl) AS single
       FROM anc GROUP BY level, leaf_i, leaf_j),
leaf AS (SELECT "sourceId", min(level) AS level FROM anc JOIN ac USING (level, leaf_i, leaf_j)
         WHERE n_rows <= {cap} OR single OR level = {top} GROUP BY "sourceId"),
pl AS (SELECT anc.*, CAST(level AS VARCHAR) || '/' || CAST(leaf_i AS VARCHAR) || '.' || CAST(leaf_j AS VARCHAR) AS leaf
       FROM anc JOIN leaf USING ("sourceId", level))"""


def _catalogue_bytes() -> str:
    """The size of the written catalogue, from its lines."""
    return f"""t AS (SELECT sum(length(line) + 1) AS total_bytes FROM (
  SELECT CAST("sourceId" AS VARCHAR) || ',NULL,NULL,' || coalesce(CAST("objectId" AS VARCHAR), 'NULL')
         || ',NULL,NULL,' || {_jstr('ra')} || ',NULL,NULL,' || {_jstr('decl')}
         || repeat(',NULL', 97) AS line FROM sky) s)"""


def _pairs(eps: str) -> str:
    """All pairs closer than eps, by Decl zones."""
    return f"""WITH {_SKY}, {_WRAPPED},
b AS (SELECT *, CAST(floor(decl / {eps}) AS BIGINT) AS zb FROM wrapped)
SELECT p."sourceId" AS id_a, q."sourceId" AS id_b,
       sqrt((q.ra - p.ra) * (q.ra - p.ra) + (q.decl - p.decl) * (q.decl - p.decl)) AS separation
FROM b p JOIN b q ON q.zb BETWEEN p.zb - 1 AND p.zb + 1 AND p."sourceId" < q."sourceId"
WHERE sqrt((q.ra - p.ra) * (q.ra - p.ra) + (q.decl - p.decl) * (q.decl - p.decl)) < {eps}"""


def _tiles(cells: int) -> str:
    """Equal-load cells by plain row numbers."""
    import math
    slabs = math.ceil(math.sqrt(cells))
    tiles = math.ceil(cells / slabs)
    return f"""s AS (SELECT *, CAST((row_number() OVER (ORDER BY ra, decl, "sourceId") - 1) * {slabs}
  // count(*) OVER () AS INTEGER) AS slab FROM wrapped),
tiled AS (SELECT "sourceId", ra, decl, slab, CAST((row_number() OVER (PARTITION BY slab ORDER BY decl, ra, "sourceId") - 1) * {tiles}
  // count(*) OVER (PARTITION BY slab) AS INTEGER) AS tile FROM s)"""


def _htm_sql(level: int) -> str:
    """Every triangle of the level against every point; the first that holds it."""
    corners, octants = CORNERS, OCTANTS
    first = " UNION ALL ".join(
        "SELECT CAST({} AS BIGINT) AS id, ".format(8 + o) + ", ".join(
            f"CAST({corners[t[k]][a]} AS DOUBLE) AS {'uvw'[k]}{'xyz'[a]}" for k in range(3) for a in range(3))
        for o, t in enumerate(octants))

    def middle(p: str, q: str) -> str:
        n = " + ".join(f"({p}{a} + {q}{a}) * ({p}{a} + {q}{a})" for a in "xyz")
        return ", ".join(f"({p}{a} + {q}{a}) * pow({n}, CAST(-0.5 AS DOUBLE)) AS {{}}{a}" for a in "xyz")
    mids = ", ".join([middle("v", "w").replace("{}", "m1"), middle("u", "w").replace("{}", "m2"),
                      middle("u", "v").replace("{}", "m3")])
    levels = [f"t0 AS ({first})"]
    for k in range(level):
        kids = " UNION ALL ".join(
            f"SELECT id * 4 + {n}, " + ", ".join(f"{c}{a} AS {'uvw'[i]}{a}" for i, c in enumerate(corner) for a in "xyz")
            + f" FROM m{k}" for n, corner in enumerate(
                (("u", "m3", "m2"), ("v", "m1", "m3"), ("w", "m2", "m1"), ("m1", "m2", "m3"))))
        kids = kids.replace("id * 4 + 0,", "id * 4 + 0 AS id,")
        levels += [f"m{k} AS (SELECT *, {mids} FROM t{k})", f"t{k + 1} AS MATERIALIZED ({kids})"]

    def side(a: str, b: str) -> str:
        return (f"({a}y * {b}z - {a}z * {b}y) * px + ({a}z * {b}x - {a}x * {b}z) * py "
                f"+ ({a}x * {b}y - {a}y * {b}x) * pz >= 0")
    return f"""WITH {_SKY}, {', '.join(levels)},
p AS MATERIALIZED (SELECT "sourceId", cos(radians(decl)) * cos(radians(ra)) AS px,
  cos(radians(decl)) * sin(radians(ra)) AS py, sin(radians(decl)) AS pz FROM sky)
SELECT "sourceId", min(id) AS htm_id FROM p JOIN t{level} t
  ON {side('u', 'v')} AND {side('v', 'w')} AND {side('w', 'u')} GROUP BY "sourceId" """


def core_oracle_sql() -> dict[str, str]:
    n = f"CAST({_N} AS DOUBLE)"
    hist = """SELECT cell_i, cell_j, CAST(cell_i AS VARCHAR) || '.' || CAST(cell_j AS VARCHAR) AS cell,
       count(*) AS n_rows, repeat('*', CAST(ceil(log10(CAST(count(*) AS DOUBLE))) AS INTEGER)) AS bar
FROM excl GROUP BY cell_i, cell_j"""
    eps = f"CAST({EPS} AS DOUBLE)"
    import math
    thr = repr(math.sin(math.radians(EPS) / 2.0) ** 2)
    return {
        "text_scan": f"WITH {_lines()} SELECT value FROM lines",
        "source_scan": f"""WITH {_SKY} SELECT "sourceId", "objectId", ra, decl FROM sky""",
        "lines_containing": f"""WITH {_lines()}
SELECT count(*) FILTER (WHERE contains(value, 'a')) AS lines_with_a,
       count(*) FILTER (WHERE contains(value, 'b')) AS lines_with_b FROM lines""",
        "count_by_object": f"""WITH {_SKY}
SELECT "objectId", count(*) AS n_sources FROM sky WHERE "objectId" IS NOT NULL GROUP BY "objectId" """,
        "object_extent": f"""WITH {_SKY}
SELECT "objectId", count(*) AS n_sources, max(CAST("sourceId" AS VARCHAR)) AS last_source_id,
       min(ra) AS min_ra, max(ra) AS max_ra, min(decl) AS min_decl, max(decl) AS max_decl
FROM sky WHERE "objectId" IS NOT NULL GROUP BY "objectId" """,
        "bounding_zone": f"""WITH {_SKY}
SELECT min(ra) AS min_ra, max(ra) AS max_ra, min(decl) AS min_decl, max(decl) AS max_decl FROM sky""",
        "bounding_zone_wrapped": f"""WITH {_SKY}, {_WRAPPED}
SELECT min(ra) AS min_ra, max(ra) AS max_ra, min(decl) AS min_decl, max(decl) AS max_decl FROM wrapped""",
        "zone_text": f"""WITH {_SKY}
SELECT printf('minRA : %f, maxRA : %f, minDecl : %f, maxDecl : %f', min(ra), max(ra), min(decl), max(decl)) AS zone
FROM sky""",
        "sky_positions": f"WITH {_SKY} SELECT ra, decl FROM sky",
        "positions_wrapped": f"""WITH {_SKY}, {_WRAPPED} SELECT "sourceId", ra, decl FROM wrapped""",
        "positions_unwrapped": f"""WITH {_SKY}, {_WRAPPED}
SELECT "sourceId", CASE WHEN ra < CAST(0 AS DOUBLE) THEN ra + CAST(360 AS DOUBLE) ELSE ra END AS ra, decl
FROM wrapped""",
        "format_record": f"""WITH {_SKY}
SELECT "sourceId", {_jstr('ra')} || ',' || {_jstr('decl')} AS record FROM sky""",
        "grid_cells": f"""WITH {_SKY}, {_WRAPPED}, {_zone('wrapped')}
SELECT CAST(a.i AS INTEGER) AS cell_i, CAST(b.j AS INTEGER) AS cell_j,
       CAST(a.i AS VARCHAR) || '.' || CAST(b.j AS VARCHAR) AS cell,
       x0 + CAST(a.i AS DOUBLE) * ((x1 - x0) / {n}) AS ra_lo,
       x0 + CAST(a.i + 1 AS DOUBLE) * ((x1 - x0) / {n}) AS ra_hi,
       y0 + CAST(b.j AS DOUBLE) * ((y1 - y0) / {n}) AS decl_lo,
       y0 + CAST(b.j + 1 AS DOUBLE) * ((y1 - y0) / {n}) AS decl_hi
FROM range(0, {_N}) a(i), range(0, {_N}) b(j), z""",
        "grid_assign": f"""WITH {_SKY}, {_zone('sky')}, {_excl('sky')}
SELECT "sourceId", cell_i, cell_j, CAST(cell_i AS VARCHAR) || '.' || CAST(cell_j AS VARCHAR) AS cell FROM excl""",
        "grid_assign_wrapped": f"""WITH {_SKY}, {_WRAPPED}, {_zone('wrapped')}, {_excl('wrapped')}
SELECT "sourceId", cell_i, cell_j, CAST(cell_i AS VARCHAR) || '.' || CAST(cell_j AS VARCHAR) AS cell FROM excl""",
        "cell_histogram": f"WITH {_SKY}, {_zone('sky')}, {_excl('sky')} {hist}",
        "grid_assign_overlap": f"""WITH {_SKY}, {_WRAPPED}, {_zone('wrapped')}, {_overlap()}
SELECT "sourceId", cell_i, cell_j, cell FROM ov""",
        "cell_capacity_split": f"""WITH {_SKY}, {_WRAPPED}, {_zone('wrapped')}, {_overlap()}, {_capped(CAP)}
SELECT "sourceId", cell_i, cell_j, segment, cell FROM capped""",
        "capped_histogram": f"""WITH {_SKY}, {_WRAPPED}, {_zone('wrapped')}, {_overlap()}, {_capped(CAP)}
SELECT cell_i, cell_j, segment, cell, count(*) AS n_rows,
       repeat('*', CAST(ceil(log10(CAST(count(*) AS DOUBLE))) AS INTEGER)) AS bar
FROM capped GROUP BY cell_i, cell_j, segment, cell""",
        "stripe_assign": f"""WITH {_SKY}, {_stripes('sky')} SELECT "sourceId", stripe FROM stripes""",
        "partition_exclusive": f"""WITH {_SKY}, {_zone('sky')}, {_excl('sky')}
SELECT cell_i, cell_j, CAST(cell_i AS VARCHAR) || '.' || CAST(cell_j AS VARCHAR) AS cell,
       {_jstr('ra')} || ',' || {_jstr('decl')} AS record FROM excl""",
        "partition_overlap": f"""WITH {_SKY}, {_WRAPPED}, {_zone('wrapped')}, {_overlap()}, {_capped(10000)},
un AS (SELECT cell_i, cell_j, segment, cell,
              CASE WHEN ra < CAST(0 AS DOUBLE) THEN ra + CAST(360 AS DOUBLE) ELSE ra END AS ura, decl
       FROM capped)
SELECT cell_i, cell_j, segment, cell, {_jstr('ura')} || ',' || {_jstr('decl')} AS record FROM un""",
        "partition_stripe": f"""WITH {_SKY}, {_stripes('sky')}
SELECT stripe, {_jstr('ra')} || ',' || {_jstr('decl')} AS record FROM stripes""",
        "sink_text": f"""WITH {_SKY}
SELECT "objectId", count(*) AS n_sources FROM sky WHERE "objectId" IS NOT NULL GROUP BY "objectId" """,
        "extent_records": f"""WITH {_SKY},
e AS (SELECT "objectId", count(*) AS n, max(CAST("sourceId" AS VARCHAR)) AS last_src,
             min(ra) AS min_ra, max(ra) AS max_ra, min(decl) AS min_decl, max(decl) AS max_decl
      FROM sky WHERE "objectId" IS NOT NULL GROUP BY "objectId")
SELECT CAST("objectId" AS VARCHAR) || ',' || CAST(n AS VARCHAR) || ',' || last_src || ','
       || {_jstr('min_ra')} || ',' || {_jstr('max_ra')} || ','
       || {_jstr('min_decl')} || ',' || {_jstr('max_decl')} AS record FROM e""",
        "sink_by_cell": f"""WITH {_SKY}, {_zone('sky')}, {_excl('sky')}
SELECT cell_i, cell_j, count(*) AS n_rows, min("sourceId") AS min_source_id, max("sourceId") AS max_source_id,
       min(ra) AS min_ra, max(decl) AS max_decl FROM excl GROUP BY cell_i, cell_j""",
        "neighbour_pairs": _pairs(eps),
        "region_pairs": _pairs(eps),
        "neighbour_pairs_sphere": f"""WITH {_SKY},
b AS (SELECT *, CAST(floor(decl / {eps}) AS BIGINT) AS zb FROM sky)
SELECT p."sourceId" AS id_a, q."sourceId" AS id_b
FROM b p JOIN b q ON q.zb BETWEEN p.zb - 1 AND p.zb + 1 AND p."sourceId" < q."sourceId"
WHERE pow(sin((radians(q.decl) - radians(p.decl)) / CAST(2 AS DOUBLE)), 2)
      + cos(radians(p.decl)) * cos(radians(q.decl)) * pow(sin((radians(q.ra) - radians(p.ra)) / CAST(2 AS DOUBLE)), 2)
      < CAST({thr} AS DOUBLE)""",
        "grid_metadata": f"""WITH {_SKY}, {_WRAPPED}, {_zone('wrapped')}, {_overlap()},
m AS (SELECT cell_i, cell_j, count(*) AS members FROM ov GROUP BY cell_i, cell_j)
SELECT c.cell_i, c.cell_j, CAST(c.cell_i AS VARCHAR) || '.' || CAST(c.cell_j AS VARCHAR) AS cell,
       x0 + CAST(c.cell_i AS DOUBLE) * ((x1 - x0) / {n}) AS ra_lo,
       x0 + CAST(c.cell_i + 1 AS DOUBLE) * ((x1 - x0) / {n}) AS ra_hi,
       y0 + CAST(c.cell_j AS DOUBLE) * ((y1 - y0) / {n}) AS decl_lo,
       y0 + CAST(c.cell_j + 1 AS DOUBLE) * ((y1 - y0) / {n}) AS decl_hi,
       coalesce(m.members, 0) AS members,
       CAST((coalesce(m.members, 0) + {CAP - 1}) // {CAP} AS INTEGER) AS segments,
       {_N} AS grid_side, CAST(0.1 AS DOUBLE) AS halo
FROM cells c CROSS JOIN z LEFT JOIN m ON c.cell_i = m.cell_i AND c.cell_j = m.cell_j""",
        "min_cells": f"""WITH {_SKY}, {_catalogue_bytes()}
SELECT CAST(total_bytes AS BIGINT) AS total_bytes,
       greatest(1, CAST(ceil(CAST(total_bytes AS DOUBLE) / CAST({BLOCK_BYTES} AS DOUBLE)) AS INTEGER)) AS min_cells,
       CAST(ceil(sqrt(CAST(greatest(1, CAST(ceil(CAST(total_bytes AS DOUBLE) / CAST({BLOCK_BYTES} AS DOUBLE)) AS INTEGER)) AS DOUBLE))) AS INTEGER) AS grid_side
FROM t""",
        "adaptive_split": f"""WITH {_SKY}, {_WRAPPED}, {_zone('wrapped')}, {_adaptive(ADAPTIVE_CAP)}
SELECT "sourceId", level, leaf_i, leaf_j, leaf FROM pl""",
        "adaptive_cells": f"""WITH {_SKY}, {_WRAPPED}, {_zone('wrapped')}, {_adaptive(ADAPTIVE_CAP)},
l AS (SELECT DISTINCT leaf, level, leaf_i, leaf_j FROM pl),
b AS (SELECT l.*, ac.n_rows, ac.n_rows > {ADAPTIVE_CAP} AS indivisible,
             (x1 - x0) / (pow(CAST(2 AS DOUBLE), level) * {n}) AS w, (y1 - y0) / (pow(CAST(2 AS DOUBLE), level) * {n}) AS h
      FROM l JOIN ac USING (level, leaf_i, leaf_j), z)
SELECT leaf, level, leaf_i, leaf_j, x0 + leaf_i * w AS ra_lo, x0 + (leaf_i + 1) * w AS ra_hi,
       y0 + leaf_j * h AS decl_lo, y0 + (leaf_j + 1) * h AS decl_hi, n_rows, indivisible FROM b, z""",
        "sink_by_stripe": f"""WITH {_SKY}, {_stripes('sky')}
SELECT stripe, count(*) AS n_rows, min("sourceId") AS min_source_id, max("sourceId") AS max_source_id,
       min(ra) AS min_ra, max(decl) AS max_decl FROM stripes GROUP BY stripe""",
        "sink_by_capped_cell": f"""WITH {_SKY}, {_WRAPPED}, {_zone('wrapped')}, {_overlap()}, {_capped(CAP)}
SELECT cell_i, cell_j, segment, count(*) AS n_rows, min("sourceId") AS min_source_id, max("sourceId") AS max_source_id,
       min(CASE WHEN ra < CAST(0 AS DOUBLE) THEN ra + CAST(360 AS DOUBLE) ELSE ra END) AS min_ra, max(decl) AS max_decl
FROM capped GROUP BY cell_i, cell_j, segment""",
        "htm_assign": _htm_sql(HTM_LEVEL),
        "kd_assign": f"""WITH {_SKY}, {_WRAPPED}, {_tiles(jobs.MIN_CELLS)} SELECT "sourceId", slab, tile FROM tiled""",
        "kd_cells": f"""WITH {_SKY}, {_WRAPPED}, {_tiles(jobs.MIN_CELLS)}
SELECT slab, tile, min(ra) AS ra_lo, max(ra) AS ra_hi, min(decl) AS decl_lo, max(decl) AS decl_hi, count(*) AS n_rows
FROM tiled GROUP BY slab, tile""",
        "merged_loads": f"""WITH {_SKY}
SELECT "objectId", count(*) AS n_sources, max(CAST("sourceId" AS VARCHAR)) AS last_source_id,
       min(ra) AS min_ra, max(ra) AS max_ra, min(decl) AS min_decl, max(decl) AS max_decl
FROM sky WHERE "objectId" IS NOT NULL GROUP BY "objectId" """,
        "region_lookup": f"""WITH {_SKY}
SELECT "sourceId", ra, decl FROM sky WHERE (ra >= CAST({BOX[0]} AS DOUBLE) OR ra <= CAST({BOX[1]} AS DOUBLE))
AND decl BETWEEN CAST({BOX[2]} AS DOUBLE) AND CAST({BOX[3]} AS DOUBLE)""",
        "source_errors": f"""WITH {_SKY},
v AS (SELECT *, "sourceId" % 17 = 2 AS cut FROM sky),
e AS (SELECT decl, list_filter([CASE WHEN "sourceId" % 13 = 5 THEN 'ra malformed' END,
    CASE WHEN "sourceId" % 11 = 4 THEN 'sourceId missing' WHEN "sourceId" % 11 = 2 THEN 'sourceId malformed' END,
    CASE WHEN "sourceId" % 7 = 3 AND "objectId" IS NOT NULL THEN 'objectId malformed' END,
    CASE WHEN "sourceId" % 17 = 1 THEN 'line long' WHEN cut THEN 'line short' END], lambda x: x IS NOT NULL) AS said FROM v)
SELECT verdict, count(*) AS n_rows, min(decl) AS min_decl, max(decl) AS max_decl FROM (
  SELECT decl, unnest(CASE WHEN len(said) = 0 THEN ['good'] ELSE said END) AS verdict FROM e) GROUP BY verdict""",
        "count_good_objects": f"""WITH {_SKY},
v AS (SELECT *, "sourceId" % 9 = 4 AND "objectId" IS NOT NULL AS bad FROM sky)
SELECT CASE WHEN NOT bad THEN "objectId" END AS "objectId", count(*) AS n_sources FROM v
WHERE bad OR "objectId" IS NOT NULL GROUP BY CASE WHEN NOT bad THEN "objectId" END""",
        "source_rejects": f"""WITH {_SKY},
v AS (SELECT *, CASE WHEN "sourceId" % 10 = 3 THEN 'RA malformed' WHEN "sourceId" % 10 = 7 THEN 'RA missing'
                     WHEN "sourceId" % 10 = 5 THEN 'Decl not finite' END AS reject FROM sky)
SELECT "sourceId", reject, CASE WHEN reject IS NULL THEN ra END AS ra,
       CASE WHEN reject IS NULL THEN decl END AS decl FROM v""",
        "grid_from_size": f"""WITH {_SKY}, {_zone('sky')}, {_catalogue_bytes()},
g AS (SELECT greatest(1, CAST(ceil(sqrt(ceil(CAST(total_bytes AS DOUBLE) / {SIZED_BLOCK}))) AS INTEGER)) AS n FROM t),
c AS (SELECT CAST(i AS INTEGER) AS cell_i, CAST(j AS INTEGER) AS cell_j, CAST(n AS DOUBLE) AS n
      FROM (SELECT n, unnest(range(0, n)) AS i FROM g) a, (SELECT unnest(range(0, n)) AS j FROM g) b)
SELECT cell_i, cell_j, CAST(cell_i AS VARCHAR) || '.' || CAST(cell_j AS VARCHAR) AS cell,
       x0 + CAST(cell_i AS DOUBLE) * ((x1 - x0) / n) AS ra_lo, x0 + CAST(cell_i + 1 AS DOUBLE) * ((x1 - x0) / n) AS ra_hi,
       y0 + CAST(cell_j AS DOUBLE) * ((y1 - y0) / n) AS decl_lo, y0 + CAST(cell_j + 1 AS DOUBLE) * ((y1 - y0) / n) AS decl_hi
FROM c, z""",
    }


# ----------------------------------------------------------------------------
# Optional training-data subpackage

def _llm():
    """``skygrid.llm.queries``, or None where the subpackage is not installed."""
    try:
        from skygrid.llm import queries as llm_queries
    except ModuleNotFoundError as e:
        if e.name in ("skygrid.llm", "skygrid.llm.queries", "corpus_pipeline"):
            return None
        raise
    return llm_queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    llm = _llm()
    return core_queries() | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    llm = _llm()
    return core_oracle_sql() | (llm.oracle_sql() if llm else {})
