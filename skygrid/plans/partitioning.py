"""The partition program: catalogue in, one directory per region out.

``run_partitioning`` scans a Source catalogue once, checking every field it
uses, into a table; the same pass takes the bounding box and the number of
rows.  It derives the grid from the box, assigns every observation by the chosen scheme -- exclusive
grid, overlapping grid with a per-cell cap, RA stripes, quad-tree leaves, or triangles of the
sphere -- writes the rows below ``output/data`` with one directory per region (the
segments of a capped cell are sorted runs inside its directory), writes the region table to ``output/grid`` and returns the histogram computed from
what was written.  Rows with a malformed or missing field fail the run; with
``on_bad="report"`` they go to ``output/rejects`` with a reason instead, and
their number is returned.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skygrid.functions.cells import DEFAULT_CELL_CAP, DEFAULT_HALO, MAX_MIN_CELLS, Grid, Zone, make_grid
from skygrid.functions.coords import log_bar, unwrap_ra, wrap_ra
from skygrid.functions.htm import with_htm
from skygrid.operators.adaptive import LEAF_KEYS, adaptive_split, leaf_table
from skygrid.operators.grid import (assign_exclusive, assign_overlap, assign_stripes, capacity_split,
                                    cell_histogram, exclusive_cells, grid_cells)
from skygrid.operators.positions import require_positions
from skygrid.plans import jobs
from skygrid.session import cut_lineage
from skygrid.sources.catalogue import read_checked_sources
from skygrid.sources.schema import DECL, RA, SOURCE_ID
from skygrid.sources.sinks import min_cells_for_input, read_by_cell, write_by_cell

MODES = ("exclusive", "overlap", "stripe", "adaptive", "htm")
HTM_LEVEL = 6           # triangles of about 1.4 degrees


@dataclass(frozen=True)
class PartitionResult:
    grid: Grid | None           # stripes and triangles have none
    data_path: str
    grid_path: str
    histogram: DataFrame
    rejects_path: str | None    # written where on_bad is "report"
    n_rejects: int
    n_rows: int


def _staged(checked: DataFrame):
    """The checked rows as a table, from one scan that also takes the box and the number of rows."""
    good, seen = F.col("reject").isNull(), Observation()
    position = {"ra": F.col(RA), "wrapped": wrap_ra(RA), "decl": F.col(DECL)}
    rows = cut_lineage(checked.observe(
        seen, F.count(F.lit(1)).alias("n"),
        *[f(F.when(good, c)).alias(f"{side}_{k}") for k, c in position.items()
          for side, f in (("min", F.min), ("max", F.max))]), "staged")
    return rows, seen.get


def run_partitioning(spark: SparkSession, input_path: str, output_path: str, mode: str = "exclusive",
                     min_cells: int | None = jobs.MIN_CELLS, cap: int = DEFAULT_CELL_CAP,
                     halo: float = DEFAULT_HALO, on_bad: str = "fail", ceiling: int = MAX_MIN_CELLS,
                     htm_level: int = HTM_LEVEL) -> PartitionResult:
    """Run one scheme; ``min_cells=None`` sizes the grid by the input's bytes."""
    if mode not in MODES or on_bad not in ("fail", "report"):
        raise ValueError(f"unknown mode {mode!r} or on_bad {on_bad!r}")
    out = output_path.rstrip("/")
    data_path, grid_path, rejects_path = f"{out}/data", f"{out}/grid", None
    staged, box = _staged(read_checked_sources(spark, input_path, (SOURCE_ID, RA, DECL)).drop("errors"))
    bad = staged.where(F.col("reject").isNotNull())
    n_rejects = bad.count()
    if n_rejects and on_bad == "fail":
        raise ValueError(f"{n_rejects} rows are unusable, such as {bad.limit(3).collect()}; "
                         "on_bad='report' sets them aside")
    if on_bad == "report":
        rejects_path = f"{out}/rejects"
        bad.select(SOURCE_ID, f"{RA}_text", f"{DECL}_text", "reject").write.mode("errorifexists").parquet(rejects_path)
    sources = staged.where(F.col("reject").isNull()).select(SOURCE_ID, RA, DECL)
    if min_cells is None and mode not in ("stripe", "htm"):
        min_cells = min_cells_for_input(spark, input_path)

    grid, keys, within = None, ("cell_i", "cell_j"), ()
    if mode == "stripe":
        keys = ("stripe",)
        rows = assign_stripes(sources).select(SOURCE_ID, RA, DECL, *keys)
    elif mode == "htm":
        keys = ("htm_id",)
        rows = with_htm(require_positions(sources), htm_level, RA, DECL)
    else:
        if box["min_ra"] is None:
            raise ValueError("cannot build a grid over an empty input")
        axis = "ra" if mode == "exclusive" else "wrapped"
        pts = sources if mode == "exclusive" else jobs.wrapped(sources)
        grid = make_grid(Zone(box[f"min_{axis}"], box[f"max_{axis}"], box["min_decl"], box["max_decl"]),
                         min_cells, ceiling)
        if mode == "exclusive":
            rows = assign_exclusive(pts, grid)
        elif mode == "overlap":
            within = ("segment",)
            rows = capacity_split(assign_overlap(pts, grid, halo), cap)
        else:
            keys = LEAF_KEYS
            rows = adaptive_split(pts, grid, cap).drop("leaf")
        ra = RA if mode == "exclusive" else unwrap_ra(RA).alias(RA)
        rows = rows.select(SOURCE_ID, ra, DECL, *keys, *within)
    write_by_cell(rows, data_path, keys=keys, within=within, arranged=bool(within))
    written = read_by_cell(spark, data_path, keys=keys)

    # The region table's counts come from what was written (partition columns
    # only) rather than from another pass over the input.
    if mode in ("exclusive", "overlap"):
        histogram = cell_histogram(written, [*keys, *within])
        members = written.groupBy("cell_i", "cell_j").agg(F.count(F.lit(1)).alias("members"))
        cells = exclusive_cells(spark, grid) if mode == "exclusive" else grid_cells(spark, grid)
        regions = (cells.join(members, ["cell_i", "cell_j"], "left")
                   .withColumn("members", F.coalesce(F.col("members"), F.lit(0)))
                   .withColumn("grid_side", F.lit(grid.n)))
        if mode == "overlap":
            regions = (regions.withColumn("segments", F.expr(f"CAST((members + {cap - 1}) div {cap} AS INT)"))
                       .withColumn("halo", F.lit(float(halo))))
    else:
        histogram = (written.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
                     .withColumn("bar", log_bar("n_rows")))
        regions = histogram.drop("bar")
        if mode == "adaptive":
            regions = leaf_table(regions, grid, cap)
    regions.write.mode("errorifexists").json(grid_path)
    return PartitionResult(grid, data_path, grid_path, histogram, rejects_path, n_rejects, box["n"])


def region_lookup(spark: SparkSession, result: PartitionResult, ra_from: float, ra_to: float,
                  decl_from: float, decl_to: float) -> DataFrame:
    """The observations of a closed box (``ra_from > ra_to``: across RA 0), from the regions that meet it.

    The stored region table is the dimension: its rows that meet the box are
    broadcast (a grid has a bounded number), and the scan of the data reads
    only their directories.  In an overlapping layout a point is taken from
    the cell it lies in.
    """
    table = spark.read.json(result.grid_path)
    if "grid_side" not in table.columns:
        raise ValueError("look-ups need an exclusive or overlapping grid")
    overlap = "halo" in table.columns
    x, y, edge = wrap_ra(RA) if overlap else F.col(RA), F.col(DECL), 1e-9
    if overlap:
        ra_from, ra_to = (a - 360.0 if a > 180.0 else a for a in (ra_from, ra_to))
    spans = [(ra_from, ra_to)] if ra_from <= ra_to else [(ra_from, 360.0), (-360.0, ra_to)]

    def any_span(test) -> Column:
        return reduce(Column.__or__, [test(F.lit(float(a)), F.lit(float(b))) for a, b in spans])
    n = F.col("grid_side")
    regions = table.where(any_span(lambda a, b: (F.col("ra_hi") + edge >= a) & (F.col("ra_lo") - edge <= b))
                          & (F.col("decl_hi") + edge >= float(decl_from)) & (F.col("decl_lo") - edge <= float(decl_to)))
    regions = regions.select(*[F.col(c).cast("int").alias(c) for c in ("cell_i", "cell_j")],
                             "ra_lo", "ra_hi", "decl_lo", "decl_hi", n.cast("int").alias("grid_side"))
    found = read_by_cell(spark, result.data_path).join(F.broadcast(regions), ["cell_i", "cell_j"]).where(
        any_span(lambda a, b: (x >= a) & (x <= b)) & (y >= float(decl_from)) & (y <= float(decl_to)))
    if overlap:
        last = F.col("grid_side") - 1

        def inside(c: Column, axis: str, cell: str) -> Column:
            return (((c >= F.col(f"{axis}_lo")) | (F.col(cell) == 0))
                    & ((c < F.col(f"{axis}_hi")) | (F.col(cell) == last)))
        found = found.where(inside(x, "ra", "cell_i") & inside(y, "decl", "cell_j"))
    return found.select(SOURCE_ID, RA, DECL)
