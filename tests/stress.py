"""Memory/scale stress runs on generated points (opt-in, not a pytest module).

Usage: python tests/stress.py [operator ...] [--rows N] [--heap 1g]

Runs each operator over ``N`` generated points (hashed coordinates over the
survey footprint) through the ``noop`` sink on ``local[8]`` with the given
driver heap, and prints one line per operator: completed or failed, seconds.
Operators: cap, planar, sphere, adaptive, write, extent.
"""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def points(spark, n: int):
    from pyspark.sql import functions as F
    ra = F.abs(F.xxhash64("id")) % 4_000_000
    dec = F.abs(F.xxhash64(F.col("id") + 7)) % 14_000_000
    return spark.range(0, n, numPartitions=8).select(
        F.col("id").alias("sourceId"), (F.col("id") % 200_000).alias("objectId"),
        (ra.cast("double") / 1e6 - 2.0).alias("ra"), (dec.cast("double") / 1e6 - 7.0).alias("decl"))


def build(name: str, spark, pts):
    from skygrid.functions.cells import Grid, Zone
    from skygrid.operators.adaptive import adaptive_split
    from skygrid.operators.grid import assign_exclusive, assign_overlap, capacity_split
    from skygrid.operators.neighbours import neighbour_pairs, neighbour_pairs_sphere
    from skygrid.operators.summary import object_extent
    from skygrid.session import fresh_dir
    from skygrid.sources.sinks import write_by_cell
    grid = Grid(Zone(-2.0, 2.0, -7.0, 7.0), 7)
    if name == "cap":
        return capacity_split(assign_overlap(pts, grid, 0.1), cap=10_000)
    if name == "planar":
        return neighbour_pairs(pts, 0.0005)
    if name == "sphere":
        return neighbour_pairs_sphere(pts, 0.0005)
    if name == "adaptive":
        return adaptive_split(pts, grid, cap=50_000)
    if name == "extent":
        return object_extent(pts)
    if name == "write":
        write_by_cell(assign_exclusive(pts, grid).select("sourceId", "ra", "decl", "cell_i", "cell_j"),
                      fresh_dir(spark, "stress-write"))
        return None
    raise ValueError(name)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("ops", nargs="*", default=["cap", "planar", "sphere", "adaptive", "write", "extent"])
    ap.add_argument("--rows", type=int, default=20_000_000)
    ap.add_argument("--heap", default="1g")
    args = ap.parse_args()
    from skygrid.session import build_session
    for op in args.ops:
        spark = build_session(master="local[8]", extra={"spark.driver.memory": args.heap})
        t0 = time.time()
        try:
            df = build(op, spark, points(spark, args.rows))
            if df is not None:
                df.write.format("noop").mode("overwrite").save()
            print(f"{op:10s} completed {time.time() - t0:7.1f}s", flush=True)
        except Exception as e:  # report and go on with the next operator
            print(f"{op:10s} FAILED    {time.time() - t0:7.1f}s {type(e).__name__}", flush=True)
        spark.stop()


if __name__ == "__main__":
    main()
