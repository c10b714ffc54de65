"""Neighbour pairs against brute force; sinks written and read back."""

import math
import random
import re

import pytest

from pyspark.sql import functions as F

from conftest import SF_SMALL
from skygrid.functions.cells import Grid, make_grid
from skygrid.operators.grid import assign_exclusive
from skygrid.operators.neighbours import neighbour_pairs, neighbour_pairs_sphere
from skygrid.operators.summary import zone_of
from skygrid.plans import jobs
from skygrid.session import fresh_dir
from skygrid.sources.catalogue import read_lines, sky, write_source_files
from skygrid.sources.schema import DECL, RA, SOURCE_ID
from skygrid.sources.sinks import input_size, min_cells_from_size, read_by_cell, write_by_cell


def _points(n, seed, ra_span=(-0.3, 0.3), dec_span=(-0.3, 0.3)):
    rnd = random.Random(seed)
    pts = [(k, rnd.uniform(*ra_span), rnd.uniform(*dec_span)) for k in range(n)]
    # a dense clump: one block holding many points
    pts += [(n + k, 0.0101 + rnd.uniform(0, 0.004), 0.0101 + rnd.uniform(0, 0.004)) for k in range(150)]
    return pts


@pytest.mark.parametrize("budget", [50_000_000, 40])
def test_planar_pairs_equal_brute_force(spark, budget):
    pts = _points(1500, 1)
    eps = 0.02
    df = spark.createDataFrame(pts, "sourceId long, ra double, decl double")
    got = sorted((r.id_a, r.id_b) for r in neighbour_pairs(df, eps, pair_budget=budget).collect())
    want = sorted((a[0], b[0]) for i, a in enumerate(pts) for b in pts[i + 1:]
                  if math.sqrt((b[1] - a[1]) ** 2 + (b[2] - a[2]) ** 2) < eps)
    assert got == want and len(got) > 150


def _sep(a, b):
    r1, d1, r2, d2 = map(math.radians, (a[1], a[2], b[1], b[2]))
    h = math.sin((d2 - d1) / 2) ** 2 + math.cos(d1) * math.cos(d2) * math.sin((r2 - r1) / 2) ** 2
    return math.degrees(2 * math.asin(math.sqrt(min(1.0, h))))


@pytest.mark.parametrize("budget", [50_000_000, 30])
def test_sphere_pairs_equal_brute_force_across_ra_zero_and_pole(spark, budget):
    rnd = random.Random(5)
    pts = [(k, rnd.choice([rnd.uniform(359.7, 360.0), rnd.uniform(0.0, 0.3)]), rnd.uniform(-0.2, 0.2))
           for k in range(1200)]
    pts += [(5000 + k, rnd.uniform(0, 360), rnd.uniform(89.9, 90.0)) for k in range(300)]
    eps = 0.03
    df = spark.createDataFrame(pts, "sourceId long, ra double, decl double")
    got = sorted((r.id_a, r.id_b) for r in neighbour_pairs_sphere(df, eps, pair_budget=budget).collect())
    want = sorted((a[0], b[0]) for i, a in enumerate(pts) for b in pts[i + 1:]
                  if _sep(a, b) < eps)
    # borderline pairs within 1e-12 deg of eps may fall either way
    border = [(a[0], b[0]) for i, a in enumerate(pts) for b in pts[i + 1:] if abs(_sep(a, b) - eps) < 1e-12]
    assert set(got) ^ set(want) <= set(border)
    assert any(a < 1200 and b < 1200 and abs(pts[a][1] - pts[b][1]) > 300 for a, b in got)


def test_sink_by_cell_keeps_1_1_and_1_10_apart(spark):
    rows = [(k, 0.0, 0.0, 1, 1 if k % 2 else 10) for k in range(10)]
    df = spark.createDataFrame(rows, "sourceId long, ra double, decl double, cell_i int, cell_j int")
    path = fresh_dir(spark, "cells-test")
    write_by_cell(df, path)
    back = read_by_cell(spark, path)
    assert sorted(tuple(r) for r in back.groupBy("cell_i", "cell_j").count().collect()) == [(1, 1, 5), (1, 10, 5)]
    assert back.where((F.col("cell_i") == 1) & (F.col("cell_j") == 10)).count() == 5


def test_sink_by_cell_counts_equal_assignment(spark):
    pts, grid = jobs.exclusive_grid(sky(spark, SF_SMALL))
    assigned = assign_exclusive(pts, grid)
    path = fresh_dir(spark, "cells-sky")
    write_by_cell(assigned.select("sourceId", "ra", "decl", "cell_i", "cell_j"), path)
    back = read_by_cell(spark, path).groupBy("cell_i", "cell_j").count()
    want = assigned.groupBy("cell_i", "cell_j").count()
    assert sorted(back.collect()) == sorted(want.collect())


def test_capped_cells_are_sorted_runs_in_one_directory(spark):
    """Directories are bounded by the grid, and a segment is found by file statistics."""
    from skygrid.operators.grid import capacity_split
    from skygrid.operators.grid import assign_overlap
    pts, grid = jobs.overlap_grid(sky(spark, SF_SMALL))
    rows = capacity_split(assign_overlap(pts, grid, 0.1), cap=5).select("sourceId", "ra", "decl", "cell_i", "cell_j", "segment")
    want = sorted(map(tuple, rows.collect()))
    for arranged in (True, False):
        path = fresh_dir(spark, "capped")
        write_by_cell(rows, path, within=("segment",), arranged=arranged)
        back = read_by_cell(spark, path)
        assert sorted(map(tuple, back.select("sourceId", "ra", "decl", "cell_i", "cell_j", "segment").collect())) == want
        cells = {(i, j) for _, _, _, i, j, _ in want}
        files = [f for f in back.inputFiles()]
        assert len({f.rsplit("/", 1)[0] for f in files}) == len(cells)
        assert len(files) <= len(cells) + 2 * 8
        for f in files:     # each file is sorted by segment
            segs = [r.segment for r in spark.read.parquet(f).select("segment").collect()]
            assert segs == sorted(segs)
        plan = back.where("cell_i = 1 AND segment = 3")._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PushedFilters: \[.*EqualTo\(segment,3\)\]", plan) and "PartitionFilters" in plan


@pytest.mark.parametrize("eps,max_rows", [(0.02, 10**6), (0.1, 40), (0.1, 10**6)])
def test_region_pairs_equal_neighbour_pairs_without_an_exchange(spark, eps, max_rows):
    from skygrid.operators.regions import region_pairs, write_regions
    rnd = random.Random(7)
    pts = [(rnd.choice([-0.5, 0.3]) + rnd.gauss(0, 0.2), rnd.uniform(-1, 1)) for _ in range(900)]
    pts += [(0.1 * k, 0.05 * k) for k in range(20)] + [(0.0, 0.0)] * 6         # exact multiples of eps, one position
    df = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(pts)], "sourceId long, ra double, decl double")
    grid = make_grid(zone_of(df), 40)
    regions = write_regions(df, grid, fresh_dir(spark, "regions"), halo=0.1, buckets=5, max_rows=max_rows)
    out = region_pairs(spark, regions, eps)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, neighbour_pairs(df, eps).collect()))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "SelectedBucketsCount: 5 out of 5" in plan
    other = spark.newSession()      # a session that has never seen the table
    assert region_pairs(other, regions, eps).count() == out.count()
    with pytest.raises(ValueError, match="halo"):
        region_pairs(spark, regions, 0.2)


def test_text_sink_by_cell(spark):
    df = spark.createDataFrame([(0, 1, "1.5,2.5"), (0, 1, "3.0,4.0"), (2, 0, "0.0,0.0")],
                               "cell_i int, cell_j int, value string")
    path = fresh_dir(spark, "cells-text")
    write_by_cell(df, path, fmt="text")
    back = read_by_cell(spark, path, fmt="text")
    assert sorted((r.cell_i, r.cell_j, r.value) for r in back.collect()) == sorted(
        (r.cell_i, r.cell_j, r.value) for r in df.collect())


def test_input_size_and_min_cells(spark):
    import os
    path = fresh_dir(spark, "size")
    write_source_files(sky(spark, SF_SMALL), path)
    local = path.replace("file:", "")
    on_disk = sum(os.path.getsize(os.path.join(local, f)) for f in os.listdir(local)
                  if not f.startswith((".", "_")))
    size = input_size(spark, path).first()
    assert size.total_bytes == on_disk
    cells = min_cells_from_size(input_size(spark, path), block_bytes=100_000).first()
    assert cells.min_cells == math.ceil(on_disk / 100_000)
    assert cells.grid_side == math.ceil(math.sqrt(cells.min_cells))


@pytest.mark.parametrize("seed,eps", [(11, 0.005), (12, 0.05), (13, 0.2)])
def test_pairs_random_footprints_equal_brute_force(spark, seed, eps):
    rnd = random.Random(seed)
    pts = []
    for k in range(900):
        kind = rnd.random()
        if kind < 0.4:      # across RA = 0
            ra = rnd.choice([rnd.uniform(359.5, 360.0), rnd.uniform(0.0, 0.5)])
            dec = rnd.uniform(-0.5, 0.5)
        elif kind < 0.7:    # mid latitude
            ra, dec = rnd.uniform(100, 101), rnd.uniform(60, 61)
        else:               # dense clump
            ra, dec = 200 + rnd.uniform(0, 3 * eps), -30 + rnd.uniform(0, 3 * eps)
        pts.append((k, ra, dec))
    df = spark.createDataFrame(pts, "sourceId long, ra double, decl double")
    got = {(r.id_a, r.id_b) for r in neighbour_pairs_sphere(df, eps).collect()}
    want = {(a[0], b[0]) for i, a in enumerate(pts) for b in pts[i + 1:] if _sep(a, b) < eps}
    border = {(a[0], b[0]) for i, a in enumerate(pts) for b in pts[i + 1:] if abs(_sep(a, b) - eps) < 1e-12}
    assert got ^ want <= border and len(want) > 0
    flat = [(k, ra - 360 if ra > 180 else ra, dec) for k, ra, dec in pts]
    dfp = spark.createDataFrame(flat, "sourceId long, ra double, decl double")
    gotp = {(r.id_a, r.id_b) for r in neighbour_pairs(dfp, eps).collect()}
    wantp = {(a[0], b[0]) for i, a in enumerate(flat) for b in flat[i + 1:]
             if math.sqrt((b[1] - a[1]) ** 2 + (b[2] - a[2]) ** 2) < eps}
    assert gotp == wantp


def test_separation_spot_values(spark):
    from skygrid.functions.coords import separation_deg
    rows = [(0.0, 0.0, 0.0, 1.0, 1.0), (10.0, 0.0, 20.0, 0.0, 10.0), (0.0, 89.5, 180.0, 89.5, 1.0),
            (359.5, 0.0, 0.5, 0.0, 1.0), (0.0, -90.0, 0.0, 90.0, 180.0)]
    df = spark.createDataFrame(rows, "r1 double, d1 double, r2 double, d2 double, want double")
    for r in df.select(separation_deg("r1", "d1", "r2", "d2").alias("got"), "want").collect():
        assert abs(r.got - r.want) < 1e-9


def test_budget_is_raised_until_the_hot_table_is_small(spark, monkeypatch):
    import skygrid.operators.neighbours as N
    monkeypatch.setattr(N, "MAX_HOT_BROADCAST", 2)
    pts = _points(800, 21)
    df = spark.createDataFrame(pts, "sourceId long, ra double, decl double")
    got = sorted((r.id_a, r.id_b) for r in neighbour_pairs(df, 0.02, pair_budget=2).collect())
    want = sorted((a[0], b[0]) for i, a in enumerate(pts) for b in pts[i + 1:]
                  if math.sqrt((b[1] - a[1]) ** 2 + (b[2] - a[2]) ** 2) < 0.02)
    assert got == want


def test_sink_by_stripe_reads_back(spark):
    from skygrid.operators.grid import assign_stripes
    rows = assign_stripes(sky(spark, SF_SMALL)).select("sourceId", "ra", "decl", "stripe")
    path = fresh_dir(spark, "stripes")
    write_by_cell(rows, path, keys=("stripe",))
    back = read_by_cell(spark, path, keys=("stripe",))
    assert sorted(back.groupBy("stripe").count().collect()) == sorted(rows.groupBy("stripe").count().collect())


def test_sphere_pairs_compare_coordinates_before_distances(spark):
    """Distances are computed for candidates close in both coordinates only, with each row's cosine made once."""
    rows = [(1, 359.99, 0.0), (2, 0.005, 0.0), (3, 0.005, 0.0199), (4, 10.0, 89.9999), (5, 190.0, 89.9999),
            (6, 40.0, -60.0), (7, 40.0399, -60.0), (8, 40.0, -60.0), (9, 40.0401, -60.0)]
    pairs = neighbour_pairs_sphere(spark.createDataFrame(rows, f"{SOURCE_ID} long, {RA} double, {DECL} double"), 0.02)
    assert {tuple(r) for r in pairs.collect()} == {(1, 2), (2, 3), (4, 5), (6, 7), (6, 8), (7, 8), (7, 9)}
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "COS(" not in join.upper() and "abs(" in join and join.index("abs(") < join.upper().index("SIN("), join


def test_sphere_pairs_meet_by_one_number_in_small_blocks(spark):
    """Zone and block are one sort key of a merge join; a block is no more than about eps wide."""
    eps = 0.02
    pts = _points(1500, 31)
    pairs = neighbour_pairs_sphere(spark.createDataFrame(pts, f"{SOURCE_ID} long, {RA} double, {DECL} double"), eps)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [_k#" in plan and "BroadcastHashJoin" not in plan, plan
    assert {tuple(r) for r in pairs.collect()} == {(a[0], b[0]) for i, a in enumerate(pts) for b in pts[i + 1:]
                                                   if _sep(a, b) < eps}
    # A dense grid: pairs that meet in a block, against those that are close (blocks of twice the side: above 5).
    grid = [(k, 10.0 + (k % 60) * eps / 10, (k // 60) * eps / 10) for k in range(3600)]
    joined = neighbour_pairs_sphere(spark.createDataFrame(grid, f"{SOURCE_ID} long, {RA} double, {DECL} double"), eps)
    optimized = joined._jdf.queryExecution().optimizedPlan()
    while "Join" not in optimized.nodeName():
        optimized = optimized.children().apply(0)
    sides = [spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, optimized.children().apply(i))
             for i in (0, 1)]
    counts = []
    for side in sides:
        at = list(side.columns()).index("_k")
        counts.append({})
        for r in side.collect():
            counts[-1][r.get(at)] = counts[-1].get(r.get(at), 0) + 1
    candidates = sum(n * counts[1].get(k, 0) for k, n in counts[0].items())
    assert candidates < 4 * joined.count()


def test_sphere_pairs_of_tiny_eps_and_of_more_than_a_turn(spark):
    rows = [(k, 1e-9 * k, 0.0) for k in range(20)]
    df = spark.createDataFrame(rows, f"{SOURCE_ID} long, {RA} double, {DECL} double")
    assert {tuple(r) for r in neighbour_pairs_sphere(df, 2.5e-9).collect()} == {
        (a, b) for a in range(20) for b in range(a + 1, min(a + 3, 20))}
    turned = [(1, 365.0, 0.0), (2, 5.005, 0.001), (3, 725.0, 0.0), (4, -355.0, 0.0), (5, 5.0301, 0.0), (6, 185.0, 0.0)]
    df = spark.createDataFrame(turned, f"{SOURCE_ID} long, {RA} double, {DECL} double")
    assert {tuple(r) for r in neighbour_pairs_sphere(df, 0.02).collect()} == {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)}
