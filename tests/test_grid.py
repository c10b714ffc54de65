"""Grid, overlap, capacity split and stripes: goldens and invariants."""

import math
import random

import pytest
from pyspark.sql import functions as F

from skygrid.functions.cells import Grid, Zone, grid_side, make_grid
from skygrid.functions.coords import log_bar, unwrap_ra, wrap_ra
from skygrid.operators.adaptive import adaptive_leaves, adaptive_split
from skygrid.operators.grid import (assign_exclusive, assign_overlap, assign_stripes,
                                    capacity_split, cell_histogram, grid_cells)
from skygrid.operators.ranks import rank_rows
from skygrid.operators.summary import zone_of
from skygrid.plans import jobs


def _hist(df):
    return sorted((r.cell_i, r.cell_j, r.n_rows) for r in cell_histogram(df).collect())


def test_grid_side():
    assert [grid_side(k) for k in (0, 1, 2, 3, 4, 5, 40, 49, 50, 676)] == [1, 1, 2, 2, 2, 3, 7, 7, 8, 26]
    for bad in (-1, 677):
        with pytest.raises(ValueError):
            grid_side(bad)


def test_log_bar(spark):
    df = spark.createDataFrame([(n,) for n in (1, 10, 11, 1000, 10000, 10001)], "n long")
    assert [len(r.b) for r in df.select(log_bar("n").alias("b")).collect()] == [0, 1, 2, 3, 4, 5]


def test_exclusive_goldens(sources):
    z = zone_of(sources)
    assert _hist(assign_exclusive(sources, Grid(z, 2))) == [
        (0, 0, 1), (1, 0, 1), (1, 1, 15), (1, 2, 14), (2, 1, 2), (2, 2, 23)]
    assert _hist(assign_exclusive(sources, Grid(z, 3))) == [
        (0, 0, 1), (1, 0, 1), (1, 1, 15), (1, 2, 1), (2, 1, 1), (2, 3, 24), (3, 1, 1), (3, 2, 1), (3, 3, 11)]


def test_exclusive_single_point(spark):
    g = make_grid(Zone(357.954210, 358.090417, 2.564629, 3.175271), 3)
    df = spark.createDataFrame([(358.08, 2.94)], "ra double, decl double")
    assert assign_exclusive(df, g).first().cell == "2.2"


def test_exclusive_counts_sum_to_input(sources):
    for n in range(1, 8):
        g = Grid(zone_of(sources), n)
        assert sum(r[2] for r in _hist(assign_exclusive(sources, g))) == 56


def test_wrap_round_trip(sources):
    back = sources.select("ra", unwrap_ra(wrap_ra("ra")).alias("rt"))
    assert back.where(F.col("ra") != F.col("rt")).count() == 0


def test_overlap_golden(sources):
    pts = jobs.wrapped(sources)
    g = Grid(zone_of(pts), 3)
    got = _hist(assign_overlap(pts, g, 0.1))
    assert got == [(i, j, {0: 19, 1: 13, 2: 37}[j]) for i in range(3) for j in range(3)]


def test_overlap_single_point(spark, sources):
    g = make_grid(zone_of(jobs.wrapped(sources)), 5)
    df = spark.createDataFrame([(1, -2.00, 2.67)], "sourceId long, ra double, decl double")
    cells = sorted(r.cell for r in assign_overlap(df, g, 0.1).collect())
    assert cells == ["0.0", "0.1", "1.0", "1.1", "2.0", "2.1"]


def test_overlap_equals_brute_force_and_contains_exclusive(spark):
    rnd = random.Random(7)
    rows = [(k, rnd.uniform(-3, 3), rnd.uniform(-7, 7)) for k in range(3000)]
    df = spark.createDataFrame(rows, "sourceId long, ra double, decl double")
    for n, halo in ((7, 0.1), (4, 2.5), (1, 0.1)):
        g = make_grid(zone_of(df), n * n)
        got = sorted((r.sourceId, r.cell_i, r.cell_j)
                     for r in assign_overlap(df, g, halo).collect())
        w, h = g.cell_width, g.cell_height
        z = g.zone
        want = sorted((k, i, j) for k, x, y in rows for i in range(g.n) for j in range(g.n)
                      if x >= z.min_ra + i * w - halo and x <= z.min_ra + (i + 1) * w + halo
                      and y >= z.min_decl + j * h - halo and y <= z.min_decl + (j + 1) * h + halo)
        assert got == want
        assert {k for k, _, _ in got} == {k for k, _, _ in rows}


def test_grid_cells_table(spark, sources):
    g = Grid(zone_of(sources), 4)
    cells = grid_cells(spark, g).collect()
    assert len(cells) == 16 and len({c.cell for c in cells}) == 16
    first = [c for c in cells if c.cell == "0.0"][0]
    assert first.ra_lo == g.zone.min_ra and first.decl_lo == g.zone.min_decl


@pytest.mark.parametrize("parts,per_task", [(1, 10**6), (3, 300), (8, 97)])
def test_capacity_split_matches_row_number(spark, parts, per_task):
    rnd = random.Random(parts)
    rows = [(k, rnd.choice([0, 0, 0, 1, 2]), rnd.choice([0, 1])) for k in rnd.sample(range(10**6), 2000)]
    df = spark.createDataFrame(rows, "sourceId long, cell_i int, cell_j int").withColumn(
        "cell", F.concat_ws(".", "cell_i", "cell_j"))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {(r.sourceId, r.cell_i, r.cell_j): (r.segment, r.cell)
               for r in capacity_split(df, cap=37, rows_per_task=per_task).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(got) == len(rows)
    by_cell = {}
    for k, i, j in sorted(rows):
        by_cell.setdefault((i, j), []).append(k)
    for (i, j), ids in by_cell.items():
        for rank, k in enumerate(ids):
            seg = rank // 37
            assert got[(k, i, j)] == (seg, f"{i}.{j}" + "bis" * seg)


def _evaluations(spark, rows, column):
    """``rows`` with a counter of how often the column was evaluated."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(v):
        seen.add(1)
        return v
    return rows.withColumn(column, counted.asNondeterministic()(F.col(column))), seen


@pytest.mark.parametrize("ids", [list(range(0, 10**12, 10**9)) + list(range(7, 4007)),
                                 [*range(5000), 2**61], [-(2**63), -5, 0, 3, 2**63 - 1]])
def test_ranks_are_exact_in_few_passes_whatever_the_ids(spark, ids):
    """Dense runs, far outliers, the ends of the type; every row is evaluated for the sample and the shuffle only."""
    df, seen = _evaluations(spark, spark.createDataFrame([(k, 1) for k in ids], "k long, g int"), "k")
    ranked = {r.k: r["rank"] for r in rank_rows(df, ["g"], "k", rows_per_task=300).collect()}
    assert ranked == {k: n + 1 for n, k in enumerate(sorted(set(ids)))}
    assert seen.value <= 2 * len(ids)


def test_ranks_of_a_hot_group_span_many_tasks(spark):
    df = spark.range(0, 20000, 1, 3).select(F.lit(1).alias("g"), F.lit(7).alias("k"), F.lit("x").alias("same"))
    out = rank_rows(df, ["g"], "k", rows_per_task=1000)
    assert sorted(r["rank"] for r in out.collect()) == list(range(1, 20001))
    import glob
    import re
    scan = re.search(r"(/[^\s,\]]*skygrid-ranked-\w+)", out._jdf.queryExecution().optimizedPlan().toString()
                     + " ".join(out.inputFiles())).group(1)
    sizes = [spark.read.parquet(f).count() for f in glob.glob(f"{scan}/*.parquet")]
    assert len(sizes) >= 15 and max(sizes) < 4000, sizes


@pytest.mark.parametrize("parts", [1, 3, 5])
def test_ranks_of_ties_do_not_depend_on_the_partitioning(spark, parts):
    rows = [(1, 4, 2.0, 1.0, "a"), (1, 4, 1.0, 2.0, "b"), (1, 4, 1.0, 1.0, "c"), (1, 4, 1.0, 1.0, "d"),
            (1, 4, 3.0, 0.0, "e"), (1, 4, 3.0, 0.0, "e"), (None, 4, 0.0, 0.0, "f"), (1, None, 9.0, 9.0, "g")] * 3
    schema = "cell_i int, sourceId long, ra double, decl double, t string"
    want = sorted(map(tuple, rank_rows(spark.createDataFrame(rows, schema).coalesce(1), ["cell_i"],
                                       ["sourceId", "ra", "decl"]).collect()), key=repr)
    df = spark.createDataFrame(rows[::-1], schema).repartition(parts)
    got = sorted(map(tuple, rank_rows(df, ["cell_i"], ["sourceId", "ra", "decl"], rows_per_task=2).collect()), key=repr)
    assert got == want
    ranks = [r[-1] for r in got if r[0] == 1]
    assert sorted(ranks) == list(range(1, 22))
    capped = [sorted(map(tuple, capacity_split(d.withColumn("cell_j", F.lit(0)).withColumn("cell", F.lit("1.0")), cap=2)
                         .collect()), key=repr) for d in (df, spark.createDataFrame(rows, schema).coalesce(1))]
    assert capped[0] == capped[1]


def test_ranks_keep_columns_of_any_name(spark):
    names = ["row", "tie", "nth", "at", "part", "inside", "key0", "of", "of_key0", "shift", "first", "n"]
    df = spark.range(5).select("id", *[F.lit(c).alias(c) for c in names])
    out = rank_rows(df, ["row"], "id").orderBy("id").collect()
    assert [r["rank"] for r in out] == [1, 2, 3, 4, 5] and all(out[0][c] == c for c in names)
    assert rank_rows(df.limit(0), ["row"], "id").count() == 0


def test_stripe_goldens(spark, sources):
    pts = spark.createDataFrame([(float(x),) for x in (1, 359, 8, 17, 351, 10, 11, 111, 211, 0)], "ra double")
    got = {}
    for r in assign_stripes(pts).collect():
        got.setdefault(r.ra, set()).add(r.stripe)
    assert got == {1: {1, 40}, 359: {40, 1}, 8: {1, 2}, 17: {2, 3}, 351: {39, 40}, 10: {2, 1},
                   11: {2}, 111: {13}, 211: {24}, 0: {0, 1}}
    assert sorted(tuple(r) for r in assign_stripes(sources.select("ra")).groupBy("stripe").count().collect()) == [(40, 56)]


def _recursive_leaves(points, n, zone, cap):
    """Each point's leaf by plain recursion: coarsest node within the cap, of one position, or at the last level."""
    x0, x1, y0, y1 = zone
    top = (n << 30) - 1
    fine = {k: (min(top, max(0, int((x - x0) // ((x1 - x0) / (n << 30))))),
                min(top, max(0, int((y - y0) // ((y1 - y0) / (n << 30)))))) for k, x, y in points}
    at, leaves = {k: (x, y) for k, x, y in points}, {}

    def divide(level, ids):
        nodes = {}
        for k in ids:
            nodes.setdefault((fine[k][0] >> 30 - level, fine[k][1] >> 30 - level), []).append(k)
        for (i, j), own in nodes.items():
            if len(own) <= cap or level == 30 or len({at[k] for k in own}) == 1:
                leaves.update({k: (level, i, j) for k in own})
            else:
                divide(level + 1, own)
    divide(0, list(at))
    return leaves


@pytest.mark.parametrize("cap", [1, 2, 7, 60])
def test_adaptive_split_equals_recursion_at_every_depth(spark, cap):
    rnd = random.Random(cap)
    pts = [(rnd.uniform(0, 1), rnd.uniform(0, 1)) for _ in range(150)]
    pts += [(2.0 ** -k, 2.0 ** -(k + 1)) for k in range(40)]                # one step deeper each: 30 levels of skew
    pts += [(2.0 ** -33, 0.0)] * 5 + [(2.0 ** -34, 0.0)] * 5                # apart, but not at the last level
    pts += [(0.7, 0.7)] * 90 + [(0.7 + 1e-7, 0.7)] * 30                     # heavy single positions, side by side
    pts += [(0.0, 0.0), (1.0, 1.0)]
    rows = [(k, x, y) for k, (x, y) in enumerate(pts)]
    df = spark.createDataFrame(rows, "sourceId long, ra double, decl double").repartition(4)
    g = make_grid(Zone(0.0, 1.0, 0.0, 1.0), 4)
    split, seen = _evaluations(spark, df, "sourceId")
    got = {r.sourceId: (r.level, r.leaf_i, r.leaf_j) for r in adaptive_split(split, g, cap, rows_per_task=50).collect()}
    assert got == _recursive_leaves(rows, 2, (0.0, 1.0, 0.0, 1.0), cap)
    assert max(lv for lv, _, _ in got.values()) == (30 if cap < 60 else max(lv for lv, _, _ in got.values()))
    assert seen.value <= 2 * len(rows)          # the sample and the shuffle, whatever the depth


def test_zorder_codes(spark):
    from skygrid.operators.adaptive import common_level, zorder
    pairs = [(0, 0), (1, 0), (0, 1), (2**30 - 1, 0), (0, 2**30 - 1), (2**30 - 1, 2**30 - 1), (123456789, 987654321)]
    df = spark.createDataFrame(pairs, "i long, j long")
    got = [r.z for r in df.select(zorder(F.col("i"), F.col("j")).alias("z")).collect()]
    assert got == [sum((i >> k & 1) << 2 * k + 1 | (j >> k & 1) << 2 * k for k in range(30)) for i, j in pairs]
    codes = spark.createDataFrame([(0, 0), (0, 1), (0, 3), (0, 4), (0, 2**59), (0, 2**60 - 1)], "a long, b long")
    assert [r.v for r in codes.select(common_level(F.col("a"), F.col("b")).alias("v")).collect()] == [30, 29, 29, 28, 0, 0]


def test_adaptive_split_invariants(spark):
    rnd = random.Random(3)
    rows = [(k, rnd.gauss(0, 0.3), rnd.gauss(0, 1.0)) for k in range(3000)]
    rows += [(3000 + k, 0.001 + rnd.uniform(0, 1e-5), 0.001) for k in range(500)]     # needs many levels
    rows += [(4000 + k, 0.2, 0.2) for k in range(400)]                                # one single position
    df = spark.createDataFrame(rows, "sourceId long, ra double, decl double")
    g = make_grid(zone_of(df), 4)
    out = adaptive_split(df, g, cap=150)
    leaves = {r.leaf: r for r in adaptive_leaves(df, g, cap=150).collect()}
    counted = {r.leaf: r["count"] for r in out.groupBy("leaf").count().collect()}
    assert sum(counted.values()) == len(rows)
    assert counted == {k: r.n_rows for k, r in leaves.items()}
    # Every leaf obeys the cap, but the one that can't be divided.
    over = [r for r in leaves.values() if r.n_rows > 150]
    assert [r.indivisible for r in over] == [True] and over[0].n_rows >= 400
    # Rows lie in their leaf's box; leaves never nest.
    for r in out.collect():
        b = leaves[r.leaf]
        assert b.ra_lo - 1e-9 <= r.ra <= b.ra_hi + 1e-9 and b.decl_lo - 1e-9 <= r.decl <= b.decl_hi + 1e-9
    cells = {(r.level, r.leaf_i, r.leaf_j) for r in leaves.values()}
    for lvl, i, j in cells:
        for up in range(lvl):
            assert (up, i >> (lvl - up), j >> (lvl - up)) not in cells


def test_breakpoint_index_equals_walk_on_breakpoints(spark):
    from skygrid.functions.cells import breakpoint_index
    rnd = random.Random(0)
    rows, want = [], []
    for t in range(12):
        x0 = rnd.uniform(-10, 360)
        x1 = x0 + rnd.choice([rnd.uniform(1e-3, 5), rnd.uniform(1, 400)])
        n = rnd.randint(1, 26)
        bps = [x0 + k * ((x1 - x0) / n) for k in range(n + 1)]
        for x in bps + [rnd.uniform(x0 - 1, x1 + 1) for _ in range(10)] + [x1]:
            rows.append((t, x0, x1, n, float(x)))
            want.append(min(n, sum(1 for b in bps if b < x)))
    got = []
    for t in range(12):
        sub = [r for r in rows if r[0] == t]
        _, x0, x1, n, _ = sub[0]
        df = spark.createDataFrame([(r[4],) for r in sub], "x double")
        got += [r.i for r in df.select(breakpoint_index("x", x0, x1, n).alias("i")).collect()]
    assert got == want


def test_stripes_hold_the_points_of_their_widened_arcs(spark):
    from hypothesis import given, settings, strategies as st
    values = [float(v) for v in range(0, 361)] + [v + d for v in range(0, 361, 9) for d in (-1.0, 1.0, -1e-9, 1e-9)]

    def on_arc(ra, k):      # the arc of stripe k, a degree wider on both sides, anywhere around the circle
        return any((k - 1) * 9 - 1 <= ra + turn <= k * 9 + 1 for turn in (-360.0, 0.0, 360.0))

    @settings(max_examples=1, deadline=None)
    @given(st.lists(st.floats(min_value=0.0, max_value=360.0, allow_nan=False), min_size=200, max_size=200))
    def check(randoms):
        pts = [v for v in values + randoms if 0.0 <= v <= 360.0]
        df = spark.createDataFrame([(i, v) for i, v in enumerate(pts)], "k long, ra double")
        got = {}
        for r in assign_stripes(df).collect():
            got.setdefault(r.k, set()).add(r.stripe)
        for k, v in enumerate(pts):
            assert got[k] == ({0, 1} if v == 0.0 else {s for s in range(1, 41) if on_arc(v, s)}), v
    check()


def test_capped_histogram_equals_split(spark):
    from skygrid.operators.grid import capped_histogram
    rnd = random.Random(8)
    df = spark.createDataFrame([(k, rnd.choice([0, 0, 1]), rnd.choice([0, 2])) for k in range(1000)],
                               "sourceId long, cell_i int, cell_j int").withColumn("cell", F.concat_ws(".", "cell_i", "cell_j"))
    split = cell_histogram(capacity_split(df, cap=100), keys=("cell_i", "cell_j", "segment"))
    assert sorted(map(tuple, capped_histogram(df, cap=100).collect())) == sorted(map(tuple, split.collect()))


def test_points_without_a_position_have_no_cell(spark):
    from skygrid.functions.cells import exclusive_cell
    g = Grid(Zone(0.0, 2.0, 0.0, 2.0), 2)
    rows = [(None, 1.5), (1.5, None), (float("nan"), 1.5), (1.5, float("inf")), (1.5, 1.5), (0.0, 1.5)]
    df = spark.createDataFrame(rows, "ra double, decl double")
    i, j = exclusive_cell("ra", "decl", g)
    got = [tuple(r) for r in df.select(i.alias("i"), j.alias("j")).collect()]
    assert got == [(None, None), (2, None), (None, None), (2, None), (2, 2), (0, 0)]


@pytest.mark.parametrize("bad", [None, float("nan"), float("inf")])
def test_assignments_fail_on_a_row_without_a_position(spark, bad):
    g = Grid(Zone(0.0, 2.0, 0.0, 2.0), 2)
    df = spark.createDataFrame([(1, 1.0, 1.0), (2, bad, 1.0)], "sourceId long, ra double, decl double")
    for run in (lambda: assign_exclusive(df, g), lambda: assign_overlap(df, g), lambda: assign_stripes(df),
                lambda: adaptive_split(df, g, 1), lambda: zone_of(df)):
        with pytest.raises(Exception, match="RA is not a finite number"):
            out = run()
            out.collect()


def test_flat_extent(spark):
    df = spark.createDataFrame([(k, 5.0, float(k)) for k in range(4)], "sourceId long, ra double, decl double")
    g = make_grid(zone_of(df), 4)
    assert {r.cell_i for r in assign_exclusive(df, g).collect()} == {0}
    assert assign_overlap(df, g).select("sourceId").distinct().count() == 4
    assert adaptive_split(df, g, 1).select("leaf").distinct().count() == 4


def test_grid_side_ceiling():
    with pytest.raises(ValueError, match="ceiling"):
        make_grid(Zone(0, 1, 0, 1), 800_000)
    assert make_grid(Zone(0, 1, 0, 1), 800_000, ceiling=1_000_000).n == 895


def test_format_record_keeps_places(spark):
    from skygrid.functions.coords import format_record
    df = spark.createDataFrame([(None, 1.5)], "a double, b double")
    assert df.select(format_record("a", "b").alias("r")).first().r == "NULL,1.5"
