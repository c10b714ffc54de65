"""The incremental partitioner gives the batch assignment, file batch by file batch."""

import pytest
from pyspark.sql import functions as F

from conftest import SOURCE_SAMPLE
from skygrid.functions.cells import Grid, Zone
from skygrid.functions.coords import unwrap_ra
from skygrid.operators.grid import assign_exclusive
from skygrid.operators.summary import zone_of
from skygrid.session import fresh_dir
from skygrid.sources.sinks import read_by_cell
from skygrid.streaming.incremental import (assigned_stream, cell_counts, read_source_stream,
                                           start_partitioning)


def _split_sample(tmp_path):
    lines = open(SOURCE_SAMPLE).read().splitlines()
    src = tmp_path / "incoming"
    src.mkdir()
    for k in range(0, len(lines), 20):
        (src / f"part-{k:03d}.csv").write_text("\n".join(lines[k:k + 20]) + "\n")
    return str(src)


def test_stream_partition_equals_batch(spark, sources, tmp_path):
    incoming = _split_sample(tmp_path)
    grid = Grid(zone_of(sources), 3)
    out, ckpt = fresh_dir(spark, "stream-out"), fresh_dir(spark, "stream-ckpt")
    q = start_partitioning(read_source_stream(spark, incoming, max_files_per_trigger=1), grid, out, ckpt)
    q.awaitTermination()
    got = read_by_cell(spark, f"{out}/data").groupBy("cell_i", "cell_j").count()
    want = assign_exclusive(sources, grid).groupBy("cell_i", "cell_j").count()
    assert sorted(got.collect()) == sorted(want.collect())


def test_stream_running_histogram(spark, sources, tmp_path):
    incoming = _split_sample(tmp_path)
    grid = Grid(zone_of(sources), 2)
    counts = cell_counts(assigned_stream(read_source_stream(spark, incoming), grid))
    q = (counts.writeStream.format("memory").queryName("cell_counts_test")
         .outputMode("complete").option("checkpointLocation", fresh_dir(spark, "hist-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.cell_i, r.cell_j, r.n_rows) for r in spark.table("cell_counts_test").collect())
    assert got == [(0, 0, 1), (1, 0, 1), (1, 1, 15), (1, 2, 14), (2, 1, 2), (2, 2, 23)]


def test_run_partitioning_exclusive_and_overlap(spark, sources):
    from skygrid.plans.partitioning import run_partitioning
    res = run_partitioning(spark, SOURCE_SAMPLE, fresh_dir(spark, "prog"), min_cells=4)
    got = sorted((r.cell_i, r.cell_j, r.n_rows) for r in res.histogram.collect())
    assert got == [(0, 0, 1), (1, 0, 1), (1, 1, 15), (1, 2, 14), (2, 1, 2), (2, 2, 23)]
    # The grid file numbers cells as the directories do: 1 to n, and 0 for the minimum edges.
    stored = {(r.cell_i, r.cell_j): r for r in spark.read.json(res.grid_path).collect()}
    assert len(stored) == 2 * 3 + 1 and res.n_rows == 56
    assert {k: r.members for k, r in stored.items() if r.members} == {(i, j): n for i, j, n in got}
    for r in read_by_cell(spark, res.data_path).collect():
        box = stored[(r.cell_i, r.cell_j)]
        assert box.ra_lo <= r.ra <= box.ra_hi and box.decl_lo <= r.decl <= box.decl_hi
    res = run_partitioning(spark, SOURCE_SAMPLE, fresh_dir(spark, "prog2"), mode="overlap",
                           min_cells=9, cap=10)
    hist = {r.cell: r.n_rows for r in res.histogram.collect()}
    assert sum(hist.values()) == 3 * (19 + 13 + 37)
    assert max(hist.values()) <= 10 and hist["0.2bisbisbis"] == 7
    back = read_by_cell(spark, res.data_path)
    assert back.where(F.col("ra") < 0).count() == 0   # records keep the original RA


def test_stream_capped_partition_continues_counts(spark, sources, tmp_path):
    from skygrid.plans import jobs
    from skygrid.streaming.incremental import start_capped_partitioning
    lines = open(SOURCE_SAMPLE).read().splitlines()
    incoming = tmp_path / "capped-in"
    incoming.mkdir()
    # files in sourceId order, so arrival order equals sourceId order
    rows = sorted(lines, key=lambda l: int(l.split(",")[0]))
    import os
    for n, k in enumerate(range(0, len(rows), 20)):
        f = incoming / f"part-{k:03d}.csv"
        f.write_text("\n".join(rows[k:k + 20]) + "\n")
        os.utime(f, (1_700_000_000 + 100 * n, 1_700_000_000 + 100 * n))
    pts = jobs.wrapped(sources)
    grid = Grid(zone_of(pts), 3)
    out, ckpt = fresh_dir(spark, "capped-out"), fresh_dir(spark, "capped-ckpt")
    q = start_capped_partitioning(read_source_stream(spark, str(incoming), max_files_per_trigger=1),
                                  grid, out, ckpt, cap=10)
    q.awaitTermination()
    got = spark.read.parquet(f"{out}/data")
    got = sorted((r.sourceId, r.ra, int(r.cell_i), int(r.cell_j), int(r.segment)) for r in got.collect())
    want = jobs.capacity_split(jobs.assign_overlap(pts, grid, 0.1), 10).withColumn("ra", unwrap_ra("ra"))
    want = sorted((r.sourceId, r.ra, r.cell_i, r.cell_j, r.segment) for r in want.collect())
    assert got == want


def test_run_partitioning_grid_file(spark):
    from skygrid.plans.partitioning import run_partitioning
    res = run_partitioning(spark, SOURCE_SAMPLE, fresh_dir(spark, "prog3"), mode="overlap",
                           min_cells=9, cap=10)
    meta = {r.cell_i * 10 + r.cell_j: r for r in spark.read.json(res.grid_path).collect()}
    assert len(meta) == 9
    assert sum(r.members for r in meta.values()) == 3 * (19 + 13 + 37)
    assert meta[2].members == 37 and meta[2].segments == 4 and meta[2].grid_side == 3


def _lines(rows):
    from skygrid.sources.schema import SOURCE_SCHEMA
    out = []
    for k, ra, decl in rows:
        fields = ["NULL"] * len(SOURCE_SCHEMA)
        fields[0], fields[6], fields[9] = str(k), str(ra), str(decl)
        out.append(",".join(fields))
    return "\n".join(out) + "\n"


def test_stream_accounts_for_points_beyond_the_grid(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    (incoming / "a.csv").write_text(_lines([(1, 0.5, 0.5), (2, 359.5, 0.0), (3, 5.0, 5.0)]))
    grid = Grid(Zone(-1.0, 1.0, -1.0, 1.0), 2)
    out = fresh_dir(spark, "outside")
    start_partitioning(read_source_stream(spark, str(incoming)), grid, out, fresh_dir(spark, "ck"),
                       overlap=True).awaitTermination()
    inside = {(r.sourceId, r.ra) for r in spark.read.parquet(f"{out}/data").collect()}
    outside = {(r.sourceId, r.ra) for r in spark.read.parquet(f"{out}/outside").collect()}
    assert inside == {(1, 0.5), (2, 359.5)} and outside == {(3, 5.0)}      # RA as it was read


def test_stream_fails_on_damaged_counts(spark, tmp_path):
    from skygrid.streaming.incremental import start_capped_partitioning
    incoming = tmp_path / "in"
    incoming.mkdir()
    grid, out, ckpt = Grid(Zone(-1.0, 1.0, -1.0, 1.0), 1), fresh_dir(spark, "damaged"), fresh_dir(spark, "ck")

    def run():
        q = start_capped_partitioning(read_source_stream(spark, str(incoming)), grid, out, ckpt, cap=10)
        q.awaitTermination()
    (incoming / "a.csv").write_text(_lines([(k, 0.1, 0.1) for k in range(15)]))
    run()
    counts = out.replace("file:", "") + "/_counts/batch=0"
    import glob
    import os
    for f in glob.glob(counts + "/*.parquet") + glob.glob(counts + "/.*.crc"):
        with open(f, "wb") as h:
            h.write(b"damaged")
    assert os.path.isdir(counts)
    (incoming / "b.csv").write_text(_lines([(100 + k, 0.1, 0.1) for k in range(5)]))
    with pytest.raises(Exception):
        run()


def test_run_partitioning_stripes_and_leaves(spark, sources):
    from skygrid.plans.partitioning import run_partitioning
    res = run_partitioning(spark, SOURCE_SAMPLE, fresh_dir(spark, "stripes"), mode="stripe")
    assert [tuple(r) for r in res.histogram.select("stripe", "n_rows").collect()] == [(40, 56)]
    res = run_partitioning(spark, SOURCE_SAMPLE, fresh_dir(spark, "leaves"), mode="adaptive", min_cells=None, cap=10)
    rows = res.histogram.collect()
    assert sum(r.n_rows for r in rows) == 56 and max(r.n_rows for r in rows) <= 10
    assert spark.read.json(res.grid_path).count() == len(rows)


@pytest.mark.parametrize("mode", ["exclusive", "overlap", "stripe", "adaptive", "htm"])
def test_run_partitioning_bad_lines(spark, tmp_path, mode):
    from skygrid.plans.partitioning import run_partitioning
    f = tmp_path / "dirty.csv"
    f.write_text(_lines([(1, 1.0, 1.0), (2, "abc", 1.0), (3, "NaN", 1.0), (4, "NULL", 2.0), (5, 2.0, 2.0)]))
    with pytest.raises(Exception):
        run_partitioning(spark, str(f), fresh_dir(spark, "bad"), mode=mode, min_cells=4)
    res = run_partitioning(spark, str(f), fresh_dir(spark, "good"), mode=mode, min_cells=4, on_bad="report")
    back = spark.read.parquet(res.data_path).select("sourceId").distinct().collect()
    assert res.n_rejects == 3 and {r.sourceId for r in back} == {1, 5}
    assert sorted(map(tuple, spark.read.parquet(res.rejects_path).select("sourceId", "reject").collect())) == [
        (2, "RA malformed"), (3, "RA not finite"), (4, "RA missing")]


@pytest.mark.parametrize("mode", ["exclusive", "overlap", "stripe", "adaptive", "htm"])
def test_the_program_reads_its_input_once(spark, tmp_path, monkeypatch, mode):
    from skygrid.plans import partitioning
    f = tmp_path / "in.csv"
    f.write_text(_lines([(k, 0.1 * k, 0.05 * k) for k in range(40)]))
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(v):
        seen.add(1)
        return v
    read = partitioning.read_checked_sources
    monkeypatch.setattr(partitioning, "read_checked_sources", lambda *a: read(*a).withColumn(
        "ra", counted.asNondeterministic()("ra")))
    res = partitioning.run_partitioning(spark, str(f), fresh_dir(spark, "once"), mode=mode, min_cells=4, cap=7)
    assert seen.value == 40 == res.n_rows
    assert res.histogram.selectExpr("sum(n_rows)").first()[0] >= 40


def test_partition_on_the_sphere(spark, tmp_path):
    from skygrid.plans.partitioning import run_partitioning
    f = tmp_path / "in.csv"
    points = [(k, 360.0 * k / 50, 90.0 - 180.0 * k / 49) for k in range(50)]
    f.write_text(_lines(points))
    res = run_partitioning(spark, str(f), fresh_dir(spark, "htm"), mode="htm", htm_level=2)
    back = read_by_cell(spark, res.data_path, keys=("htm_id",)).collect()
    assert sorted((r.sourceId, r.ra, r.decl) for r in back) == points
    assert all(128 <= r.htm_id < 256 for r in back)
    assert {(r.htm_id, r.n_rows) for r in spark.read.json(res.grid_path).collect()} == {
        (i, sum(r.htm_id == i for r in back)) for i in {r.htm_id for r in back}}


@pytest.mark.parametrize("mode,box", [("exclusive", (1.0, 2.2, 0.5, 1.1)), ("exclusive", (0.0, 0.3, -9.0, 9.0)),
                                      ("exclusive", (359.0, 0.4, -1.0, 0.2)), ("overlap", (359.0, 0.4, -1.0, 0.2)),
                                      ("overlap", (0.5, 0.5, -9.0, 9.0)), ("overlap", (5.0, 6.0, 0.0, 1.0))])
def test_region_lookup_reads_only_directories_that_meet_the_box(spark, tmp_path, mode, box):
    import random
    from skygrid.plans.partitioning import region_lookup, run_partitioning
    rnd = random.Random(3)
    points = [(k, round(rnd.uniform(-1.5, 3.0), 3) % 360.0, round(rnd.uniform(-1, 2), 3)) for k in range(600)]
    points += [(1000 + k, x, y) for k, (x, y) in enumerate([(0.0, -1.5), (0.5, 0.2), (358.5, 2.0), (3.0, 2.0), (0.5, -1.5)])]
    f = tmp_path / "in.csv"
    f.write_text(_lines(points))
    res = run_partitioning(spark, str(f), fresh_dir(spark, "lookup"), mode=mode, min_cells=49, cap=5, halo=0.05)
    a, b, c, d = box
    want = sorted(p for p in points if (a <= p[1] <= b if a <= b else p[1] >= a or p[1] <= b) and c <= p[2] <= d)
    out = region_lookup(spark, res, *box)
    assert sorted(map(tuple, out.collect())) == want
    assert "dynamicpruningexpression" in out._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = region_lookup(spark, res, *box)
        again.collect()
        leaves = again._jdf.queryExecution().executedPlan().collectLeaves()
        read = [leaves.apply(k) for k in range(leaves.size())]
        partitions = max(int(s.metrics().apply("numPartitions").value()) for s in read
                         if "FileScan parquet" in s.toString())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    spans = [(a, b)] if a <= b else [(a, 360.0), (-360.0, b)]
    if mode == "overlap":
        spans = [tuple(x - 360.0 if x > 180.0 else x for x in (a, b))]
    stored = spark.read.json(res.grid_path).where("members > 0").collect()
    meeting = [r for r in stored
               if r.decl_lo <= d + 1e-9 and r.decl_hi >= c - 1e-9
               and any(r.ra_lo <= y + 1e-9 and r.ra_hi >= x - 1e-9 for x, y in spans)]
    # Pruned by each of the two keys: the directories of the meeting rows and columns.
    crossed = [r for r in stored if r.cell_i in {m.cell_i for m in meeting} and r.cell_j in {m.cell_j for m in meeting}]
    assert len(meeting) <= partitions == len(crossed) <= len(meeting) + 1 < len(stored)


def test_lookup_needs_a_grid(spark, tmp_path):
    from skygrid.plans.partitioning import region_lookup, run_partitioning
    f = tmp_path / "in.csv"
    f.write_text(_lines([(1, 1.0, 1.0)]))
    res = run_partitioning(spark, str(f), fresh_dir(spark, "stripe"), mode="stripe")
    with pytest.raises(ValueError, match="grid"):
        region_lookup(spark, res, 0, 1, 0, 1)
