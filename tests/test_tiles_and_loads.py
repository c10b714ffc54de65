"""Equal-load cells against row numbers; summaries of loads against the summary of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SOURCE_SAMPLE
from skygrid.operators.loads import compact_loads, merged_loads, start_loads, write_load
from skygrid.operators.summary import merge_extents, object_extent
from skygrid.operators.tiles import assign_tiles, tile_table
from skygrid.session import fresh_dir


@pytest.mark.parametrize("cells,n", [(1, 50), (4, 1000), (10, 997), (40, 1500), (40, 5), (6, 0)])
def test_tiles_hold_equal_loads_on_a_skewed_sky(spark, cells, n):
    rnd = random.Random(n)
    pts = [(k, rnd.gauss(0, 0.001), rnd.gauss(0, 0.001)) if k % 3 else (k, rnd.uniform(-2, 2), rnd.uniform(-7, 7))
           for k in range(n)]
    pts = [(k, 0.5, 0.5) if k % 10 == 1 else (k, x, y) for k, x, y in pts]      # a heavy single position
    df = spark.createDataFrame(pts, "sourceId long, ra double, decl double").withColumn("slab2", F.lit("kept")).repartition(3)
    out = assign_tiles(df, cells, rows_per_task=200)
    got = {r.sourceId: (r.slab, r.tile) for r in out.collect()}
    slabs = -int(-cells ** 0.5 // 1)
    tiles = -(-cells // slabs)
    by_ra = sorted(pts, key=lambda p: (p[1], p[2], p[0]))
    held = {}
    for r, p in enumerate(by_ra):
        held.setdefault(r * slabs // n, []).append(p)
    want = {p[0]: (s, r * tiles // len(own)) for s, own in held.items()
            for r, p in enumerate(sorted(own, key=lambda p: (p[2], p[1], p[0])))}
    assert got == want
    counts = [r.n_rows for r in tile_table(out).collect()]
    assert sum(counts) == n
    if n > 10 * cells:
        assert max(counts) <= 1.1 * n / cells + 1 and len(counts) == slabs * tiles
    for r in tile_table(out).collect():
        inside = [p for p in pts if got[p[0]] == (r.slab, r.tile)]
        assert (r.ra_lo, r.ra_hi, r.decl_lo, r.decl_hi) == (
            min(p[1] for p in inside), max(p[1] for p in inside), min(p[2] for p in inside), max(p[2] for p in inside))


def _rows(spark, n, seed):
    rnd = random.Random(seed)
    ids = [rnd.choice([rnd.randrange(-10**3, 10**3), rnd.randrange(-2**63, 2**63), rnd.randrange(100)]) for _ in range(n)]
    rows = [(i, rnd.choice([1, 1, 1, 2, 3, seed + 10, None]), rnd.uniform(-2, 2), rnd.uniform(-7, 7)) for i in ids]
    return spark.createDataFrame(rows, "sourceId long, objectId long, ra double, decl double")


def test_merged_loads_equal_the_summary_of_all_rows(spark):
    loads = {f"night-{k}": _rows(spark, 200, k) for k in range(3)}
    path = fresh_dir(spark, "loads")
    for name, rows in loads.items():
        write_load(rows, path, name)
    write_load(loads["night-1"], path, "night-1")                   # a replay
    write_load(_rows(spark, 5, 0).limit(0), path, "empty")
    union = loads["night-0"].unionByName(loads["night-1"]).unionByName(loads["night-2"])
    want = sorted(map(tuple, object_extent(union).collect()))
    assert sorted(map(tuple, merged_loads(spark, path).collect())) == want
    # Summaries of summaries, in any order.
    a, b, c = (object_extent(r) for r in loads.values())
    assert sorted(map(tuple, merge_extents(merge_extents(c.unionByName(a)).unionByName(b)).collect())) == want
    into = fresh_dir(spark, "compact")
    compact_loads(spark, path, into)
    write_load(_rows(spark, 100, 9), into, "night-3")
    assert sorted(map(tuple, merged_loads(spark, into).collect())) == sorted(
        map(tuple, object_extent(union.unionByName(_rows(spark, 100, 9))).collect()))
    with pytest.raises(ValueError):
        write_load(a, path, "x/../y")


def test_loads_of_a_stream_and_the_running_summary(spark, sources, tmp_path):
    from skygrid.streaming.incremental import read_source_stream
    lines = open(SOURCE_SAMPLE).read().splitlines()
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    for k in range(0, len(lines), 20):
        (incoming / f"part-{k:03d}.csv").write_text("\n".join(lines[k:k + 20]) + "\n")
    want = sorted(map(tuple, object_extent(sources).collect()))
    path = fresh_dir(spark, "streamloads")
    start_loads(read_source_stream(spark, str(incoming), 1), path, fresh_dir(spark, "ck")).awaitTermination()
    assert sorted(map(tuple, merged_loads(spark, path).collect())) == want
    # The same stream from the start again, with another checkpoint: every batch replaces itself.
    start_loads(read_source_stream(spark, str(incoming), 1), path, fresh_dir(spark, "ck")).awaitTermination()
    assert sorted(map(tuple, merged_loads(spark, path).collect())) == want
    # The aggregate itself also runs as a stateful stream.
    q = (object_extent(read_source_stream(spark, str(incoming), 1)).writeStream.format("memory").queryName("running_extent")
         .outputMode("complete").option("checkpointLocation", fresh_dir(spark, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("running_extent").collect())) == want
