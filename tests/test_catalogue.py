"""Schema, scans and per-object summaries on the 56-line source sample."""

import pytest
from pyspark.sql import functions as F

from conftest import OBJECT_SAMPLE, SOURCE_SAMPLE
from skygrid.operators.summary import (bounding_zone, bounding_zone_wrapped, count_by_object,
                                       count_lines_containing, object_extent, zone_description)
from skygrid.sources.catalogue import (read_checked_sources, read_lines, read_objects, read_sources, source_lines,
                                       write_source_files)
from skygrid.sources.schema import OBJECT_ID, OBJECT_SCHEMA, position, SOURCE_ID, SOURCE_SCHEMA
from skygrid.session import fresh_dir


def test_schema_positions_and_lengths():
    s, o = SOURCE_SCHEMA, OBJECT_SCHEMA
    assert len(s) == 107 and len(o) == 229
    assert s.fieldNames()[0] == "sourceId"
    assert s.fieldNames()[3] == "objectId"
    assert s.fieldNames()[106] == "flagForWcs"
    assert o.fieldNames()[0] == "objectId"
    assert o.fieldNames()[23] == "extendedness"
    assert o.fieldNames()[228] == "subChunkId"
    assert [position(s, c) for c in ("sourceId", "objectId", "ra", "decl")] == [0, 3, 6, 9]


def test_schema_types():
    s = {f.name: f.dataType.simpleString() for f in SOURCE_SCHEMA}
    assert s["sourceId"] == "bigint" and s["ra"] == "double" and s["filterId"] == "smallint"
    assert s["flagForWcs"] == "int"
    o = {f.name: f.dataType.simpleString() for f in OBJECT_SCHEMA}
    assert o["iauId"] == "string"


def test_scan_counts(spark, sources):
    assert sources.count() == 56
    assert read_objects(spark, OBJECT_SAMPLE).count() == 50
    assert read_lines(spark, SOURCE_SAMPLE).count() == 56
    assert sources.where(F.col("objectId").isNotNull()).count() == 6


def test_count_by_object(sources):
    rows = count_by_object(sources).collect()
    assert [(r.objectId, r.n_sources) for r in rows] == [(430209694171136, 6)]


def test_object_extent_golden(sources):
    rows = object_extent(sources).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.objectId == 430209694171136
    assert r.n_sources == 6
    assert r.last_source_id == "29809086638981597"
    assert abs(r.min_ra - 357.9893337673741) < 1e-14
    assert abs(r.max_ra - 357.9894411124743) < 1e-14
    assert abs(r.min_decl - 2.5646291352701804) < 1e-14
    assert abs(r.max_decl - 2.564762701468148) < 1e-14


def test_latest_source_is_text_order(spark):
    df = spark.createDataFrame([(1, 9, 0.0, 0.0), (1, 10, 0.0, 0.0)],
                               "objectId long, sourceId long, ra double, decl double")
    assert object_extent(df).first().last_source_id == "9"


def test_bounding_zones(sources):
    z = bounding_zone(sources).first()
    assert (z.min_ra, z.max_ra) == (357.9542095807038, 358.0904167299142)
    assert (z.min_decl, z.max_decl) == (2.5646291352701804, 3.1752713951351934)
    w = bounding_zone_wrapped(sources).first()
    assert (w.min_ra, w.max_ra) == (-2.0457904192962246, -1.9095832700858182)
    text = zone_description(bounding_zone(sources)).first().zone
    assert text == "minRA : 357.954210, maxRA : 358.090417, minDecl : 2.564629, maxDecl : 3.175271"


def test_source_lines_round_trip(spark, sources):
    path = fresh_dir(spark, "rt")
    cols = ["sourceId", "objectId", "ra", "decl"]
    write_source_files(sources.select(*cols), path)
    back = read_sources(spark, path).select(*cols)
    assert sorted(back.collect()) == sorted(sources.select(*cols).collect())
    line = source_lines(sources.select(*cols)).first().value
    assert line.count(",") == 106 and line.split(",")[1] == "NULL"


def test_lines_containing_matches_python(spark):
    text = ["alpha\nbeta\n", "", "no match\nxyz", "abc"]
    df = spark.createDataFrame([(t,) for t in text], "value string")
    from skygrid.plans.text import document_lines
    lines = document_lines(df.withColumnRenamed("value", "text"))
    got = count_lines_containing(lines).first()
    expected = [l for t in text for l in t.split("\n")]
    assert got.lines_with_a == sum("a" in l for l in expected)
    assert got.lines_with_b == sum("b" in l for l in expected)


@pytest.mark.parametrize("mode", ["PERMISSIVE"])
def test_short_rows_padded_and_filterable(spark, tmp_path, mode):
    p = tmp_path / "short.csv"
    p.write_text("1, 2 ,3,NULL,5,6,  10.5 ,7,8,-1.25\n2,3\n")
    df = read_sources(spark, str(p), mode).select("sourceId", "objectId", "ra", "decl")
    rows = sorted(df.collect())
    assert rows[0].ra == 10.5 and rows[0].decl == -1.25 and rows[0].objectId is None
    assert rows[1].ra is None


def test_document_lines_split_on_all_terminators(spark):
    from skygrid.plans.text import document_lines
    df = spark.createDataFrame([("a1\r\nb1\rc1\nd1",), ("x\ny\n",), ("",)], "text string")
    got = sorted(r.value for r in document_lines(df).collect())
    assert got == sorted(["a1", "b1", "c1", "d1", "x", "y", "", ""])


def test_failfast_rejects_bad_numbers_in_read_columns(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("1,0,3,NULL,5,6,abc,7,8,-1.25\n")
    with pytest.raises(Exception):
        read_sources(spark, str(p), "FAILFAST").select("ra", "decl").collect()
    # Other modes don't hide a bad position either; only columns that are read are parsed.
    with pytest.raises(Exception, match="ra is not a number: abc"):
        read_sources(spark, str(p)).select("ra", "decl").collect()
    assert read_sources(spark, str(p)).select("decl").first().decl == -1.25


def test_latest_source_text_order_edge_ids(spark):
    groups = {1: [-5, -40, -123], 2: [-(2 ** 63), -9], 3: [0, -1], 4: [9, 10, 1, 100],
              5: [2 ** 63 - 1, 999999999999999999], 6: [120, 12, 1200]}
    rows = [(g, v, 0.0, 0.0) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "objectId long, sourceId long, ra double, decl double")
    got = {r.objectId: r.last_source_id for r in object_extent(df).collect()}
    assert got == {g: max(str(v) for v in vs) for g, vs in groups.items()}


def _line(**values):
    from skygrid.sources.schema import SOURCE_SCHEMA, position
    fields = ["NULL"] * len(SOURCE_SCHEMA)
    for name, value in values.items():
        fields[position(SOURCE_SCHEMA, name)] = str(value)
    return ",".join(fields)


def test_no_malformed_field_is_lost(spark, tmp_path):
    """A malformed id neither vanishes from a count nor becomes a silent null."""
    from skygrid.sources.catalogue import read_checked_sources
    p = tmp_path / "ids.csv"
    p.write_text("\n".join([_line(sourceId=1, objectId="x12", ra=1.0, decl=1.0), _line(sourceId="zz", objectId=5, ra=1.0, decl=1.0),
                            _line(sourceId=3, objectId=5, ra=1.0, decl=1.0)]) + "\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        count_by_object(read_sources(spark, str(p))).collect()
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        object_extent(read_sources(spark, str(p))).collect()
    checked = {r.reject: r for r in read_checked_sources(spark, str(p)).collect()}
    assert set(checked) == {"objectId malformed", "sourceId malformed", None}
    assert [tuple(e) for e in checked["objectId malformed"].errors] == [("objectId", "malformed")]
    good = read_checked_sources(spark, str(p)).where("reject IS NULL")
    assert [tuple(r) for r in count_by_object(good).collect()] == [(5, 1)]


def test_every_line_has_a_verdict(spark, tmp_path):
    from skygrid.sources.catalogue import read_checked_sources
    ok = dict(sourceId=1, objectId=2, ra=1.5, decl=-2.5)
    cases = [(_line(**ok), [], None), (_line(**{**ok, "objectId": "NULL"}), [], None),
             (" 7 ,NULL,NULL, 8\t,NULL,NULL, 1e1 ,NULL,NULL,-1", [("line", "short")], None),
             ("7,NULL,NULL,8,NULL,NULL,1", [("decl", "missing"), ("line", "short")], "Decl missing"),
             (_line(**ok) + ",more", [("line", "long")], None),
             (_line(**{**ok, "ra": "NaN", "decl": "12x", "sourceId": "9e3", "objectId": ""}),
              [("ra", "not finite"), ("decl", "malformed"), ("sourceId", "malformed"), ("objectId", "malformed")], "RA not finite"),
             (_line(objectId=1, ra=1, decl="Infinity"), [("decl", "not finite"), ("sourceId", "missing")], "Decl not finite"),
             (_line(**{**ok, "sourceId": 2 ** 63}), [("sourceId", "malformed")], "sourceId malformed"),
             (",,,", [("ra", "missing"), ("decl", "missing"), ("sourceId", "malformed"), ("objectId", "malformed"),
                      ("line", "short")], "RA missing")]
    p = tmp_path / "lines.csv"
    for line, errors, reject in cases:
        p.write_text(f"\n  \n{line}\n\n")
        [r] = read_checked_sources(spark, str(p)).collect()
        assert ([tuple(e) for e in r.errors], r.reject) == (errors, reject), line
    p.write_text("\n".join(c[0] for c in cases))
    strict = read_checked_sources(spark, str(p), whole_lines=True)
    assert strict.count() == len(cases)
    assert strict.where("reject IS NULL").count() == 2
    assert strict.where("reject = 'line long'").count() == 1
    wide = read_checked_sources(spark, str(p), ("sourceId", "psfFlux", "ra", "decl")) if "psfFlux" in read_sources(
        spark, str(p)).columns else read_checked_sources(spark, str(p), ("sourceId", "htmId20", "ra", "decl"))
    assert wide.columns[1] in ("psfFlux", "htmId20")


def test_triangles_of_the_sphere(spark):
    """Every position, the poles and RA 0 and 360 included, lies in exactly one triangle of each level."""
    import math
    import random
    from skygrid.functions.htm import CORNERS, OCTANTS, ancestor, with_htm
    rnd = random.Random(1)
    pts = [(rnd.uniform(0, 360), math.degrees(math.asin(rnd.uniform(-1, 1)))) for _ in range(300)]
    pts += [(ra, decl) for ra in (0.0, 90.0, 180.0, 270.0, 360.0, -45.0, 123.4) for decl in (-90.0, -45.0, 0.0, 45.0, 90.0)]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pts)] + [(-1, None, 1.0), (-2, 1.0, float("nan"))],
                               "k long, a double, d double").withColumn("row", F.lit("kept")).withColumn("htm", F.lit("kept"))

    def triangles(level):
        found = {8 + o: tuple(tuple(map(float, CORNERS[c])) for c in t) for o, t in enumerate(OCTANTS)}

        def mid(p, q):
            s = [x + y for x, y in zip(p, q, strict=True)]
            n = math.sqrt(sum(x * x for x in s))
            return tuple(x / n for x in s)
        for _ in range(level):
            found = {i * 4 + n: c for i, (u, v, w) in found.items() for a, b, m in [(mid(v, w), mid(u, w), mid(u, v))]
                     for n, c in enumerate([(u, m, b), (v, a, m), (w, b, a), (a, b, m)])}
        return found

    def depth(p, t):
        u, v, w = t
        return min((a[1] * b[2] - a[2] * b[1]) * p[0] + (a[2] * b[0] - a[0] * b[2]) * p[1]
                   + (a[0] * b[1] - a[1] * b[0]) * p[2] for a, b in ((u, v), (v, w), (w, u)))
    for level in (0, 1, 3):
        out = with_htm(df, level, "a", "d").collect()
        assert len(out) == len(df.collect()) and all(r.row == "kept" and r.htm == "kept" for r in out)
        ids, every = {r.k: r.htm_id for r in out}, triangles(level)
        assert ids.pop(-1) is None and ids.pop(-2) is None
        for k, (ra, decl) in enumerate(pts):
            a, d = math.radians(ra), math.radians(decl)
            p = (math.cos(d) * math.cos(a), math.cos(d) * math.sin(a), math.sin(d))
            assert depth(p, every[ids[k]]) >= -1e-12, (ra, decl)
            if k < 300:     # inside: no other triangle holds it
                assert [i for i, t in every.items() if depth(p, t) >= 0] == [ids[k]]
    deep = with_htm(with_htm(df, 7, "a", "d", "deep"), 3, "a", "d")
    assert deep.where(ancestor(F.col("deep"), 3, 7) != F.col("htm_id")).count() == 0
    with pytest.raises(ValueError):
        with_htm(df, 11, "a", "d")


def test_checked_lines_are_split_once(spark, tmp_path):
    """A filter on the verdict must not be pushed below the split of the line."""
    path = str(tmp_path / "lines")
    n = len(SOURCE_SCHEMA)
    rows = [["1", "NULL", "2", "7", "NULL", "3", "1.5", "NULL", "0.1", "-2.5"] + ["NULL"] * (n - 10),
            ["2", "NULL", "2", "x7", "NULL", "3", "1.5", "NULL", "0.1", "-2.5"] + ["NULL"] * (n - 9),
            ["3", "NULL", "2", "7", "NULL", "3", "abc"]]
    spark.createDataFrame([(",".join(r),) for r in rows], "value string").coalesce(1).write.text(path)
    checked = read_checked_sources(spark, path)
    got = {r[SOURCE_ID]: (r[OBJECT_ID], r["reject"], [(e.field, e.reason) for e in r["errors"]]) for r in checked.collect()}
    assert got == {1: (7, None, []), 2: (None, "objectId malformed", [("objectId", "malformed"), ("line", "long")]),
                   3: (7, "RA malformed", [("ra", "malformed"), ("decl", "missing"), ("line", "short")])}
    good = checked.where(F.col("reject").isNull()).select(OBJECT_ID)
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1, plan
    assert [r[0] for r in good.collect()] == [7]


def test_good_and_bad_lines_are_counted_in_one_scan(spark, tmp_path):
    """The written lines are read once; runs of columns that the frame lacks are one literal; blank lines stay out."""
    import __spark_entry__ as E
    rows = [(1, 7, "view"), (2, 7, "view"), (3, 8, "error"), (4, 8, "view"), (13, 7, "view"), (22, 9, "error"), (5, 8, "view")]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    out = E.queries()["count_good_objects"](spark, str(tmp_path))
    assert out.dtypes == [(OBJECT_ID, "bigint"), ("n_sources", "bigint")]
    assert {tuple(r) for r in out.collect()} == {(7, 2), (8, 1), (None, 2)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("] text") == 1 and "Union" not in plan, plan
    lines = source_lines(spark.range(1).select(F.col("id").alias(SOURCE_ID)))
    assert lines.first().value == "0" + ",NULL" * (len(SOURCE_SCHEMA) - 1)
    assert lines._jdf.queryExecution().analyzed().toString().count("NULL,NULL") > 0
    path = str(tmp_path / "lines")
    spark.createDataFrame([(v,) for v in ("", " \t ", "  1,NULL,2,7", "\f\v", " x")], "value string").write.text(path)
    assert {r[SOURCE_ID] for r in read_checked_sources(spark, path).collect()} == {1, None}
    assert read_checked_sources(spark, path).count() == 2
