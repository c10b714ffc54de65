"""Physical-plan properties of the registered catalogue queries.

No Cartesian product or nested-loop join, no sort-based or object
aggregation, no Python evaluation, no interpreted lambda functions, and every
file scan reads a pruned schema
(the stand-in catalogue reads two or three of the six ``events`` columns).
"""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate",
             "ObjectHashAggregate", "BatchEvalPython", "ArrowEvalPython", "lambdafunction")


def _check(plan: str) -> None:
    assert [op for op in FORBIDDEN if op in plan] == []
    for scan in re.findall(r"FileScan parquet .*", plan):
        if "/events.parquet" in scan:
            columns = re.search(r"ReadSchema: struct<([^>]*)>", scan)[1]
            assert len(columns.split(",")) <= 4, columns


@pytest.mark.parametrize("name", sorted(E.core_queries()))
def test_plan_properties(spark, monkeypatch, name):
    """The plan as it ran, and the plans of the tables written while the query is built."""
    import skygrid.session as session
    from skygrid.operators import adaptive, neighbours, ranks

    def watched(df, *args, **kwargs):
        _check(df._jdf.queryExecution().executedPlan().toString())
        return session.cut_lineage(df, *args, **kwargs)
    for module in (adaptive, neighbours, ranks):
        monkeypatch.setattr(module, "cut_lineage", watched)
    df = E.core_queries()[name](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not plan.startswith("AdaptiveSparkPlan isFinalPlan=false")
    _check(plan)


def test_filters_reach_the_catalogue_scan(spark, tmp_path):
    import shutil
    from conftest import SOURCE_SAMPLE
    from skygrid.operators.summary import object_extent
    from skygrid.sources.catalogue import read_sources
    path = tmp_path / "sources.csv"       # a path no cached frame covers
    shutil.copy(SOURCE_SAMPLE, path)
    plan = object_extent(read_sources(spark, str(path)))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(objectId)]" in plan
    assert "ReadSchema: struct<sourceId:bigint,objectId:bigint,ra:string,decl:string>" in plan
    assert "HashAggregate" in plan and "partial_" in plan
