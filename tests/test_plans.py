"""Plan properties: no nested-loop or cartesian joins, partition pruning on day scans."""

from __future__ import annotations

import contextlib
import io
import os

import pytest

import __spark_entry__ as entry
from footfall.plans.catalog import QUERIES
from footfall.schemas import TRACE
from footfall.sources.fixtures import Fixture
from footfall.sources.trace import scan_day, trailing_window

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
SIDE_EFFECTS = {"partition_overwrite", "load_summary", "frequency_incremental", "changed_user_days", "dwells_refreshed"}


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SIDE_EFFECTS))
def test_no_nested_loop_cartesian_or_python(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                        "FlatMapCoGroupsInPandas", "AggregateInPandas", "MapInArrow"):
        assert python_node not in plan          # everything stays in the JVM


def test_day_scan_and_window_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "trace")
    Fixture(spark, SF).raw_trace().write.partitionBy("year", "month", "day").parquet(path)
    trace = spark.read.schema(TRACE).option("basePath", path).parquet(path)
    day = _plan(scan_day(trace, "2024-01-15"))
    assert "PartitionFilters: [" in day and "(day#" in day.split("PartitionFilters: [", 1)[1].split("]")[0]
    window = _plan(trailing_window(trace, "2024-01-31", 30))
    filters = window.split("PartitionFilters: [", 1)[1].split("]")[0]
    assert "make_date" in filters and "(year#" in filters
    assert scan_day(trace, "2024-01-15").count() == 26      # the 2024-01-15 slice of sf0.001
