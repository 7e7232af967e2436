"""Physical-plan summary of every registered query (markdown on stdout).

    python tools/plan_summary.py [sf_dir]

Counts shuffles, broadcasts, windows and join strategies in the formatted plan
of each query, and shows the partition filters of the day scan and of the
trailing window on a partitioned copy of the sf0.001 fixture.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from footfall.plans.catalog import QUERIES  # noqa: E402
from footfall.sources.fixtures import Fixture  # noqa: E402
from footfall.sources.trace import scan_day, trailing_window  # noqa: E402
from footfall.schemas import TRACE  # noqa: E402
from footfall.session import local_session  # noqa: E402

NODES = ["Exchange", "BroadcastExchange", "Window", "SortMergeJoin", "BroadcastHashJoin",
         "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "Generate"]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def counts(text: str) -> dict[str, int]:
    heads = re.findall(r"^\(\d+\) (\w+)", text, flags=re.M)
    return {n: heads.count(n) for n in NODES}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 16)
    print("| query | shuffles | broadcasts | windows | SMJ | BHJ | SHJ | nested loop | cartesian | explode |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        if name in ("partition_overwrite", "load_summary"):
            continue   # write side effects; their reads are plain scans
        c = counts(plan_text(fn(spark, sf_dir)))
        print(f"| {name} | {c['Exchange']} | {c['BroadcastExchange']} | {c['Window']} | {c['SortMergeJoin']} | "
              f"{c['BroadcastHashJoin']} | {c['ShuffledHashJoin']} | {c['BroadcastNestedLoopJoin']} | "
              f"{c['CartesianProduct']} | {c['Generate']} |")
    root = tempfile.mkdtemp(prefix="plans-", dir="/tmp")
    Fixture(spark, "/root/testdata/sf0.001").raw_trace().write.partitionBy("year", "month", "day") \
        .parquet(f"{root}/trace")
    trace = spark.read.schema(TRACE).option("basePath", f"{root}/trace").parquet(f"{root}/trace")
    for label, df in [("day scan 2024-01-15", scan_day(trace, "2024-01-15")),
                      ("trailing 30 days to 2024-01-31", trailing_window(trace, "2024-01-31", 30))]:
        text = plan_text(df)
        pf = re.search(r"PartitionFilters: (\[.*?\])\n", text)
        print(f"\n{label}: PartitionFilters: {pf.group(1) if pf else 'none'}")


if __name__ == "__main__":
    main()
