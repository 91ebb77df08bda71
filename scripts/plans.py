"""Summarise the executed (final adaptive) plans of the headline queries.

Usage: python scripts/plans.py [sf_dir] > docs/PLANS.md
For each query: the operators that move or reorder data (exchanges, joins,
windows, generators, sorts), top-level plan only, after execution so AQE's
final choices are shown.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bench import HEADLINE  # noqa: E402
from hourglass.plans.catalog import QUERIES  # noqa: E402
from hourglass.session import local_session  # noqa: E402

SHOW = ("Exchange", "Join", "Window", "Generate", "Sort", "TakeOrdered", "Union",
        "InMemoryTableScan", "Scan", "HashAggregate")


def _children(node):
    kids = node.children()
    return [kids.apply(i) for i in range(kids.size())]


def _walk(node, depth, out):
    name = node.nodeName()
    # unwrap adaptive/query-stage wrappers to the plan they executed
    for wrapper, getter in (("AdaptiveSparkPlan", "executedPlan"), ("ShuffleQueryStage", "plan"),
                            ("BroadcastQueryStage", "plan"), ("ResultQueryStage", "plan"),
                            ("TableCacheQueryStage", "plan")):
        if name.startswith(wrapper):
            return _walk(getattr(node, getter)(), depth, out)
    if name.startswith("ReusedExchange"):
        out.append("  " * depth + "ReusedExchange (shuffle output reused, not recomputed)")
        return out
    if any(k in name for k in SHOW):
        detail = ""
        if "Exchange" in name:
            detail = " " + str(node.outputPartitioning().toString())
        elif "Join" in name:
            detail = " " + re.sub(r"#\d+L?", "", str(node.simpleStringWithNodeId()))[len(name):][:90]
        elif name.startswith("Scan") and name != "Scan ExistingRDD" and "RDD" not in name:
            meta = node.metadata()
            parts = []
            for key in ("Location", "ReadSchema", "PushedFilters"):
                opt = meta.get(key)
                if opt.isDefined():
                    val = str(opt.get())
                    if key == "Location":
                        val = val.rsplit("/", 1)[-1].rstrip("]")
                    parts.append(f"{key}={val}")
            detail = " " + " ".join(parts)
        elif name.startswith("Scan"):
            detail = " (checkpointed rows)"
        elif "InMemoryTableScan" in name:
            detail = ""
        out.append("  " * depth + name + re.sub(r"#\d+L?", "", detail))
    if "InMemoryTableScan" in name:
        return out                      # do not descend into cached relations
    for c in _children(node):
        _walk(c, depth + 1, out)
    return out


def summary(df) -> list[str]:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()                  # run this plan itself, so AQE's final plan is shown
    return _walk(qe.executedPlan(), 0, [])


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=16)
    print(f"# Executed plans of the headline queries ({sf}, local[8], AQE on)\n")
    print("Generated by `scripts/plans.py`; only operators that move or reorder rows are shown.\n")
    for name in HEADLINE:
        print(f"## {name}\n\n```")
        for line in summary(QUERIES[name](spark, sf)):
            print(line)
        print("```\n")
        spark.catalog.clearCache()


if __name__ == "__main__":
    main()
