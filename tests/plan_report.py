"""Print the physical plan shape of every layer as Markdown (PLANS.md).

Each layer is planned from its materialised inputs (the default), so the
listing shows exactly the exchanges, joins, windows and aggregates that layer
runs.  Usage: python tests/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PATTERNS = [
    (r"ReusedExchange", "reused shuffle/broadcast output"),
    (r"Exchange (SinglePartition)", "shuffle"),
    (r"Exchange (\w+)\((.*?), \d+\), ", "shuffle"),
    (r"BroadcastExchange", "broadcast"),
    (r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin) \[([^\]]*)\], \[([^\]]*)\], (\w+)", "join"),
    (r"Window \[.*?\], \[([^\]]*)\]", "window"),
    (r"WindowGroupLimit \[([^\]]*)\].*?(Partial|Final)", "top1"),
    (r"(HashAggregate|SortAggregate|ObjectHashAggregate)\(keys?=\[([^\]]*)\]", "agg"),
    (r"Scan (parquet|ExistingRDD|In-memory)", "scan"),
    (r"Generate (explode\w*)", "generate"),
]


def clean(s: str) -> str:
    return re.sub(r"#\d+L?", "", s)


def shape(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.split("\n"):
        depth = (len(line) - len(line.lstrip(" :+-"))) // 3
        for pat, kind in PATTERNS:
            m = re.search(pat, line)
            if m:
                out.append("  " * depth + f"- {kind}: " + clean(" ".join(g for g in m.groups() if g)
                                                                   if m.groups() else kind))
                break
    return out


def main():
    from skylane.plans.contract import CONTRACT_RULES
    from skylane.plans.pipeline import build_layers
    from skylane.session import local_session
    from skylane.sources.fixture import fixture_sources

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    layers = build_layers(fixture_sources(spark, sf), CONTRACT_RULES)
    print("# PLANS — physical plan shape per layer\n")
    print(f"Generated by `python tests/plan_report.py` on `{os.path.basename(sf)}` with the "
          "contract rules; every layer is planned from its materialised inputs "
          "(`Scan ExistingRDD` = a checkpointed layer).  Indentation follows the plan tree "
          "(root first).  `shuffle` lines are the data movements of that layer; a branch "
          "that repeats an exchange of another branch (e.g. a per-segment summary read "
          "next to the rows it summarises) is executed once, because adaptive execution "
          "reuses identical query stages, so the count is an upper bound.\n")
    for name in ["flights_filtered", "fuel_chart_interpolated", "radar_in_terminal_area",
                 "fuel_at_points", "vertical_profile", "occupancy", "flight_consumption",
                 "ml_features"]:
        lines = shape(layers.plan(name))
        n_shuffle = sum("shuffle:" in x for x in lines)
        print(f"## {name}\n\n{n_shuffle} shuffle(s).\n\n```")
        print("\n".join(lines))
        print("```\n")


if __name__ == "__main__":
    main()
