"""Write the physical plan of every ``queries()`` entry (after one run, so
AQE's final plan is shown) to PLANS.md, two lines per query."""

from __future__ import annotations

import collections
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.queries import queries  # noqa: E402
from tidemark.session import get_session  # noqa: E402

NODE = re.compile(r"^[\s:+\-|]*(?:\*\((\d+)\)\s*)?([A-Za-z][A-Za-z]*)(.*)$")
SHOWN = ("Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "Window", "MapInArrow",
         "FlatMapGroupsInArrow", "SortAggregate")


def digest(plan: str) -> list[str]:
    """Codegen stages, scans (columns, pushed filters), and the nodes that move or sort rows."""
    stages, scans, nodes = set(), [], collections.Counter()
    for line in plan.splitlines():
        m = NODE.match(line)
        if not m:
            continue
        stage, name, rest = m.groups()
        if stage:
            stages.add(stage)
        rest = re.sub(r"#\d+L?|\[plan_id=\d+\]|, ENSURE_REQUIREMENTS", "", rest)
        if name == "FileScan":
            cols = re.search(r"parquet \[([^\]]*)\]", rest)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", rest)
            at = re.search(r"paths\)\[[^\]]*/([a-z_]+)\.parquet", rest)
            scan = f"{at.group(1) if at else 'written table'}({cols.group(1) if cols else ''})"
            scans.append(scan + (f" where {pushed.group(1)[:60]}" if pushed and pushed.group(1) else ""))
        elif name == "Exchange":
            nodes["Exchange " + re.sub(r"\s+", " ", rest)[:70].strip(" ,")] += 1
        elif name in SHOWN:
            nodes[name] += 1
    out = [f"* {len(stages)} codegen stages; scans: " + "; ".join(f"{n}x {s}" if n > 1 else s for s, n in collections.Counter(scans).items())]
    return out + ["* " + "; ".join(f"{n}x {k}" if n > 1 else k for k, n in nodes.items())] if nodes else out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("tidemark-plans", master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    lines = ["# Physical plans", "",
             f"Final AQE plans at `{sf_dir}` (`local[8]`), produced by `tools/dump_plans.py`. Expressions",
             "and trees are left out: what is scanned, and what moves or sorts rows. A query that runs",
             "streams or folds batches shows the plan that reads its result.", ""]
    for name, fn in queries().items():
        df = fn(spark, sf_dir)
        qe = df._jdf.queryExecution()
        qe.executedPlan().execute().count()  # run this very plan so AQE finalises it
        plan = qe.executedPlan().toString().split("== Initial Plan ==")[0]  # the final plan only
        lines += [f"## {name}", ""] + digest(plan) + [""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines))


if __name__ == "__main__":
    main()
