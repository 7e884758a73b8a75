"""Write PLANS.md: physical-plan facts of the benchmark queries.

For each query: number of shuffles (Exchange), broadcasts, Python stages,
sorts, window operators, and the pushed filters / read schemas of its scans,
taken from the executed plan at the given scale factor (AQE final plan).
"""
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from quern.session import get_session  # noqa: E402
from quern.plans import REGISTRY  # noqa: E402


def facts(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", plan)),
        "range_shuffles": plan.count("Exchange rangepartitioning"),
        "reused": plan.count("ReusedExchange"),
        "broadcasts": plan.count("BroadcastExchange"),
        "python": len(re.findall(r"(MapInPandas|ArrowEvalPython|FlatMapGroupsInPandas|BatchEvalPython)", plan)),
        "windows": len(re.findall(r"\bWindow(GroupLimit)? \[", plan)) + plan.count("WindowGroupLimit"),
        "codegen": len(set(re.findall(r"\*\((\d+)\)", plan))),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "16"})
    lines = ["# PLANS", "", f"Executed (AQE final) plans of the benchmark queries at `{sf}`, from",
             "`tools/plan_report.py`.  Columns: shuffles (hash/range/single exchanges), of which range,",
             "reused exchanges, broadcasts, Python stages, codegen stages; then the scans' pushed filters",
             "and read schemas.", "",
             "| Query | shuffles | range | reused | broadcasts | python | codegen stages |", "|---|---|---|---|---|---|---|"]
    scans = []
    for name, q in REGISTRY.items():
        if not q.bench:
            continue
        df = q.fn(spark, sf)
        df.collect()                       # runs this DataFrame's own plan, so AQE's final plan is kept
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]      # AQE prints both; keep the final one
        f = facts(plan)
        lines.append(f"| `{name}` | {f['shuffles']} | {f['range_shuffles']} | {f['reused']} | {f['broadcasts']} | "
                     f"{f['python']} | {f['codegen']} |")
        for m in re.finditer(r"FileScan parquet \[[^\]]*\].*?PushedFilters: (\[[^\]]*\]).*?ReadSchema: (struct<[^>]*>)",
                             plan):
            scans.append(f"* `{name}`: pushed {m.group(1)}; reads `{m.group(2)}`")
    lines += ["", "## Scans", ""] + scans
    open(os.path.join(ROOT, "PLANS.md"), "w").write("\n".join(lines) + "\n")
    print("\n".join(lines[:40]))


if __name__ == "__main__":
    main()
