"""Summarise the physical plans of the mart's steps and reports (markdown on stdout).

Usage: python explain_plans.py [sf_dir]   (default /root/testdata/sf0.01)

For each step: number of shuffle exchanges, broadcast exchanges, join strategies, whether a
Python evaluation node appears, and each file scan's read schema and partition filters. Plans
are taken after execution, so adaptive decisions (broadcast conversions, coalescing) show.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def summarise(name: str, df, run: bool = True) -> str:
    if run:
        df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    shuffles = len(re.findall(r"\bExchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin|"
                              r"rebalance|REBALANCE)", plan))
    bcast = plan.count("BroadcastExchange")
    joins = sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                                  r"CartesianProduct)", plan)))
    python = any(k in plan for k in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                                     "MapInPandas"))
    scans = []
    for line in plan.split("\n"):
        m = re.search(r"FileScan (\w+) \[([^\]]*)\].*?PartitionFilters: \[([^\]]*)\]", line)
        if not m:
            continue
        cols = [re.sub(r"#\d+L?", "", c) for c in m.group(2).split(",")]
        pf = re.sub(r"#\d+", "", m.group(3).strip()) or "-"
        scans.append(f"{m.group(1)} [{', '.join(cols)}]; partition filters: {pf[:90]}")
    return (f"| {name} | {shuffles} | {bcast} | {', '.join(joins) or '-'} | {'yes' if python else 'no'} | "
            f"{'<br>'.join(scans) or '-'} |")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from costmart.operators.dimensions import dimension_keys
    from costmart.operators.fact import build_fact
    from costmart.plans import reports as R
    from costmart.plans.mart import combined_from_driver_tables, load_mart
    from costmart.session import get_spark, scratch_path
    from costmart.sinks import mart_store

    spark = get_spark("costmart-explain", master="local[8]", shuffle_partitions=16)
    base = scratch_path(spark, "explain")
    combined = combined_from_driver_tables(spark, sf_dir)
    mart_store.write_dimensions(combined, base)
    mart_store.write_fact_months(build_fact(combined), base)
    mart = load_mart(spark, base)
    f, d = mart.fact, mart.dims

    rows = [
        summarise("normalise both sources (from driver tables)", combined),
        summarise("dimension keys, one pass (grouping sets)", dimension_keys(combined)),
        summarise("fact with ids + month layout", mart_store.cluster_layout(build_fact(combined), True)),
    ]
    for name, df in R.run_reports(f, d).items():
        rows.append(summarise(f"report {name} (stored mart)", df))
    rows.append(summarise("report tag_spend (stored mart)", R.tag_spend(f)))
    rows.append(summarise("report net_gross_credits (stored mart)", R.net_gross_credits(f)))
    from costmart.operators.rollup import daily_rollup

    rows.append(summarise("daily rollup from the stored fact", daily_rollup(f)))
    mart_store.write_rollup_months(spark, base)
    rollup = load_mart(spark, base).rollup
    rows.append(summarise("report monthly_trend (from rollup)", R.monthly_trend(rollup, d["dim_date"])))
    rows.append(summarise("report category_share (from rollup)", R.category_share(rollup, d["dim_service"])))
    print("| step | shuffles | broadcasts | joins | python | scans |")
    print("|---|---|---|---|---|---|")
    print("\n".join(rows))
    spark.stop()


if __name__ == "__main__":
    main()
