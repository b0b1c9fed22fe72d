"""Command line: build the mart from exports (or synthetic ones), validate it, show the reports.

    python -m costmart --synthetic 5000                  # generate both exports, then run
    python -m costmart --aws PATH --gcp PATH --out DIR   # real exports
    options: --reports default|all, --master local[8], --seed N

Every step runs on Spark; only the small report results and row counts reach the console.
"""

from __future__ import annotations

import argparse
import time

DEFAULT_REPORTS = ["spend_by_provider", "top_services", "monthly_trend", "team_environment", "geography_spend"]


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="costmart")
    ap.add_argument("--aws", help="source A export (CSV file, folder or glob)")
    ap.add_argument("--gcp", help="source B export (CSV file, folder or glob)")
    ap.add_argument("--synthetic", type=int, default=0, help="generate N rows per source instead")
    ap.add_argument("--seed", type=int, default=42)
    ap.add_argument("--out", help="mart folder (default: a new folder under spark.checkpoint.dir)")
    ap.add_argument("--reports", choices=["default", "all"], default="default")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    if not args.synthetic and not (args.aws and args.gcp):
        ap.error("give --aws and --gcp, or --synthetic N")

    from costmart.operators.quality import mart_summary, raise_on_failures, validate_mart
    from costmart.plans import reports as R
    from costmart.plans.mart import landed_rows, run_pipeline
    from costmart.session import get_spark, scratch_path
    from costmart.sinks.mart_store import read_load_counts
    from costmart.sources.billing_csv import write_export
    from pyspark.sql import SparkSession

    from costmart.sources.synth import synthesize_billing

    t0 = time.perf_counter()
    created = SparkSession.getActiveSession() is None
    spark = get_spark("costmart", master=args.master)
    base = args.out or scratch_path(spark, "mart")
    aws, gcp = args.aws, args.gcp
    if args.synthetic:
        aws, gcp = scratch_path(spark, "synthetic-aws"), scratch_path(spark, "synthetic-gcp")
        write_export(synthesize_billing(spark, args.synthetic, "AWS", seed=args.seed), aws)
        write_export(synthesize_billing(spark, args.synthetic, "GCP", seed=args.seed + 1), gcp)
        print(f"generated {args.synthetic:,} rows per source")

    t1 = time.perf_counter()
    mart = run_pipeline(spark, aws, gcp, base)
    print(f"mart written to {base} in {time.perf_counter() - t1:.1f}s")
    raise_on_failures(validate_mart(mart.fact, mart.dims, expected_fact_rows=landed_rows(spark, base), content=True))
    print("\n-- load")
    read_load_counts(spark, base).show(truncate=False)

    # reports read the daily rollup when the mart has one: same results, far less data
    source = mart.rollup if mart.rollup is not None else mart.fact
    reports = R.run_reports(source, mart.dims)
    reports["tags_lookup"] = R.tag_spend(source)
    reports["net_gross_credits"] = R.net_gross_credits(source)
    names = DEFAULT_REPORTS if args.reports == "default" else list(reports)
    for name in names:
        print(f"\n-- {name}")
        reports[name].show(50, truncate=False)

    print("\n-- tables")
    mart_summary(mart.tables()).show(truncate=False)
    print(f"total run time {time.perf_counter() - t0:.1f}s")
    if created:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
