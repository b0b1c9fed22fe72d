"""Hot keys: a month holding most rows is split over several tasks (files), not one."""

import glob

from pyspark.sql import functions as F

from costmart.operators.fact import build_fact, fact_lines
from costmart.operators.normalize import normalize
from costmart.operators.rollup import daily_rollup
from costmart.plans import reports as R
from costmart.session import local_path
from costmart.sinks import mart_store
from costmart.sources.layouts import AWS
from costmart.sources.synth import synthesize_billing


def test_hot_month_is_split_over_tasks(spark, scratch):
    base = scratch("hot-month")
    raw = synthesize_billing(spark, 20000, "AWS", seed=3)
    # move 90 % of the rows into one day of January: one hot month and one hot day
    raw = raw.withColumn("bill_date", F.when(F.xxhash64("resource_id") % 10 != 0, F.lit("2024-01-07"))
                         .otherwise(F.col("bill_date")))
    canon = normalize(raw, AWS)
    # At this size adaptive execution would merge the stage before the layout exchange into one
    # task (a skewed partition can only be split by map blocks); keep its partitions as a large
    # input would have them, and use a small advisory size so the month counts as skewed.
    confs = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        mart_store.write_fact_months(build_fact(canon), base)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    files = glob.glob(local_path(base) + "/fact_cloud_costs/bill_month=2024-01/*.parquet")
    assert len(files) > 1  # the hot month was written by several tasks
    assert mart_store.read_fact(spark, base).count() == canon.count()


def test_rollup_equals_fact_on_skewed_data(spark):
    raw = synthesize_billing(spark, 5000, "AWS", seed=9)
    raw = raw.withColumn("bill_date", F.when(F.xxhash64("resource_id") % 3 == 0, F.lit("2024-05-05"))
                         .otherwise(F.col("bill_date")))
    f = fact_lines(normalize(raw, AWS))
    r = daily_rollup(f)
    assert R.spend_by_provider(f).collect() == R.spend_by_provider(r).collect()
    assert R.tag_spend(f).collect() == R.tag_spend(r).collect()
    assert R.net_gross_credits(f).collect() == R.net_gross_credits(r).collect()
