"""Volume run: N months of ~3.5 M trips each (events replicated), cleaned, gated and loaded in ONE job.

usage: python tools/volume.py [months=6] [sf_dir=/root/testdata/sf0.1]
Prints one JSON line with rows, seconds per stage and rows/s.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    from pyspark.sql import functions as F

    from tripmart.functions.months import month_shift
    from tripmart.plans.gate import evaluate_months
    from tripmart.plans.monthly import run_months
    from tripmart.plans.warehouse import load_months
    from tripmart.session import build_session, scratch_path
    from tripmart.sources import fixture
    from tripmart.sources.lake import Lake
    from tripmart.sources.reference import read_zones_csv

    n_months = int(sys.argv[1]) if len(sys.argv) > 1 else 6
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    spark = build_session()
    events = fixture.table(spark, sf_dir, "events")
    n_events = events.count()
    k = max(1, -(-3_500_000 // n_events))
    span = events.agg(F.max("event_id")).first()[0] + 1
    rep = (events.crossJoin(spark.range(k).withColumnRenamed("id", "_k"))
           .withColumn("event_id", F.col("event_id") + F.col("_k") * F.lit(span)).drop("_k"))
    lake = Lake(scratch_path(spark, "volume"))
    months = [month_shift("2024-01", i) for i in range(n_months)]
    for i, m in enumerate(months):
        # each month's events moved to start on the 1st of that month
        shifted = rep.withColumn("ts", F.add_months(F.col("ts"), i).cast("timestamp_ntz")
                                 + (F.col("ts") - F.date_trunc("day", F.col("ts"))))
        fixture.raw_trips_from_events(shifted).repartition(16).write.parquet(lake.raw_month(m))
    fixture.zones(spark, sf_dir).coalesce(1).write.option("header", True).csv(lake.raw_zones)
    zones = read_zones_csv(spark, lake.raw_zones)
    times = {}
    t = time.time()
    res = run_months(spark, lake, months, zones)
    times["clean"] = round(time.time() - t, 2)
    t = time.time()
    evaluate_months(spark, lake, months, max_hard_reject_rate=0.01)
    times["gate"] = round(time.time() - t, 2)
    t = time.time()
    load_months(spark, lake, months)
    times["load"] = round(time.time() - t, 2)
    rows = sum(o.rows_in for o in res.outcomes.values())
    total = sum(times.values())
    print(json.dumps({"months": n_months, "rows": rows, "ok": res.ok, "seconds": times,
                      "rows_per_sec_total": round(rows / total), "rows_per_sec_clean": round(rows / times["clean"])}))
    spark.stop()


if __name__ == "__main__":
    main()
