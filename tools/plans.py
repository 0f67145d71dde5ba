"""Print the final (executed, adaptive) physical plans of the main jobs as Markdown.

usage: python tools/plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def formatted(df) -> str:
    df.collect()  # run this DataFrame's own query, so its adaptive plan is final (small at sf0.01)
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    keep = [ln for ln in details.splitlines()
            if re.match(r"^\(\d+\) (Scan|Exchange|BroadcastExchange|ReusedExchange|HashAggregate|BroadcastHashJoin"
                        r"|SortMergeJoin|AQEShuffleRead)", ln)
            or ln.startswith(("ReadSchema", "PushedFilters", "PartitionFilters", "Arguments", "Keys", "Join type"))]
    return tree.strip() + "\n\n" + "\n".join(keep)


def main():
    from pyspark.sql import functions as F

    from tripmart.operators import reports
    from tripmart.operators.clean import enrich, split_clean, split_rejected, tag_rows
    from tripmart.operators.warehouse import to_staging
    from tripmart.plans import marts as pm
    from tripmart.plans.monthly import run_months
    from tripmart.plans.warehouse import load_months
    from tripmart.session import build_session, scratch_path
    from tripmart.sources import fixture
    from tripmart.sources.lake import Lake, raw_month_scan, read_table, union_by_name
    from tripmart.sources.reference import payment_type_codes, read_zones_csv
    from tripmart.operators import dq

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    lake = Lake(scratch_path(spark, "plans"))
    fixture.raw_month(spark, sf, "2024-01").write.parquet(lake.raw_month("2024-01"))
    fixture.raw_month_drifted(spark, sf, "2024-02").write.parquet(lake.raw_month("2024-02"))
    fixture.zones(spark, sf).coalesce(1).write.option("header", True).csv(lake.raw_zones)
    zones = read_zones_csv(spark, lake.raw_zones)
    months = ["2024-01", "2024-02"]
    run_months(spark, lake, months, zones)
    load_months(spark, lake, months)
    pm.build_marts(spark, lake, zones, payment_type_codes(spark))
    marts = pm.read_marts(spark, lake)

    tagged = union_by_name(tag_rows(raw_month_scan(spark, lake, m), m) for m in months)
    jobs = {
        "Clean write input (two months, drifted schemas)": enrich(split_clean(tagged), zones),
        "Rejected write input": split_rejected(tagged).hint("rebalance", "source_month"),
        "Warehouse load input (one month, partition-pruned)": to_staging(
            read_table(spark, lake, lake.clean).filter((F.col("year") == 2024) & (F.col("month") == 1))),
        "trips_by_borough over the marts": reports.trips_by_borough(marts["fact_trips"], marts["dim_zone"]),
        "weekday_avg over the marts": reports.weekday_avg(marts["fact_trips"], marts["dim_date"]),
        "Data tests (fact part, one scan)": dq._fact_tests(marts["fact_trips"], marts, pm.stg_trips(pm.staging_view(spark, lake))),
    }
    for title, df in jobs.items():
        print(f"## {title}\n\n```\n{formatted(df)}\n```\n")


if __name__ == "__main__":
    main()
