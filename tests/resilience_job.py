"""Run one month where the first attempt of some scan tasks fails (retried by Spark).

Prints JSON: the month outcome and the failures injected. Run as a separate
process because it needs a session whose master allows task retries.
"""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    from pyspark import TaskContext
    from pyspark.sql import functions as F
    from pyspark.sql.types import BooleanType

    from tripmart.operators import clean as C
    from tripmart.plans import monthly
    from tripmart.session import build_session
    from tripmart.sources import fixture
    from tripmart.sources.lake import Lake, raw_month_scan, read_table
    from tripmart.sources.reference import read_zones_csv

    spark = build_session(master="local[4,4]", app="resilience",
                          extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="resil-")})
    sf = sys.argv[1]
    lake = Lake(tempfile.mkdtemp(prefix="resil-lake-"))
    fixture.raw_month(spark, sf, "2024-01").repartition(4).write.parquet(lake.raw_month("2024-01"))
    fixture.zones(spark, sf).coalesce(1).write.option("header", True).csv(lake.raw_zones)
    zones = read_zones_csv(spark, lake.raw_zones)

    @F.udf(BooleanType())
    def fail_first_attempt(_):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
            raise RuntimeError("injected executor failure")
        return True

    # Every scan task with an even partition id fails once, in BOTH writes.
    real_tag = C.tag_rows
    monthly.tag_rows = lambda df, m=None: real_tag(df.filter(fail_first_attempt(F.col("vendor_id"))), m)
    res = monthly.run_months(spark, lake, ["2024-01"], zones, raw={"2024-01": raw_month_scan(spark, lake, "2024-01")})
    o = res.outcomes["2024-01"]
    clean_rows = read_table(spark, lake, lake.clean).count()
    print(json.dumps({"rows_in": o.rows_in, "clean": o.rows_clean, "rejected": o.rows_rejected,
                      "reasons_total": o.reasons_total, "published": o.published, "clean_table": clean_rows}))
    spark.stop()


if __name__ == "__main__":
    main()
