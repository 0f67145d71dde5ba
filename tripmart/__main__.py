"""Command line: ``python -m tripmart <command> --lake ROOT --month YYYY-MM [--month ...]``.

Commands mirror the stages; exit codes: 0 ok, 1 failed input, 2 invalid
month or summary, 3 count mismatch / gate or data-test failure.

    clean   clean, verify and publish the months (writes run summaries)
    gate    evaluate the quality gate from the run summaries
    load    replace the months in the warehouse staging table
    marts   rebuild the months' fact partitions and the dimensions, run data tests
    flow    all of the above, stopping at the first failure
"""

from __future__ import annotations

import argparse
import logging
import sys

from tripmart.contracts import DEFAULT_MAX_HARD_REJECT_RATE, DEFAULT_MAX_NON_CLEAN_RATE

log = logging.getLogger("tripmart")


def main(argv=None, spark=None) -> int:
    """Run one command; a session that is passed in is used and left open."""
    p = argparse.ArgumentParser(prog="tripmart", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    p.add_argument("command", choices=["clean", "gate", "load", "marts", "flow"])
    p.add_argument("--lake", required=True, help="lake root (any Hadoop path)")
    p.add_argument("--month", action="append", default=[], help="YYYY-MM, repeatable")
    p.add_argument("--from", dest="first", help="first month of a range (with --to)")
    p.add_argument("--to", dest="last", help="last month of a range (with --from)")
    p.add_argument("--max-non-clean-rate", type=float, default=DEFAULT_MAX_NON_CLEAN_RATE)
    p.add_argument("--max-hard-reject-rate", type=float, default=DEFAULT_MAX_HARD_REJECT_RATE)
    p.add_argument("--staging-table", default=None, help="flow: register the staging table under this name and analyze the loaded months")
    p.add_argument("--master", default=None, help="Spark master for local runs (default: the submit's)")
    args = p.parse_args(argv)
    logging.basicConfig(level="INFO", format="%(levelname)s %(asctime)s [%(name)s] %(message)s")

    from tripmart.functions.months import InvalidMonth, month_range, validate_months
    try:
        wanted = list(args.month)
        if args.first or args.last:
            wanted += month_range(args.first or args.last, args.last or args.first)
        months = validate_months(wanted)
    except InvalidMonth as exc:
        log.error("%s", exc)
        return 2

    from pyspark.sql import SparkSession

    from tripmart.plans import flow as fl
    from tripmart.plans.gate import evaluate_months
    from tripmart.plans.marts import build_marts, run_data_tests
    from tripmart.plans.monthly import run_months_batched
    from tripmart.plans.warehouse import load_months
    from tripmart.session import build_session
    from tripmart.sources.lake import Lake
    from tripmart.sources.reference import payment_type_codes, read_lake_zones

    own = spark is None
    if own:
        spark = build_session(master=args.master) if args.master else SparkSession.builder.getOrCreate()
    lake = Lake(args.lake)
    try:
        if args.command == "flow":
            res = fl.run_flow(spark, lake, months, max_non_clean_rate=args.max_non_clean_rate,
                              max_hard_reject_rate=args.max_hard_reject_rate, staging_table_name=args.staging_table)
            log.info("stages %s", res.stages)
            for m, st in sorted(res.month_status.items()):
                log.info("%s %s", m, st)
            for t in res.detail.get("tests_failed", []):
                log.error("data test failed: %s", t)
            return res.code
        if args.command == "clean":
            res = run_months_batched(spark, lake, months, read_lake_zones(spark, lake))
            for o in res.outcomes.values():
                log.info("%s in=%d clean=%d rejected=%d published=%s", o.month, o.rows_in, o.rows_clean,
                         o.rows_rejected, o.published)
            return max(o.code for o in res.outcomes.values())
        if args.command == "gate":
            status = evaluate_months(spark, lake, months, args.max_non_clean_rate, args.max_hard_reject_rate)
            log.info("gate %s", status)
            if any(s in ("missing", "invalid") for s in status.values()):
                return 2
            return 0 if all(s == "passed" for s in status.values()) else 3
        if args.command == "load":
            out = load_months(spark, lake, months)
            for o in out.values():
                log.info("%s %s expected=%s loaded=%s %s", o.month, o.status, o.expected, o.loaded, o.error or "")
            if any(o.status == "missing" for o in out.values()):
                return 1
            return 0 if all(o.status == "success" for o in out.values()) else 3
        if args.command == "marts":
            build_marts(spark, lake, read_lake_zones(spark, lake), payment_type_codes(spark), months=months)
            failed = [r["test_name"] for r in run_data_tests(spark, lake, months).filter("NOT passed").collect()]
            for t in failed:
                log.error("data test failed: %s", t)
            return 3 if failed else 0
    finally:
        if own:
            spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
