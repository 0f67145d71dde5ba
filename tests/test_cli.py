"""The command line maps stages to exit codes."""

import os
import subprocess
import sys

from tripmart.__main__ import main
from tripmart.sources import fixture

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def test_exit_codes_of_the_stages(spark, lake):
    fixture.raw_month(spark, SF, "2024-01").write.parquet(lake.raw_month("2024-01"))
    fixture.zones(spark, SF).coalesce(1).write.option("header", True).csv(lake.raw_zones)

    def run(command, *args):
        return main([command, "--lake", lake.root, *args], spark)

    assert run("clean", "--month", "2024-13") == 2
    assert run("gate", "--month", "2024-01") == 2  # nothing was cleaned: no summary
    assert run("clean", "--month", "2024-05") == 1
    assert run("clean", "--from", "2024-01", "--to", "2024-02") == 1  # 2024-02 is absent, 2024-01 is cleaned all the same
    assert run("gate", "--month", "2024-01") == 3  # hard rejects above 0.1 %
    assert run("gate", "--month", "2024-01", "--max-hard-reject-rate", "0.01") == 0
    assert run("gate", "--month", "2024-01", "--month", "2024-02", "--max-hard-reject-rate", "0.01") == 2
    assert run("load", "--month", "2024-02") == 1
    assert run("load", "--month", "2024-01") == 0
    assert run("marts", "--month", "2024-01") == 3  # trips with unknown zones
    spark.range(1).count()  # the session stays open


def test_own_process(tmp_path):
    done = subprocess.run([sys.executable, "-m", "tripmart", "gate", "--lake", str(tmp_path), "--month", "2024-01", "--master", "local[1]"],
                          capture_output=True, text=True, timeout=300, env={**os.environ, "PYTHONPATH": ROOT}, cwd=ROOT)
    assert done.returncode == 2, done.stderr[-500:]
