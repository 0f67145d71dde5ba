"""tripmart: monthly trip-record cleaning, warehouse loading and reporting on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; only the writers in ``tripmart.plans`` run actions.

Common entry points::

    from tripmart import Lake, build_session, run_flow
    result = run_flow(build_session(), Lake("s3a://bucket/trips"), ["2025-01"])
"""

__version__ = "0.1.0"

from tripmart.operators.clean import enrich, split_clean, split_rejected, standardize, tag_rows  # noqa: E402
from tripmart.plans.flow import run_flow  # noqa: E402
from tripmart.plans.gate import evaluate_months  # noqa: E402
from tripmart.plans.monthly import run_months, run_months_batched  # noqa: E402
from tripmart.plans.warehouse import load_months  # noqa: E402
from tripmart.session import build_session, cluster_conf  # noqa: E402
from tripmart.sources.lake import Lake  # noqa: E402

__all__ = [
    "Lake", "build_session", "cluster_conf", "standardize", "tag_rows", "split_clean", "split_rejected", "enrich",
    "run_months", "run_months_batched", "evaluate_months", "load_months", "run_flow",
]
