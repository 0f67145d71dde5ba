import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tests_llm_data import rows  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, tid int, bucket string, kept int"


@pytest.fixture(scope="session")
def doc_rows():
    return rows()


@pytest.fixture(scope="session")
def docs(spark):
    """The odd rows with extra columns whose names operators use inside."""
    from tripmart.llm.common import ship

    ship(spark)
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows()], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, 1, int(i == 400)) for i in range(500)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
