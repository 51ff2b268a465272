import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.session import local_session  # noqa: E402
from tillroll.sources.tables import Tables  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="tillroll-tests")
    yield s
    s.stop()


@pytest.fixture()
def tables(spark):
    """Build a Tables from {logical name: (ddl schema, rows)}."""

    def make(**named):
        resolvers = {}
        for key, (schema, rows) in named.items():
            df = spark.createDataFrame(rows, schema)
            resolvers[key.replace("__", ".")] = lambda _t, d=df: d
        return Tables(spark, resolvers)

    return make
