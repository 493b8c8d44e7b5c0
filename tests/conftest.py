import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flowgraph.session import local_session  # noqa: E402
from flowgraph.schemas import EDGE_SCHEMA, Graph  # noqa: E402

# A wheel: a rim of nine places, and spokes from place 0 to every other one of them; every road is stored in both directions.
PAIRS = [(k, k % 9 + 1) for k in range(1, 10)] + [(0, k) for k in range(1, 10, 2)]
ROADS = [(a, b, 1 + 5 * n % 13) for n, (a, b) in enumerate(PAIRS)]


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    return session


def graph_of(spark, edges, nodes):
    rows = [(s, d, float(w)) for s, d, w in edges]
    return Graph.of(spark.createDataFrame([(n,) for n in nodes], "node_id bigint"), spark.createDataFrame(rows, EDGE_SCHEMA))


@pytest.fixture(scope="session")
def ten(spark):
    both = [(a, b, w) for a, b, w in ROADS] + [(b, a, w) for a, b, w in ROADS]
    return graph_of(spark, both, range(10))


@pytest.fixture(scope="session")
def ten_isolated(spark):
    both = [(a, b, w) for a, b, w in ROADS] + [(b, a, w) for a, b, w in ROADS]
    return graph_of(spark, both, range(11))
