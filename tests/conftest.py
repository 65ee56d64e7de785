import os
import sys

import numpy as np
import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]
# Encoders and labelers defined in test modules are looked up there by the workers.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [HERE, os.environ.get("PYTHONPATH")]))

from themewell.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions=8,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def vectors_of(spark):
    def make(x, partitions=3, order=None):
        rows = [(i, [float(v) for v in x[i]]) for i in (range(len(x)) if order is None else order)]
        return spark.createDataFrame(rows, "id long, embedding array<float>").repartition(partitions)

    return make


@pytest.fixture
def assigned_of(spark):
    def make(labels):
        rows = [(i, int(c)) for i, c in enumerate(labels)]
        return spark.createDataFrame(rows, "id long, cluster_id int")

    return make


#: Places far from each other, as long as the noise is within a few units; dimensions repeat them.
PLACES = ((7.0, 1.0, 0.0), (-5.0, 6.0, 2.0), (-2.0, -8.0, 3.0))


def clumps(sizes, dim=6, noise=0.5, seed=11):
    """Rows evenly spread in boxes around the first ``len(sizes)`` places."""
    around = [np.resize(place, dim) for place in PLACES[: len(sizes)]]
    rng = np.random.default_rng(seed)
    return np.concatenate([p + rng.uniform(-noise, noise, (n, dim)) for p, n in zip(around, sizes)]).astype(np.float32)
