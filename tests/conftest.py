import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from phonesense.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", shuffle_partitions=4, conf={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def uploads(spark):
    def make(rows):
        return spark.createDataFrame(rows, "user_id string, payload string")
    return make


def obj(probe, **fields):
    """A probe object as JSON text (values given as JSON text fragments)."""
    parts = [f'"PROBE":"x.y.{probe}"'] + [f'"{k}":{v}' for k, v in fields.items()]
    return "{" + ",".join(parts) + "}"
