import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from shelftide.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "shelftide-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    from shop_data import main_rows, raw_frame
    return raw_frame(spark, main_rows())


@pytest.fixture(scope="session")
def layers(raw):
    from shelftide.plans.layers import Layers
    from shop_data import PARAMS
    return Layers(raw, PARAMS)


@pytest.fixture(scope="session")
def quadrant_layers(spark):
    from shelftide.plans.layers import Layers
    from shop_data import PARAMS, quadrant_rows, raw_frame
    return Layers(raw_frame(spark, quadrant_rows()), PARAMS)
