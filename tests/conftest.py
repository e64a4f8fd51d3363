import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from paths import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("TESSERA_SHUFFLE_PARTITIONS", "8")
    from tessera.session import get_spark
    s = get_spark(master="local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def duck():
    from oracle import duck as _duck
    return _duck(SF_SMALL)
