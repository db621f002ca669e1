import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

from cartoweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=8, shuffle_partitions=4, memory="4g")
