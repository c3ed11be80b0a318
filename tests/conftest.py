import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark():
    from strandwise.session import drop_staged, local_session

    s = local_session(4, 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    drop_staged(s)
    s.stop()
