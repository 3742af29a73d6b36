import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("SPARKLOOM_DRIVER_MEMORY", "4g")
DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from sparkloom.session import get_session

    session = get_session(8, 8)
    yield session
    session.stop()
