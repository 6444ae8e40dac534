import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from lexloom.session import session

    s = session("local[4]", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
