import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quern.session import build_session, ensure_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
                            spark__driver__memory="6g", spark__ui__showConsoleProgress="false",
                            spark__sql__warehouse__dir=str(home / "warehouse"))
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"
