import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ebbline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = f"file://{tmp_path_factory.mktemp('shared')}"
    conf = {"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": shared}
    session = local_session("tests", 8, **conf)
    yield session
    session.stop()
