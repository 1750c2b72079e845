import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lexiflow.session import build_session
    from scripts.plan_audit import EVENT_LOG
    folder = tmp_path_factory.mktemp("shared")
    (folder / "events").mkdir()
    s = build_session(master="local[4]", shuffle_partitions=8, extra={
        "spark.driver.memory": "8g", "spark.checkpoint.dir": f"file://{folder}/checkpoints",
        "spark.sql.warehouse.dir": f"file://{folder}/warehouse",
        **EVENT_LOG, "spark.eventLog.dir": f"file://{folder}/events"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_out(tmp_path):
    return str(tmp_path)
