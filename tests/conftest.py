import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickweave.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="clickweave-tests-")
    s = get_spark(
        "local[4]",
        8,
        app_name="clickweave-tests",
        extra={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
            "spark.driver.memory": "4g",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)


def session(sid="SID-1", events=None, **extra):
    d = {"session_id": sid, "user_id": "UID-1", "device_type": "desktop",
         "geolocation": "1.5,-2.5", "user_agent": "ua"}
    if events is not None:
        d["events"] = events
    d.update(extra)
    return d


def ev(event_type="page_view", timestamp="2024-07-01T10:00:00Z", **details):
    e = {}
    if event_type is not None:
        e["event_type"] = event_type
    if timestamp is not None:
        e["timestamp"] = timestamp
    if details:
        e["details"] = details
    return {"event": e}


def lines_df(spark, lines):
    """A text frame like spark.read.text gives, with a source column."""
    rows = [(x if isinstance(x, str) or x is None else json.dumps(x), f"line-{i}") for i, x in enumerate(lines)]
    return spark.createDataFrame(rows, "value string, source string")
