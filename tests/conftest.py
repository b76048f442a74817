import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidewater.session import get_session
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = get_session("local[4]", app_name="tidewater-tests", shuffle_partitions=4,
                    conf={"spark.checkpoint.dir": ckpt, "spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


def ts(s):
    from datetime import datetime
    return datetime.fromisoformat(s)


def d(s):
    from datetime import date
    return date.fromisoformat(s)
