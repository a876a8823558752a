import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import build_session
    s = build_session("local[4]", app_name="tidewater-tests", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def one_col(df, name=None):
    name = name or df.columns[0]
    return [r[name] for r in df.collect()]
