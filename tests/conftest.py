import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from heliolake.session import build_session, checkpoint_dir

    s = build_session(master="local[4]", app_name="heliolake-tests", shuffle_partitions=8,
                      extra={"spark.ui.enabled": "false",
                             "spark.driver.memory": "4g",
                             "spark.sql.execution.arrow.pyspark.enabled": "true"})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s
