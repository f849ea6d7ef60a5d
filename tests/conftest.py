import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lakebank.session import build_session
    scratch = tempfile.mkdtemp(prefix="lakebank-test-")
    s = build_session("local[*]", 8, extra={"spark.sql.warehouse.dir": os.path.join(scratch, "wh"),
                                             "spark.driver.memory": "8g"})
    s.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    yield s
    s.stop()
