import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"
# The FIXTURES spine: 1994-01-01 .. 2001-12-31 (END 2002-01-01 excluded).
START, END = dt.date(1994, 1, 1), dt.date(2002, 1, 1)


@pytest.fixture(scope="session")
def spark():
    from caldim.session import build_session

    s = build_session("local[*]", shuffle_partitions=8, app="caldim-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="caldim-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fin(spark):
    from caldim.sources.fincal import formula_financial_calendar
    from caldim.sources.spine import date_spine

    return formula_financial_calendar(date_spine(spark, START, END)).cache()


@pytest.fixture()
def scratch(spark):
    from caldim.session import work_dir

    return work_dir(spark, "test")
