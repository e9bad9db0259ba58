import os
import sys
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablevault.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # The shared folder comes from spark.checkpoint.dir when it is configured;
    # build_session creates a local one only where it is unset.
    s = build_session("local[*]", 8)
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    from tablevault.session import new_work_dir
    return new_work_dir(spark, "test")
