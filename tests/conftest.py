import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from benchtrail.session import build_session  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="benchtrail-tests", shuffle_partitions=4)
    # tests own their checkpoint folder (on a cluster it comes from the session)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bt-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="bt-test-", dir="/tmp")


def lines_df(spark, files: dict):
    """(file, line_no, line) rows from {file: text}."""
    rows = []
    for f, text in files.items():
        for i, line in enumerate(text.split("\n"), start=1):
            rows.append((f, i, line))
    return spark.createDataFrame(rows, "file string, line_no bigint, line string")
