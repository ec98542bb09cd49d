import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fundtrail.session import build_session, ensure_checkpoint_dir

    scratch = tempfile.mkdtemp(prefix="fundtrail-tests-")
    session = build_session(
        "local[4]",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.local.dir": scratch,
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    # Tests own their session, so they name the checkpoint folder themselves.
    ensure_checkpoint_dir(session, os.path.join(scratch, "checkpoint"))
    yield session
    session.stop()
