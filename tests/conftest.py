import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# The modelled project's sample pair (raw and cleaned CSV): test_golden.py runs where it is given;
# test_sample.py always runs, on a sample of its own.
SAMPLE_DIR = os.environ.get("MARTCRAFT_SAMPLE_DIR", "")
collect_ignore = [] if SAMPLE_DIR else ["test_golden.py"]
SAMPLE_RAW = os.path.join(SAMPLE_DIR, "customer_transactions.csv") if SAMPLE_DIR else ""
SAMPLE_CLEANED = os.path.join(SAMPLE_DIR, "customer_transactions_cleaned.csv") if SAMPLE_DIR else ""
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from martcraft.session import get_session

    scratch = tempfile.mkdtemp(prefix="martcraft-test-")
    s = get_session("local[4]", app="martcraft-tests", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.local.dir": os.path.join(scratch, "local"),
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="martcraft-t-")
