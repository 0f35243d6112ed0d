from __future__ import annotations

import os
import sys
import time

import pytest

# fixtures hold naive datetimes; read them in the session zone (UTC)
os.environ["TZ"] = "UTC"
time.tzset()

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for p in (ROOT, os.path.join(ROOT, "tests")):
    if p not in sys.path:
        sys.path.insert(0, p)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    scratch = tmp_path_factory.mktemp("spark")
    session = (SparkSession.builder.master("local[8]")
               .appName("submart-tests")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
               .getOrCreate())
    # the shared folder: the session's own if one is named, else a new one
    from submart.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(session)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
