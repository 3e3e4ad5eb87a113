import os

import pytest
from pyspark.sql import SparkSession

os.environ.setdefault("OMP_NUM_THREADS", "1")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from twinspark.shared import ship

    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield ship(s)
    s.stop()
