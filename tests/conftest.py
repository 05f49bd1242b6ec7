import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("ledgerline-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-test-ckpt-"))
    yield s


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="ledgerline-test-")


def raw_rows(spark, rows, file="april_2015.csv"):
    """Raw text rows -> DataFrame with load-order columns (for warehouse/report tests)."""
    from pyspark.sql import functions as F
    from ledgerline.schema import CANONICAL_COLS
    cols = list(CANONICAL_COLS)
    data = []
    for i, r in enumerate(rows):
        data.append(tuple(r.get(c) for c in cols) + (r.get("_source_file", file), r.get("_row_idx", i)))
    schema = ", ".join(f"{c} string" for c in cols) + ", _source_file string, _row_idx long"
    return spark.createDataFrame(data, schema).withColumn("_row_key", F.monotonically_increasing_id())
