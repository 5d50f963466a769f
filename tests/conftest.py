import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("mktlens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="mktlens-test-ckpt-"))
    yield s


class Frames(dict):
    """A raw-table mapping built from hand-made frames."""

    def __init__(self, spark, **tables):
        super().__init__(**tables)
        self.spark = spark


def raw_frame(spark, table, rows):
    """A DataFrame with the raw contract schema; rows are dicts (missing keys are NULL)."""
    from mktlens.sources.schemas import RAW_SCHEMAS

    schema = RAW_SCHEMAS[table]
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)
