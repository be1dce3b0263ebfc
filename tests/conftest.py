import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import logweave as lw  # noqa: E402
from logweave.sources.lines import as_line_frame  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("logweave-tests")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g").config("spark.sql.shuffle.partitions", "4")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    return lw.configure(session)


@pytest.fixture(scope="session")
def lines(spark):
    def build(*texts):
        rows = spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)
        return as_line_frame(rows, "value")

    return build


@pytest.fixture(scope="session")
def parse(lines):
    """All rows of the given lines, good and bad, as dicts in input order."""

    def run(mapping, *texts, **options):
        if isinstance(mapping, str):
            mapping = lw.vendor_mapping(mapping)
        elif isinstance(mapping, dict):
            mapping = lw.parse_mapping(mapping)
        parsed = lw.parse_network(lines(*texts), mapping, lw.Options(**options))
        return [r.asDict() for r in parsed.rows.orderBy("block", "seq").collect()]

    return run
