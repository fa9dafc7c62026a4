from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trialguard.session import local_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def study(spark):
    from trialguard.plans.catalog import StoredStudy

    return StoredStudy(spark, SF0001)


@pytest.fixture(scope="session")
def run_result(spark, tmp_path_factory):
    from trialguard.plans import pipeline
    from trialguard.sources import fixtures

    out = str(tmp_path_factory.mktemp("run"))
    result = pipeline.run(spark, fixtures.raw_bundle(spark, SF0001), out_dir=out)
    return result, out


def frame(spark, columns: dict[str, list]):
    """An all-text inline frame from column lists (RECNO = row order)."""
    names = list(columns)
    n = len(columns[names[0]])
    rows = [tuple(columns[c][i] for c in names) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in names))
    from pyspark.sql import functions as F

    return df.withColumn("RECNO", F.monotonically_increasing_id())
