"""Plan properties that must hold at any scale, and partition invariance."""

from __future__ import annotations

import re

import pytest

from tests.conftest import SF0001
from trialguard.operators import tables
from trialguard.plans import catalog

KEY_QUERIES = ["dm_findings", "adae", "adlb", "teae_soc_pt", "risk_differences", "findings"]


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", KEY_QUERIES)
def test_no_python_and_no_cartesian(spark, name):
    plan = physical(catalog.QUERIES[name](spark, SF0001))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_examples_use_partial_window_group_limit(spark):
    plan = physical(catalog.QUERIES["lb_findings"](spark, SF0001))
    assert "WindowGroupLimit" in plan


def _window_partitions(plan: str):
    for line in plan.split("\n"):
        if "Window [" in line and "windowspecdefinition(" in line:
            fn = line.split("Window [", 1)[1].split("(", 1)[0]
            spec = line.split("windowspecdefinition(", 1)[1]
            parts = []
            for item in spec.split(", "):
                if " ASC" in item or " DESC" in item or item.startswith("specifiedwindowframe"):
                    break
                parts.append(item.split("#", 1)[0])
            yield fn.strip(), parts


@pytest.mark.parametrize("name", ["sdtm_ae", "sdtm_lb", "adae", "adlb"])
def test_no_numbering_window_over_whole_subjects(spark, name):
    """Row numbering never partitions record-level data by subject alone (a hot subject would be one task)."""
    plan = physical(catalog.QUERIES[name](spark, SF0001))
    for fn, parts in _window_partitions(plan):
        if fn == "row_number":
            assert parts != ["USUBJID"], f"{name}: row_number over USUBJID only"


def test_no_window_without_partition(spark):
    for name in KEY_QUERIES:
        plan = physical(catalog.QUERIES[name](spark, SF0001))
        for line in plan.split("\n"):
            if "Window [" in line and "windowspecdefinition(" in line:
                spec = line.split("windowspecdefinition(", 1)[1]
                assert not spec.startswith("specifiedwindowframe") and not spec.startswith("ASC"), f"{name}: unpartitioned window"


@pytest.mark.parametrize("name", ["sdtm_lb", "adae"])
def test_partition_invariance(spark, name):
    def rows(parts):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            return sorted(tuple(str(v) for v in r) for r in catalog.QUERIES[name](spark, SF0001).collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")

    assert rows(1) == rows(16)


def test_scans_are_pruned(spark):
    """Every parquet scan reads a strict subset of its file's columns (column pruning reaches the reader)."""
    import pyarrow.parquet as pq

    study = catalog.Study(spark, SF0001)
    plan = physical(tables.teae_overview(study.adsl, study.adae, study.arms))
    scans = [line for line in plan.split("\n") if "FileScan" in line and "ReadSchema" in line]
    assert scans
    for line in scans:
        table = re.search(r"/(\w+)\.parquet", line).group(1)
        read = re.findall(r"(\w+):", line.split("ReadSchema: struct<", 1)[1])
        assert len(read) < len(pq.read_schema(f"{SF0001}/{table}.parquet").names), f"{table} read whole: {read}"
        if table == "customer":
            assert read == ["c_custkey"]


def test_a_study_is_read_once_for_all_its_stored_queries(spark, monkeypatch):
    """Queries over stored stages read no raw table any more once a first one has stored what it needs."""
    reads = []
    real = catalog.fixtures.raw_bundle
    monkeypatch.setattr(catalog.fixtures, "raw_bundle", lambda *a: reads.append(a) or real(*a))
    study = catalog.StoredStudy(spark, SF0001)
    for name in ("findings", "conformance", "teae_overview", "hys_law", "record_counts"):
        catalog.QUERIES[name](spark, SF0001).collect()
    done = len(reads)
    for name in ("findings", "conformance", "teae_overview", "hys_law", "record_counts", "dashboard_kpis", "content_digest"):
        plan = physical(catalog.QUERIES[name](spark, SF0001))
        assert not re.search("customer|orders|lineitem", plan), name
    assert len(reads) == done and study.store is catalog.StoredStudy(spark, SF0001).store


def test_building_a_query_starts_no_job(spark):
    """Every query that stores nothing is composed without running anything."""
    import __spark_entry__ as E

    from trialguard.sources import fixtures

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("read", "schemas of the supplied files")
    fixtures.raw_bundle(spark, SF0001)
    reads = len(tracker.getJobIdsForGroup("read"))
    for name, query in catalog.QUERIES.items():
        if name in catalog.STORING:
            continue
        spark.sparkContext.setJobGroup(f"build {name}", name)
        query(spark, SF0001)
        assert len(tracker.getJobIdsForGroup(f"build {name}")) <= reads, name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert set(catalog.QUERIES) <= set(E.queries())


def test_labs_are_scanned_at_most_twice(spark):
    plan = catalog.QUERIES["adlb"](spark, SF0001)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("lineitem.parquet") <= 2


def test_a_hot_subject_and_date_is_cut_into_grains(spark):
    """Half of all labs are one subject's on one date: numbers are right and no grain is large."""
    from pyspark.sql import functions as F

    from trialguard.operators import keys

    n = 40_000
    rows = spark.range(n).select(
        F.col("id").alias("RECNO"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 500)).alias("USUBJID"),
        F.when(F.col("id") % 2 == 0, "2024-01-01").otherwise("2024-02-01").alias("DAY"),
    )
    df, grain = keys.grain_of(rows, ["USUBJID"], ["DAY"])
    assert df.groupBy(*grain).count().agg(F.max("count")).first()[0] <= 1024
    numbered = keys.sequence(rows, ["USUBJID"], ["DAY"], "SEQ")
    got = numbered.groupBy("USUBJID").agg(F.count("*").alias("n"), F.countDistinct("SEQ").alias("d"), F.min("SEQ").alias("a"), F.max("SEQ").alias("b"))
    assert got.where("n != d or a != 1 or b != n").count() == 0
    order = numbered.where("USUBJID = 'hot'").orderBy("SEQ").select("RECNO").collect()
    assert [r[0] for r in order] == list(range(0, n, 2))
    text = rows.withColumn("RECNO", F.concat(F.lit("f#"), F.lpad(F.col("RECNO").cast("string"), 20, "0")))
    again = keys.sequence(text, ["USUBJID"], ["DAY"], "SEQ").where("USUBJID = 'hot'").agg(F.max("SEQ"), F.countDistinct("SEQ")).first()
    assert tuple(again) == (n // 2, n // 2)
