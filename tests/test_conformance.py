"""Each conformance rule on two or three rows of a domain, one fault at a time."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests import inline
from trialguard.operators import conformance

SOUND = {
    "DM": {"STUDYID": "s", "DOMAIN": "DM", "USUBJID": "u1", "SEX": "F", "DTHFL": "", "RFSTDTC": "2025-01-01"},
    "AE": {"STUDYID": "s", "DOMAIN": "AE", "USUBJID": "u1", "AESEQ": 1, "AESEV": "MILD", "AESER": "N", "AETOXGR": 2, "AESTDTC": "2025-01-02", "AESTDY": 2},
    "LB": {"STUDYID": "s", "DOMAIN": "LB", "USUBJID": "u1", "LBSEQ": 1, "LBNRIND": "LOW", "LBBLFL": "Y", "LBDTC": "2025-01-01"},
}
#: domain, changed values of rows (the first row is sound), findings as (rule, severity, count, examples)
CASES = [
    ("DM", [{"STUDYID": ""}], [("SD0004", "ERROR", 1, "u2")]),
    ("DM", [{"SEX": "X"}, {"SEX": None}], [("DM0002", "ERROR", 2, "u2, u3")]),
    ("DM", [{"DTHFL": "Y"}, {"DTHFL": "Y", "DTHDTC": "2025-03-01"}], [("DM0003", "WARNING", 1, "u2")]),
    ("DM", [{"USUBJID": "u1"}, {"USUBJID": "u1"}], [("DM0001", "ERROR", 2, "u1")]),
    ("DM", [{"RFSTDTC": "1/2/2025"}, {"RFENDTC": "2025-02"}], [("SD0007", "ERROR", 1, "u2"), ("SD0007", "ERROR", 1, "u3")]),
    ("AE", [{"USUBJID": "nobody"}], [("SD0005", "ERROR", 1, "nobody")]),
    ("AE", [{"USUBJID": "u1"}, {"USUBJID": "u1", "AESEQ": 2}], [("SD0006", "ERROR", 1, "u1")]),
    ("AE", [{"AESTDY": 0}, {"AEENDY": 0}], [("SD0008", "ERROR", 1, "u2"), ("SD0008", "ERROR", 1, "u3")]),
    ("AE", [{"AESEV": "AWFUL"}, {"AESEV": None}], [("AE0001", "ERROR", 2, "u2, u3")]),
    ("AE", [{"AESER": ""}], [("AE0002", "ERROR", 1, "u2")]),
    ("AE", [{"AEENDTC": "2025-01-01"}, {"AEENDTC": "2025-01-02"}], [("AE0003", "ERROR", 1, "u2")]),
    ("AE", [{"AEOUT": "FATAL"}, {"AEOUT": "FATAL", "AESER": "Y"}], [("AE0004", "WARNING", 1, "u2")]),
    ("AE", [{"AETOXGR": 3}, {"AETOXGR": 3, "AESEV": "SEVERE"}], [("AE0005", "WARNING", 1, "u2")]),
    ("LB", [{"LBBLFL": ""}, {"USUBJID": "u2", "LBSEQ": 2}], [("LB0001", "WARNING", 0, "")]),
    ("LB", [{"LBBLFL": ""}, {"LBBLFL": ""}], [("LB0001", "WARNING", 2, "u2, u3")]),
    ("LB", [{"LBNRIND": "odd"}, {"LBNRIND": ""}], [("LB0002", "ERROR", 1, "u2")]),
]


def _check(spark, domain, changes, edit=lambda df: df):
    rows = [SOUND[domain]] + [SOUND[domain] | {"USUBJID": f"u{i}"} | c for i, c in enumerate(changes, start=2)]
    sets = {domain: edit(inline.dataset(spark, domain, rows))}
    if domain != "DM":
        sets["DM"] = inline.dataset(spark, "DM", [SOUND["DM"] | {"USUBJID": f"u{i}"} for i in (1, 2, 3)])
    return sorted(tuple(r) for r in conformance.check_sdtm(spark, sets).select("rule_id", "severity", "count", "examples").collect())


@pytest.mark.parametrize(("domain", "changes", "want"), CASES, ids=lambda v: v[0][0] if isinstance(v, list) and v and isinstance(v[0], tuple) else None)
def test_a_fault_is_found_and_nothing_else(spark, domain, changes, want):
    assert _check(spark, domain, changes) == [w for w in want if w[2]]


def test_structure_is_checked_without_rows(spark):
    got = _check(spark, "AE", [], lambda df: df.drop("AEREL", "AEOUT").withColumn("LONGVARNAME", F.lit(1)))
    assert got == [("SD0001", "ERROR", 2, ""), ("SD0002", "ERROR", 1, "LONGVARNAME")]
    assert _check(spark, "LB", []) == []


def test_examples_are_the_first_five_subjects(spark):
    got = _check(spark, "DM", [{"SEX": "?"}] * 9)
    assert got == [("DM0002", "ERROR", 9, "u10, u2, u3, u4, u5")]


def test_key_sets(spark):
    ae = inline.dataset(spark, "AE", [{"USUBJID": u} for u in ("x", "x", "y", "z")])
    dm = inline.dataset(spark, "DM", [{"USUBJID": u} for u in ("y", "w")])
    assert sorted(r.USUBJID for r in conformance.orphan_subjects(ae, dm).collect()) == ["x", "x", "z"]
    lb = inline.dataset(spark, "LB", [{"USUBJID": "x", "LBBLFL": ""}, {"USUBJID": "x", "LBBLFL": "Y"}, {"USUBJID": "y"}])
    assert [r.USUBJID for r in conformance.subjects_without_baseline(lb).collect()] == ["y"]
