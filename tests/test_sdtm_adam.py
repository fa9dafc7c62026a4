"""Derivations on a study of three subjects, with every derived value written out."""

from __future__ import annotations

import datetime as dt

import pytest

from tests import inline
from trialguard import schemas
from trialguard.operators import adam, cleaning, sdtm

D = dt.date.fromisoformat
SUBJECTS = [
    {"SUBJID": "a", "AGE": "44", "ARM": "Drug A 50 mg", "ARMCD": "DRGA50"},
    {"SUBJID": "b", "AGE": "45", "TRTEDT": "2025-01-10"},
    {"SUBJID": "c", "AGE": "65", "TRTSDT": "2025-02-01", "TRTEDT": "2025-01-01"},
]
EVENTS = [
    {"SUBJID": "a", "AEDECOD": "Rash", "AEBODSYS": "Skin", "AESTDT": "2025-01-10", "AETOXGR": "2"},
    {"SUBJID": "a", "AESTDT": "2025-01-09", "AETOXGR": "3"},  # the day before the first dose
    {"SUBJID": "a", "AESTDT": "2025-01-10", "AETOXGR": "4"},
    {"SUBJID": "a", "AEDECOD": "Rash", "AEBODSYS": "Skin", "AESTDT": "2025-01-10", "AETOXGR": "5"},
    {"SUBJID": "a", "AEDECOD": "Vertigo", "AESTDT": "2025-02-19", "AETOXGR": "1"},  # 30 days after the last dose
    {"SUBJID": "b", "AESTDT": "2025-02-10", "AETOXGR": "1"},  # 31 days after
]
LABS = [
    {"SUBJID": "a", "LBDT": "2025-01-08", "LBORRES": "30"},
    {"SUBJID": "a", "LBDT": "2025-01-10", "LBORRES": "50", "VISITNUM": "2.5", "VISIT": "V2"},
    {"SUBJID": "a", "LBDT": "2025-01-10", "LBORRES": "40", "VISITNUM": "2.25", "VISIT": "V2"},
    {"SUBJID": "a", "LBDT": "2025-01-10", "LBORRES": "n/a", "VISITNUM": "1"},  # no number, so no baseline
    {"SUBJID": "a", "LBDT": "2025-01-20", "LBORRES": "100", "VISITNUM": "3", "VISIT": "V3"},
    {"SUBJID": "a", "LBDT": "2025-01-20", "LBORRES": "5", "LBTESTCD": "AST", "LBTEST": ""},
    {"SUBJID": "b", "LBDT": "2025-01-09", "LBORRES": "0"},
    {"SUBJID": "b", "LBDT": "2025-01-11", "LBORRES": "8", "LBORNRHI": "x"},
]


@pytest.fixture(scope="module")
def built(spark):
    dm = cleaning.flag_dm(inline.raw(spark, inline.DM, SUBJECTS)).clean
    ae = cleaning.flag_ae(inline.raw(spark, inline.AE, EVENTS), dm).clean_with_subject
    lb = cleaning.flag_lb(inline.raw(spark, inline.LB, LABS), dm).clean_with_subject
    out = {"DM": sdtm.build_dm(dm), "ADSL": adam.build_adsl(dm)}
    out |= {"AE": sdtm.build_ae(ae, out["DM"]), "LB": sdtm.build_lb(lb, out["DM"])}
    out |= {"ADAE": adam.build_adae(out["AE"], out["ADSL"]), "ADLB": adam.build_adlb(out["LB"], out["ADSL"])}
    out["ADLB in one plan"] = adam.build_adlb(sdtm.build_lb_with_baseline(lb, out["DM"]), out["ADSL"])
    return out


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("name", ["DM", "AE", "LB", "ADSL", "ADAE", "ADLB"])
def test_variables_and_types_are_the_specified_ones(built, name):
    assert [(f.name, f.dataType) for f in built[name].schema] == list(schemas.SPECS[name])


def test_subjects(built):
    got = _rows(built["ADSL"], "SUBJID", "AGEGR1", "AGEGR1N", "TRT01PN", "TRTEDT", "TRTDURD", "SAFFL", "EOSSTT")
    assert got == [
        ("a", "<45", 1, 1, D("2025-01-20"), 11, "Y", "COMPLETED"),
        ("b", "45-64", 2, 0, D("2025-01-10"), 1, "Y", "COMPLETED"),
        ("c", ">=65", 3, 0, D("2025-02-01"), 1, "Y", "COMPLETED"),
    ]
    assert _rows(built["DM"], "DOMAIN", "USUBJID")[0] == ("DM", "SYN-SAFETY-001-a")


def test_events_are_numbered_and_flagged(built):
    # grade tells the event; equal dates go by term, equal terms by input order; there is no day 0
    got = _rows(built["ADAE"], "AESEQ", "AETOXGR", "ASTDY", "TRTEMFL", "AOCCFL", "AOCCSFL", "AOCCPFL")
    assert got == [
        (1, 1, 32, "", "", "", ""),
        (1, 3, -1, "", "", "", ""),
        (2, 4, 1, "Y", "Y", "Y", "Y"),
        (3, 2, 1, "Y", "", "Y", "Y"),
        (4, 5, 1, "Y", "", "", ""),
        (5, 1, 41, "Y", "", "", "Y"),
    ]


def test_labs_are_numbered_and_have_a_baseline(built):
    got = _rows(built["LB"], "USUBJID", "LBTESTCD", "LBSEQ", "LBORRES", "LBBLFL", "LBNRIND", "VISITNUM")
    who = "SYN-SAFETY-001-"
    assert got == [
        (f"{who}a", "ALT", 1, "30", "", "NORMAL", 1), (f"{who}a", "ALT", 2, "n/a", "", "", 1),
        (f"{who}a", "ALT", 3, "40", "Y", "NORMAL", 2), (f"{who}a", "ALT", 4, "50", "", "HIGH", 2),
        (f"{who}a", "ALT", 5, "100", "", "HIGH", 3), (f"{who}a", "AST", 6, "5", "", "LOW", 1),
        (f"{who}b", "ALT", 1, "0", "Y", "LOW", 1), (f"{who}b", "ALT", 2, "8", "", "", 1),
    ]


def test_change_from_baseline(built):
    columns = ("PARAM", "AVAL", "BASE", "CHG", "PCHG", "BNRIND", "R2ANRHI")
    alt, ast = "Alanine (U/L)", "AST (U/L)"
    want = sorted([
        (alt, 30.0, 40.0, -10.0, -25.0, "NORMAL", 0.75), (alt, None, 40.0, None, None, "NORMAL", None),
        (alt, 40.0, 40.0, 0.0, 0.0, "NORMAL", 1.0), (alt, 50.0, 40.0, 10.0, 25.0, "NORMAL", 1.25),
        (alt, 100.0, 40.0, 60.0, 150.0, "NORMAL", 2.5), (ast, 5.0, None, None, None, "", 0.125),
        (alt, 0.0, 0.0, 0.0, None, "LOW", 0.0), (alt, 8.0, 0.0, 8.0, None, "LOW", None),
    ], key=str)
    assert _rows(built["ADLB"], *columns) == want and _rows(built["ADLB in one plan"], *columns) == want


@pytest.mark.parametrize("name", ["AE", "LB"])
def test_nothing_gives_nothing_with_all_variables(spark, built, name):
    nothing = spark.createDataFrame([], schemas.struct(name))
    made = (adam.build_adae if name == "AE" else adam.build_adlb)(nothing, built["ADSL"])
    assert made.columns == schemas.struct(f"AD{name}").names and made.collect() == []


def test_a_subject_that_is_there_twice_is_an_error(built):
    twice = built["ADSL"].unionByName(built["ADSL"].limit(1))
    with pytest.raises(Exception, match="not unique"):
        adam.build_adae(built["AE"], twice).collect()


def test_labs_carry_what_adlb_needs_of_their_subject(spark):
    dm = cleaning.flag_dm(inline.raw(spark, inline.DM, SUBJECTS)).clean
    labs = cleaning.flag_lb(inline.raw(spark, inline.LB, LABS), dm).clean_with_subject
    adsl, plain = adam.build_adsl(dm), sdtm.build_lb_with_baseline(labs, sdtm.build_dm(dm), stored=True)
    rich = sdtm.build_lb_with_baseline(labs, sdtm.build_dm(dm), stored=True, subjects=adam.arms_of(adsl))
    assert sorted(sdtm.without_baseline(rich).collect()) == sorted(sdtm.without_baseline(plain).collect())
    stored = spark.createDataFrame(rich.collect(), rich.schema)
    adlb = adam.build_adlb(stored, adsl)
    assert "Join" not in adlb._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, adlb.collect())) == sorted(map(str, adam.build_adlb(plain, adsl).collect()))
    twice = sdtm.build_lb_with_baseline(labs, sdtm.build_dm(dm), stored=True, subjects=adam.arms_of(adsl.union(adsl)))
    assert sdtm.without_baseline(twice).count() == len(LABS)
    with pytest.raises(Exception, match="not unique"):
        adam.build_adlb(twice, adsl).collect()
