"""Safety tables and views on datasets of a few rows, with every cell written out."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tests import inline
from trialguard import schemas
from trialguard.operators import tables, views

P, L, H = "Placebo", "Drug A 50 mg", "Drug A 100 mg"
SUBJECTS = [("p1", P, 0, "Y", 30, "F"), ("p2", P, 0, "Y", 50, "M"), ("l1", L, 1, "Y", 60, "F"), ("l2", L, 1, "N", 70, "F"), ("h1", H, 2, "Y", 80, "M")]
EVENTS = [  # subject, SOC, PT, emergent, serious, grade, relation, action, outcome
    ("p1", "S1", "A", "Y", "N", 1, "", "", ""), ("p1", "S1", "A", "Y", "Y", 4, "RELATED", "", ""), ("p1", "S1", "B", "Y", "N", None, "", "DRUG WITHDRAWN", ""),
    ("p2", "S2", "A", "", "Y", 5, "RELATED", "", "FATAL"), ("l1", "S1", "B", "Y", "N", 3, "NOT RELATED", "", ""), ("l2", "S1", "B", "Y", "Y", 3, "", "", "FATAL"),
    ("h1", "S2", "C", "Y", "N", 2, "POSSIBLY RELATED", "", "FATAL"),
]
LABS = [  # subject, parameter, visit, day, value, base, indicator, base indicator, baseline, ratio
    ("p1", "ALT", 1, 1, 10.0, 10.0, "NORMAL", "NORMAL", "Y", 9.0), ("p1", "ALT", 2, 8, 14.0, 10.0, "LOW", "NORMAL", "", 3.0),
    ("p1", "ALT", 3, 15, 16.0, 10.0, "NORMAL", "NORMAL", "", 1.0), ("p1", "BILI", 2, 8, 5.0, None, "HIGH", "", "", 2.0),
    ("p2", "ALT", 2, 8, 18.0, 10.0, "HIGH", "NORMAL", "", None), ("l1", "AST", 2, 9, 7.0, 5.0, "HIGH", "LOW", "", 2.9),
    ("l1", "BILI", 2, 9, 7.0, 5.0, "", "LOW", "", 4.0), ("h1", "AST", 2, 9, None, 5.0, "", "LOW", "", None), ("h1", "GGT", 2, 9, 7.0, 5.0, "LOW", "LOW", "", 9.0),
]


@pytest.fixture(scope="module")
def sets(spark):
    arm = {s[0]: s[1] for s in SUBJECTS}
    safe = {s[0]: s[3] for s in SUBJECTS}
    group = lambda age: ("<45", 1) if age < 45 else ("45-64", 2) if age < 65 else (">=65", 3)
    adsl = inline.dataset(spark, "ADSL", [
        {"USUBJID": u, "TRT01A": a, "TRT01AN": n, "SAFFL": s, "AGE": age, "AGEGR1": group(age)[0], "AGEGR1N": group(age)[1], "SEX": sex, "RACE": "ASIAN"}
        for u, a, n, s, age, sex in SUBJECTS
    ])
    adae = inline.dataset(spark, "ADAE", [
        dict(zip(("USUBJID", "AEBODSYS", "AEDECOD", "TRTEMFL", "AESER", "ATOXGR", "AEREL", "AEACN", "AEOUT"), e, strict=True)) | {"TRTA": arm[e[0]], "SAFFL": safe[e[0]]}
        for e in EVENTS
    ])
    adlb = inline.dataset(spark, "ADLB", [
        {"USUBJID": u, "PARAMCD": p, "PARAM": p.title(), "TRTA": arm[u], "AVISITN": v, "AVISIT": f"V{v}", "ADY": d, "AVAL": x, "BASE": b,
         "CHG": None if x is None or b is None else x - b, "ANRIND": i, "BNRIND": bi, "ABLFL": f, "R2ANRHI": r}
        for u, p, v, d, x, b, i, bi, f, r in LABS
    ])
    return adsl, adae, adlb, tables.arm_summary(adsl)


def _rows(df, *columns):
    return [tuple(r) for r in df.select(*[F.col(f"`{c}`") for c in columns or df.columns]).collect()]


def test_arms_and_their_sizes(sets):
    assert sets[3].names == (P, L, H) and sets[3].n == {P: 2, L: 1, H: 1, "Total": 4}
    assert _rows(tables.safety_n(sets[0])) == [(H, 1), (L, 1), (P, 2), ("Total", 4)]


def test_overview(sets):
    adsl, adae, _, arms = sets
    want = [
        ("Any TEAE", 1, 1, 1, 3, "3 (75.0%)"), ("Any serious TEAE", 1, 0, 0, 1, "1 (25.0%)"), ("Any grade >=3 TEAE", 1, 1, 0, 2, "2 (50.0%)"),
        ("Any treatment-related TEAE", 1, 0, 1, 2, "2 (50.0%)"), ("TEAE leading to treatment discontinuation", 1, 0, 0, 1, "1 (25.0%)"),
        ("TEAE leading to death", 0, 0, 1, 1, "1 (25.0%)"),
    ]
    columns = ("Category", f"_n_{P}", f"_n_{L}", f"_n_{H}", "_n_Total", "Total")
    assert _rows(tables.teae_overview(adsl, adae, arms), *columns) == want
    assert _rows(tables.teae_overview(adsl, tables.event_profile(adae), arms), *columns) == want


def test_terms_by_class(sets):
    adsl, adae, _, arms = sets
    got = _rows(tables.teae_soc_pt(adsl, adae, arms), "SOC", "PT", P, L, H, "_total")
    one, none = "1 (50.0%)", "0 (0.0%)"
    assert got == [
        ("S1", "", one, "1 (100.0%)", none, 2), ("S1", "B", one, "1 (100.0%)", none, 2), ("S1", "A", one, none, none, 1),
        ("S2", "", none, none, "1 (100.0%)", 1), ("S2", "C", none, none, "1 (100.0%)", 1),
    ]


def test_differences_to_the_control(sets):
    adsl, adae, _, arms = sets
    risk = tables.risk_differences(adsl, adae, arms=arms)
    got = _rows(risk, "SOC", "PT", "Arm", "n_active", "N_active_arm", "n_control", "N_control_arm", "Diff")
    assert got == [
        ("S2", "C", H, 1, 1, 0, 2, 100.0), ("S1", "B", L, 1, 1, 1, 2, 50.0), ("S2", "C", L, 0, 1, 0, 2, 0.0),
        ("S1", "A", H, 0, 1, 1, 2, -50.0), ("S1", "A", L, 0, 1, 1, 2, -50.0), ("S1", "B", H, 0, 1, 1, 2, -50.0),
    ]
    assert all(lo <= d <= hi for lo, d, hi in _rows(risk, "Lower", "Diff", "Upper"))
    assert _rows(views.forest_rows(risk, L, min_subjects=2), "PT") == [("B",)] and views.default_forest_arm(arms) == L
    assert tables.risk_differences(adsl, adae, control="nobody", arms=arms).collect() == []


def test_labs(sets):
    for adlb in (sets[2], tables.lab_profile(sets[2])):
        assert _rows(tables.lab_shift(adlb)) == [
            ("ALT", P, "NORMAL", "HIGH", 1), ("ALT", P, "NORMAL", "LOW", 1), ("AST", L, "LOW", "HIGH", 1), ("GGT", H, "LOW", "LOW", 1),
        ]
        assert _rows(tables.hys_law(adlb)) == [("p1", P, 3.0, 2.0, True), ("l1", L, 2.9, 4.0, False)]
        change = _rows(tables.lab_mean_change(adlb), "PARAMCD", "TRTA", "AVISITN", "n", "Mean CHG", "SE")
        assert change == [
            ("ALT", P, 2, 2, 6.0, pytest.approx(math.sqrt(8) / math.sqrt(2))), ("ALT", P, 3, 1, 6.0, None), ("AST", L, 2, 1, 2.0, None),
            ("BILI", L, 2, 1, 2.0, None), ("GGT", H, 2, 1, 2.0, None),
        ]


def test_the_profiles_read_their_dataset_once(sets):
    for df, profile in ((sets[1], tables.event_profile), (sets[2], tables.lab_profile)):
        plan = profile(df)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LogicalRDD") == 1 and "Join" not in plan


def test_subjects(sets):
    got = _rows(tables.demographics(sets[0], sets[3]), "Characteristic", P, "Total")
    assert got == [
        ("N", "2", "4"), ("Age, mean (SD)", "40.0 (14.1)", "55.0 (20.8)"), ("Age, median (min-max)", "40 (30-50)", "55 (30-80)"),
        ("Age group: <45", "1 (50.0%)", "1 (25.0%)"), ("Age group: 45-64", "1 (50.0%)", "2 (50.0%)"), ("Age group: >=65", "0 (0.0%)", "1 (25.0%)"),
        ("Sex: F", "1 (50.0%)", "2 (50.0%)"), ("Sex: M", "1 (50.0%)", "2 (50.0%)"), ("Race: ASIAN", "2 (100.0%)", "4 (100.0%)"),
    ]


def test_views(sets):
    adsl, adae, adlb, arms = sets
    # terms by subjects of any population
    assert sorted(_rows(views.pt_incidence_top(adae, arms, 1))) == [("B", L, 2, 200.0), ("B", P, 1, 50.0)]
    hys = tables.hys_law(adlb)
    assert _rows(views.dashboard_kpis(adsl, tables.teae_overview(adsl, adae, arms), hys)) == [(4, 75.0, 1, 2, 1, 1)]
    found = views.soc_pt_search(tables.teae_soc_pt(adsl, adae, arms), "s2")
    assert _rows(found, "SOC", "PT") == [("S2", views.ANY_TERM_IN_SOC), ("S2", "C")] and "_total" not in found.columns
    assert views.edish_points(hys).count() == 2
    assert _rows(views.lab_shift_wide(tables.lab_shift(adlb), "ALT"), "HIGH", "LOW", "NORMAL") == [(1, 1, 0)]
    assert _rows(views.dataset_preview(adae, ["USUBJID", "AEDECOD", "AESER"], 2), "USUBJID", "AEDECOD") == [("h1", "C"), ("l1", "B")]


def test_nothing_to_count(spark, sets):
    adsl, _, _, arms = sets
    ae, lb = (spark.createDataFrame([], schemas.struct(n)) for n in ("ADAE", "ADLB"))
    for made in (tables.teae_soc_pt(adsl, ae, arms), tables.risk_differences(adsl, ae, arms=arms), tables.lab_shift(lb), tables.hys_law(lb), tables.lab_mean_change(lb)):
        assert made.collect() == []
    assert _rows(tables.teae_overview(adsl, ae, arms), "_n_Total", "Total") == [(0, "0 (0.0%)")] * 6
