"""Controlled terminology and study-design constants.

Everything in this module is a fixed value: the outputs must carry exactly
these codes, labels and thresholds, so they are written out plainly here and
used everywhere else by name.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the published behaviour; do not edit)
# ---------------------------------------------------------------------------

STUDYID = "SYN-SAFETY-001"

SEX_CT = ("M", "F", "U", "UNDIFFERENTIATED")
AESEV_CT = ("MILD", "MODERATE", "SEVERE")
NY_CT = ("Y", "N")
RACE_CT = (
    "WHITE",
    "BLACK OR AFRICAN AMERICAN",
    "ASIAN",
    "AMERICAN INDIAN OR ALASKA NATIVE",
    "NATIVE HAWAIIAN OR OTHER PACIFIC ISLANDER",
    "MULTIPLE",
    "NOT REPORTED",
    "UNKNOWN",
)
RELATED_TERMS = ("POSSIBLY RELATED", "PROBABLY RELATED", "RELATED")
LBNRIND_CT = ("LOW", "NORMAL", "HIGH", "")

# Raw-value synonym maps (keys are compared after upper-casing).
SEX_SYNONYMS = {
    "M": "M",
    "MALE": "M",
    "F": "F",
    "FEMALE": "F",
    "U": "U",
    "UNKNOWN": "U",
    "UNDIFFERENTIATED": "UNDIFFERENTIATED",
}
YN_SYNONYMS = {"Y": "Y", "YES": "Y", "1": "Y", "TRUE": "Y", "N": "N", "NO": "N", "0": "N", "FALSE": "N"}


@dataclass(frozen=True)
class Arm:
    """A planned treatment arm."""

    armcd: str
    arm: str
    trtn: int


ARMS: tuple[Arm, ...] = (
    Arm("PBO", "Placebo", 0),
    Arm("DRGA50", "Drug A 50 mg", 1),
    Arm("DRGA100", "Drug A 100 mg", 2),
)
ARM_CODES = tuple(a.armcd for a in ARMS)
CONTROL_ARM = "Placebo"

# (label, code, lower bound inclusive, upper bound exclusive)
AGE_GROUPS: tuple[tuple[str, int, float, float], ...] = (
    ("<45", 1, 0, 45),
    ("45-64", 2, 45, 65),
    (">=65", 3, 65, 200),
)

TEAE_WINDOW_DAYS = 30
HYS_ALT_AST_ULN = 3.0
HYS_BILI_ULN = 2.0
Z95 = 1.959963984540054
DASHBOARD_Z = 1.96
PROTOCOL_AGE_MIN = 18
PROTOCOL_AGE_MAX = 85
AGE_MIN = 0
AGE_MAX = 120

SEVERITIES = ("ERROR", "WARNING", "NOTE")
STATUS_PASSED = "PASSED"
STATUS_WARN = "PASSED WITH FINDINGS"
STATUS_FAILED = "FAILED"

# Variable labels (at most 40 characters each, as SAS v5 transport requires).
LABELS: dict[str, str] = {
    "STUDYID": "Study Identifier",
    "DOMAIN": "Domain Abbreviation",
    "USUBJID": "Unique Subject Identifier",
    "SUBJID": "Subject Identifier for the Study",
    "SITEID": "Study Site Identifier",
    "RFSTDTC": "Subject Reference Start Date/Time",
    "RFENDTC": "Subject Reference End Date/Time",
    "AGE": "Age",
    "AGEU": "Age Units",
    "SEX": "Sex",
    "RACE": "Race",
    "ETHNIC": "Ethnicity",
    "ARMCD": "Planned Arm Code",
    "ARM": "Description of Planned Arm",
    "ACTARMCD": "Actual Arm Code",
    "ACTARM": "Description of Actual Arm",
    "COUNTRY": "Country",
    "DTHFL": "Subject Death Flag",
    "DTHDTC": "Date/Time of Death",
    "AESEQ": "Sequence Number",
    "AETERM": "Reported Term for the Adverse Event",
    "AEDECOD": "Dictionary-Derived Term",
    "AEBODSYS": "Body System or Organ Class",
    "AESEV": "Severity/Intensity",
    "AESER": "Serious Event",
    "AEREL": "Causality",
    "AEACN": "Action Taken with Study Treatment",
    "AEOUT": "Outcome of Adverse Event",
    "AETOXGR": "Standard Toxicity Grade",
    "AESTDTC": "Start Date/Time of Adverse Event",
    "AEENDTC": "End Date/Time of Adverse Event",
    "AESTDY": "Study Day of Start of Adverse Event",
    "AEENDY": "Study Day of End of Adverse Event",
    "LBSEQ": "Sequence Number",
    "LBTESTCD": "Lab Test or Examination Short Name",
    "LBTEST": "Lab Test or Examination Name",
    "LBORRES": "Result or Finding in Original Units",
    "LBORRESU": "Original Units",
    "LBORNRLO": "Reference Range Lower Limit in Orig Unit",
    "LBORNRHI": "Reference Range Upper Limit in Orig Unit",
    "LBSTRESN": "Numeric Result/Finding in Standard Units",
    "LBSTRESU": "Standard Units",
    "LBNRIND": "Reference Range Indicator",
    "LBBLFL": "Baseline Flag",
    "VISITNUM": "Visit Number",
    "VISIT": "Visit Name",
    "LBDTC": "Date/Time of Specimen Collection",
    "LBDY": "Study Day of Specimen Collection",
    "AGEGR1": "Pooled Age Group 1",
    "AGEGR1N": "Pooled Age Group 1 (N)",
    "TRT01P": "Planned Treatment for Period 01",
    "TRT01PN": "Planned Treatment for Period 01 (N)",
    "TRT01A": "Actual Treatment for Period 01",
    "TRT01AN": "Actual Treatment for Period 01 (N)",
    "TRTSDT": "Date of First Exposure to Treatment",
    "TRTEDT": "Date of Last Exposure to Treatment",
    "TRTDURD": "Total Treatment Duration (Days)",
    "SAFFL": "Safety Population Flag",
    "ITTFL": "Intent-To-Treat Population Flag",
    "EOSSTT": "End of Study Status",
    "DCSREAS": "Reason for Discontinuation from Study",
    "TRTA": "Actual Treatment",
    "TRTAN": "Actual Treatment (N)",
    "ASTDT": "Analysis Start Date",
    "AENDT": "Analysis End Date",
    "ASTDY": "Analysis Start Relative Day",
    "TRTEMFL": "Treatment Emergent Analysis Flag",
    "AOCCFL": "1st Occurrence within Subject Flag",
    "AOCCSFL": "1st Occurrence of SOC Flag",
    "AOCCPFL": "1st Occurrence of Preferred Term Flag",
    "ATOXGR": "Analysis Toxicity Grade",
    "PARAMCD": "Parameter Code",
    "PARAM": "Parameter",
    "AVISIT": "Analysis Visit",
    "AVISITN": "Analysis Visit (N)",
    "ADT": "Analysis Date",
    "ADY": "Analysis Relative Day",
    "AVAL": "Analysis Value",
    "BASE": "Baseline Value",
    "CHG": "Change from Baseline",
    "PCHG": "Percent Change from Baseline",
    "ANRLO": "Analysis Normal Range Lower Limit",
    "ANRHI": "Analysis Normal Range Upper Limit",
    "ANRIND": "Analysis Reference Range Indicator",
    "BNRIND": "Baseline Reference Range Indicator",
    "ABLFL": "Baseline Record Flag",
    "R2ANRHI": "Ratio to Analysis Normal Range Upper",
}

DATASET_LABELS = {
    "DM": "Demographics",
    "AE": "Adverse Events",
    "LB": "Laboratory Test Results",
    "ADSL": "Subject-Level Analysis Dataset",
    "ADAE": "Adverse Event Analysis Dataset",
    "ADLB": "Laboratory Analysis Dataset",
}

# Required raw columns per domain, and optional raw columns with their defaults.
REQUIRED_RAW: dict[str, tuple[str, ...]] = {
    "dm": ("SUBJID", "SITEID", "AGE", "SEX", "RACE", "ARMCD", "ARM", "TRTSDT", "TRTEDT"),
    "ae": ("SUBJID", "AEDECOD", "AEBODSYS", "AESTDT", "AETOXGR", "AESER"),
    "lb": ("SUBJID", "VISITNUM", "VISIT", "LBDT", "LBTESTCD", "LBORRES", "LBORNRLO", "LBORNRHI"),
}
OPTIONAL_RAW: dict[str, tuple[str, ...]] = {
    "dm": ("ETHNIC", "COUNTRY", "RANDDT", "DCSREAS", "DTHDT"),
    "ae": ("AETERM", "AEENDT", "AESEV", "AEREL", "AEACN", "AEOUT"),
    "lb": ("LBTEST", "LBORRESU"),
}
