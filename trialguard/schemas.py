"""Fixed output schemas of the SDTM and ADaM datasets.

Each dataset is an ordered list of ``(name, type)``; variables not typed here
are strings. ``struct(name)`` gives the ``StructType`` used for empty domains.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, D, DT, B = T.StringType(), T.IntegerType(), T.DoubleType(), T.DateType(), T.BooleanType()

DM_SPEC = [
    ("STUDYID", S), ("DOMAIN", S), ("USUBJID", S), ("SUBJID", S), ("RFSTDTC", S), ("RFENDTC", S),
    ("SITEID", S), ("AGE", I), ("AGEU", S), ("SEX", S), ("RACE", S), ("ETHNIC", S), ("ARMCD", S),
    ("ARM", S), ("ACTARMCD", S), ("ACTARM", S), ("COUNTRY", S), ("DTHFL", S), ("DTHDTC", S),
]
AE_SPEC = [
    ("STUDYID", S), ("DOMAIN", S), ("USUBJID", S), ("AESEQ", I), ("AETERM", S), ("AEDECOD", S),
    ("AEBODSYS", S), ("AESEV", S), ("AESER", S), ("AEREL", S), ("AEACN", S), ("AEOUT", S),
    ("AETOXGR", I), ("AESTDTC", S), ("AEENDTC", S), ("AESTDY", I), ("AEENDY", I),
]
LB_SPEC = [
    ("STUDYID", S), ("DOMAIN", S), ("USUBJID", S), ("LBSEQ", I), ("LBTESTCD", S), ("LBTEST", S),
    ("LBORRES", S), ("LBORRESU", S), ("LBORNRLO", D), ("LBORNRHI", D), ("LBSTRESN", D),
    ("LBSTRESU", S), ("LBNRIND", S), ("LBBLFL", S), ("VISITNUM", I), ("VISIT", S), ("LBDTC", S),
    ("LBDY", I),
]
ADSL_SPEC = [
    ("STUDYID", S), ("USUBJID", S), ("SUBJID", S), ("SITEID", S), ("COUNTRY", S), ("AGE", I),
    ("AGEU", S), ("AGEGR1", S), ("AGEGR1N", I), ("SEX", S), ("RACE", S), ("ETHNIC", S),
    ("ARMCD", S), ("ARM", S), ("TRT01P", S), ("TRT01PN", I), ("TRT01A", S), ("TRT01AN", I),
    ("TRTSDT", DT), ("TRTEDT", DT), ("TRTDURD", I), ("SAFFL", S), ("ITTFL", S), ("EOSSTT", S),
    ("DCSREAS", S), ("DTHFL", S),
]
ADAE_SPEC = [
    ("STUDYID", S), ("USUBJID", S), ("SITEID", S), ("AGE", I), ("SEX", S), ("RACE", S),
    ("TRTA", S), ("TRTAN", I), ("SAFFL", S), ("TRTSDT", DT), ("TRTEDT", DT), ("AESEQ", I),
    ("AETERM", S), ("AEDECOD", S), ("AEBODSYS", S), ("AESEV", S), ("AESER", S), ("AEREL", S),
    ("AEACN", S), ("AEOUT", S), ("AETOXGR", I), ("ATOXGR", I), ("ASTDT", DT), ("AENDT", DT),
    ("ASTDY", I), ("TRTEMFL", S), ("AOCCFL", S), ("AOCCSFL", S), ("AOCCPFL", S),
]
ADLB_SPEC = [
    ("STUDYID", S), ("USUBJID", S), ("TRTA", S), ("TRTAN", I), ("SAFFL", S), ("PARAMCD", S),
    ("PARAM", S), ("AVISIT", S), ("AVISITN", I), ("ADT", DT), ("ADY", I), ("AVAL", D),
    ("BASE", D), ("CHG", D), ("PCHG", D), ("ANRLO", D), ("ANRHI", D), ("ANRIND", S),
    ("BNRIND", S), ("ABLFL", S), ("R2ANRHI", D),
]
FINDINGS_SPEC = [
    ("rule_id", S), ("domain", S), ("severity", S), ("message", S), ("count", T.LongType()),
    ("examples", S),
]

SPECS = {
    "DM": DM_SPEC, "AE": AE_SPEC, "LB": LB_SPEC,
    "ADSL": ADSL_SPEC, "ADAE": ADAE_SPEC, "ADLB": ADLB_SPEC,
    "FINDINGS": FINDINGS_SPEC,
}


def names(name: str) -> list[str]:
    """Ordered variable names of a dataset."""
    return [n for n, _ in SPECS[name]]


def struct(name: str) -> T.StructType:
    """The ``StructType`` of a dataset (every field nullable)."""
    return T.StructType([T.StructField(n, t, True) for n, t in SPECS[name]])


DM_VARS, AE_VARS, LB_VARS = names("DM"), names("AE"), names("LB")
ADSL_VARS, ADAE_VARS, ADLB_VARS = names("ADSL"), names("ADAE"), names("ADLB")
