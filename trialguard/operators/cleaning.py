"""Row-level cleaning of raw DM, AE and LB.

Each ``flag_*`` function evaluates the domain's ordered rules in one pass
(see ``rules.py``); ``clean_*`` returns the clean rows, the quarantined rows
(raw values plus ``QREASON``) and the findings, all from that one flagged table.

Input order matters ("first copy" of a subject, sequence numbers), so every raw
table carries ``RECNO``; when a caller does not supply one it is created at
read time and reflects file order only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialguard import terminology as tm
from trialguard.functions import (
    blank_to,
    iso_date,
    is_in,
    race_upper,
    severity,
    sex_term,
    to_number,
    toxicity_grade,
    usubjid,
    yes_no,
)
from trialguard.operators import keys
from trialguard.operators.rules import Rule, findings_of, flag_rows

# ---------------------------------------------------------------------------
# FIXED VALUES: rule ids, severities, messages and quarantine reasons.
# ---------------------------------------------------------------------------
DM_R01 = Rule("DM-R01", "DM", "ERROR", "Subject identifier is missing; record quarantined", "missing SUBJID", examples=False)
DM_R02 = Rule("DM-R02", "DM", "ERROR", "Duplicate subject record; later copy quarantined", "duplicate SUBJID")
DM_R03 = Rule("DM-R03", "DM", "ERROR", "AGE missing, non-numeric or outside 0-120", "invalid AGE")
DM_R04 = Rule("DM-R04", "DM", "WARNING", "AGE outside protocol range 18-85")
DM_R05 = Rule("DM-R05", "DM", "WARNING", "SEX mapped to CDISC terminology (e.g. Male -> M)")
DM_R06 = Rule("DM-R06", "DM", "ERROR", "SEX not mappable to CDISC terminology", "invalid SEX")
DM_R07 = Rule("DM-R07", "DM", "WARNING", "RACE not in CDISC terminology; set to UNKNOWN")
DM_R08 = Rule("DM-R08", "DM", "ERROR", "ARMCD is not a planned arm", "invalid ARMCD")
DM_R09 = Rule("DM-R09", "DM", "ERROR", "First-dose date missing or not ISO 8601", "invalid TRTSDT")
DM_R10 = Rule("DM-R10", "DM", "WARNING", "Last-dose date missing/invalid; set to first-dose date")
DM_RULES = (DM_R01, DM_R02, DM_R03, DM_R04, DM_R05, DM_R06, DM_R07, DM_R08, DM_R09, DM_R10)

AE_R01 = Rule("AE-R01", "AE", "ERROR", "Adverse event for a subject not in (or removed from) DM; quarantined", "subject not in DM")
AE_R02 = Rule("AE-R02", "AE", "ERROR", "AE start date missing or not ISO 8601; quarantined", "invalid AESTDT")
AE_R03 = Rule("AE-R03", "AE", "WARNING", "AE end date not ISO 8601; set to missing (ongoing)")
AE_R04 = Rule("AE-R04", "AE", "WARNING", "AE end date before start date; end date set to missing")
AE_R05 = Rule("AE-R05", "AE", "WARNING", "Toxicity grade not 1-5; set to missing")
AE_R06 = Rule("AE-R06", "AE", "WARNING", "AESER not Y/N; treated as N")
AE_RULES = (AE_R01, AE_R02, AE_R03, AE_R04, AE_R05, AE_R06)

LB_R01 = Rule("LB-R01", "LB", "ERROR", "Lab result for a subject not in (or removed from) DM; quarantined", "subject not in DM")
LB_R02 = Rule("LB-R02", "LB", "ERROR", "Collection date missing or not ISO 8601; quarantined", "invalid LBDT")
LB_R03 = Rule("LB-R03", "LB", "ERROR", "Visit number not numeric; quarantined", "invalid VISITNUM")
LB_R04 = Rule("LB-R04", "LB", "WARNING", "Non-numeric result (e.g. '<5'); kept as text, excluded from analysis")
LB_R05 = Rule("LB-R05", "LB", "WARNING", "Reference range missing or low >= high")
LB_RULES = (LB_R01, LB_R02, LB_R03, LB_R04, LB_R05)

OPTIONAL_DEFAULTS = {
    "dm": {"ETHNIC": "NOT REPORTED", "COUNTRY": "", "RANDDT": "", "DCSREAS": "", "DTHDT": ""},
    "ae": {c: "" for c in tm.OPTIONAL_RAW["ae"]},
    "lb": {c: "" for c in tm.OPTIONAL_RAW["lb"]},
}

DM_CLEAN_COLS = [
    "RECNO", "SUBJID", "USUBJID", "SITEID", "AGE", "SEX", "RACE", "ETHNIC", "COUNTRY", "ARMCD", "ARM",
    "TRTSDT", "TRTEDT", "RANDDT", "DTHDT", "DCSREAS",
]
AE_CLEAN_COLS = [
    "RECNO", "SUBJID", "USUBJID", "AETERM", "AEDECOD", "AEBODSYS", "AESTDT", "AEENDT", "AETOXGR", "AESER",
    "AESEV", "AEREL", "AEACN", "AEOUT",
]
LB_CLEAN_COLS = [
    "RECNO", "SUBJID", "USUBJID", "VISITNUM", "VISIT", "LBDT", "LBTESTCD", "LBTEST", "LBORRES", "LBORRESU",
    "LBSTRESN", "LBORNRLO", "LBORNRHI",
]

#: Clean columns that hold the raw text as it is (defaults filled in).
UNCHANGED = {
    "DM": ("RECNO", "SUBJID", "SITEID", "ETHNIC", "COUNTRY", "ARMCD", "ARM", "DCSREAS"),
    "AE": ("RECNO", "SUBJID", "AEDECOD", "AEBODSYS", "AEREL", "AEACN", "AEOUT"),
    "LB": ("RECNO", "SUBJID", "VISIT", "LBTESTCD", "LBTEST", "LBORRES", "LBORRESU"),
}


@dataclass
class Cleaned:
    """The flagged table of one domain and the three views derived from it."""

    flagged: DataFrame
    raw_columns: list[str]
    clean_columns: list[str]
    rules: tuple[Rule, ...]
    looked_up: tuple[str, ...] = ()  # of the subject, beside the domain's own columns

    @property
    def clean(self) -> DataFrame:
        return self.flagged.filter(F.col("QREASON").isNull()).select(*[F.col(f"_c_{c}").alias(c) for c in self.clean_columns])

    @property
    def clean_with_subject(self) -> DataFrame:
        """The clean rows and what the subject lookup brought along, so that it isn't looked up again."""
        columns = [*self.clean_columns, *self.looked_up]
        return self.flagged.filter(F.col("QREASON").isNull()).select(*[F.col(f"_c_{c}").alias(c) for c in columns])

    @property
    def quarantine(self) -> DataFrame:
        return self.flagged.filter(F.col("QREASON").isNotNull()).select(*self.raw_columns, "QREASON")

    @property
    def findings(self) -> DataFrame:
        return findings_of(self.flagged, self.rules, "SUBJID")

    @property
    def essential(self) -> DataFrame:
        """The flagged table without intermediate columns: what clean, quarantine and findings read.

        Clean values that are the raw ones are left out; ``of_stored`` gives them back.
        """
        derived = [f"_c_{c}" for c in (*self.clean_columns, *self.looked_up) if c not in UNCHANGED[self.rules[0].domain]]
        keep = [*self.raw_columns, *derived, "_hits", "QREASON"]
        return self.flagged.select(*[F.col(f"`{c}`") for c in dict.fromkeys(keep)])

    def with_flagged(self, flagged: DataFrame) -> Cleaned:
        """Same views over a materialised copy of the (essential) flagged table."""
        return Cleaned(flagged, self.raw_columns, self.clean_columns, self.rules, self.looked_up)


def of_stored(domain: str, flagged: DataFrame) -> Cleaned:
    """The views over a stored (essential) flagged table of ``domain`` (``dm``, ``ae`` or ``lb``)."""
    columns, rules = {
        "dm": (DM_CLEAN_COLS, DM_RULES), "ae": (AE_CLEAN_COLS, AE_RULES), "lb": (LB_CLEAN_COLS, LB_RULES),
    }[domain]
    raw = [c for c in flagged.columns if not c.startswith(("_c_", "_hits")) and c != "QREASON"]
    looked_up = tuple(c for c in (REFERENCE_DATE,) if f"_c_{c}" in flagged.columns)
    flagged = flagged.withColumns({f"_c_{c}": F.col(c) for c in UNCHANGED[domain.upper()]})
    return Cleaned(flagged, raw, columns, rules, looked_up)


def quarantined() -> Column:
    """Rows of a flagged table that are quarantined, as an aggregate."""
    return F.count("QREASON").alias("quarantined")


def with_defaults(raw: DataFrame, domain: str) -> DataFrame:
    """Add absent optional columns with their defaults, NULL text as ``''`` and ``RECNO`` if missing."""
    df = raw
    for c, default in OPTIONAL_DEFAULTS[domain].items():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(default))
    if "RECNO" not in df.columns:
        df = df.withColumn("RECNO", F.monotonically_increasing_id())
    text = [c for c, t in df.dtypes if t == "string"]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in text})


def _raw_columns(df: DataFrame) -> list[str]:
    return ["RECNO"] + [c for c in df.columns if c != "RECNO"]


def flag_dm(raw: DataFrame, again: DataFrame | None = None) -> Cleaned:
    """Flag demographics with DM-R01..DM-R10 in one pass.

    The first copies of subjects are read from ``again``: the same rows without the metrics that ``raw`` may carry.
    """
    df = with_defaults(raw, "dm")
    raw_cols = _raw_columns(df)
    subj = F.col("SUBJID")
    blank = subj == ""
    # DM-R02: the first copy of a subject is the one with the lowest RECNO. A per-subject
    # minimum (partially aggregated before the shuffle) joined back keeps a heavily
    # duplicated subject from landing in one task.
    copies = df if again is None else with_defaults(again, "dm")
    first = copies.filter(~blank).groupBy("SUBJID").agg(F.min("RECNO").alias("_first_recno"))
    df = df.join(first, "SUBJID", "left")
    df = df.withColumns(
        {
            "_p_age": to_number("AGE"),
            "_p_sex": sex_term("SEX"),
            "_p_race": race_upper("RACE"),
            "_p_start": iso_date("TRTSDT"),
            "_p_end": iso_date("TRTEDT"),
        }
    )
    age, sex, race, start, end = (F.col(c) for c in ("_p_age", "_p_sex", "_p_race", "_p_start", "_p_end"))
    # only an age that passes DM-R03 is cast: any number may stand in the raw text
    age_int = F.when((age >= tm.AGE_MIN) & (age <= tm.AGE_MAX), age).try_cast("int")
    df = df.withColumns(
        {
            "_c_AGE": age_int,
            "_c_SEX": sex,
            "_c_RACE": F.when(is_in(race, tm.RACE_CT), race).otherwise(F.lit("UNKNOWN")),
            "_c_TRTSDT": start,
            "_c_TRTEDT": F.when(end.isNull() | (end < start), start).otherwise(end),
        }
    )
    checks = [
        (DM_R01, blank),
        (DM_R02, ~blank & (F.col("RECNO") != F.col("_first_recno"))),
        (DM_R03, age.isNull() | (age < tm.AGE_MIN) | (age > tm.AGE_MAX)),
        (DM_R04, (age_int < tm.PROTOCOL_AGE_MIN) | (age_int > tm.PROTOCOL_AGE_MAX)),
        (DM_R05, sex.isNotNull() & (sex != F.col("SEX"))),
        (DM_R06, sex.isNull()),
        (DM_R07, ~is_in(race, tm.RACE_CT)),
        (DM_R08, ~is_in("ARMCD", tm.ARM_CODES)),
        (DM_R09, start.isNull()),
        (DM_R10, end.isNull() | (end < start)),
    ]
    flagged = flag_rows(df, checks).withColumns(
        {
            "_c_RECNO": F.col("RECNO"),
            "_c_SUBJID": subj,
            "_c_USUBJID": usubjid(subj),
            "_c_SITEID": F.col("SITEID"),
            "_c_ETHNIC": F.col("ETHNIC"),
            "_c_COUNTRY": F.col("COUNTRY"),
            "_c_ARMCD": F.col("ARMCD"),
            "_c_ARM": F.col("ARM"),
            "_c_RANDDT": iso_date("RANDDT"),
            "_c_DTHDT": iso_date("DTHDT"),
            "_c_DCSREAS": F.col("DCSREAS"),
        }
    )
    return Cleaned(flagged, raw_cols, DM_CLEAN_COLS, DM_RULES)


#: Reference start date of a row's subject.
REFERENCE_DATE = "_RFSTDT"


def _known_subjects(subjects: DataFrame) -> DataFrame:
    """Clean-DM subject keys with a match marker and, if known, the reference date (one row per subject)."""
    key = F.col("USUBJID") if "USUBJID" in subjects.columns else usubjid("SUBJID")
    date = [F.col("TRTSDT").alias(REFERENCE_DATE)] if dict(subjects.dtypes).get("TRTSDT") == "date" else []
    return subjects.select(key.alias("USUBJID"), F.lit(True).alias("_known"), *date)


def _with_subject(df: DataFrame, subjects: DataFrame) -> tuple[DataFrame, tuple[str, ...]]:
    """Rows keyed by USUBJID and joined with the known subjects; what the join brought along."""
    # the key is worked out from SUBJID on both sides of the shuffle, which then carries it once
    known = _known_subjects(subjects).withColumnRenamed("USUBJID", "_subject")
    joined = df.join(known, usubjid("SUBJID") == F.col("_subject"), "left").drop("_subject")
    return joined.withColumn("USUBJID", usubjid("SUBJID")), tuple(c for c in known.columns if c == REFERENCE_DATE)


def flag_ae(raw: DataFrame, subjects: DataFrame) -> Cleaned:
    """Flag adverse events with AE-R01..AE-R06; ``subjects`` is the clean DM (or its keys)."""
    df = with_defaults(raw, "ae")
    raw_cols = _raw_columns(df)
    df, looked_up = _with_subject(df, subjects)
    df = df.withColumns(
        {
            "_p_start": iso_date("AESTDT"),
            "_p_end": iso_date("AEENDT"),
            "_p_grade": toxicity_grade("AETOXGR"),
            "_p_ser": yes_no("AESER"),
        }
    )
    start, end, grade, ser = (F.col(c) for c in ("_p_start", "_p_end", "_p_grade", "_p_ser"))
    bad_end_text = (F.col("AEENDT") != "") & end.isNull()
    reversed_ = end.isNotNull() & (end < start)
    checks = [
        (AE_R01, F.col("_known").isNull()),
        (AE_R02, start.isNull()),
        (AE_R03, bad_end_text),
        (AE_R04, reversed_),
        (AE_R05, grade.isNull()),
        (AE_R06, ser.isNull()),
    ]
    flagged = flag_rows(df, checks).withColumns(
        {
            "_c_RECNO": F.col("RECNO"),
            "_c_SUBJID": F.col("SUBJID"),
            "_c_USUBJID": F.col("USUBJID"),
            "_c_AETERM": blank_to("AETERM", "AEDECOD"),
            "_c_AEDECOD": F.col("AEDECOD"),
            "_c_AEBODSYS": F.col("AEBODSYS"),
            "_c_AESTDT": start,
            "_c_AEENDT": F.when(~reversed_, end),
            "_c_AETOXGR": grade,
            "_c_AESER": F.coalesce(ser, F.lit("N")),
            "_c_AESEV": severity("AESEV", grade),
            "_c_AEREL": F.col("AEREL"),
            "_c_AEACN": F.col("AEACN"),
            "_c_AEOUT": F.col("AEOUT"),
            **{f"_c_{c}": F.col(c) for c in looked_up},
        }
    )
    return Cleaned(flagged, raw_cols, AE_CLEAN_COLS, AE_RULES, looked_up)


def flag_lb(raw: DataFrame, subjects: DataFrame) -> Cleaned:
    """Flag lab results with LB-R01..LB-R05; ``subjects`` is the clean DM (or its keys)."""
    df = with_defaults(raw, "lb")
    raw_cols = _raw_columns(df)
    df, looked_up = _with_subject(df, subjects)
    df = df.withColumns(
        {
            "_p_lbdt": iso_date("LBDT"),
            "_p_visit": to_number("VISITNUM"),
            "_p_value": to_number("LBORRES"),
            "_p_lo": to_number("LBORNRLO"),
            "_p_hi": to_number("LBORNRHI"),
        }
    )
    lbdt, visit, value, lo, hi = (F.col(c) for c in ("_p_lbdt", "_p_visit", "_p_value", "_p_lo", "_p_hi"))
    bad_range = lo.isNull() | hi.isNull() | (lo >= hi)
    checks = [
        (LB_R01, F.col("_known").isNull()),
        (LB_R02, lbdt.isNull()),
        (LB_R03, visit.isNull()),
        (LB_R04, value.isNull()),
        (LB_R05, bad_range),
    ]
    flagged = flag_rows(df, checks).withColumns(
        {
            "_c_RECNO": F.col("RECNO"),
            "_c_SUBJID": F.col("SUBJID"),
            "_c_USUBJID": F.col("USUBJID"),
            "_c_VISITNUM": visit,
            "_c_VISIT": F.col("VISIT"),
            "_c_LBDT": lbdt,
            "_c_LBTESTCD": F.col("LBTESTCD"),
            "_c_LBTEST": F.col("LBTEST"),
            "_c_LBORRES": F.col("LBORRES"),
            "_c_LBORRESU": F.col("LBORRESU"),
            "_c_LBSTRESN": value,
            "_c_LBORNRLO": F.when(~bad_range, lo),
            "_c_LBORNRHI": F.when(~bad_range, hi),
            **{f"_c_{c}": F.col(c) for c in looked_up},
        }
    )
    return Cleaned(flagged, raw_cols, LB_CLEAN_COLS, LB_RULES, looked_up)


def clean_dm(raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean, quarantine, findings) of demographics."""
    c = flag_dm(raw)
    return c.clean, c.quarantine, c.findings


def clean_ae(raw: DataFrame, subjects: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean, quarantine, findings) of adverse events."""
    c = flag_ae(raw, subjects)
    return c.clean, c.quarantine, c.findings


def clean_lb(raw: DataFrame, subjects: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean, quarantine, findings) of lab results."""
    c = flag_lb(raw, subjects)
    return c.clean, c.quarantine, c.findings


def _raw_key() -> Column:
    """USUBJID of a raw row."""
    return usubjid(F.coalesce(F.col("SUBJID"), F.lit("")))


def crowded_apart(raw: DataFrame, subjects: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For the clean rows of a raw AE/LB table: the rows of subjects of up to ``keys.CROWDED`` rows; those of larger
    subjects that are in the clean DM ``subjects``, no row of the others being clean (AE-R01, LB-R01); and their DM.

    The larger subjects are few, so their DM is broadcast and their rows need not meet in one task for the lookup.
    Counting costs a scan of one column.
    """
    many = keys.crowded(raw.select(_raw_key().alias("USUBJID")), ["USUBJID"])
    usual, _ = keys.apart(raw, _raw_key(), many)
    _, known = keys.apart(subjects, F.col("USUBJID"), many)
    _, large = keys.apart(raw, _raw_key(), known.select("USUBJID"))
    return usual, large, F.broadcast(known)


def orphans(raw: DataFrame, subjects: DataFrame) -> DataFrame:
    """Raw AE/LB rows whose subject is not in the clean DM (anti join on the subject key)."""
    keyed = raw.withColumn("USUBJID", _raw_key())
    return keyed.join(_known_subjects(subjects).select("USUBJID"), "USUBJID", "left_anti")
