"""ADaM datasets ADSL, ADAE and ADLB.

The subject lookups (J4, J5) are plain equi-joins on USUBJID; the planner and
AQE choose broadcast or shuffle from the runtime size of the subject table.
The N:1 uniqueness the lookups rely on is asserted lazily: the subject table is
filtered through ``raise_error`` when a key repeats, so a broken input fails at
the first action instead of silently multiplying rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialguard.functions import (
    age_group,
    arm_number,
    change,
    duration_days,
    flag,
    iso_date,
    parameter_label,
    percent_change,
    ratio_to_uln,
    study_day,
    treatment_emergent,
    usubjid,
)
from trialguard.operators.keys import group_first_value
from trialguard.operators.sdtm import BASE_INDICATOR, BASE_VALUE, SUBJECT, conform
from trialguard.terminology import STUDYID


def unique_on(df: DataFrame, key: str, what: str) -> DataFrame:
    """Pass ``df`` through unchanged, failing at run time if ``key`` is not unique."""
    others = [c for c in df.columns if c != key]
    rows = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), *[F.first(c).alias(c) for c in others])
    return rows.filter(_once(F.col("_rows"), key, what)).select(*df.columns)


def _once(rows: Column, key: str, what: str) -> Column:
    """True; fails at run time where a key has several rows."""
    msg = F.concat(F.lit(f"{what}: {key} not unique: "), F.col(key).cast("string"))
    return F.when(rows > 1, F.raise_error(msg).cast("boolean")).otherwise(F.lit(True))


def arms_of(adsl: DataFrame) -> DataFrame:
    """What ADLB needs of each subject, and its number of rows in ADSL, for ``sdtm.build_lb_with_baseline``.

    A repeated subject fails in ``build_adlb``, which reads it, and not in LB.
    """
    arms = F.struct(
        F.count(F.lit(1)).alias("rows"), F.first("TRT01A").alias("TRTA"), F.first("TRT01AN").alias("TRTAN"),
        F.first("SAFFL").alias("SAFFL"),
    )
    return adsl.groupBy("USUBJID").agg(arms.alias(SUBJECT))


def build_adsl(dm_clean: DataFrame) -> DataFrame:
    """Subject-level analysis dataset.

    The clean DM row already holds every SDTM DM value and DCSREAS, so the
    SUBJID lookup of the discontinuation reason (J3) is a same-row projection.
    """
    dm = dm_clean if "USUBJID" in dm_clean.columns else dm_clean.withColumn("USUBJID", usubjid("SUBJID"))
    label, code = age_group("AGE")
    reason = F.coalesce(F.col("DCSREAS"), F.lit(""))
    out = dm.select(
        F.lit(STUDYID).alias("STUDYID"),
        "USUBJID",
        "SUBJID",
        "SITEID",
        "COUNTRY",
        F.col("AGE").cast("int").alias("AGE"),
        F.lit("YEARS").alias("AGEU"),
        label.alias("AGEGR1"),
        code.alias("AGEGR1N"),
        "SEX",
        "RACE",
        F.when(F.col("ETHNIC") == "", F.lit("NOT REPORTED")).otherwise(F.col("ETHNIC")).alias("ETHNIC"),
        "ARMCD",
        "ARM",
        F.col("ARM").alias("TRT01P"),
        arm_number("ARMCD").alias("TRT01PN"),
        F.col("ARM").alias("TRT01A"),
        arm_number("ARMCD").alias("TRT01AN"),
        "TRTSDT",
        "TRTEDT",
        duration_days("TRTSDT", "TRTEDT").alias("TRTDURD"),
        flag(F.col("TRTSDT").isNotNull(), "Y", "N").alias("SAFFL"),
        flag(F.col("ARMCD") != "", "Y", "N").alias("ITTFL"),
        F.when(reason == "", F.lit("COMPLETED")).otherwise(F.lit("DISCONTINUED")).alias("EOSSTT"),
        reason.alias("DCSREAS"),
        flag(F.col("DTHDT").isNotNull()).alias("DTHFL"),
    )
    return conform(out, "ADSL")


def build_adae(ae_sdtm: DataFrame, adsl: DataFrame) -> DataFrame:
    """ADAE with TRTEMFL (30-day window) and first-occurrence flags."""
    keys = unique_on(
        adsl.select(
            "USUBJID", "SITEID", "AGE", "SEX", "RACE",
            F.col("TRT01A").alias("TRTA"), F.col("TRT01AN").alias("TRTAN"), "SAFFL", "TRTSDT", "TRTEDT",
        ),
        "USUBJID",
        "ADSL",
    )
    ae = ae_sdtm.join(keys, "USUBJID", "inner")
    ae = ae.withColumns({"ASTDT": iso_date("AESTDTC"), "AENDT": iso_date("AEENDTC")})
    ae = ae.withColumn("TRTEMFL", treatment_emergent("ASTDT", "TRTSDT", "TRTEDT"))
    ae = ae.join(_first_occurrences(ae), ["USUBJID", "AEBODSYS", "AEDECOD"], "left")
    first = (F.col("TRTEMFL") == "Y") & (F.col("AESEQ") == F.col("_first.AESEQ"))

    out = ae.select(
        F.lit(STUDYID).alias("STUDYID"),
        "USUBJID", "SITEID", "AGE", "SEX", "RACE", "TRTA", "TRTAN", "SAFFL", "TRTSDT", "TRTEDT",
        "AESEQ", "AETERM", "AEDECOD", "AEBODSYS", "AESEV", "AESER", "AEREL", "AEACN", "AEOUT", "AETOXGR",
        F.col("AETOXGR").alias("ATOXGR"),
        "ASTDT",
        "AENDT",
        study_day("ASTDT", "TRTSDT").alias("ASTDY"),
        "TRTEMFL",
        flag(first & F.col("_of_subject")).alias("AOCCFL"),
        flag(first & F.col("_of_soc")).alias("AOCCSFL"),
        flag(first & F.col("_of_pt")).alias("AOCCPFL"),
    )
    return conform(out, "ADAE")


def _first_occurrences(ae: DataFrame) -> DataFrame:
    """The first TEAE row (by ASTDT, AESEQ) of each (subject, SOC, PT), and whether it is also the first of
    its subject, of its (subject, SOC) and of its (subject, PT).

    One aggregate, partially done before the shuffle; the wider groupings are windows over its rows, which are a
    subject's different terms and not its events.
    """
    first = F.min(F.struct("ASTDT", "AESEQ")).alias("_first")
    terms = ae.filter(F.col("TRTEMFL") == "Y").groupBy("USUBJID", "AEBODSYS", "AEDECOD").agg(first)

    def is_first(*of: str):
        return F.col("_first") == F.min("_first").over(Window.partitionBy("USUBJID", *of))

    return terms.select(
        "USUBJID", "AEBODSYS", "AEDECOD", "_first", is_first().alias("_of_subject"),
        is_first("AEBODSYS").alias("_of_soc"), is_first("AEDECOD").alias("_of_pt"),
    )


def build_adlb(lb_sdtm: DataFrame, adsl: DataFrame) -> DataFrame:
    """ADLB with baseline value and indicator (J6), change, percent change and ratio to ULN.

    Labs that were built with ``arms_of`` the same ADSL hold what it has of their subjects.
    """
    if SUBJECT in lb_sdtm.columns:
        of = F.col(SUBJECT)
        lb = lb_sdtm.filter(of.isNotNull() & _once(of["rows"], "USUBJID", "ADSL"))
        lb = lb.withColumns({c: of[c] for c in ("TRTA", "TRTAN", "SAFFL")})
    else:
        keys = unique_on(
            adsl.select("USUBJID", F.col("TRT01A").alias("TRTA"), F.col("TRT01AN").alias("TRTAN"), "SAFFL"),
            "USUBJID",
            "ADSL",
        )
        lb = lb_sdtm.join(keys, "USUBJID", "inner")
    # Value and indicator of the baseline row of (subject, parameter); already there when the labs were built in
    # the same plan, else a partially aggregated lookup of the flagged row, joined back.
    if BASE_VALUE in lb.columns:
        lb = lb.withColumn("_base", F.struct(F.col(BASE_VALUE).alias("LBSTRESN"), F.col(BASE_INDICATOR).alias("LBNRIND")))
    else:
        lb = group_first_value(
            lb, ["USUBJID", "LBTESTCD"], [F.col("LBSEQ")],
            {"_base": F.struct(F.col("LBSTRESN"), F.col("LBNRIND"))}, where=F.col("LBBLFL") == "Y",
        )
    out = lb.select(
        F.lit(STUDYID).alias("STUDYID"),
        "USUBJID", "TRTA", "TRTAN", "SAFFL",
        F.col("LBTESTCD").alias("PARAMCD"),
        parameter_label("LBTEST", "LBTESTCD", "LBSTRESU").alias("PARAM"),
        F.col("VISIT").alias("AVISIT"),
        F.col("VISITNUM").alias("AVISITN"),
        iso_date("LBDTC").alias("ADT"),
        F.col("LBDY").alias("ADY"),
        F.col("LBSTRESN").alias("AVAL"),
        F.col("_base.LBSTRESN").alias("BASE"),
        change("LBSTRESN", "_base.LBSTRESN").alias("CHG"),
        percent_change(change("LBSTRESN", "_base.LBSTRESN"), "_base.LBSTRESN").alias("PCHG"),
        F.col("LBORNRLO").alias("ANRLO"),
        F.col("LBORNRHI").alias("ANRHI"),
        F.col("LBNRIND").alias("ANRIND"),
        F.coalesce(F.col("_base.LBNRIND"), F.lit("")).alias("BNRIND"),
        F.col("LBBLFL").alias("ABLFL"),
        ratio_to_uln("LBSTRESN", "LBORNRHI").alias("R2ANRHI"),
    )
    return conform(out, "ADLB")
