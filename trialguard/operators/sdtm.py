"""SDTM domains DM, AE and LB from clean raw tables.

Numbering uses the grains of ``keys``. For labs one aggregate by grain carries
the row count and the first row that can be a baseline; windows over that
aggregate give sequence offsets and the baseline of each (subject, test), and
one join brings both back to the rows, together with the baseline's value and
indicator that ADLB needs (``lab_rows``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialguard import schemas
from trialguard.functions import (
    flag,
    iso_date,
    iso_text,
    range_indicator,
    study_day,
    usubjid,
)
from trialguard.operators import keys
from trialguard.terminology import STUDYID


def _ensure_usubjid(df: DataFrame) -> DataFrame:
    return df if "USUBJID" in df.columns else df.withColumn("USUBJID", usubjid("SUBJID"))


#: The domains that are built here.
DOMAINS = ("DM", "AE", "LB")


def conform(df: DataFrame, name: str) -> DataFrame:
    """Project to the dataset's fixed variable list and types."""
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in schemas.SPECS[name]])


def build_dm(dm_clean: DataFrame) -> DataFrame:
    """B1: SDTM DM, one row per clean subject."""
    dm = _ensure_usubjid(dm_clean)
    out = dm.select(
        F.lit(STUDYID).alias("STUDYID"),
        F.lit("DM").alias("DOMAIN"),
        "USUBJID",
        "SUBJID",
        iso_text("TRTSDT").alias("RFSTDTC"),
        iso_text("TRTEDT").alias("RFENDTC"),
        "SITEID",
        F.col("AGE").cast("int").alias("AGE"),
        F.lit("YEARS").alias("AGEU"),
        "SEX",
        "RACE",
        F.when(F.col("ETHNIC") == "", F.lit("NOT REPORTED")).otherwise(F.col("ETHNIC")).alias("ETHNIC"),
        "ARMCD",
        "ARM",
        F.col("ARMCD").alias("ACTARMCD"),
        F.col("ARM").alias("ACTARM"),
        "COUNTRY",
        flag(F.col("DTHDT").isNotNull()).alias("DTHFL"),
        iso_text("DTHDT").alias("DTHDTC"),
    )
    return conform(out, "DM")


def reference_dates(dm_sdtm: DataFrame) -> DataFrame:
    """USUBJID -> reference start date (one row per subject)."""
    return dm_sdtm.select("USUBJID", iso_date("RFSTDTC").alias("_RFSTDT"))


def _with_reference(df: DataFrame, dm_sdtm: DataFrame) -> DataFrame:
    """Rows with their subject's reference date: brought along by cleaning, else looked up in DM."""
    df = _ensure_usubjid(df)
    return df if "_RFSTDT" in df.columns else df.join(reference_dates(dm_sdtm), "USUBJID", "left")


def build_ae(ae_clean: DataFrame, dm_sdtm: DataFrame, stored: bool = False) -> DataFrame:
    """B2: SDTM AE with AESEQ (per subject by start date, term, input order) and study days.

    ``stored`` rows are counted by subject first, which costs a scan of one column.
    """
    ae = _with_reference(ae_clean, dm_sdtm)
    many = keys.crowded(_ensure_usubjid(ae_clean), ["USUBJID"]) if stored else None
    ae = keys.sequence(ae, ["USUBJID"], ["AESTDT", "AEDECOD"], "AESEQ", many)
    out = ae.select(
        F.lit(STUDYID).alias("STUDYID"),
        F.lit("AE").alias("DOMAIN"),
        "USUBJID",
        "AESEQ",
        "AETERM",
        "AEDECOD",
        "AEBODSYS",
        "AESEV",
        "AESER",
        "AEREL",
        "AEACN",
        "AEOUT",
        "AETOXGR",
        iso_text("AESTDT").alias("AESTDTC"),
        iso_text("AEENDT").alias("AEENDTC"),
        study_day("AESTDT", "_RFSTDT").alias("AESTDY"),
        study_day("AEENDT", "_RFSTDT").alias("AEENDY"),
    )
    return conform(out, "AE")


#: What LBSEQ goes by, before input order.
LAB_ORDER = ["LBTESTCD", "LBDT", "VISITNUM"]
#: Value and indicator of the baseline row, beside the variables of the domain.
BASE_VALUE, BASE_INDICATOR = "_BASE", "_BNRIND"
#: What ADLB needs of a row's subject, beside the variables of the domain (see ``adam.arms_of``).
SUBJECT = "_SUBJECT"


def _eligible() -> Column:
    """Whether a row can be a baseline: a numeric result on or before the reference date."""
    return F.col("LBSTRESN").isNotNull() & F.coalesce(F.col("LBDT") <= F.col("_RFSTDT"), F.lit(False))


def _first_eligible() -> Column:
    """The row that is the baseline of a (subject, test), as an aggregate; NULL if none can be."""
    return F.min(F.when(_eligible(), F.struct((-F.unix_date("LBDT")).alias("late"), "VISITNUM", "RECNO", "LBSTRESN", "LBNRIND")))


def _with_indicator(lb_clean: DataFrame, dm_sdtm: DataFrame) -> DataFrame:
    lb = _with_reference(lb_clean, dm_sdtm)
    return lb.withColumn("LBNRIND", range_indicator("LBSTRESN", "LBORNRLO", "LBORNRHI"))


def _baseline_columns() -> dict[str, Column]:
    return {
        "LBBLFL": flag(F.coalesce(F.col("RECNO") == F.col("_baseline.RECNO"), F.lit(False))),
        BASE_VALUE: F.col("_baseline.LBSTRESN"),
        BASE_INDICATOR: F.col("_baseline.LBNRIND"),
    }


def unnumbered_lab_rows(lb_clean: DataFrame, dm_sdtm: DataFrame) -> DataFrame:
    """``lab_rows`` with a NULL LBSEQ, for what has no sequence number (ADLB).

    The baseline of each (subject, test) is one aggregate of the rows that can be one, partially done before the
    shuffle, and a lookup; no row is numbered.
    """
    lb = _with_indicator(lb_clean, dm_sdtm)
    first = F.min(F.struct((-F.unix_date("LBDT")).alias("late"), "VISITNUM", "RECNO", "LBSTRESN", "LBNRIND"))
    baselines = lb.filter(_eligible()).groupBy("USUBJID", "LBTESTCD").agg(first.alias("_baseline"))
    lb = lb.join(baselines, ["USUBJID", "LBTESTCD"], "left")
    return lb.withColumns({"LBSEQ": F.lit(None).cast("int"), **_baseline_columns()}).drop("_baseline")


def lab_rows(
    lb_clean: DataFrame, dm_sdtm: DataFrame, stored: bool = False, subjects: DataFrame | None = None
) -> DataFrame:
    """Clean labs with LBSEQ, LBNRIND, LBBLFL, the reference date, and the baseline's value and indicator.

    Baseline (W3): among rows with a numeric result on or before the reference date, the latest date per
    (subject, test); ties on that date go to the lowest visit number, then input order. ``stored`` rows are counted
    by subject and test first, which costs a scan of two columns. ``subjects`` (see ``adam.arms_of``) come along as
    ``SUBJECT``: they meet the table of grains, so that rows are not joined once more for them.
    """
    lb = _with_indicator(lb_clean, dm_sdtm)
    subject, order = ["USUBJID"], LAB_ORDER
    if stored:
        lb, grain = keys.cells_of(lb, subject, order, keys.crowded(_ensure_usubjid(lb_clean), ["USUBJID", "LBTESTCD"]))
    else:
        lb, grain = keys.grain_of(lb, subject, order)
    grains = lb.groupBy(*grain).agg(F.count(F.lit(1)).alias("_n"), _first_eligible().alias("_first"))
    grains = grains.select(
        *grain,
        keys.rows_before(subject, grain, "_n").alias("_before"),
        F.min("_first").over(Window.partitionBy("USUBJID", "LBTESTCD")).alias("_baseline"),
    )
    if subjects is not None:
        grains = grains.join(subjects.select("USUBJID", SUBJECT), "USUBJID", "left")
    # the date and visit that chose the baseline stay behind
    kept = F.struct("_baseline.RECNO", "_baseline.LBSTRESN", "_baseline.LBNRIND")
    lb = lb.join(grains.withColumn("_baseline", F.when(F.col("_baseline").isNotNull(), kept)), grain)
    number = (F.col("_before") + keys.place_in_grain(grain, order)).cast("int")
    return lb.withColumns({"LBSEQ": number, **_baseline_columns()}).drop("_before", "_baseline", *keys.added(grain))


def never_null(lb_clean: DataFrame) -> DataFrame:
    """Clean labs, which have a date and a visit, in columns that can't be NULL.

    The join with the grains then filters none of its readings of the input for that, so that all readings share the
    shuffles that lie in it.
    """
    date, visit = F.lit("1970-01-01").cast("date"), F.lit(0.0)
    return lb_clean.withColumns({"LBDT": F.coalesce("LBDT", date), "VISITNUM": F.coalesce("VISITNUM", visit)})


def whole_lab_rows(lb_clean: DataFrame, dm_sdtm: DataFrame) -> DataFrame:
    """``lab_rows`` for subjects of so few rows that all of them may lie in one task (see ``cleaning.crowded_apart``).

    They do once they have met DM, so numbers and baselines are windows over the rows as they lie, and no row is
    shuffled for them.
    """
    lb = _with_indicator(lb_clean, dm_sdtm).repartition("USUBJID")  # nothing is moved if the lookup was a shuffled join
    lb = lb.sortWithinPartitions("USUBJID", *LAB_ORDER, "RECNO")  # serves all windows
    test = ["USUBJID", "LBTESTCD"]
    before = F.rank().over(Window.partitionBy("USUBJID").orderBy("LBTESTCD")) - 1  # rows of the subject's earlier tests
    number = (before + keys.place_in_grain(test, LAB_ORDER)).cast("int")
    lb = lb.withColumn("_baseline", _first_eligible().over(Window.partitionBy(*test)))
    return lb.withColumns({"LBSEQ": number, **_baseline_columns()}).drop("_baseline")


def lab_domain(rows: DataFrame, *more: str) -> DataFrame:
    """The variables of LB from ``lab_rows``, and the columns ``more``."""
    out = rows.select(
        F.lit(STUDYID).alias("STUDYID"),
        F.lit("LB").alias("DOMAIN"),
        "USUBJID",
        "LBSEQ",
        "LBTESTCD",
        "LBTEST",
        "LBORRES",
        "LBORRESU",
        "LBORNRLO",
        "LBORNRHI",
        "LBSTRESN",
        F.col("LBORRESU").alias("LBSTRESU"),
        "LBNRIND",
        "LBBLFL",
        F.col("VISITNUM").try_cast("int").alias("VISITNUM"),
        "VISIT",
        iso_text("LBDT").alias("LBDTC"),
        study_day("LBDT", "_RFSTDT").alias("LBDY"),
        *more,
    )
    return out.select(*[F.col(n).cast(t).alias(n) for n, t in schemas.SPECS["LB"]], *more)


def build_lb(lb_clean: DataFrame, dm_sdtm: DataFrame) -> DataFrame:
    """SDTM LB with LBSEQ, study day, range indicator and baseline flag."""
    return lab_domain(lab_rows(lb_clean, dm_sdtm))


def build_lb_with_baseline(
    lb_clean: DataFrame, dm_sdtm: DataFrame, stored: bool = False, subjects: DataFrame | None = None
) -> DataFrame:
    """LB and, beside its variables, the baseline's value and indicator and, with ``subjects``, what ADLB needs of them:
    ADLB then needs no lookup of its own."""
    more = [SUBJECT] if subjects is not None else []
    return lab_domain(lab_rows(lb_clean, dm_sdtm, stored, subjects), BASE_VALUE, BASE_INDICATOR, *more)


def without_baseline(lb: DataFrame) -> DataFrame:
    """The variables of LB alone."""
    return lb.drop(BASE_VALUE, BASE_INDICATOR, SUBJECT)
