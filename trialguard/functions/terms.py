"""Terminology mapping and derivation expressions.

Each function maps Columns to a Column; none of them uses a Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from trialguard import terminology as tm
from trialguard.functions.parsing import col


def lookup(c: Column | str, mapping: Mapping, default=None) -> Column:
    """``CASE c WHEN k THEN v ... ELSE default END`` built from a small fixed mapping."""
    c = col(c)
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default)) if default is not None else out


def is_in(c: Column | str, values) -> Column:
    """Null-safe membership: NULL is never a member (pandas ``isin`` semantics)."""
    return F.coalesce(col(c).isin(*values), F.lit(False))


def sex_term(c: Column | str) -> Column:
    """SEX synonym (compared upper-case) -> CDISC code, NULL if unmappable."""
    return lookup(F.upper(col(c)), tm.SEX_SYNONYMS)


def yes_no(c: Column | str) -> Column:
    """Y/N synonym -> Y or N, NULL if unmappable (callers default to N)."""
    return lookup(F.upper(col(c)), tm.YN_SYNONYMS)


def race_upper(c: Column | str) -> Column:
    """E5 first half: upper-case, blank -> NOT REPORTED."""
    up = F.upper(col(c))
    return F.when(up == "", F.lit("NOT REPORTED")).otherwise(up)


def severity(sev: Column | str, grade: Column | str) -> Column:
    """A valid AESEV (upper-case) wins, else from grade 1/2/3-5; no grade -> NULL."""
    up = F.upper(col(sev))
    g = col(grade)
    derived = (
        F.when(g == 1, F.lit("MILD")).when(g == 2, F.lit("MODERATE")).when(g.isNotNull(), F.lit("SEVERE"))
    )
    return F.when(is_in(up, tm.AESEV_CT), up).otherwise(derived)


def blank_to(c: Column | str, other: Column | str) -> Column:
    """Blank text -> another column."""
    c = col(c)
    return F.when(c == "", col(other)).otherwise(c)


def usubjid(subjid: Column | str, studyid: str = tm.STUDYID) -> Column:
    """STUDYID-SUBJID."""
    return F.concat(F.lit(studyid + "-"), col(subjid))


def study_day(dt: Column | str, ref: Column | str) -> Column:
    """``dt - ref + 1`` on or after the reference date, ``dt - ref`` before it; no day 0."""
    delta = F.datediff(col(dt), col(ref))
    return F.when(delta >= 0, delta + 1).otherwise(delta)


def iso_text(dt: Column | str) -> Column:
    """Date -> ``YYYY-MM-DD``, missing -> ``''``."""
    return F.coalesce(col(dt).cast("string"), F.lit(""))


def range_indicator(value: Column | str, low: Column | str, high: Column | str) -> Column:
    """LOW / HIGH / NORMAL, ``''`` if the value or a limit is missing."""
    v, lo, hi = col(value), col(low), col(high)
    ind = F.when(v < lo, F.lit("LOW")).when(v > hi, F.lit("HIGH")).otherwise(F.lit("NORMAL"))
    return F.when(v.isNotNull() & lo.isNotNull() & hi.isNotNull(), ind).otherwise(F.lit(""))


def age_group(age: Column | str) -> tuple[Column, Column]:
    """(label, code) from half-open age bands; outside all bands -> ('', NULL)."""
    a = col(age)
    label = code = None
    for name, num, lo, hi in tm.AGE_GROUPS:
        cond = (a >= lo) & (a < hi)
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
        code = F.when(cond, F.lit(num)) if code is None else code.when(cond, F.lit(num))
    return label.otherwise(F.lit("")), code


def arm_number(armcd: Column | str) -> Column:
    """Planned arm code -> numeric treatment code."""
    return lookup(armcd, {a.armcd: a.trtn for a in tm.ARMS})


def duration_days(start: Column | str, end: Column | str) -> Column:
    """End - start + 1."""
    return F.datediff(col(end), col(start)) + 1


def flag(cond: Column, yes: str = "Y", no: str = "") -> Column:
    """E16 helper: a NULL-safe Y/'' (or Y/N) flag."""
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(yes)).otherwise(F.lit(no))


def treatment_emergent(start: Column | str, first_dose: Column | str, last_dose: Column | str) -> Column:
    """Y when first dose <= start <= last dose + 30 days, else ''."""
    s = col(start)
    return flag((s >= col(first_dose)) & (s <= F.date_add(col(last_dose), tm.TEAE_WINDOW_DAYS)))


def parameter_label(test: Column | str, testcd: Column | str, unit: Column | str) -> Column:
    """(LBTEST, or LBTESTCD when blank) + ' (' + unit + ')'."""
    return F.concat(blank_to(test, testcd), F.lit(" ("), col(unit), F.lit(")"))


def change(aval: Column | str, base: Column | str) -> Column:
    """AVAL - BASE."""
    return col(aval) - col(base)


def percent_change(chg: Column | str, base: Column | str) -> Column:
    """100 * CHG / BASE when BASE is non-zero."""
    b = col(base)
    return F.when(F.abs(b) > 0, F.lit(100.0) * col(chg) / b)


def ratio_to_uln(aval: Column | str, anrhi: Column | str) -> Column:
    """AVAL / ANRHI when ANRHI > 0."""
    hi = col(anrhi)
    return F.when(hi > 0, col(aval) / hi)
