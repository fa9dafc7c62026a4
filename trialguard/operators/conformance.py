"""Conformance checks on SDTM DM / AE / LB.

Structural rules (required variables, name and label lengths) look only at the
schema and run on the driver. Row rules are conditions of one scan per domain;
key rules (duplicate keys, subjects without a baseline) are aggregates of the
key columns. All become hit rows ``(key, _id, _w)`` that one ``summarize_hits``
turns into findings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialguard import schemas
from trialguard import terminology as tm
from trialguard.functions import iso_date, is_iso_text, is_in, to_number
from trialguard.operators.rules import Rule, literal_findings, summarize_hits, union_all

SPEC = {"DM": schemas.DM_VARS, "AE": schemas.AE_VARS, "LB": schemas.LB_VARS}


def structural_findings(domains: dict[str, DataFrame], labels: dict[str, str] | None = None) -> list[tuple]:
    """SD0001-SD0003 from the schemas alone; ``labels`` are the study's own, beside the standard ones."""
    rows = []
    labels = tm.LABELS | (labels or {})
    for name, df in domains.items():
        cols = df.columns
        missing = [v for v in SPEC.get(name, []) if v not in cols]
        rows.append(("SD0001", name, "ERROR", f"Required variables missing: {', '.join(missing)}", len(missing), ""))
        long_names = sorted({c for c in cols if len(c) > 8})
        rows.append(("SD0002", name, "ERROR", "Variable name longer than 8 characters", len([c for c in cols if len(c) > 8]), ", ".join(long_names[:5])))
        long_labels = sorted({c for c in cols if len(labels.get(c, "")) > 40})
        rows.append(("SD0003", name, "ERROR", "Variable label longer than 40 characters", len([c for c in cols if len(labels.get(c, "")) > 40]), ", ".join(long_labels[:5])))
    return rows


def _row_checks(name: str, df: DataFrame) -> list[tuple[Rule, Column]]:
    cols = set(df.columns)
    checks: list[tuple[Rule, Column]] = []
    for key in ("STUDYID", "DOMAIN", "USUBJID"):
        if key in cols:
            c = F.col(key)
            checks.append((Rule("SD0004", name, "ERROR", f"{key} is null", key=f"SD0004:{name}:{key}"), c.isNull() | (c.cast("string") == "")))
    for col in [c for c in df.columns if c.endswith("DTC")]:
        v = F.col(col).cast("string")
        bad = v.isNull() | ((v != "") & ~is_iso_text(v))
        checks.append((Rule("SD0007", name, "ERROR", f"{col} is not ISO 8601", key=f"SD0007:{name}:{col}"), bad))
    types = dict(df.dtypes)
    for col in [c for c in df.columns if c.endswith("DY")]:
        value = F.col(col) if types[col] in ("int", "bigint", "double", "smallint", "float") else to_number(F.col(col).cast("string"))
        checks.append((Rule("SD0008", name, "ERROR", f"{col} equals 0 (SDTM study days have no day 0)", key=f"SD0008:{name}:{col}"), value == 0))
    if name == "DM":
        if "SEX" in cols:
            checks.append((Rule("DM0002", "DM", "ERROR", "SEX not in controlled terminology"), ~is_in("SEX", tm.SEX_CT)))
        if {"DTHFL", "DTHDTC"} <= cols:
            checks.append((Rule("DM0003", "DM", "WARNING", "DTHFL is Y but DTHDTC is missing"), (F.col("DTHFL") == "Y") & (F.col("DTHDTC") == "")))
    if name == "AE":
        if "AESEV" in cols:
            checks.append((Rule("AE0001", "AE", "ERROR", "AESEV not in controlled terminology"), ~is_in("AESEV", tm.AESEV_CT)))
        if "AESER" in cols:
            checks.append((Rule("AE0002", "AE", "ERROR", "AESER not Y/N"), ~is_in("AESER", tm.NY_CT)))
        if {"AESTDTC", "AEENDTC"} <= cols:
            st, en = iso_date(F.col("AESTDTC").cast("string")), iso_date(F.col("AEENDTC").cast("string"))
            checks.append((Rule("AE0003", "AE", "ERROR", "AEENDTC before AESTDTC"), en.isNotNull() & (en < st)))
        if {"AEOUT", "AESER"} <= cols:
            ser_not_y = F.coalesce(F.col("AESER") != "Y", F.lit(True))
            checks.append((Rule("AE0004", "AE", "WARNING", "Fatal outcome but AESER is not Y"), (F.col("AEOUT") == "FATAL") & ser_not_y))
        if {"AETOXGR", "AESEV"} <= cols:
            grade = to_number(F.col("AETOXGR").cast("string"))
            checks.append((Rule("AE0005", "AE", "WARNING", "Grade >=3 reported as MILD"), (grade >= 3) & (F.col("AESEV") == "MILD")))
    if name == "LB" and "LBNRIND" in cols:
        checks.append((Rule("LB0002", "LB", "ERROR", "LBNRIND not in controlled terminology"), ~is_in("LBNRIND", tm.LBNRIND_CT)))
    return checks


def _hits(df: DataFrame, checks: list[tuple[Rule, Column]], weights: dict[int, Column] | None = None) -> DataFrame:
    """``(key, _id, _w)`` for each row and check that hits; rows without a hit leave no trace.

    ``weights`` gives a weight other than 1 for the check at an index.
    """
    weights = weights or {}
    marks = [
        F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(rule.key).alias("key"), weights.get(i, F.lit(1)).cast("long").alias("_w")))
        for i, (rule, cond) in enumerate(checks)
    ]
    found = df.select(F.col("USUBJID").cast("string").alias("_id"), F.explode(F.array(*marks)).alias("_h"))
    return found.filter(F.col("_h").isNotNull()).select("_h.key", "_id", "_h._w")


def _key_hits(
    df: DataFrame, seq: str | None, seq_rule: Rule | None, dup_rule: Rule | None, baseline_rule: Rule | None,
    orphan_rule: Rule | None, dm_keys: DataFrame | None,
) -> DataFrame:
    """Hits of the rules on keys: later copies of (subject, sequence number), later copies of a subject, subjects
    without a baseline record, and rows of subjects not in DM. The key columns are counted by (subject, sequence
    number), then by subject; only subjects are looked up in DM."""
    is_base = F.coalesce(F.col("LBBLFL") == "Y", F.lit(False)) if baseline_rule is not None else F.lit(True)
    keys = ["USUBJID", seq] if seq_rule is not None else ["USUBJID"]
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.bool_or(is_base).alias("_base"))
    subjects = per_key.groupBy("USUBJID").agg(
        F.sum("_n").alias("_n"), F.sum(F.col("_n") - 1).alias("_again"), F.bool_or("_base").alias("_base")
    )
    orphan = F.lit(True)
    if orphan_rule is not None and dm_keys is not None:
        subjects = subjects.join(dm_keys, "USUBJID", "left")
        orphan = F.col("_in_dm").isNull()
    rules = (
        (seq_rule, F.col("_again") > 0, F.col("_again")), (dup_rule, F.col("_n") > 1, F.col("_n") - 1),
        (baseline_rule, ~F.col("_base"), F.lit(1)), (orphan_rule, orphan, F.col("_n")),
    )
    rules = [r for r in rules if r[0] is not None]
    return _hits(subjects, [(rule, cond) for rule, cond, _ in rules], {i: w for i, (_, _, w) in enumerate(rules)})


def orphan_subjects(df: DataFrame, dm: DataFrame | None) -> DataFrame:
    """Rows whose USUBJID is not in DM (left anti join on the subject key)."""
    if dm is None or "USUBJID" not in dm.columns:
        return df
    return df.join(dm.select("USUBJID").distinct(), "USUBJID", "left_anti")


def subjects_without_baseline(lb: DataFrame) -> DataFrame:
    """Subjects that have lab records but none flagged as baseline."""
    return (
        lb.groupBy("USUBJID")
        .agg(F.max(F.coalesce(F.col("LBBLFL") == "Y", F.lit(False)).cast("int")).alias("_has"))
        .filter(F.col("_has") == 0)
        .select("USUBJID")
    )


def check_sdtm(
    spark: SparkSession, domains: dict[str, DataFrame | None], labels: dict[str, str] | None = None
) -> DataFrame:
    """All conformance findings for the given SDTM domains (``{"DM": ..., "AE": ..., "LB": ...}``).

    Row checks are conditions of one scan per domain, and only rows that hit
    are counted. Duplicate keys, missing baselines and subjects not in DM are
    taken from partially aggregated counts of the key columns.
    """
    domains = {k: v for k, v in domains.items() if v is not None}
    dm = domains.get("DM")
    dm_keys = dm.select("USUBJID").distinct().withColumn("_in_dm", F.lit(True)) if dm is not None and "USUBJID" in dm.columns else None
    rules: list[Rule] = []
    hits: list[DataFrame] = []
    for name, df in domains.items():
        checks = _row_checks(name, df)
        cols = set(df.columns)
        has_id = "USUBJID" in cols
        orphan_rule = Rule("SD0005", name, "ERROR", "USUBJID not found in DM", key=f"SD0005:{name}") if has_id and name != "DM" else None
        seq = f"{name}SEQ"
        seq_rule = Rule("SD0006", name, "ERROR", f"{seq} not unique within subject", key=f"SD0006:{name}") if has_id and seq in cols else None
        dup_rule = Rule("DM0001", "DM", "ERROR", "USUBJID not unique in DM") if name == "DM" and has_id else None
        baseline_rule = Rule("LB0001", "LB", "WARNING", "Subject has no baseline lab record") if name == "LB" and has_id and "LBBLFL" in cols else None
        extra = [r for r in (seq_rule, dup_rule, baseline_rule, orphan_rule) if r is not None]
        if not checks and not extra:
            continue
        rules.extend(r for r, _ in checks)
        rules.extend(extra)
        if not has_id:
            df = df.withColumn("USUBJID", F.lit(None).cast("string"))
        hits.append(_hits(df, checks))
        if extra:
            hits.append(_key_hits(df, seq, seq_rule, dup_rule, baseline_rule, orphan_rule, dm_keys))
    parts = [literal_findings(spark, structural_findings(domains, labels))]
    if hits:
        parts.append(summarize_hits(union_all(hits), rules))
    return union_all(parts)
