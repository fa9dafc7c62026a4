"""Analytical views behind the dashboard.

Each view is a DataFrame over the safety tables or ADaM datasets; the UI
itself (widgets, charts, server) is not part of this library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialguard import terminology as tm
from trialguard.operators import tables as T

ANY_TERM_IN_SOC = "— any term in SOC —"


def dashboard_kpis(adsl: DataFrame, overview: DataFrame, hys: DataFrame) -> DataFrame:
    """V1: one row of headline numbers (safety N, any-TEAE %, serious, grade >= 3, deaths, Hy's law).

    Built as a union of one-value rows and a single global aggregate, so no
    join (and no cross join) of one-row tables is needed.
    """
    total = f"_n_{T.TOTAL}"
    cat = F.col("Category")
    parts = [
        adsl.agg(F.count(F.when(F.col("SAFFL") == "Y", 1)).cast("long").alias("v")).select(F.lit("saf").alias("k"), "v"),
        overview.select(
            F.when(cat == "Any TEAE", "any").when(cat == "Any serious TEAE", "ser")
            .when(cat == "Any grade >=3 TEAE", "g3").when(cat == "TEAE leading to death", "death").alias("k"),
            F.col(f"`{total}`").cast("long").alias("v"),
        ).filter(F.col("k").isNotNull()),
        hys.agg(F.count(F.when(F.col("`Potential Hy's law`"), 1)).cast("long").alias("v")).select(F.lit("hys").alias("k"), "v"),
    ]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    val = lambda k: F.coalesce(F.max(F.when(F.col("k") == k, F.col("v"))), F.lit(0)).cast("long")
    agg = u.agg(*[val(k).alias(k) for k in ("saf", "any", "ser", "g3", "death", "hys")])
    return agg.select(
        F.col("saf").alias("safety_population"),
        F.when(F.col("saf") > 0, F.lit(100.0) * F.col("any") / F.col("saf")).alias("any_teae_pct"),
        F.col("ser").alias("serious_teae"),
        F.col("g3").alias("grade3_teae"),
        F.col("death").alias("deaths"),
        F.col("hys").alias("potential_hys_law"),
    )


def pt_incidence_top(adae: DataFrame, arms: T.Arms, top_n: int = 12) -> DataFrame:
    """V2 + W9: subjects and percent per (PT, arm) for the ``top_n`` PTs by total subjects.

    Treatment-emergent rows only (no safety filter), percent of the arm's
    safety N; ties in the ranking go to the alphabetically first term.
    """
    counts = (
        T.teae(adae, safety_only=False)
        .select(F.col("PT").alias("AEDECOD"), "TRTA", "USUBJID")
        .distinct()
        .groupBy("AEDECOD", "TRTA")
        .agg(F.count(F.lit(1)).alias("Subjects"))
    )
    denom = None
    for a in arms.names:
        denom = F.when(F.col("TRTA") == a, F.lit(arms.n[a])) if denom is None else denom.when(F.col("TRTA") == a, F.lit(arms.n[a]))
    pct = F.lit(100.0) * F.col("Subjects") / denom if denom is not None else F.lit(None).cast("double")
    counts = counts.withColumn("Percent", F.when(denom > 0, pct) if denom is not None else pct)
    top = (
        counts.groupBy("AEDECOD").agg(F.sum("Subjects").alias("_tot"))
        .orderBy(F.col("_tot").desc(), "AEDECOD")
        .limit(top_n)
        .select("AEDECOD")
    )
    return counts.join(top, "AEDECOD", "left_semi").select("AEDECOD", "TRTA", "Subjects", "Percent")


def forest_rows(risk: DataFrame, arm: str, min_subjects: int = 3) -> DataFrame:
    """V3: one active arm's risk differences with at least ``min_subjects`` subjects in both arms, Diff desc."""
    return risk.filter((F.col("Arm") == arm) & ((F.col("n_active") + F.col("n_control")) >= min_subjects)).orderBy(
        F.col("Diff").desc_nulls_last(), "SOC", "PT"
    )


def default_forest_arm(arms: T.Arms, control: str = tm.CONTROL_ARM) -> str | None:
    """The dashboard's default active arm: the last of the active arm names in sorted order."""
    actives = sorted(a for a in arms.names if a != control)
    return actives[-1] if actives else None


def soc_pt_search(soc_pt: DataFrame, query: str) -> DataFrame:
    """V4: SOC/PT rows whose SOC or PT matches ``query`` (case-insensitive regex); blank PT shown as a label."""
    pattern = "(?iu)" + query
    hit = F.coalesce(F.col("SOC").rlike(pattern), F.lit(False)) | F.coalesce(F.col("PT").rlike(pattern), F.lit(False))
    visible = [c for c in soc_pt.columns if not c.startswith("_")]
    out = soc_pt.filter(hit) if query else soc_pt
    return out.select(*[F.when(F.col("PT") == "", F.lit(ANY_TERM_IN_SOC)).otherwise(F.col("PT")).alias("PT") if c == "PT" else F.col(f"`{c}`") for c in visible])


def edish_points(hys: DataFrame) -> DataFrame:
    """V5: eDISH points, subjects with both peaks present (flag column tells the potential Hy's law cases)."""
    return hys.filter(F.col("`Peak ALT/AST xULN`").isNotNull() & F.col("`Peak bilirubin xULN`").isNotNull())


def mean_change_band(change: DataFrame, param: str | None = None) -> DataFrame:
    """V6: mean change with a 95% band of +-1.96 SE (the dashboard uses 1.96, not the exact z)."""
    df = change if param is None else change.filter(F.col("PARAM") == param)
    se = F.col("SE")
    return df.withColumns(
        {"lo": F.col("`Mean CHG`") - F.lit(tm.DASHBOARD_Z) * se, "hi": F.col("`Mean CHG`") + F.lit(tm.DASHBOARD_Z) * se}
    )


def lab_shift_wide(shift: DataFrame, paramcd: str | None = None) -> DataFrame:
    """V7: shift table wide: (parameter, arm, baseline indicator) x worst indicator, missing cells 0."""
    df = shift if paramcd is None else shift.filter(F.col("PARAMCD") == paramcd)
    w = F.col("`Worst post-baseline`")
    return df.groupBy("PARAMCD", "TRTA", "BNRIND").agg(
        *[F.coalesce(F.sum(F.when(w == lvl, F.col("Subjects"))), F.lit(0)).cast("long").alias(lvl) for lvl in ("HIGH", "LOW", "NORMAL")]
    )


def dataset_preview(df: DataFrame, keys: list[str], n: int = 500) -> DataFrame:
    """V8 + W10: the first ``n`` rows of a dataset in key order (the preview limit is the feature)."""
    return df.orderBy(*keys).limit(n)
