"""Safety summary tables.

All adverse-event counts are subjects, not events. Subject counts are taken by
de-duplicating to the grain being counted (partially aggregated before the
shuffle, so a subject with very many rows collapses map-side) and then counting.

Per-arm columns need the arm list and the safety N per arm. Both come from one
tiny aggregate of ADSL (one row per arm, ``arm_summary``). Tables then count
per arm with conditional sums over that explicit list (what ``pivot`` with
given values compiles to), named ``k0..kN`` internally and renamed at the end.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialguard import terminology as tm
from trialguard.functions import fixed, n_pct, newcombe_diff, wilson

TOTAL = "Total"


@dataclass(frozen=True)
class Arms:
    """Arms in display order with their safety N; ``n[TOTAL]`` is the safety population."""

    names: tuple[str, ...]
    codes: tuple[int | None, ...]
    n: dict[str, int]

    @property
    def columns(self) -> list[str]:
        return [*self.names, TOTAL]


def arm_summary(adsl: DataFrame) -> Arms:
    """W7 + T0 in one small job: arms ordered by code (the first subject's code per arm text) and safety N."""
    saf = F.col("SAFFL") == "Y"
    rows = (
        adsl.groupBy("TRT01A")
        .agg(
            F.min_by("TRT01AN", "USUBJID").alias("code"),
            F.count(F.when(saf, F.lit(1))).alias("n"),  # one row per subject
        )
        .collect()  # a row per arm text; each becomes a column of the tables
    )
    rows = sorted(rows, key=lambda r: (r["code"] is None, r["code"] if r["code"] is not None else 0, r["TRT01A"]))
    n = {r["TRT01A"]: int(r["n"]) for r in rows}
    n[TOTAL] = sum(n.values())
    return Arms(tuple(r["TRT01A"] for r in rows), tuple(r["code"] for r in rows), n)


def arm_order(adsl: DataFrame) -> DataFrame:
    """W7 as a DataFrame: (TRT01A, TRT01AN) in code order."""
    return adsl.groupBy("TRT01A").agg(F.min_by("TRT01AN", "USUBJID").alias("TRT01AN")).orderBy("TRT01AN", "TRT01A")


def safety_n(adsl: DataFrame) -> DataFrame:
    """Subjects in the safety population per arm plus Total (arms without safety subjects -> 0)."""
    saf = F.col("SAFFL") == "Y"
    per_arm = adsl.groupBy("TRT01A").agg(F.count(F.when(saf, F.lit(1))).alias("N"))  # one row per subject
    total = adsl.filter(saf).agg(F.count(F.lit(1)).alias("N")).select(F.lit(TOTAL).alias("TRT01A"), "N")
    out = per_arm.unionByName(total).select(F.col("TRT01A").alias("Arm"), "N")
    return out.orderBy(F.col("Arm") == TOTAL, "Arm")


def _event_flags() -> list[Column]:
    """Conditions on an event: the overview's categories in display order, then the safety population."""
    return [
        F.lit(True),
        F.col("AESER") == "Y",
        F.col("ATOXGR") >= 3,
        F.col("AEREL").isin(*tm.RELATED_TERMS),
        F.col("AEACN") == "DRUG WITHDRAWN",
        F.col("AEOUT") == "FATAL",
        F.col("SAFFL") == "Y",
    ]


#: The conditions that a subject's events of one term meet, as bits in the order of ``_event_flags``.
EVENT_BITS = "_bits"
SAFETY_BIT = 6


def event_profile(adae: DataFrame) -> DataFrame:
    """Treatment-emergent events as ``TRTA, USUBJID, SOC, PT`` and the set of conditions that any of them meets.

    One aggregate of ADAE, partially done before the shuffle, from which every event table is read. A profile is
    passed on as it is.
    """
    if EVENT_BITS in adae.columns:
        return adae
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(_event_flags())), F.lit(0))
    return (
        adae.filter(F.col("TRTEMFL") == "Y")
        .groupBy("TRTA", "USUBJID", F.col("AEBODSYS").alias("SOC"), F.col("AEDECOD").alias("PT"))
        .agg(F.bit_or(bits).alias(EVENT_BITS))
    )


def _has(bit: int) -> Column:
    return F.col(EVENT_BITS).bitwiseAND(1 << bit) > 0


def teae(adae: DataFrame, safety_only: bool = True) -> DataFrame:
    """The profile of treatment-emergent events (of the safety population unless ``safety_only`` is False)."""
    profile = event_profile(adae)
    return profile.filter(_has(SAFETY_BIT)) if safety_only else profile


def per_arm_counts(arms: Arms, arm_col: str = "TRTA") -> list[Column]:
    """Conditional counts ``k0..kN`` (one per arm) for use inside ``agg``."""
    return [F.count(F.when(F.col(arm_col) == a, F.lit(1))).alias(f"k{j}") for j, a in enumerate(arms.names)]


def _k(arms: Arms) -> Callable[[str], Column]:
    return lambda a: F.coalesce(F.col(f"k{arms.names.index(a)}"), F.lit(0)).cast("long")


def _total(arms: Arms, k: Callable[[str], Column]) -> Column:
    return sum((k(a) for a in arms.names), F.lit(0)).cast("long")


def _display(arms: Arms, k: Callable[[str], Column]) -> list[Column]:
    """``n (x.x%)`` per arm and Total (a subject belongs to one arm, so Total is the sum)."""
    cells = [n_pct(k(a), F.lit(arms.n[a])).alias(a) for a in arms.names]
    cells.append(n_pct(_total(arms, k), F.lit(arms.n[TOTAL])).alias(TOTAL))
    return cells


# ---------------------------------------------------------------------------
# T2 demographics
# ---------------------------------------------------------------------------


def demographics(adsl: DataFrame, arms: Arms | None = None) -> DataFrame:
    """N, age mean (SD), age median (min-max), then n (%) per age group, sex and race level.

    Columns: Characteristic, one per arm, Total. Level rows: age groups by code,
    sex and race by descending total count.
    """
    arms = arms or arm_summary(adsl)
    saf = adsl.filter(F.col("SAFFL") == "Y")
    stats = saf.rollup("TRT01A").agg(
        F.grouping("TRT01A").alias("_g"),
        F.count(F.lit(1)).alias("n"),  # one row per subject
        F.avg("AGE").alias("mean"),
        F.stddev_samp("AGE").alias("sd"),
        F.median("AGE").alias("median"),
        F.min("AGE").alias("min"),
        F.max("AGE").alias("max"),
    )
    mean_sd = F.concat(fixed("mean", 1), F.lit(" ("), fixed("sd", 1), F.lit(")"))
    median_rng = F.concat(
        fixed("median", 0), F.lit(" ("), F.coalesce(F.col("min").cast("string"), F.lit("nan")), F.lit("-"),
        F.coalesce(F.col("max").cast("string"), F.lit("nan")), F.lit(")"),
    )
    col_of = lambda c: F.when(F.col("_g") == 1, F.lit(TOTAL)).otherwise(F.col("TRT01A")) == c
    head = stats.agg(
        *[F.max(F.when(col_of(c), F.col("n").cast("string"))).alias(f"n_{i}") for i, c in enumerate(arms.columns)],
        *[F.max(F.when(col_of(c), mean_sd)).alias(f"m_{i}") for i, c in enumerate(arms.columns)],
        *[F.max(F.when(col_of(c), median_rng)).alias(f"d_{i}") for i, c in enumerate(arms.columns)],
    )
    head_rows = head.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(o).alias("_ord"),
                        F.lit(label).alias("Characteristic"),
                        F.lit(0).cast("long").alias("_sub"),
                        *[F.coalesce(F.col(f"{p}_{i}"), F.lit(empty)).alias(c) for i, c in enumerate(arms.columns)],
                    )
                    for o, label, p, empty in (
                        (0, "N", "n", "0"),
                        (1, "Age, mean (SD)", "m", "nan (nan)"),
                        (2, "Age, median (min-max)", "d", "nan (nan-nan)"),
                    )
                ]
            )
        ).alias("r")
    ).select("r.*")

    levels = saf.select(
        "TRT01A",
        F.explode(
            F.array(
                F.struct(F.lit(3).alias("_ord"), F.lit("Age group").alias("var"), F.col("AGEGR1").alias("level"), F.col("AGEGR1N").cast("long").alias("code")),
                F.struct(F.lit(4).alias("_ord"), F.lit("Sex").alias("var"), F.col("SEX").alias("level"), F.lit(None).cast("long").alias("code")),
                F.struct(F.lit(5).alias("_ord"), F.lit("Race").alias("var"), F.col("RACE").alias("level"), F.lit(None).cast("long").alias("code")),
            )
        ).alias("x"),
    ).select("TRT01A", "x.*")
    counts = levels.groupBy("_ord", "var", "level").agg(F.min("code").alias("code"), *per_arm_counts(arms, "TRT01A"))
    k = _k(arms)
    level_rows = counts.select(
        "_ord",
        F.concat(F.col("var"), F.lit(": "), F.col("level")).alias("Characteristic"),
        F.when(F.col("_ord") == 3, F.col("code")).otherwise(-_total(arms, k)).alias("_sub"),
        *_display(arms, k),
    )
    return head_rows.unionByName(level_rows).orderBy("_ord", "_sub", "Characteristic").drop("_ord", "_sub")


# ---------------------------------------------------------------------------
# T3 TEAE overview
# ---------------------------------------------------------------------------

# FIXED VALUES: overview categories in display order.
OVERVIEW_CATEGORIES = (
    "Any TEAE",
    "Any serious TEAE",
    "Any grade >=3 TEAE",
    "Any treatment-related TEAE",
    "TEAE leading to treatment discontinuation",
    "TEAE leading to death",
)


def teae_overview(adsl: DataFrame, adae: DataFrame, arms: Arms | None = None) -> DataFrame:
    """Six category rows; n (%) per arm and Total plus numeric ``_n_<arm>`` columns.

    Conditions are united by subject, then one global aggregate counts subjects
    per (category, arm). A global aggregate always yields a row, so an empty
    ADAE still gives six rows of zeros.
    """
    arms = arms or arm_summary(adsl)
    per_subject = teae(adae).groupBy("TRTA", "USUBJID").agg(F.bit_or(EVENT_BITS).alias(EVENT_BITS))
    sums = [
        F.count(F.when((F.col("TRTA") == a) & _has(i), F.lit(1))).alias(f"n{i}_{j}")
        for i in range(len(OVERVIEW_CATEGORIES))
        for j, a in enumerate(arms.names)
    ] or [F.count(F.lit(1)).alias("_rows")]
    agg = per_subject.agg(*sums)
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("_ord"),
                    F.lit(label).alias("Category"),
                    *[F.col(f"n{i}_{j}").alias(f"k{j}") for j in range(len(arms.names))],
                )
                for i, label in enumerate(OVERVIEW_CATEGORIES)
            ]
        )
    )
    long = agg.select(rows.alias("r")).select("r.*")
    k = _k(arms)
    return long.select(
        "_ord",
        "Category",
        *_display(arms, k),
        *[k(a).alias(f"_n_{a}") for a in arms.names],
        _total(arms, k).alias(f"_n_{TOTAL}"),
    ).orderBy("_ord").drop("_ord")


# ---------------------------------------------------------------------------
# T4 SOC / PT incidence
# ---------------------------------------------------------------------------


def subjects_by_arm(df: DataFrame, keys: list[str], arms: Arms) -> DataFrame:
    """Distinct subjects per ``keys`` and arm, as columns ``k0..kN`` (dedupe, then count)."""
    grain = df.select(*keys, "TRTA", "USUBJID").distinct()
    return grain.groupBy(*keys).agg(*(per_arm_counts(arms) or [F.count(F.lit(1)).alias("_rows")]))


def teae_soc_pt(adsl: DataFrame, adae: DataFrame, arms: Arms | None = None) -> DataFrame:
    """T4: one row per SOC (PT = '') and per (SOC, PT), ordered by SOC total, SOC, SOC row first, PT total.

    The profile has a subject once per PT; the SOC grain is expanded from it and de-duplicated, so a subject counts once per SOC however many PTs it has there. Columns: SOC, PT, arms, Total, _total.
    """
    arms = arms or arm_summary(adsl)
    t = teae(adae).select(
        "TRTA",
        "USUBJID",
        "SOC",
        F.explode(
            F.array(
                F.struct(F.lit(True).alias("_is_soc"), F.lit("").alias("PT")),
                F.struct(F.lit(False).alias("_is_soc"), F.col("PT")),
            )
        ).alias("g"),
    ).select("TRTA", "USUBJID", "SOC", "g._is_soc", "g.PT")
    wide = subjects_by_arm(t, ["SOC", "PT", "_is_soc"], arms)
    k = _k(arms)
    out = wide.select("SOC", "PT", "_is_soc", *_display(arms, k), _total(arms, k).alias("_total"))
    out = out.withColumn("_soc_total", F.max(F.when(F.col("_is_soc"), F.col("_total"))).over(Window.partitionBy("SOC")))
    return out.orderBy(F.col("_soc_total").desc(), "SOC", F.col("_is_soc").desc(), F.col("_total").desc(), "PT").drop(
        "_is_soc", "_soc_total"
    )


# ---------------------------------------------------------------------------
# T5 risk differences, E20 on data
# ---------------------------------------------------------------------------

# Spark resolves names without case, so inside a plan the arm denominators can't be called N_active and N_control
# beside n_active and n_control; ``PUBLISHED_NAMES`` gives them these names where the table is written.
PUBLISHED_NAMES = {"N_active_arm": "N_active", "N_control_arm": "N_control"}
RISK_TYPES = {
    "PT": "string", "SOC": "string", "Arm": "string", "n_active": "long", "N_active_arm": "long",
    "n_control": "long", "N_control_arm": "long", "Pct_active": "double", "Pct_control": "double",
    "Diff": "double", "Lower": "double", "Upper": "double",
}


def _pct(x: str, n: str) -> Column:
    return F.when(F.col(n) != 0, F.lit(100.0) * F.col(x) / F.col(n))


def risk_differences(adsl: DataFrame, adae: DataFrame, control: str = tm.CONTROL_ARM, arms: Arms | None = None) -> DataFrame:
    """T5: active minus control TEAE incidence per (SOC, PT) and active arm, Newcombe 95% CI, in points.

    The (SOC, PT) x active-arm rows come from exploding a literal array of the
    active arms over the per-(SOC, PT) counts: no join and no cross product.
    """
    arms = arms or arm_summary(adsl)
    t = teae(adae)
    actives = [a for a in arms.names if a != control]
    if control not in arms.names or not actives:
        return t.select(*[F.lit(None).cast(v).alias(c) for c, v in RISK_TYPES.items()]).limit(0)
    wide = t.groupBy("SOC", "PT").agg(*per_arm_counts(arms))  # the profile has a subject once per term
    k = _k(arms)
    per_arm = F.explode(
        F.array(*[F.struct(F.lit(a).alias("Arm"), k(a).alias("xa"), F.lit(arms.n[a]).cast("long").alias("na")) for a in actives])
    )
    rows = wide.select(
        "PT", "SOC", k(control).alias("xc"), F.lit(arms.n[control]).cast("long").alias("nc"), per_arm.alias("r")
    ).select("PT", "SOC", "r.Arm", "r.xa", "r.na", "xc", "nc")
    d, lo, hi = newcombe_diff("xa", "na", "xc", "nc")
    out = rows.select(
        "PT", "SOC", "Arm",
        F.col("xa").alias("n_active"), F.col("na").alias("N_active_arm"),
        F.col("xc").alias("n_control"), F.col("nc").alias("N_control_arm"),
        _pct("xa", "na").alias("Pct_active"),
        _pct("xc", "nc").alias("Pct_control"),
        (F.lit(100.0) * d).alias("Diff"),
        (F.lit(100.0) * lo).alias("Lower"),
        (F.lit(100.0) * hi).alias("Upper"),
    )
    return out.orderBy(F.col("Diff").desc_nulls_last(), "SOC", "PT", "Arm")


def wilson_by_pt(adsl: DataFrame, adae: DataFrame, arms: Arms | None = None) -> DataFrame:
    """E20 on data: Wilson 95% interval of each (PT, arm) TEAE incidence in the safety population."""
    arms = arms or arm_summary(adsl)
    wide = subjects_by_arm(teae(adae), ["PT"], arms)
    k = _k(arms)
    per_arm = F.explode(
        F.array(*[F.struct(F.lit(a).alias("Arm"), k(a).alias("x"), F.lit(arms.n[a]).cast("long").alias("n")) for a in arms.names])
    )
    rows = wide.select("PT", per_arm.alias("r")).select("PT", "r.*")
    lo, hi = wilson("x", "n")
    return rows.select("PT", "Arm", "x", "n", lo.alias("Lower"), hi.alias("Upper"))


# ---------------------------------------------------------------------------
# T6-T8 laboratory tables
# ---------------------------------------------------------------------------

SHIFT_COLUMNS = ["PARAMCD", "TRTA", "BNRIND", "Worst post-baseline", "Subjects"]
HYS_COLUMNS = ["USUBJID", "TRTA", "Peak ALT/AST xULN", "Peak bilirubin xULN", "Potential Hy's law"]
MEAN_CHANGE_COLUMNS = ["PARAMCD", "PARAM", "TRTA", "AVISITN", "AVISIT", "n", "Mean CHG", "SE"]


def post_baseline() -> Column:
    return (F.col("ABLFL") != "Y") & (F.coalesce(F.col("ADY"), F.lit(0)) > 1)


#: Which grouping of the lab profile a row belongs to.
LAB_SET = "_set"
_SUBJECT_SET, _VISIT_SET = ["PARAMCD", "TRTA", "USUBJID", "BNRIND"], ["PARAMCD", "TRTA", "PARAM", "AVISITN", "AVISIT"]


def lab_profile(adlb: DataFrame) -> DataFrame:
    """What the lab tables are made of, in one pass over ADLB: two grouping sets, each partially aggregated.

    By parameter, arm, subject and baseline indicator: ``_rank`` of the worst post-baseline indicator and ``_peak``
    ratio to the upper limit. By parameter, arm and visit: ``_n``, ``_mean`` and ``_sd`` of the change. A profile is
    passed on as it is.
    """
    if LAB_SET in adlb.columns:
        return adlb
    # FIXED VALUES: worst-indicator ranking '' 0, NORMAL 1, LOW 2, HIGH 3.
    a = F.col("ANRIND")
    rank = F.when(a == "NORMAL", 1).when(a == "LOW", 2).when(a == "HIGH", 3).otherwise(0)
    shifted = post_baseline() & (a != "") & (F.col("BNRIND") != "")
    changed = (F.col("ABLFL") != "Y") & (F.col("AVISITN") > 1)
    # grouping columns are NULL in the other set's rows, so what is aggregated is computed before
    rows = adlb.select(
        *dict.fromkeys(_SUBJECT_SET + _VISIT_SET),
        F.when(shifted, rank).alias("_rank"), F.when(post_baseline(), F.col("R2ANRHI")).alias("_peak"),
        F.when(changed, F.col("CHG")).alias("_chg"),
    ).filter(F.coalesce("_rank", "_peak", "_chg").isNotNull())
    return rows.groupingSets(
        [[F.col(c) for c in _SUBJECT_SET], [F.col(c) for c in _VISIT_SET]],
        *[F.col(c) for c in dict.fromkeys(_SUBJECT_SET + _VISIT_SET)],
    ).agg(
        F.when(F.grouping("USUBJID") == 1, "visit").otherwise("subject").alias(LAB_SET),
        F.max("_rank").alias("_rank"), F.max("_peak").alias("_peak"),
        F.count("_chg").alias("_n"), F.avg("_chg").alias("_mean"), F.stddev_samp("_chg").alias("_sd"),
    )


def lab_shift(adlb: DataFrame) -> DataFrame:
    """Subjects by parameter, arm, baseline indicator and worst post-baseline indicator (HIGH > LOW > NORMAL).

    No safety-population filter (as published).
    """
    worst = lab_profile(adlb).filter((F.col(LAB_SET) == "subject") & F.col("_rank").isNotNull())
    r = F.col("_rank")
    label = F.when(r == 1, "NORMAL").when(r == 2, "LOW").when(r == 3, "HIGH").otherwise("")
    return worst.groupBy("PARAMCD", "TRTA", "BNRIND", label.alias("Worst post-baseline")).agg(
        F.count(F.lit(1)).alias("Subjects")
    ).orderBy(*SHIFT_COLUMNS[:4])


def hys_law(adlb: DataFrame) -> DataFrame:
    """Per-subject peak post-baseline ALT/AST and bilirubin (x ULN) and the potential Hy's law flag.

    Peaks need not come from the same visit; subjects with no ratio at all are absent.
    """
    post = lab_profile(adlb).filter((F.col(LAB_SET) == "subject") & F.col("PARAMCD").isin("ALT", "AST", "BILI"))
    wide = post.groupBy("USUBJID", "TRTA").agg(
        *[F.max(F.when(F.col("PARAMCD") == p, F.col("_peak"))).alias(p) for p in ("ALT", "AST", "BILI")]
    )
    wide = wide.filter(F.col("ALT").isNotNull() | F.col("AST").isNotNull() | F.col("BILI").isNotNull())
    peak = F.greatest("ALT", "AST")
    hys = F.coalesce((peak >= tm.HYS_ALT_AST_ULN) & (F.col("BILI") >= tm.HYS_BILI_ULN), F.lit(False))
    return wide.select(
        "USUBJID",
        "TRTA",
        peak.alias("Peak ALT/AST xULN"),
        F.col("BILI").alias("Peak bilirubin xULN"),
        hys.alias("Potential Hy's law"),
    ).orderBy(F.col("`Peak ALT/AST xULN`").desc_nulls_last(), "USUBJID")


def lab_mean_change(adlb: DataFrame) -> DataFrame:
    """N, mean change and SE = sd / sqrt(n) by parameter, arm and post-baseline visit (n = 1 -> SE NULL)."""
    visits = lab_profile(adlb).filter((F.col(LAB_SET) == "visit") & (F.col("_n") > 0))
    return visits.select(
        "PARAMCD", "PARAM", "TRTA", "AVISITN", "AVISIT", F.col("_n").alias("n"), F.col("_mean").alias("Mean CHG"),
        (F.col("_sd") / F.sqrt(F.col("_n").cast("double"))).alias("SE"),
    ).orderBy(*MEAN_CHANGE_COLUMNS[:5])
