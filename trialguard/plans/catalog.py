"""Registered queries: one per operator of the inventory, over the supplied tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame built from
the raw DM / AE / LB tables that ``sources.fixtures`` derives from the
``customer`` / ``orders`` / ``lineitem`` tables of that directory, so every
query's work grows with the scale factor. Double columns are rounded to six
decimals at the very end (``rounded``) so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialguard import files, sinks
from trialguard.functions import for_transport, iso_date, to_number
from trialguard.operators import adam, cleaning, conformance, sdtm, tables, views
from trialguard.operators.rules import by_severity, sort_findings, union_all
from trialguard.plans import readers
from trialguard.plans.stages import StageStore, shared_store
from trialguard.sources import fixtures
from trialguard.sources.raw import normalize_values
from trialguard import terminology as tm

SEARCH_QUERY = "soc0|pt1"
PREVIEW_ROWS = 500
TOP_PTS = 12


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column (presentation step for cross-engine comparison)."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


class Study:
    """The lazy plans of one study (one scale-factor directory)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return fixtures.raw_bundle(self.spark, self.sf_dir)

    @cached_property
    def dm(self) -> cleaning.Cleaned:
        return cleaning.flag_dm(self.raw["dm"])

    @cached_property
    def ae(self) -> cleaning.Cleaned:
        return cleaning.flag_ae(self.raw["ae"], self.dm.clean)

    @cached_property
    def lb(self) -> cleaning.Cleaned:
        return cleaning.flag_lb(self.raw["lb"], self.dm.clean)

    @cached_property
    def sdtm_dm(self) -> DataFrame:
        return sdtm.build_dm(self.dm.clean)

    @cached_property
    def sdtm_ae(self) -> DataFrame:
        return sdtm.build_ae(self.ae.clean_with_subject, self.sdtm_dm)

    @cached_property
    def lab_rows(self) -> DataFrame:
        """Only the rows of crowded subjects are shuffled by grain; all others are numbered where they meet DM."""
        usual, large, known = cleaning.crowded_apart(self.raw["lb"], self.dm.clean)
        usual, large = (cleaning.flag_lb(lb, dm).clean_with_subject for lb, dm in ((usual, self.dm.clean), (large, known)))
        return sdtm.whole_lab_rows(usual, self.sdtm_dm).unionByName(sdtm.lab_rows(sdtm.never_null(large), self.sdtm_dm))

    @cached_property
    def sdtm_lb(self) -> DataFrame:
        return sdtm.lab_domain(self.lab_rows)

    @cached_property
    def adsl(self) -> DataFrame:
        return adam.build_adsl(self.dm.clean)

    @cached_property
    def adae(self) -> DataFrame:
        return adam.build_adae(self.sdtm_ae, self.adsl)

    @cached_property
    def adlb(self) -> DataFrame:
        rows = sdtm.unnumbered_lab_rows(self.lb.clean_with_subject, self.sdtm_dm)  # ADLB has no sequence number
        return adam.build_adlb(sdtm.lab_domain(rows, sdtm.BASE_VALUE, sdtm.BASE_INDICATOR), self.adsl)

    @cached_property
    def arms(self) -> tables.Arms:
        return tables.arm_summary(self.adsl)

    @property
    def events(self) -> DataFrame:
        """What the event tables are read from."""
        return self.adae

    @property
    def labs(self) -> DataFrame:
        """What the lab tables are read from."""
        return self.adlb

    def conformance(self) -> DataFrame:
        return conformance.check_sdtm(self.spark, {"DM": self.sdtm_dm, "AE": self.sdtm_ae, "LB": self.sdtm_lb})

    def findings(self) -> DataFrame:
        return union_all([self.dm.findings, self.ae.findings, self.lb.findings, self.conformance()])


class StoredStudy(Study):
    """The same study over stored stages, which all its queries share.

    Stages lie in the session's shared folder under the fingerprint of the input files, so each raw table is read
    once however many queries ask, and a plan starts at the closest stage. Asking for a stage that is not there yet
    stores it.
    """

    @cached_property
    def store(self) -> StageStore:
        inputs = (f"{self.sf_dir.rstrip('/')}/{t}.parquet" for t in ("customer", "orders", "lineitem"))
        return shared_store(self.spark, files.fingerprint(self.spark, *inputs))

    def _flagged(self, domain: str, build: Callable[[], cleaning.Cleaned]) -> cleaning.Cleaned:
        return cleaning.of_stored(domain, self.store.get(f"flagged/{domain}", lambda: build().essential))

    @cached_property
    def dm(self) -> cleaning.Cleaned:
        return self._flagged("dm", lambda: cleaning.flag_dm(self.raw["dm"]))

    @cached_property
    def ae(self) -> cleaning.Cleaned:
        return self._flagged("ae", lambda: cleaning.flag_ae(self.raw["ae"], self.dm.clean))

    @cached_property
    def lb(self) -> cleaning.Cleaned:
        return self._flagged("lb", lambda: cleaning.flag_lb(self.raw["lb"], self.dm.clean))

    @cached_property
    def sdtm_ae(self) -> DataFrame:
        return self.store.get("sdtm/ae", lambda: sdtm.build_ae(self.ae.clean_with_subject, self.sdtm_dm, stored=True))

    @cached_property
    def lb_with_baseline(self) -> DataFrame:
        plan = lambda: sdtm.build_lb_with_baseline(
            self.lb.clean_with_subject, self.sdtm_dm, stored=True, subjects=adam.arms_of(self.adsl)
        )
        return self.store.get("sdtm/lb", plan)

    @cached_property
    def sdtm_lb(self) -> DataFrame:
        return sdtm.without_baseline(self.lb_with_baseline)

    @cached_property
    def adae(self) -> DataFrame:
        return self.store.get("adam/adae", lambda: adam.build_adae(self.sdtm_ae, self.adsl))

    @cached_property
    def adlb(self) -> DataFrame:
        """Read once by what needs it, so it is not stored; the stored LB is taken if there is one."""
        return adam.build_adlb(self.lb_with_baseline, self.adsl) if self.store.mark("sdtm/lb") else super().adlb

    @cached_property
    def events(self) -> DataFrame:
        return self.store.get("profile/events", lambda: tables.event_profile(self.adae))

    @cached_property
    def labs(self) -> DataFrame:
        return self.store.get("profile/labs", lambda: tables.lab_profile(self.adlb))

    def findings(self) -> DataFrame:
        return self.store.get("findings", super().findings)


Query = Callable[[SparkSession, str], DataFrame]


def _q(fn: Callable[[Study], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(fn(Study(spark, sf_dir)))


#: Queries that store stages, or files to read, when they are composed.
STORING = set(readers.QUERIES)


def _stored(name: str, fn: Callable[[Study], DataFrame]) -> Query:
    STORING.add(name)
    return lambda spark, sf_dir: rounded(fn(StoredStudy(spark, sf_dir)))


def _expr_dates(s: Study) -> DataFrame:
    r = s.raw["ae"]
    return r.select(
        "RECNO", F.col("AESTDT").alias("start_text"), F.col("AEENDT").alias("end_text"),
        iso_date("AESTDT").alias("start_date"), iso_date("AEENDT").alias("end_date"),
    )


def _expr_numbers(s: Study) -> DataFrame:
    r = s.raw["lb"]
    return r.select(
        "RECNO", "LBORRES", to_number("LBORRES").alias("result_num"), "LBORNRLO", to_number("LBORNRLO").alias("low_num"),
        "VISITNUM", to_number("VISITNUM").alias("visit_num"),
    )


def _conformance_broken(s: Study) -> DataFrame:
    """C1-C18 on copies of the domains with faults: every rule fires."""
    broken = fixtures.broken_domains(s.sdtm_dm, s.sdtm_ae, s.sdtm_lb)
    return conformance.check_sdtm(s.spark, broken, fixtures.BROKEN_LABELS)


def _conformance_orphans(s: Study) -> DataFrame:
    """J7 over the raw-derived subject keys of AE and LB against SDTM DM: domain, USUBJID, records."""
    parts = []
    for dom, key in (("AE", "ae"), ("LB", "lb")):
        keyed = s.raw[key].select(F.concat(F.lit(tm.STUDYID + "-"), F.col("SUBJID")).alias("USUBJID"))
        orphans = conformance.orphan_subjects(keyed, s.sdtm_dm)
        parts.append(orphans.groupBy("USUBJID").agg(F.count(F.lit(1)).alias("records")).select(F.lit(dom).alias("domain"), "USUBJID", "records"))
    return parts[0].unionByName(parts[1])


def _run_status(s: Study) -> DataFrame:
    """F6 as a query: status and finding counts from the run's findings and quarantine sizes."""
    f = s.findings()
    counts = f.agg(
        F.count(F.when(F.col("severity") == "ERROR", 1)).alias("errors"),
        F.count(F.when(F.col("severity") == "WARNING", 1)).alias("warnings"),
        F.count(F.when(F.col("severity") == "NOTE", 1)).alias("notes"),
    ).select("errors", "warnings", "notes", F.lit(0).cast("long").alias("quarantined"))
    q = [c.flagged.agg(F.count(F.when(F.col("QREASON").isNotNull(), 1)).alias("q")) for c in (s.dm, s.ae, s.lb)]
    quar = q[0].unionByName(q[1]).unionByName(q[2]).agg(F.sum("q").cast("long").alias("quarantined")).select(
        F.lit(0).cast("long").alias("errors"), F.lit(0).cast("long").alias("warnings"), F.lit(0).cast("long").alias("notes"), "quarantined"
    )
    tot = counts.unionByName(quar).agg(*[F.sum(c).cast("long").alias(c) for c in ("errors", "warnings", "notes", "quarantined")])
    status = F.when((F.col("errors") > 0) | (F.col("warnings") > 0) | (F.col("quarantined") > 0), F.lit(tm.STATUS_WARN)).otherwise(F.lit(tm.STATUS_PASSED))
    return tot.select(status.alias("status"), "errors", "warnings", "notes", "quarantined")


def _record_counts(s: Study) -> DataFrame:
    sets = {
        "DM": s.sdtm_dm, "AE": s.sdtm_ae, "LB": s.sdtm_lb, "ADSL": s.adsl, "ADAE": s.adae, "ADLB": s.adlb,
        "quarantine_dm": s.dm.quarantine, "quarantine_ae": s.ae.quarantine, "quarantine_lb": s.lb.quarantine,
    }
    parts = [df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(k).alias("dataset"), "records") for k, df in sets.items()]
    return union_all(parts)


def _metadata(s: Study) -> DataFrame:
    sets = {"DM": s.sdtm_dm, "AE": s.sdtm_ae, "LB": s.sdtm_lb, "ADSL": s.adsl, "ADAE": s.adae, "ADLB": s.adlb}
    return sinks.dataset_metadata(s.spark, sets)


def _digest(s: Study) -> DataFrame:
    sets = {"DM": s.sdtm_dm, "AE": s.sdtm_ae, "LB": s.sdtm_lb, "ADSL": s.adsl, "ADAE": s.adae, "ADLB": s.adlb}
    return union_all([sinks.content_digest(df).select(F.lit(k).alias("dataset"), "records", "digest") for k, df in sets.items()])


def _forest(s: Study) -> DataFrame:
    risk = tables.risk_differences(s.adsl, s.events, arms=s.arms)
    arm = views.default_forest_arm(s.arms)
    return views.forest_rows(risk, arm or "")


def _kpis(s: Study) -> DataFrame:
    ov = tables.teae_overview(s.adsl, s.events, s.arms)
    return views.dashboard_kpis(s.adsl, ov, tables.hys_law(s.labs))


QUERIES: dict[str, Query] = {
    # sources and expressions
    "raw_dm": _q(lambda s: s.raw["dm"]),
    "raw_ae": _q(lambda s: s.raw["ae"]),
    "raw_lb": _q(lambda s: s.raw["lb"]),
    "normalized_dm": _q(lambda s: normalize_values(s.raw["dm"])),
    "expr_dates": _q(_expr_dates),
    "expr_numbers": _q(_expr_numbers),
    **readers.QUERIES,
    # cleaning, quarantine, findings
    "dm_clean": _q(lambda s: s.dm.clean),
    "ae_clean": _q(lambda s: s.ae.clean),
    "lb_clean": _q(lambda s: s.lb.clean),
    "dm_quarantine": _q(lambda s: s.dm.quarantine),
    "ae_quarantine": _q(lambda s: s.ae.quarantine),
    "lb_quarantine": _q(lambda s: s.lb.quarantine),
    "dm_findings": _q(lambda s: s.dm.findings),
    "ae_findings": _q(lambda s: s.ae.findings),
    "lb_findings": _q(lambda s: s.lb.findings),
    "ae_orphans": _q(lambda s: cleaning.orphans(s.raw["ae"], s.dm.clean).select("RECNO", "SUBJID")),
    # SDTM and ADaM
    "sdtm_dm": _q(lambda s: s.sdtm_dm),
    "sdtm_ae": _q(lambda s: s.sdtm_ae),
    "sdtm_lb": _q(lambda s: s.sdtm_lb),
    "adsl": _q(lambda s: s.adsl),
    "adae": _q(lambda s: s.adae),
    "adlb": _stored("adlb", lambda s: s.adlb),
    # conformance
    "conformance": _stored("conformance", lambda s: s.conformance()),
    "conformance_broken": _stored("conformance_broken", _conformance_broken),
    "conformance_orphans": _q(_conformance_orphans),
    "labs_without_baseline": _stored("labs_without_baseline", lambda s: conformance.subjects_without_baseline(s.sdtm_lb)),
    # safety tables
    "arm_order": _q(lambda s: tables.arm_order(s.adsl)),
    "safety_n": _q(lambda s: tables.safety_n(s.adsl)),
    "demographics": _stored("demographics", lambda s: tables.demographics(s.adsl, s.arms)),
    "teae_overview": _stored("teae_overview", lambda s: tables.teae_overview(s.adsl, s.events, s.arms)),
    "teae_soc_pt": _stored("teae_soc_pt", lambda s: tables.teae_soc_pt(s.adsl, s.events, s.arms)),
    "risk_differences": _stored("risk_differences", lambda s: tables.risk_differences(s.adsl, s.events, arms=s.arms)),
    "wilson_by_pt": _stored("wilson_by_pt", lambda s: tables.wilson_by_pt(s.adsl, s.events, s.arms)),
    "lab_shift": _stored("lab_shift", lambda s: tables.lab_shift(s.labs)),
    "hys_law": _stored("hys_law", lambda s: tables.hys_law(s.labs)),
    "lab_mean_change": _stored("lab_mean_change", lambda s: tables.lab_mean_change(s.labs)),
    # findings and run control
    "findings": _stored("findings", lambda s: sort_findings(s.findings())),
    "findings_by_severity": _stored("findings_by_severity", lambda s: by_severity(s.findings())),
    "run_status": _stored("run_status", _run_status),
    "record_counts": _stored("record_counts", _record_counts),
    # sinks
    "xpt_ready_adsl": _q(lambda s: for_transport(s.adsl)),
    "dataset_metadata": _stored("dataset_metadata", _metadata),
    "content_digest": _stored("content_digest", _digest),
    # dashboard views
    "dashboard_kpis": _stored("dashboard_kpis", _kpis),
    "pt_incidence_top": _stored("pt_incidence_top", lambda s: views.pt_incidence_top(s.events, s.arms, TOP_PTS)),
    "forest_rows": _stored("forest_rows", _forest),
    "soc_pt_search": _stored("soc_pt_search", lambda s: views.soc_pt_search(tables.teae_soc_pt(s.adsl, s.events, s.arms), SEARCH_QUERY)),
    "edish_points": _stored("edish_points", lambda s: views.edish_points(tables.hys_law(s.labs))),
    "mean_change_band": _stored("mean_change_band", lambda s: views.mean_change_band(tables.lab_mean_change(s.labs))),
    "lab_shift_wide": _stored("lab_shift_wide", lambda s: views.lab_shift_wide(tables.lab_shift(s.labs))),
    "dataset_preview": _stored("dataset_preview", lambda s: views.dataset_preview(s.adae, ["USUBJID", "AESEQ"], PREVIEW_ROWS)),
}
