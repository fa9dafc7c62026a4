"""One-pass rule engine and findings.

A domain's rules run *in order*: a row quarantined by one rule is invisible to
every later rule. Instead of filtering the table once per rule, all rule
conditions are evaluated in a single projection:

    hit_r   = cond_r AND NOT (any earlier quarantine condition)
    QREASON = reason of the first quarantine rule that hits

``clean`` and ``quarantine`` are then two filters of the same flagged table, and
findings are an aggregation of its hit rows. Examples (first five distinct
sorted identifiers per rule) use ``row_number() <= 5`` over a de-duplicated
(rule, id) table; Spark plans that as a partial window-group limit before the
shuffle, so no rule ever gathers more than five ids per partition in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trialguard import schemas
from trialguard.terminology import SEVERITIES

MAX_EXAMPLES = 5


@dataclass(frozen=True)
class Rule:
    """A data-quality rule. ``key`` is unique; several keys may share a ``rule_id``."""

    rule_id: str
    domain: str
    severity: str
    message: str
    quarantine: str | None = None
    examples: bool = True
    key: str = ""

    def __post_init__(self) -> None:
        if self.severity not in SEVERITIES:
            raise ValueError(f"unknown severity {self.severity!r}")
        if not self.key:
            object.__setattr__(self, "key", self.rule_id)


def flag_rows(df: DataFrame, checks: Sequence[tuple[Rule, Column]]) -> DataFrame:
    """Evaluate ordered rules on every row: adds ``_hits`` (rule key per rule, NULL when not hit) and ``QREASON``."""
    # Conditions are materialised as boolean columns first, so each (possibly
    # regex-heavy) condition is evaluated once per row, not once per later rule.
    conds = {f"_r{i}": F.coalesce(cond, F.lit(False)) for i, (_, cond) in enumerate(checks)}
    df = df.withColumns(conds) if conds else df
    alive = F.lit(True)
    hits: list[Column] = []
    reason: Column | None = None
    for i, (rule, _) in enumerate(checks):
        c = F.col(f"_r{i}")
        hit = alive & c
        hits.append(F.when(hit, F.lit(rule.key)))
        if rule.quarantine is not None:
            r = F.when(hit, F.lit(rule.quarantine))
            reason = r if reason is None else F.coalesce(reason, r)
            alive = alive & ~c
    # A plain array with NULL for rules that did not hit: CreateArray stays in codegen
    # (a higher-order ``filter`` would force interpreted evaluation of every condition).
    arr = F.array(*hits) if hits else F.array().cast("array<string>")
    return df.withColumn("_hits", arr).withColumn("QREASON", reason if reason is not None else F.lit(None).cast("string"))


def hit_rows(flagged: DataFrame, rules: Iterable[Rule], id_col: str) -> DataFrame:
    """One row per (row, rule hit): ``key``, ``_id`` (NULL for count-only rules), ``_w`` = 1."""
    count_only = [r.key for r in rules if not r.examples]
    exploded = flagged.select(F.explode("_hits").alias("key"), F.col(id_col).cast("string").alias("_id")).filter(
        F.col("key").isNotNull()
    )
    ident = F.when(F.col("key").isin(*count_only), F.lit(None).cast("string")).otherwise(F.col("_id")) if count_only else F.col("_id")
    return exploded.select("key", ident.alias("_id"), F.lit(1).cast("long").alias("_w"))


def _meta(rules: Sequence[Rule], attr: str) -> Column:
    key = F.col("key")
    out = None
    for r in rules:
        v = F.lit(getattr(r, attr))
        out = F.when(key == r.key, v) if out is None else out.when(key == r.key, v)
    return out if out is not None else F.lit(None).cast("string")


def summarize_hits(hits: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Findings from hit rows ``(key, _id, _w)``: count = sum of weights; up to 5 sorted distinct ids."""
    per_id = hits.groupBy("key", "_id").agg(F.sum("_w").alias("_n"))
    counts = per_id.groupBy("key").agg(F.sum("_n").alias("count"))
    # NULL ids come last and are passed over by collect_list. Nothing is filtered before, and the window reads the
    # count too, so that both sides read one and the same shuffle and the hits are worked out once.
    by_id = Window.partitionBy("key").orderBy(F.col("_id").asc_nulls_last(), "_n")
    top = (
        per_id.withColumn("_rn", F.row_number().over(by_id))
        .filter(F.col("_rn") <= MAX_EXAMPLES)
        .groupBy("key")
        .agg(F.array_join(F.array_sort(F.collect_list("_id")), ", ").alias("examples"))
    )
    out = counts.filter(F.col("count") > 0).join(top, "key", "left")
    return out.select(
        _meta(rules, "rule_id").alias("rule_id"),
        _meta(rules, "domain").alias("domain"),
        _meta(rules, "severity").alias("severity"),
        _meta(rules, "message").alias("message"),
        F.col("count").cast("long").alias("count"),
        F.coalesce(F.col("examples"), F.lit("")).alias("examples"),
    )


def findings_of(flagged: DataFrame, rules: Sequence[Rule], id_col: str) -> DataFrame:
    """Findings of a flagged table."""
    return summarize_hits(hit_rows(flagged, rules, id_col), rules)


def literal_findings(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """Findings known on the driver (structural checks, stage failures): ``(rule_id, domain, severity, message, count, examples)``."""
    data = []
    for rule_id, domain, severity, message, count, examples in rows:
        if severity not in SEVERITIES:
            raise ValueError(f"unknown severity {severity!r}")
        if count:
            data.append((rule_id, domain, severity, message, int(count), examples))
    return spark.createDataFrame(data, schemas.struct("FINDINGS"))


def empty_findings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.struct("FINDINGS"))


def severity_rank(c: Column | str = "severity") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    out = None
    for i, s in enumerate(SEVERITIES):
        out = F.when(c == s, F.lit(i)) if out is None else out.when(c == s, F.lit(i))
    return out.otherwise(F.lit(len(SEVERITIES)))


def sort_findings(findings: DataFrame) -> DataFrame:
    """ERROR, WARNING, NOTE, then rule_id (domain and message break ties)."""
    return findings.orderBy(severity_rank(), "rule_id", "domain", "message")


def union_all(frames: Sequence[DataFrame], spark: SparkSession | None = None) -> DataFrame:
    frames = [f for f in frames if f is not None]
    if not frames:
        if spark is None:
            raise ValueError("nothing to union")
        return empty_findings(spark)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def by_severity(findings: DataFrame) -> DataFrame:
    """number of findings (rules, not records) per severity."""
    return findings.groupBy("severity").agg(F.count(F.lit(1)).alias("findings"))
